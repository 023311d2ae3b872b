"""Loading a wave and building the dictionary, start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wavebook.operators.clean import clean_responses, page_times
from wavebook.operators.contract import compile_contract
from wavebook.operators.flatten import (
    classify_questions,
    explode_variables,
    question_variables,
    require_valid,
)
from wavebook.operators.naming import (
    name_questions,
    require_named,
    require_unique_names,
    use_names,
)
from wavebook.operators.structure import require_same_structure
from wavebook.operators.validate import (
    WatchedRows,
    contract_checks,
    metadata_report,
    require_no_failures,
    written_report,
)
from wavebook.schemas import METADATA
from wavebook.session import staged
from wavebook.sources.definitions import normalize_questions, read_questions
from wavebook.sources.dictionary_files import write_dictionary, write_index
from wavebook.sources.tables import SurveyTables


def classified_questions(definitions: DataFrame) -> DataFrame:
    """(survey_id, definition) to typed questions with their inferred type."""
    return classify_questions(normalize_questions(read_questions(definitions)))


def survey_metadata(definitions: DataFrame) -> DataFrame:
    """(survey_id, definition) to named metadata: one stage, no shuffle, no checks."""
    questions = question_variables(classified_questions(definitions))
    return explode_variables(name_questions(questions))


def checked_metadata(definitions: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Named metadata of all surveys, staged; raises with everything that is wrong.

    ``names`` overrides the names made by rule, see :func:`use_names`.
    """
    require_valid(classified_questions(definitions))
    metadata = survey_metadata(definitions)
    if names is not None:
        metadata = use_names(metadata, names)
    metadata = staged(metadata.select(METADATA.names), "metadata")
    require_unique_names(metadata)
    require_named(metadata)
    require_no_failures(metadata_report(metadata), "the metadata")
    return metadata


def load_wave(
    tables: SurveyTables,
    metadata: DataFrame,
    responses: DataFrame,
    **formats: str,
) -> int:
    """Check, clean, validate and store one wave; returns its number.

    The structure check comes first, before the responses are touched. The cleaned wave
    is written once, to the folder of its partition, and the job that writes it counts its
    failing rows; only then does the table show it. So the response files are parsed and the
    rows written a single time, and only columns with a long code book are read again. The rows
    validated are the rows stored, also if executors are lost meanwhile. A wave that fails its
    checks is removed.
    """
    own = metadata.where(metadata.survey_id == tables.survey_id)
    if tables.exists():
        require_same_structure(tables.metadata(), own)
        own = use_names(own, tables.metadata())
    wave = tables.next_wave()
    contract = compile_contract(own, tables.survey_id, page_times(responses))
    cleaned = clean_responses(responses, contract, tables.survey_id, own, **formats)
    watched = WatchedRows(cleaned, contract_checks(cleaned, contract))
    try:
        stored = tables.stage_wave(watched.rows, wave)
        report = written_report(watched, stored, contract, own, tables.survey_id)
        require_no_failures(report, f"wave {wave}")
    except Exception:
        tables.discard_wave(wave)
        raise
    tables.accept_wave(stored, wave, own if wave == 0 else None)
    return wave


def build_dictionary(tables: SurveyTables, path: str) -> None:
    """Write the data dictionary and its start page of a stored survey below ``path``."""
    metadata = tables.metadata()
    write_dictionary(metadata, f"{path}/dictionary")
    write_index(metadata, f"{path}/index")
