"""Raw response text to a typed table, as one projection over one scan."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.functions import casting
from wavebook.functions.joins import lookup_left, new_name
from wavebook.functions.text import strip
from wavebook.schemas import (
    COMPLETED_COLUMN,
    PAGE_TIME_FINAL,
    PAGE_TIME_RAW,
    SYSTEM_COLUMNS,
    UNUSED_COLUMNS,
    WAVE_COLUMN,
    SurveyColumn,
)

_ANSWER = re.compile(r"V\d")
_PAGE_TIME = re.compile(PAGE_TIME_RAW + r"(\d+)")


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def answer_columns(names: Iterable[str]) -> list[str]:
    """Raw columns that hold answers: a capital V followed by a digit."""
    return [name for name in names if _ANSWER.match(name)]


def page_times(raw: DataFrame) -> int:
    """The number of timed pages that a raw table's columns tell of."""
    found = (_PAGE_TIME.fullmatch(name) for name in raw.columns)
    return max((int(match.group(1)) for match in found if match), default=0)


# ---------------------------------------------------------------- rows


def is_completed() -> Column:
    """Not marked '0'; a missing mark counts as not completed."""
    return F.col(COMPLETED_COLUMN).cast("string") != "0"


def has_answer(names: Iterable[str]) -> Column:
    """At least one answer that is neither null nor ''; white space is an answer.

    One flat expression that stops at the first answer, for any number of columns.
    """
    given = [
        F.when(quoted(name).cast("string") != "", F.lit(True)) for name in answer_columns(names)
    ]
    return F.coalesce(*given, F.lit(False))


def filter_completed(raw: DataFrame) -> DataFrame:
    return raw.where(is_completed())


def filter_non_empty(raw: DataFrame) -> DataFrame:
    return raw.where(has_answer(raw.columns))


# ---------------------------------------------------------------- columns


def drop_columns(table: DataFrame, names: list[str] = UNUSED_COLUMNS) -> DataFrame:
    """Drop columns that must be there."""
    missing = [name for name in names if name not in table.columns]
    if missing:
        raise ValueError(f"cannot drop missing columns: {', '.join(missing)}")
    return table.drop(*names)


def final_name(raw_name: str, renames: dict[str, str]) -> str:
    """Name after cleaning: from the metadata, else the system's, else unchanged."""
    if raw_name in renames:
        return renames[raw_name]
    if raw_name in SYSTEM_COLUMNS:
        return SYSTEM_COLUMNS[raw_name][0]
    page_time = _PAGE_TIME.fullmatch(raw_name)
    return f"{PAGE_TIME_FINAL}{page_time.group(1)}" if page_time else raw_name


def check_names(names: Iterable[str]) -> None:
    """Spark ignores case in column names, so names that differ by case only clash too."""
    counts = Counter(name.lower() for name in names)
    clashes = sorted(name for name, count in counts.items() if count > 1)
    if clashes:
        raise ValueError(f"column names clash: {', '.join(clashes)}")


def rename_columns(table: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Raw names to final names for the columns that are present."""
    check_names(table.columns)
    names = [final_name(name, renames) for name in table.columns]
    check_names(names)
    return table.select([quoted(old).alias(new) for old, new in zip(table.columns, names)])


def add_wave(table: DataFrame, wave: int) -> DataFrame:
    return table.withColumn(WAVE_COLUMN, F.lit(wave).cast("bigint"))


# ---------------------------------------------------------------- values


def cleaned_value(value: Column, column: SurveyColumn, **formats: str) -> Column:
    """Decode and cast one column by its contract."""
    text = value.cast("string")
    if column.long_code_book:
        return text
    if column.is_enum:
        return casting.to_enum(casting.decode(text, column.codes, column.labels), column.labels)
    return casting.cast_text(text, column.type_name, column.name, **formats)


def decode_from_table(table: DataFrame, name: str, survey_id: str, metadata: DataFrame) -> DataFrame:
    """Decode one column whose code book is too long for an expression.

    The code book stays a table: codes lead to labels, labels to themselves, and a code
    wins over an equal label. Its size decides between a broadcast and a shuffle.
    """
    pairs = book_pairs(metadata, survey_id, name)
    code, label, text, allowed = (new_name(n) for n in ("code", "label", "text", "allowed"))
    codes = pairs.groupBy(F.col("pair.possible_values_codes").alias(code)).agg(
        F.max_by(F.col("pair.possible_values_labels"), F.col("place")).alias(label)
    )
    labels = book_labels(metadata, survey_id, name, text).withColumn(allowed, F.col(text))
    decoded = lookup_left(table.withColumn(code, quoted(name)), codes, [code])
    stripped = strip(F.coalesce(F.col(label), quoted(name)))
    found = lookup_left(decoded.withColumn(text, stripped), labels, [text])
    return found.select(
        [F.col(allowed).alias(name) if c == name else quoted(c) for c in table.columns]
    )


def book_pairs(metadata: DataFrame, survey_id: str, name: str) -> DataFrame:
    """(place, pair) for every code and label of one variable."""
    variable = metadata.where((F.col("survey_id") == survey_id) & (F.col("id") == name))
    zipped = F.arrays_zip("possible_values_codes", "possible_values_labels")
    return variable.select(F.posexplode(zipped).alias("place", "pair"))


def book_labels(metadata: DataFrame, survey_id: str, name: str, column: str) -> DataFrame:
    """The labels of one variable, each once, in a column of the given name."""
    labels = book_pairs(metadata, survey_id, name).select(
        F.col("pair.possible_values_labels").alias(column)
    )
    return labels.where(F.col(column) != "").distinct()


def clean_responses(
    raw: DataFrame,
    contract: list[SurveyColumn],
    survey_id: str | None = None,
    metadata: DataFrame | None = None,
    **formats: str,
) -> DataFrame:
    """Completed, non-empty responses with final names and types.

    Filter, rename, decode and cast make one projection over the scan, without a
    shuffle. Columns outside the contract are kept as they are. ``survey_id`` and
    ``metadata`` are only needed when the contract has a long code book.
    """
    check_names(raw.columns)
    kept = [name for name in raw.columns if name not in UNUSED_COLUMNS]
    drop_columns(raw)
    renames = {column.raw_name: column.name for column in contract}
    by_name = {column.name: column for column in contract}
    names = [final_name(name, renames) for name in kept]
    check_names(names)
    cleaned = raw.where(is_completed() & has_answer(raw.columns)).select(
        [
            (
                cleaned_value(quoted(old), by_name[new], **formats)
                if new in by_name
                else quoted(old)
            ).alias(new)
            for old, new in zip(kept, names)
        ]
    )
    for column in contract:
        if column.long_code_book and column.name in names:
            if metadata is None or survey_id is None:
                raise ValueError(f"{column.name} has a long code book: pass survey_id and metadata")
            cleaned = decode_from_table(cleaned, column.name, survey_id, metadata)
    return cleaned


def decode_long(answers: DataFrame, metadata: DataFrame) -> DataFrame:
    """Decode (survey_id, id, value) rows of many variables by one join.

    An unknown code keeps its text here, as before the cast.
    """
    pairs = metadata.select(
        "survey_id",
        "id",
        F.posexplode(F.arrays_zip("possible_values_codes", "possible_values_labels")).alias(
            "place", "pair"
        ),
    )
    book = pairs.groupBy("survey_id", "id", F.col("pair.possible_values_codes").alias("value")).agg(
        F.max_by(F.col("pair.possible_values_labels"), F.col("place")).alias("label")
    )
    return lookup_left(answers, book, ["survey_id", "id", "value"]).withColumn(
        "label", F.coalesce("label", "value")
    )
