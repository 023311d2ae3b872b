"""The data dictionary as text files, one folder per survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavebook.operators.dictionary import (
    dictionary_frame,
    dictionary_lines,
    dictionary_overview,
    overview_lines,
    text_around,
    text_in_order,
)
from wavebook.session import staged


def all_lines(metadata: DataFrame) -> DataFrame:
    """The full document of every survey, one row per line."""
    return overview_lines(dictionary_overview(metadata)).unionByName(
        dictionary_lines(dictionary_frame(metadata))
    )


def write_dictionary(metadata: DataFrame, path: str) -> None:
    """Write ``<path>/survey_id=<survey>/part-*.txt``, lines in order across the parts.

    The sort is by ranges, so surveys and long surveys alike are spread over tasks. It reads
    what it sorts twice, for the ranges and for the sort: the lines around the tables are stored
    first, the variables' lines are only made from the stored metadata where they are written.
    """
    around = staged(text_around(metadata), "lines")
    (
        text_in_order(dictionary_frame(metadata), around)
        .write.partitionBy("survey_id")
        .mode("errorifexists")
        .text(path)
    )


def write_index(metadata: DataFrame, path: str) -> None:
    """Write the start page of every survey's dictionary."""
    overview = dictionary_overview(metadata)
    text = F.concat(
        F.lit("# "),
        F.col("survey_id"),
        F.lit("\n\nThis survey asks "),
        F.col("total_questions").cast("string"),
        F.lit(" questions, which give "),
        F.col("total_variables").cast("string"),
        F.lit(" variables.\nThe dictionary lists each of them with its type and values."),
    )
    (
        overview.select("survey_id", text.alias("line"))
        .write.partitionBy("survey_id")
        .mode("errorifexists")
        .text(path)
    )
