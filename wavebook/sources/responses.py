"""Response files: CSV text, one row per participant, every column read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavebook.operators.clean import check_names
from wavebook.session import new_folder
from wavebook.sources import split_csv

#: Never occurs in a file, so '' stays '' and only a missing field is null.
_NO_NULL_TEXT = "\u0001"


def read_responses(
    spark: SparkSession, path: str, multi_line: bool = True, split_above: int | None = None
) -> DataFrame:
    """CSV with a header. Types are not guessed: '007' and '1.0' stay as they are.

    ``multi_line`` allows line breaks inside quoted answers. If a file is larger than
    ``split_above`` bytes, which is what Spark gives one task unless told, many tasks read it,
    see :mod:`wavebook.sources.split_csv`: its quotes are counted at once, and its rows are read
    with the result. Small files, and sets with stray quotes, mixed line ends or an answer that is
    never closed, are read by one task a file; the rows are the same either way. Without line breaks in
    answers turn it off: files are split and nothing needs to be counted.
    Every file's header is checked against the first one's.
    """
    options = {
        "quote": '"',
        "escape": '"',
        "nullValue": _NO_NULL_TEXT,
        "multiLine": multi_line,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    head = spark.read.options(header=False, **options).csv(path).limit(1).collect()
    if not head:
        raise ValueError(f"no header in {path}")
    names = [name or "" for name in head[0]]
    check_names(names)
    if multi_line and _largest_file(spark, path) > _bytes_of_a_task(spark, split_above):
        found = split_csv.ranges(spark, path)
        if not split_csv.need_one_task(found):
            as_text = {key: str(value).lower() if isinstance(value, bool) else value for key, value in options.items()}
            return split_csv.parsed(split_csv.records(spark, path, found), names, as_text)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.schema(schema).options(header=True, enforceSchema=False, **options).csv(path)
    )


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max("length")).first()[0] or 0


def _bytes_of_a_task(spark: SparkSession, asked: int | None) -> int:
    if asked is not None:
        return asked
    # the setting is text with a unit, which only Spark knows how to read
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def unpack_envelopes(spark: SparkSession, path: str, target: str | None = None) -> str:
    """JSON files ``{"data": "<csv text>"}`` to a CSV file set; returns its path.

    Each envelope becomes a file of its own, so no two headers share a file. All lie in one
    folder, so that no folder is listed for each envelope. The target lies in the shared folder
    unless given.
    """
    target = target or new_folder(spark, "responses")
    file_path = F.col("_metadata.file_path")
    missing = F.raise_error(F.concat(F.lit("no response text in "), file_path))
    (
        spark.read.schema("data string")
        .json(path, multiLine=True)
        .select(F.coalesce("data", missing).alias("data"))
        .write.option("maxRecordsPerFile", 1)
        .mode("errorifexists")
        .text(target)
    )
    return target


def read_response_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return read_responses(spark, unpack_envelopes(spark, path))
