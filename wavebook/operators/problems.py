"""Reporting everything that is wrong with a table of any size in one error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from wavebook.session import new_folder

#: Problems named in the message itself; all of them stand in the table that it names.
SHOWN = 20


def raise_if_any(found: DataFrame, problem: Column, error: type[Exception], heading: str) -> None:
    """Raise ``error`` if there are rows, each of them a problem told in words.

    All problems are written to the shared folder. The message gives their exact number,
    the first ones in alphabetical order, and the folder if there are more.
    """
    spark = found.sparkSession
    path = new_folder(spark, "problems")
    found.select(problem.alias("problem")).write.parquet(path)
    stored = spark.read.schema("problem string").parquet(path)
    count = stored.count()
    if not count:
        return
    lines = [row.problem for row in stored.orderBy("problem").limit(SHOWN).collect()]
    if count > SHOWN:
        lines.append(f"and {count - SHOWN} more: all {count} are in {path}")
    raise error("\n".join([heading, *lines]))
