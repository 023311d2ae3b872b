"""Has the survey's structure changed since the last wave?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavebook.operators.problems import raise_if_any


class StructureMismatch(ValueError):
    """The new definition differs from the stored one."""


def structure_diff(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows by which two variable lists differ as multisets of raw name and type.

    One signed count over the union of both sides: one shuffle, combined before it.
    Readable names may change between waves and are not compared. ``copies`` tells how
    often a row is missing from, or added to, the stored list.
    """
    keys = ["survey_id", "original_id", "question_type"]
    signed = (
        new.select(*keys)
        .withColumn("sign", F.lit(1))
        .unionByName(stored.select(*keys).withColumn("sign", F.lit(-1)))
    )
    balance = signed.groupBy(*keys).agg(F.sum("sign").alias("balance"))
    return balance.where("balance <> 0").select(
        *keys,
        F.when(F.col("balance") > 0, F.lit("added")).otherwise(F.lit("missing")).alias("change"),
        F.abs("balance").cast("bigint").alias("copies"),
    )


def require_same_structure(stored: DataFrame, new: DataFrame) -> None:
    problem = F.concat(
        "change",
        F.lit(": "),
        "original_id",
        F.lit(" ("),
        F.coalesce("question_type", F.lit("no type")),
        F.lit(") in survey "),
        "survey_id",
    )
    heading = "the survey's structure has changed since the last wave"
    raise_if_any(structure_diff(stored, new), problem, StructureMismatch, heading)
