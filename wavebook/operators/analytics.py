"""The canned questions asked of a stored survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.operators.clean import quoted
from wavebook.schemas import WAVE_COLUMN

AGGREGATIONS = {
    "AVG": F.avg,
    "SUM": F.sum,
    "MIN": F.min,
    "MAX": F.max,
    "COUNT": F.count,
    "STDDEV": F.stddev_samp,
    "VARIANCE": F.var_samp,
}


def percentage() -> Column:
    """Share of ``count`` in ``total`` in percent, rounded half up to two decimals.

    Whole-number arithmetic, so the rounding is exact and the same on every engine.
    """
    return F.expr("((`count` * 20000 + `total`) div (2 * `total`)) / 100.0D")


def frequency_distribution(
    results: DataFrame, variable: str, include_nulls: bool = False
) -> DataFrame:
    """Count and share of every value, most frequent first.

    The total is a scalar subquery over the same counts, that is one number put into the
    plan: no window over all groups, which for free text would be as many rows as there
    are responses, and no join. Both read the same shuffled counts, so the answers are
    scanned once.
    """
    answers = results.select(quoted(variable).alias("response"))
    if not include_nulls:
        answers = answers.where("response is not null")
    counts = answers.groupBy("response").agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.withColumn("total", counts.select(F.sum("count")).scalar())
        .withColumn("percentage", percentage())
        .drop("total")
        .orderBy(F.desc("count"), F.asc_nulls_last("response"))
    )


def wave_trend(results: DataFrame, variable: str, aggregation: str = "AVG") -> DataFrame:
    """One aggregate of a variable per wave; the column is ``avg_value`` for all of them."""
    function = AGGREGATIONS.get(aggregation.upper())
    if function is None:
        raise ValueError(f"aggregation must be one of {', '.join(AGGREGATIONS)}")
    value = quoted(variable)
    return (
        results.where(value.isNotNull())
        .groupBy(F.col(WAVE_COLUMN).alias("wave"))
        .agg(
            function(value.cast("double")).alias("avg_value"),
            F.count(value).alias("response_count"),
        )
        .orderBy("wave")
    )


def item_distribution(results: DataFrame, variable: str) -> DataFrame:
    """How often each score was given, by score."""
    return (
        results.select(quoted(variable).alias("score"))
        .where("score is not null")
        .groupBy("score")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .orderBy("score")
    )


def long_answers(results: DataFrame, variables: list[str], keep: list[str] = ()) -> DataFrame:
    """(variable, value) rows as text, null answers left out."""
    texts = [quoted(name).cast("string").alias(name) for name in variables]
    return (
        results.select(*[quoted(name) for name in keep], *texts)
        .unpivot(list(keep), [quoted(name) for name in variables], "variable", "value")
        .where("value is not null")
    )


def frequency_all_variables(results: DataFrame, variables: list[str]) -> DataFrame:
    """The frequency distribution of every variable of a survey in one pass.

    Values are counted before the shuffle. The totals have one row per column of the
    table, which bounds what is broadcast; so the many values of one free-text variable
    never meet in a single task.
    """
    counts = (
        long_answers(results, variables)
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.groupBy("variable").agg(F.sum("count").alias("total"))
    return (
        counts.join(F.broadcast(totals), "variable", "left")
        .withColumn("percentage", percentage())
        .select("variable", F.col("value").alias("response"), "count", "percentage")
    )


def trend_all_variables(
    results: DataFrame, variables: list[str], aggregation: str = "AVG"
) -> DataFrame:
    """The wave trend of many numeric variables in one pass, combined before the shuffle."""
    function = AGGREGATIONS.get(aggregation.upper())
    if function is None:
        raise ValueError(f"aggregation must be one of {', '.join(AGGREGATIONS)}")
    numbers = [quoted(name).cast("double").alias(name) for name in variables]
    return (
        results.select(F.col(WAVE_COLUMN).alias("wave"), *numbers)
        .unpivot(["wave"], [quoted(name) for name in variables], "variable", "value")
        .where("value is not null")
        .groupBy("variable", "wave")
        .agg(function("value").alias("avg_value"), F.count("value").alias("response_count"))
    )


# ---------------------------------------------------------------- metadata


def question_metadata(metadata: DataFrame, question_id: int) -> DataFrame:
    """Everything known about the variables of one question."""
    return (
        metadata.where(F.col("question_id") == question_id)
        .orderBy("question_position", "group_id", "survey_id", "variable_position")
        .select(
            F.col("id").alias("variable_name"),
            F.col("label").alias("variable_label"),
            "question_text",
            "question_type",
            "possible_values_labels",
            "scale_labels",
            "range_min",
            "range_max",
        )
    )


def matrix_metadata(metadata: DataFrame, question_type: str = "matrix") -> DataFrame:
    """Items, headings and bounds of all questions of a type."""
    return (
        metadata.where(F.col("question_type") == question_type)
        .orderBy("question_id", "group_id", "survey_id", "variable_position")
        .select(
            F.col("id").alias("variable_name"),
            F.col("label").alias("item_label"),
            "question_text",
            "scale_labels",
            "range_min",
            "range_max",
        )
    )


def find_variables(metadata: DataFrame, question_type: str, limit: int = 1) -> DataFrame:
    """The first variables of a type, in survey order; the limit is the feature."""
    return (
        metadata.where(F.col("question_type") == question_type)
        .orderBy("survey_id", "question_position", "group_id", "variable_position")
        .limit(limit)
        .select("id", "question_text", "possible_values_labels")
    )


def count_questions(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("survey_id").agg(
        F.countDistinct("question_id").alias("question_count")
    )
