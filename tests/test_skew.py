"""One key holding a third of all rows and more: results stay whole, work is split."""

import pytest
from pyspark.sql import functions as F

from wavebook.functions import joins
from wavebook.operators import analytics, clean, dictionary, flatten
from wavebook.operators.dictionary import dictionary_frame, dictionary_lines

LOW_LIMITS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def low_limits(spark):
    before = {name: spark.conf.get(name, None) for name in LOW_LIMITS}
    for name, value in LOW_LIMITS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot(key):
    """Two thirds of the rows share key 7, the rest is spread."""
    return F.when(key % 3 < 2, F.lit(7)).otherwise(key % 1000)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_question_with_most_of_the_variables(spark, low_limits):
    variables = spark.range(0, 30_000, 1, 4).select(
        F.lit("s").alias("survey_id"),
        hot(F.col("id")).alias("question_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
    )
    texts = spark.range(1000).select(
        F.lit("s").alias("survey_id"),
        F.col("id").alias("question_id"),
        F.concat(F.lit("Frage "), "id").alias("text"),
    )
    joined = flatten.join_question_text(variables, texts)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 30_000
    assert joined.where("question_text = 'Frage 7'").count() == variables.where("question_id = 7").count()


def test_code_given_by_most_participants(spark, low_limits, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    book = spark.range(1000).select(
        F.lit("s").alias("survey_id"),
        F.lit("Q1").alias("id"),
        F.array(F.col("id").cast("string")).alias("possible_values_codes"),
        F.array(F.concat(F.lit("Ort "), "id")).alias("possible_values_labels"),
    )
    raw = spark.range(0, 30_000, 1, 4).select(
        "id",
        hot(F.col("id")).cast("string").alias("Q1"),
        F.sha2(F.col("id").cast("string"), 512).alias("note"),
    )
    decoded = clean.decode_from_table(raw, "Q1", "s", book)
    assert "SortMergeJoin" in final_plan(decoded)
    assert decoded.where("Q1 = 'Ort 7'").count() == raw.where("Q1 = '7'").count()
    assert decoded.count() == 30_000


def test_hot_keys_are_few_and_stay_out_of_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    keys = hot(F.col("id")).cast("string")
    rows = spark.range(0, 32_000, 1, 4).select(
        "id", F.when(F.col("id") % 8 > 0, keys).alias("key"), F.lit("x").alias("_hot")
    )
    lookup = spark.range(500).select(
        F.col("id").cast("string").alias("key"), F.concat(F.lit("Ort "), "id").alias("label")
    )
    found = joins.hot_keys(rows, ["key"]).collect()
    assert {row.key for row in found} >= {"7", None} and len(found) <= 1 / joins.HOT_SHARE
    joined = joins.lookup_left(rows, lookup, ["key"])
    assert joined.columns == ["key", "id", "_hot", "label"]
    plain = rows.join(lookup, ["key"], "left")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


def test_dictionary_of_a_survey_that_is_mostly_one_question(
    spark, low_limits, metadata, monkeypatch, tmp_path
):
    (like,) = metadata.where("id = 'Q1'").collect()
    many = (
        spark.range(0, 6_000, 1, 4)
        .select(
            *[
                F.lit(like[name]).cast(kind).alias(name)
                for name, kind in metadata.dtypes
                if name not in ("id", "question_id", "variable_position", "label")
            ],
            F.concat(F.lit("Q1_"), F.sha2(F.col("id").cast("string"), 256)).alias("id"),
            hot(F.col("id")).alias("question_id"),
            F.col("id").alias("variable_position"),
            F.sha2(F.col("id").cast("string"), 512).alias("label"),
        )
    )
    path = str(tmp_path / "metadata")
    many.withColumn("survey_id", F.concat(F.lit("s"), F.col("question_id") % 3)).write.parquet(path)
    monkeypatch.setattr(dictionary, "BUCKET", 500)
    stored = spark.read.parquet(path)
    lines = dictionary_lines(dictionary_frame(stored))
    assert "Broadcast" not in final_plan(lines)
    buckets = dictionary.in_buckets(dictionary_frame(stored)).groupBy("Survey Id", "Question Id", "bucket")
    assert buckets.count().agg(F.max("count")).first()[0] <= 500
    assert lines.where("line like '| Q1_%'").count() == 6_000
    questions = many.select("question_id").distinct().count()
    assert lines.where("line like '### Q%'").count() == questions


def test_frequency_of_free_text_next_to_a_hot_answer(spark):
    frame = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 < 2, F.lit("ja")).otherwise(F.col("id").cast("string")).alias("x")
    )
    found = analytics.frequency_distribution(frame, "x").limit(2).collect()
    assert (found[0].response, found[0]["count"], found[0].percentage) == ("ja", 20_000, 66.67)
    together = analytics.frequency_all_variables(frame, ["x"])
    assert together.count() == 10_001 and together.where("response = 'ja'").first()["count"] == 20_000
