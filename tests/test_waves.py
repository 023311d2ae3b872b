import json
from pathlib import Path

import pytest
from surveys import QUESTIONS, ROWS, de, definition_frame, group, question, raw_frame, raw_row
from pyspark.sql import functions as F

from wavebook.operators import analytics
from wavebook.operators.structure import StructureMismatch, structure_diff
from wavebook.operators.validate import ValidationError
from wavebook.plans.canned import ask
from wavebook.plans.pipeline import build_dictionary, checked_metadata, load_wave
from wavebook.sources.tables import SurveyTables, TableMissing, next_wave, read_table


@pytest.fixture
def demo(spark, tmp_path):
    """Tables of a survey of its own; the file path tells it apart."""
    survey = f"demo_{abs(hash(str(tmp_path)))}"
    return SurveyTables(spark, survey, str(tmp_path / "tables"))


CHECKED = {}


def checked(spark, questions, survey):
    """Checked metadata, worked out once per definition."""
    key = json.dumps(questions)
    if key not in CHECKED:
        CHECKED[key] = checked_metadata(definition_frame(spark, questions))
    return CHECKED[key].withColumn("survey_id", F.lit(survey))


def load(spark, tables, questions=QUESTIONS, rows=ROWS):
    return load_wave(tables, checked(spark, questions, tables.survey_id), raw_frame(spark, rows))


def test_three_waves(spark, demo):
    assert demo.next_wave() == 0
    waves = [load(spark, demo) for _ in range(3)]
    assert waves == [0, 1, 2]
    results = demo.results()
    assert dict(results.dtypes)["load_counter"] == "bigint"
    assert results.count() == 12
    assert demo.metadata().count() == 18
    trend = analytics.wave_trend(results, "Q1").collect()
    assert [(r.wave, r.avg_value, r.response_count) for r in trend] == [
        (0, 5.0, 4), (1, 5.0, 4), (2, 5.0, 4),
    ]
    assert demo.next_wave() == 3


def test_a_wave_can_be_written_again_and_touches_no_other(spark, demo):
    for _ in range(3):
        load(spark, demo)
    again = demo.results().where("load_counter = 1 and id <> 3").drop("load_counter")
    path = demo.location + "/copy"
    again.write.parquet(path)
    demo.write_wave(spark.read.schema(again.schema).parquet(path), 1)
    counts = {r.load_counter: r["count"] for r in demo.results().groupBy("load_counter").count().collect()}
    assert counts == {0: 4, 1: 3, 2: 4}


def test_interrupted_first_load(spark, demo, metadata, contract):
    """Results without metadata do not count as a survey; the first load starts over."""
    from wavebook.operators.clean import clean_responses

    cleaned = clean_responses(raw_frame(spark, ROWS), contract)
    (
        cleaned.withColumn("load_counter", F.lit(0).cast("bigint"))
        .write.partitionBy("load_counter")
        .option("path", f"{demo.location}/{demo.results_name}")
        .saveAsTable(demo.results_name)
    )
    assert not demo.exists() and demo.next_wave() == 0
    assert load(spark, demo, rows=ROWS[:2]) == 0
    assert demo.results().count() == 2


def test_first_wave_needs_metadata_and_happens_once(spark, demo):
    with pytest.raises(ValueError, match="metadata"):
        demo.write_wave(spark.range(1), 0)
    load(spark, demo)
    with pytest.raises(ValueError, match="exists"):
        demo.write_wave(spark.range(1), 0, spark.range(1))


def test_tables_must_exist_to_be_read(demo):
    with pytest.raises(TableMissing):
        demo.results()


def test_survey_id_must_fit_a_table_name(spark):
    with pytest.raises(ValueError):
        SurveyTables(spark, "x; drop")


def test_next_wave_of_empty_tables(spark):
    empty = spark.createDataFrame([], "load_counter bigint")
    assert next_wave(empty).first().next_wave == 1
    assert next_wave(spark.createDataFrame([(4,), (2,)], "load_counter bigint")).first()[0] == 5


def without(questions, number):
    return [q for q in questions if q["id"] != number]


CHANGED = {
    "fewer": without(QUESTIONS, 1),
    "other name": [*without(QUESTIONS, 1), question(1, "SCALE", group(["V99"], span=[1, 7, 1]))],
    "other type": [
        *without(QUESTIONS, 1),
        question(1, "INPUT", group(["V1"], items=[{"id": "1"}], kind="INTEGER")),
    ],
    "more": [*QUESTIONS, question(10, "SCALE", group(["V18"], span=[0, 2, 1]), page=90)],
}


def test_changed_structure_stops_the_load(spark, demo):
    load(spark, demo)
    for questions in CHANGED.values():
        with pytest.raises(StructureMismatch):
            load(spark, demo, questions)
    assert demo.results().count() == 4


def test_reworded_label_keeps_the_stored_column(spark, demo):
    load(spark, demo)
    reworded = [
        question(
            2,
            "CHOICE",
            group(["V2", "V3", "V4", "V5"], labels=de("Krimis", "Comics", "Zeitungen", "Landkarten")),
            page=40,
        )
        if q["id"] == 2
        else q
        for q in QUESTIONS
    ]
    assert load(spark, demo, reworded) == 1
    assert "Q2_romane" in demo.results().columns
    assert demo.results().where("Q2_romane").count() == 4


def test_new_codes_are_decoded_by_the_new_definition(spark, demo):
    load(spark, demo)
    new = [dict(q) for q in QUESTIONS]
    new[4] = question(
        5,
        "CHOICE",
        group(["V9"], labels=de("zu Fuß", "Taxi"), codes=["a", "b"], items=[{"id": "1"}]),
        page=50,
    )
    load(spark, demo, new, [raw_row(1, V9="b")])
    assert demo.results().where("load_counter = 1").first().Q5 == "Taxi"


def test_invalid_wave_is_not_stored(spark, demo):
    load(spark, demo)
    with pytest.raises(ValidationError, match="Q1"):
        load(spark, demo, rows=[raw_row(1, V1="99")])
    assert demo.results().count() == 4 and demo.next_wave() == 1
    left = sorted(p.name for p in Path(demo.location, demo.results_name).glob("load_counter=*"))
    assert left == ["load_counter=0"]


def test_structure_diff_counts_copies(spark):
    schema = "survey_id string, original_id string, question_type string"
    stored = spark.createDataFrame([("s", "V1", "a")] * 3 + [("s", "V2", "b")], schema)
    new = spark.createDataFrame([("s", "V1", "a")] + [("s", "V2", "c")], schema)
    found = {
        (r.original_id, r.question_type, r.change, r.copies)
        for r in structure_diff(stored, new).collect()
    }
    assert found == {
        ("V1", "a", "missing", 2), ("V2", "b", "missing", 1), ("V2", "c", "added", 1),
    }
    assert structure_diff(stored, stored).count() == 0


def test_free_sql(spark, demo):
    load(spark, demo)
    rows = read_table(
        spark,
        f"select id, Q2_romane from {demo.results_name} where Q3 >= :visits order by id",
        visits=12,
    ).collect()
    assert [(r.id, r.Q2_romane) for r in rows] == [(1, True), (2, False), (4, False)]
    arrays = read_table(spark, f"select possible_values_labels from {demo.metadata_name} where id = 'Q5'")
    assert arrays.first()[0] == ["Fahrrad", "Bus und Bahn", "Auto"]


def test_next_wave_of_stored_tables(spark, demo):
    load(spark, demo)
    stored = demo.results().drop("load_counter")
    rows = stored.collect()
    demo.write_wave(spark.createDataFrame([], stored.schema), 5)
    assert demo.next_wave() == 1
    demo.write_wave(spark.createDataFrame(rows, stored.schema), 4)
    assert demo.next_wave() == 5


def test_canned_questions_and_dictionary(spark, demo, tmp_path):
    with pytest.raises(TableMissing):
        build_dictionary(demo, str(tmp_path / "docs"))
    load(spark, demo)
    assert ask(demo, "item_distribution", "Q1").count() == 3
    assert ask(demo, "wave_trend", "Q1", "MAX").first().avg_value == 6.0
    assert ask(demo, "question_metadata", 2).count() == 4
    assert ask(demo, "find_variables", "matrix", limit=2).count() == 2
    with pytest.raises(ValueError, match="wave_trend"):
        ask(demo, "drop_everything")
    build_dictionary(demo, str(tmp_path / "docs"))
    lines = spark.read.text(str(tmp_path / "docs" / "dictionary"))
    assert lines.where("value like '### Q%'").count() == 9
