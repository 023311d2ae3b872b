import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wavebook.operators import analytics

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=40), st.booleans())
def test_frequency_against_a_model(spark, values, nulls):
    frame = spark.createDataFrame([(v,) for v in values], "`my.col` string")
    found = analytics.frequency_distribution(frame, "my.col", include_nulls=nulls).collect()
    counted = [v for v in values if nulls or v is not None]
    expected = {
        v: (counted.count(v), (counted.count(v) * 20000 + len(counted)) // (2 * len(counted)) / 100)
        for v in set(counted)
    }
    assert {r.response: (r["count"], r.percentage) for r in found} == expected
    assert [r["count"] for r in found] == sorted((r["count"] for r in found), reverse=True)


def test_shares_are_rounded_half_up(spark):
    frame = spark.createDataFrame([("a",)] * 1 + [("b",)] * 799, "x string")
    found = {r.response: r.percentage for r in analytics.frequency_distribution(frame, "x").collect()}
    assert found == {"a": 0.13, "b": 99.88}


def test_wave_trend(spark):
    rows = [(0, "1"), (0, "3"), (0, None), (2, "5"), (1, None)]
    frame = spark.createDataFrame(rows, "load_counter bigint, score string")
    for name, expected in {
        "AVG": [2.0, 5.0], "sum": [4.0, 5.0], "MIN": [1.0, 5.0], "MAX": [3.0, 5.0],
        "COUNT": [2, 1], "VARIANCE": [2.0, None],
    }.items():
        found = analytics.wave_trend(frame, "score", name).collect()
        assert [(r.wave, r.response_count) for r in found] == [(0, 2), (2, 1)]
        assert [r.avg_value for r in found] == expected, name
    with pytest.raises(ValueError, match="AVG"):
        analytics.wave_trend(frame, "score", "drop table")


def test_item_distribution(spark):
    frame = spark.createDataFrame([(3,), (1,), (3,), (None,)], "x bigint")
    found = analytics.item_distribution(frame, "x").collect()
    assert [(r.score, r.frequency) for r in found] == [(1, 1), (3, 2)]


def test_all_variables_at_once_equal_one_at_a_time(spark):
    rows = [(0, "a", 1, True), (0, "b", 2, None), (1, "a", None, False), (1, None, 2, True)]
    frame = spark.createDataFrame(rows, "load_counter bigint, `x.y` string, n bigint, b boolean")
    together = {
        (r.variable, r.response, r["count"], r.percentage)
        for r in analytics.frequency_all_variables(frame, ["x.y", "n", "b"]).collect()
    }
    apart = {
        (name, str(r.response).lower() if name == "b" else str(r.response), r["count"], r.percentage)
        for name in ("x.y", "n", "b")
        for r in analytics.frequency_distribution(frame, name).collect()
    }
    assert together == apart
    trends = {
        (r.variable, r.wave, r.avg_value, r.response_count)
        for r in analytics.trend_all_variables(frame, ["n"]).collect()
    }
    assert trends == {("n", 0, 1.5, 2), ("n", 1, 2.0, 1)}


def test_question_metadata(metadata):
    rows = analytics.question_metadata(metadata, 7).collect()
    assert [r.variable_name for r in rows] == ["Q7_laerm", "Q7_kaelte", "Q7_other", "Q7_other_text"]
    assert rows[0].variable_label == "Lärm" and rows[0].question_type == "multiple_choice_other"
    (row,) = analytics.question_metadata(metadata, 5).collect()
    assert row.possible_values_labels[0] == "Fahrrad"


def test_matrix_metadata(metadata):
    rows = analytics.matrix_metadata(metadata).collect()
    assert [r.item_label for r in rows] == ["Regale übersichtlich", "Öffnungszeiten reichen"]
    assert rows[0].scale_labels == ["immer", "oft", "selten", "nie"]
    assert (rows[0].range_min, rows[0].range_max) == (1.0, 4.0)


def test_find_variables(metadata):
    assert [r.id for r in analytics.find_variables(metadata, "multiple_choice", 2).collect()] == [
        "Q2_romane", "Q2_comics",
    ]
    assert analytics.find_variables(metadata, "scale").first().id == "Q1"


def test_count_questions(metadata):
    assert analytics.count_questions(metadata).first().question_count == 9
