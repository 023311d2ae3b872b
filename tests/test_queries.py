"""Registered queries against their SQL; the rest of them runs with tools/compare.py."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402

from wavebook.plans.queries import REGISTRY  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ALL = list(REGISTRY)
QUICK = [
    "read_responses",
    "clean_responses",
    "flatten_questions",
    "name_multi",
    "decode_long_code_book",
    "frequency_distribution",
    "frequency_all_variables",
    "wave_trend",
    "structure_diff_copies",
    "dictionary_sections_long",
    "validate_collect_all",
    "write_wave",
]

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", ALL if os.environ.get("WAVEBOOK_ALL_QUERIES") else QUICK)
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.difference(spark, connection, FOLDER, name) is None


def test_every_query_has_sql():
    """All queries over the survey operators; others are tested against brute force."""
    assert set(ALL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@needs_data
def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["response", "count", "percentage"] and frame.count() == 5


SPREAD = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plan(frame):
    return frame._jdf.queryExecution().sparkPlan().toString()


@needs_data
@pytest.mark.parametrize("name", [n for n in ALL if "wave" not in n and not n.startswith("write")])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    found = plan(entry_points.queries()[name](spark, FOLDER))
    assert not [node for node in SPREAD if node in found]
    assert "Window" not in found.replace("WindowGroupLimit", "")


@needs_data
@pytest.mark.parametrize(
    "name",
    ["clean_responses", "flatten_questions", "name_multi", "page_number", "question_violations"],
)
def test_no_operator_shuffles(spark, name):
    """The one exchange allowed hands out the rows of a scan with too few splits."""
    frame = entry_points.queries()[name](spark, FOLDER)
    found = frame._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in found
    assert found.count("Exchange") == found.count("REPARTITION_BY_NUM")


@needs_data
def test_columns_and_filters_reach_the_scan(spark):
    frame = entry_points.queries()["frequency_distribution_flag"](spark, FOLDER)
    found = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string>" in found
    assert "IsNotNull(l_returnflag)" in found


@needs_data
def test_the_counts_of_a_frequency_are_scanned_once(spark):
    frame = entry_points.queries()["frequency_distribution_flag"](spark, FOLDER)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


PARTS = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"


@pytest.mark.parametrize("name", ["structure_diff", "keep_original_id"])
def test_definitions_are_taken_apart_once(spark, tmp_path, name):
    """What is compared with, or joined to, a form of itself is stored first."""
    rows = [(n, f"Teil {n}", "Marke A", "STANDARD", n % 7) for n in (0, 1, 2, 20, 30, 50)]
    spark.createDataFrame([*rows, rows[1]], PARTS).write.parquet(str(tmp_path / "part.parquet"))
    found = REGISTRY[name](spark, str(tmp_path))
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    # 2 variables gone, 2 renamed and 2 of another type; 14 variables a definition, and of the
    # definition that comes twice each first variable of its 7 questions meets both names
    assert found.count() == {"structure_diff": 2 + 4 + 4, "keep_original_id": 7 * 14 + 2 * 7}[name]
