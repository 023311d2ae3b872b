"""Checks counted while rows are written, against a scan of the written rows."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from surveys import ROWS, raw_frame, raw_row

from wavebook.operators import validate
from wavebook.operators.clean import clean_responses
from wavebook.session import staged

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def watched_report(table, contract):
    watched = validate.WatchedRows(table, validate.contract_checks(table, contract))
    stored = staged(watched.rows, "checked")
    return validate.written_report(watched, stored, contract), stored


def rows_of(report):
    return sorted(map(tuple, report.collect()))


@pytest.mark.parametrize("rows", [ROWS, [raw_row(1, V7="5", V1="8"), raw_row(2, V7="0", vDATE=None), raw_row(3, V1="")]])
def test_equals_a_scan(spark, contract, rows):
    table = clean_responses(raw_frame(spark, rows * 7), contract)
    report, stored = watched_report(table, contract)
    assert rows_of(report) == rows_of(validate.validation_report(stored, contract))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_empty_and_incomplete_tables(spark, contract):
    table = clean_responses(raw_frame(spark, ROWS), contract)
    for some in (table.limit(0), table.where("id < 0"), table.drop("Q1"), table.withColumn("Q1", F.lit("x"))):
        report, stored = watched_report(some, contract)
        assert rows_of(report) == rows_of(validate.validation_report(stored, contract))


def test_rows_written_otherwise_are_scanned(spark, contract):
    table = clean_responses(raw_frame(spark, ROWS), contract)
    watched = validate.WatchedRows(table, validate.contract_checks(table, contract))
    staged(watched.rows, "checked")
    more = staged(table.union(table), "checked")
    got = validate.written_report(watched, more, contract)
    assert rows_of(got) == rows_of(validate.validation_report(more, contract))


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from wavebook.operators import validate
from wavebook.schemas import SurveyColumn
from wavebook.session import staged

spark = (SparkSession.builder.master("local[3,4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())

def failing_once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2:
        raise RuntimeError("lost on purpose")

rows = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("Q"))
rows = rows.mapInArrow(failing_once, "Q long")
column = SurveyColumn("Q", "V1", "Int64", nullable=False, minimum=0, maximum=8)
watched = validate.WatchedRows(rows, validate.contract_checks(rows, [column]))
stored = staged(watched.rows, "checked")
seen = watched._seen.get["rows"]
print("SEEN", seen, sorted((r.check, r.failures) for r in watched.report(stored).collect()))
"""


def test_a_task_that_runs_again_counts_once(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=240
    )
    line = next((x for x in done.stdout.splitlines() if x.startswith("SEEN")), done.stderr[-2000:])
    assert line == "SEEN 30000 [('column_present', 0), ('in_range', 2000), ('not_null', 10000), ('type', 0)]"
    assert "lost on purpose" in done.stderr
