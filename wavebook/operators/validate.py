"""Every check of a contract in one pass, reported together."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wavebook.operators.clean import quoted
from wavebook.operators.naming import raw_names_left
from wavebook.schemas import METADATA, SurveyColumn


class ValidationError(ValueError):
    """A table breaks its contract; the message lists every broken check."""


#: Column name, check name and the condition under which a row fails; a plain True or
#: False where the schema alone decides.
Check = tuple[str, str, Column | bool]

REPORT = "column_name string, check string, failures bigint"


def contract_checks(table: DataFrame, contract: list[SurveyColumn]) -> list[Check]:
    """(column, check, rows failing as a condition) for every check of the contract.

    Allowed values of long code books are not among them, see :func:`long_book_report`.
    """
    types = {field.name: field.dataType for field in table.schema.fields}
    checks: list[Check] = []
    for column in contract:
        missing = column.name not in types
        checks.append((column.name, "column_present", missing))
        if missing:
            continue
        wrong = types[column.name] != column.data_type
        checks.append((column.name, "type", wrong))
        if not column.nullable:
            checks.append((column.name, "not_null", quoted(column.name).isNull()))
        if wrong:
            continue
        value = quoted(column.name)
        if column.labels and not column.long_code_book:
            checks.append((column.name, "allowed_values", ~value.isin(list(column.labels))))
        if column.minimum is not None or column.maximum is not None:
            checks.append((column.name, "in_range", _outside(value, column)))
    return checks


def _outside(value: Column, column: SurveyColumn) -> Column:
    below = F.lit(False) if column.minimum is None else value < column.minimum
    above = F.lit(False) if column.maximum is None else value > column.maximum
    return below | above


def schema_report(table: DataFrame, checks: list[Check]) -> DataFrame:
    """The checks that the schema alone decides; a failure counts once, no row is read."""
    decided = [(name, check, int(failing)) for name, check, failing in checks if isinstance(failing, bool)]
    return table.sparkSession.createDataFrame(decided, REPORT)


class WatchedRows:
    """Rows whose checks are counted by the very job that writes them.

    ``rows`` are the table's, to be written once and as they are. The counts come from the
    tasks that write, of which Spark counts one attempt each: a task that fails and runs
    again, or runs twice at a time, adds nothing twice.
    """

    def __init__(self, table: DataFrame, checks: list[Check]):
        self._checks = checks
        self._asked = [(name, check, failing) for name, check, failing in checks if not isinstance(failing, bool)]
        self._seen = Observation(f"checks-{uuid.uuid4().hex}")
        counts = [F.count_if(failing).alias(f"check_{n}") for n, (*_, failing) in enumerate(self._asked)]
        self.rows = table.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def report(self, stored: DataFrame) -> DataFrame:
        """The report of :func:`row_report` and :func:`schema_report` without a scan.

        ``stored`` are the rows as written; only their number is read, from the footers. An empty
        table is not watched by Spark and has no failures. Should the numbers differ, as after a
        job that was repeated as a whole, the stored rows are scanned.
        """
        count = stored.count()
        seen = self._seen.get if count else {"rows": 0}
        if seen["rows"] != count:
            return schema_report(stored, self._checks).unionByName(row_report(stored, self._checks))
        told = [(name, check, seen.get(f"check_{n}", 0)) for n, (name, check, _) in enumerate(self._asked)]
        counted = stored.sparkSession.createDataFrame(told, REPORT)
        return schema_report(stored, self._checks).unionByName(counted)


def row_report(table: DataFrame, checks: list[Check]) -> DataFrame:
    """(column_name, check, failures) for the checks of rows, from one scan.

    Each row gives the numbers of the checks it fails, usually none, and those are
    counted before and after the shuffle. So the work follows the failures and not the
    number of checks, and the plan stays small for tables of many hundred columns.
    """
    asked = [(name, check, failing) for name, check, failing in checks if not isinstance(failing, bool)]
    listed = table.sparkSession.createDataFrame(
        [(n, name, check) for n, (name, check, _) in enumerate(asked)],
        "number int, column_name string, check string",
    )
    if not asked:
        return listed.select("column_name", "check", F.lit(0).cast("bigint").alias("failures"))
    numbers = F.array_compact(F.array(*[F.when(failing, F.lit(n)) for n, (*_, failing) in enumerate(asked)]))
    counts = (
        # outer, and then dropping the nulls, so that the array is not built a second time
        # by a test of its size
        table.select(F.explode_outer(numbers).alias("number"))
        .where("number is not null")
        .groupBy("number")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # one count per check at most: that bounds what is broadcast
    return listed.join(F.broadcast(counts), "number", "left").select(
        "column_name", "check", F.coalesce("count", F.lit(0)).cast("bigint").alias("failures")
    )


def long_book_report(
    table: DataFrame, contract: list[SurveyColumn], metadata: DataFrame, survey_id: str
) -> DataFrame:
    """The allowed values of all long code books, from one scan.

    Values are counted per column before the shuffle, so a value that most rows have is one
    row of the anti join with the labels. No value and no label comes to the driver.
    """
    columns = [c.name for c in contract if c.long_code_book and c.name in table.columns]
    listed = table.sparkSession.createDataFrame([(name,) for name in columns], "column_name string")
    pairs = [F.struct(F.lit(n).alias("column_name"), quoted(n).cast("string").alias("value")) for n in columns]
    used = (
        table.select(F.inline(F.array(*pairs)))
        .where("value is not null")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    labels = metadata.where((F.col("survey_id") == survey_id) & F.col("id").isin(columns)).select(
        F.col("id").alias("column_name"), F.explode("possible_values_labels").alias("value")
    )
    unknown = used.join(labels.where("value <> ''").distinct().hint("merge"), ["column_name", "value"], "left_anti")
    failures = unknown.groupBy("column_name").agg(F.sum("count").alias("failures"))
    # one row per column at most: that bounds what is broadcast
    return listed.join(F.broadcast(failures), "column_name", "left").select(
        "column_name",
        F.lit("allowed_values").alias("check"),
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
    )


def validation_report(
    table: DataFrame,
    contract: list[SurveyColumn],
    metadata: DataFrame | None = None,
    survey_id: str | None = None,
) -> DataFrame:
    """(column_name, check, failures) for every check of the contract.

    A missing column and a wrong type are one failure each, whatever the number of rows;
    all other failures are rows. ``metadata`` and ``survey_id`` are needed when the contract has a long code book.
    """
    checks = contract_checks(table, contract)
    report = schema_report(table, checks).unionByName(row_report(table, checks))
    return _with_long_books(report, table, contract, metadata, survey_id)


def written_report(
    watched: WatchedRows,
    stored: DataFrame,
    contract: list[SurveyColumn],
    metadata: DataFrame | None = None,
    survey_id: str | None = None,
) -> DataFrame:
    """:func:`validation_report` of rows that were watched while they were written.

    Only columns with a long code book are read again, as their values are joined.
    """
    return _with_long_books(watched.report(stored), stored, contract, metadata, survey_id)


def _with_long_books(report, table, contract, metadata, survey_id) -> DataFrame:
    if not any(column.long_code_book for column in contract):
        return report
    if metadata is None or survey_id is None:
        raise ValueError("the contract has a long code book: pass metadata and survey_id")
    return report.unionByName(long_book_report(table, contract, metadata, survey_id))


def metadata_report(metadata: DataFrame) -> DataFrame:
    """The same report for the metadata table, over all surveys at once."""
    types = {field.name: field.dataType for field in metadata.schema.fields}
    checks: list[Check] = []
    for field in METADATA.fields:
        missing = field.name not in types
        checks.append((field.name, "column_present", missing))
        if missing:
            continue
        checks.append((field.name, "type", not _same_type(types[field.name], field.dataType)))
        if not field.nullable:
            checks.append((field.name, "not_null", F.col(field.name).isNull()))
    if "id" in types:
        checks.append(("id", "no_raw_name", raw_names_left()))
    return schema_report(metadata, checks).unionByName(row_report(metadata, checks))


def _same_type(found, wanted) -> bool:
    return found.simpleString() == wanted.simpleString()


def require_no_failures(report: DataFrame, what: str) -> None:
    """Raise with all broken checks; a report has one row per check, not per response."""
    broken = report.where(F.col("failures") > 0).collect()
    if broken:
        lines = [f"{row.column_name}: {row.check} fails for {row.failures} rows" for row in broken]
        raise ValidationError(f"{what} breaks its contract\n" + "\n".join(lines))
