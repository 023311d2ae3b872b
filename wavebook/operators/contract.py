"""From the metadata table to the contract of one survey's response table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.operators.flatten import MATRIX, SCALE, SINGLE_CHOICE
from wavebook.schemas import SurveyColumn, spark_type, system_columns

#: Code books up to this size become part of an expression; longer ones are joined.
LONG_CODE_BOOK = 200


def contract_rows(metadata: DataFrame) -> DataFrame:
    """What every variable of every survey must look like, one row per variable.

    ``checks`` lists the checks in words; ``allowed`` holds the labels without repeats,
    in order of first appearance.
    """
    labels = F.array_distinct("possible_values_labels")
    chosen = (F.col("question_type") == SINGLE_CHOICE) & (F.array_size(labels) > 0)
    ranged = F.col("question_type").isin(SCALE, MATRIX)
    low = F.when(ranged, F.col("range_min"))
    high = F.when(ranged, F.col("range_max"))
    is_enum = F.coalesce(chosen, F.lit(False))
    checks: Column = F.array_compact(
        F.array(
            F.when(is_enum, F.lit("allowed_values")),
            F.when(low.isNotNull() | high.isNotNull(), F.lit("in_range")),
        )
    )
    return metadata.select(
        "survey_id",
        F.col("id").alias("column_name"),
        F.col("original_id").alias("raw_name"),
        F.when(is_enum, F.lit("Enum")).otherwise(F.col("schema_variable_type")).alias("type_name"),
        F.lit(True).alias("nullable"),
        F.when(is_enum, F.col("possible_values_codes")).alias("codes"),
        F.when(is_enum, F.col("possible_values_labels")).alias("labels"),
        F.when(is_enum, labels).alias("allowed"),
        low.alias("minimum"),
        high.alias("maximum"),
        checks.alias("checks"),
    )


def compile_contract(metadata: DataFrame, survey_id: str, page_times: int) -> list[SurveyColumn]:
    """The contract of one survey, survey columns first, then the system columns.

    Only column names, types and short code books come to the driver, where they turn
    into expressions; long code books stay in the metadata table. ``page_times`` is the
    number of timed pages, see :func:`wavebook.operators.clean.page_times`.
    """
    short = F.array_size("codes") <= LONG_CODE_BOOK
    rows = (
        contract_rows(metadata.where(F.col("survey_id") == survey_id))
        .select(
            "column_name",
            "raw_name",
            "type_name",
            F.when(short, F.col("codes")).alias("codes"),
            F.when(short, F.col("labels")).alias("labels"),
            F.coalesce(~short, F.lit(False)).alias("long"),
            "minimum",
            "maximum",
        )
        .collect()
    )
    if not rows:
        raise ValueError(f"no metadata for survey {survey_id}")
    columns = [
        SurveyColumn(
            name=row.column_name,
            raw_name=row.raw_name,
            type_name="String" if row.type_name == "Enum" else row.type_name,
            codes=tuple(row.codes or ()),
            labels=tuple(row.labels or ()),
            long_code_book=row.long,
            minimum=row.minimum,
            maximum=row.maximum,
        )
        for row in rows
    ]
    for column in columns:
        spark_type(column.type_name)
    return columns + system_columns(page_times)
