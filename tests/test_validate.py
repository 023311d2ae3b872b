from dataclasses import replace

import pytest
from surveys import PAGE_TIMES, ROWS, raw_frame, raw_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavebook.operators import contract as contracts
from wavebook.operators.clean import clean_responses
from wavebook.operators.contract import compile_contract, contract_rows
from wavebook.operators.validate import (
    ValidationError,
    metadata_report,
    require_no_failures,
    validation_report,
)
from wavebook.schemas import METADATA, SurveyColumn, spark_type, type_name


def failures(table, contract):
    report = validation_report(table, contract).where("failures > 0").collect()
    return {(r.column_name, r.check): r.failures for r in report}


def test_fixture_is_valid(spark, contract):
    cleaned = clean_responses(raw_frame(spark, ROWS), contract)
    assert failures(cleaned, contract) == {}
    require_no_failures(validation_report(cleaned, contract), "the wave")


def test_every_failure_is_reported_at_once(spark, contract):
    rows = [
        raw_row(1, V7="5", V1="8"),
        raw_row(2, V7="0", V1="-1", vFINISHED="x", vDATE=None),
        raw_row(3, V1=""),
    ]
    cleaned = clean_responses(raw_frame(spark, rows), contract)
    expected = {
        ("Q4_uebersichtlich", "in_range"): 2,
        ("Q1", "in_range"): 2,
        ("finished", "not_null"): 1,
        ("date", "not_null"): 1,
    }
    assert failures(cleaned, contract) == expected
    with pytest.raises(ValidationError) as error:
        require_no_failures(validation_report(cleaned, contract), "the wave")
    assert all(column in str(error.value) for column, _ in expected)


def test_missing_column_and_wrong_type(spark, contract):
    cleaned = clean_responses(raw_frame(spark, ROWS), contract)
    broken = cleaned.drop("pagetime3").withColumn("Q3", F.col("Q3").cast("string"))
    assert failures(broken, contract) == {
        ("pagetime3", "column_present"): 1,
        ("Q3", "type"): 1,
    }


def test_allowed_values(spark, contract):
    cleaned = clean_responses(raw_frame(spark, ROWS), contract)
    other = cleaned.withColumn("Q5", F.when(F.col("id") != 1, F.lit("Schiff")))
    assert failures(other, contract) == {("Q5", "allowed_values"): 3}


def test_allowed_values_of_a_long_code_book(spark, metadata, monkeypatch):
    """Another table than our own cleaned one, so nothing has removed the bad values."""
    monkeypatch.setattr(contracts, "LONG_CODE_BOOK", 2)
    long = [c for c in compile_contract(metadata, "demo", PAGE_TIMES) if c.name == "Q5"]
    table = spark.createDataFrame([("Auto",), ("bad",), (None,), ("bad",), ("Fahrrad",), (" Auto",)], "Q5 string")
    report = validation_report(table, long, metadata, "demo").where("failures > 0").collect()
    assert [(r.column_name, r.check, r.failures) for r in report] == [("Q5", "allowed_values", 3)]
    assert validation_report(table.limit(0), long, metadata, "demo").where("failures > 0").count() == 0
    with pytest.raises(ValueError, match="long code book"):
        validation_report(table, long)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=20),
    st.one_of(st.none(), st.integers(-2, 2)),
    st.one_of(st.none(), st.integers(-2, 2)),
)
def test_range_against_a_model(spark, values, low, high):
    frame = spark.createDataFrame([(v,) for v in values], "x bigint")
    column = SurveyColumn("x", "V1", "Int64", minimum=low, maximum=high)
    outside = sum(
        v is not None and ((low is not None and v < low) or (high is not None and v > high))
        for v in values
    )
    assert failures(frame, [column]).get(("x", "in_range"), 0) == outside


def test_contract(metadata, contract):
    by_name = {column.name: column for column in contract}
    assert by_name["Q5"].labels == ("Fahrrad", "Bus und Bahn", "Auto")
    assert (by_name["Q1"].minimum, by_name["Q1"].maximum) == (1.0, 7.0)
    assert not by_name["id"].nullable and by_name["Q6"].nullable
    assert sum(not column.nullable for column in contract) == 13
    rows = {r.column_name: r for r in contract_rows(metadata).collect()}
    assert rows["Q5"].checks == ["allowed_values"] and rows["Q1"].checks == ["in_range"]
    assert rows["Q6"].checks == []


def test_labels_in_order_of_first_appearance(metadata):
    doubled = metadata.where("id = 'Q5'").withColumn(
        "possible_values_labels", F.array(*[F.lit(x) for x in ("B", "A", "B", "C", "A")])
    )
    assert contract_rows(doubled).first().allowed == ["B", "A", "C"]


def test_no_metadata(metadata):
    with pytest.raises(ValueError, match="nothing"):
        compile_contract(metadata, "nothing", PAGE_TIMES)


def test_unknown_type_name(metadata):
    odd = metadata.withColumn("schema_variable_type", F.lit("Decimal"))
    with pytest.raises(ValueError, match="Decimal"):
        compile_contract(odd, "demo", PAGE_TIMES)


def test_metadata_report(metadata):
    assert metadata_report(metadata).where("failures > 0").count() == 0
    broken = (
        metadata.withColumn("question_text", F.when(F.col("question_id") > 2, F.col("question_text")))
        .withColumn("id", F.col("original_id"))
        .drop("label")
    )
    found = {
        (r.column_name, r.check): r.failures
        for r in metadata_report(broken).where("failures > 0").collect()
    }
    assert found == {
        ("question_text", "not_null"): 5,
        ("id", "no_raw_name"): 18,
        ("label", "column_present"): 1,
    }


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Int64", T.LongType()),
        ("Int32", T.IntegerType()),
        ("Float64", T.DoubleType()),
        ("Float32", T.FloatType()),
        ("String", T.StringType()),
        ("Boolean", T.BooleanType()),
        ("Date", T.DateType()),
        ("Datetime", T.TimestampNTZType()),
        ("List(String)", T.ArrayType(T.StringType())),
        ("List(List(Int64))", T.ArrayType(T.ArrayType(T.LongType()))),
        ("Enum(['a', 'b'])", T.StringType()),
        ("List(Enum(['a']))", T.ArrayType(T.StringType())),
    ],
)
def test_type_names(name, expected):
    assert spark_type(name) == expected


def test_type_names_round_trip():
    for field in METADATA.fields:
        assert spark_type(type_name(field.dataType)) == field.dataType
    for unknown in ("Decimal", "List(Decimal)", "", "int"):
        with pytest.raises(ValueError):
            spark_type(unknown)
    with pytest.raises(ValueError):
        type_name(T.BinaryType())


def test_metadata_has_the_documented_columns(metadata):
    types = {field.name: field.dataType.simpleString() for field in METADATA.fields}
    assert dict(metadata.dtypes) == types


def test_hundreds_of_columns(spark):
    columns = [
        SurveyColumn(f"c{n}", f"V{n}", "Int64", nullable=False, minimum=0.0, maximum=5.0)
        for n in range(400)
    ]
    frame = spark.range(10).select(*[(F.col("id") + 0).alias(c.name) for c in columns])
    found = failures(frame, [*columns[:-1], replace(columns[-1], maximum=8.0)])
    assert len(found) == 400 and found[("c0", "in_range")] == 4
    assert found[("c399", "in_range")] == 1
