import datetime as dt

import pytest
from surveys import PAGE_TIMES, ROWS, raw_frame, raw_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavebook.functions import casting
from wavebook.operators import clean
from wavebook.operators import contract as contracts
from wavebook.operators.clean import clean_responses

TEXTS = st.one_of(
    st.none(),
    st.sampled_from(["", " ", "0", "1", "2", "\t1", "1 ", "x", "A", "B", " A ", "true", "1.0"]),
    st.text(max_size=4).filter(lambda t: all(0x20 <= ord(c) < 0xD800 for c in t)),
)
MODEL = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [row[1] for row in frame.select("i", expression(F.col("text"))).orderBy("i").collect()]


def test_fixture_row(spark, contract):
    row = clean_responses(raw_frame(spark, ROWS), contract).where("id = 1").first()
    assert row.completed is True and row.finished is True and row.duration == 301.25
    assert row.start == dt.datetime(2025, 5, 6, 8, 15) and row.date == dt.date(2025, 5, 6)
    assert (row.Q1, row.Q2_romane, row.Q2_comics, row.Q2_landkarten) == (5, True, False, False)
    assert (row.Q3, row.Q4_uebersichtlich, row.Q5, row.Q9) == (12, 2, "Bus und Bahn", "2.5")
    assert (row.Q7_other_text, row.Q8_ort, row.pagetime4) == ("", "Ulm", 35)


def test_final_types(spark, contract):
    cleaned = clean_responses(raw_frame(spark, ROWS), contract)
    types = dict(cleaned.dtypes)
    assert types["start"] == "timestamp_ntz" and types["date"] == "date"
    assert types["Q3"] == "bigint" and types["Q2_comics"] == "boolean" and types["Q5"] == "string"
    assert not {"vANONYM", "vLANG"} & set(types)


def test_incomplete_and_empty_rows(spark, contract):
    nothing = {name: "" for name in raw_row(0) if name.startswith("V")}
    rows = [
        raw_row(1),
        raw_row(2, vCOMPLETED="0"),
        raw_row(3, vCOMPLETED=None),
        raw_row(4, **nothing),
        raw_row(5, **{name: None for name in nothing}),
        raw_row(6, **{**nothing, "V10": " "}),
        raw_row(7, **{**nothing, "V13.1": "x"}),
    ]
    cleaned = clean_responses(raw_frame(spark, rows), contract)
    assert {r.id for r in cleaned.select("id").collect()} == {1, 6, 7}


def test_unknown_and_empty_codes(spark, contract):
    codes = ["a", "", None, "x", "Auto", " Auto", " a", "c"]
    rows = [raw_row(n, V9=code) for n, code in enumerate(codes)]
    cleaned = clean_responses(raw_frame(spark, rows), contract).orderBy("id")
    assert [r.Q5 for r in cleaned.collect()] == [
        "Fahrrad", None, None, None, "Auto", "Auto", None, "Auto",
    ]


def test_missing_column_cannot_be_dropped(spark, contract):
    with pytest.raises(ValueError, match="vLANG"):
        clean_responses(raw_frame(spark, ROWS).drop("vLANG"), contract)


def test_extra_columns_are_kept_and_absent_ones_skipped(spark, contract):
    raw = raw_frame(spark, ROWS).withColumn("note", F.lit("x")).drop("V1")
    names = clean_responses(raw, contract).columns
    assert "note" in names and "Q1" not in names


def test_clashing_names(spark, contract):
    with pytest.raises(ValueError, match="v1"):
        clean_responses(raw_frame(spark, ROWS).select("*", F.lit("x").alias("v1")), contract)
    with pytest.raises(ValueError, match="clash"):
        clean.rename_columns(raw_frame(spark, ROWS), {"V1": "id"})


def test_page_times_of_any_number(spark, metadata):
    raw = raw_frame(spark, ROWS).withColumn("vPAGETIME5", F.lit("7"))
    contract = contracts.compile_contract(metadata, "demo", page_times=5)
    assert clean_responses(raw, contract).first().pagetime5 == 7


@MODEL
@given(st.lists(TEXTS, min_size=1, max_size=30))
def test_boolean_against_a_model(spark, texts):
    expected = [True if t == "1" else False if t in ("0", "") else None for t in texts]
    assert column(spark, texts, casting.to_boolean) == expected


@MODEL
@given(st.lists(TEXTS, min_size=1, max_size=30))
def test_decode_and_enum_against_a_model(spark, texts):
    codes, labels = ["1", "2", "1"], ["A", "B ", "B"]

    def model(text):
        if text is None:
            return None
        decoded = {"1": "B", "2": "B "}.get(text, text).strip()
        return decoded if decoded in labels and decoded else None

    found = column(
        spark, texts, lambda c: casting.to_enum(casting.decode(c, codes, labels), labels)
    )
    assert found == [model(text) for text in texts]


@MODEL
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=20))
def test_integers_of_any_size(spark, numbers):
    texts = [f" {n} " for n in numbers] + ["", " ", None]
    assert column(spark, texts, lambda c: casting.to_integer(c, "x")) == numbers + [None] * 3


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "cast, bad",
    [
        (lambda c: casting.to_integer(c, "age"), "1.0"),
        (lambda c: casting.to_integer(c, "age"), "x"),
        (lambda c: casting.to_integer(c, "age"), "9223372036854775808"),
        (lambda c: casting.to_double(c, "age"), "1d"),
        (lambda c: casting.to_double(c, "age"), "1,5"),
        (lambda c: casting.to_double(c, "age"), "0x1p3"),
        (lambda c: casting.to_double(c, "age"), "1e"),
        (lambda c: casting.to_double(c, "age"), "."),
        (lambda c: casting.to_date(c, "age"), "2024-01-01 10:00:00"),
        (lambda c: casting.to_date(c, "age"), ""),
        (lambda c: casting.to_date(c, "age"), "2024-02-30"),
        (lambda c: casting.to_timestamp(c, "age"), "2024-01-01T10:00:00"),
        (lambda c: casting.to_timestamp(c, "age"), "2024-01-01"),
    ],
)
def test_bad_text_raises_and_names_the_column(spark, ansi, cast, bad):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="column age"):
            column(spark, [bad], cast)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_doubles(spark):
    texts = ["1.5", " 2 ", "1e3", "-0.5", "", None, "inf", "+2.", ".5E-1", "-Infinity", "NaN"]
    found = column(spark, texts, lambda c: casting.to_double(c, "x"))
    assert found[:-1] == [
        1.5, 2.0, 1000.0, -0.5, None, None, float("inf"), 2.0, 0.05, -float("inf"),
    ]
    assert found[-1] != found[-1]


def test_other_layouts(spark):
    assert column(spark, ["31.12.2024"], lambda c: casting.to_date(c, "x", "dd.MM.yyyy")) == [
        dt.date(2024, 12, 31)
    ]
    layout = "yyyy-MM-dd'T'HH:mm:ss"
    assert column(
        spark, ["2024-12-31T01:02:03"], lambda c: casting.to_timestamp(c, "x", layout)
    ) == [dt.datetime(2024, 12, 31, 1, 2, 3)]


def test_timestamp_in_a_gap_of_the_local_clock(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        text = "2024-03-31 02:30:00"
        found = column(spark, [text], lambda c: casting.to_timestamp(c, "x"))
        assert found == [dt.datetime(2024, 3, 31, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_code_book_gives_the_same_as_the_short_one(spark, metadata, monkeypatch):
    codes = ["a", "", None, "x", "Auto", " Auto", "c", "b"]
    raw = raw_frame(spark, [raw_row(n, V9=code) for n, code in enumerate(codes)])
    short = contracts.compile_contract(metadata, "demo", PAGE_TIMES)
    monkeypatch.setattr(contracts, "LONG_CODE_BOOK", 2)
    long = contracts.compile_contract(metadata, "demo", PAGE_TIMES)
    assert [c.long_code_book for c in long if c.name == "Q5"] == [True]
    with pytest.raises(ValueError, match="long code book"):
        clean_responses(raw, long)
    one = clean_responses(raw, short)
    other = clean_responses(raw, long, "demo", metadata)
    assert one.columns == other.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_decode_by_merge_join(spark, metadata, monkeypatch):
    from wavebook.functions import joins

    raw = spark.createDataFrame([("a",), ("b",), ("x",), (None,)], "Q5 string")
    small = clean.decode_from_table(raw, "Q5", "demo", metadata)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    large = clean.decode_from_table(raw, "Q5", "demo", metadata)
    plan = large._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
