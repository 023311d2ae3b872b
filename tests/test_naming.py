import re

import pytest
from surveys import QUESTIONS, de, definition_frame, group, item, question
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavebook.functions.text import naming_word, transliterate
from wavebook.operators.naming import (
    NamingError,
    duplicate_ids,
    raw_names_left,
    require_named,
    require_unique_names,
    use_names,
    variables_per_question,
)
from wavebook.plans.pipeline import checked_metadata, survey_metadata


def names(spark, *questions):
    rows = survey_metadata(definition_frame(spark, list(questions))).collect()
    return {row.original_id: row.id for row in rows}


def test_fixture_names(metadata):
    assert {row.original_id: row.id for row in metadata.collect()} == {
        "V1": "Q1",
        "V2": "Q2_romane",
        "V3": "Q2_comics",
        "V4": "Q2_zeitungen",
        "V5": "Q2_landkarten",
        "V6": "Q3",
        "V7": "Q4_uebersichtlich",
        "V8": "Q4_oeffnungszeiten",
        "V9": "Q5",
        "V10": "Q6",
        "V11": "Q7_laerm",
        "V12": "Q7_kaelte",
        "V13": "Q7_other",
        "V13.1": "Q7_other_text",
        "V14": "Q8_strasse",
        "V15": "Q8_ort",
        "V16": "Q8_land",
        "V17": "Q9",
    }


def test_repeated_words_get_distinct_names(spark):
    labels = de("Hund", "hund", "Der Hund", "Hundxxb", "123", "456", "Katze")
    found = names(spark, question(1, "CHOICE", group([f"V{n}" for n in range(7)], labels=labels)))
    assert len(set(found.values())) == 7
    assert found["V0"] == "Q1_hund" and found["V6"] == "Q1_katze"
    assert found["V3"] == "Q1_hundxb"
    assert all(re.fullmatch(r"Q1_[a-z]+", name) for name in found.values())


def test_label_other_does_not_take_the_other_options_name(spark):
    found = names(
        spark,
        question(
            1,
            "CHOICE",
            group(["V1", "V2"], labels=de("Other", "Anderes")),
            group(["V2.1"], items=[item()], kind="SINGLELINE"),
        ),
    )
    assert found["V2"] == "Q1_other" and found["V2.1"] == "Q1_other_text"
    assert found["V1"].startswith("Q1_otherxx")


def test_same_word_in_different_questions(spark):
    found = names(
        spark,
        question(1, "CHOICE", group(["V1", "V2"], labels=de("Ja", "Nein"))),
        question(2, "CHOICE", group(["V3", "V4"], labels=de("Ja", "Nein"))),
    )
    assert found == {"V1": "Q1_ja", "V2": "Q1_nein", "V3": "Q2_ja", "V4": "Q2_nein"}


def test_names_are_the_same_every_time(spark):
    assert names(spark, *QUESTIONS) == names(spark, *QUESTIONS)


def test_word_from_the_question_when_the_label_has_none(spark):
    found = names(
        spark,
        question(1, "CHOICE", group(["V1", "V2"], labels=de("18-25", "26-30")), text="Dein Alter?"),
    )
    assert found["V1"] == "Q1_alter"


def word_model(text):
    text = text.strip().lstrip("_")
    for letter, spelling in zip("äöüÄÖÜß", ["ae", "oe", "ue", "ae", "oe", "ue", "ss"]):
        text = text.replace(letter, spelling)
    words = [w for w in re.split(r"[^a-zéñç]+", text.lower()) if re.fullmatch("[a-z]+", w)]
    return re.sub("xx+", "x", max(words, key=len)) if words else None


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="abxÄöüß éñ-_1 ", max_size=20), min_size=1, max_size=30))
def test_word_against_a_model(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in frame.select("text", naming_word(F.col("text")).alias("word")).collect():
        assert row.word == word_model(row.text), repr(row.text)


def test_transliterate(spark):
    frame = spark.createDataFrame([(" __Größe ÄÖÜ ä ß_",)], "text string")
    assert frame.select(transliterate(F.col("text"))).first()[0] == "Groesse aeoeue ae ss_"


def test_given_names(metadata, spark):
    given_names = spark.createDataFrame(
        [("demo", "V1", "mood"), ("demo", "V3", "comic_books"), ("else", "V2", "novels")],
        "survey_id string, original_id string, id string",
    )
    found = {r.original_id: r.id for r in use_names(metadata, given_names).collect()}
    assert found["V1"] == "mood" and found["V3"] == "comic_books" and found["V2"] == "Q2_romane"
    assert len(found) == 18


def test_variables_per_question(metadata):
    counts = {r.question_id: r.var_count for r in variables_per_question(metadata).collect()}
    assert counts == {1: 1, 2: 4, 3: 1, 4: 2, 5: 1, 6: 1, 7: 4, 8: 3, 9: 1}


def test_duplicates_are_found(metadata):
    twice = metadata.unionByName(metadata.where("id = 'Q1'"))
    assert [(r.id, r["count"]) for r in duplicate_ids(twice).collect()] == [("Q1", 2)]
    with pytest.raises(NamingError, match="Q1"):
        require_unique_names(twice)


def test_raw_name_used_twice(spark):
    twice = [question(n, "SCALE", group(["V1"], span=[0, 1, 1])) for n in (1, 2)]
    with pytest.raises(NamingError, match="original_id"):
        checked_metadata(definition_frame(spark, twice))


def test_raw_names_left(spark, metadata):
    frame = spark.createDataFrame(
        [("V1",), ("V12",), ("Vx3",), ("Vxy3",), ("Value",), ("Q1",), ("v1",)], "id string"
    )
    assert {r.id for r in frame.where(raw_names_left()).collect()} == {"V1", "V12", "Vx3"}
    with pytest.raises(NamingError, match="raw name left"):
        require_named(metadata.withColumn("id", F.col("original_id")))


def test_blank_label_is_an_error(spark):
    blank = question(1, "CHOICE", group(["V1", "V2"], labels=[{"de": "a"}, []]))
    with pytest.raises(NamingError, match="V2"):
        checked_metadata(definition_frame(spark, [blank]))
