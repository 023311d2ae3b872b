import json

import pytest
from surveys import QUESTIONS, de, definition_frame, group, item, question

from wavebook.operators.flatten import (
    DefinitionError,
    flatten_questions,
    join_question_text,
    question_violations,
    require_valid,
)
from wavebook.plans.pipeline import checked_metadata, classified_questions, survey_metadata
from wavebook.sources.definitions import normalize_questions, read_definitions, read_questions


def many(spark, cases):
    """One definition per case, so that all cases take one job."""
    rows = [(str(n), json.dumps(case)) for n, case in enumerate(cases)]
    return spark.createDataFrame(rows, "survey_id string, definition string")


def variables(spark, *questions):
    rows = survey_metadata(definition_frame(spark, list(questions))).collect()
    return sorted(rows, key=lambda r: (r.question_position, r.variable_position))


def test_all_types(metadata):
    rows = metadata.collect()
    assert len(rows) == 18
    kinds = {row.original_id: row.question_type for row in rows}
    assert kinds["V10"] == "input_single_multiline"
    assert kinds["V6"] == "input_single_integer"
    assert kinds["V14"] == kinds["V16"] == "input_multiple_singleline"
    assert kinds["V9"] == "single_choice"
    assert kinds["V2"] == "multiple_choice"
    assert kinds["V13.1"] == "multiple_choice_other"
    assert kinds["V7"] == "matrix"
    assert kinds["V1"] == "scale"
    types = {row.original_id: row.schema_variable_type for row in rows}
    assert [types[v] for v in ("V10", "V6", "V9", "V2", "V13.1", "V7", "V1")] == [
        "String", "Int64", "String", "Boolean", "String", "Int64", "Int64",
    ]


def test_pages_are_ranked_and_positions_counted(spark):
    questions = read_questions(definition_frame(spark, QUESTIONS)).collect()
    assert {(q.question_id, q.question_position, q.page_number) for q in questions} == {
        (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 2), (5, 5, 2), (6, 6, 3), (7, 7, 3), (8, 8, 4), (9, 9, 4),
    }


def test_other_option_comes_last_and_once(spark):
    rows = variables(
        spark,
        question(
            1,
            "CHOICE",
            group(["V40", "V41", "V42"], labels=de("Grund 1", "Anderes", "Grund 2")),
            group(["V41.1"], items=[item("Text")], kind="SINGLELINE"),
        ),
    )
    assert [r.original_id for r in rows] == ["V40", "V42", "V41", "V41.1"]
    assert [r.label for r in rows] == ["Grund 1", "Grund 2", "Anderes", "Anderes (Text)"]
    assert [r.is_other_boolean for r in rows] == [False, False, True, False]
    assert [r.is_other_text for r in rows] == [False, False, False, True]
    assert [r.group_id for r in rows] == [0, 0, 0, 1]


def test_other_option_without_label(spark):
    rows = variables(
        spark,
        question(
            1,
            "CHOICE",
            group(["V69", "V70"], labels=[{"de": "Auswahl"}, []]),
            group(["V70.1"], items=[item()], kind="SINGLELINE"),
        ),
    )
    assert [(r.original_id, r.label) for r in rows] == [
        ("V69", "Auswahl"), ("V70", ""), ("V70.1", " (Text)"),
    ]


def test_matrix(spark):
    def matrix(span, labels):
        return question(
            1,
            "MATRIX",
            group(["V10", "V11"], labels=labels, items=[item("Punkt 1"), item("Punkt 2")], span=span),
        )

    rows = variables(spark, matrix([1, 2, 1], de("Option A", "Option B")))
    assert [(r.label, r.range_min, r.range_max) for r in rows] == [
        ("Punkt 1", 1.0, 2.0), ("Punkt 2", 1.0, 2.0),
    ]
    assert rows[0].scale_labels == ["Option A", "Option B"]
    rows = variables(spark, matrix([], [{"de": "a"}, [], {"de": "c"}]))
    assert [(r.range_min, r.range_max) for r in rows] == [(1.0, 3.0)] * 2
    assert rows[0].scale_labels == ["a", "c"]
    assert variables(spark, matrix([], [[], {}]))[0].scale_labels is None


def test_multiple_input(spark):
    rows = variables(
        spark,
        question(
            1,
            "INPUT",
            group(["V1"], items=[item()], kind="INTEGER", name={"de": "Erstes Feld"}),
            group(["V2"], items=[item()], kind="INTEGER", name={"de": "Zweites Feld"}),
        ),
    )
    assert [(r.label, r.group_id, r.schema_variable_type) for r in rows] == [
        ("Erstes Feld", 0, "Int64"), ("Zweites Feld", 1, "Int64"),
    ]


CODE_BOOKS = [
    (["1", "2", "3"], de("A", "B", "C"), (["1", "2", "3"], ["A", "B", "C"])),
    ([], de("A", "B"), (["1", "2"], ["A", "B"])),
    (["", " "], de("A", "B"), (["1", "2"], ["A", "B"])),
    (["a", " ", "c"], de("A", "B", "C"), (["a", "c"], ["A", "C"])),
    (["a", "b"], [{"de": "A"}, []], (["a"], ["A"])),
    (["1"], de("A", "B"), (None, None)),
    ([], [], (None, None)),
    ([], [{}, []], (None, None)),
]


def test_code_books(spark):
    cases = [
        [question(1, "CHOICE", group(["V3"], labels=labels, codes=codes, items=[item()]))]
        for codes, labels, _ in CODE_BOOKS
    ]
    found = {
        int(row.survey_id): (row.possible_values_codes, row.possible_values_labels)
        for row in survey_metadata(many(spark, cases)).collect()
    }
    assert found == {n: expected for n, (_, _, expected) in enumerate(CODE_BOOKS)}


def test_scale(spark):
    (row,) = variables(spark, question(1, "SCALE", group(["V15"], span=[1, 5, 1])))
    assert (row.range_min, row.range_max, row.schema_variable_type) == (1.0, 5.0, "Int64")


def test_empty_lists_standing_for_maps(spark):
    raw = question(1, "CHOICE", group(["V1", "V2"], labels=[{"de": "x"}, []]))
    raw["groups"][0]["name"] = []
    raw["groups"][0]["range"] = []
    raw["groups"][0]["items"] = [{"id": "1", "name": []}]
    (row,) = normalize_questions(read_questions(definition_frame(spark, [raw]))).collect()
    (g,) = row.groups
    assert g.name == {} and g.range is None
    assert g.labels == [{"de": "x"}, {}]
    assert g["items"][0].name == {}


def incomplete(question_):
    del question_["groups"][0]["codes"]
    return question_


BROKEN = [
        (question(1, "RANKING", group(["V1"])), "unknown question type"),
        (question(1, "SCALE"), "unknown question type"),
        ({**question(1, "SCALE", group(["V1"], span=[0, 1, 1])), "question": {"en": "x"}}, "German"),
        ({**question(1, "SCALE", group(["V1"], span=[0, 1, 1])), "question": None}, "German"),
        ({**question(1, "SCALE", group(["V1"], span=[0, 1, 1])), "pageId": 0}, "pageId"),
        ({**question(1, "SCALE", group(["V1"], span=[0, 1, 1])), "position": 0}, "position"),
        ({**question(1, "NONE", group(["V1"], span=[0, 1, 1]))}, "type is not known"),
        (question(1, "SCALE", group(["V1"], span=[0, 1])), "range must hold"),
        (question(1, "SCALE", group(["V1"])), "a scale has a range"),
        (question(1, "INPUT", group(["V1"], items=[item()], kind="TEXT")), "inputType"),
        (question(1, "INPUT", group(["V1"], items=[], kind="INTEGER")), "an input field"),
        (question(1, "INPUT", group(["V1"], items=[item()])), "unknown question type"),
        (
            question(
                1,
                "INPUT",
                group(["V1"], items=[item()], kind="INTEGER", name={"de": "a"}),
                group(["V2"], items=[item()], kind="DATE", name={"de": "b"}),
            ),
            "share one input type",
        ),
        (
            question(
                1,
                "INPUT",
                group(["V1"], items=[item()], kind="DATE", name={"de": "a"}),
                group(["V2"], items=[item()], kind="DATE"),
            ),
            "has a German name",
        ),
        (question(1, "CHOICE", group(["V1"], labels=de("a"), items=[])), "exactly one item"),
        (question(1, "CHOICE", group(["V1", "V2"], labels=de("a"))), "as many variables as labels"),
        (
            question(
                1,
                "CHOICE",
                group(["V1", "V2"], labels=de("a", "b")),
                group(["V3.1"], items=[item()], kind="SINGLELINE"),
            ),
            "named after one of the options",
        ),
        (
            question(1, "MATRIX", group(["V1"], labels=de("a", "b"), items=[item("x")])),
            "a matrix has",
        ),
    (incomplete(question(1, "SCALE", group(["V1"], span=[0, 1, 1]))), "a group lacks"),
]


def test_broken_rules_are_reported_and_give_no_variables(spark):
    classified = classified_questions(many(spark, [[bad] for bad, _ in BROKEN])).cache()
    found: dict[int, list[str]] = {}
    for row in question_violations(classified).collect():
        found.setdefault(int(row.survey_id), []).append(row.violation)
    for n, (bad, message) in enumerate(BROKEN):
        assert any(message in text for text in found[n]), (bad, found[n])
    assert flatten_questions(classified).count() == 0
    with pytest.raises(DefinitionError, match="survey 0"):
        require_valid(classified)


def test_question_ids_are_unique_and_definitions_readable(spark):
    twice = [question(1, "SCALE", group([v], span=[0, 1, 1])) for v in ("V1", "V2")]
    rows = [("twice", json.dumps(twice)), ("empty", ""), ("text", "no json"), ("none", "[]"), ("map", "{}")]
    frame = spark.createDataFrame(rows, "survey_id string, definition string")
    found: dict[str, set[str]] = {}
    for row in question_violations(classified_questions(frame)).collect():
        found.setdefault(row.survey_id, set()).add(row.violation)
    assert found["twice"] == {"question ids are not unique"}
    for survey in ("empty", "text", "none"):
        assert found[survey] == {"the definition holds no readable question"}
    assert found["map"]


def test_all_broken_questions_are_named_in_one_error(spark):
    bad = [question(n, "RANKING", group([f"V{n}"])) for n in (1, 2, 3)]
    with pytest.raises(DefinitionError) as error:
        checked_metadata(definition_frame(spark, bad))
    assert all(f"question {n} " in str(error.value) for n in (1, 2, 3))


def test_many_problems_are_counted_and_kept(spark):
    bad = [question(n, "RANKING", group([f"V{n}"])) for n in range(1, 31)]
    with pytest.raises(DefinitionError, match="and 10 more: all 30 are in") as error:
        checked_metadata(definition_frame(spark, bad))
    path = str(error.value).rsplit(" ", 1)[1]
    kept = [row.problem for row in spark.read.parquet(path).collect()]
    assert len(kept) == 30 and all("unknown question type" in problem for problem in kept)
    assert sorted(kept)[0] in str(error.value)


def test_definition_files(spark, tmp_path):
    for survey in ("first", "zweite welle", "a+b%20 ä"):
        (tmp_path / f"{survey}.json").write_text(
            json.dumps(QUESTIONS, indent=2, ensure_ascii=False), encoding="utf-8"
        )
    metadata = survey_metadata(read_definitions(spark, str(tmp_path)))
    counts = {row.survey_id: row["count"] for row in metadata.groupBy("survey_id").count().collect()}
    assert counts == {"first": 18, "zweite welle": 18, "a+b%20 ä": 18}


def test_join_question_text(spark):
    variables_ = spark.createDataFrame(
        [("s", 1, "V1"), ("s", 1, "V2"), ("s", 2, "V3")],
        "survey_id string, question_id bigint, id string",
    )
    texts = spark.createDataFrame(
        [("s", 1, "eins"), ("t", 2, "zwei")], "survey_id string, question_id bigint, text string"
    )
    joined = join_question_text(variables_, texts).collect()
    assert {(r.id, r.question_text) for r in joined} == {
        ("V1", "eins"), ("V2", "eins"), ("V3", None),
    }
