from pyspark.sql import functions as F

from wavebook.operators import dictionary
from wavebook.session import staged
from wavebook.sources.dictionary_files import all_lines, write_dictionary, write_index


def text(spark, metadata):
    rows = all_lines(metadata).orderBy("survey_id", "question_id", "part", "place").collect()
    return [row.line for row in rows]


def test_frame(metadata):
    frame = dictionary.ordered_dictionary(dictionary.dictionary_frame(metadata))
    assert frame.columns == [
        "Survey Id", "Variable", "Label", "Question", "Question Id", "Question Type", "Data Type",
        "Range", "Possible Values", "Scale Labels", "Question Position", "Variable Position",
    ]
    rows = {r["Variable"]: r for r in frame.collect()}
    assert list(rows)[0] == "Q1" and list(rows)[-1] == "Q9"
    assert rows["Q6"]["Label"] == "" and rows["Q6"]["Range"] == ""
    assert rows["Q1"]["Range"] == "[1.0, 7.0]"
    assert rows["Q5"]["Possible Values"] == "Fahrrad; Bus und Bahn; Auto"
    assert rows["Q4_uebersichtlich"]["Scale Labels"] == "immer; oft; selten; nie"


def test_range_display(spark):
    from wavebook.functions.formatting import range_display

    frame = spark.createDataFrame(
        [(1.0, None), (None, 2.5), (None, None), (-3.0, 2e7), (0.1, 1e300)], "a double, b double"
    )
    assert [r[0] for r in frame.select(range_display(F.col("a"), F.col("b"))).collect()] == [
        "[1.0, None]", "[None, 2.5]", "", "[-3.0, 20000000.0]", "[0.1, 1.0E300]",
    ]


def test_sections(spark, metadata):
    lines = text(spark, metadata)
    assert lines[:10] == [
        "# Survey Documentation", "", "## Overview", "", "Total questions: 9", "",
        "Total variables: 18", "", "## Questions", "",
    ]
    matrix = lines.index("### Q4: Frage")
    assert lines[matrix : matrix + 11] == [
        "### Q4: Frage",
        "",
        "**Type:** matrix",
        "",
        "**Variables:** 2",
        "",
        "| Variable           | Label                  | Data Type | Range      |",
        "|--------------------|------------------------|-----------|------------|",
        "| Q4_uebersichtlich  | Regale übersichtlich   | Int64     | [1.0, 4.0] |",
        "| Q4_oeffnungszeiten | Öffnungszeiten reichen | Int64     | [1.0, 4.0] |",
        "",
    ]
    single = lines.index("### Q5: Frage")
    assert lines[single + 6].split("|")[1:-1] == [
        " Variable ", " Data Type ", " Possible Values" + " " * 13,
    ]
    assert lines[lines.index("### Q6: Frage") + 6] == "| Variable | Data Type |"
    assert "Label" in lines[lines.index("### Q3: Frage") + 6]


def test_line_breaks_stay_out_of_the_table(spark, metadata):
    broken = metadata.withColumn("label", F.lit("a\n  b"))
    lines = text(spark, broken)
    assert any("| a b " in line for line in lines) and not any("\n" in line for line in lines)


def test_files(spark, metadata, tmp_path):
    two = metadata.unionByName(metadata.withColumn("survey_id", F.lit("zwei")))
    write_dictionary(two, str(tmp_path / "docs"))
    write_index(two, str(tmp_path / "index"))
    for survey in ("demo", "zwei"):
        parts = sorted((tmp_path / "docs" / f"survey_id={survey}").glob("part-*"))
        written = "".join(part.read_text() for part in parts).splitlines()
        expected = text(spark, metadata)
        assert written == expected
        index = "".join(p.read_text() for p in (tmp_path / "index" / f"survey_id={survey}").glob("part-*"))
        assert "9 questions" in index and survey in index


def test_question_ids(metadata):
    assert [r.question_id for r in dictionary.question_ids_in_order(metadata).collect()] == list(
        range(1, 10)
    )


def test_line_breaks_in_cells(spark, metadata):
    rows = dictionary.dictionary_frame(
        metadata.withColumn("label", F.lit("a \r\n\n b  c\rd"))
        .withColumn("question_text", F.when(F.col("id") == "Q1", F.lit("eins\n zwei")))
    )
    found = dictionary.in_buckets(rows)
    assert {row.Label for row in found.collect()} == {"a b  c d"}
    assert {row.Question for row in found.collect()} == {"eins zwei", None}


def test_texts_without_line_breaks_take_no_expression(metadata):
    """The regular expression stands under a condition that looks for a character."""
    shown = str(dictionary._on_one_line(metadata["label"])).lower()
    assert shown.index("contains") < shown.index("then regexp_replace")


def test_lines_are_put_together_once(spark, metadata, tmp_path, monkeypatch):
    """What is sorted by ranges is read from a stored table."""
    from wavebook.sources import dictionary_files

    stored = []

    def staged_(rows, purpose):
        stored.append(purpose)
        return staged(rows, purpose)

    monkeypatch.setattr(dictionary_files, "staged", staged_)
    write_dictionary(metadata, str(tmp_path / "dictionary"))
    written = spark.read.schema("value string, survey_id string").text(str(tmp_path / "dictionary"))
    assert stored == ["lines"]
    assert sorted(row.value for row in written.collect()) == sorted(text(spark, metadata))


def documents(path):
    return {
        folder.name.removeprefix("survey_id="): "".join(
            part.read_text(encoding="utf-8") for part in sorted(folder.glob("part-*"))
        )
        for folder in path.glob("survey_id=*")
    }


def test_documents_are_their_lines_in_order(spark, metadata, tmp_path, monkeypatch):
    """Over buckets, variables that come twice, without a survey or in no order, and question 0."""
    monkeypatch.setattr(dictionary, "BUCKET", 2)
    twice = metadata.union(metadata).withColumn("survey_id", F.lit("zwei"))
    zero = metadata.withColumn("survey_id", F.lit("null")).withColumn(
        "question_id", F.when(F.col("question_id") > 1, F.col("question_id") - 2)
    )
    # the variable that comes first by its question's position is the last one by its own
    turned = metadata.withColumn("survey_id", F.lit("um")).withColumn(
        "question_position", F.lit(100) - F.col("variable_position")
    )
    without = metadata.withColumn("survey_id", F.lit(None).cast("string")).withColumn("question_text", F.lit(None))
    places = [F.lit(None).cast("bigint").alias(n) if n == "variable_position" else n for n in metadata.columns]
    unplaced = metadata.where("question_id = 4").select(places).limit(1).withColumn("survey_id", F.lit("ohne"))
    rows = metadata.unionByName(twice).unionByName(zero).unionByName(turned).unionByName(without).unionByName(unplaced)
    rows = staged(rows.repartition(5), "metadata")
    write_dictionary(rows, str(tmp_path / "docs"))
    expected = {}
    for row in all_lines(rows).orderBy("survey_id", "question_id", "part", "place").collect():
        survey = row.survey_id or "__HIVE_DEFAULT_PARTITION__"
        expected[survey] = expected.get(survey, "") + (row.line or "") + "\n"
    assert documents(tmp_path / "docs") == expected and len(expected) == 6


def test_lines_are_padded_where_they_are_written(spark, metadata):
    """Neither what is stored nor what is shuffled holds a variable's padded line."""
    around = staged(dictionary.text_around(metadata), "lines")
    stored = [line for row in around.collect() for line in (row.text or "").splitlines()]
    assert "| Variable | Data Type |" in stored and not any(line.startswith("| Q") for line in stored)
    rows = dictionary.text_in_order(dictionary.dictionary_frame(metadata), around)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Sort ") == 1
    assert "rpad" in plan[: plan.index("Exchange")] and "rpad" not in plan[plan.index("Exchange") :]
