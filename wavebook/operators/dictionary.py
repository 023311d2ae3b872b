"""The data dictionary: a table of variables, and its text as one row per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavebook.functions.binding import bind
from wavebook.functions.formatting import heading, list_display, range_display

# ---- fixed values: columns shown per question type, and the document's fixed lines ----
SHOWN_COLUMNS = {
    "scale": ["Variable", "Data Type", "Range"],
    "matrix": ["Variable", "Label", "Data Type", "Range"],
    "single_choice": ["Variable", "Data Type", "Possible Values"],
    "input_single_singleline": ["Variable", "Data Type"],
    "input_single_multiline": ["Variable", "Data Type"],
}
SHOWN_OTHERWISE = ["Variable", "Label", "Data Type"]
TITLE_LINES = ["# Survey Documentation", "", "## Overview", ""]
QUESTIONS_LINES = ["## Questions", ""]
# ---- end of fixed values ----

#: Variables of one question that are joined together.
BUCKET = 10_000

_CELLS = ["Variable", "Label", "Data Type", "Range", "Possible Values"]
_KEYS = ["Survey Id", "Question Id"]

#: The parts of a document in their order: a survey's overview; of each question the heading,
#: the table's variables and the line after them.
OVERVIEW, HEADING, TABLE, CLOSING = range(4)


def dictionary_frame(metadata: DataFrame) -> DataFrame:
    """The variables with everything shown as text, under headings in title case."""
    shown = metadata.select(
        "survey_id",
        F.col("id").alias("variable"),
        F.coalesce("label", F.lit("")).alias("label"),
        F.col("question_text").alias("question"),
        "question_id",
        "question_type",
        F.col("schema_variable_type").alias("data_type"),
        range_display(F.col("range_min"), F.col("range_max")).alias("range"),
        list_display(F.col("possible_values_labels")).alias("possible_values"),
        list_display(F.col("scale_labels")).alias("scale_labels"),
        "question_position",
        "variable_position",
    )
    return shown.select([F.col(name).alias(heading(name)) for name in shown.columns])


def ordered_dictionary(dictionary: DataFrame) -> DataFrame:
    return dictionary.orderBy("Survey Id", "Question Position", "Variable Position")


def dictionary_overview(metadata: DataFrame) -> DataFrame:
    """Questions and variables per survey."""
    return metadata.groupBy("survey_id").agg(
        F.countDistinct("question_id").alias("total_questions"),
        F.count(F.lit(1)).alias("total_variables"),
    )


def question_ids_in_order(metadata: DataFrame) -> DataFrame:
    return metadata.select("survey_id", "question_id").distinct().orderBy("survey_id", "question_id")


def _shown_columns(question_type: Column) -> Column:
    shown = _texts(SHOWN_OTHERWISE)
    for kind, names in SHOWN_COLUMNS.items():
        shown = F.when(question_type == kind, _texts(names)).otherwise(shown)
    return shown


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _table_line(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def _place() -> Column:
    return F.struct("Question Position", "Variable Position")


def _on_one_line(text: Column) -> Column:
    """Line breaks and the white space around them as one blank.

    Few texts have any; looking for a character costs far less than the expression.
    """
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.regexp_replace(text, r"\s*[\r\n]+\s*", " ")).otherwise(text)


def in_buckets(dictionary: DataFrame) -> DataFrame:
    """Cells on one line each, and the bucket of the variable's position in its question."""
    one_line = {name: _on_one_line(F.col(f"`{name}`")) for name in [*_CELLS, "Question"]}
    bucket = F.greatest(F.floor((F.col("Variable Position") - 1) / BUCKET), F.lit(0))
    return dictionary.withColumns(one_line).withColumn("bucket", bucket.cast("bigint"))


def dictionary_lines(dictionary: DataFrame) -> DataFrame:
    """The dictionary's text, one row per line, over all surveys.

    (survey_id, question_id, part, place) give the order. Each variable makes its own
    line; what a question's lines share (widths, heading, size) is a small aggregate
    joined back, and the first variable brings the lines around the table. A question
    with very many variables is joined in buckets of BUCKET positions, so it is neither
    gathered in one row nor in one task. The variables are read twice: pass a stored table.
    """
    rows = in_buckets(dictionary)
    # what a question's lines share, once for each of its buckets
    questions = (
        _questions(rows)
        .withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))))
        .drop("last")
    )
    cells = F.create_map(*[part for name in _CELLS for part in (F.lit(name), F.col(f"`{name}`"))])
    # Merged, not broadcast: there may be any number of questions, and none of their buckets
    # is larger than BUCKET.
    joined = rows.select(*_KEYS, "bucket", _place().alias("place"), cells.alias("cells")).join(
        questions.hint("merge"), [*_KEYS, "bucket"], "left"
    )
    # The outer form keeps the optimizer from testing the array's size beforehand, which
    # would put every line together twice; no array is empty.
    return joined.select(
        F.col("Survey Id").alias("survey_id"),
        F.col("Question Id").alias("question_id"),
        F.inline_outer(bind(_shown_columns(F.col("shown.Question Type")), _lines_of_variable)),
    )


def _questions(rows: DataFrame) -> DataFrame:
    """What a question's lines share; rows as of :func:`in_buckets`."""
    widths = [
        part
        for name in _CELLS
        for part in (
            F.lit(name),
            F.greatest(F.max(F.char_length(f"`{name}`")), F.lit(len(name))),
        )
    ]
    return rows.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("size"),
        F.min(_place()).alias("first"),
        F.max("bucket").alias("last"),
        F.min_by(F.struct("Question", "Question Type"), _place()).alias("shown"),
        F.create_map(*widths).alias("widths"),
    )


def _padded(names: Column, widths: Column, value) -> Column:
    return F.transform(names, lambda n: F.rpad(value(n), F.element_at(widths, n), " "))


def _heading(names: Column) -> Column:
    """The lines from a question's title to the rule of its table."""
    widths = F.col("widths")
    dashes = F.transform(names, lambda n: F.repeat(F.lit("-"), F.element_at(widths, n) + 2))
    rule = F.concat(F.lit("|"), F.array_join(dashes, "|"), F.lit("|"))
    position = F.col("first.Question Position").cast("string")
    return F.array(
        F.concat(F.lit("### Q"), position, F.lit(": "), F.col("shown.Question")),
        F.lit(""),
        F.concat(F.lit("**Type:** "), F.col("shown.Question Type")),
        F.lit(""),
        F.concat(F.lit("**Variables:** "), F.col("size").cast("string")),
        F.lit(""),
        _table_line(_padded(names, widths, lambda n: n)),
        rule,
    )


def _lines_of_variable(names: Column) -> Column:
    """A variable's table line, with the lines around the table for the first variable."""

    def line(part: int, number: Column, text: Column) -> Column:
        return F.struct(
            F.lit(part).alias("part"), number.cast("bigint").alias("place"), text.alias("line")
        )

    around = F.concat(
        F.transform(_heading(names), lambda text, i: line(HEADING, i, text)),
        F.array(line(CLOSING, F.lit(0), F.lit(""))),
    )
    cells = _padded(names, F.col("widths"), lambda n: F.element_at("cells", n))
    own = line(TABLE, F.col("place.Variable Position"), _table_line(cells))
    return F.when(F.col("place") == F.col("first"), F.concat(around, F.array(own))).otherwise(
        F.array(own)
    )


def text_around(metadata: DataFrame) -> DataFrame:
    """All text but the variables' own lines, lines that follow each other in one row.

    (survey_id, question_id, bucket, part, place) give the order. The row of a heading carries
    what the lines of its question need, and there is one in each of the question's buckets.
    The variables are read three times: pass a stored table.
    """
    rows = in_buckets(dictionary_frame(metadata))
    # As many headings as variables stand in the first place.
    times = (
        rows.groupBy(*_KEYS, _place().alias("place"))
        .agg(F.count(F.lit(1)).cast("int").alias("times"))
        .groupBy(*_KEYS)
        .agg(F.min_by("times", "place").alias("times"))
    )
    # Variables without a survey or a question have no heading.
    questions = _questions(rows).join(times.hint("merge"), _KEYS)
    heading = bind(_shown_columns(F.col("shown.Question Type")), _heading)
    repeated = F.flatten(
        F.transform(heading, lambda line: F.array_repeat(F.coalesce(line, F.lit("")), F.col("times")))
    )
    shared = F.struct(F.col("shown.Question Type").alias("type"), F.col("widths"))
    begin = F.col("bucket") == 0
    headings = questions.withColumn(
        "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))
    ).select(
        *_KEYS, "bucket", F.lit(HEADING), F.when(begin, F.array_join(repeated, "\n")), shared
    )
    nothing = F.lit(None).cast(headings.schema[-1].dataType)
    closings = questions.select(
        *_KEYS, "last", F.lit(CLOSING), F.repeat(F.lit("\n"), F.col("times") - 1), nothing
    )
    overviews = dictionary_overview(metadata).select(
        "survey_id",
        F.lit(0).cast("bigint"),
        F.lit(0).cast("bigint"),
        F.lit(OVERVIEW),
        F.array_join(_overview(), "\n"),
        nothing,
    )
    names = ["survey_id", "question_id", "bucket", "part", "text", "shared"]
    found = headings.union(closings).union(overviews).toDF(*names)
    return found.withColumn("place", F.lit(None).cast("bigint"))


def text_in_order(dictionary: DataFrame, around: DataFrame) -> DataFrame:
    """(survey_id, text) of all documents, in order over the partitions and within them.

    Variables are shuffled once, as they are, and padded to their widths at the end: padded lines
    take many times the bytes. Rows are spread by ranges of buckets, where the heading's row stands
    first and hands its widths down.
    """
    rows = in_buckets(dictionary).select(
        F.col("Survey Id").alias("survey_id"),
        F.col("Question Id").alias("question_id"),
        "bucket",
        F.lit(TABLE).alias("part"),
        F.col("Variable Position").alias("place"),
        F.struct(*[F.col(f"`{name}`") for name in _CELLS]).alias("cells"),
    )
    keys, order = ["survey_id", "question_id", "bucket"], ["part", "place"]
    down = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.unionByName(around, allowMissingColumns=True)
        .repartitionByRange(*keys)
        .withColumn("shared", F.first("shared", ignorenulls=True).over(down))
        .sortWithinPartitions(*keys, *order)
        .where((F.col("part") != HEADING) | (F.col("bucket") == 0))
    )
    cells = F.create_map(*[x for name in _CELLS for x in (F.lit(name), F.col(f"cells.`{name}`"))])

    def line(bound: Column) -> Column:
        padded = _padded(bound["names"], bound["widths"], lambda n: F.element_at(bound["cells"], n))
        return _table_line(padded)

    needed = F.struct(
        _shown_columns(F.col("shared.type")).alias("names"),
        F.col("shared.widths").alias("widths"),
        cells.alias("cells"),
    )
    text = F.when(F.col("part") == TABLE, bind(needed, line)).otherwise(F.col("text"))
    return placed.select("survey_id", text.alias("text"))


def overview_lines(overview: DataFrame) -> DataFrame:
    """The lines before the first question; question 0 sorts before all others."""
    return overview.select(
        "survey_id",
        F.lit(0).cast("bigint").alias("question_id"),
        F.lit(OVERVIEW).alias("part"),
        F.posexplode(_overview()).alias("place", "line"),
    ).withColumn("place", F.col("place").cast("bigint"))


def _overview() -> Column:
    return F.array(
        *[F.lit(line) for line in TITLE_LINES],
        F.concat(F.lit("Total questions: "), F.col("total_questions").cast("string")),
        F.lit(""),
        F.concat(F.lit("Total variables: "), F.col("total_variables").cast("string")),
        F.lit(""),
        *[F.lit(line) for line in QUESTIONS_LINES],
    )
