"""Questions to variables: one row per column of the response table.

Everything about a question is in its own row, so flattening is a projection and an
explode: no shuffle, no join, whatever the number of surveys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.functions.binding import bind
from wavebook.functions.text import german, is_blank
from wavebook.operators.problems import raise_if_any
from wavebook.sources.definitions import definition_violations, is_unreadable

# ---- fixed values: inferred question types ----
SINGLE_CHOICE = "single_choice"
MULTIPLE_CHOICE = "multiple_choice"
MULTIPLE_CHOICE_OTHER = "multiple_choice_other"
MATRIX = "matrix"
SCALE = "scale"
INPUT_SINGLE = "input_single_"
INPUT_MULTIPLE = "input_multiple_"
# ---- end of fixed values ----

QUESTION_KEYS = [
    "survey_id",
    "question_id",
    "question_position",
    "question_type",
    "question_text",
]
_TEXTS = "array<string>"


class DefinitionError(ValueError):
    """A survey definition breaks the rules for its question types."""


def _group(index: int) -> Column:
    return F.get(F.col("groups"), F.lit(index))


def _count(values: Column) -> Column:
    return F.coalesce(F.array_size(values), F.lit(0))


def question_type() -> Column:
    """Question type inferred from the raw type, the groups and the first group's size."""
    groups = _count(F.col("groups"))
    first = _group(0)
    input_type = F.lower(first["input_type"])
    raw = F.col("type")
    return (
        F.when((raw == "INPUT") & (groups == 1), F.concat(F.lit(INPUT_SINGLE), input_type))
        .when((raw == "INPUT") & (groups > 1), F.concat(F.lit(INPUT_MULTIPLE), input_type))
        .when((raw == "MATRIX") & (groups == 1), F.lit(MATRIX))
        .when(
            (raw == "CHOICE") & (groups == 1),
            F.when(_count(first["varnames"]) == 1, F.lit(SINGLE_CHOICE)).otherwise(
                F.lit(MULTIPLE_CHOICE)
            ),
        )
        .when((raw == "CHOICE") & (groups == 2), F.lit(MULTIPLE_CHOICE_OTHER))
        .when((raw == "SCALE") & (groups == 1), F.lit(SCALE))
    )


def classify_questions(questions: DataFrame) -> DataFrame:
    """Add ``question_type`` and ``question_text`` to normalized questions."""
    return questions.withColumns(
        {"question_type": question_type(), "question_text": german(F.col("question"))}
    )


# ---------------------------------------------------------------- rules


def lacks_german_text() -> Column:
    return ~F.coalesce(F.map_contains_key("question", "de"), F.lit(False))


def _rule_violations() -> Column:
    kind, first, second = F.col("question_type"), _group(0), _group(1)

    def every_group(test) -> Column:
        return F.coalesce(F.forall("groups", test), F.lit(False))

    single = kind.startswith(INPUT_SINGLE)
    several = kind.startswith(INPUT_MULTIPLE)
    prefix = F.split(F.get(second["varnames"], F.lit(0)), r"\.")[0]
    rules = {
        "no German ('de') question text": lacks_german_text(),
        "unknown question type for this number of groups": kind.isNull(),
        "an input field has exactly one variable, one item and no labels": (single | several)
        & ~every_group(
            lambda g: (_count(g["varnames"]) == 1)
            & (_count(g["items"]) == 1)
            & (_count(g["labels"]) == 0)
        ),
        "every field of a multiple input has a German name": several
        & ~every_group(lambda g: german(g["name"]) != ""),
        "all fields of a multiple input share one input type": several
        & (_count(F.array_distinct(F.transform("groups", lambda g: g["input_type"]))) != 1),
        "a matrix has more than one item, as many variables and more than one label": (
            kind == MATRIX
        )
        & ~(
            (_count(first["items"]) > 1)
            & (_count(first["varnames"]) == _count(first["items"]))
            & (_count(first["labels"]) > 1)
        ),
        "a single choice has exactly one item": (kind == SINGLE_CHOICE)
        & (_count(first["items"]) != 1),
        "a multiple choice has as many variables as labels": (kind == MULTIPLE_CHOICE)
        & (_count(first["varnames"]) != _count(first["labels"])),
        "a choice with other text has several options, each with a label": (
            kind == MULTIPLE_CHOICE_OTHER
        )
        & ~(
            (_count(first["varnames"]) > 1)
            & (_count(first["varnames"]) == _count(first["labels"]))
        ),
        "the other text is one single-line field named after one of the options": (
            kind == MULTIPLE_CHOICE_OTHER
        )
        & ~F.coalesce(
            (_count(second["items"]) == 1)
            & (_count(second["varnames"]) == 1)
            & F.get(second["varnames"], F.lit(0)).contains(".1")
            & (second["input_type"] == "SINGLELINE")
            & F.array_contains(first["varnames"], prefix),
            F.lit(False),
        ),
        "a scale has a range and a variable": (kind == SCALE)
        & (first["range"].isNull() | (_count(first["varnames"]) == 0)),
    }
    return F.array_compact(
        F.array(*[F.when(broken, F.lit(message)) for message, broken in rules.items()])
    )


def violations() -> Column:
    """All messages about one classified question; an empty array when it is fine."""
    unreadable = F.array(F.lit("the definition holds no readable question"))
    return F.when(is_unreadable(), unreadable).otherwise(
        F.concat(definition_violations(), _rule_violations())
    )


def question_violations(classified: DataFrame) -> DataFrame:
    """One row per broken rule, over all questions of all surveys."""
    return classified.select(
        "survey_id",
        "question_position",
        "question_id",
        # The outer form keeps the optimizer from testing the array's size beforehand,
        # which would evaluate every rule twice.
        F.explode_outer(violations()).alias("violation"),
    ).where("violation is not null")


def require_valid(classified: DataFrame) -> None:
    """Raise with all broken rules of all definitions."""
    problem = F.concat_ws(
        "",
        F.lit("survey "),
        "survey_id",
        F.lit(", question "),
        F.col("question_id").cast("string"),
        F.lit(" at position "),
        F.col("question_position").cast("string"),
        F.lit(": "),
        "violation",
    )
    found = question_violations(classified)
    raise_if_any(found, problem, DefinitionError, "the definitions break rules")


# ---------------------------------------------------------------- variables


def variable(
    name: Column,
    type_name: str | Column,
    group_id: Column | None = None,
    label: Column | None = None,
    range_min: Column | None = None,
    range_max: Column | None = None,
    codes: Column | None = None,
    labels: Column | None = None,
    scale_labels: Column | None = None,
    other_boolean: bool = False,
    other_text: bool = False,
) -> Column:
    """One variable; what a question type does not set is null or false."""

    def given(value: Column | None, data_type: str) -> Column:
        return (F.lit(None) if value is None else value).cast(data_type)

    kind = F.lit(type_name) if isinstance(type_name, str) else type_name
    group = F.lit(0) if group_id is None else group_id
    return F.struct(
        group.cast("bigint").alias("group_id"),
        name.alias("id"),
        kind.alias("schema_variable_type"),
        given(label, "string").alias("label"),
        given(range_min, "double").alias("range_min"),
        given(range_max, "double").alias("range_max"),
        given(codes, _TEXTS).alias("possible_values_codes"),
        given(labels, _TEXTS).alias("possible_values_labels"),
        given(scale_labels, _TEXTS).alias("scale_labels"),
        F.lit(other_boolean).alias("is_other_boolean"),
        F.lit(other_text).alias("is_other_text"),
    )




def _input_type_name(group: Column) -> Column:
    return F.when(group["input_type"] == "INTEGER", F.lit("Int64")).otherwise(F.lit("String"))


def _single_input() -> Column:
    return F.array(variable(F.get(_group(0)["varnames"], F.lit(0)), _input_type_name(_group(0))))


def _multiple_input() -> Column:
    return F.transform(
        "groups",
        lambda g, i: variable(
            F.get(g["varnames"], F.lit(0)), _input_type_name(_group(0)), i, german(g["name"])
        ),
    )


def _matrix() -> Column:
    group = _group(0)
    headings = F.filter(F.transform(group["labels"], german), lambda text: text != "")
    low = F.when(group["range"].isNull(), F.lit(1.0)).otherwise(F.get(group["range"], F.lit(0)))
    high = F.when(group["range"].isNull(), _count(group["labels"]).cast("double")).otherwise(
        F.get(group["range"], F.lit(1))
    )

    def items(shown: Column) -> Column:
        return F.zip_with(
            group["varnames"],
            group["items"],
            lambda name, item: variable(
                name,
                "Int64",
                label=german(item["name"]),
                range_min=low,
                range_max=high,
                scale_labels=shown,
            ),
        )

    return bind(F.when(F.array_size(headings) > 0, headings), items)


def code_book(codes: Column, labels: Column) -> Column:
    """Pairs of code and German label; codes 1..n where none are given.

    Codes and labels of different number say nothing about each other and give no
    pair; a blank code or an empty label drops its pair only.
    """
    numbered = F.transform(labels, lambda _, i: (i + 1).cast("string"))
    given = F.when(F.forall(F.coalesce(codes, F.array()), is_blank), numbered).otherwise(codes)

    def pairs(used: Column) -> Column:
        zipped = F.zip_with(
            used,
            labels,
            lambda code, label: F.struct(code.alias("code"), german(label).alias("label")),
        )
        return F.when(
            F.array_size(used) == F.array_size(labels),
            F.filter(zipped, lambda pair: ~is_blank(pair["code"]) & (pair["label"] != "")),
        )

    return bind(given, pairs)


def _single_choice() -> Column:
    group = _group(0)

    def chosen(pairs: Column) -> Column:
        some = F.array_size(pairs) > 0
        return variable(
            F.get(group["varnames"], F.lit(0)),
            "String",
            codes=F.when(some, pairs["code"]),
            labels=F.when(some, pairs["label"]),
        )

    return F.array(bind(code_book(group["codes"], group["labels"]), chosen))


def _multiple_choice() -> Column:
    group = _group(0)
    return F.zip_with(
        group["varnames"],
        group["labels"],
        lambda name, label: variable(name, "Boolean", label=german(label)),
    )


def _multiple_choice_other() -> Column:
    options, text_field = _group(0), F.get(_group(1)["varnames"], F.lit(0))
    other = F.split(text_field, r"\.")[0]

    def in_order(place: Column) -> Column:
        label = german(F.get(options["labels"], place))
        plain = F.filter(_multiple_choice(), lambda _, i: i != place)
        as_boolean = variable(other, "Boolean", label=label, other_boolean=True)
        as_text = variable(
            text_field,
            "String",
            group_id=F.lit(1),
            label=F.concat(label, F.lit(" (Text)")),
            other_text=True,
        )
        return F.concat(plain, F.array(as_boolean, as_text))

    return bind((F.array_position(options["varnames"], other) - 1).cast("int"), in_order)


def _scale() -> Column:
    group = _group(0)
    return F.array(
        variable(
            F.get(group["varnames"], F.lit(0)),
            "Int64",
            range_min=F.get(group["range"], F.lit(0)),
            range_max=F.get(group["range"], F.lit(1)),
        )
    )


def variables() -> Column:
    """The variables of a classified question as an array, null for an unknown type."""
    kind = F.col("question_type")
    return (
        F.when(kind.startswith(INPUT_SINGLE), _single_input())
        .when(kind.startswith(INPUT_MULTIPLE), _multiple_input())
        .when(kind == MATRIX, _matrix())
        .when(kind == SINGLE_CHOICE, _single_choice())
        .when(kind == MULTIPLE_CHOICE, _multiple_choice())
        .when(kind == MULTIPLE_CHOICE_OTHER, _multiple_choice_other())
        .when(kind == SCALE, _scale())
    )


def question_variables(classified: DataFrame) -> DataFrame:
    """Classified questions with their ``variables``; null where a rule is broken.

    As the output of a generator the variables are worked out once per question, also
    when a later filter or count looks at them.
    """
    found = F.when(F.array_size(violations()) == 0, variables()).alias("variables")
    return classified.select(*QUESTION_KEYS, F.inline(F.array(F.struct(found)))).withColumn(
        "variable_count", F.array_size("variables").cast("bigint")
    )


def explode_variables(questions: DataFrame) -> DataFrame:
    """One row per variable; questions without variables vanish.

    ``variable_position`` is the place within the question; it and ``variable_count``,
    the question's number of variables, need no shuffle here.
    """
    exploded = questions.select(
        *QUESTION_KEYS,
        "variable_count",
        # Outer, then dropping the empty ones: the rules are not evaluated a second time
        # by a filter pushed below the explode.
        F.posexplode_outer("variables").alias("index", "v"),
    ).where("index is not null")
    position = (F.col("index") + 1).cast("bigint").alias("variable_position")
    return exploded.select(*QUESTION_KEYS, "v.*", position, "variable_count")


def flatten_questions(classified: DataFrame) -> DataFrame:
    """One row per variable of every question that breaks no rule, under its raw name."""
    return explode_variables(question_variables(classified))


def join_question_text(variables_: DataFrame, texts: DataFrame) -> DataFrame:
    """Left join of question texts, for variables that do not carry them yet.

    ``texts`` is (survey_id, question_id, text), one row per question, any number of
    them: both sides are shuffled and merged, and a question with very many variables is
    split at run time by the skew-join rule.
    """
    renamed = texts.select("survey_id", "question_id", F.col("text").alias("question_text"))
    return variables_.join(renamed.hint("merge"), ["survey_id", "question_id"], "left")
