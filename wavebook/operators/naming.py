"""Readable variable names: ``Q<position>``, ``Q<position>_<word>``, ``Q<position>_other``.

Names follow a fixed rule, so the same definition gets the same names in every wave.
As the question position is part of every name, names that are unique within their
question are unique within their survey. A question's variables are in one row until
they are exploded, so names are given there, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.functions.binding import bind
from wavebook.functions.text import is_blank, naming_word, numbered_word
from wavebook.operators.flatten import MULTIPLE_CHOICE_OTHER
from wavebook.operators.problems import raise_if_any

# ---- fixed values: endings and what a name may not look like ----
OTHER = "_other"
OTHER_TEXT = "_other_text"
RAW_NAME_START = "V"
NAME_COLUMNS = ["id", "original_id"]
# ---- end of fixed values ----

#: Stands in for a label and question without a single word of letters.
NO_WORD = "option"


class NamingError(ValueError):
    """A variable cannot be named, or two variables share a name."""


def with_other_ending(name: Column, is_boolean: Column, is_text: Column) -> Column:
    """Append the ending for the 'other' option, unless the name already has it."""

    def ended(ending: str) -> Column:
        return F.when(name.endswith(ending), name).otherwise(F.concat(name, F.lit(ending)))

    return F.when(is_text, ended(OTHER_TEXT)).when(is_boolean, ended(OTHER)).otherwise(name)


def is_named_by_rule(count: Column, is_boolean: Column, is_text: Column) -> Column:
    """Variables whose name needs no word: alone in their question, or the other option."""
    other = (F.col("question_type") == MULTIPLE_CHOICE_OTHER) & (is_boolean | is_text)
    return (count == 1) | other


def _first_uses(words: Column) -> Column:
    """For every word of an array, whether it is the first of its kind.

    Sorting brings equal words together, the earliest first; sorting by place brings
    them back.
    """
    placed = F.array_sort(
        F.transform(words, lambda word, i: F.struct(word.alias("word"), i.alias("place")))
    )

    def marked(in_order: Column) -> Column:
        return F.transform(
            in_order,
            lambda one, i: F.struct(
                one["place"].alias("place"),
                (~F.get(in_order, i - 1)["word"].eqNullSafe(one["word"])).alias("first"),
            ),
        )

    return F.array_sort(bind(placed, marked))["first"]


def name_questions(questions: DataFrame) -> DataFrame:
    """Give every element of ``variables`` its name as ``id``, the raw one as ``original_id``.

    A word already used in the question is followed by a mark no word contains and the
    variable's place in letters, which cannot meet another name.
    """
    base = F.concat(F.lit("Q"), F.col("question_position").cast("string"))

    def word(v: Column) -> Column:
        chosen = F.coalesce(
            naming_word(v["label"]), naming_word(F.col("question_text")), F.lit(NO_WORD)
        )
        by_rule = is_named_by_rule(
            F.col("variable_count"), v["is_other_boolean"], v["is_other_text"]
        )
        return F.when(~by_rule, chosen)

    def named(words: Column, first_uses: Column) -> Column:
        def name(v: Column, i: Column) -> Column:
            chosen = F.get(words, i)
            # "other" is taken where there is an other option
            taken = (F.col("question_type") == MULTIPLE_CHOICE_OTHER) & (chosen == OTHER[1:])
            suffix = numbered_word(chosen, F.get(first_uses, i) & ~taken, i)
            by_rule = with_other_ending(base, v["is_other_boolean"], v["is_other_text"])
            return F.coalesce(F.concat(base, F.lit("_"), suffix), by_rule)

        return F.transform(
            "variables",
            lambda v, i: v.withField("original_id", v["id"]).withField("id", name(v, i)),
        )

    words = F.transform("variables", word)
    return questions.withColumn(
        "variables",
        bind(words, lambda w: bind(_first_uses(w), lambda first: named(w, first))),
    )


def use_names(metadata: DataFrame, names: DataFrame) -> DataFrame:
    """Replace ``id`` by a given name where there is one, by raw name.

    ``names`` is (survey_id, original_id, id) with one row per variable: names chosen by
    hand, or those of an earlier wave, whose columns keep their name when a label is
    reworded. Both sides are as long as the metadata and their keys are unique: they are
    shuffled and merged, without a hot key.
    """
    given = names.select("survey_id", "original_id", F.col("id").alias("given_id"))
    return (
        metadata.join(given.hint("merge"), ["survey_id", "original_id"], "left")
        .withColumn("id", F.coalesce("given_id", "id"))
        .drop("given_id")
    )


def number_variables(variables: DataFrame) -> DataFrame:
    """The variables of every question in order, each with its place and their number."""
    return variables.select(
        "survey_id",
        "question_id",
        "id",
        F.col("variable_position").alias("place"),
        F.col("variable_count").alias("variables_in_question"),
    )


def variables_per_question(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("survey_id", "question_id").agg(F.count("id").alias("var_count"))


def duplicate_ids(metadata: DataFrame, column: str = "id") -> DataFrame:
    """Names used more than once in their survey."""
    return (
        metadata.groupBy("survey_id", column)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def raw_names_left() -> Column:
    """A name that still looks like a raw one: V with a digit among the next two characters."""
    name = F.col("id")
    return name.startswith(RAW_NAME_START) & F.substring(name, 2, 2).rlike("[0-9]")


def lacks_label() -> Column:
    """A variable in need of a word whose label is blank."""
    by_rule = is_named_by_rule(
        F.col("variable_count"), F.col("is_other_boolean"), F.col("is_other_text")
    )
    return ~by_rule & is_blank(F.col("label"))


def require_unique_names(metadata: DataFrame) -> None:
    """Raise when a readable or a raw name occurs twice in a survey; one shuffle for both."""
    both = metadata.select(
        "survey_id",
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("kind"), F.col(c).alias("id")) for c in NAME_COLUMNS]
            )
        ),
    )
    counted = both.groupBy("survey_id", "kind", "id").agg(F.count(F.lit(1)).alias("count"))
    problem = F.concat("kind", F.lit(" "), "id", F.lit(" in survey "), "survey_id")
    raise_if_any(counted.where("count > 1"), problem, NamingError, "used more than once:")


def require_named(metadata: DataFrame) -> None:
    """Raise when a variable kept its raw name or had to be named without a label."""
    problem = F.when(raw_names_left(), F.lit("raw name left")).when(
        lacks_label(), F.lit("no label to name it by")
    )
    found = metadata.select("survey_id", "id", "original_id", problem.alias("problem"))
    told = F.concat(
        "original_id", F.lit(" ("), "id", F.lit(") in survey "), "survey_id", F.lit(": "), "problem"
    )
    raise_if_any(found.where("problem is not null"), told, NamingError, "variables lack a name")
