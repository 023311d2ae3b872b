"""One query per operator, each over whole given tables.

A query takes (session, folder of the tables) and returns a DataFrame. Lists are joined
to text and dates are written out, so that results compare the same on every engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.functions import casting
from wavebook.functions.formatting import list_display, range_display
from wavebook.functions.text import transliterate
from wavebook.operators import (
    analytics,
    clean,
    contract,
    dictionary,
    flatten,
    naming,
    structure,
    validate,
)
from wavebook.plans import inputs, pipeline
from wavebook.schemas import PAGE_TIME_RAW, SurveyColumn
from wavebook.session import new_folder, staged
from wavebook.sources import definitions, dictionary_files, responses, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return add


# ---------------------------------------------------------------- shared inputs


def orders_metadata(spark: SparkSession) -> DataFrame:
    return pipeline.survey_metadata(inputs.orders_definition(spark))


@cache
def orders_contract(spark: SparkSession) -> list[SurveyColumn]:
    times = sum(name.startswith(PAGE_TIME_RAW) for name in inputs.RESPONSE_COLUMNS)
    return contract.compile_contract(orders_metadata(spark), inputs.ORDERS_SURVEY, times)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned responses of all waves, the wave kept in ``load_counter``."""
    raw = inputs.responses_with_wave(spark, folder)
    return clean.clean_responses(raw, orders_contract(spark))


def part_questions(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.classified_questions(inputs.definitions(spark, folder))


def part_variables(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.flatten_questions(part_questions(spark, folder))


def part_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of as many surveys as there are parts."""
    return pipeline.survey_metadata(inputs.definitions(spark, folder))


def document_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of few surveys with very many variables."""
    questions = inputs.document_questions(spark, folder)
    return flatten.explode_variables(naming.name_questions(questions))


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def as_text(table: DataFrame) -> DataFrame:
    """Dates and times written out, everything else as it is."""
    kinds = dict(table.dtypes)
    return table.select(
        [
            clean.quoted(name).cast("string").alias(name)
            if kinds[name] in ("date", "timestamp_ntz")
            else clean.quoted(name)
            for name in table.columns
        ]
    )


# ---------------------------------------------------------------- sources and sinks


@register("read_questions")
def read_questions(spark, folder):
    questions = definitions.read_questions(inputs.definitions(spark, folder))
    return questions.select(
        "survey_id",
        "question_position",
        "question_id",
        "poll_id",
        "page_id",
        "type",
        "anonym",
        "mandatory",
        F.array_size("groups").cast("bigint").alias("groups"),
        F.array_join(F.flatten(F.transform("groups", lambda g: g["varnames"])), "|").alias(
            "varnames"
        ),
    )


@register("normalize_questions")
def normalize_questions(spark, folder):
    questions = definitions.normalize_questions(
        definitions.read_questions(inputs.definitions(spark, folder))
    )

    def texts(maps: Column) -> Column:
        return F.array_join(F.transform(maps, lambda m: F.coalesce(m["de"], F.lit("-"))), "|")

    return questions.select(
        "survey_id", "question_position", F.posexplode("groups").alias("group", "g")
    ).select(
        "survey_id",
        "question_position",
        F.col("group").cast("bigint").alias("group"),
        F.coalesce(F.col("g.name")["de"], F.lit("-")).alias("name"),
        texts(F.col("g.labels")).alias("labels"),
        F.array_join(F.col("g.range").cast("array<bigint>"), "|").alias("range"),
        texts(F.transform("g.items", lambda i: i["name"])).alias("items"),
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """As response files come: '' in quotes, a missing value as nothing, blanks kept."""
    rows.write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@register("read_responses")
def read_responses(spark, folder):
    path = new_folder(spark, "responses")
    write_csv(inputs.responses(spark, folder), path)
    return responses.read_responses(spark, path, multi_line=False).withColumnRenamed(
        "V12.1", "V12_1"
    )


@register("read_responses_line_breaks")
def read_responses_line_breaks(spark, folder):
    path = new_folder(spark, "responses")
    texts = inputs.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("vID"), F.col("text").alias("V1")
    )
    write_csv(texts, path)
    return responses.read_responses(spark, path).select(
        "vID", F.md5("V1").alias("text_md5"), F.length("V1").cast("bigint").alias("characters")
    )


@register("read_responses_split")
def read_responses_split(spark, folder):
    """The same files read by ranges, whatever their size."""
    path = new_folder(spark, "responses")
    texts = inputs.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("vID"), F.col("text").alias("V1")
    )
    write_csv(texts, path)
    return responses.read_responses(spark, path, split_above=0).select(
        "vID", F.md5("V1").alias("text_md5"), F.length("V1").cast("bigint").alias("characters")
    )


def stored_orders(spark: SparkSession, folder: str) -> tables.SurveyTables:
    """All waves but the last written in one pass, the last one added to them."""
    store = tables.SurveyTables(spark, f"orders_{uuid.uuid4().hex}", new_folder(spark, "tables"))
    waves = cleaned(spark, folder)
    last = tables.max_wave(inputs.responses_with_wave(spark, folder)).first().max_counter
    newest = F.col("load_counter") == F.lit(last)
    store.write_backfill(waves.where(~newest), orders_metadata(spark))
    store.write_wave(waves.where(newest).drop("load_counter"), last)
    return store


@register("read_definitions")
def read_definitions(spark, folder):
    """Definition files written one per survey and read back."""
    path = definitions.write_definitions(inputs.definitions(spark, folder))
    read = definitions.read_definitions(spark, path)
    whole = F.regexp_replace("definition", "\\n$", "")
    return read.select(F.md5(whole).alias("definition_md5")).groupBy("definition_md5").agg(
        F.count(F.lit(1)).alias("files")
    )


@register("read_response_envelopes")
def read_response_envelopes(spark, folder):
    """Responses as envelopes, one for every thousand orders, read back."""
    path = new_folder(spark, "envelopes")
    raw = inputs.responses(spark, folder)
    names = raw.columns
    # A column is mentioned once, so its expression is worked out once.
    quoted_ = [
        F.coalesce(
            F.concat(F.lit('"'), F.replace(clean.quoted(n), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")
        )
        for n in names
    ]
    lines = raw.select(
        F.floor(F.col("vID").cast("bigint") / 1000).alias("part"), F.concat_ws(",", *quoted_).alias("line")
    )
    body = F.concat_ws("\n", F.lit(",".join(names)), F.array_join(F.collect_list("line"), "\n"))
    # a file for each envelope, all in one folder
    lines.groupBy("part").agg(body.alias("data")).select(F.to_json(F.struct("data"))).write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    return responses.read_response_envelopes(spark, path).withColumnRenamed("V12.1", "V12_1")


@register("load_wave")
def load_wave(spark, folder):
    """Definition and response files loaded as two waves and read back."""
    path = new_folder(spark, "load")
    inputs.orders_definition(spark).select("definition").coalesce(1).write.text(f"{path}/definition")
    read = definitions.read_definitions(spark, f"{path}/definition")
    survey = f"orders_{uuid.uuid4().hex}"
    metadata = pipeline.checked_metadata(read.withColumn("survey_id", F.lit(survey)))
    store = tables.SurveyTables(spark, survey, f"{path}/tables")
    raw = inputs.responses(spark, folder)
    for wave in (0, 1):
        write_csv(raw.where(F.col("vID").cast("bigint") % 2 == wave), f"{path}/wave{wave}")
        answers = responses.read_responses(spark, f"{path}/wave{wave}", multi_line=False)
        pipeline.load_wave(store, metadata, answers)
    return store.results().groupBy("load_counter").agg(
        F.count(F.lit(1)).alias("responses"),
        F.sum("Q4").alias("branches"),
        F.count("Q5").alias("chosen"),
        F.sum(F.col("Q9").cast("double")).alias("kilometers"),
    )


@register("write_wave")
def write_wave(spark, folder):
    return (
        stored_orders(spark, folder)
        .results()
        .groupBy("load_counter")
        .agg(
            F.count(F.lit(1)).alias("responses"),
            F.sum("Q4").alias("branches"),
            F.count("Q5").alias("chosen"),
            F.count_if(F.col("Q6_other")).alias("others"),
        )
    )


@register("append_wave")
def append_wave(spark, folder):
    store = stored_orders(spark, folder)
    return as_text(store.results().select("load_counter", "id", "start", "Q2", "Q4", "Q5", "Q3_katalog", "Q9"))


@register("read_table")
def read_table(spark, folder):
    cleaned(spark, folder).createOrReplaceTempView("stored_responses")
    return tables.read_table(
        spark,
        "select Q5, count(*) as answers, avg(Q2) as mean from stored_responses "
        "where load_counter >= :since and Q5 is not null group by Q5",
        since=2,
    )


@register("free_sql")
def free_sql(spark, folder):
    cleaned(spark, folder).createOrReplaceTempView("stored_responses")
    return tables.read_table(
        spark,
        "select load_counter, Q6_other, count(*) as answers, max(Q4) as most_branches "
        "from stored_responses group by load_counter, Q6_other",
    )


@register("write_dictionary")
def write_dictionary(spark, folder):
    path = new_folder(spark, "dictionary")
    metadata = staged(document_metadata(spark, folder), "metadata", compression="zstd")
    dictionary_files.write_dictionary(metadata, path)
    lines = spark.read.schema("value string, survey_id string").text(path)
    return lines.groupBy("survey_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("value").startswith("### ")).alias("sections"),
        F.count_if(F.col("value").startswith("| Q")).alias("rows"),
        F.sum(F.length("value")).alias("characters"),
    )


# ---------------------------------------------------------------- rows and columns


@register("filter_completed")
def filter_completed(spark, folder):
    raw = inputs.responses(spark, folder)
    return clean.filter_completed(raw).select("vID", "vCOMPLETED")


@register("filter_non_empty")
def filter_non_empty(spark, folder):
    raw = inputs.responses(spark, folder)
    return clean.filter_non_empty(raw).select("vID", "V8", "V13", "V15")


@register("drop_columns")
def drop_columns(spark, folder):
    return clean.drop_columns(inputs.responses(spark, folder)).withColumnRenamed("V12.1", "V12_1")


@register("rename_from_metadata")
def rename_from_metadata(spark, folder):
    renames = {column.raw_name: column.name for column in orders_contract(spark)}
    raw = clean.drop_columns(inputs.responses(spark, folder))
    return clean.rename_columns(raw, renames)


@register("add_wave")
def add_wave(spark, folder):
    raw = inputs.responses(spark, folder).select("vID", "vDATE")
    return clean.add_wave(raw, 3)


@register("decode_single_choice")
def decode_single_choice(spark, folder):
    column = {c.raw_name: c for c in orders_contract(spark)}["V9"]
    raw = inputs.responses(spark, folder)
    return raw.select(
        "vID", casting.decode(F.col("V9"), column.codes, column.labels).alias("decoded")
    )


@register("decode_long_code_book")
def decode_long_code_book(spark, folder):
    """The join form: order keys' customers as codes, the customer table as code book."""
    book = (
        inputs.table(spark, folder, "customer")
        .select(
            F.lit("orders").alias("survey_id"),
            F.lit("customer").alias("id"),
            F.array(F.col("c_custkey").cast("string")).alias("possible_values_codes"),
            F.array("c_name").alias("possible_values_labels"),
        )
    )
    raw = inputs.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("x"), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer"),
    )
    return clean.decode_from_table(raw, "customer", "orders", book)


@register("decode_long")
def decode_long(spark, folder):
    answers = inputs.responses(spark, folder).select(
        "vID",
        F.lit(inputs.ORDERS_SURVEY).alias("survey_id"),
        F.lit("Q5").alias("id"),
        F.col("V9").alias("value"),
    )
    return clean.decode_long(answers, orders_metadata(spark)).select("vID", "value", "label")


@register("clean_responses")
def clean_responses(spark, folder):
    return as_text(cleaned(spark, folder))


# ---------------------------------------------------------------- casts


def cast_query(name: str, raw_name: str, cast: Callable[[Column], Column]) -> None:
    @register(name)
    def run(spark, folder):
        raw = inputs.responses(spark, folder)
        return as_text(raw.select("vID", cast(F.col(raw_name)).alias("value")))


cast_query("cast_boolean", "V6", casting.to_boolean)
cast_query("cast_integer", "V8", lambda c: casting.to_integer(c, "V8"))
cast_query("cast_double", "vDURATION", lambda c: casting.to_double(c, "vDURATION"))
cast_query("cast_date", "vDATE", lambda c: casting.to_date(c, "vDATE"))
cast_query("cast_timestamp", "vEND", lambda c: casting.to_timestamp(c, "vEND"))


@register("cast_enum")
def cast_enum(spark, folder):
    column = {c.raw_name: c for c in orders_contract(spark)}["V9"]
    raw = inputs.responses(spark, folder)
    return raw.select("vID", clean.cleaned_value(F.col("V9"), column).alias("value"))


# ---------------------------------------------------------------- definitions


@register("classify_question")
def classify_question(spark, folder):
    return part_questions(spark, folder).select(
        "survey_id", "question_position", "type", "question_type"
    )


@register("question_violations")
def question_violations(spark, folder):
    return flatten.question_violations(part_questions(spark, folder))


@register("german_text_required")
def german_text_required(spark, folder):
    return (
        part_questions(spark, folder)
        .where(flatten.lacks_german_text())
        .select("survey_id", "question_position", "question_id")
    )


VARIABLE_COLUMNS = [
    "survey_id",
    "question_id",
    "group_id",
    "id",
    "question_position",
    "question_type",
    "schema_variable_type",
    "question_text",
    "label",
    "range_min",
    "range_max",
    "possible_values_codes",
    "possible_values_labels",
    "scale_labels",
    "is_other_boolean",
    "is_other_text",
    "variable_position",
    "variable_count",
]
LISTS = {"possible_values_codes", "possible_values_labels", "scale_labels"}


def shown(variables: DataFrame, columns: list[str]) -> DataFrame:
    return variables.select([joined(c) if c in LISTS else F.col(c) for c in columns])


def flatten_query(name: str, condition: str) -> None:
    @register(name)
    def run(spark, folder):
        return shown(part_variables(spark, folder).where(condition), VARIABLE_COLUMNS)


flatten_query("flatten_input_single", "question_type like 'input_single_%'")
flatten_query("flatten_input_multiple", "question_type like 'input_multiple_%'")
flatten_query("flatten_matrix", "question_type = 'matrix'")
flatten_query("flatten_single_choice", "question_type = 'single_choice'")
flatten_query("flatten_multiple_choice", "question_type = 'multiple_choice'")
flatten_query("flatten_multiple_choice_other", "question_type = 'multiple_choice_other'")
flatten_query("flatten_scale", "question_type = 'scale'")
flatten_query("flatten_questions", "true")


@register("default_columns")
def default_columns(spark, folder):
    extras = ["label", "range_min", "range_max", *sorted(LISTS)]
    variables = part_variables(spark, folder)
    return variables.groupBy("question_type").agg(
        *[F.count_if(F.col(name).isNull()).alias(f"no_{name}") for name in extras],
        F.count_if(~F.col("is_other_boolean")).alias("not_other_boolean"),
        F.count_if(~F.col("is_other_text")).alias("not_other_text"),
    )


@register("absolute_position")
def absolute_position(spark, folder):
    return definitions.read_questions(inputs.definitions(spark, folder)).select(
        "survey_id", "question_id", "question_position"
    )


@register("page_number")
def page_number(spark, folder):
    return definitions.read_questions(inputs.definitions(spark, folder)).select(
        "survey_id", "question_id", "page_id", "page_number"
    )


@register("join_question_text")
def join_question_text(spark, folder):
    """Line items as variables of orders: the many-to-one join on its own."""
    variables = inputs.table(spark, folder, "lineitem").select(
        F.lit("orders").alias("survey_id"),
        F.col("l_orderkey").alias("question_id"),
        F.concat(F.lit("V"), "l_linenumber").alias("id"),
    )
    texts = inputs.table(spark, folder, "orders").select(
        F.lit("orders").alias("survey_id"),
        F.col("o_orderkey").alias("question_id"),
        F.col("o_orderpriority").alias("text"),
    )
    return flatten.join_question_text(variables, texts).select("question_id", "id", "question_text")


# ---------------------------------------------------------------- naming

NAME_COLUMNS = ["survey_id", "question_position", "original_id", "id"]


@register("name_single")
def name_single(spark, folder):
    return part_metadata(spark, folder).where("variable_count = 1").select(*NAME_COLUMNS)


@register("name_multi")
def name_multi(spark, folder):
    return document_metadata(spark, folder).select(*NAME_COLUMNS)


@register("name_multi_many_surveys")
def name_multi_many_surveys(spark, folder):
    return part_metadata(spark, folder).where("variable_count > 1").select(*NAME_COLUMNS)


@register("name_other")
def name_other(spark, folder):
    return (
        part_metadata(spark, folder)
        .where("question_type = 'multiple_choice_other' and (is_other_boolean or is_other_text)")
        .select(*NAME_COLUMNS)
    )


@register("transliterate")
def transliterate_texts(spark, folder):
    return inputs.table(spark, folder, "documents").select(
        "doc_id", F.md5(transliterate(F.col("text"))).alias("text_md5")
    )


@register("keep_original_id")
def keep_original_id(spark, folder):
    """Names of an earlier load win over new ones; variables without one keep theirs."""
    # Named and raw variables come from the same questions: read twice, so they are stored first.
    questions = staged(flatten.question_variables(part_questions(spark, folder)), "questions")
    metadata = flatten.explode_variables(naming.name_questions(questions))
    earlier = (
        flatten.explode_variables(questions)
        .where("variable_position = 1")
        .select("survey_id", F.col("id").alias("original_id"), F.concat(F.lit("old_"), "id").alias("id"))
    )
    return naming.use_names(metadata, earlier).select(*NAME_COLUMNS)


@register("group_variables")
def group_variables(spark, folder):
    return naming.number_variables(document_metadata(spark, folder))


@register("variables_per_question")
def variables_per_question(spark, folder):
    return naming.variables_per_question(document_metadata(spark, folder))


@register("duplicate_ids")
def duplicate_ids(spark, folder):
    """Line items as variables: the same part ordered twice is a name used twice."""
    variables = inputs.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("survey_id"),
        F.concat(F.lit("V"), "l_partkey").alias("id"),
    )
    return naming.duplicate_ids(variables)


@register("no_raw_names_left")
def no_raw_names_left(spark, folder):
    """Raw names next to readable ones: only the raw ones are found."""
    metadata = part_metadata(spark, folder)
    mixed = metadata.withColumn(
        "id",
        F.when(F.col("question_position") % 2 == 0, F.col("original_id")).otherwise(F.col("id")),
    )
    return mixed.where(naming.raw_names_left()).select("survey_id", "question_position", "id")


# ---------------------------------------------------------------- waves and structure


def changed_metadata(metadata: DataFrame) -> DataFrame:
    """The next wave's definition: a variable gone, one renamed, one of another type."""
    key = F.col("survey_id").cast("bigint")
    return (
        metadata.where(~((key % 20 == 0) & (F.col("original_id") == "V31")))
        .withColumn(
            "original_id",
            F.when((key % 30 == 0) & (F.col("original_id") == "V5"), "V5x").otherwise(
                F.col("original_id")
            ),
        )
        .withColumn(
            "question_type",
            F.when((key % 50 == 0) & (F.col("question_type") == "scale"), "matrix").otherwise(
                F.col("question_type")
            ),
        )
    )


@register("structure_diff")
def structure_diff(spark, folder):
    # Compared with a change of itself: read twice, so it is stored first.
    variables = part_variables(spark, folder).withColumnRenamed("id", "original_id")
    stored = staged(variables.select("survey_id", "original_id", "question_type"), "variables")
    return structure.structure_diff(stored, changed_metadata(stored))


@register("structure_diff_copies")
def structure_diff_copies(spark, folder):
    """Lists with repeats: shipped line items against the open ones, per order."""
    items = inputs.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("survey_id"),
        F.col("l_suppkey").cast("string").alias("original_id"),
        F.col("l_linenumber").cast("string").alias("question_type"),
        "l_linestatus",
    )
    return structure.structure_diff(
        items.where("l_linestatus = 'F'"), items.where("l_linestatus = 'O'")
    )


@register("next_wave")
def next_wave(spark, folder):
    return tables.next_wave(cleaned(spark, folder))


@register("next_wave_stored")
def next_wave_stored(spark, folder):
    return tables.next_wave(stored_orders(spark, folder).results())


@register("max_wave")
def max_wave(spark, folder):
    return tables.max_wave(inputs.responses_with_wave(spark, folder))


# ---------------------------------------------------------------- analytics


@register("frequency_distribution")
def frequency_distribution(spark, folder):
    return analytics.frequency_distribution(cleaned(spark, folder), "Q5")


@register("frequency_distribution_with_nulls")
def frequency_distribution_with_nulls(spark, folder):
    return analytics.frequency_distribution(cleaned(spark, folder), "Q5", include_nulls=True)


@register("frequency_distribution_free_text")
def frequency_distribution_free_text(spark, folder):
    return analytics.frequency_distribution(cleaned(spark, folder), "Q7_rampe")


@register("frequency_distribution_flag")
def frequency_distribution_flag(spark, folder):
    return analytics.frequency_distribution(
        inputs.table(spark, folder, "lineitem"), "l_returnflag"
    )


@register("frequency_distribution_event")
def frequency_distribution_event(spark, folder):
    return analytics.frequency_distribution(inputs.table(spark, folder, "events"), "event_type")


def trend_query(name: str, variable: str, aggregation: str) -> None:
    @register(name)
    def run(spark, folder):
        trend = analytics.wave_trend(cleaned(spark, folder), variable, aggregation)
        if aggregation in ("STDDEV", "VARIANCE"):
            return trend.withColumn("avg_value", F.round("avg_value", 6))
        return trend


trend_query("wave_trend", "Q2", "AVG")
trend_query("wave_trend_sum", "Q4", "SUM")
trend_query("wave_trend_min", "Q4", "MIN")
trend_query("wave_trend_max", "Q4", "MAX")
trend_query("wave_trend_count", "Q1_rechnung", "COUNT")
trend_query("wave_trend_stddev", "Q4", "STDDEV")
trend_query("wave_trend_variance", "Q4", "VARIANCE")


@register("item_distribution")
def item_distribution(spark, folder):
    return analytics.item_distribution(inputs.table(spark, folder, "lineitem"), "l_quantity")


@register("item_distribution_matrix")
def item_distribution_matrix(spark, folder):
    return analytics.item_distribution(cleaned(spark, folder), "Q1_freundlich")


@register("share_of_total")
def share_of_total(spark, folder):
    shares = analytics.frequency_distribution(
        inputs.table(spark, folder, "orders"), "o_orderpriority"
    )
    return shares.select("response", "percentage")


@register("frequency_all_variables")
def frequency_all_variables(spark, folder):
    return analytics.frequency_all_variables(
        cleaned(spark, folder), list(inputs.ORDERS_NAMES.values())
    )


@register("trend_all_variables")
def trend_all_variables(spark, folder):
    numeric = ["Q1_verpackung", "Q1_freundlich", "Q1_rechnung", "Q2", "Q4", "Q9"]
    return analytics.trend_all_variables(cleaned(spark, folder), numeric)


@register("count_questions")
def count_questions(spark, folder):
    return analytics.count_questions(part_metadata(spark, folder))


@register("distinct_ordered")
def distinct_ordered(spark, folder):
    rows = contract.contract_rows(part_variables(spark, folder).withColumn("original_id", F.col("id")))
    return rows.where("allowed is not null").select(
        "survey_id", "column_name", F.array_join("allowed", "|").alias("allowed")
    )


@register("distinct_question_ids_sorted")
def distinct_question_ids_sorted(spark, folder):
    return dictionary.question_ids_in_order(document_metadata(spark, folder))


@register("question_metadata")
def question_metadata(spark, folder):
    found = analytics.question_metadata(part_metadata(spark, folder), 3)
    return found.withColumns(
        {
            "possible_values_labels": joined("possible_values_labels"),
            "scale_labels": joined("scale_labels"),
        }
    )


@register("matrix_metadata")
def matrix_metadata(spark, folder):
    found = analytics.matrix_metadata(part_metadata(spark, folder))
    return found.withColumn("scale_labels", joined("scale_labels"))


@register("find_variables")
def find_variables(spark, folder):
    found = analytics.find_variables(part_metadata(spark, folder), "single_choice", 25)
    return found.withColumn("possible_values_labels", joined("possible_values_labels"))


# ---------------------------------------------------------------- dictionary


@register("dictionary_frame")
def dictionary_frame(spark, folder):
    metadata = staged(part_metadata(spark, folder), "metadata")
    return dictionary.ordered_dictionary(dictionary.dictionary_frame(metadata))


@register("range_display")
def range_display_query(spark, folder):
    """Bounds from order prices and customers, each missing now and then."""
    low = F.when(F.col("o_orderkey") % 3 != 0, F.floor("o_totalprice").cast("double"))
    high = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") / 2)
    orders = inputs.table(spark, folder, "orders")
    return orders.select("o_orderkey", range_display(low, high).alias("range"))


@register("list_display")
def list_display_query(spark, folder):
    orders = inputs.table(spark, folder, "orders")
    values = F.array(
        "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))
    )
    shown_ = list_display(F.when(F.col("o_orderkey") % 7 != 0, values))
    return orders.select("o_orderkey", shown_.alias("list"))


@register("dictionary_sections")
def dictionary_sections(spark, folder):
    metadata = staged(part_metadata(spark, folder), "metadata")
    lines = dictionary.dictionary_lines(dictionary.dictionary_frame(metadata))
    return lines.withColumn("part", F.col("part").cast("bigint"))


@register("dictionary_sections_long")
def dictionary_sections_long(spark, folder):
    metadata = staged(document_metadata(spark, folder), "metadata")
    lines = dictionary.dictionary_lines(dictionary.dictionary_frame(metadata))
    return lines.withColumn("part", F.col("part").cast("bigint"))


@register("dictionary_overview")
def dictionary_overview(spark, folder):
    return dictionary.dictionary_overview(document_metadata(spark, folder))


# ---------------------------------------------------------------- checks


@register("build_contract")
def build_contract(spark, folder):
    rows = contract.contract_rows(part_metadata(spark, folder))
    return rows.select(
        "survey_id",
        "column_name",
        "raw_name",
        "type_name",
        "nullable",
        F.array_join("allowed", "|").alias("allowed"),
        "minimum",
        "maximum",
        F.array_join("checks", "|").alias("checks"),
    )


def tightened(spark: SparkSession) -> list[SurveyColumn]:
    """A contract the responses do not meet, so that every check has something to find."""
    changed = []
    for column in orders_contract(spark):
        values = dict(vars(column))
        if column.name == "Q2":
            values.update(minimum=1.0, maximum=5.0)
        if column.name == "Q4":
            values.update(minimum=20.0)
        if column.name == "Q1_rechnung":
            values.update(nullable=False, minimum=None, maximum=1.0)
        if column.name == "Q5":
            values.update(labels=tuple(x for x in column.labels if x != "im Monat"))
        if column.name == "Q3_katalog":
            values.update(type_name="Int64")
        changed.append(SurveyColumn(**values))
    return [*changed, SurveyColumn("pagetime5", "vPAGETIME5", "Int64", nullable=False)]


def report(spark: SparkSession, folder: str) -> DataFrame:
    """All checks; the rows are read once."""
    return validate.validation_report(cleaned(spark, folder), tightened(spark))


def check_query(name: str, check: str) -> None:
    @register(name)
    def run(spark, folder):
        return report(spark, folder).where(F.col("check") == check)


def written(spark: SparkSession, folder: str) -> DataFrame:
    """All checks, counted by the job that writes the rows."""
    rows, contract = cleaned(spark, folder), tightened(spark)
    watched = validate.WatchedRows(rows, validate.contract_checks(rows, contract))
    return validate.written_report(watched, staged(watched.rows, "checked"), contract)


def schema_query(name: str, check: str) -> None:
    """A check of the schema of the rows as written."""

    @register(name)
    def run(spark, folder):
        return written(spark, folder).where(F.col("check") == check)


schema_query("validate_required_columns", "column_present")
schema_query("validate_types", "type")
check_query("validate_not_null", "not_null")
check_query("validate_allowed_values", "allowed_values")
check_query("validate_range", "in_range")
register("validate_collect_all")(report)


register("validate_while_writing")(written)


@register("validate_allowed_values_long")
def validate_allowed_values_long(spark, folder):
    """Orders with their customers' names, some misspelt, against all customers as labels."""
    column = SurveyColumn("customer", "V1", "String", long_code_book=True)
    customers = inputs.table(spark, folder, "customer")
    book = customers.select(
        F.lit("orders").alias("survey_id"),
        F.lit("customer").alias("id"),
        F.array("c_name").alias("possible_values_labels"),
    )
    names = inputs.table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderkey") % 10 == 0, F.lit("nobody"))
        .otherwise(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
        .alias("customer")
    )
    return validate.validation_report(names, [column], book, "orders")


@register("validate_metadata")
def validate_metadata(spark, folder):
    metadata = part_metadata(spark, folder)
    broken = metadata.withColumn(
        "question_text", F.when(F.col("question_position") != 2, F.col("question_text"))
    ).withColumn(
        "id", F.when(F.col("question_position") == 4, F.col("original_id")).otherwise(F.col("id"))
    )
    return validate.metadata_report(broken)
