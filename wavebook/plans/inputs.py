"""Survey data derived from the given tables, as SQL that reads the same everywhere.

The tables hold no surveys. Here ``orders`` plays the response file of one survey,
``part`` holds the definition of one survey per row, and every line of a text in
``documents`` is a label to make a variable name from. Whole tables are used.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.functions.text import is_blank
from wavebook.operators.flatten import variable


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a scan with fewer splits than cores, handed out evenly.

    Taking definitions and texts apart costs far more than moving their few bytes; a
    table of many files has splits enough and is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


# ---------------------------------------------------------------- responses over orders

ORDERS_SURVEY = "orders"


def _answer(expression: str) -> str:
    """An answer column: rows with a key divisible by 97 answered nothing at all."""
    return (
        "case when o_orderkey % 194 = 0 then cast(null as string) "
        f"when o_orderkey % 97 = 0 then '' else {expression} end"
    )


_DAY = "substr(cast(o_orderdate as string), 1, 10)"
_ANSWERS = {
    "V1": "cast(1 + o_orderkey % 4 as string)",
    "V2": "cast(1 + o_custkey % 4 as string)",
    "V3": "case when o_custkey % 9 = 0 then '' else cast(1 + o_custkey % 2 as string) end",
    "V4": "case when o_orderkey % 19 = 0 then '' else cast(o_custkey % 7 as string) end",
    "V5": "case o_orderkey % 3 when 0 then '1' when 1 then '0' else '' end",
    "V6": "case o_custkey % 4 when 0 then '1' when 1 then '0' when 2 then '' "
    "else cast(null as string) end",
    "V7": "case o_custkey % 3 when 0 then '1' else '0' end",
    "V8": "case when o_orderkey % 13 = 0 then '' when o_orderkey % 17 = 0 then ' ' "
    "else concat(' ', cast(1 + o_custkey % 60 as string)) end",
    "V9": "case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then 'z' "
    "when o_orderkey % 23 = 0 then 'im Monat' when o_orderkey % 29 = 0 then ' in der Woche ' "
    "else concat('p', substr(o_orderpriority, 1, 1)) end",
    "V10": "cast(o_orderkey % 2 as string)",
    "V11": "cast(o_custkey % 2 as string)",
    "V12": "case when o_orderkey % 6 = 0 then '1' else '0' end",
    "V12_1": "case when o_orderkey % 6 = 0 then o_orderpriority else '' end",
    "V13": "concat('Tor ', cast(o_custkey as string))",
    "V14": "case when o_orderkey % 4 = 0 then cast(null as string) "
    "else concat('0', cast(o_custkey * 7 as string)) end",
    "V15": "case when o_orderkey % 5 = 0 then '' else concat('Fracht ', cast(o_custkey as string)) end",
    "V16": "concat(cast(o_custkey % 40 as string), '.25')",
}
_SYSTEM = {
    "vID": "cast(o_orderkey as string)",
    "vCOMPLETED": "case when o_orderkey % 101 = 0 then cast(null as string) "
    "when o_orderstatus = 'P' then '0' else '1' end",
    "vFINISHED": "case o_orderstatus when 'F' then '1' else '0' end",
    "vDURATION": "concat(cast(o_custkey % 900 as string), '.5')",
    "vQUOTE": "concat('Q', cast(o_orderkey % 4 as string))",
    "vSTART": f"concat({_DAY}, ' 10:00:00')",
    "vEND": f"concat({_DAY}, ' 10:', lpad(cast(o_custkey % 60 as string), 2, '0'), ':30')",
    "vRUNTIME": "concat(cast(o_custkey % 900 as string), 's')",
    "vPAGETIME1": "cast(o_custkey % 50 as string)",
    "vPAGETIME2": "cast(o_custkey % 70 as string)",
    "vPAGETIME3": "cast(o_custkey % 90 as string)",
    "vPAGETIME4": "cast(o_orderkey % 30 as string)",
    "vDATE": _DAY,
    "vANONYM": "'0'",
    "vLANG": "'de'",
}

#: Raw responses: every column text, plus the year of the order as the wave.
RESPONSE_EXPRESSIONS = [
    *[f"{sql} as {name}" for name, sql in _SYSTEM.items()],
    *[f"{_answer(sql)} as {name}" for name, sql in _ANSWERS.items()],
    "cast(year(o_orderdate) - 1995 as bigint) as load_counter",
]


RESPONSE_COLUMNS = [*_SYSTEM, *(name.replace("_", ".") for name in _ANSWERS)]


def responses_with_wave(spark: SparkSession, folder: str) -> DataFrame:
    """Raw responses of all waves, the wave in ``load_counter``."""
    orders = table(spark, folder, "orders").drop("o_totalprice")
    raw = spread(orders, "o_orderkey").selectExpr(*RESPONSE_EXPRESSIONS)
    return raw.withColumnRenamed("V12_1", "V12.1")


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Raw responses as a response file holds them."""
    return responses_with_wave(spark, folder).drop("load_counter")


def _group(varnames, labels=(), items=(), codes=(), span=(), kind=None, name=()):
    """A question group as JSON files have it: empty maps and ranges arrive as ``[]``."""
    return {
        "name": {"de": name} if name else [],
        "inputType": kind,
        "labels": [{"de": text} if text else [] for text in labels],
        "range": list(span),
        "varnames": list(varnames),
        "codes": list(codes),
        "items": [{"id": str(n), "name": {"de": t} if t else []} for n, t in enumerate(items, 1)],
    }


def _question(number, kind, page, text, *groups):
    return {
        "id": number,
        "pollId": 1,
        "pageId": page,
        "position": number,
        "type": kind,
        "question": {"de": text},
        "groups": list(groups),
    }


#: The definition the responses over ``orders`` belong to: a shipper asks its customers.
ORDERS_DEFINITION = json.dumps(
    [
        _question(
            31, "MATRIX", 7, "Was sagen Sie zur Lieferung?",
            _group(
                ["V1", "V2", "V3"], labels=["ja", "teilweise", "nein", "keine Angabe"],
                items=["Verpackung hielt", "Fahrer war freundlich", "Rechnung stimmte"],
                span=[1, 4, 1],
            ),
        ),
        _question(32, "SCALE", 7, "Wie eilig war es?", _group(["V4"], span=[0, 6, 1])),
        _question(
            33, "CHOICE", 7, "Womit bestellen Sie?",
            _group(["V5", "V6", "V7"], labels=["Katalog", "Fernruf", "Webseite"]),
        ),
        _question(34, "INPUT", 8, "Wie viele Filialen haben Sie?", _group(["V8"], items=["Zahl"], kind="INTEGER")),
        _question(
            35, "CHOICE", 8, "Bis wann brauchen Sie die Ware?",
            _group(
                ["V9"], items=[""], codes=["p1", "p2", "p3", "p4", "p5"],
                labels=["am selben Tag", "in der Woche", "im Monat", "im Quartal", "offen"],
            ),
        ),
        _question(
            36, "CHOICE", 8, "Was fehlt im Sortiment?",
            _group(["V10", "V11", "V12"], labels=["Schrauben", "Dichtungen", "Weiteres"]),
            _group(["V12.1"], items=["Weiteres"], kind="SINGLELINE"),
        ),
        _question(
            37, "INPUT", 9, "Wohin soll die Ware?",
            _group(["V13"], items=["Rampe"], kind="SINGLELINE", name="Rampe am Hof"),
            _group(["V14"], items=["Halle"], kind="SINGLELINE", name="Halle"),
        ),
        _question(38, "INPUT", 9, "Was steht auf dem Frachtbrief?", _group(["V15"], items=["Text"], kind="MULTILINE")),
        _question(39, "INPUT", 9, "Wie weit ist der Weg?", _group(["V16"], items=["Kilometer"], kind="FLOAT")),
    ],
    ensure_ascii=False,
)

#: Names the definition leads to, in column order.
ORDERS_NAMES = {
    "V1": "Q1_verpackung",
    "V2": "Q1_freundlich",
    "V3": "Q1_rechnung",
    "V4": "Q2",
    "V5": "Q3_katalog",
    "V6": "Q3_fernruf",
    "V7": "Q3_webseite",
    "V8": "Q4",
    "V9": "Q5",
    "V10": "Q6_schrauben",
    "V11": "Q6_dichtungen",
    "V12": "Q6_other",
    "V12.1": "Q6_other_text",
    "V13": "Q7_rampe",
    "V14": "Q7_halle",
    "V15": "Q8",
    "V16": "Q9",
}


def orders_definition(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(ORDERS_SURVEY, ORDERS_DEFINITION)], "survey_id string, definition string"
    )


# ---------------------------------------------------------------- definitions over part


def _sql_text(template: str) -> str:
    """SQL for a text in which ``<<expression>>`` parts are filled in per row."""
    pieces = []
    for n, piece in enumerate(template.replace(">>", "<<").split("<<")):
        pieces.append(f"cast({piece} as string)" if n % 2 else f"'{piece}'")
    return "concat(" + ", ".join(pieces) + ")"


_HEAD = '{"id":%d,"pollId":<<p_partkey + 1>>,"pageId":%s,"position":%d,"type":"%s","question":%s,"groups":%s}'
_LABEL_OR_EMPTY = """<<case when p_size % 3 = 0 then '[]' else concat('{"de":"Größe ', cast(p_size as string), '"}') end>>"""


def _definition_question(number: int, page: str, kind: str, groups: str, text: str | None = None) -> str:
    text = text or '{"de":"Frage %d zu <<p_name>>","en":"question"}' % number
    return _sql_text(_HEAD % (number, page, number, kind, text, groups))


_INPUT_KIND = "<<case p_partkey % 4 when 0 then 'SINGLELINE' when 1 then 'MULTILINE' when 2 then 'INTEGER' else 'FLOAT' end>>"
_CODES = """<<case p_partkey % 5 when 0 then '[]' when 1 then '["1","2","3"]' when 2 then '["a"," ","c"]' when 3 then '["1","2"]' else '[""," ",""]' end>>"""
_OTHER = "V2<<p_partkey % 3>>.1"
_DEFINITION_QUESTIONS = [
    _definition_question(
        1, "300", "INPUT",
        '[{"name":[],"inputType":"' + _INPUT_KIND + '","labels":[],"range":[],"varnames":["V1"],'
        '"codes":[],"items":[{"id":"1","name":{"de":"Feld"}}]}]',
    ),
    _definition_question(
        2, "300", "INPUT",
        '[{"name":{"de":"<<p_brand>> Länge"},"inputType":"<<case when p_size % 2 = 0 then \'INTEGER\' else \'SINGLELINE\' end>>",'
        '"labels":[],"range":[],"varnames":["V2"],"codes":[],"items":[{"id":"1","name":[]}]},'
        '{"name":{"de":"<<p_type>>"},"inputType":"<<case when p_size % 2 = 0 then \'INTEGER\' else \'SINGLELINE\' end>>",'
        '"labels":[],"range":[],"varnames":["V3"],"codes":[],"items":[{"id":"2"}]}]',
    ),
    _definition_question(
        3, "100", "CHOICE",
        '[{"name":[],"labels":[{"de":"<<p_name>>"},' + _LABEL_OR_EMPTY + ',{"de":"<<p_type>>"}],'
        '"range":[],"varnames":["V4"],"codes":' + _CODES + ',"items":[{"id":"1","name":[]}]}]',
    ),
    _definition_question(
        4, "<<100 + p_size>>", "CHOICE",
        '[{"name":{},"labels":[{"de":"<<p_type>> grün"},' + _LABEL_OR_EMPTY + ',{"de":"<<p_brand>> grün"}],'
        '"range":[],"varnames":["V5","V6","V7"],"codes":[],"items":[]}]',
    ),
    _definition_question(
        5, "200", "CHOICE",
        '[{"name":{},"labels":[{"de":"<<p_name>>"},{"de":"Straße"},' + _LABEL_OR_EMPTY + '],'
        '"range":[],"varnames":["V20","V21","V22"],"codes":[],"items":[]},'
        '{"name":{},"inputType":"SINGLELINE","labels":[],"range":[],"varnames":["' + _OTHER + '"],'
        '"codes":[],"items":[{"id":"1","name":{"de":"Text"}}]}]',
    ),
    _definition_question(
        6, "<<100 + p_size>>", "MATRIX",
        '[{"name":[],"labels":[{"de":"passt"},' + _LABEL_OR_EMPTY + ',{"de":"passt nicht"}],'
        '"range":<<case when p_partkey % 2 = 0 then \'[]\' else \'[1,5,1]\' end>>,'
        '"varnames":["V30","V31"],"codes":[],'
        '"items":[{"id":"1","name":{"de":"Aussage <<p_brand>>"}},{"id":"2","name":{"de":"Aussage <<p_type>>"}}]}]',
    ),
    _definition_question(
        7, "400", "SCALE",
        '[{"name":[],"labels":[],"range":[0,<<p_size>>,1],"varnames":["V40"],"codes":[],"items":[]}]',
    ),
]
# Some surveys carry a question that breaks a rule.
_BROKEN_QUESTIONS = {
    3: _definition_question(8, "500", "RANKING", "[]"),
    7: _definition_question(
        8, "500", "SCALE",
        '[{"name":[],"labels":[],"range":[0,5,1],"varnames":["V50"],"codes":[],"items":[]}]',
        text='{"en":"no German text"}',
    ),
    9: _definition_question(
        8, "500", "MATRIX",
        '[{"name":[],"labels":[{"de":"nur eins"}],"range":[1,2,1],"varnames":["V50","V51"],'
        '"codes":[],"items":[{"id":"1","name":[]},{"id":"2","name":[]}]}]',
    ),
}

#: One survey definition per part: the JSON text of seven or eight questions.
DEFINITION_EXPRESSIONS = [
    "cast(p_partkey as string) as survey_id",
    "concat('[', "
    + ", ',', ".join(_DEFINITION_QUESTIONS)
    + ", case p_partkey % 10 "
    + " ".join(f"when {n} then concat(',', {sql})" for n, sql in _BROKEN_QUESTIONS.items())
    + " else '' end, ']') as definition",
]


def definitions(spark: SparkSession, folder: str) -> DataFrame:
    """(survey_id, definition), one survey per row of ``part``."""
    parts = spread(table(spark, folder, "part"), "p_partkey")
    return parts.selectExpr(*DEFINITION_EXPRESSIONS)


# ---------------------------------------------------------------- labels over documents


def document_questions(spark: SparkSession, folder: str) -> DataFrame:
    """A question per document with an option per line that is not blank."""
    lines = F.filter(F.split("text", "\n"), lambda line: ~is_blank(line))
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return (
        spread(documents, "doc_id")
        .select(
            F.col("source").alias("survey_id"),
            F.col("doc_id").alias("question_id"),
            (F.col("doc_id") + 1).alias("question_position"),
            F.lit("multiple_choice").alias("question_type"),
            F.col("lang").alias("question_text"),
            lines.alias("lines"),
        )
        .withColumn(
            "variables",
            F.transform(
                "lines",
                lambda line, i: variable(
                    F.concat(F.lit("V"), F.col("question_id"), F.lit("."), i), "Boolean", label=line
                ),
            ),
        )
        .withColumn("variable_count", F.array_size("lines").cast("bigint"))
        .drop("lines")
    )
