"""A library's survey with every question type, and four raw responses."""

from __future__ import annotations

import json


def group(varnames, labels=(), items=(), codes=(), span=None, kind=None, name=None):
    made = {
        "name": name or {},
        "labels": list(labels),
        "varnames": list(varnames),
        "codes": list(codes),
        "items": list(items),
    }
    if span is not None:
        made["range"] = span
    if kind is not None:
        made["inputType"] = kind
    return made


def question(number, kind, *groups, page=1, text="Frage"):
    return {
        "id": number,
        "pollId": 5,
        "pageId": page,
        "position": 1,
        "type": kind,
        "question": {"de": text},
        "groups": list(groups),
    }


def item(text=None):
    return {"id": "1", "name": {"de": text}} if text else {"id": "1"}


def de(*texts):
    return [{"de": text} if text else {} for text in texts]


QUESTIONS = [
    question(1, "SCALE", group(["V1"], span=[1, 7, 1]), page=40),
    question(
        2,
        "CHOICE",
        group(["V2", "V3", "V4", "V5"], labels=de("Romane", "Comics", "Zeitungen", "Landkarten")),
        page=40,
    ),
    question(3, "INPUT", group(["V6"], items=[item("Besuche im Jahr")], kind="INTEGER"), page=40),
    question(
        4,
        "MATRIX",
        group(
            ["V7", "V8"],
            labels=de("immer", "oft", "selten", "nie"),
            items=[item("Regale übersichtlich"), item("Öffnungszeiten reichen")],
            span=[1, 4, 1],
        ),
        page=50,
    ),
    question(
        5,
        "CHOICE",
        group(["V9"], labels=de("Fahrrad", "Bus und Bahn", "Auto"), codes=["a", "b", "c"], items=[item()]),
        page=50,
    ),
    question(6, "INPUT", group(["V10"], items=[item("Wunsch")], kind="MULTILINE"), page=60),
    question(
        7,
        "CHOICE",
        group(["V11", "V12", "V13"], labels=de("Lärm", "Kälte", "Sonstiges")),
        group(["V13.1"], items=[item("und zwar")], kind="SINGLELINE"),
        page=60,
    ),
    question(
        8,
        "INPUT",
        group(["V14"], items=[item("a")], kind="SINGLELINE", name={"de": "Straße"}),
        group(["V15"], items=[item("b")], kind="SINGLELINE", name={"de": "Ort"}),
        group(["V16"], items=[item("c")], kind="SINGLELINE", name={"de": "Land"}),
        page=70,
    ),
    question(9, "INPUT", group(["V17"], items=[item("Entfernung")], kind="FLOAT"), page=70),
]
PAGE_TIMES = 4


def raw_row(number, **changes):
    row = {
        "vID": str(number),
        "vCOMPLETED": "1",
        "vFINISHED": "1",
        "vDURATION": "301.25",
        "vQUOTE": "rot",
        "vSTART": "2025-05-06 08:15:00",
        "vEND": "2025-05-06 08:20:01",
        "vRUNTIME": "301 Sekunden",
        "vPAGETIME1": "112",
        "vPAGETIME2": "90",
        "vPAGETIME3": "64",
        "vPAGETIME4": "35",
        "vDATE": "2025-05-06",
        "vANONYM": "1",
        "vLANG": "de",
        "V1": "5",
        "V2": "1",
        "V3": "0",
        "V4": "1",
        "V5": "",
        "V6": "12",
        "V7": "2",
        "V8": "4",
        "V9": "b",
        "V10": "mehr Licht",
        "V11": "0",
        "V12": "1",
        "V13": "0",
        "V13.1": "",
        "V14": "Ringweg 3",
        "V15": "Ulm",
        "V16": "",
        "V17": "2.5",
    }
    row.update(changes)
    return row


ROWS = [
    raw_row(1),
    raw_row(2, V1="3", V2="0", V6="40", V7="1", V9="a"),
    raw_row(3, V1="6", V6="3", V9="c", V13="1", vFINISHED="0") | {"V13.1": "Zugluft"},
    raw_row(4, V1="6", V2="0", V6="25", V10="", V17=""),
]


def raw_frame(spark, rows):
    names = list(raw_row(0))
    schema = ", ".join(f"`{name}` string" for name in names)
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)


def definition_frame(spark, questions, survey="demo"):
    return spark.createDataFrame(
        [(survey, json.dumps(questions))], "survey_id string, definition string"
    )
