"""Toxicity and language: held-out accuracy, what may be learned from, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from awkward import CLASHING, awkward_rows
from pyspark.sql import functions as F

from wavebook.llm import language, toxicity
from wavebook.llm.queries import op6_toxicity, op9_language

SYLLABLES = {
    "aa": "the and ing tion er or".split(),
    "bb": "sch ung ein der ich ü".split(),
    "cc": "ção é ou que ai ç".split(),
}


def texts(seed, count):
    chance = np.random.default_rng(seed)
    rows = []
    for n in range(count):
        lang = ("aa", "bb", "cc")[int(chance.integers(3))]
        some = ["".join(chance.choice(SYLLABLES[lang], int(chance.integers(1, 4)))) for _ in range(int(chance.integers(4, 90)))]
        rows.append((n, " ".join(some), lang))
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    chance = np.random.default_rng(9)
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    for key, text, lang in texts(1, 900):
        insult, group = chance.random() < 0.5, chance.random() < 0.5
        own = text.split()
        for there, word in ((insult, "vilewords"), (group, "groupname")):
            if there:
                own.insert(int(chance.integers(len(own) + 1)), word)
        rows.append((key, " ".join(own), lang if key % 11 else None))
        labels.append((key, int(insult and group), "x"))
    extra = [(10_000 + (k or 0), t, None) for k, t in awkward_rows()] + [(None, None, "aa"), (None, "zz", "bb")]
    labels += [(3, None, "x"), (None, 1, "x"), (99_999, 1, "x"), (5, 7, "x")]
    clash = [c for c in CLASHING if c != "text"]
    frame = spark.createDataFrame(
        [(*r, *["1"] * len(clash)) for r in rows + extra],
        "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in clash),
    )
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, text string").write.parquet(f"{path}/labels.parquet")
    return path, rows, labels, extra


def held(key, parts, part):
    return zlib.crc32(str(key).encode()) % parts == part


def test_toxicity_learns_a_pair(spark, folder):
    path, rows, labels, extra = folder
    got = op6_toxicity(spark, path).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict((k, t) for k, t, _ in labels)
    some = [r for r in got if r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) for r in some)
    assert all(0 <= r.score <= 1 for r in got)
    right = [r.predicted == truth.get(r.doc_id) for r in some if r.held_out and truth.get(r.doc_id) in (0, 1)]
    assert np.mean(right) > 0.95
    rest = [r for r in got if r.doc_id is None]
    assert len(rest) == 2 and not any(r.held_out for r in rest)


def test_toxicity_is_reproducible_and_blind_to_the_held_out(spark, folder):
    path, rows, labels, _ = folder
    documents = spark.read.parquet(f"{path}/documents.parquet")
    table = spark.read.parquet(f"{path}/labels.parquet")
    turned = table.withColumn("toxic", F.when(language.held_out("doc_id", 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = toxicity.fit(documents, table, ~language.held_out("doc_id", 5, 0))
    two = toxicity.fit(documents.repartition(5), turned, ~language.held_out("doc_id", 5, 0))
    assert (one.weights == two.weights).all() and (one.factors == two.factors).all()
    assert len(toxicity.learning_sample(documents, table, F.lit(True), 7).collect()) <= 14


def test_toxicity_without_labels(spark, folder):
    path, *_ = folder
    documents = spark.read.parquet(f"{path}/documents.parquet")
    table = spark.read.parquet(f"{path}/labels.parquet")
    machine = toxicity.fit(documents, table.limit(0), F.lit(True))
    assert toxicity.score(documents, machine).where("score >= 0.5").count() == 0
    assert toxicity.score(documents.limit(0), machine).count() == 0


def test_languages(spark, folder):
    path, rows, _, extra = folder
    got = op9_language(spark, path).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {k: lang for k, _, lang in texts(1, 900)}
    some = [r for r in got if r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in some)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in some if r.held_out]) > 0.97
    odd = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None and r.doc_id >= 10_000}
    assert odd[10_104] == odd[10_105] == odd[10_106] == "und" and odd[10_109] in SYLLABLES


def test_languages_without_labels(spark, folder):
    path, *_ = folder
    documents = spark.read.parquet(f"{path}/documents.parquet")
    network = language.fit(documents.select("text", F.lit(None).cast("string").alias("lang")))
    told = language.identify(documents, network, ["doc_id"])
    assert told.where("lang_pred <> 'und'").count() == 0
    assert language.identify(documents.limit(0), network, ["doc_id"]).count() == 0


def test_copies_count_once_in_the_sample(spark):
    rows = [(f"text {'abcdefghij'[n]}", lang) for n in range(10) for lang in ("aa", "bb")]
    rows += [(text, "aa") for text, lang in rows if lang == "aa" for _ in range(200)]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for most in (10, 4):
        sample = language.training_sample(frame, most, 1)
        for lang in ("aa", "bb"):
            taken = [r.stretches[0] for r in sample if r.lang == lang]
            assert len(taken) == len(set(taken)) == most


def test_windows_cover_whole_texts():
    text = "aé漢" * 1000
    rows = language.windows_of(text)
    assert rows.reshape(-1)[: len(text.encode())].tobytes() == text.encode()
    assert len(rows) == -(-len(text.encode()) // language.WINDOW_BYTES)


def test_look_ups_equal_filters():
    net = language.Network(
        ["x"],
        [np.random.default_rng(w).normal(0, 1, (w, 256, language.FILTERS)).astype(np.float32) for w in language.WIDTHS],
        np.zeros(language.FILTERS * len(language.WIDTHS), np.float32),
        np.zeros((1, 1)),
        np.zeros(1),
    )
    rows = np.random.default_rng(2).integers(0, 256, (5, 40)).astype(np.uint8)
    assert np.allclose(net.best_answers(rows), net.features(rows)[0], atol=1e-5)
