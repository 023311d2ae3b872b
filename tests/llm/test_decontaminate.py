"""Benchmark hits against a plain search; longest matches against all places."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from awkward import awkward_rows, prose

from wavebook.llm import decontaminate
from wavebook.llm.decontaminate import benchmark_hits, clean_documents, longest_matches_report
from wavebook.llm.queries import op10_suffix_decontamination

PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items, window=13):
    out = []
    for key, text in rows:
        own = words(text)
        hit, found = set(), set()
        for name, item in items:
            theirs = words(item)
            width = min(window, len(theirs))
            for at in range(len(theirs) - width + 1 if theirs else 0):
                for n in range(len(own) - width + 1):
                    if own[n : n + width] == theirs[at : at + width]:
                        hit.update(range(n, n + width))
                        found.add("" if name is None else str(name))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(own), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


ITEMS = [
    (1, prose(3, 40)), (10, prose(7, 26)[:120]), (2, prose(9002, 80)), (2, prose(9002, 20)), (30, "one"),
    (31, "é, À 漢字"), (32, None), (33, "..."), (None, prose(12, 30)), (35, "word " * 30), (36, prose(3, 40)),
]


def document_rows():
    rows = awkward_rows()
    rows += [(200, "before " * 40 + prose(3, 40).upper() + " after" * 30), (201, "word " * 14), (202, "word, Word-word " * 9)]
    rows += [(203, prose(3, 40).split(" ", 30)[-1]), (204, " ".join(prose(7, 26).split()[:12]) + " break")]
    rows += [(205, "z " * 600 + "one"), (206, "One")]
    return rows


@pytest.fixture
def tables(spark):
    documents = spark.createDataFrame(
        [(*r, "a", 1) for r in document_rows()], "doc_id long, text string, spans string, n_words int"
    ).repartition(3)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    return documents, items


@pytest.mark.parametrize("block_words", [1 << 17, 30])
@pytest.mark.parametrize("shard_words", [1 << 20, 50])
def test_query(spark, tables, tmp_path, monkeypatch, block_words, shard_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    for name, frame in zip(("documents", "benchmark"), tables):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    got = op10_suffix_decontamination(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(document_rows(), ITEMS)


def test_clean_documents(spark, tables):
    documents, items = tables
    left = clean_documents(documents, items)
    assert left.columns == documents.columns
    bad = [r[0] for r in plain(document_rows(), ITEMS) if r[-1]]
    kept = sorted((r.doc_id for r in left.collect()), key=str)
    assert kept == sorted((k for k, *_, out in plain(document_rows(), ITEMS) if not out), key=str)
    assert bad
    for some, none in ((documents, items.limit(0)), (documents.limit(0), items)):
        assert clean_documents(some, none).count() == some.count()
        assert benchmark_hits(some, none).where("n_hit > 0").count() == 0


def test_longest_matches(spark):
    rows = [(1, "a b c d e f g"), (2, "x c d e f y"), (3, "b c d e f g h i"), (4, None), (5, "a b c")]
    items = [("p", "c d e f g h"), ("q", "zz a b q"), ("r", "")]
    found = longest_matches_report(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(2),
        spark.createDataFrame(items, "item_id string, text string"),
        least=2,
    ).collect()
    got = {(r.item_id, r.item_word): (r.length, r.doc_id, r.doc_word) for r in found}
    assert got == {
        ("p", 0): (6, 3, 1), ("p", 1): (5, 3, 2), ("p", 2): (4, 3, 3), ("p", 3): (3, 3, 4), ("p", 4): (2, 3, 5),
        ("q", 1): (2, 1, 0),
    }


def test_suffix_array_is_sorted():
    chance = np.random.default_rng(3)
    numbers = chance.integers(0, 4, 300)
    order, first = decontaminate.suffix_array(numbers, 16)
    suffixes = [numbers[n:].tolist() for n in order]
    cut = [s[: s.index(0)] if 0 in s else s for s in suffixes]
    assert [c[:16] for c in cut] == sorted(c[:16] for c in cut)
    assert sorted(order.tolist()) == np.flatnonzero(numbers).tolist()
    assert (first == numbers[order]).all()
