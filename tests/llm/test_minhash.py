"""Near duplicates against all pairs of full sets."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from awkward import awkward_rows, prose

from wavebook.llm import graph, minhash
from wavebook.llm.common import shingle_set
from wavebook.llm.minhash import band_keys, keep_one, near_duplicates, signature
from wavebook.llm.queries import op7_circulant_minhash


def shingles(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    width = min(size, len(words))
    return {tuple(words[n : n + width]) for n in range(len(words) - width + 1)} if words else set()


def plain(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for n, (key, _) in enumerate(rows):
        own = [rows[m][0] for m in range(len(rows)) if root(m) == root(n) and rows[m][0] is not None]
        component = min(own) if own else None
        out.append((key, len(sets[n]), component, key == component))
    return sorted(out, key=str)


def copies(seed, groups=12, members=14):
    """Groups of texts with more and fewer edits, chains, and thresholds met exactly."""
    chance = random.Random(seed)
    rows = []
    for g in range(groups):
        words = prose(seed * 1000 + g, chance.choice([4, 9, 40, 120])).split()
        for m in range(members):
            own = list(words)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 3, 5])):
                own[chance.randrange(len(own))] = f"w{chance.randrange(10**6)}"
            if chance.random() < 0.3:
                words = own
            rows.append((g * 100 + m, " ".join(own)))
    exact = [f"u{n}" for n in range(10)]
    rows += [(5000, " ".join(exact)), (5001, " ".join(exact[:9])), (5002, " ".join(exact + ["v"] * 2))]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, small", [(2, minhash.SMALL), (2, 2), (5, 4)])
def test_as_all_pairs(spark, monkeypatch, words, small):
    """Also where almost all buckets count as large, with few hubs a round and small cells."""
    monkeypatch.setattr(minhash, "SMALL", small)
    if small == 2:
        monkeypatch.setattr(minhash, "HUBS", 3)
        monkeypatch.setattr(minhash, "CELL", 4)
    rows = copies(words) + awkward_rows()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    found = near_duplicates(frame.repartition(3), words=words).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, words)


def test_query(spark, documents, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    found = op7_circulant_minhash(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(awkward_rows(), 2)


def test_keep_one(spark, documents, no_documents):
    left = keep_one(documents)
    assert left.columns == documents.columns
    told = plain(awkward_rows(), 5)
    once = Counter(r.doc_id for r in left.collect())
    sizes = {k: len(shingles(t, 5)) for k, t in awkward_rows() if k == 103}
    kept = Counter(k for k, *_, own in told if own)
    assert sizes[103] and kept.pop(103) == 2 and once.pop(103) == 1
    assert once == kept
    assert keep_one(no_documents).count() == 0 and near_duplicates(no_documents).count() == 0


def test_signature_is_circulant():
    one = shingle_set(prose(1, 400), 2)
    values = signature(one, 50)
    assert (signature(one, 20) == values[:20]).all()
    two = np.union1d(one, shingle_set(prose(2, 60), 2))
    same = np.mean(signature(two, 400) == signature(one, 400))
    assert abs(same - len(one) / len(two)) < 0.08
    assert len(set(band_keys(one).tolist())) == 40


def test_groups_settle_without_all_pairs(spark):
    """Members that the first hub does not reach are still compared with all others."""
    near = {frozenset(p) for p in [(2, 3), (3, 4), (5, 6), (7, 1), (9, 10), (10, 2)]}
    rows = [("g", n) for n in range(1, 12)] + [("h", 20), ("h", 21)]
    members = graph.groups_of(spark.createDataFrame(rows, "key string, node long"))
    asked = []

    def confirm(members):
        some = [(r.a, r.b) for r in graph.hub_pairs(members).collect()]
        asked.extend(some)
        kept = [p for p in some if frozenset(p) in near] or [(0, 0)]
        return spark.createDataFrame(kept, "a long, b long")

    found, reached = graph.settled(members, confirm, hubs=2)
    assert len(asked) == len({frozenset(p) for p in asked})
    label = {r.node: r.component for r in reached.collect()}
    assert label[2] == label[3] == label[4] == label[9] == label[10] == 2
    assert label[5] == label[6] == 5 and label[7] == label[1] == 1


def test_components(spark):
    chance = random.Random(8)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)]
    edges += [(n, n + 1) for n in range(400, 460)] + [(700, n) for n in range(701, 760)] + [(None, 3), (5, 5)]
    parent = {}

    def root(n):
        while parent.setdefault(n, n) != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.components(frame).collect()}
    assert got == {n: root(n) for n in list(parent)}
    assert graph.components(frame.limit(0)).count() == 0
