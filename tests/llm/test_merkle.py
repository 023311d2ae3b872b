"""Witnesses of a Merkle manifest against a brute-force version, and awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from awkward import awkward_rows
from pyspark.sql import functions as F

from wavebook.llm import merkle
from wavebook.llm.queries import op13_merkle_witnesses

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    told = (row[0], row[3], row[2], row[4], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def tree(nodes, arity=3):
    """The root, and for every node the siblings on its way, each (before, after)."""
    ways, above = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[n : n + arity] for n in range(0, len(nodes), arity)]
        for way, at in zip(ways, above):
            run, place = runs[at // arity], at % arity
            way.append(("".join(run[:place]), "".join(run[place + 1 :])))
        nodes, above = [digest(*run) for run in runs], [at // arity for at in above]
    return nodes[0] if nodes else None, ways


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {name: tree([leaf for *_, leaf, _ in sorted(groups[name], key=lambda g: g[:3])]) for name in names}
    root, over = tree([made[name][0] for name in names])
    told = []
    for name, upper in zip(names, over):
        subroot, ways = made[name]
        for (*_, leaf, row), way in zip(sorted(groups[name], key=lambda g: g[:3]), ways):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf_of(row, text)
            for before, after in way + upper:
                folded = digest(before, folded, after)
            proof = digest(*(before + after for before, after in way + upper))
            told.append((row[0], leaf, subroot, root, proof, folded, folded == root))
    return told


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def documents():
    rows = [(k, t, "en", "odd", None if t is None else len(t)) for k, t in awkward_rows()]
    rows += [(5000 + n, f"a\nb {n}", None if n % 7 == 0 else "de", "hot", n) for n in range(250)]
    rows += [(6000 + n, f"line\n{n}", "fr", None, n) for n in range(28)]
    rows += [(7000 + n, f"{n}", "fr", f"é{n % 30}" if n % 2 else f"z{n % 30}", n) for n in range(90)]
    return rows + [(8000, "alone", "en", "", 5), (8001, "same", "en", "twice", 4), (8001, "same", "en", "twice", 4)]


def test_query(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, COLUMNS).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle_witnesses(spark, str(tmp_path))
    assert got.columns == "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    told = rows_of(got)
    assert told == sorted(brute(rows), key=repr)
    assert {r[-1] for r in told} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_trees_of_many_blocks(spark, levels):
    """Blocks of three and nine leaves, so block roots are appended in several rounds."""
    rows = documents()
    frame = spark.createDataFrame([(r[0], r[3], leaf_of(r, r[1])) for r in rows], "k long, s string, leaf string")
    got = merkle.witnessed(frame.repartition(5), "s", ["k"], "leaf", levels=levels)
    told = got.select("k", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")))
    assert rows_of(told) == sorted((r[:5] for r in brute(rows)), key=repr)
    wrong = got.where(merkle.folded(F.col("leaf"), F.col("witness")) != F.col("root"))
    assert wrong.count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 4, 8, 9, 10, 27, 28, 82])
def test_appender_equals_whole_tree(count):
    leaves = [hashlib.sha256(str(n).encode()).digest() for n in range(count)]
    appender = merkle.Appender(3, 5)
    for leaf in leaves:
        appender.append(leaf)
    root, ways = tree([leaf.hex() for leaf in leaves])
    assert appender.close(alone=True).hex() == root
    assert [[(a.hex(), b.hex()) for a, b in way] for way in appender.witness] == ways


def test_empty_table_and_clashing_names(spark):
    frame = spark.createDataFrame([(1, "a", digest("x"), "p")], "k long, s string, leaf string, position string")
    assert merkle.witnessed(frame.limit(0), "s", ["k"], "leaf").count() == 0
    one = merkle.witnessed(frame, "s", ["k"], "leaf").first()
    assert one.position == "p" and one.subroot == one.root == one.leaf and one.witness == []
    with pytest.raises(ValueError):
        merkle.witnessed(frame.withColumn("ROOT", F.lit(1)), "s", ["k"], "leaf")
