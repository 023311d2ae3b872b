"""Shards: a permutation, even counts, no gaps, and the same at every layout."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wavebook.llm.sharding import grid, shard_documents, shard_rows, walked

from awkward import awkward_rows


@pytest.mark.parametrize("count", [1, 2, 3, 7, 40, 41, 1000, 1023])
def test_walks_permute(spark, count):
    rows = spark.range(count).select(walked(F.col("id"), count, 11).alias("p")).collect()
    inside = [r.p for r in rows if r.p < count]
    assert len(set(r.p for r in rows)) == count
    assert len(set(inside)) == len(inside) >= 0.9 * count - 3
    rows, columns = grid(count)
    assert rows * columns >= count and rows * columns - count < max(rows, columns)


def test_documents(spark, documents):
    rows = shard_documents(documents, 7).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in awkward_rows()
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[n]) for n in range(7)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shard_documents(documents.repartition(5, "key"), 7).collect()
    place = lambda found: sorted(map(str, ((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found)))
    assert place(rows) == place(again)
    assert place(rows) != place(shard_documents(documents, 7, seed=3).collect())


def test_empty_repeated_and_clashing(spark, no_documents):
    assert shard_documents(no_documents, 4).count() == 0
    same = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit("t").alias("text"))
    assert Counter(r.shard for r in shard_documents(same, 4).collect()) == {n: 125 for n in range(4)}
    with pytest.raises(ValueError, match="slot"):
        shard_rows(spark.range(3).withColumn("slot", F.lit(1)), ["id"], 2)
