"""Top-k over bit slices against plain arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavebook.llm import bitslice
from wavebook.llm.queries import op4_bit_sliced_top_k


def plain(rows, k):
    sound = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in sound:
        if q % 100 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q and len(a) == len(b)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("bits", [(2, 2), (5, 4), (8, 16)])
def test_block_is_exact(monkeypatch, bits):
    monkeypatch.setattr(bitslice, "KEPT_BITS", bits[0])
    monkeypatch.setattr(bitslice, "WEIGHT_BITS", bits[1])
    chance = np.random.default_rng(4)
    for span, dims in ((5, 3), (900, 8), (1, 2), (40, 1)):
        vectors = chance.integers(-span, span + 1, (300, dims))
        vectors[50:150] = vectors[50]
        ids = chance.permutation(300) * 3
        index = bitslice.build(ids, vectors)
        for query in (vectors[7], -vectors[8], vectors[60] * 0, chance.integers(-7, 8, dims)):
            for k in (1, 10, 400):
                scores = vectors @ query
                best = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[7])[:k]
                assert bitslice.top_rows(index, int(ids[7]), query, k) == [(i, -s) for s, i in best]


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 90)
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", 2)
    chance = np.random.default_rng(5)
    rows = [(n, chance.normal(0, 0.3, 6).astype(float).tolist()) for n in range(420)]
    rows += [(n, [0.25, -0.5, 0.125, 0.0, 1.0, -1.0]) for n in range(500, 640)]
    rows += [(1000, None), (1100, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (1200, [float("nan")] * 6), (1300, [float("inf")] * 6)]
    rows += [(None, [0.1] * 6), (1400, [0.5, 0.5]), (1401, [0.25, 0.75]), (1500, [])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    frame.unionAll(frame.where("vec_id = 3")).write.parquet(f"{tmp_path}/embeddings.parquet")
    single = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in op4_bit_sliced_top_k(spark, str(tmp_path)).collect())
    assert got == plain(single, 10)


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    vectors = bitslice.quantised(none, "vec_id", "embedding", 1024)
    assert bitslice.top_k(vectors, vectors.where(F.col("id") % 100 == 0)).count() == 0
