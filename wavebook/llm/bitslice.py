"""Exact top-k by inner product over a bit-sliced index.

Vectors are whole numbers. A block of rows keeps, for every attribute, one bitmap per bit of
the attribute's quantised value (its low bits dropped, and shifted to be at least zero). A
query's weighted sum of attributes is built from these slices with bitmap adders, which gives
an approximate score of every row as slices in turn. Rows are then selected from the most
significant slice downward: rows with the bit set come before rows without. As the dropped bits bound
the error of an approximate score from both sides, the k best lower bounds give a threshold,
every row whose upper bound reaches it is a boundary row, and boundary rows are scored
exactly on the kept whole numbers, with ties going to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavebook.llm.common import fresh
from wavebook.session import staged

#: Rows of a block of the index, and queries of a block; both bound what a task holds.
BLOCK_ROWS, BLOCK_QUERIES = 16384, 128
#: Significant bits that a quantised attribute keeps in the index, and a query's weight in its use.
KEPT_BITS, WEIGHT_BITS = 8, 16

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit words, padded with zeros."""
    padded = np.zeros(-(-len(bits) // 64) * 64, np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view("<u8")


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _drop(values: np.ndarray, bits: int) -> int:
    """Low bits to drop so that the range of the values fits into so many bits."""
    span = int(values.max()) - int(values.min()) if values.size else 0
    return max(0, span.bit_length() - bits)


@dataclass
class Index:
    """Slices of a block: ``slices[d]`` holds the bitmaps of attribute d, lowest bit first."""

    ids: np.ndarray
    vectors: np.ndarray
    base: np.ndarray
    dropped: np.ndarray
    slices: list[list[np.ndarray]]


def build(ids: np.ndarray, vectors: np.ndarray) -> Index:
    base = vectors.min(axis=0)
    dropped = np.array([_drop(column, KEPT_BITS) for column in vectors.T], np.int64)
    kept = (vectors - base) >> dropped
    slices = []
    for column in kept.T:
        width = int(column.max()).bit_length()
        slices.append([_bitmap((column >> bit) & 1) for bit in range(width)])
    return Index(ids, vectors, base, dropped, slices)


def _add(total: list[np.ndarray], part: list[np.ndarray], shift: int) -> None:
    """Bitmap adder: add the number in ``part``'s slices, shifted, to that in ``total``."""
    empty = np.zeros_like(part[0])
    while len(total) < shift:
        total.append(empty.copy())
    carry = None
    place = shift
    for bits in part:
        if place == len(total):
            total.append(empty.copy())
        old = total[place]
        half = old ^ bits
        over = old & bits
        if carry is None:
            total[place], carry = half, over
        else:
            total[place], carry = half ^ carry, over | (half & carry)
        place += 1
    while carry is not None and carry.any():
        if place == len(total):
            total.append(empty.copy())
        total[place], carry = total[place] ^ carry, total[place] & carry
        place += 1


def _approximate(index: Index, query: np.ndarray) -> tuple[list[np.ndarray], int, int, int]:
    """Slices of an approximate score, their unit, and what has to be added at least and at most.

    A negative weight counts the complement of an attribute: -w*x = w*(top - x) - w*top. Weights lose their
    low bits like attributes do; what is lost is bounded by the attribute's range.
    """
    drop = int(index.dropped.min()) if len(index.dropped) else 0
    lost = max(0, int(np.abs(query).max(initial=0)).bit_length() - WEIGHT_BITS)
    total: list[np.ndarray] = []
    low = high = 0
    for d, weight in enumerate(query.tolist()):
        slices, dropped, base = index.slices[d], int(index.dropped[d]), int(index.base[d])
        top = (1 << len(slices)) - 1
        low += weight * base
        high += weight * base
        kept, rest = abs(weight) >> lost, abs(weight) & ((1 << lost) - 1)
        unit, tail = 1 << dropped, (1 << dropped) - 1
        largest = top * unit + tail  # of the attribute, above its base
        if weight >= 0:
            # w*x = kept*2^lost*(s*unit + t) + rest*x
            high += (kept << lost) * tail + rest * largest
            parts = slices
        else:
            # -w*x = kept*2^lost*((top - s)*unit - top*unit - t) - rest*x
            low -= (kept << lost) * (top * unit + tail) + rest * largest
            high -= (kept << lost) * top * unit
            parts = [~s for s in slices]
        if not slices:
            continue
        place = dropped - drop
        while kept:
            if kept & 1:
                _add(total, parts, place)
            kept >>= 1
            place += 1
    return total, 1 << (drop + lost), low, high


def _selected(total: list[np.ndarray], among: np.ndarray, wanted: int) -> int:
    """The wanted-th largest number among the rows, from the top slice downward."""
    sure, open_, value = 0, among, 0
    for place in range(len(total) - 1, -1, -1):
        ones = open_ & total[place]
        found = _count(ones)
        if sure + found >= wanted:
            open_, value = ones, value | (1 << place)
        else:
            sure += found
            open_ = open_ & ~total[place]
    return value


def _at_least(total: list[np.ndarray], among: np.ndarray, value: int) -> np.ndarray:
    """Rows whose number is at least ``value``."""
    if value <= 0:
        return among
    if value >> len(total):
        return np.zeros_like(among)
    more, equal = np.zeros_like(among), among
    for place in range(len(total) - 1, -1, -1):
        if value >> place & 1:
            equal = equal & total[place]
        else:
            more = more | (equal & total[place])
            equal = equal & ~total[place]
    return more | equal


def top_rows(index: Index, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The block's k best (id, score) for a query other than rows with the query's id."""
    among = _bitmap(index.ids != query_id)
    rows = _count(among)
    if not rows:
        return []
    total, unit, low, high = _approximate(index, query)
    if total and rows > k:
        # score lies between low + unit*n and high + unit*n
        least = _selected(total, among, k)
        among = _at_least(total, among, least - (high - low) // unit)
    found = _rows(among)
    scores = index.vectors[found] @ query
    order = np.lexsort((index.ids[found], -scores))[:k]
    return [(int(index.ids[found[i]]), int(scores[i])) for i in order]


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, values array<long>): floor(scale * x) of every component as a double.

    Vectors that are null, or hold null, NaN or infinite components, and vectors without an id
    take no part.
    """
    values = F.col(vector)
    x = lambda c: c.cast("double")
    sound = F.forall(
        values, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < F.lit(float("inf")))
    )
    return vectors.where(F.col(key).isNotNull() & values.isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(key).cast("long").alias("id"),
        F.transform(values, lambda c: F.floor(x(c) * F.lit(float(scale))).cast("long")).alias("values"),
    )


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), np.int64).reshape(len(values), -1)


def _in_blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Deal rows out to numbered blocks of about ``size`` rows each."""
    count = rows.count()
    blocks = max(1, -(-count // size))
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int"))
    return dealt, blocks


def _cell(rows: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """One group of the grid: a block of rows, indexed, and a block of queries run on it."""
    out = []
    if len(rows) and len(asked):
        index = build(rows["id"].to_numpy(np.int64), _matrix(rows["values"]))
        for query_id, values in zip(asked["id"].tolist(), _matrix(asked["values"])):
            out += [(query_id, *hit) for hit in top_rows(index, query_id, values, k)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of every query by inner product.

    Both sides hold (id long, values array<long>), see :func:`quantised`. Rows with the
    query's own id are left out, ties go to the smaller id, fewer than k rows give all of
    them. A repeated row is one candidate and a repeated query one query; an id with several
    different vectors is a candidate with each. Vectors of another length than the query's
    do not compete. Scores must fit 64 bits. Empty tables give no row.

    The rows are dealt out to blocks and the queries too; every pair of blocks is a group of
    its own, and only k rows per query leave a group.
    """
    size = fresh("size")
    rows = staged(rows.select("id", "values").dropDuplicates().withColumn(size, F.size("values")), "vectors")
    queries = staged(queries.select("id", "values").dropDuplicates().withColumn(size, F.size("values")), "queries")
    dealt, blocks = _in_blocks(rows, BLOCK_ROWS, "row_block")
    asked, sets = _in_blocks(queries, BLOCK_QUERIES, "query_block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = dealt.withColumn("query_block", every(sets))
    right = asked.withColumn("row_block", every(blocks))
    cell = ["row_block", "query_block", size]
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInPandas(
            lambda a, b: _cell(a, b, k), "query_id long, vec_id long, score long"
        )
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; Spark keeps only k rows per query before the shuffle too."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
