"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered by a global sort; the permutation sends a row number to a place, walking
along its cycle while the place lies outside the table. Place p belongs to shard p mod n at
slot p div n, so both can be worked out for any row number without looking at other rows,
shard sizes differ by one at most, and slots have no gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import fresh
from wavebook.session import staged

ROUNDS = 6
#: Walks along a cycle in one expression. The grid has fewer than sqrt(n) + 1 cells too many,
#: so a walk ends outside with a probability of about 1 / sqrt(n) at most; rows that are still
#: outside after them all walk on in further passes, until none is.
WALKS = 4
#: A prime and a multiplier below 2^31: products stay within 64 bits.
PRIME, MULTIPLIER = 2147483647, 48271


def grid(count: int) -> tuple[int, int]:
    """Sides of the smallest grid, close to a square, that holds ``count`` cells."""
    rows = max(1, math.isqrt(max(count - 1, 0)) + 1)
    return rows, max(1, -(-count // rows))


def _round_keys(seed: int) -> list[int]:
    keys, state = [], seed % PRIME or 1
    for _ in range(ROUNDS):
        state = (state * MULTIPLIER + 12345) % PRIME or 1
        keys.append(state)
    return keys


def _noise(value: Column, key: Column, side: int) -> Column:
    """A number below ``side``, from two multiplications in the field of PRIME."""
    once = (value % PRIME * MULTIPLIER + key) % PRIME
    mixed = once.bitwiseXOR(F.shiftright(once, 15))
    return (mixed % PRIME * MULTIPLIER + key) % PRIME % side


def walked(number: Column, count: int, seed: int) -> Column:
    """The place of a row number, or one outside the table after WALKS walks.

    A walk applies the Feistel network over the grid of ``count`` cells once. Its halves are
    row and column of a cell, and each round adds noise from one half to the other, modulo
    its side; that can be undone, so the network is a permutation of the grid. Walks end
    when a cell lies inside the table.
    """
    if count > 1 << 52:
        raise ValueError("row numbers beyond 2^52 are not exact")
    rows, columns = grid(count)
    keys = F.array(*(F.lit(key).cast("long") for key in _round_keys(seed)))

    def step(state: Column, turn: Column) -> Column:
        key = F.element_at(keys, (turn % ROUNDS + 1).cast("int"))
        odd = turn % 2 == 1
        row = F.when(odd, state.r).otherwise((state.r + _noise(state.c, key, rows)) % rows)
        column = F.when(odd, (state.c + _noise(state.r, key, columns)) % columns).otherwise(state.c)
        ends = (turn % ROUNDS == ROUNDS - 1) & (row * columns + column < count)
        moved = F.struct(row.alias("r"), column.alias("c"), ends.alias("inside"))
        return F.when(state.inside, state).otherwise(moved)

    start = F.struct(
        ((number - number % columns) / columns).cast("long").alias("r"),
        (number % columns).cast("long").alias("c"),
        F.lit(False).alias("inside"),
    )
    turns = F.sequence(F.lit(0), F.lit(WALKS * ROUNDS - 1))
    return F.aggregate(turns, start, step, lambda state: state.r * columns + state.c)


def places(numbered: DataFrame, number: str, place: str, count: int, seed: int) -> DataFrame:
    """Add the place of every row number; each number below ``count`` gets a place of its own.

    Rows still outside after WALKS walks go on in further passes.
    """
    rows = staged(numbered.withColumn(place, walked(F.col(number), count, seed)), "places")
    while not rows.where(F.col(place) >= count).isEmpty():
        onward = F.when(F.col(place) < count, F.col(place)).otherwise(
            walked(F.col(place), count, seed)
        )
        rows = staged(rows.withColumn(place, onward), "places")
    return rows


def numbered_rows(rows: DataFrame, order: list[str], number: str) -> tuple[DataFrame, int]:
    """Add the rank of every row in the order of the columns, from 0, and count the rows.

    Ranges of the order are sorted side by side; only their sizes, one per range, are added
    up on the driver. Rows equal in all columns of the order are told apart by where they were read,
    which also spreads them over ranges, so a repeated row fills no task.
    """
    read, at, part = fresh("read"), fresh("at"), fresh("part")
    ranged = (
        rows.withColumn(read, F.monotonically_increasing_id())
        .repartitionByRange(*order, read)
        .sortWithinPartitions(*order, read)
        .withColumn(at, F.monotonically_increasing_id())
        .drop(read)
    )
    kept = staged(ranged, "ranges")
    inside = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(F.shiftright(at, 33).cast("int").alias(part)).count().orderBy(part).collect()
    before, total = {}, 0
    for size in sizes:
        before[size[part]] = total
        total += size["count"]
    if not before:
        return kept.select(*rows.columns, F.lit(0).cast("long").alias(number)), 0
    offsets = rows.sparkSession.createDataFrame(list(before.items()), f"`{part}` int, before long")
    start = fresh("start")
    offsets = offsets.withColumnRenamed("before", start)
    # one row per range: the number of ranges is that of the shuffle's partitions
    joined = kept.withColumn(part, F.shiftright(at, 33).cast("int")).join(F.broadcast(offsets), part)
    return joined.select(*rows.columns, (F.col(start) + inside).alias(number)), total


def shard_rows(
    rows: DataFrame, order: list[str], shards: int, seed: int = 20240607
) -> DataFrame:
    """Add ``row_number``, ``shard`` and ``slot`` to rows numbered in the order of columns.

    The order should hold every column that tells rows apart; rows equal in it may change
    places with each other. Nulls sort first. An empty table stays empty. A column of the
    input named like a new one is an error.
    """
    taken = {"row_number", "shard", "slot"} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"the rows already have {sorted(taken)}")
    numbered, count = numbered_rows(rows, order, "row_number")
    place = fresh("place")
    placed = places(numbered, "row_number", place, max(count, 1), seed)
    return placed.select(
        *rows.columns,
        "row_number",
        (F.col(place) % shards).cast("int").alias("shard"),
        F.floor(F.col(place) / shards).cast("long").alias("slot"),
    )


def shard_documents(documents: DataFrame, shards: int, seed: int = 20240607) -> DataFrame:
    """Documents as doc_id, size, text_crc32, row_number, shard and slot.

    Size is the text's UTF-8 bytes, none for null, plus 16. Null texts have the checksum of
    no bytes. Numbers go by doc_id, size and checksum, so the shuffle does not depend on how
    the files are split; equal documents are interchangeable. Further columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    light = documents.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(light, ["doc_id", "size", "text_crc32"], shards, seed)
