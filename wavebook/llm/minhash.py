"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A shingle hash is put on one of SLOTS places by a first fixed permutation (a multiplication
of the hash by an odd number, of which the top bits count). A second permutation of the
places, circularly shifted by 0, 1, 2, ..., gives every coordinate of the signature: the
smallest shifted value over the set. Bands of coordinates make buckets, and every link that is
claimed has been confirmed on the full shingle sets.

Documents with equal sets are one class and are worked on once. In a bucket, members are not
compared all with all but settled by hubs in rounds, see :func:`wavebook.llm.graph.settled`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import (
    BATCH_ROWS,
    drop_listed,
    fresh,
    keep_possible,
    only_listed,
    shingle_set,
)
from wavebook.llm.graph import all_pairs, groups_of, settled
from wavebook.session import staged

#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^40, about 1e-7.
BANDS, BAND_ROWS = 40, 5
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
FIRST = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Buckets up to this size have all their pairs compared.
SMALL = 12
#: Members of a larger bucket that become hubs in the same round, and texts of a cell.
HUBS, CELL = 256, 256
#: Shingles whose shifted values are looked up at once.
GATHERED = 4096


@lru_cache(maxsize=2)
def _circulant(coordinates: int) -> np.ndarray:
    """Row s holds the values of slot s under all shifts."""
    second = np.random.default_rng(20240611).permutation(SLOTS).astype(np.uint32)
    around = np.concatenate([second, second[: coordinates - 1]])
    return np.lib.stride_tricks.sliding_window_view(around, coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    slots = ((shingles * FIRST) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    shifted = _circulant(coordinates)
    least = np.full(coordinates, SLOTS, np.uint32)
    for at in range(0, len(slots), GATHERED):
        np.minimum(least, shifted[slots[at : at + GATHERED]].min(axis=0), out=least)
    return least


def band_keys(shingles: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit bucket key per band."""
    values = signature(shingles, bands * rows).reshape(bands, rows)
    keys = [xxhash.xxh3_64_intdigest(v.tobytes(), seed=n) for n, v in enumerate(values)]
    return np.array(keys, np.uint64).view(np.int64)


def sets_and_bands(texts: DataFrame, words: int) -> DataFrame:
    """(…, n_shingles, set_id, bands) in place of ``text``; no shingles: null set and bands."""
    keep = [c for c in texts.columns if c != "text"]
    place = {c: n for n, c in enumerate(texts.columns)}
    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                sizes, ids, bands = [], [], []
                for text in part.column(place["text"]).to_pylist():
                    shingles = shingle_set(text, words)
                    some = len(shingles) > 0
                    sizes.append(len(shingles))
                    ids.append(xxhash.xxh3_128_digest(shingles.tobytes()) if some else None)
                    bands.append(band_keys(shingles) if some else None)
                columns = [part.column(place[c]) for c in keep]
                columns += [
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, [*keep, "n_shingles", "set_id", "bands"]
                )

    return texts.mapInArrow(
        task, f"{schema}, n_shingles long, set_id binary, bands array<long>"
    )


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of set ids, those whose full sets are similar enough.

    The texts of a pair are brought together and their shingle sets made again, so no set is
    stored. Pairs come sorted by ``a``, whose set is kept from one pair to the next.
    """
    first = texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(second.hint("merge"), "b").join(first.hint("merge"), "a")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                linked = []
                names = part.column(0).to_pylist()
                for name, own, other in zip(
                    names, part.column(2).to_pylist(), part.column(3).to_pylist()
                ):
                    if name != last:
                        last, held = name, shingle_set(own, words)
                    linked.append(similar(held, shingle_set(other, words), percent))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a binary, b binary")


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of sorted distinct hashes."""
    small, large = sorted((len(one), len(two)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


def confirmed_in_cells(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) of the hubs of large groups (key, node, size, hub) with their members.

    The members of a group are dealt out to cells of about CELL texts, and its hubs go to
    each of them; so a text is moved once for all hubs of its group, and no pair is a row.
    """
    cells = F.ceil(F.col("size") / F.lit(CELL)).cast("int")
    with_text = members.join(texts.withColumnRenamed("set_id", "node").hint("merge"), "node")
    dealt = with_text.select(
        "key", F.pmod(F.xxhash64("node"), cells).cast("int").alias("cell"), "node", "text"
    )
    asked = with_text.where("hub").select(
        F.col("key").alias("hub_key"),
        F.explode(F.sequence(F.lit(0), cells - 1)).alias("hub_cell"),
        F.col("node").alias("hub_node"),
        F.col("text").alias("hub_text"),
    )

    def cell(some: pd.DataFrame, hubs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(some) and len(hubs):
            names = hubs["hub_node"].tolist()
            index = HubIndex([shingle_set(t, words) for t in hubs["hub_text"]])
            for node, text in zip(some["node"], some["text"]):
                for n in index.similar(shingle_set(text, words), percent).tolist():
                    if names[n] != node:
                        out.append((names[n], node))
        return pd.DataFrame(out, columns=["a", "b"])

    beside = asked.groupBy("hub_key", "hub_cell")
    return dealt.groupBy("key", "cell").cogroup(beside).applyInPandas(cell, "a binary, b binary")


class HubIndex:
    """Shingle sets of some hubs, to count what another set has in common with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        shingles = np.concatenate(sets)
        order = np.argsort(shingles, kind="stable")
        self.shingles = shingles[order]
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, other: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the hubs with 100 * intersection >= percent * union."""
        low = np.searchsorted(self.shingles, other, side="left")
        runs = np.searchsorted(self.shingles, other, side="right") - low
        first = np.repeat(low - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
        hits = self.owners[first + np.arange(int(runs.sum()))]
        common = np.bincount(hits, minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(other) - common))


def linked(classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the classes that similar pairs join, by confirmed links.

    Any two members of a small bucket are compared. In a larger one they are compared, or end
    up in one component by other links.
    """
    exploded = classes.select(F.col("set_id").alias("node"), F.explode("bands").alias("key"))
    members = groups_of(exploded)
    nodes = members.select(F.col("node").alias("set_id")).distinct()
    spoken = staged(_texts_of(classes, nodes, texts), "texts")
    small = members.where(F.col("size") <= SMALL)
    known = staged(confirmed(all_pairs(small), spoken, words, percent), "confirmed")
    _, reached = settled(
        members.where(F.col("size") > SMALL),
        lambda some: confirmed_in_cells(some, spoken, words, percent),
        known,
        HUBS,
    )
    return reached


def _texts_of(classes: DataFrame, wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(set_id, text) of the wanted classes; texts are picked before they are shuffled."""
    picked = classes.join(wanted.hint("merge"), "set_id", "left_semi").select("set_id", "text_key")
    picked = staged(picked, "picked")
    hashed = texts.select(F.xxhash64("text").alias("text_key"), "text")
    near = keep_possible(hashed, "text_key", picked, "text_key")
    return (
        near.groupBy("text_key")
        .agg(F.first("text").alias("text"))
        .join(picked, "text_key")
        .select("set_id", "text")
    )


def near_duplicates(
    documents: DataFrame, words: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, text_key, component_id, kept) of every row of (doc_id, text).

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of
    shingles of ``words`` words; fewer words make one shingle, and none, or a null text, an
    empty set that is linked with nothing. ``component_id`` is the smallest doc_id that can
    be reached, and ``kept`` says whether it is the row's own. A repeated row has equal
    results each time; a null doc_id counts for nothing in a smallest one, and a component
    that has only null ones has none and keeps its rows. An empty table gives no rows.
    Further columns are not read. ``text_key`` is the xxhash64 of the text.
    """
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    known = staged(sets_and_bands(rows, words), "signatures")
    classes = staged(
        known.where("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.first("bands").alias("bands"),
            F.min("text_key").alias("text_key"),
            F.min("doc_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    reached = linked(classes, documents.select("text"), words, percent)
    reached = reached.select(F.col("node").alias("set_id"), "component").hint("merge")
    joined = classes.join(reached, "set_id", "left").select(
        "set_id", "least", "copies", F.coalesce("component", "set_id").alias("component")
    )
    joined = staged(joined, "joined")
    smallest = joined.groupBy("component").agg(
        F.min("least").alias("component_id"), F.sum("copies").alias("documents")
    )
    smallest = staged(smallest.where("documents > 1"), "smallest")
    owner = joined.join(smallest.hint("merge"), "component").select("set_id", "component_id")
    answer = known.select("doc_id", "n_shingles", "text_key", "set_id").join(
        staged(owner, "owners").hint("merge"), "set_id", "left"
    )
    component = F.coalesce("component_id", "doc_id")
    return answer.select(
        "doc_id",
        "n_shingles",
        "text_key",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents without near duplicates: the kept row of each component, all columns.

    Of rows equal in doc_id and text one stays; a row without doc_id stays unless a document
    with an id is near it.
    """
    told = staged(near_duplicates(documents.select("doc_id", "text"), words, percent), "told")
    gone = told.where("not kept").select("doc_id", "text_key").distinct()
    mark = fresh("key")
    rows = documents.withColumn(mark, F.xxhash64("text"))
    left = drop_listed(rows, staged(gone, "gone"), {"doc_id": "doc_id", mark: "text_key"})
    again = (
        told.where("kept and n_shingles > 0")
        .groupBy("doc_id", "text_key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select("doc_id", "text_key")
    )
    again = staged(again, "repeated")
    if again.isEmpty():
        return left.drop(mark)
    keys = {"doc_id": "doc_id", mark: "text_key"}
    once = drop_listed(left, again, keys)
    repeated = only_listed(left, again, keys).dropDuplicates(["doc_id", mark])
    return once.unionByName(repeated).drop(mark)
