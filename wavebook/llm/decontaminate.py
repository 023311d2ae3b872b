"""Benchmark decontamination with suffix arrays over the training documents.

A task joins the documents it reads into shards of a bounded number of words, sorts the
suffixes of each shard, and looks up every suffix of the benchmark by binary search. The
neighbours of its place share the longest verbatim match with it; the suffixes that begin
with a whole window are all occurrences of the window. The benchmark comes in blocks of a
bounded size, each broadcast by itself; rows go through a pass per block, in one stage.

A word that no item of a block has becomes a number that ends every match, so the words of
a shard are small integers and a match never runs from one document into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import BATCH_ROWS

WINDOW = 13
#: Words of a shard, and of a block of the benchmark.
SHARD_WORDS, BLOCK_WORDS = 1 << 20, 1 << 17

#: A-Z to a-z and every byte that belongs to no word to a blank; UTF-8 beyond ASCII stays.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


@dataclass
class Block:
    """Items of the benchmark as numbers, one after another with a 0 behind each.

    ``starts`` are places where a window begins and ``widths`` their lengths; equal windows
    are there once, and ``owners`` lists the items of each.
    """

    vocabulary: dict[bytes, int]
    words: np.ndarray
    starts: np.ndarray
    widths: np.ndarray
    owners: list[np.ndarray]
    names: list[str]
    begins: np.ndarray
    item_of: np.ndarray


def benchmark_block(items: list[tuple[str, list[bytes]]], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    words: list[int] = []
    windows: dict[tuple[int, ...], list[int]] = {}
    places: dict[tuple[int, ...], int] = {}
    begins: list[int] = []
    names = sorted({name for name, _ in items})
    number = {name: n for n, name in enumerate(names)}
    for name, own in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in own]
        width = min(window, len(ids))
        for at in range(len(ids) - width + 1 if ids else 0):
            key = tuple(ids[at : at + width])
            places.setdefault(key, len(words) + at)
            windows.setdefault(key, []).append(number[name])
        begins.append(len(words))
        words += [*ids, 0]
    return Block(
        vocabulary,
        np.array(words, np.int64),
        np.array([places[k] for k in windows], np.int64),
        np.array([len(k) for k in windows], np.int64),
        [np.unique(v) for v in windows.values()],
        names,
        np.array(begins, np.int64),
        np.array([number[name] for name, _ in items], np.int64),
    )


def suffix_array(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, compared over ``depth`` words at least.

    By prefix doubling; places that begin with 0 are left out, as no match begins there.
    Also gives the number of the first word of each place in that order.
    """
    size = len(words)
    rank = words.astype(np.int64)
    reach = 1
    while reach < depth:
        after = np.zeros(size, np.int64)
        after[: max(0, size - reach)] = rank[reach:]
        after[rank == 0] = 0
        key = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.unique(key, return_inverse=True)[1]
        # a suffix that has come to a 0 keeps no more than what it has
        rank = np.where(words == 0, 0, order + 1)
        reach *= 2
    places = np.flatnonzero(words)
    order = places[np.argsort(rank[places], kind="stable")]
    return order, words[order]


def _compare(
    shard: np.ndarray, places: np.ndarray, block: np.ndarray, starts: np.ndarray, widths: np.ndarray
) -> np.ndarray:
    """-1, 0 or 1: the order of the shard's suffix and the block's, over its width of words."""
    sign = np.zeros(len(places), np.int64)
    live = np.arange(len(places))
    step = 0
    while len(live):
        live = live[widths[live] > step]
        left = shard[np.minimum(places[live] + step, len(shard) - 1)]
        difference = np.sign(left - block[starts[live] + step])
        sign[live] = difference
        live = live[difference == 0]
        step += 1
    return sign


def _bound(
    shard: np.ndarray, order: np.ndarray, block: np.ndarray, starts: np.ndarray, widths: np.ndarray, right: bool
) -> np.ndarray:
    """Binary search of all suffixes at once: the first place not below, or the first above."""
    low = np.zeros(len(starts), np.int64)
    high = np.full(len(starts), len(order), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        sign = _compare(shard, order[middle], block, starts[open_], widths[open_])
        below = sign <= 0 if right else sign < 0
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
    return low


def _common(shard: np.ndarray, places: np.ndarray, block: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words that the suffixes share; a 0 ends the match."""
    length = np.zeros(len(places), np.int64)
    live = np.flatnonzero(places >= 0)
    step = 0
    while len(live):
        a, b = places[live] + step, starts[live] + step
        inside = (a < len(shard)) & (b < len(block))
        live, a, b = live[inside], a[inside], b[inside]
        live = live[(shard[a] == block[b]) & (shard[a] != 0)]
        step += 1
        length[live] = step
    return length


@dataclass
class Shard:
    """Numbered words of some documents, a 0 behind each, and where each begins."""

    words: np.ndarray
    begins: np.ndarray
    counts: np.ndarray


def numbered(texts: list[list[bytes]], vocabulary: dict[bytes, int]) -> Shard:
    counts = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
    words = np.zeros(int(counts.sum()) + len(texts), np.int64)
    for begin, own in zip(begins.tolist(), texts):
        words[begin : begin + len(own)] = [vocabulary.get(w, 0) for w in own]
    return Shard(words, begins, counts)


def long_runs(words: np.ndarray, least: int) -> np.ndarray:
    """Places in runs of at least so many known words, and the 0 behind each such run."""
    ends = np.flatnonzero(words == 0)
    begins = np.concatenate([[0], ends[:-1] + 1])
    worth = np.flatnonzero(ends - begins >= least)
    if not len(worth):
        return np.zeros(0, np.int64)
    sizes = ends[worth] - begins[worth] + 1
    first = np.repeat(begins[worth] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return first + np.arange(int(sizes.sum()))


def window_hits(shard: Shard, block: Block, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(window, places) for every window of the block that occurs in the shard.

    No window occurs in a run of known words shorter than the shortest window, so only the
    suffixes in longer runs are sorted.
    """
    if not len(block.starts):
        return
    runs = long_runs(shard.words, int(block.widths.min()))
    words = shard.words[runs]
    order, _ = suffix_array(words, window)
    if not len(order):
        return
    low = _bound(words, order, block.words, block.starts, block.widths, False)
    high = _bound(words, order, block.words, block.starts, block.widths, True)
    for n in np.flatnonzero(low < high).tolist():
        yield n, runs[order[low[n] : high[n]]]


def longest_matches(shard: Shard, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For every place of the block: the longest verbatim match and a place of it in the shard.

    The suffixes are sorted to the depth of the longest item, so the neighbours are exact.
    """
    ends = np.flatnonzero(block.words == 0)
    own = np.flatnonzero(block.words)
    room = ends[np.searchsorted(ends, own)] - own
    order, _ = suffix_array(shard.words, int(room.max(initial=1)))
    length = np.zeros(len(block.words), np.int64)
    where = np.full(len(block.words), -1, np.int64)
    if not len(order) or not len(own):
        return length, where
    at = _bound(shard.words, order, block.words, own, room, False)
    for neighbour in (at - 1, at):
        found = np.where((neighbour >= 0) & (neighbour < len(order)), neighbour, -1)
        places = np.where(found >= 0, order[found], -1)
        common = np.minimum(_common(shard.words, places, block.words, own), room)
        better = common > length[own]
        length[own[better]] = common[better]
        where[own[better]] = places[better]
    return length, where


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
STATE = "spans array<struct<start:long,stop:long>>, items array<string>, n_words long"


def marked(
    texts: list[str | None], spans: list[list[dict]], items: list[list[str]], block: Block, window: int
) -> tuple[list[list[dict]], list[list[str]], list[int]]:
    """One pass over a shard: the hit runs and item names with those of a block added."""
    shard = numbered([item_words(t) for t in texts], block.vocabulary)
    change = np.zeros(len(shard.words) + 1, np.int64)
    owners: list[list[int]] = [[] for _ in texts]
    for n, places in window_hits(shard, block, window):
        np.add.at(change, places, 1)
        np.add.at(change, places + block.widths[n], -1)
        inside = np.searchsorted(shard.begins, places, side="right") - 1
        for document in np.unique(inside).tolist():
            owners[document].append(n)
    for begin, own in zip(shard.begins.tolist(), spans):
        for span in own:
            change[begin + span["start"]] += 1
            change[begin + span["stop"]] -= 1
    hit = (np.cumsum(change[:-1]) > 0).astype(np.int8)
    new_spans, new_items = [], []
    for n, (begin, count) in enumerate(zip(shard.begins.tolist(), shard.counts.tolist())):
        edge = np.diff(hit[begin : begin + count], prepend=0, append=0)
        starts, stops = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
        new_spans.append([{"start": a, "stop": b} for a, b in zip(starts, stops)])
        found = set(items[n])
        if owners[n]:
            some = np.unique(np.concatenate([block.owners[w] for w in owners[n]]))
            found.update(block.names[i] for i in some.tolist())
        new_items.append(sorted(found))
    return new_spans, new_items, shard.counts.tolist()


def _shards(batches: Iterator[pa.RecordBatch], words: int, text_at: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows gathered until their texts hold about so many words (six bytes each)."""
    some, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            some.append(part)
            size += part.column(text_at).nbytes
            if size >= words * 6:
                yield some
                some, size = [], 0
    if some:
        yield some


def benchmark_blocks(items: DataFrame, window: int) -> Iterator:
    """The benchmark in broadcast blocks of about BLOCK_WORDS words, made one by one.

    Items without words are left out, a null item_id is the empty name. An item is never cut:
    a block ends with the item that fills it.
    """
    context = items.sparkSession.sparkContext
    some, size = [], 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    for name, text in rows.toLocalIterator():
        own = item_words(text)
        if own:
            some.append((name, own))
            size += len(own)
        if size >= BLOCK_WORDS:
            yield context.broadcast(benchmark_block(some, window))
            some, size = [], 0
    if some:
        yield context.broadcast(benchmark_block(some, window))


def _pass(rows: DataFrame, block, window: int, keep: list[str]) -> DataFrame:
    place = {c: n for n, c in enumerate(rows.columns)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _shards(batches, SHARD_WORDS, place["text"]):
            held = pa.Table.from_batches(parts)
            spans, items, counts = marked(
                held.column(place["text"]).to_pylist(),
                held.column(place["spans"]).to_pylist(),
                held.column(place["items"]).to_pylist(),
                block.value,
                window,
            )
            columns = [held.column(place[c]).combine_chunks() for c in keep]
            columns += [
                pa.array(spans, pa.list_(SPAN)),
                pa.array(items, pa.list_(pa.string())),
                pa.array(counts, pa.int64()),
            ]
            done = pa.Table.from_arrays(columns, [*keep, "spans", "items", "n_words"])
            yield from done.to_batches(max_chunksize=10_000)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(task, f"{kinds}, {STATE}")


def benchmark_hits(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """n_words, n_hit, items and hit_spans of every row of (doc_id, text).

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. A window
    is ``window`` consecutive words of an item, or all its words if it has fewer but some. A
    word of a document is hit if it lies in an occurrence of a window; ``hit_spans`` are the
    runs of hit words, and ``items`` the names, in order, of the items with windows that
    occur. Null and empty texts have no words, items without words no window, a null item_id is the empty
    name; equal rows count each for itself, equal items as one name; without items nothing is
    hit. Only doc_id and text are read, and of the items item_id and text.
    """
    return _hits(documents.select("doc_id", "text"), ["doc_id"], items, window)


def _hits(rows: DataFrame, keep: list[str], items: DataFrame, window: int) -> DataFrame:
    """The columns to keep of rows with a ``text``, and what was found."""
    blocks = list(benchmark_blocks(items.select("item_id", "text"), window))
    blocks = blocks or [items.sparkSession.sparkContext.broadcast(benchmark_block([], window))]
    empty = "cast(array() as array<struct<start:long,stop:long>>) spans"
    rows = rows.selectExpr("*", empty, "cast(array() as array<string>) items")
    held = [*keep, *({"text"} - {*keep})]
    for n, block in enumerate(blocks):
        rows = _pass(rows, block, window, keep if n == len(blocks) - 1 else held)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s.stop - s.start)
    return rows.select(*keep, "n_words", hit.alias("n_hit"), "items", F.col("spans").alias("hit_spans"))


def contaminated(least_share: int = 20):
    """The rule: some word is hit, and at least one word in ``least_share``."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words"))


def clean_documents(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, least_share: int = 20
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, as in :func:`benchmark_hits`."""
    own = {c: "text" if c == "text" else f"c{n}" for n, c in enumerate(documents.columns)}
    rows = documents.select(*(F.col(f"`{c}`").alias(name) for c, name in own.items()))
    told = _hits(rows, list(own.values()), items, window).where(~contaminated(least_share))
    return told.select(*(F.col(name).alias(c) for c, name in own.items()))


def longest_matches_report(documents: DataFrame, items: DataFrame, least: int = 5) -> DataFrame:
    """(item_id, item_word, length, doc_id, doc_word): each item suffix's longest match.

    For every word of every item, the longest run of words from there on that a document has
    verbatim, if it has at least ``least`` words, and one place where it stands: the smallest doc_id
    and word of the shards' findings. Input is treated as in :func:`benchmark_hits`.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"item_id string, item_word long, length long, doc_id {kind}, doc_word long"
    parts = []
    for block in benchmark_blocks(items.select("item_id", "text"), WINDOW):

        def task(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            own = block.value
            for held in _shards(batches, SHARD_WORDS, 1):
                rows = pa.Table.from_batches(held)
                texts = [item_words(t) for t in rows.column(1).to_pylist()]
                shard = numbered(texts, own.vocabulary)
                length, where = longest_matches(shard, own)
                at = np.flatnonzero(length >= least)
                item = np.searchsorted(own.begins, at, side="right") - 1
                document = np.searchsorted(shard.begins, where[at], side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own.names[own.item_of[i]] for i in item.tolist()], pa.string()),
                        pa.array(at - own.begins[item], pa.int64()),
                        pa.array(length[at], pa.int64()),
                        rows.column(0).combine_chunks().take(pa.array(document)),
                        pa.array(where[at] - shard.begins[document], pa.int64()),
                    ],
                    ["item_id", "item_word", "length", "doc_id", "doc_word"],
                )

        parts.append(documents.select("doc_id", "text").mapInArrow(task, schema))
    if not parts:
        return documents.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.max_by(
        F.struct("length", "doc_id", "doc_word"), F.struct("length", -F.col("doc_id"), -F.col("doc_word"))
    )
    return found.groupBy("item_id", "item_word").agg(best.alias("best")).select(
        "item_id", "item_word", "best.length", "best.doc_id", "best.doc_word"
    )
