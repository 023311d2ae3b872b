"""Vector bin packing of tokenized examples into training sequences.

An example asks for three things at once: tokens, one segment, and loss-bearing tokens (ids
that are predicted, not only read). A sequence has a limit for each. Bins are filled one at a
time: of the waiting examples that still fit, the one whose demand has the largest dot
product with what the bin has left goes in next, each dimension as a share of its limit. When
none fits, the best one is cut and its head fills the bin, unless cutting is turned off.

A task packs what it reads, holding a bounded number of waiting tokens, so there is no
shuffle, and padding is left only where a task ends or the segment or loss limit binds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding, Tokenizer

from wavebook.llm.common import BATCH_ROWS

#: Below this character letters have one lower-case form of one letter.
LATIN_END = "\u0100"

#: Words a worker remembers before it starts afresh; about 200 bytes each.
KNOWN_WORDS = 1_000_000

#: Bins are closed once so many examples wait that can fill one, by tokens or by segments, or so
#: many tokens wait.
WAITING, WAITING_TOKENS = 256, 1 << 20


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


@dataclass
class Example:
    """What is left of a row: its ids and a mark for those that bear loss."""

    key: object
    ids: np.ndarray
    loss: np.ndarray
    start: int = 0
    total: int = 0
    bears: int = 0


@dataclass
class Piece:
    key: object
    ids: np.ndarray
    start: int
    total: int
    sequence: int
    offset: int
    loss_tokens: int


def pack(
    examples: Iterable[Example], limits: Limits, first: int = 0, cut: bool = True
) -> Iterator[Piece]:
    """Deal the examples out to sequences numbered from ``first``.

    An example without ids makes no piece. One that fits no empty sequence is cut into pieces
    that do, also where ``cut`` is off, as it could not be placed otherwise.
    """
    waiting: list[Example] = []
    held, sequence = 0, first
    for example in examples:
        example.total, example.bears = len(example.ids), int(example.loss.sum())
        while len(example.ids) and _too_large(example, limits):
            yield _head(example, _room(example, limits.tokens, limits.loss_tokens), sequence, 0)
            sequence += 1
        if not len(example.ids):
            continue
        waiting.append(example)
        held += len(example.ids)
        while held >= WAITING_TOKENS or len(waiting) >= WAITING and _fills(len(waiting), held, limits):
            for piece in _bin(waiting, limits, sequence, cut):
                held -= len(piece.ids)
                yield piece
            sequence += 1
    while waiting:
        yield from _bin(waiting, limits, sequence, cut)
        sequence += 1


def _fills(examples: int, held: int, limits: Limits) -> bool:
    return held >= limits.tokens or examples >= limits.segments


def _too_large(example: Example, limits: Limits) -> bool:
    return len(example.ids) >= limits.tokens or example.bears > limits.loss_tokens


def _room(example: Example, tokens: int, loss_tokens: int) -> int:
    """How many of the example's ids fit into so many tokens with so much loss."""
    run = np.cumsum(example.loss[:tokens])
    return int(np.searchsorted(run, loss_tokens, side="right"))


def _head(example: Example, length: int, sequence: int, offset: int) -> Piece:
    loss = int(example.loss[:length].sum())
    ids, start = example.ids[:length], example.start
    example.ids, example.loss = example.ids[length:], example.loss[length:]
    example.start += length
    example.bears -= loss
    return Piece(example.key, ids, start, example.total, sequence, offset, loss)


def _bin(waiting: list[Example], limits: Limits, sequence: int, cut: bool) -> Iterator[Piece]:
    """Fill one sequence from the waiting examples and take what was placed off the list."""
    capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    demand = np.array([(len(e.ids), 1, e.bears) for e in waiting], float)
    shares, left, offset = demand / capacity, capacity.copy(), 0
    open_ = np.ones(len(waiting), bool)
    while open_.any() and left[0] >= 1 and left[1] >= 1:
        value = shares @ (left / capacity)
        fits = open_ & (demand <= left).all(axis=1)
        if fits.any():
            chosen = int(np.argmax(np.where(fits, value, -1.0)))
            length = len(waiting[chosen].ids)
        elif not cut and offset:
            break
        else:
            chosen = int(np.argmax(np.where(open_, value, -1.0)))
            length = _room(waiting[chosen], int(left[0]), int(left[2]))
            if not length:
                break
        piece = _head(waiting[chosen], length, sequence, offset)
        yield piece
        left -= (length, 1, piece.loss_tokens)
        offset += length
        if len(waiting[chosen].ids):
            break
        open_[chosen] = False
    waiting[:] = [e for e in waiting if len(e.ids)]


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space between words.

    Words between blanks are looked up, and the unknown ones of a batch are encoded as one
    text and told apart by their places in it, so a word is encoded about once per worker.
    ``added`` strings, matched before words are, make a text go through the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        size = self.tokenizer.get_vocab_size()
        names = (self.tokenizer.id_to_token(n) or "" for n in range(size))
        self.ends = np.fromiter((name.endswith("</w>") for name in names), bool, size)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words = [[] if not t else t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {"": b""}
        fresh = {word for word in set().union(*words) if word not in self.known}
        if fresh:
            self._learn(fresh)
        known = self.known.__getitem__
        ids = [np.frombuffer(b"".join(map(known, ws)), "<u4") for ws in words]
        for n, text in enumerate(texts):
            if text and any(a in text for a in self.added):
                whole = self.tokenizer.encode(text, add_special_tokens=False)
                ids[n] = np.array(whole.ids, "<u4")
        return ids

    def _learn(self, fresh: set[str]) -> None:
        """Letters with full stops or commas behind are two words of the tokenizer's own."""
        known, split, plain, other = self.known, [], set(), []
        for word in fresh:
            stem = word.rstrip(".,")
            if stem.isalpha() and (stem.isascii() or max(stem) < LATIN_END):
                low = stem.lower()
                if low not in known:
                    plain.add(low)
                if low != word:
                    split.append((word, low, word[len(stem) :]))
            else:
                other.append(word)
        other += [tail for tail in {tail for *_, tail in split} if tail not in known]
        self._encode(list(plain), self._by_endings)
        self._encode(other, self._by_places)
        known.update({word: known[low] + known[tail] for word, low, tail in split})

    def _encode(self, words: list[str], cuts: Callable[[list[str], Encoding], np.ndarray]) -> None:
        """Many words as one text; ``cuts`` tells where each one's ids end."""
        for at in range(0, len(words), 300):
            some = words[at : at + 300]
            text = " ".join(some)
            if any(a in text for a in self.added):
                # a text that holds such a word is encoded whole, so its ids are not asked for
                self.known.update(dict.fromkeys(some, b""))
                some = [w for w in some if not any(a in w for a in self.added)]
                text = " ".join(some)
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ends = (4 * cuts(some, encoded)).tolist()
            ids = np.array(encoded.ids, "<u4").tobytes()
            self.known.update({w: ids[b:e] for w, b, e in zip(some, [0, *ends], ends)})

    def _by_endings(self, words: list[str], encoded: Encoding) -> np.ndarray:
        """A word of letters ends with the one id that stands for the end of a word."""
        return np.flatnonzero(self.ends[np.array(encoded.ids, np.int64)]) + 1

    def _by_places(self, words: list[str], encoded: Encoding) -> np.ndarray:
        starts = np.array([place[0] for place in encoded.offsets], np.int64)
        return np.searchsorted(starts, np.cumsum([len(w) + 1 for w in words]), side="left")


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_for(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


SCHEMA = (
    "start long, length long, ids binary, total_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)


def _arrow_batch(key_type: pa.DataType, pieces: list[Piece]) -> pa.RecordBatch:
    columns = {
        "key": (pa.array([p.key for p in pieces], key_type)),
        "start": pa.array([p.start for p in pieces], pa.int64()),
        "length": pa.array([len(p.ids) for p in pieces], pa.int64()),
        "ids": pa.array([p.ids.astype("<u4").tobytes() for p in pieces], pa.binary()),
        "total_tokens": pa.array([p.total for p in pieces], pa.int64()),
        "sequence_id": pa.array([p.sequence for p in pieces], pa.int64()),
        "offset": pa.array([p.offset for p in pieces], pa.int64()),
        "loss_tokens": pa.array([p.loss_tokens for p in pieces], pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _packed(
    rows: DataFrame, read: Callable[[pa.RecordBatch], Iterator[Example]], limits: Limits, cut: bool
) -> DataFrame:
    def task(batches):
        first = TaskContext.get().partitionId() << 40
        key_type = pa.int64()

        def examples():
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("key").type
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    yield from read(batch.slice(at, BATCH_ROWS))

        out, size = [], 0
        for piece in pack(examples(), limits, first, cut):
            out.append(piece)
            size += len(piece.ids)
            if size > 1 << 18:
                yield _arrow_batch(key_type, out)
                out, size = [], 0
        if out:
            yield _arrow_batch(key_type, out)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(task, f"key {kind}, {SCHEMA}")


def pack_examples(examples: DataFrame, limits: Limits = Limits(), cut: bool = False) -> DataFrame:
    """Pack rows (key, ids array<int>, loss array<boolean>), as made from instruction data.

    One row per piece: key, start in the example, length, ids (little-endian unsigned 32-bit),
    total_tokens of the example, sequence_id, offset in the sequence, loss_tokens. Null ids,
    and no ids, make no piece; a null ``loss`` means that every id bears loss. Further columns
    are not read. Repeated rows and keys are examples of their own.
    """

    def read(batch: pa.RecordBatch) -> Iterator[Example]:
        for row in batch.to_pylist():
            ids = np.array(row["ids"] or [], "<u4")
            loss = np.ones(len(ids), bool) if row["loss"] is None else np.array(row["loss"], bool)
            yield Example(row["key"], ids, loss)

    return _packed(examples.select("key", "ids", "loss"), read, limits, cut)


def pack_texts(
    texts: DataFrame,
    key: str,
    text: str,
    tokenizer_path: str,
    end_id: int = 2,
    limits: Limits = Limits(),
    cut: bool = True,
) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id`` and pack them; all ids bear loss.

    The result is that of :func:`pack_examples` with the key under its own name. A null text
    counts as empty, an empty one is the end id alone; a null key stays null; equal rows are
    packed each for itself; an empty table gives no row. Further columns are not read.
    """
    name = key

    def read(batch: pa.RecordBatch) -> Iterator[Example]:
        encoder = tokenizer_for(tokenizer_path)
        keys = batch.column(0).to_pylist()
        for one, ids in zip(keys, encoder.encode(batch.column(1).to_pylist())):
            ids = np.append(ids, np.uint32(end_id))
            yield Example(one, ids, np.ones(len(ids), bool))

    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return _packed(rows, read, limits, cut).withColumnRenamed("key", name)
