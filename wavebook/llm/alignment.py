"""Alignment of two tokenizers by fragments that compose.

Two token sequences of one text are cut into groups where tokens of both end at one byte. A
fragment tells what is known of a range of bytes: the tokens up to the first common end (open
prefix), the groups behind it (closed), and the tokens after the last common end (open
suffix). Fragments of neighbouring ranges compose, and that is associative: a suffix and the
prefix behind it become a closed group. So ranges of a long text are worked on by different
tasks and composed as a tree, and a short text is composed from its words in one task.

A text is cut before a blank that follows a letter, digit or sign. Neither tokenizer has a
token across such a place, so each part between two places is tokenized on its own, and the
parts that occur again and again once per worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import BATCH_ROWS
from wavebook.session import staged

#: How the byte-level vocabulary splits text, and the bytes that stand for themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: White space, invisible characters and the sign that stands for a blank: no cut behind these.
_BLANKS = r"\s᠎​-‍⁠﻿▁"
CUT = re.compile(rf"(?<=[^{_BLANKS}]) (?!\Z)")
_NO_CUT = re.compile(rf"[{_BLANKS}] |\A | \Z")

#: What stands behind an id: another of its group, the other side, a group, a part.
_MARKS = ",|;\n"

#: Characters of a range; a longer text is worked on by several tasks. A border between two
#: ranges needs a cut so near on both sides, else the two stay one.
RANGE, NEAR = 1 << 15, 1 << 12
#: Fragments composed in one step of the tree.
FAN_IN = 8
#: Parts of texts a worker remembers, with their fragments.
KNOWN_PARTS = 300_000
#: Id pairs whose counts every task gets to know, sixteen bytes each; the rarer ones are joined.
KEPT_PAIRS = 1 << 20


def _byte_level_ranks(path: str) -> dict[bytes, int]:
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    rest = [b for b in range(256) if b not in PRINTED]
    byte_of = {chr(b): b for b in PRINTED} | {chr(256 + n): b for n, b in enumerate(rest)}
    special = {token["content"] for token in found["added_tokens"]}
    vocabulary = found["model"]["vocab"].items()
    return {bytes(map(byte_of.__getitem__, t)): n for t, n in vocabulary if t not in special}


def _piece_bytes(pieces: sentencepiece.SentencePieceProcessor, n: int) -> bytes:
    name = pieces.id_to_piece(n)
    return bytes([int(name[3:5], 16)]) if pieces.is_byte(n) else name.replace("▁", " ").encode()


def _numbers(values=()) -> np.ndarray:
    return np.array(values, np.int64)


@dataclass
class Tokens:
    """Ids of both tokenizers and the bytes of the text at which they end."""

    a: np.ndarray = field(default_factory=_numbers)
    a_ends: np.ndarray = field(default_factory=_numbers)
    b: np.ndarray = field(default_factory=_numbers)
    b_ends: np.ndarray = field(default_factory=_numbers)

    def __add__(self, other: Tokens) -> Tokens:
        pairs = zip(self.parts(), other.parts())
        return Tokens(*(np.concatenate(p) for p in pairs))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def between(self, low: int, high: int) -> Tokens:
        """The tokens that end behind ``low``, and at ``high`` at the latest."""
        of_a = (self.a_ends > low) & (self.a_ends <= high)
        of_b = (self.b_ends > low) & (self.b_ends <= high)
        return Tokens(self.a[of_a], self.a_ends[of_a], self.b[of_b], self.b_ends[of_b])

    def moved(self, by: int) -> Tokens:
        return replace(self, a_ends=self.a_ends + by, b_ends=self.b_ends + by)

    def pairs(self, pieces: int) -> np.ndarray:
        """One number, a * pieces + b, for each pair of tokens that overlap.

        Between two neighbouring ends of either tokenizer lies exactly one such pair.
        """
        ends = np.union1d(self.a_ends, self.b_ends)
        return self.a[np.searchsorted(self.a_ends, ends)] * pieces + self.b[np.searchsorted(self.b_ends, ends)]

    def text(self) -> str:
        """The tokens as one group: ``a1,a2|b1``."""
        return f"{','.join(map(str, self.a.tolist()))}|{','.join(map(str, self.b.tolist()))}"


@dataclass
class Fragment:
    """What is known of a range; without a common end in it all tokens are its prefix."""

    sound: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    cut: bool = False
    prefix: Tokens = field(default_factory=Tokens)
    suffix: Tokens = field(default_factory=Tokens)
    pairs: np.ndarray = field(default_factory=_numbers)
    times: np.ndarray = field(default_factory=_numbers)


def _counted(pairs: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if times is None:
        return np.unique(pairs, return_counts=True)
    found, place = np.unique(pairs, return_inverse=True)
    return found, np.bincount(place, times, len(found)).astype(np.int64)


def fragment_of(tokens: Tokens, pieces: int, sound: bool = True) -> tuple[Fragment, str]:
    """The fragment of some tokens, and its closed groups as text."""
    common = np.intersect1d(tokens.a_ends, tokens.b_ends)
    made = Fragment(sound, len(tokens.a), len(tokens.b))
    if not len(common):
        made.prefix = tokens
        return made, ""
    first, last = int(common[0]), int(common[-1])
    closed = tokens.between(first, last)
    made.cut, made.n_groups = True, len(common) - 1
    made.prefix, made.suffix = tokens.between(-1, first), tokens.between(last, 1 << 62)
    if not made.n_groups:
        return made, ""
    made.pairs, made.times = _counted(closed.pairs(pieces))
    return made, group_text(closed, common[1:])


def group_text(tokens: Tokens, common: np.ndarray) -> str:
    """The groups that end at the common ends: ``a1,a2|b1;a3|b2,b3``."""
    own_a, own_b = list(map(str, tokens.a.tolist())), list(map(str, tokens.b.tolist()))
    at_a = np.searchsorted(tokens.a_ends, common, side="right").tolist()
    at_b = np.searchsorted(tokens.b_ends, common, side="right").tolist()
    return ";".join(
        f"{','.join(own_a[i:j])}|{','.join(own_b[k:m])}"
        for i, j, k, m in zip([0, *at_a], at_a, [0, *at_b], at_b)
    )


def compose(left: Fragment, right: Fragment, pieces: int) -> Fragment:
    """The fragment of two neighbouring ranges; ``Fragment()`` is the neutral one."""
    made = Fragment(
        left.sound and right.sound,
        left.n_a + right.n_a,
        left.n_b + right.n_b,
        left.n_groups + right.n_groups,
        left.cut or right.cut,
        left.prefix,
        right.suffix,
    )
    pairs, times = [left.pairs, right.pairs], [left.times, right.times]
    if left.cut and right.cut:
        middle = left.suffix + right.prefix
        if len(middle.a):
            made.n_groups += 1
            pairs.append(middle.pairs(pieces))
            times.append(np.ones(len(pairs[-1]), np.int64))
    elif left.cut:
        made.suffix = left.suffix + right.prefix
    else:
        made.prefix = left.prefix + right.prefix
    made.pairs, made.times = _counted(np.concatenate(pairs), np.concatenate(times))
    return made


def closed(whole: Fragment, pieces: int) -> Fragment:
    """The fragment of a whole text: its prefix is a group as well; unsound ones have nothing."""
    if not whole.sound:
        return Fragment(sound=False)
    start = Fragment(cut=True)
    return compose(start, whole, pieces)


#: A part of a text between two cuts: its groups as text (empty if it is not sound), its pairs
#: as bytes, and how many A tokens it has.
Part = tuple[str, bytes, int]
UNSOUND: Part = ("", b"", 0)


class Aligner:
    """Both tokenizers and the parts seen by one worker."""

    def __init__(self, byte_path: str, piece_path: str):
        ranks = _byte_level_ranks(byte_path)
        self.bytes_ = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = {n: token for token, n in ranks.items()}
        self.words = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.pieces = self.words.get_piece_size()
        self.b_bytes = [_piece_bytes(self.words, n) for n in range(self.pieces)]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(t) for t in self.a_bytes.values()]
        self.b_size = _numbers([len(t) for t in self.b_bytes])
        # every id as text with what may stand behind it in a list of groups
        highest = max(len(self.a_size), self.pieces)
        self.names = [f"{n}{mark}" for n in range(highest) for mark in _MARKS]
        self.known: dict[str, Part] = {}

    def tokens(self, text: str) -> tuple[Tokens, bool]:
        """Tokens of a blank and the text, and whether both join to that again."""
        whole = f" {text}".encode()
        a, b = self.bytes_.encode_ordinary(f" {text}"), self.words.encode(text)
        sound = b"".join(map(self.b_bytes.__getitem__, b)) == whole == b"".join(map(self.a_bytes.__getitem__, a))
        a, b = _numbers(a), _numbers(b)
        return Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b])), sound

    def parts(self, texts: list[str]) -> list[list[Part]]:
        """The parts of each text, in order."""
        cut = [t.split(" ") if not _NO_CUT.search(t) else CUT.split(t) for t in texts]
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        fresh_ = [part for part in set().union(*cut) if part not in self.known]
        # the last part of a text may end with a blank, which would hide a cut behind it
        last = {some[-1] for some in cut}
        plain = [part for part in fresh_ if part not in last]
        for at in range(0, len(plain), 1024):
            self._learn(plain[at : at + 1024])
        for part in last:
            if part not in self.known:
                self._learn([part])
        known = self.known.__getitem__
        return [list(map(known, some)) for some in cut]

    def _learn(self, fresh_: list[str]) -> None:
        """Many parts as one text; each ends where a token of both ends."""
        tokens, sound = self.tokens(" ".join(fresh_))
        if not sound:
            if len(fresh_) == 1:
                self.known[fresh_[0]] = UNSOUND
            for part in fresh_ if len(fresh_) > 1 else ():
                self._learn([part])
            return
        ends = np.cumsum([len(part.encode()) + 1 for part in fresh_])
        both = np.union1d(tokens.a_ends, tokens.b_ends)
        groups = self._group_texts(tokens, ends)
        pairs, at = tokens.pairs(self.pieces).tobytes(), (8 * np.searchsorted(both, ends, side="right")).tolist()
        n_a = np.diff(np.searchsorted(tokens.a_ends, ends, side="right"), prepend=0).tolist()
        own = [pairs[i:j] for i, j in zip([0, *at], at)]
        self.known.update(zip(fresh_, zip(groups, own, n_a)))

    def _group_texts(self, tokens: Tokens, ends: np.ndarray) -> list[str]:
        """The groups of each part as text: ids and the marks behind them, put in order at once."""
        common = np.intersect1d(tokens.a_ends, tokens.b_ends)
        at_a = np.searchsorted(tokens.a_ends, common, side="right")
        at_b = np.searchsorted(tokens.b_ends, common, side="right")
        group_a = np.searchsorted(common, tokens.a_ends)
        group_b = np.searchsorted(common, tokens.b_ends)
        codes = np.zeros(len(tokens.a) + len(tokens.b), np.int64)
        mark_a = np.where(common[group_a] == tokens.a_ends, 1, 0)
        mark_b = np.where(common[group_b] == tokens.b_ends, 2, 0) + np.isin(tokens.b_ends, ends)
        codes[np.arange(len(tokens.a)) + np.concatenate([[0], at_b])[group_a]] = len(_MARKS) * tokens.a + mark_a
        codes[np.arange(len(tokens.b)) + at_a[group_b]] = len(_MARKS) * tokens.b + mark_b
        return "".join(map(self.names.__getitem__, codes.tolist())).split(_MARKS[3])[:-1]

    def whole(self, parts: list[Part]) -> tuple[Fragment, str]:
        """The closed fragment of one part or more, and its groups."""
        texts, pairs, a = zip(*parts)
        if "" in texts:
            return Fragment(sound=False), ""
        groups = ";".join(texts)
        n_a, n_groups = sum(a), groups.count(";") + 1
        # a group of m and n ids has m + n - 2 commas
        n_b = groups.count(",") + 2 * n_groups - n_a
        found, times = _counted(np.frombuffer(b"".join(pairs), np.int64))
        return Fragment(True, n_a, n_b, n_groups, True, pairs=found, times=times), groups

    def range_(self, text: str, low: int, high: int, base: int) -> tuple[Fragment, str]:
        """The fragment of the tokens that end behind ``low`` and up to ``high``.

        ``text`` reaches from the cut before ``low`` to the one behind ``high``; all three
        count from the cut, which is byte ``base`` of the whole text. The first and the last
        part may be cut by the range; all between are whole.
        """
        own = CUT.split(text)
        sizes = [len(part.encode()) + 1 for part in (own[0], own[-1])]
        last = len(text.encode()) + 1 - sizes[1] if len(own) > 1 else 0
        made, texts = Fragment(), []
        for part, start in [(own[0], 0), (None, 0), (own[-1], last)][: 1 if len(own) == 1 else 3]:
            if part is None:
                if len(own) == 2:
                    continue
                more, groups = self.whole(self.parts([" ".join(own[1:-1])])[0])
            else:
                tokens, sound = self.tokens(part)
                if not sound:
                    return Fragment(sound=False), ""
                more, groups = fragment_of(tokens.moved(start).between(low, high).moved(base), self.pieces)
            if not more.sound:
                return Fragment(sound=False), ""
            # a part that is not the first starts at a common end, so its prefix is a group
            if made.cut and more.cut and len(more.prefix.a):
                texts.append(more.prefix.text())
            texts.append(groups)
            made = compose(made, more, self.pieces)
        return made, ";".join(filter(None, texts))


def ranges_of(text: str, size: int, near: int) -> Iterator[tuple[str, int, int, int]]:
    """(text, low, high, base) for every range of a text, see :meth:`Aligner.range_`.

    Borders stand every ``size`` characters, also inside a word. Where there is no cut near,
    there is no border, so no part is tokenized more than twice.
    """

    def bytes_of(start: int, end: int) -> int:
        """UTF-8 bytes between two characters; the blank before the text is character -1."""
        return len(text[max(start, 0) : end].encode()) + (start < 0)

    start, low, base, at = -1, 0, 0, size
    while True:
        before = after = None
        while at < len(text):
            places = [m.start() for m in CUT.finditer(text, max(0, at - near), min(len(text), at + near))]
            before = max((p for p in places if start < p <= at), default=None)
            after = min((p for p in places if p >= at), default=None)
            if before is not None and after is not None:
                break
            at += size
        if at >= len(text):
            yield text[start + 1 :], low, bytes_of(start, len(text)), base
            return
        yield text[start + 1 : after], low, bytes_of(start, at), base
        base += bytes_of(start, before)
        start, low = before, bytes_of(before, at)
        at += size


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_for(byte_path: str, piece_path: str) -> Aligner:
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(byte_path, piece_path)
    return _ALIGNERS[key]


#: A fragment as columns; Tokens are four lists.
_TOKENS = "struct<a: array<long>, a_ends: array<long>, b: array<long>, b_ends: array<long>>"
_FRAGMENT = (
    "sound boolean, n_a long, n_b long, n_groups long, cut boolean, "
    f"prefix {_TOKENS}, suffix {_TOKENS}, pairs array<long>, times array<long>"
)
_ARROW_TOKENS = pa.struct([(name, pa.list_(pa.int64())) for name in ("a", "a_ends", "b", "b_ends")])
_ARROW_FRAGMENT = {
    "sound": pa.bool_(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "cut": pa.bool_(),
    "prefix": _ARROW_TOKENS,
    "suffix": _ARROW_TOKENS,
    "pairs": pa.list_(pa.int64()),
    "times": pa.list_(pa.int64()),
}


def _as_row(made: Fragment) -> list:
    tokens = [dict(zip(("a", "a_ends", "b", "b_ends"), t.parts())) for t in (made.prefix, made.suffix)]
    return [made.sound, made.n_a, made.n_b, made.n_groups, made.cut, *tokens, made.pairs, made.times]


def _as_fragment(row: dict) -> Fragment:
    tokens = [Tokens(*(_numbers(row[side][n]) for n in ("a", "a_ends", "b", "b_ends"))) for side in ("prefix", "suffix")]
    return Fragment(
        *(row[n] for n in ("sound", "n_a", "n_b", "n_groups", "cut")),
        *tokens,
        _numbers(row["pairs"]),
        _numbers(row["times"]),
    )


def _batch(rows: list[list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kind) for column, kind in zip(columns, kinds.values())], list(kinds)
    )


_FACTS = ["key", "row", "n_a", "n_b", "n_groups", "groups_sha256"]
_WHOLE = {
    "row": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "pairs": pa.list_(pa.int64()),
    "times": pa.list_(pa.int64()),
    "groups_sha256": pa.string(),
}
_WHOLE_SQL = "row long, n_a long, n_b long, n_groups long, pairs array<long>, times array<long>, groups_sha256 string"
_RANGE = {"range": pa.int64(), "low": pa.int64(), "high": pa.int64(), "base": pa.int64(), "part": pa.string()}
_RANGE_SQL = "range long, low long, high long, base long, part string"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _first_pass(rows: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """Rows (key, row, text): short texts told whole, longer ones as ranges still to be read."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_for(*paths)
        for batch in batches:
            kinds = {"key": batch.schema.field("key").type} | _WHOLE | _RANGE
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows_ = list(zip(*(column.to_pylist() for column in batch.slice(at, BATCH_ROWS).columns)))
                short = [row for row in rows_ if not row[2] or len(row[2]) <= size]
                out = []
                for (key, number, text), parts in zip(short, aligner.parts([t or "" for *_, t in short])):
                    made, groups = aligner.whole(parts) if text else (Fragment(), "")
                    counts = [made.n_a, made.n_b, made.n_groups]
                    out.append([key, number, *counts, made.pairs, made.times, _sha256(groups), *[None] * len(_RANGE)])
                if out:
                    yield _batch(out, kinds)
                for key, number, text in rows_:
                    if text and len(text) > size:
                        for n, (own, low, high, base) in enumerate(ranges_of(text, size, min(size, NEAR))):
                            empty = [None] * (len(_WHOLE) - 1)
                            yield _batch([[key, number, *empty, n, low, high, base, own]], kinds)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "row", "text").mapInArrow(task, f"key {kind}, {_WHOLE_SQL}, {_RANGE_SQL}")


def _range_fragments(ranges: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Every range's fragment and closed groups, dealt to tasks by row and range."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_for(*paths)
        kinds = {"row": pa.int64(), "range": pa.int64(), "groups": pa.string()} | _ARROW_FRAGMENT
        for batch in batches:
            for row in batch.to_pylist():
                made, groups = aligner.range_(row["part"], row["low"], row["high"], row["base"])
                yield _batch([[row["row"], row["range"], groups, *_as_row(made)]], kinds)

    dealt = ranges.select("row", "range", "low", "high", "base", "part").repartition("row", "range")
    return dealt.mapInArrow(task, f"row long, range long, groups string, {_FRAGMENT}")


def _composed(fragments: DataFrame, pieces: int) -> DataFrame:
    """Fragments of a row composed as a tree, FAN_IN at a time, until one is left."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"row": pa.int64(), "range": pa.int64()} | _ARROW_FRAGMENT
        current, made = None, Fragment()
        for batch in batches:
            for row in batch.to_pylist():
                place = (row["row"], row["range"] // FAN_IN)
                if place != current and current is not None:
                    yield _batch([[*current, *_as_row(made)]], kinds)
                    made = Fragment()
                current, made = place, compose(made, _as_fragment(row), pieces)
        if current is not None:
            yield _batch([[*current, *_as_row(made)]], kinds)

    rows = fragments.drop("groups")
    last = rows.agg(F.max("range")).first()[0] or 0
    while last > 0:
        step = F.floor(F.col("range") / FAN_IN)
        near = rows.repartition("row", step).sortWithinPartitions("row", "range")
        rows = staged(near.mapInArrow(task, f"row long, range long, {_FRAGMENT}"), "fragments")
        last //= FAN_IN
    return rows


def _digests(fragments: DataFrame) -> DataFrame:
    """(row, groups_sha256): a row's ranges in order, as a digest takes its bytes in order.

    One range is held at a time. The group across a border is written once its end is known.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"row": pa.int64(), "groups_sha256": pa.string()}
        current, digest, some, open_, sound = None, hashlib.sha256(), False, Tokens(), True

        def add(text: str) -> None:
            nonlocal some
            if text:
                digest.update((";" * some + text).encode())
                some = True

        for batch in batches:
            for row in batch.to_pylist():
                if row["row"] != current:
                    if current is not None:
                        yield _batch([[current, digest.hexdigest() if sound and some else ""]], kinds)
                    current, digest, some, open_, sound = row["row"], hashlib.sha256(), False, Tokens(), True
                sound = sound and row["sound"]
                own = _as_fragment(row | {"pairs": [], "times": []})
                open_ = open_ + own.prefix
                if own.cut:
                    if len(open_.a):
                        add(open_.text())
                    add(row["groups"])
                    open_ = own.suffix
        if current is not None:
            yield _batch([[current, digest.hexdigest() if sound and some else ""]], kinds)

    some = fragments.drop("pairs", "times").repartition("row").sortWithinPartitions("row", "range")
    return some.mapInArrow(task, "row long, groups_sha256 string")


def _closed(composed: DataFrame, pieces: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {name: kind for name, kind in _WHOLE.items() if name != "groups_sha256"}
        for batch in batches:
            for row in batch.to_pylist():
                made = closed(_as_fragment(row), pieces)
                yield _batch([[row["row"], made.n_a, made.n_b, made.n_groups, made.pairs, made.times]], kinds)

    return composed.mapInArrow(task, _WHOLE_SQL.removesuffix(", groups_sha256 string"))


def aligned_rows(rows: DataFrame, byte_path: str, piece_path: str, size: int = RANGE) -> DataFrame:
    """Rows (key, row, text), each row number once, with counts, pairs, times and the digest.

    ``pairs`` are the different linked id pairs, a * pieces + b, and ``times`` how often each is
    linked. Texts are read once; those of more than ``size`` characters are worked on by ranges.
    """
    paths, names = (byte_path, piece_path), ["key", *_WHOLE]
    told = staged(_first_pass(rows, paths, size), "aligned")
    whole = told.where("range is null").select(names)
    ranges = told.where("range is not null")
    if ranges.isEmpty():
        return whole
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    fragments = staged(_range_fragments(ranges, paths), "fragments")
    # each side has one row for a long text, and rows are numbered, so no key is hot
    tree = _closed(_composed(fragments, pieces), pieces).join(_digests(fragments).hint("merge"), "row")
    keys = ranges.where("range = 0").select("key", "row")
    return whole.unionByName(staged(tree.join(keys.hint("merge"), "row").select(names), "aligned"))


def _counts_of(pairs: DataFrame) -> DataFrame:
    """(pair, documents), counted before the shuffle."""
    listed = pairs.select(F.explode("pairs").alias("pair"))
    return listed.groupBy("pair").agg(F.count(F.lit(1)).alias("documents"))


def _kept_from(counts: DataFrame, most: int) -> int:
    """The least count from which on at most ``most`` pairs are left, from a few class sizes."""
    bits = F.floor(F.log2("documents") * 8).cast("int").alias("bits")
    classes = counts.groupBy(bits).agg(F.count(F.lit(1)).alias("n"), F.min("documents").alias("least"))
    total, least = 0, 1 << 62
    for row in sorted(classes.collect(), key=lambda r: -r.bits):
        total += row.n
        if total > most:
            break
        least = row.least
    return least


def link_scores(aligned: DataFrame, pieces: int, most: int = KEPT_PAIRS) -> DataFrame:
    """Add n_links, n_best and count_sum to aligned rows.

    A pair's count is the number of rows that hold it. The counts of the ``most`` frequent
    pairs at most, and the highest count of each A id, one number for an entry of the
    vocabulary, are broadcast. Rarer pairs are joined; none of them is hot, as the frequent
    ones are not among them.
    """
    spark = aligned.sparkSession
    counts = staged(_counts_of(aligned), "pairs")
    least = _kept_from(counts, most)
    kept = counts.where(F.col("documents") >= least).toArrow()
    order = np.argsort(kept.column("pair").to_numpy())
    known = kept.column("pair").to_numpy()[order]
    numbers = kept.column("documents").to_numpy()[order]
    of_a = F.floor(F.col("pair") / pieces)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("documents").alias("best"))
    found = highest.toArrow()
    best = np.zeros(max(found.column("a").to_pylist(), default=0) + 1, np.int64)
    best[found.column("a").to_numpy()] = found.column("best").to_numpy()
    shared = spark.sparkContext.broadcast((known, numbers, best))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            lengths = batch.column("pairs").value_lengths().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            count = np.zeros(len(pairs), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                count = np.where(known[place] == pairs, numbers[place], 0)
            top = (count > 0) & (count == best[pairs // pieces])
            totals = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for total, weights in zip(totals, (times, times * top, times * count)):
                np.add.at(total, owner, weights)
            rare = count == 0
            ends = np.cumsum([0, *np.bincount(owner[rare], minlength=batch.num_rows)])
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(some[rare])) for some in (pairs, times)]
            facts = [batch.column(name) for name in _FACTS]
            yield pa.RecordBatch.from_arrays(
                [*facts, *map(pa.array, totals), *lists],
                [*_FACTS, "n_links", "n_best", "count_sum", "rare", "rare_times"],
            )

    facts = ", ".join(f"{n} {aligned.schema[n].dataType.simpleString()}" for n in _FACTS)
    told = aligned.select(*_FACTS, "pairs", "times").mapInArrow(
        task, f"{facts}, n_links long, n_best long, count_sum long, rare array<long>, rare_times array<long>"
    )
    scarce = counts.where(F.col("documents") < least)
    if scarce.isEmpty():
        return told.drop("rare", "rare_times")
    told = staged(told, "links")
    wanted = told.select("row", F.inline(F.arrays_zip(F.col("rare").alias("pair"), F.col("rare_times").alias("n"))))
    looked_up = wanted.join(scarce.hint("merge"), "pair")
    # one row for an entry of the vocabulary at most
    looked_up = looked_up.withColumn("a", of_a).join(F.broadcast(highest), "a")
    more = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("documents") == F.col("best"), F.col("n")).otherwise(0)).alias("more_best"),
        F.sum(F.col("documents") * F.col("n")).alias("more_sum"),
    )
    return told.join(more.hint("merge"), "row", "left").select(
        *_FACTS,
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def align_texts(
    texts: DataFrame,
    key: str,
    text: str,
    byte_path: str,
    piece_path: str,
    size: int = RANGE,
    most: int = KEPT_PAIRS,
) -> DataFrame:
    """Align a byte-level tokenizer (A) with one of pieces (B) on every whole text.

    The result has the key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256,
    one row for each of the table. A null or empty text, and one that either tokenizer does not
    give back byte by byte behind a blank, has no tokens: zeros and an empty digest. Equal rows
    and keys are rows of their own and each counts; a null key stays null; an empty table gives
    no row. Further columns are not read, so their names do not matter.
    """
    rows = texts.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    told = link_scores(aligned_rows(rows, byte_path, piece_path, size), pieces, most)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return told.select(F.col("key").alias(key), *numbers)
