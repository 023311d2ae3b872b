"""Large CSV files with line breaks in answers, read by many tasks each.

Spark's text reader deals whole lines of one file to many tasks, by ranges of bytes. A line is
inside an answer when the quotes before it, from the start of its file, are odd in number. So
each range first counts its quotes; a running sum over the ranges tells for each whether it
starts inside an answer; and then each range puts its lines together to records. What a range
has of a record that goes on in the next one is put together from the few such fragments.

Counting quotes is right where quotes stand as the format has them: around a field, doubled
inside it. The first pass checks every line for that, both for starting inside an answer and
for starting outside, and whether all records of a file end as its first line does, in LF or in
CR LF. If not, the files are left to Spark's own reader, one task a file. As there, a file whose
lines end in CR LF has its line breaks in answers told as LF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavebook.session import staged

_INSIDE = r'(?:[^"]++|"")*+'
_OUTSIDE = rf'(?:(?:"{_INSIDE}"|[^",]*+),)*+(?:"{_INSIDE}(?:"\r?)?|[^",]*+)'
#: What a line is made of that starts outside an answer, and one that starts inside.
LINES = (re.compile(_OUTSIDE), re.compile(rf'{_INSIDE}(?:"(?:\r?|,{_OUTSIDE}))?'))

#: A whole record; the end of one, from the start of a range; the beginning of one, up to the
#: end of a range; and a whole range in the middle of one.
WHOLE, END, BEGINNING, MIDDLE = range(4)


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): every line, by its file and the first byte of its range."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The parts of a batch that lie in one range, with its file and start."""
    file, start = (batch.column(n).to_numpy() for n in (1, 2))
    borders = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    edges = [0, *borders.tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        if low < high:
            yield (int(file[low]), int(start[low])), batch.slice(low, high - low)


#: What is known of a range, each number for starting outside an answer and for starting inside:
#: stray quotes, records that end in CR LF or in LF, and whether its last line ends one in LF.
_NUMBERS = ("stray", "with_cr", "without_cr", "last_without_cr")
_RANGE = "file long, start long, crlf boolean, odd int, " + ", ".join(f"{name} array<long>" for name in _NUMBERS)


class _Counts:
    """The quotes and line ends of a range, added up batch by batch."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.odd, self.crlf = key, 0, None
        self.numbers = {name: [0, 0] for name in _NUMBERS}

    def add(self, lines: pa.Array) -> None:
        stray = self.numbers["stray"]
        if self.key[1] == 0 and self.crlf is None:
            first = lines[0].as_py()
            self.crlf = first.endswith("\r")
            # a single CR in the first line may be taken for its end
            stray[:] = [int("\r" in first[:-1])] * 2
        quotes = pc.count_substring(lines, '"').to_numpy()
        with_cr = pc.ends_with(lines, "\r").to_numpy(zero_copy_only=False)
        after = (self.odd + np.cumsum(quotes)) % 2
        for at in np.flatnonzero(quotes).tolist():
            line = lines[at].as_py()
            inside = int(after[at] + quotes[at]) % 2
            for begun in (0, 1):
                stray[begun] += not LINES[inside ^ begun].fullmatch(line)
        for begun in (0, 1):
            ends = after == begun
            self.numbers["with_cr"][begun] += int((ends & with_cr).sum())
            self.numbers["without_cr"][begun] += int((ends & ~with_cr).sum())
            self.numbers["last_without_cr"][begun] = int(ends[-1] and not with_cr[-1])
        self.odd = int(after[-1])

    def row(self) -> pa.RecordBatch:
        numbers = [pa.array([self.numbers[name]], pa.list_(pa.int64())) for name in _NUMBERS]
        key = [pa.array([n], pa.int64()) for n in self.key]
        ends = [pa.array([self.crlf], pa.bool_()), pa.array([self.odd], pa.int32())]
        return pa.RecordBatch.from_arrays([*key, *ends, *numbers], ["file", "start", "crlf", "odd", *_NUMBERS])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = None
    for batch in batches:
        for key, part in _stretches(batch):
            if counts is None or key != counts.key:
                if counts is not None:
                    yield counts.row()
                counts = _Counts(key)
            counts.add(part.column(0))
    if counts is not None:
        yield counts.row()


@dataclass
class _Range:
    """The records of a range, put together line by line."""

    inside: bool
    first: bool
    #: Whether the record now open began in an earlier range.
    earlier: bool = False
    open: list[str] = field(default_factory=list)

    def records(self, lines: pa.Array) -> Iterator[tuple[pa.Array, int]]:
        quotes = pc.count_substring(lines, '"').to_numpy()
        after = (int(self.inside) + np.cumsum(quotes)) % 2
        before = (after + quotes) % 2
        single = (before == 0) & (after == 0)
        chosen = np.flatnonzero(~single).tolist()
        start = 0
        for at in chosen:
            yield lines.slice(start, at - start), WHOLE
            start = at + 1
            self.open.append(lines[at].as_py())
            if not after[at]:
                yield pa.array(["\n".join(self.open)], pa.string()), END if self.earlier else WHOLE
                self.open, self.earlier = [], False
        yield lines.slice(start), WHOLE
        self.inside = bool(after[-1])

    def rest(self) -> Iterator[tuple[pa.Array, int]]:
        if self.open:
            yield pa.array(["\n".join(self.open)], pa.string()), MIDDLE if self.earlier else BEGINNING


#: Bytes of records that are handed on together, unless one record alone has more.
BATCH_BYTES = 32 * 1024 * 1024


def _batch(key: tuple[int, int], own: _Range, texts: list[pa.Array], kinds: list[int]) -> pa.RecordBatch:
    """Records of one range: empty ones are left out, the first of a file is its heading."""
    records = pa.concat_arrays(texts)
    kind = np.repeat(np.array(kinds, np.int32), [len(text) for text in texts])
    kept = pc.not_equal(records, "").to_numpy(zero_copy_only=False) | (kind != WHOLE)
    records, kind = records.filter(pa.array(kept)), kind[kept]
    heading = np.zeros(len(records), bool)
    if len(records):
        heading[0], own.first = own.first, False
    places = [pa.array(np.full(len(records), n, np.int64)) for n in key]
    return pa.RecordBatch.from_arrays(
        [records, pa.array(kind), pa.array(heading), *places], ["record", "kind", "heading", "file", "start"]
    )


def _assembled(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """(record, kind, heading, file, start): the whole records of all ranges, or else the fragments.

    What a batch of lines gives is handed on together: a batch for each record would cost more
    than reading it.
    """

    def told(key, own, pieces):
        texts, kinds, size = [], [], 0
        for records, kind in pieces:
            if not len(records):
                continue
            if texts and size + records.nbytes > BATCH_BYTES:
                yield _batch(key, own, texts, kinds)
                texts, kinds, size = [], [], 0
            texts.append(records.cast(pa.string()))
            kinds.append(kind)
            size += records.nbytes
        if texts:
            yield _batch(key, own, texts, kinds)

    def wanted(found):
        for records in found:
            kind = records.column(1).to_numpy()
            yield records.filter(pa.array((kind == WHOLE) == whole))

    def ranged():
        current, own = None, None
        for batch in batches:
            for key, part in _stretches(batch):
                if key != current:
                    if own is not None:
                        yield from told(current, own, own.rest())
                    inside = part.column(3)[0].as_py()
                    if inside is None:
                        raise RuntimeError("the files or their ranges have changed since they were counted: read them again")
                    current, own = key, _Range(inside, first=key[1] == 0, earlier=inside)
                lines = part.column(0)
                if part.column(4)[0].as_py():
                    lines = pc.replace_substring_regex(lines, r"\r$", "")
                yield from told(key, own, own.records(lines))
        if own is not None:
            yield from told(current, own, own.rest())

    return wanted(ranged())


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """One row for each range of the files, and whether it starts ``inside`` an answer; written once.

    ``crlf`` tells how the first line of its file ends.
    """
    counted = _text_lines(spark, path).mapInArrow(_counted, _RANGE)
    file = Window.partitionBy("file")
    earlier = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0)) == 1
    return staged(counted.withColumn("inside", inside).withColumn("crlf", F.max("crlf").over(file)), "ranges")


def need_one_task(found: DataFrame) -> bool:
    """Whether quotes or line ends stand where the format has none, or an answer is never closed."""

    def own(name: str) -> Column:
        return F.col(name)[F.col("inside").cast("int")]

    # a file's last line may have no end at all
    bare = F.sum(own("without_cr")) - F.max_by(own("last_without_cr"), "start")
    files = found.groupBy("file").agg(
        F.sum(own("stray")).alias("stray"),
        (F.sum("odd") % 2).alias("open"),
        F.when(F.first("crlf"), bare).otherwise(F.sum(own("with_cr"))).alias("other_ends"),
    )
    return not files.where("stray > 0 or open = 1 or other_ends > 0").isEmpty()


def records(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """(record, heading): the text of every record, whichever ranges it lies in; no row is shuffled.

    Only fragments, at most two a range, are grouped. They are taken from a pass of their own,
    over the ranges that begin or end inside an answer.
    """
    kinds = "record string, kind int, heading boolean, file long, start long"
    lines = _text_lines(spark, path)

    def told(some: DataFrame, how: str, whole: bool) -> DataFrame:
        # one row a range, a few bytes each
        marked = lines.join(F.broadcast(some.select("file", "start", "inside", "crlf")), ["file", "start"], how)
        return marked.select("value", "file", "start", "inside", "crlf").mapInArrow(partial(_assembled, whole=whole), kinds)

    whole = told(found, "left", whole=True).select("record", "heading")
    broken = found.where(F.col("inside") | (F.col("inside").cast("int") + F.col("odd") == 1))
    if broken.isEmpty():
        return whole
    fragments = told(broken, "inner", whole=False)
    begun = F.sum((F.col("kind") == BEGINNING).cast("int"))
    # the end of a record comes before the beginning of the next one of the same range
    numbered = fragments.withColumn(
        "number", begun.over(Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    )
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("heading").alias("heading")
    )
    return whole.unionByName(joined.select("record", "heading"))


def parsed(rows: DataFrame, names: list[str], options: dict[str, str]) -> DataFrame:
    """One text column for each name; raises if a heading has other names."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    fields = F.from_csv("record", ", ".join(f"{name} string" for name in quoted), options)
    # the output of a generator, so that no filter makes it be worked out again
    split = rows.select("heading", F.explode(F.array(fields)).alias("fields"))

    def value(name: str) -> Column:
        return F.col(f"fields.{name}")

    found = F.array(*(F.coalesce(value(name), F.lit("")) for name in quoted))
    wrong = F.raise_error(F.concat(F.lit("a header differs from the first file's: "), F.array_join(found, ", ")))
    expected = F.array(*(F.lit(name.lower()) for name in names))
    same = F.transform(found, F.lower) == expected
    kept = F.when(~F.col("heading"), True).when(same, False).otherwise(wrong.cast("boolean"))
    return split.where(kept).select(*(value(name).alias(own) for name, own in zip(quoted, names)))
