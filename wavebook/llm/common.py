"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a Python batch: a batch is whole texts, so few rows keep a worker small.
BATCH_ROWS = 64

#: Entries a worker remembers before it starts afresh.
MEMO_ENTRIES = 400_000

#: Buckets of :func:`keep_possible`; bounds what it broadcasts to so many integers.
FILTER_BUCKETS = 1 << 20

#: Bits of a hash by which :func:`first_by_hash` counts rows before it ranks some.
HASH_BITS = 12


def fresh(name: str) -> str:
    """A column name that no input table has."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def first_by_hash(rows: DataFrame, group: str, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of each group, those whose keys have the smallest hashes.

    Rows are counted by group and beginning of the hash first, so that only those whose
    beginnings can hold chosen rows are ranked, however large a group is. The number of groups
    must be small: what is broadcast are 2 ** HASH_BITS numbers a group at most.
    """
    hashed, part, place, earlier = (fresh(n) for n in ("hashed", "part", "place", "earlier"))
    beginning = F.shiftrightunsigned(hashed, 64 - HASH_BITS)
    dealt = rows.withColumn(hashed, F.xxhash64(F.col(key), F.lit(seed))).withColumn(part, beginning)
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(group, part).count().withColumn(earlier, F.coalesce(F.sum("count").over(before), F.lit(0)))
    needed = sizes.where(F.col(earlier) < most).select(group, part)
    order = Window.partitionBy(group).orderBy(part, hashed, key)
    ranked = dealt.join(F.broadcast(needed), [group, part]).withColumn(place, F.row_number().over(order))
    return ranked.where(F.col(place) <= most).select(*rows.columns)


def _bucket(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BUCKETS)).cast("int")


def _marked(rows: DataFrame, listed: DataFrame, keys: dict[str, str]) -> tuple[DataFrame, str]:
    """Add a column that is null where the row's keys are not listed for certain."""
    bucket, seen = fresh("bucket"), fresh("seen")
    buckets = listed.select(
        _bucket(*(F.col(c) for c in keys.values())).alias(bucket), F.lit(1).alias(seen)
    ).distinct()
    marked = rows.withColumn(bucket, _bucket(*(F.col(c) for c in keys)))
    return marked.join(F.broadcast(buckets), bucket, "left").drop(bucket), seen


def _same(keys: dict[str, str], names: dict[str, str]) -> Column:
    equal = F.lit(True)
    for own, other in keys.items():
        equal = equal & F.col(own).eqNullSafe(F.col(names[other]))
    return equal


def _listed_join(rows: DataFrame, listed: DataFrame, keys: dict[str, str], how: str) -> DataFrame:
    names = {c: fresh("listed") for c in keys.values()}
    other = listed.select(*(F.col(c).alias(n) for c, n in names.items()))
    return rows.join(other.hint("merge"), _same(keys, names), how)


def keep_possible(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose key may be among the wanted keys, without a shuffle of the rows.

    Only bucket numbers are broadcast, FILTER_BUCKETS of them at most whatever the number
    of wanted keys. Some rows that are not wanted pass; an exact join must follow.
    """
    marked, seen = _marked(rows, wanted, {key: wanted_key})
    return marked.where(F.col(seen).isNotNull()).drop(seen)


def only_listed(rows: DataFrame, listed: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The rows whose keys (own name to listed name) are listed; null equals null."""
    marked, seen = _marked(rows, listed, keys)
    doubtful = marked.where(F.col(seen).isNotNull()).drop(seen)
    return _listed_join(doubtful, listed, keys, "left_semi")


def drop_listed(rows: DataFrame, listed: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The rows whose keys are not listed; only those that may be are shuffled."""
    marked, seen = _marked(rows, listed, keys)
    clear = marked.where(F.col(seen).isNull()).drop(seen)
    doubtful = marked.where(F.col(seen).isNotNull()).drop(seen)
    return clear.unionByName(_listed_join(doubtful, listed, keys, "left_anti"))


class Memo(dict):
    """Word to 64-bit hash, remembered; emptied when it has grown to MEMO_ENTRIES."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_MEMO = Memo()

#: A-Z to a-z; every other byte stays, so UTF-8 stays UTF-8.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def blank_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_MEMO.__getitem__, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words.

    Fewer words make one shingle of them all; no words make the empty set.
    """
    hashes = word_hashes(blank_words(text))
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    count = len(hashes) - width + 1
    mixed = np.full(count, width, np.uint64)
    for place in range(width):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[place : place + count])
    return np.unique(mixed)
