"""Looking values up in a table whose size is not known beforehand."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes up to which a lookup table is sent to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024

#: A key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def new_name(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def text_bytes(lookup: DataFrame) -> int:
    """Bytes of a table of text columns.

    The optimizer's estimate does not see how far an explode widens its input, so they
    are added up.
    """
    widths = [F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) for name in lookup.columns]
    row = sum(widths[1:], widths[0]) + 64
    return lookup.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0]


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that hold HOT_SHARE of all rows or more; counted before the shuffle."""
    count = new_name("count")
    least = rows.select(F.count(F.lit(1)) * F.lit(HOT_SHARE)).scalar()
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return counted.where(F.col(count) >= least).drop(count)


def lookup_left(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a lookup table of text columns, unique by ``keys``.

    A small lookup is broadcast. Beside a large one, only its entries for hot keys are, a
    bounded number; all other rows are shuffled and merged, and none of their keys holds more
    than a small share. Rows without a key do not take part in any join.
    """
    if text_bytes(lookup) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), keys, "left")
    values = [name for name in lookup.columns if name not in keys]
    keyed = _all(F.col(f"`{key}`").isNotNull() for key in keys)
    hot = new_name("hot")
    book = hot_keys(rows.where(keyed), keys).join(lookup, keys, "left").withColumn(hot, F.lit(True))
    marked = rows.where(keyed).join(F.broadcast(book), keys, "left")
    wanted = [*rows.columns, *values]
    settled = marked.where(F.col(hot).isNotNull()).select(*map(_quoted, wanted))
    others = marked.where(F.col(hot).isNull()).drop(hot, *values)
    merged = others.join(lookup.hint("merge"), keys, "left").select(*map(_quoted, wanted))
    empty = [F.lit(None).cast(lookup.schema[name].dataType).alias(name) for name in values]
    without = rows.where(~keyed).select(*map(_quoted, rows.columns), *empty)
    joined = settled.unionByName(merged).unionByName(without)
    ordered = [*keys, *(name for name in wanted if name not in keys)]
    return joined.select(*map(_quoted, ordered))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _all(conditions) -> Column:
    every = F.lit(True)
    for condition in conditions:
        every = every & condition
    return every
