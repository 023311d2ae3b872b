"""A Merkle manifest of a dataset, with witnesses that grow as leaves are appended.

Leaves are hashed where they are read and numbered by their place in their tree. They are
appended in aligned blocks of ARITY ** LEVELS, each block by one task. The appender keeps the
open subtrees only; when the next siblings complete one of them, every leaf of it gets these
siblings as a further step of its witness. The roots of the blocks are leaves of the next
round, appended in the same way, until each tree has one root; and the roots of all trees are
appended to the tree of the whole dataset. So no task sees more than a block, however large a
tree is, and a leaf's witness is that of its block, then that of the block's block, and so on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavebook.llm.common import fresh
from wavebook.session import staged

#: Nodes that make one of the next level, and levels of a block: 2187 leaves.
ARITY, LEVELS = 3, 7

#: A step of a witness: the digests of the siblings on either side, thirty-two bytes each.
STEP = "struct<left: binary, right: binary>"
_ARROW_STEP = pa.struct([("left", pa.binary()), ("right", pa.binary())])


def node(digests: list[bytes]) -> bytes:
    """The digest of a run of nodes, which are hashed as lower-case hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


class Appender:
    """Leaves of one block appended one after another.

    ``open`` holds, for each level, the nodes that wait for siblings, each with the numbers of
    the leaves below it as a range. A leaf's witness is extended whenever a subtree above it is
    completed.
    """

    def __init__(self, arity: int, levels: int):
        self.arity, self.levels = arity, levels
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(levels + 1)]
        self.witness: list[list[tuple[bytes, bytes]]] = []

    def append(self, leaf: bytes) -> None:
        number = len(self.witness)
        self.witness.append([])
        self._add(0, (leaf, number, number + 1))

    def _add(self, level: int, new: tuple[bytes, int, int]) -> None:
        self.open[level].append(new)
        if len(self.open[level]) == self.arity and level < self.levels:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, *_ in run]
        for n, (_, first, end) in enumerate(run):
            step = (b"".join(digests[:n]), b"".join(digests[n + 1 :]))
            for leaf in range(first, end):
                self.witness[leaf].append(step)
        self._add(level + 1, (node(digests), run[0][1], run[-1][2]))

    def close(self, alone: bool) -> bytes:
        """Complete what is open and return the block's root.

        A block that is a whole tree ``alone`` ends at its first level with a single node; any
        other is raised to the level of its neighbours, through runs of one if need be.
        """
        for level in range(self.levels):
            higher = any(self.open[above] for above in range(level + 1, self.levels + 1))
            if self.open[level] and (higher or not alone or len(self.open[level]) > 1):
                self._complete(level)
        return next(run[0][0] for run in reversed(self.open) if run)


def _appended(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Nodes (tree, position, digest) with ``witness`` inside their block; a block's first node has its ``root``."""
    size = arity**levels

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            appender = Appender(arity, levels)
            for digest in block.column("digest").to_pylist():
                appender.append(digest)
            number = block.column("position")[0].as_py() // size
            # the first block is a whole tree unless it is full, and then both ends are the same
            root = appender.close(alone=number == 0)
            roots = pa.array([root] + [None] * (block.num_rows - 1), pa.binary())
            steps = [[{"left": a, "right": b} for a, b in steps] for steps in appender.witness]
            witness = pa.array(steps, pa.list_(_ARROW_STEP))
            return pa.RecordBatch.from_arrays([*block.columns, witness, roots], [*block.schema.names, "witness", "root"])

        held, current = [], None
        for batch in batches:
            starts = [0]
            places = list(zip(batch.column("tree").to_pylist(), (p // size for p in batch.column("position").to_pylist())))
            starts += [n for n in range(1, len(places)) if places[n] != places[n - 1]]
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                if start == end:
                    continue
                if held and places[start] != current:
                    yield told(held)
                    held = []
                current = places[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield told(held)

    block = F.floor(F.col("position") / size)
    dealt = nodes.repartition("tree", block).sortWithinPartitions("tree", "position")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return staged(dealt.mapInArrow(task, f"{kinds}, witness array<{STEP}>, root binary"), "witnesses")


def grow(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees over nodes (tree, position, digest, ...), positions of a tree without gaps from 0.

    Gives the nodes with the ``block`` they are in and their ``witness`` up to its root; and
    one row (tree, block, upper, top) for every block, with the steps from there to the top of
    the tree. A further round takes place as long as a tree has more than one block.
    """
    size = arity**levels
    rounds = [_appended(nodes, arity, levels)]

    def block_of(rows: DataFrame) -> Column:
        return F.floor(rows["position"] / size)

    def roots(rows: DataFrame) -> DataFrame:
        return rows.where("root is not null").select("tree", block_of(rows).alias("position"), F.col("root").alias("digest"))

    last = rounds[0].agg(F.max("position")).first()[0] or 0
    while last >= size:
        rounds.append(_appended(roots(rounds[-1]), arity, levels))
        last //= size
    tops = roots(rounds[-1])
    blocks = tops.select("tree", F.col("position").alias("block"), F.array().cast(f"array<{STEP}>").alias("upper"), F.col("digest").alias("top"))
    for rows in reversed(rounds[1:]):
        inner = rows.select(
            F.col("tree").alias("own"), block_of(rows).alias("above"), F.col("position").alias("number"), "witness"
        )
        # a block has a bounded number of nodes, so no key is hot, also where one tree is huge
        joined = inner.join(
            blocks.hint("merge"),
            F.col("own").eqNullSafe(F.col("tree")) & (F.col("above") == F.col("block")),
        )
        blocks = joined.select(
            F.col("own").alias("tree"), F.col("number").alias("block"), F.concat("witness", "upper").alias("upper"), "top"
        )
    first = rounds[0]
    return first.withColumn("block", block_of(first)).drop("root"), blocks


def positions(rows: DataFrame, tree: str, order: list[str], position: str) -> DataFrame:
    """Add every row's place in its tree, from 0, in the order of the columns.

    Ranges of (tree, order) are sorted side by side. Only the first tree of a range can go on
    from an earlier one, so one number for each range is broadcast, whatever the number of trees.
    """
    part, nth, size = fresh("part"), fresh("nth"), fresh("size")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, count = object(), 0
        for batch in batches:
            numbers = []
            for own in batch.column(tree).to_pylist():
                current, count = (own, 1) if own != current else (current, count + 1)
                numbers.append(count - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, nth])

    sorted_ = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    counted = sorted_.mapInArrow(task, f"{kinds}, `{nth}` bigint").withColumn(part, F.spark_partition_id())
    kept = staged(counted, "places")
    runs = kept.groupBy(part, tree).agg(F.count(F.lit(1)).alias(size))
    earlier = Window.partitionBy(tree).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(position, F.sum(size).over(earlier)).where(F.col(position) > 0)
    own, at = fresh("tree"), fresh("part")
    starts = runs.select(F.col(tree).alias(own), F.col(part).alias(at), position)
    joined = kept.join(
        F.broadcast(starts), F.col(tree).eqNullSafe(F.col(own)) & (F.col(part) == F.col(at)), "left"
    )
    return joined.select(*rows.columns, (F.col(nth) + F.coalesce(position, F.lit(0))).alias(position))


def digest_of(values: list[Column]) -> Column:
    """Lower-case hexadecimal SHA-256 of values, each ``-`` if null, else its bytes, ``:`` and itself."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, values)), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf's hexadecimal digest gives with the steps of a witness."""

    def raised(digest: Column, step: Column) -> Column:
        return F.sha2(F.concat(_hex(step["left"]), digest, _hex(step["right"])), 256)

    return F.aggregate(witness, leaf, raised)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def proof_digest(witness: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), ""), 256)


def witnessed(rows: DataFrame, tree: str, order: list[str], leaf: str, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Add ``subroot``, ``root`` and ``witness`` to rows with a hexadecimal digest ``leaf``.

    Rows of a ``tree`` (null is one, the first) are leaves in the order of the columns, then of
    the digest; its root is the subroot. The subroots in the order of the trees make the root.
    The witness has all steps from the leaf to the root. Rows equal in the order and the leaf
    change places without changing any digest. An empty table stays empty. The rows must have
    no columns subroot, root and witness.
    """
    taken = {"subroot", "root", "witness"} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"the rows already have {sorted(taken)}")
    place = fresh("place")
    placed = positions(rows, tree, [*order, leaf], place)
    packed = placed.select(
        F.col(tree).alias("tree"),
        F.col(place).alias("position"),
        F.unhex(leaf).alias("digest"),
        F.struct([F.col(c) for c in rows.columns]).alias("row"),
    )
    leaves, blocks = grow(packed, arity, levels)
    subroots = blocks.where("block = 0").select("tree", F.col("top").alias("digest"))
    # one tree of all subroots, in the order of their trees
    numbered = positions(subroots.withColumn("all", F.lit(0)), "all", ["tree"], "position")
    inner = numbered.select(F.col("all").alias("tree"), "position", "digest", F.col("tree").alias("name"))
    tops, above = grow(inner, arity, levels)
    outer = tops.alias("t").join(above.alias("u").hint("merge"), F.expr("t.tree = u.tree and t.block = u.block"))
    outer = outer.select(
        F.col("t.name").alias("name"), F.concat("t.witness", "u.upper").alias("over"), F.col("u.top").alias("root")
    )
    # one row for each block, joined with one for each tree; the many blocks of a hot tree are
    # few rows against its leaves
    full = blocks.join(outer.hint("merge"), F.col("tree").eqNullSafe(F.col("name"))).select(
        F.col("tree").alias("own"),
        F.col("block").alias("number"),
        F.concat("upper", "over").alias("rest"),
        F.col("top").alias("subroot"),
        "root",
    )
    joined = leaves.join(
        full.hint("merge"), F.col("tree").eqNullSafe(F.col("own")) & (F.col("block") == F.col("number"))
    )
    return joined.select(
        "row.*",
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        F.concat("witness", "rest").alias("witness"),
    )
