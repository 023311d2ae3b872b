"""Connected components of a link table, and the links that settle groups of candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavebook.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); a component is its smallest node.

    Every node takes its smallest neighbour as its parent where that is smaller, which gives
    a forest; parents are followed until they are roots, links are redrawn between roots, and
    so on until none is left. Each step is written to the shared folder: lineage stays short,
    and both sides of every join are plain tables, so that a node with very many links is
    split by the skew-join rule. Only the emptiness of a table comes to the driver. Loops and
    repeated links do no harm, null ends are left out, no links give no rows.
    """
    sound = links.where("a is not null and b is not null and a <> b")
    left = staged(_both_ways(sound), "links")
    label = None
    while not left.isEmpty():
        parents = _roots(staged(_smallest_neighbours(left), "parents"))
        label = parents if label is None else _relabelled(label, parents)
        left = staged(_between_roots(left, parents), "links")
    if label is None:
        return sound.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return label


def _both_ways(links: DataFrame) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").union(back).distinct()


def _smallest_neighbours(links: DataFrame) -> DataFrame:
    return (
        links.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("component"))
    )


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parents to the root: twice as far in each round."""
    while True:
        above = parents.select(F.col("node").alias("component"), F.col("component").alias("up"))
        moved = staged(
            parents.join(above, "component").select(
                "node", F.col("up").alias("component"), (F.col("up") != F.col("component")).alias("moved")
            ),
            "parents",
        )
        parents = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return parents


def _between_roots(links: DataFrame, parents: DataFrame) -> DataFrame:
    first = parents.select(F.col("node").alias("a"), F.col("component").alias("root_a"))
    second = parents.select(F.col("node").alias("b"), F.col("component").alias("root_b"))
    return (
        links.join(first, "a")
        .join(second, "b")
        .where("root_a <> root_b")
        .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        .distinct()
    )


def _relabelled(label: DataFrame, parents: DataFrame) -> DataFrame:
    higher = parents.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return staged(
        label.join(higher, "component", "left").select(
            "node", F.coalesce("root", "component").alias("component")
        ),
        "labels",
    )


def groups_of(rows: DataFrame) -> DataFrame:
    """(key, node, size, hub) of the rows (key, node) whose key has several nodes, each once.

    ``size`` is the number of nodes; the smallest one is the key's first hub.
    """
    once = rows.select("key", "node").distinct()
    counts = once.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
    shared = staged(counts.where("size > 1"), "groups")
    joined = once.join(shared.hint("merge"), "key")
    return staged(
        joined.select("key", "node", "size", (F.col("node") == F.col("least")).alias("hub")), "members"
    )


def all_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the members of groups, each once; for groups of a bounded size."""
    one = members.select("key", F.col("node").alias("a"))
    two = members.select("key", F.col("node").alias("b"))
    return one.join(two.hint("merge"), "key").where("a < b").select("a", "b").distinct()


def hub_pairs(members: DataFrame) -> DataFrame:
    """Pairs of a group's hubs, as ``a``, with its other members, each pair once."""
    hubs = members.where("hub").select("key", F.col("node").alias("a"))
    others = members.select("key", F.col("node").alias("b"), F.col("hub").alias("also_hub"))
    met = others.join(hubs.hint("merge"), "key").where("a <> b and (not also_hub or a < b)")
    return met.select("a", "b").distinct()


def settled(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    known: DataFrame | None = None,
    hubs: int = 32,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Confirmed links within groups (key, node, size, hub), and the components they make.

    ``confirm`` takes members and gives the links (a, b) of hubs with members of their group;
    ``known`` are links found before. Not all members of a group are compared with each
    other: hubs are compared with all others, links make components, and members outside a
    group's largest component become its next hubs, at most ``hubs`` of them in a round. In
    the end any two members of a group have been compared or are in one component.
    """
    found, reached = known, None
    while not members.isEmpty():
        more = confirm(members)
        found = staged(more if found is None else found.unionByName(more), "confirmed")
        reached = components(found.select("a", "b"))
        members = _unsettled(members, reached, hubs)
    if reached is None and found is not None:
        reached = components(found.select("a", "b"))
    return found, reached


def _unsettled(members: DataFrame, reached: DataFrame, hubs: int) -> DataFrame:
    """What is left of the groups, with the next hubs marked.

    Hubs have been compared with all others and leave. Groups whose other members are all in
    one component are settled. In the rest, members outside the component that has most of
    them become hubs.
    """
    label = reached.select("node", "component").hint("merge")
    rest = staged(
        members.where("not hub")
        .join(label, "node", "left")
        .select("key", "node", "size", F.coalesce("component", "node").alias("component")),
        "rest",
    )
    sizes = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = (
        sizes.groupBy("key")
        .agg(
            F.max_by("component", F.struct("size", "component")).alias("largest"),
            F.count(F.lit(1)).alias("components"),
        )
        .where("components > 1")
    )
    largest = staged(largest, "largest")
    if largest.isEmpty():
        return members.limit(0)
    split = staged(
        rest.join(largest.hint("merge"), "key").select(
            "key", "node", "size", (F.col("component") != F.col("largest")).alias("outside")
        ),
        "split",
    )
    # kept to so many rows per group before the shuffle
    order = Window.partitionBy("key").orderBy("node")
    chosen = (
        split.where("outside")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= hubs)
        .select("key", "node", F.lit(True).alias("hub"))
    )
    chosen = staged(chosen, "hubs").hint("merge")
    marked = split.select("key", "node", "size").join(chosen, ["key", "node"], "left")
    return staged(marked.select("key", "node", "size", F.coalesce("hub", F.lit(False)).alias("hub")), "members")
