"""Repeated and nearly repeated lines by a segment-partition edit join, in SQL functions only.

Two lines within ``threshold`` edits of each other agree on at least one of threshold + 1
segments of the shorter one, at a place that the edits allow. So each line enters an index
with its own segments, under its length, and probes the index with the substrings that can
meet a segment of a line as long as itself or up to ``threshold`` shorter. Lines that meet are
candidates; they are compared by a bit-parallel edit distance that keeps a band of
2 * threshold + 1 diagonals in one integer.

A segment that more than about a dozen lines share is hot: its lines meet again under what they
have in several classes of characters, since edits leave some classes as they are. Such a group
of up to LARGE lines, such as variants of one sentence, is compared block by block, without a
row for each pair. Lines of a larger one meet only where they share one of their rarest
substrings. In a group that is large even then, lines are compared with a few hubs in rounds, as
in :func:`wavebook.llm.graph.settled`.
"""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import drop_listed, fresh, keep_possible, only_listed
from wavebook.llm.graph import all_pairs, components, groups_of, hub_pairs, settled
from wavebook.session import staged

THRESHOLD = 2
#: Shorter lines are not linked by edits: a few edits make them agree by chance.
LEAST_CHARACTERS = 20
#: A key is hot beyond so many pairs of an index entry and a probe, about a dozen of either.
HOT_PAIRS = 144
#: Classes of characters in which lines under hot keys have to be the same.
KEPT = 3
#: Groups of so many lines at most are compared within, in blocks of about so many.
LARGE, BLOCK = 512, 64
#: Lines of a key that is hot even then meet under their rarest substrings of so many characters.
GRAM = 3
#: Columns after which a long pair is given up if nothing in the band is within the threshold.
HEAD = 24
#: Letters whose counts tell lines apart before they are compared: an edit changes two at most.
COUNTED = "etanoisrhldubwgy ."


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, chars) of every line of (doc_id, text); null has none."""
    exploded = documents.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"),
    )
    return exploded.withColumn("chars", F.length("line"))


def _segment(chars: Column, count: int, place: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment: lengths differ by one, the last ones are longer."""
    base = F.floor(chars / F.lit(count)).cast("int")
    longer = chars - base * count
    extra = F.greatest(F.lit(0), place - count + longer)
    return place * base + extra + 1, base + F.when(longer >= count - place, 1).otherwise(0)


def variants(threshold: int, count: int) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
    """(difference of lengths, kept segments, shift of each) that similar lines can agree in.

    With threshold + 1 segments one is kept, and of the shifts those that leave no more edits
    to its left and right than there are segments. With more segments all but ``threshold`` are
    kept; shifts change only where one is left out, by as many edits in all as allowed.
    """
    found = []
    for difference in range(threshold + 1):
        if count == threshold + 1:
            for place in range(count):
                for shift in range(-threshold, threshold + 1):
                    if abs(shift) <= place and abs(difference - shift) <= threshold - place:
                        found.append((difference, (place,), (shift,)))
            continue
        for out in combinations(range(count), threshold):
            kept = tuple(n for n in range(count) if n not in out)
            steps = range(-threshold, threshold + 1)
            seen = set()
            for between in product(steps, repeat=threshold - 1):
                path = (0, *between, difference)
                if sum(abs(b - a) for a, b in zip(path, path[1:])) > threshold:
                    continue
                seen.add(tuple(path[sum(o < n for o in out)] for n in kept))
            found += [(difference, kept, shifts) for shifts in sorted(seen)]
    return found


def _variant_table(threshold: int, count: int) -> Column:
    """Array of (difference, own, kept, places, shifts) of all variants, a constant.

    ``kept`` numbers the sets of kept segments.
    """
    found = variants(threshold, count)
    numbers = {kept: n for n, kept in enumerate(sorted({kept for _, kept, _ in found}))}
    return F.array(
        *(
            F.struct(
                F.lit(difference).alias("difference"),
                F.lit(difference == 0 and not any(shifts)).alias("own"),
                F.lit(numbers[kept]).alias("kept"),
                F.array(*map(F.lit, kept)).alias("places"),
                F.array(*map(F.lit, shifts)).alias("shifts"),
            )
            for difference, kept, shifts in found
        )
    )


def _key(line: Column, chars: Column, variant: Column, threshold: int, count: int) -> Column:
    """The key of a line in a variant: length of the indexed line, segments kept, their texts."""
    length = chars - variant.difference
    parts = []
    for n in range(1 if count == threshold + 1 else count - threshold):
        start, size = _segment(length, count, variant.places[n])
        parts.append(F.substring(line, start + variant.shifts[n], size))
    return F.xxhash64(length, variant.kept, *parts)


def keys_of(line: Column, chars: Column, threshold: int, count: int) -> Column:
    """Array of (key, own): all keys of a line; ``own`` are those that enter the index.

    The keys of a line as it stands are both entry and probe.
    """

    def one(variant: Column) -> Column:
        return F.struct(_key(line, chars, variant, threshold, count).alias("key"), variant.own.alias("own"))

    return F.transform(_variant_table(threshold, count), one)


def _exploded(lines: DataFrame, threshold: int, count: int) -> DataFrame:
    """(key, own, hash) for every key of every line: the array of :func:`keys_of` as rows.

    The variants are exploded and the key is worked out in each row, so that one short
    expression is compiled whatever the number of variants.
    """
    each = lines.select("hash", "line", "chars", F.explode(_variant_table(threshold, count)).alias("variant"))
    key = _key(F.col("line"), F.col("chars"), F.col("variant"), threshold, count)
    return each.select(key.alias("key"), F.col("variant.own").alias("own"), "hash")


def _shared(keys: DataFrame) -> DataFrame:
    """Keys that an index entry and another line have, with the number of pairs to expect."""
    return (
        keys.groupBy("key")
        .agg(
            F.min("hash").alias("low"),
            F.max("hash").alias("high"),
            F.sum(F.col("own").cast("long")).alias("entries"),
            F.count(F.lit(1)).alias("probes"),
        )
        .where("entries > 0 and low <> high")
        .select("key", (F.col("entries").cast("double") * F.col("probes") > HOT_PAIRS).alias("hot"))
    )


def _members(keys: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, hash, own, hot) of the lines that have a shared key, each once."""
    near = keep_possible(keys, "key", shared, "key")
    joined = near.join(shared.hint("merge"), "key")
    return joined.groupBy("key", "hash").agg(F.max("own").alias("own"), F.first("hot").alias("hot"))


def _pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of an index entry and another line under one key, each once, a < b."""
    entries = members.where("own").select("key", F.col("hash").alias("entry"))
    probes = members.select("key", F.col("hash").alias("probe"))
    met = probes.join(entries.hint("merge"), "key").where("entry <> probe")
    return met.select(
        F.least("entry", "probe").alias("a"), F.greatest("entry", "probe").alias("b")
    ).distinct()


def common_start(one: Column, two: Column, most: Column) -> Column:
    """Length of the common beginning of two texts, ``most`` characters at most, by halving."""
    steps = F.array(*(F.lit(1 << n) for n in range(30, -1, -1)))

    def longer(known: Column, step: Column) -> Column:
        same = F.substring(one, known + 1, step) == F.substring(two, known + 1, step)
        return F.when((most - known >= step) & same, known + step).otherwise(known)

    return F.aggregate(steps, F.lit(0), longer)


def within(one: Column, two: Column, threshold: int, columns: int | None = None) -> Column:
    """Whether two arrays of characters are within so many edits; ``one`` must not be longer.

    The band moves down one row per column: bit b of column j is row j - threshold + b. The
    value on the band's lowest diagonal is carried along, and from the last row on the value in
    that row. Out of the band values are taken to be too large, which is right as far as
    distances up to the threshold go. ``one`` must have at least ``threshold`` characters.

    With ``columns`` the band stops there, and the answer is whether any value in it is still
    within the threshold; both arrays must go on for ``threshold`` characters beyond.
    """
    full = (1 << (2 * threshold + 1)) - 1
    rows = F.size(one)

    def equal_bits(column: Column) -> Column:
        bits = F.lit(0).cast("long")
        for bit in range(2 * threshold + 1):
            row = column - 1 - threshold + bit
            same = F.get(one, F.when(row >= 0, row)) == F.get(two, column - 1)
            bits = bits.bitwiseOR(F.when(same, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
        return bits

    def not_(value: Column) -> Column:
        return F.bitwise_not(value).bitwiseAND(F.lit(full))

    def bit_at(value: Column, place: Column) -> Column:
        return F.call_function("shiftright", value, place).bitwiseAND(F.lit(1)).cast("int")

    def step(state: Column, equal: Column) -> Column:
        carried = ((equal.bitwiseAND(state.vp) + state.vp).bitwiseXOR(state.vp)).bitwiseAND(F.lit(full))
        zero = carried.bitwiseOR(equal).bitwiseOR(state.vn)
        return F.transform(F.array(zero), lambda d0: _moved(state, d0))[0]

    def _moved(state: Column, d0: Column) -> Column:
        hp = state.vn.bitwiseOR(not_(d0.bitwiseOR(state.vp)))
        hn = d0.bitwiseAND(state.vp)
        down = F.shiftright(d0, 1)
        last = (rows - state.at + threshold).cast("int")
        diagonal = state.at <= rows - threshold
        change = F.when(diagonal, 1 - bit_at(d0, F.lit(2 * threshold))).otherwise(
            bit_at(hp, last) - bit_at(hn, last)
        )
        return F.struct(
            hn.bitwiseOR(not_(down.bitwiseOR(hp))).alias("vp"),
            down.bitwiseAND(hp).alias("vn"),
            (state.value + change).alias("value"),
            (state.at + 1).alias("at"),
        )

    first = full - ((1 << threshold) - 1)
    start = F.struct(
        F.lit(first).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"),
        F.lit(threshold).alias("value"),
        F.lit(1).alias("at"),
    )

    def least(state: Column) -> Column:
        # rows upward from the lowest diagonal; the vectors stand for the next column already,
        # so bit b there is the step from row b to row b + 1 of this one
        value, smallest = state.value, state.value
        for bit in range(2 * threshold - 1, -1, -1):
            value = value - bit_at(state.vp, F.lit(bit)) + bit_at(state.vn, F.lit(bit))
            smallest = F.least(smallest, value)
        return smallest

    stop = F.size(two) if columns is None else F.lit(columns)
    equals = F.transform(F.sequence(F.lit(1), stop), equal_bits)
    end = (lambda state: state.value) if columns is None else least
    return F.aggregate(equals, start, step, end) <= threshold


def cores_of(short: Column, long_: Column, threshold: int) -> Column:
    """(s, l): the characters of two texts without what they share at both ends, but for a few.

    The distance stays what it is, and each keeps more than ``threshold`` characters if the
    texts have as many; ``short`` must be no longer than ``long_``.
    """
    some = F.lit(threshold + 2)
    before = common_start(short, long_, F.length(short))
    texts_ = F.struct(short.alias("s"), long_.alias("l"), F.greatest(before - some, F.lit(0)).alias("cut"))
    texts_ = _bound(
        texts_,
        lambda t: F.struct(
            F.substring(t.s, t.cut + 1, F.length(t.s)).alias("s"), F.substring(t.l, t.cut + 1, F.length(t.l)).alias("l")
        ),
    )
    texts_ = _bound(
        texts_,
        lambda t: F.struct(
            t.s.alias("s"),
            t.l.alias("l"),
            F.greatest(
                common_start(F.reverse(t.s), F.reverse(t.l), F.length(t.s) - some) - some, F.lit(0)
            ).alias("cut"),
        ),
    )
    texts_ = _bound(
        texts_,
        lambda t: F.struct(
            F.split(F.substring(t.s, F.lit(1), F.length(t.s) - t.cut), "").alias("s"),
            F.split(F.substring(t.l, F.lit(1), F.length(t.l) - t.cut), "").alias("l"),
        ),
    )
    return texts_


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line_id, hash, line, chars, counts) of the wanted lines, each once."""
    near = keep_possible(lines, "hash", wanted, "hash")
    picked = near.groupBy("line_id", "hash", "chars").agg(F.first("line").alias("line"))
    exact = picked.join(wanted.hint("merge"), "hash", "left_semi")
    counts = F.array(
        *(F.col("chars") - F.length(F.replace("line", F.lit(c), F.lit(""))) for c in COUNTED)
    )
    return exact.select("line_id", "hash", "line", "chars", counts.alias("counts"))


def comparable(chars_a: Column, chars_b: Column, counts_a: Column, counts_b: Column, threshold: int) -> Column:
    """Whether the lengths and letter counts of two lines allow them to be within the threshold."""
    apart = F.aggregate(F.zip_with(counts_a, counts_b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, d: s + d)
    return (F.abs(chars_a - chars_b) <= threshold) & (apart <= 2 * threshold)


def confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of hashes whose lines are within the threshold, with both line ids.

    Letter counts sort out most pairs before lines are moved.
    """

    def side(name: str, *columns: str) -> DataFrame:
        renamed = [F.col("hash").alias(name)] + [F.col(c).alias(f"{c}_{name}") for c in columns]
        return texts.select(*renamed).hint("merge")

    facts = ("chars", "counts")
    near = pairs.join(side("a", *facts), "a").join(side("b", *facts), "b")
    near = near.where(
        comparable(*map(F.col, ("chars_a", "chars_b", "counts_a", "counts_b")), threshold)
    ).select("a", "b").distinct()
    near = staged(near, "candidates")
    words = ("line_id", "chars", "line")
    both = near.join(side("a", *words), "a").join(side("b", *words), "b")
    # Spark's own distance, which stops at the threshold, leaves few pairs to be taken apart
    both = both.where(F.levenshtein("line_a", "line_b", threshold) >= 0)
    swap = F.col("chars_a") > F.col("chars_b")
    short = F.when(swap, F.col("line_b")).otherwise(F.col("line_a"))
    long_ = F.when(swap, F.col("line_a")).otherwise(F.col("line_b"))
    # rows of a generator: no filter is pushed below it, so cores are worked out once
    cores = both.where("line_id_a <> line_id_b").select(
        "a", "b", "line_id_a", "line_id_b", F.inline(F.array(cores_of(short, long_, threshold)))
    )
    one, two = F.col("s"), F.col("l")
    # evaluated in turn: the whole texts only where their heads agree
    alike = F.when((F.size(one) <= 2 * HEAD) | within(one, two, threshold, HEAD), within(one, two, threshold))
    return cores.where(alike).select("a", "b", "line_id_a", "line_id_b")


def rare_groups(members: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """(key, node): the lines of hot keys (key, hash), each key parted by rare substrings.

    Hot keys that share lines are one crowd, and its substrings of GRAM characters are ordered by
    the number of its lines that have them. An edit changes GRAM of a line's different substrings
    at most, so of two lines within the threshold one of the first threshold * GRAM + 1 of either
    is the same. A line of few different substrings may have none in common with its like: all of
    a crowd of up to twice the edits' number more are one group besides.
    """
    stars = members.groupBy("key").agg(F.min("hash").alias("b"))
    linked = members.join(stars.hint("merge"), "key").select(F.col("hash").alias("a"), "b")
    crowds = staged(components(linked), "crowds").select(
        F.col("node").alias("hash"), F.col("component").alias("crowd")
    )
    # characters are cut apart once: finding a place in a long text takes longer the farther it is
    places = F.sequence(F.lit(0), F.col("chars") - GRAM)
    pieces = _bound(
        F.split("line", ""),
        lambda c: F.transform(places, lambda at: F.hash(*(F.get(c, at + n) for n in range(GRAM)))),
    )
    known = texts.join(crowds.hint("merge"), "hash").select(
        "crowd", "hash", "line_id", F.explode(F.array(F.array_distinct(pieces))).alias("all")
    )
    cut = known.select("crowd", "hash", "line_id", F.size("all").alias("pieces"), F.explode("all").alias("piece"))
    cut = staged(cut, "pieces")
    counts = cut.groupBy("crowd", "piece").agg(F.count(F.lit(1)).alias("lines"))
    ranked = cut.join(counts.hint("merge"), ["crowd", "piece"])
    least = threshold * GRAM
    # a line's own substrings: as many as it has characters
    chosen = ranked.groupBy("crowd", "hash", "line_id").agg(
        F.first("pieces").alias("pieces"),
        F.slice(F.sort_array(F.collect_list(F.struct("lines", "piece"))), 1, least + 1).alias("first"),
    )
    rarest = F.transform("first", lambda one: one.piece.cast("long"))
    few = F.when(F.col("pieces") <= 2 * least, F.array(F.lit(-1 << 40))).otherwise(F.array().cast("array<bigint>"))
    rare = chosen.select("hash", F.explode(F.concat(rarest, few)).alias("piece"))
    keys = members.join(rare.hint("merge"), "hash")
    return keys.select(F.xxhash64("key", "piece").alias("key"), F.col("hash").alias("node"))


def projections_of(line: Column, threshold: int) -> Column:
    """Array of keys of which two lines within the threshold have one in common.

    Characters are dealt to 2 * threshold + KEPT classes. An edit touches two classes at most, so
    KEPT classes are left whose characters, in their order, are the same in both lines. Every
    choice of KEPT classes makes a key of what the line has in them.
    """
    count = 2 * threshold + KEPT
    codes = F.transform(F.split(line, ""), lambda c: F.ascii(c))

    def part(own: Column, number: int) -> Column:
        # spreads Latin letters by their frequency, and digits; any other rule is right as well
        return F.xxhash64(F.filter(own, lambda c: F.pmod(F.pmod(c * 30, F.lit(131)), F.lit(count)) == number))

    parts = _bound(codes, lambda own: F.array(*(part(own, n) for n in range(count))))
    kept = list(combinations(range(count), KEPT))
    return _bound(
        parts, lambda p: F.array(*(F.xxhash64(F.lit(n), *(p[k] for k in some)) for n, some in enumerate(kept)))
    )


def group_pairs(groups: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that lengths and letter counts allow, of groups of up to LARGE members.

    Under a hot key members are dealt to blocks of about BLOCK, and two blocks are compared as
    one row; only pairs that pass become rows.
    """
    small = F.col("size") * F.col("size") <= HOT_PAIRS
    blocks = F.ceil(F.col("size") / BLOCK)
    facts = texts.select(F.col("hash").alias("node"), "chars", "counts").hint("merge")
    dealt = groups.where(~small & (F.col("size") <= LARGE)).join(facts, "node").select(
        "key",
        F.struct(F.pmod(F.xxhash64("node"), blocks).alias("block"), "node", "chars", "counts").alias("one"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    )
    low, high = F.least("one.block", "other").alias("low"), F.greatest("one.block", "other").alias("high")
    cells = dealt.groupBy("key", low, high).agg(F.collect_list("one").alias("all"))

    def met(x: Column) -> Column:
        here = F.filter(
            "all",
            lambda y: (x.node < y.node)
            & ((F.col("low") == F.col("high")) | (x.block != y.block))
            & comparable(x.chars, y.chars, x.counts, y.counts, threshold),
        )
        return F.transform(here, lambda y: F.struct(x.node.alias("a"), y.node.alias("b")))

    near = cells.select(F.inline(F.flatten(F.transform("all", met))))
    return all_pairs(groups.where(small)).unionByName(near.distinct())


def edit_links(lines: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) as line ids between different lines of (line_id, hash, line, chars).

    Every pair within the threshold is linked, or joined through other links where its lines
    stand in a large group.
    """
    plain = staged(_exploded(lines, threshold, threshold + 1), "keys")
    shared = staged(_shared(plain), "shared")
    members = staged(_members(plain, shared), "members")
    texts = staged(_texts(lines, members.select("hash").distinct()), "texts")
    ids = [F.col("line_id_a").alias("a"), F.col("line_id_b").alias("b")]
    pairs = _pairs(members.where("not hot"))
    hot = staged(members.where("hot").select("hash").distinct(), "hot")
    if hot.isEmpty():
        return staged(confirmed(pairs, texts, threshold).select(*ids), "links")
    parts = only_listed(texts, hot, {"hash": "hash"}).select(
        F.explode(projections_of(F.col("line"), threshold)).alias("key"), F.col("hash").alias("node")
    )
    groups = groups_of(staged(parts, "parts"))
    pairs = pairs.unionByName(group_pairs(groups, texts, threshold)).distinct()
    links = staged(confirmed(pairs, texts, threshold).select(*ids), "links")
    hot = groups.where(F.col("size") > LARGE).select("key", F.col("node").alias("hash"))
    if hot.isEmpty():
        return links
    groups = groups_of(rare_groups(hot, texts, threshold))
    more = staged(confirmed(group_pairs(groups, texts, threshold), texts, threshold).select(*ids), "links")
    links = links.unionByName(more)
    large = groups.where(F.col("size") > LARGE)
    found, _ = settled(large, lambda some: confirmed(hub_pairs(some), texts, threshold))
    return links if found is None else links.unionByName(found.select(*ids))


def line_groups(
    documents: DataFrame, threshold: int = THRESHOLD, least_equal: int = LEAST_CHARACTERS
) -> tuple[DataFrame, DataFrame]:
    """All lines, and of those with repeats: line_id, class_doc_id, class_line_no, class_lines.

    A class joins lines of ``least_equal`` characters or more that are equal, and lines of
    LEAST_CHARACTERS or more linked by edits. It is named by its first line, by doc_id and place
    in the document.
    """
    lines = lines_of(documents).withColumn("line_id", F.unhex(F.md5("line"))).withColumn(
        "hash", F.xxhash64("line")
    )
    long_ = lines.where(F.col("chars") >= LEAST_CHARACTERS)
    distinct = staged(
        lines.where(F.col("chars") >= min(least_equal, LEAST_CHARACTERS)).groupBy("line_id").agg(
            F.min(F.struct("doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("lines")
        ),
        "lines",
    )
    reached = components(edit_links(long_, threshold)).select(
        F.col("node").alias("line_id"), "component"
    )
    named = distinct.join(reached.hint("merge"), "line_id", "left").select(
        "line_id", "first", "lines", F.coalesce("component", "line_id").alias("component")
    )
    named = staged(named, "named")
    classes = staged(
        named.groupBy("component")
        .agg(F.min("first").alias("first"), F.sum("lines").alias("class_lines"))
        .where("class_lines > 1"),
        "classes",
    )
    owners = named.select("line_id", "component").join(classes.hint("merge"), "component")
    owners = owners.select(
        "line_id",
        F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.line_no").alias("class_line_no"),
        "class_lines",
    )
    return lines, staged(owners, "owners")


def line_classes(
    documents: DataFrame, threshold: int = THRESHOLD, least_equal: int = LEAST_CHARACTERS
) -> DataFrame:
    """doc_id, line_no, chars, class_doc_id, class_line_no, class_lines, kept of every line.

    Lines of at least LEAST_CHARACTERS characters that are equal, or linked by up to ``threshold``
    edits, are one class, named by its first line in the order of doc_id (null first) and
    line_no; that line is kept, the others are not. Shorter lines are one class where they are
    equal and have ``least_equal`` characters: 1 joins the repeats of every line but the empty
    one. Other lines are classes of their own and kept. Null texts have no lines. Rows equal in
    doc_id and text are one document for this purpose: lines of each are treated alike. An empty
    table has no lines. Further columns are not read.
    """
    lines, owners = line_groups(documents, threshold, least_equal)
    told = lines.select("doc_id", "line_no", "chars", "line_id").join(
        owners.hint("merge"), "line_id", "left"
    )
    alone = F.col("class_lines").isNull()
    own_doc = F.when(alone, F.col("doc_id")).otherwise(F.col("class_doc_id"))
    own_line = F.when(alone, F.col("line_no")).otherwise(F.col("class_line_no"))
    return told.select(
        "doc_id",
        "line_no",
        "chars",
        own_doc.alias("class_doc_id"),
        own_line.alias("class_line_no"),
        F.coalesce("class_lines", F.lit(1)).alias("class_lines"),
        (F.col("doc_id").eqNullSafe(own_doc) & (F.col("line_no") == own_line)).alias("kept"),
    )


def drop_repeated_lines(
    documents: DataFrame, threshold: int = THRESHOLD, least_equal: int = LEAST_CHARACTERS
) -> DataFrame:
    """Documents without the lines that :func:`line_classes` does not keep; all columns stay.

    A document all of whose lines go is left out, as is one that keeps only lines without
    letters or digits; others keep the rest of their lines in order. Documents without a
    repeated line are handed on as they are. A column named ``n_chars`` is set to the new
    length.
    """
    lines, owners = line_groups(documents.select("doc_id", "text"), threshold, least_equal)
    doc, key, gone = fresh("doc"), fresh("key"), fresh("gone")
    told = lines.select("doc_id", "text_key", "line_no", "line_id").join(owners.hint("merge"), "line_id")
    kept = F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("line_no") == F.col("class_line_no"))
    dropped = staged(
        told.where(~kept)
        .groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
        .agg(F.collect_set("line_no").alias(gone)),
        "dropped",
    )
    mark = fresh("mark")
    rows = documents.withColumn(mark, F.xxhash64("text"))
    keys = {"doc_id": doc, mark: key}
    untouched = drop_listed(rows, dropped.select(doc, key), keys).drop(mark)
    touched = only_listed(rows, dropped.select(doc, key), keys)
    joined = touched.join(
        dropped.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col(doc)) & F.col(mark).eqNullSafe(F.col(key)),
    )
    rest = F.filter(
        F.split("text", "\n", -1), lambda line, place: ~F.array_contains(F.col(gone), place)
    )
    cut = joined.withColumn("text", F.array_join(rest, "\n")).where(F.col("text").rlike("[\\p{L}\\p{N}]"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.length("text").cast(kind))
    return untouched.unionByName(cut.select(*(F.col(f"`{c}`") for c in documents.columns)))
