"""Line classes against the distances of all pairs."""

from __future__ import annotations

import random

import pytest
from awkward import awkward_rows, prose
from pyspark.sql import functions as F

from wavebook.llm import line_dedup
from wavebook.llm.line_dedup import cores_of, drop_repeated_lines, keys_of, line_classes, variants, within
from wavebook.llm.queries import op2_line_dedup

LEAST = line_dedup.LEAST_CHARACTERS


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows, threshold):
    lines = [(k, n, x) for k, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    parent = {x: x for *_, x in lines if len(x) >= LEAST}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts = sorted(parent)
    for n, a in enumerate(texts):
        for b in texts[:n]:
            if abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold:
                parent[root(a)] = root(b)
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    out = []
    for key, n, x in lines:
        same = [(k, m) for k, m, y in lines if len(y) >= LEAST and len(x) >= LEAST and root(y) == root(x)]
        first = min(same, key=order) if same else (key, n)
        out.append((key, n, len(x), *first, max(1, len(same)), (key, n) == first))
    return sorted(out, key=str)


def edited(chance, text, times):
    own = list(text)
    for _ in range(times):
        at, kind = chance.randrange(len(own)), chance.randrange(3)
        if kind == 0:
            own[at] = chance.choice("abcé")
        elif kind == 1:
            own.insert(at, chance.choice("abcé"))
        else:
            own.pop(at)
    return "".join(own)


def many_lines(seed):
    chance = random.Random(seed)
    texts = []
    for g in range(12):
        base = prose(seed * 100 + g, chance.choice([3, 6, 15]))[:200].ljust(LEAST, "q")
        texts += [edited(chance, base, chance.choice([0, 1, 1, 2, 3, 4])) for _ in range(8)]
    texts += ["short", "short", "", "x" * (LEAST - 1), "x" * (LEAST - 1), "x" * LEAST, "x" * (LEAST + 2)]
    chance.shuffle(texts)
    return [(n, "\n".join(texts[n::20])) for n in range(20)] + awkward_rows()


@pytest.mark.parametrize("hot", [line_dedup.HOT_PAIRS, 20, 2])
@pytest.mark.parametrize("threshold", [1, 2])
def test_as_all_pairs(spark, monkeypatch, hot, threshold):
    monkeypatch.setattr(line_dedup, "HOT_PAIRS", hot)
    rows = many_lines(threshold)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, line string, hash string")
    got = line_classes(frame.repartition(3), threshold).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, threshold)


def variants_of_a_sentence(seed, count):
    """Lines that differ in one or two words, some of which differ by an edit or two."""
    chance = random.Random(seed)
    words = prose(seed, 14).split()
    texts = ["ab" * 12, "ab" * 12 + "c", "x" * 30, "x" * 31, "x" * 29 + "y"]
    for n in range(count):
        own = list(words)
        for at in chance.sample(range(len(own)), chance.choice([0, 1, 1, 2])):
            own[at] = "".join(chance.choice("aeioustn") for _ in range(chance.randint(1, 9)))
        texts.append(edited(chance, " ".join(own), n % 3))
    return texts


@pytest.mark.parametrize("hot", [line_dedup.HOT_PAIRS, 20])
def test_variants_of_a_sentence(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_PAIRS", hot)
    rows = list(enumerate(variants_of_a_sentence(8, 90)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_classes(frame.repartition(3), 2).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 2)


def test_rare_groups_hold_every_close_pair_and_part_most_others(spark):
    texts = sorted(set(variants_of_a_sentence(9, 150)))
    rows = [(1, n, bytes([n]), x, len(x)) for n, x in enumerate(texts)]
    lines = spark.createDataFrame(rows, "key long, hash long, line_id binary, line string, chars int")
    met = line_dedup.rare_groups(lines.select("key", "hash"), lines, 2).collect()
    groups = {}
    for row in met:
        groups.setdefault(row.key, set()).add(row.node)
    together = {(a, b) for nodes in groups.values() for a in nodes for b in nodes if a < b}
    close = {
        (a, b) for b in range(len(texts)) for a in range(b)
        if abs(len(texts[a]) - len(texts[b])) <= 2 and distance(texts[a], texts[b]) <= 2
    }
    assert len(close) > 5 and close <= together
    assert len(together) < len(texts) * (len(texts) - 1) / 4


def test_variants_of_a_sentence_are_settled_without_rounds(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PAIRS", 20)
    monkeypatch.setattr(line_dedup, "rare_groups", lambda *_: pytest.fail("a group of 90 lines goes on to rounds"))
    made, staged = [], line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda rows, purpose: made.append(purpose) or staged(rows, purpose))
    rows = list(enumerate(variants_of_a_sentence(8, 90)))
    got = line_classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 2)
    assert made.count("keys") == 1 and made.count("candidates") == 1


def test_larger_groups_go_on_to_rounds(spark, monkeypatch):
    called, rare = [], line_dedup.rare_groups
    monkeypatch.setattr(line_dedup, "rare_groups", lambda *given: called.append(1) or rare(*given))
    monkeypatch.setattr(line_dedup, "HOT_PAIRS", 4)
    monkeypatch.setattr(line_dedup, "LARGE", 3)
    rows = list(enumerate(variants_of_a_sentence(8, 90)))
    got = line_classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert called and sorted((tuple(r) for r in got), key=str) == plain(rows, 2)


@pytest.mark.parametrize("threshold", [1, 2])
def test_close_lines_share_a_projection_and_few_others_do(spark, threshold):
    chance = random.Random(threshold)
    texts = ["x" * 30, "\U0001f600é" * 12, "12:30 05.11.2024 00", prose(3, 40)]
    rows = []
    for n in range(400):
        text = texts[n] if n < 4 else prose(n, 9)
        rows.append((edited(chance, text, n % (threshold + 1)), text, prose(n + 1000, 9)))
    met = lambda a, b: F.arrays_overlap(
        line_dedup.projections_of(F.col(a), threshold), line_dedup.projections_of(F.col(b), threshold)
    )
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    told = frame.select(met("a", "b").alias("close"), met("a", "c").alias("far")).collect()
    assert all(r.close for r in told) and sum(r.far for r in told) < 10


@pytest.mark.parametrize("block", [4, 64])
def test_block_pairs_hold_every_close_pair(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    texts = sorted(set(variants_of_a_sentence(9, 150)))
    counts = F.array(*(F.col("chars") - F.length(F.replace("line", F.lit(c), F.lit(""))) for c in line_dedup.COUNTED))
    rows = [(n, x, len(x)) for n, x in enumerate(texts)]
    lines = spark.createDataFrame(rows, "hash long, line string, chars int").withColumn("counts", counts)
    groups = lines.select(F.lit(1).alias("key"), F.col("hash").alias("node"), F.lit(len(texts)).alias("size"))
    got = [(r.a, r.b) for r in line_dedup.group_pairs(groups, lines, 2).collect()]
    close = {
        (a, b) for b in range(len(texts)) for a in range(b)
        if abs(len(texts[a]) - len(texts[b])) <= 2 and distance(texts[a], texts[b]) <= 2
    }
    assert len(got) == len(set(got)) and len(close) > 5 and close <= set(got)
    assert len(got) < len(texts) * (len(texts) - 1) / 8


def test_cores_are_worked_out_once(spark):
    lines = spark.createDataFrame(
        [(n, bytes([n]), f"{n} {prose(n, 6)}") for n in range(3)], "hash long, line_id binary, line string"
    ).withColumn("chars", F.length("line")).withColumn("counts", F.array(F.lit(0)))
    pairs = spark.createDataFrame([(0, 1), (1, 2)], "a long, b long")
    plan = line_dedup.confirmed(pairs, lines, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("reverse(") <= 2


def test_query(spark, documents, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_line_dedup(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(awkward_rows(), line_dedup.THRESHOLD)


def test_equal_short_lines_are_one_class(spark, tmp_path):
    menu, near = "Home\nRead more\n\n é", "x" * (LEAST - 1)
    rows = [(3, menu), (1, f"Read more\n{near}\nRead mor"), (2, f"{menu}\n{near}y"), (None, near), (4, f"{near}z\n")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_line_dedup(spark, str(tmp_path)).collect()
    told = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.class_lines, r.kept) for r in got}
    assert told == {
        (None, 0): (None, 0, 2, True),
        (1, 0): (1, 0, 3, True),
        (1, 1): (None, 0, 2, False),
        (1, 2): (1, 2, 1, True),
        (2, 0): (2, 0, 2, True),
        (2, 1): (1, 0, 3, False),
        (2, 2): (2, 2, 1, True),
        (2, 3): (2, 3, 2, True),
        (2, 4): (2, 4, 2, True),
        (3, 0): (2, 0, 2, False),
        (3, 1): (1, 0, 3, False),
        (3, 2): (3, 2, 1, True),
        (3, 3): (2, 3, 2, False),
        (4, 0): (2, 4, 2, False),
        (4, 1): (4, 1, 1, True),
    }


def test_documents_without_repeats(spark, no_documents):
    long_ = [prose(n, 8) for n in range(4)]
    rows = [
        (1, f"{long_[0]}\n{long_[1]}\nshort", 5),
        (2, f"{long_[0]}x\n{long_[2]}\nshort", 5),
        (3, long_[0], 5),
        (4, f"{long_[1]}\n\n  ", 5),
        (5, f"{long_[3]}\n{long_[3]}", 5),
        (6, None, 0),
        (7, "", 0),
        (None, long_[2], 5),
        (8, "\n", 1),
    ]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, n_chars int, key string")
    left = drop_repeated_lines(frame)
    assert left.columns == frame.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
    assert got == {
        1: (f"{long_[0]}\n{long_[1]}\nshort", 5),
        2: ("short", 5),
        5: (long_[3], len(long_[3])),
        6: (None, 0),
        7: ("", 0),
        8: ("\n", 1),
        None: (long_[2], 5),
    }
    assert drop_repeated_lines(no_documents).count() == 0 and line_classes(no_documents).count() == 0


def test_bit_parallel_distance_and_keys(spark):
    chance = random.Random(6)
    rows = []
    for _ in range(1500):
        a = "".join(chance.choice("abé ") for _ in range(chance.randint(9, 30)))
        b = edited(chance, a, chance.randint(0, 4))
        rows.append(tuple(sorted((a, b), key=len)))
    frame = spark.createDataFrame(rows, "a string, b string").where("length(a) >= 9")
    for threshold in (1, 2, 3):
        some = frame.where(F.length("b") - F.length("a") <= threshold)
        close = F.levenshtein("a", "b") <= threshold
        whole = within(F.split("a", ""), F.split("b", ""), threshold)
        assert some.where(close != whole).count() == 0
        core = cores_of(F.col("a"), F.col("b"), threshold)
        cut = some.select(close.alias("close"), core.alias("core"))
        assert cut.where(F.col("close") != within(F.col("core.s"), F.col("core.l"), threshold)).count() == 0
        # a band that stops early never gives up a close pair, and gives up most others
        head = within(F.split("a", ""), F.split("b", ""), threshold, 5)
        assert some.where(close & ~head).count() == 0
        for count in {threshold + 1, 3 * min(threshold, 2)} - ({6} if threshold == 3 else set()):
            own = F.filter(keys_of(F.col("a"), F.length("a"), threshold, count), lambda k: k.own)
            met = F.arrays_overlap(
                F.transform(own, lambda k: k.key),
                F.transform(keys_of(F.col("b"), F.length("b"), threshold, count), lambda k: k.key),
            )
            assert some.where(close & ~met).count() == 0
    different = frame.select(
        F.split(F.concat(F.lit("zzzzzzzzzz"), "a"), "").alias("a"), F.split(F.concat(F.lit("yyyyyyyyyy"), "b"), "").alias("b")
    )
    assert different.where(within(F.col("a"), F.col("b"), 2, 8)).count() == 0
    assert [len(variants(k, k + 1)) for k in (1, 2)] == [4, 12]
