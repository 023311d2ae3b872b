"""Alignment of tokenizers against a brute-force version, laws of the fragments, awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from awkward import awkward_rows, prose
from tokenizers import Tokenizer

from wavebook.llm import alignment
from wavebook.llm.queries import ALIGNED, op11_fragment_alignment

PATHS = [public_tokenizers.path(name) for name in ALIGNED]
ODD = [
    "▁a b", "a▁b", " lead", "trail ", "two  blanks", "nbsp  x", "tab\t x\n y", "<|endoftext|> </s> <0x41>",
    "漢字 かな " * 40, "zero​ width", "end　", "a" * 500, "x ́y", "'s 're", "😀 👍🏽 ", "\u0000 a",
]


@pytest.fixture(scope="module")
def brute():
    byte_level, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_level.encode_special_tokens = True
    ranks = alignment._byte_level_ranks(PATHS[0])
    a_bytes = {n: token for token, n in ranks.items()}

    def tokens(text):
        if not text:
            return [], []
        a = [(n, a_bytes[n]) for n in byte_level.encode(" " + text, add_special_tokens=False).ids]
        b = [(n, alignment._piece_bytes(pieces, n)) for n in pieces.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == b"".join(t for _, t in b) == whole else ([], [])

    def facts(text):
        a, b = tokens(text)
        spans = []
        for some in (a, b):
            at, own = 0, []
            for number, token in some:
                own.append((number, at, at + len(token)))
                at += len(token)
            spans.append(own)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(n) for n, _, e in own if start < e <= end) for own in spans))
            start = end
        links = [(m, n) for m, i, j in spans[0] for n, k, o in spans[1] if i < o and k < j]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        return len(a), len(b), len(groups), links, digest

    def answer(rows):
        told = [(key, *facts(text)) for key, text in rows]
        counts = Counter(pair for row in told for pair in set(row[4]))
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        return sorted(
            (
                (key, n_a, n_b, groups, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), digest)
                for key, n_a, n_b, groups, links, digest in told
            ),
            key=repr,
        )

    return answer


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    long = [(2000 + n, prose(300 + n, 400) + ODD[n] + "x" * n) for n in range(6)]
    short = [(k, t if t is None else t[:3000]) for k, t in awkward_rows()]
    return short + long + [(1000 + n, text) for n, text in enumerate(ODD)]


@pytest.mark.parametrize("size, most", [(alignment.RANGE, alignment.KEPT_PAIRS), (37, 50), (200, 0)])
def test_equals_brute_force(spark, brute, rows, size, most):
    """Also when texts are worked on by ranges and nearly all pairs are joined."""
    frame = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n_a string").repartition(3)
    assert rows_of(alignment.align_texts(frame, "doc_id", "text", *PATHS, size, most)) == brute(rows)


def test_query(spark, brute, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_fragment_alignment(spark, str(tmp_path))
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert rows_of(got) == brute(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_texts(frame, "doc_id", "text", *PATHS).count() == 0


def test_fragments_are_a_monoid():
    aligner = alignment.aligner_for(*PATHS)
    text = prose(4, 60) + " übergrößenträger 漢字 internationalisation"
    tokens, sound = aligner.tokens(text)
    assert sound
    end = int(tokens.a_ends[-1])
    whole = alignment.closed(alignment.fragment_of(tokens, aligner.pieces)[0], aligner.pieces)
    chance = random.Random(3)

    def same(one, two):
        fields = (one.n_a, one.n_b, one.n_groups, one.cut), (two.n_a, two.n_b, two.n_groups, two.cut)
        arrays = zip(
            (*one.prefix.parts(), *one.suffix.parts(), one.pairs, one.times),
            (*two.prefix.parts(), *two.suffix.parts(), two.pairs, two.times),
        )
        return fields[0] == fields[1] and all(np.array_equal(a, b) for a, b in arrays)

    def joined(one, two):
        return alignment.compose(one, two, aligner.pieces)

    for _ in range(50):
        borders = [0, *sorted(chance.sample(range(1, end), chance.randrange(1, 12))), end]
        made = [
            alignment.fragment_of(tokens.between(low, high), aligner.pieces)[0]
            for low, high in zip(borders, borders[1:])
        ]
        left = reduce(joined, made)
        right = reduce(lambda one, two: joined(two, one), reversed(made))
        assert same(left, right) and same(joined(alignment.Fragment(), left), left)
        assert same(joined(left, alignment.Fragment()), left)
        assert same(alignment.closed(left, aligner.pieces), whole)


def test_ranges_cover_a_text_once():
    aligner = alignment.aligner_for(*PATHS)
    for text in [prose(8, 300), "é漢 " * 300, "a" * 2000 + " b" * 500, "no cut" + "x" * 900]:
        whole, _ = aligner.tokens(text)
        got = reduce(
            lambda one, two: one + two,
            (
                aligner.tokens(own)[0].between(low, high).moved(base)
                for own, low, high, base in alignment.ranges_of(text, 64, 64)
            ),
        )
        assert all(np.array_equal(a, b) for a, b in zip(got.parts(), whole.parts()))
