"""Packing against the tokenizer and the limits."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from wavebook.llm.packing import Example, Limits, WordTokenizer, pack, pack_examples, pack_texts
from wavebook.llm.queries import op1_vector_packing, tokenizer_path

from awkward import awkward_rows


def ids_of(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_by_word_equals_the_tokenizer():
    texts = [t for _, t in awkward_rows()]
    texts += ["a<|endoftext|>b", "don't, we'll... stop.,", "A.B,c", "x\xa0y z ́e é", "12 3.4", "ÀÉ. Ünï,"]
    encoder = WordTokenizer(tokenizer_path())
    assert [list(i) for i in encoder.encode(texts)] == ids_of(texts)
    assert [list(i) for i in encoder.encode(texts[::-1])] == ids_of(texts[::-1])


def whole(pieces, expected):
    """Check coverage, offsets and limits of pieces; gives the tokens of each sequence."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[(p["key"], p["total_tokens"])].append(p)
        by_sequence[p["sequence_id"]].append(p)
    found = sorted(
        ([key, total], sorted((p["start"], bytes(p["ids"])) for p in some))
        for (key, total), some in by_document.items()
    )
    for some in by_sequence.values():
        at = 0
        for p in sorted(some, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] * 4 == len(p["ids"]) and p["length"] > 0
            at += p["length"]
    assert len(found) == len(expected)
    return {k: sum(p["length"] for p in v) for k, v in by_sequence.items()}


def test_every_id_once(spark, documents):
    rows = [r.asDict() for r in pack_texts(documents, "doc_id", "text", tokenizer_path()).collect()]
    ids = ids_of([t for _, t in awkward_rows()])
    expected = defaultdict(int)
    for (key, _), own in zip(awkward_rows(), ids):
        expected[key] += len(own) + 1
    got = defaultdict(int)
    for row in rows:
        got[row["doc_id"]] += row["length"]
    assert got == expected
    for key, own in ((110, None), (109, None), (104, None)):
        text = dict((k, t) for k, t in awkward_rows())[key]
        own = [*ids_of([text])[0], 2]
        pieces = sorted((r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == key)
        assert np.frombuffer(b"".join(b for _, b in pieces), "<u4").tolist() == own
        assert {r["total_tokens"] for r in rows if r["doc_id"] == key} == {len(own)}
    sequences = whole([{**r, "key": str(r["doc_id"])} for r in rows], {(str(r["doc_id"]), r["total_tokens"]) for r in rows})
    assert max(sequences.values()) <= 4096


def test_all_but_the_last_sequence_are_full():
    chance = np.random.default_rng(1)
    examples = [
        Example(n, np.arange(size, dtype="<u4"), np.ones(size, bool))
        for n, size in enumerate(chance.integers(1, 700, 3000).tolist())
    ]
    total = sum(len(e.ids) for e in examples)
    sequences = defaultdict(int)
    for piece in pack(examples, Limits()):
        sequences[piece.sequence] += len(piece.ids)
    assert sum(sequences.values()) == total
    assert len(sequences) == -(-total // 4096)


@pytest.mark.parametrize("cut", [True, False])
def test_all_three_limits_hold(spark, cut):
    chance = np.random.default_rng(2)
    rows = []
    for n in range(300):
        size = int(chance.integers(0, 60))
        rows.append((n, list(range(size)), (chance.random(size) < 0.4).tolist() if n % 7 else None))
    rows += [(1000, list(range(500)), None), (1001, None, None), (1002, [], None), (None, [5, 6], [True, False])]
    frame = spark.createDataFrame(rows, "key long, ids array<int>, loss array<boolean>")
    limits = Limits(tokens=128, segments=4, loss_tokens=50)
    pieces = [r.asDict() for r in pack_examples(frame, limits, cut).collect()]
    tokens, segments, loss = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in pieces:
        tokens[p["sequence_id"]] += p["length"]
        segments[p["sequence_id"]] += 1
        loss[p["sequence_id"]] += p["loss_tokens"]
    assert max(tokens.values()) <= 128 and max(segments.values()) <= 4 and max(loss.values()) <= 50
    got = defaultdict(list)
    for p in pieces:
        got[p["key"]].append((p["start"], np.frombuffer(bytes(p["ids"]), "<u4").tolist()))
    for key, ids, own_loss in rows:
        assert sum((i for _, i in sorted(got.get(key, []))), []) == (ids or [])
        if not cut and ids and len(ids) < 50:
            assert len(got[key]) == 1


def test_empty_and_query(spark, no_documents, tmp_path, documents):
    assert pack_texts(no_documents, "doc_id", "text", tokenizer_path()).count() == 0
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op1_vector_packing(spark, str(tmp_path)).collect()
    one = next(r for r in rows if r.doc_id == 105)
    assert (one.doc_tokens, one.length, one.ids_crc32) == (1, 1, zlib.crc32(np.array([2], "<u4").tobytes()))


@pytest.mark.parametrize("longest", [5, 12, 30])
def test_tiny_texts_fill_sequences(longest):
    limits, sizes = Limits(), [1 + n * 7 % longest for n in range(5000)]
    held = defaultdict(list)
    for piece in pack((Example(n, np.arange(s), np.ones(s, bool)) for n, s in enumerate(sizes)), limits):
        held[piece.sequence].append(len(piece.ids))
    assert sum(map(sum, held.values())) == sum(sizes)
    assert all(sum(p) <= limits.tokens and len(p) <= limits.segments for p in held.values())
    last = held.pop(max(held))
    assert held and last and all(sum(p) == limits.tokens or len(p) == limits.segments for p in held.values())
