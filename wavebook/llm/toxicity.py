"""Toxicity by a factorization machine over hashed terms.

A text's terms are hashed to FEATURES places. The machine adds the weights of the terms that
occur and, for every pair of them, the product of their factor vectors, so that a pair such as
an insult and the mention of a group counts more than its two words do by themselves. Terms
are the distinct words of the whole text and their beginnings; those that tell nothing about
the label are left out before training, so the many rare words are not learned by heart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import BATCH_ROWS, first_by_hash, word_hashes

FEATURE_BITS, FACTORS = 18, 8
#: Beginnings of words, in bytes, that are terms too, so that inflected words share one.
PREFIXES = (4, 6)
#: A term takes part if it occurs in so many training texts at least, and its link with the
#: label reaches this log-likelihood ratio; the other terms are noise to the machine.
LEAST_TEXTS, LEAST_RATIO = 3, 10.8
#: Labelled rows of either label that are used for training at most.
SAMPLE_ROWS = 5000
EPOCHS, RATE, DECAY = 8, 0.05, 2e-5

#: Letters of all scripts that UTF-8 writes with more than one byte are kept as they are.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_places(text: str | None) -> np.ndarray:
    """Distinct hashed terms of a text: its words and the words' beginnings."""
    found = set(text.encode("utf-8", "surrogatepass").translate(_TERMS).split()) if text else set()
    terms = list(found)
    for size in PREFIXES:
        terms += {b"^%d " % size + w[:size] for w in found if len(w) > size}
    return np.unique((word_hashes(terms) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))


@dataclass
class Machine:
    """``bias`` + sum of weights + half of (square of the factors' sum - sum of squares)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, places: np.ndarray) -> float:
        own = self.factors[places]
        total = own.sum(axis=0)
        pairs = 0.5 * float((total * total).sum() - (own * own).sum())
        return self.bias + float(self.weights[places].sum()) + pairs

    def score(self, places: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.raw(places), -30, 30))))


def telling_terms(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Terms whose presence tells the label, by the log-likelihood ratio of the two by two table."""

    def texts_with(label: int) -> np.ndarray:
        some = [places for places, own in zip(rows, labels.tolist()) if own == label]
        return np.bincount(np.concatenate([*some, np.zeros(0, np.int64)]), minlength=size).astype(float)

    one, zero = texts_with(1), texts_with(0)
    ones, zeros = float(labels.sum()), float(len(labels) - labels.sum())
    with_term, total = one + zero, max(1.0, ones + zeros)
    ratio = np.zeros(size)
    for seen, label_rows, rows_with in (
        (one, ones, with_term),
        (zero, zeros, with_term),
        (ones - one, ones, total - with_term),
        (zeros - zero, zeros, total - with_term),
    ):
        expected = np.maximum(label_rows * rows_with / total, 1e-12)
        ratio += 2 * seen * np.log(np.maximum(seen, 1e-12) / expected)
    return (with_term >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Machine:
    """AdaGrad on the logistic loss, one text at a time in an order given by the seed.

    With texts of one label only, or none, every text gets that label, or is not toxic.
    """
    chance = np.random.default_rng(seed)
    size = 1 << FEATURE_BITS
    telling = telling_terms(rows, labels, size)
    rows = [places[telling[places]] for places in rows]
    machine = Machine(0.0, np.zeros(size), chance.normal(0, 0.01, (size, FACTORS)))
    machine.factors[~telling] = 0
    ones = int(labels.sum())
    if ones in (0, len(labels)):
        machine.bias = 4.0 if ones else -4.0
        return machine
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    weight = {1: len(labels) / (2 * ones), 0: len(labels) / (2 * (len(labels) - ones))}
    for _ in range(EPOCHS):
        for n in chance.permutation(len(rows)).tolist():
            places = rows[n]
            own = machine.factors[places]
            total = own.sum(axis=0)
            error = (machine.score(places) - labels[n]) * weight[int(labels[n])]
            seen_b += error * error
            machine.bias -= RATE * error / np.sqrt(seen_b)
            if not len(places):
                continue
            # a text's pairs grow with the square of its terms, so their step shrinks with them
            change_w = error + DECAY * machine.weights[places]
            change_v = error * (total - own) / np.sqrt(len(places)) + DECAY * own
            seen_w[places] += change_w * change_w
            seen_v[places] += change_v * change_v
            machine.weights[places] -= RATE * change_w / np.sqrt(seen_w[places])
            machine.factors[places] = own - 0.2 * RATE * change_v / np.sqrt(seen_v[places])
    return machine


def learning_sample(documents: DataFrame, labels: DataFrame, learn: Column, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents of either label, by a hash of the id.

    ``learn`` says of a labels row whether it may be learned from. The chosen ids are a bounded
    table, so they are broadcast and the documents are read without a shuffle.
    """
    known = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = first_by_hash(known, "toxic", "doc_id", rows, seed=3)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def fit(documents: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> Machine:
    """A machine trained on a bounded sample; without labelled rows it scores all alike.

    Tasks turn texts into places; only those of the sample, at most twice ``rows`` sets, come to
    the driver. Null texts are empty sets. If a document has several labels each counts.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [term_places(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.list_(pa.int64())), batch.column(1)], ["places", "toxic"]
            )

    sample = learning_sample(documents, labels, learn, rows).mapInArrow(task, "places array<long>, toxic int")
    collected = sample.toArrow()
    lists = collected.column("places").combine_chunks()
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    labels_ = collected.column("toxic").to_numpy()
    sets = [values[a:b] for a, b in zip(ends, ends[1:])]
    # an order of their own, as tasks end in any order
    order = sorted(range(len(sets)), key=lambda n: (labels_[n], sets[n].tobytes()))
    machine = train([sets[n] for n in order], labels_[order].astype(np.int64))
    machine.weights = machine.weights.astype(np.float32)
    machine.factors = machine.factors.astype(np.float32)
    return machine


def score(texts: DataFrame, machine: Machine, target: str = "score") -> DataFrame:
    """Add the score, from 0 to 1, of every row's whole ``text``; all columns are kept.

    A null or empty text has no terms and gets the machine's bias as its score; repeated rows
    get equal scores. A column named like the target is replaced.
    """
    keep = [c for c in texts.columns if c != target]
    place = {c: n for n, c in enumerate(texts.columns)}
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep)
    shared = texts.sparkSession.sparkContext.broadcast(machine)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                scores = [own.score(term_places(t)) for t in part.column(place["text"]).to_pylist()]
                columns = [part.column(place[c]) for c in keep] + [pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, target])

    return texts.mapInArrow(task, f"{kinds}, `{target}` double")
