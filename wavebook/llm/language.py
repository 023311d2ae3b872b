"""Language identification by a convolutional network over bytes.

A text is cut into windows of a fixed number of bytes. Filters of several widths run over the
bytes of a window, their largest answers make its features, and a softmax gives the
languages' probabilities; a text's are the mean over its windows. The network is trained in
numpy by gradient steps on a bounded sample of labelled windows.

A filter over one-hot bytes is a sum of table entries, one table per place in the filter, so
applying it is a few look-ups per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavebook.llm.common import BATCH_ROWS

WINDOW_BYTES = 256
WIDTHS, FILTERS = (2, 3, 4), 8
#: Labelled texts taken for training, per language, and windows taken of each.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 600, 3
SPREAD = 64
EPOCHS, BATCH, RATE = 8, 64, 0.006
UNKNOWN = "und"


@dataclass
class Network:
    """``tables[w]`` is (width, 256, filters); ``out`` maps the maxima to the languages."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    moments: dict = field(default_factory=dict)
    pairs: list = field(default_factory=list)

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest answer of every filter, and where it was, for rows of bytes."""
        best, places = [], []
        for table in self.tables:
            width = table.shape[0]
            length = windows.shape[1] - width + 1
            answer = table[0][windows[:, :length]]
            for place in range(1, width):
                answer += table[place][windows[:, place : place + length]]
            places.append(answer.argmax(axis=1))
            best.append(answer.max(axis=1))
        return np.concatenate(best, axis=1) + self.bias, places

    def paired(self) -> list[list[np.ndarray]]:
        """Tables by pairs of bytes for two places of a filter at once; an odd last place is alone."""
        if not self.pairs:
            for table in self.tables:
                width, _, filters = table.shape
                own = [
                    (table[n][:, None] + table[n + 1][None, :]).reshape(-1, filters)
                    for n in range(0, width - 1, 2)
                ]
                self.pairs.append(own + [table[-1]] * (width % 2))
        return self.pairs

    def best_answers(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        best = []
        for table, own in zip(self.tables, self.paired()):
            width = table.shape[0]
            length = windows.shape[1] - width + 1
            answer = np.take(own[0], pairs[:, :length], axis=0)
            for n in range(1, len(own)):
                source = pairs if 2 * n + 1 < width else windows
                answer += np.take(own[n], source[:, 2 * n : 2 * n + length], axis=0)
            best.append(answer.max(axis=1))
        return np.concatenate(best, axis=1) + self.bias

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.best_answers(windows), 0)
        return _softmax(hidden @ self.out + self.out_bias)


def _softmax(values: np.ndarray) -> np.ndarray:
    powers = np.exp(values - values.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def windows_of(text: str, size: int = WINDOW_BYTES) -> np.ndarray:
    """The whole text as rows of bytes; the last row is filled up with zeros."""
    data = text.encode("utf-8", "surrogatepass")
    rows = max(1, -(-len(data) // size))
    padded = np.zeros(rows * size, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return padded.reshape(rows, size)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross-entropy, in a fixed order given by the seed."""
    chance = np.random.default_rng(seed)
    hidden = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [chance.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(hidden, np.float32),
        chance.normal(0, 0.1, (hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    step = 0
    for epoch in range(EPOCHS):
        order = chance.permutation(len(windows))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            _step(net, windows[some], labels[some], rate, step)
    return net


def _step(net: Network, windows: np.ndarray, labels: np.ndarray, rate: float, step: int) -> None:
    raw, places = net.features(windows)
    hidden = np.maximum(raw, 0)
    error = _softmax(hidden @ net.out + net.out_bias)
    error[np.arange(len(labels)), labels] -= 1
    error /= len(labels)
    back = (error @ net.out.T) * (raw > 0)
    _adam(net, "out", net.out, hidden.T @ error, rate, step)
    _adam(net, "out_bias", net.out_bias, error.sum(axis=0), rate, step)
    _adam(net, "bias", net.bias, back.sum(axis=0), rate, step)
    rows = np.arange(len(windows))[:, None]
    filters = np.arange(FILTERS)[None, :]
    for n, table in enumerate(net.tables):
        part = back[:, n * FILTERS : (n + 1) * FILTERS]
        change = np.zeros_like(table)
        for place in range(table.shape[0]):
            np.add.at(change[place], (windows[rows, places[n] + place], filters), part)
        _adam(net, f"table{n}", table, change, rate, step)


def _adam(net: Network, name: str, value: np.ndarray, change: np.ndarray, rate: float, step: int) -> None:
    if name not in net.moments:
        net.moments[name] = (np.zeros_like(value), np.zeros_like(value))
    first, second = net.moments[name]
    first += 0.1 * (change - first)
    second += 0.001 * (change * change - second)
    value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)


def training_sample(labelled: DataFrame, per_language: int, windows: int) -> list:
    """A bounded sample of (text, lang): the different texts with the smallest hashes of each language.

    Of a text, ``windows`` stretches spread over it. So what comes to the driver is bounded by the
    languages, which are few, whatever the size of the table. Copies of a text count once.
    """
    names = ["lang", "first", "second"]
    hashed = labelled.where(F.col("text").rlike("\\p{L}")).select(
        "lang", F.xxhash64("text", F.lit(11)).alias("first"), F.xxhash64("text").alias("second"), "text"
    )
    # first in SPREAD parts of a language, so that no task reads many rows of one
    part = F.pmod("second", F.lit(SPREAD))
    within_part = Window.partitionBy("lang", "part").orderBy("first", "second")
    order = Window.partitionBy("lang").orderBy("first", "second")
    length = F.length("text")
    stretches = [
        F.substring("text", F.floor(length * F.lit(n / windows)).cast("int") + 1, F.lit(WINDOW_BYTES))
        for n in range(windows)
    ]
    chosen = (
        hashed.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("part", part)
        .withColumn("place", F.row_number().over(within_part))
        .where(F.col("place") <= per_language)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .select(*names)
    )
    # the chosen hashes are bounded like the sample, so the texts are read without a shuffle
    return (
        hashed.join(F.broadcast(chosen), names)
        .select(*names, F.array_distinct(F.array(*stretches)).alias("stretches"))
        .groupBy(*names)
        .agg(F.first("stretches").alias("stretches"))
        .select("lang", "stretches")
        .collect()
    )


def fit(labelled: DataFrame, per_language: int = SAMPLE_TEXTS, windows: int = SAMPLE_WINDOWS) -> Network:
    """A network trained on (text, lang); rows with null text or lang, or no letter, are not used."""
    rows = training_sample(labelled.where("text is not null and lang is not null"), per_language, windows)
    languages = sorted({row.lang for row in rows})
    data, labels = [], []
    for row in sorted(rows, key=lambda r: (r.lang, r.stretches)):
        for stretch in row.stretches:
            if stretch.strip():
                data.append(windows_of(stretch)[0])
                labels.append(languages.index(row.lang))
    if not data:
        return Network([], [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    net = train(np.stack(data), np.array(labels), languages)
    net.moments = {}
    return net


def identify(texts: DataFrame, net: Network, key_columns: list[str]) -> DataFrame:
    """(keys…, lang_pred, score) for every row of (keys…, text), over its whole text.

    ``und`` with score 0 for texts that are null or have no letter, and for all where the network knows
    no language. Repeated rows get equal answers; further columns are not read.
    """
    rows = texts.select(
        *key_columns,
        F.when(F.col("text").rlike("\\p{L}"), F.col("text")).alias("text"),
    )
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key_columns)
    shared = texts.sparkSession.sparkContext.broadcast(net)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                told = [_answer(own, t) for t in part.column(len(key_columns)).to_pylist()]
                columns = [part.column(n) for n in range(len(key_columns))]
                columns.append(pa.array([t[0] for t in told], pa.string()))
                columns.append(pa.array([t[1] for t in told], pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, [*key_columns, "lang_pred", "score"])

    return rows.mapInArrow(task, f"{kinds}, lang_pred string, score double")


def _answer(net: Network, text: str | None) -> tuple[str, float]:
    if text is None or not net.languages:
        return UNKNOWN, 0.0
    rows = windows_of(text)
    total = np.zeros(len(net.languages))
    for at in range(0, len(rows), 64):
        total += net.probabilities(rows[at : at + 64]).sum(axis=0)
    total /= len(rows)
    best = int(total.argmax())
    return net.languages[best], float(min(1.0, max(0.0, total[best])))


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether a row is held out: crc32 of the key as text, modulo the number of parts."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))
