"""Quality rules learned as a decision list over statistics of texts.

A rule is a conjunction of thresholds, such as ``symbols_per_word > 0.4 and words <= 900``, and
a verdict; the first rule that holds decides, and a default decides the rest. Rules are found by
sequential covering. One is grown, condition by condition, on two thirds of the rows that no
rule covers yet, always by the threshold with the largest information gain. It is pruned on the
last third, to the beginning that tells hits from misses best. It stays if it is precise on
both; then the rows it covers are put aside. In the end rules without which the list is no worse
are left out. The list is emitted as one conditional expression of Spark columns, so applying it
is a projection.

Statistics are counted in the whole of every text, in tasks, and no text leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavebook.llm.common import BATCH_ROWS, first_by_hash, fresh

#: Labelled documents of either verdict that are learned from at most.
SAMPLE_ROWS = 5000
#: A list has so many rules, and a rule so many conditions, at most.
MOST_RULES, MOST_CONDITIONS = 16, 4
#: A rule must be right in this share of the rows it covers, and cover so many, in both parts.
PRECISION, LEAST_ROWS = 0.9, 3

#: The statistics of a text, all long.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_capitals", "n_digits", "n_marks")

_WHITE = b" \t\n\r\x0b\x0c"
#: Bytes that go on with a code point of UTF-8.
_LATER = bytes(range(0x80, 0xC0))
_CAPITALS, _DIGITS = bytes(range(65, 91)), b"0123456789"
_SYMBOLS, _MARKS = b"#*$%&|<>", b"!?.,;:"


def _occurs(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def _repeat_words(codes: list[np.ndarray]) -> np.ndarray:
    """For each text, given as numbers of words that no two texts share, its words in repeated windows.

    A window is three words in a row; equal ones get equal numbers by ranking first the pairs,
    then the pairs with a third word.
    """
    sizes = np.array([len(own) for own in codes], np.int64)
    words = np.concatenate([*codes, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(codes)), sizes)
    if len(words) < 3:
        return np.zeros(len(codes), np.int64)
    inside = owner[:-2] == owner[2:]
    span = int(words.max()) + 1
    _, pairs = np.unique(words[:-1] * span + words[1:], return_inverse=True)
    _, number, count = np.unique(pairs[:-1] * span + words[2:], return_inverse=True, return_counts=True)
    # a window across two texts has words of both, so none inside a text equals it
    repeated = inside & (count[number] > 1)
    covered = np.zeros(len(words), bool)
    for place in range(3):
        covered[place : len(words) - 2 + place] |= repeated
    return np.bincount(owner[covered], minlength=len(codes))


def _counted(texts: list[bytes | None]) -> dict[str, list[int]]:
    told: dict[str, list[int]] = {name: [] for name in (*BASE, *MORE)}
    codes, base = [], 0
    for text in texts:
        text = text or b""
        words = text.split()
        numbers: dict[bytes, int] = {}
        own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        codes.append(own + base)
        base += len(numbers)
        lines = [line for line in text.split(b"\n") if line.strip(_WHITE)]
        told["n_words"].append(len(words))
        told["word_chars"].append(len(text.translate(None, _WHITE + _LATER)))
        told["n_symbols"].append(_occurs(text, _SYMBOLS))
        told["n_dup_lines"].append(len(lines) - len(set(lines)))
        told["n_lines"].append(len(lines))
        told["n_distinct_words"].append(len(numbers))
        told["n_capitals"].append(_occurs(text, _CAPITALS))
        told["n_digits"].append(_occurs(text, _DIGITS))
        told["n_marks"].append(_occurs(text, _MARKS))
    told["n_repeat_words"] = _repeat_words(codes).tolist()
    return told


def statistics(texts: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns to keep and the statistics of every row's whole text.

    Words stand between ASCII white space; null and empty texts have none and count zero
    throughout. Repeated rows stay, an empty table stays empty. Columns to keep must not have
    names of statistics; all other columns may.
    """
    names = [*BASE, *MORE]
    taken = {c.lower() for c in keep} & set(names)
    if taken:
        raise ValueError(f"columns to keep are named like statistics: {sorted(taken)}")
    own = fresh("text")
    chosen = texts.select(*keep, F.col(text).alias(own))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                column = part.column(len(keep))
                kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
                told = _counted(column.cast(kind).to_pylist())
                columns = [part.column(n) for n in range(len(keep))]
                columns += [pa.array(told[name], pa.int64()) for name in names]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(task, ", ".join([*kinds, *(f"{name} long" for name in names)]))


def features() -> dict[str, Column]:
    """What conditions are about, by name, over the statistics; shares of nothing are zero."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "characters_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct_words", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "words_per_line": share("n_words", "n_lines"),
        "capitals": share("n_capitals", "word_chars"),
        "digits": share("n_digits", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if ``above``, else ``feature <= threshold``; a missing value meets neither."""

    feature: str
    above: bool
    threshold: float

    def met(self, values: np.ndarray) -> np.ndarray:
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, value: Column) -> Column:
        limit = F.lit(self.threshold)
        return (value > limit if self.above else value <= limit) & ~F.isnan(value)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class Rule:
    """A conjunction, and the verdict where it holds and no earlier rule does."""

    conditions: tuple[Condition, ...]
    verdict: int

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))}: {self.verdict}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order, and the verdict of rows that meet none."""

    rules: tuple[Rule, ...]
    default: int

    def verdict(self, columns: dict[str, Column]) -> Column:
        """One conditional expression over the columns of the features."""
        told = F.lit(self.default)
        for rule in reversed(self.rules):
            holds = F.lit(True)
            for condition in rule.conditions:
                holds = holds & condition.column(columns[condition.feature])
            told = F.when(holds, F.lit(rule.verdict)).otherwise(told)
        return told

    def decide(self, values: np.ndarray, names: list[str]) -> np.ndarray:
        """The verdicts of rows of an array with a column for each feature."""
        told = np.full(len(values), self.default)
        for rule in reversed(self.rules):
            told[_holds(rule.conditions, values, names)] = rule.verdict
        return told


def _holds(conditions: tuple[Condition, ...], values: np.ndarray, names: list[str]) -> np.ndarray:
    met = np.ones(len(values), bool)
    for condition in conditions:
        met &= condition.met(values[:, names.index(condition.feature)])
    return met


def _best_condition(values: np.ndarray, wanted: np.ndarray, names: list[str]) -> Condition | None:
    """The threshold with the largest gain of information on the wanted rows it lets through.

    Thresholds lie half way between neighbouring values; the first best in the order of features,
    thresholds from small to large and ``<=`` before ``>`` is taken.
    """
    total, hits = len(wanted), int(wanted.sum())
    best, found = 1e-9, None
    for n, name in enumerate(names):
        order = np.argsort(values[:, n], kind="stable")
        sorted_ = values[order, n]
        below = np.cumsum(wanted[order])
        ends = np.flatnonzero(sorted_[1:] > sorted_[:-1])  # NaN is neither a border nor let through
        if not len(ends):
            continue
        known = int((~np.isnan(sorted_)).sum())
        left, left_hits = ends + 1, below[ends]
        for above, rows, own in ((False, left, left_hits), (True, known - left, below[known - 1] - left_hits)):
            gain = own * (np.log2(np.maximum(own, 1e-12) / rows) - np.log2(hits / total))
            at = int(np.argmax(gain))
            if gain[at] > best:
                low, high = float(sorted_[ends[at]]), float(sorted_[ends[at] + 1])
                middle = low + (high - low) / 2
                best, found = float(gain[at]), Condition(name, above, middle if middle < high else low)
    return found


def _grown(values: np.ndarray, wanted: np.ndarray, names: list[str]) -> tuple[Condition, ...]:
    conditions: tuple[Condition, ...] = ()
    while len(conditions) < MOST_CONDITIONS and wanted.any() and not wanted.all():
        condition = _best_condition(values, wanted, names)
        if condition is None:
            break
        conditions += (condition,)
        met = _holds((condition,), values, names)
        values, wanted = values[met], wanted[met]
    return conditions


def _worth(conditions: tuple[Condition, ...], values: np.ndarray, wanted: np.ndarray, names: list[str]) -> tuple[int, int]:
    met = _holds(conditions, values, names)
    return int((met & wanted).sum()), int((met & ~wanted).sum())


def _pruned(conditions, values, wanted, names) -> tuple[Condition, ...]:
    """The beginning of the conjunction that is worth most; the shorter of equal ones."""

    def worth(count: int) -> tuple[float, int]:
        hits, misses = _worth(conditions[:count], values, wanted, names)
        return (hits - misses) / max(1, hits + misses), -count

    return conditions[: max(range(1, len(conditions) + 1), key=worth)]


def learn(values: np.ndarray, labels: np.ndarray, names: list[str], otherwise: int = 1, seed: int = 11) -> DecisionList:
    """A list for labels 0 and 1 of rows with a value for each feature.

    Rules are sought for the rarer label, and the other is the default; with one label only it
    is the default, with no rows ``otherwise`` is. The order of the rows does not matter.
    """
    if not len(labels):
        return DecisionList((), otherwise)
    ones = int(labels.sum())
    rare = int(ones * 2 < len(labels))
    order = np.lexsort((*values.T, labels))
    values, wanted = values[order], labels[order] == rare
    if wanted.all():
        return DecisionList((), rare)
    chance = np.random.default_rng(seed)
    rules: list[Rule] = []
    rest = np.ones(len(wanted), bool)
    while len(rules) < MOST_RULES and (rest & wanted).any():
        rows = np.flatnonzero(rest)
        # a third of either label is kept for pruning
        held = np.zeros(len(wanted), bool)
        for label in (True, False):
            own = chance.permutation(rows[wanted[rows] == label])
            held[own[: len(own) // 3]] = True
        grow, prune = rest & ~held, rest & held
        conditions = _grown(values[grow], wanted[grow], names)
        if not conditions:
            break
        conditions = _pruned(conditions, values[prune], wanted[prune], names)
        parts = [_worth(conditions, values[part], wanted[part], names) for part in (grow, prune)]
        if any(hits < LEAST_ROWS or hits < PRECISION * (hits + misses) for hits, misses in parts):
            break
        rules.append(Rule(conditions, rare))
        rest &= ~_holds(conditions, values, names)

    def errors(some: list[Rule]) -> int:
        told = DecisionList(tuple(some), 1 - rare).decide(values, names) == rare
        return int((told != wanted).sum())

    for rule in reversed(rules[:]):
        without = [other for other in rules if other is not rule]
        if errors(without) <= errors(rules):
            rules = without
    return DecisionList(tuple(rules), 1 - rare)


def learning_rows(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """(key, label) of at most ``rows`` labelled keys of either label 0 or 1, chosen by a hash.

    A key with several labels counts with each.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.select(F.col(key), F.col(label).cast("int").alias(label)).distinct()
    return first_by_hash(known, label, key, rows, seed=12)


def base_failed() -> Column:
    """Whether the fixed rules reject a row: fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = SAMPLE_ROWS
) -> DecisionList:
    """A list learned from labelled documents that the fixed rules let pass.

    ``rows`` documents of either label at most take part, one row each where ids repeat, and
    only their features come to the driver. The chosen ids are broadcast; no text is shuffled.
    """
    chosen = learning_rows(labels, key, label, rows)
    some = documents.select(key, "text").join(F.broadcast(chosen), key)
    counted = statistics(some, [key, label]).where(~base_failed())
    told = features()
    values = F.struct([value.alias(name) for name, value in told.items()]).alias("values")
    single = counted.select(key, label, values).groupBy(key, label).agg(F.min("values").alias("values"))
    sample = single.select(label, "values.*").toPandas()
    return learn(sample[list(told)].to_numpy(float), sample[label].to_numpy(int), list(told))
