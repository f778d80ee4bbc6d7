"""Operator 3, quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its whole text.  Of a document labelled
1 and one labelled 0, the first is preferred with probability sigmoid(strength difference);
the weights minimise the logistic loss on feature differences of sampled preference pairs.
The cut is the quantile of the strengths of all labelled rows that are not held out, at
their share of label 0, and ``score`` = sigmoid(strength - cut), so predicted = 1 from the
cut on.

The features of every document are computed once and written to the shared folder.  The
weights are fitted on a bounded sample of them: at most ``PER_LABEL`` labelled documents of
each label, taken in hash order from those that are not held out (equal rows once), and
``PAIRS`` pairs drawn with a fixed seed.  The cut is not sampled: the strengths of all those
rows are searched for the exact quantile, digit by digit, in Spark.

Defined results: null and empty texts are scored from all-zero counts; unlabelled documents
are scored; of several labels of one document the least counts; labels other than 0 and 1
and null labels are not learned; without both labels every score is 0.5; repeated rows are
scored one by one; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.llm.language_id import held_out
from tableload.llm.quality_rules import STOP_WORDS
from tableload.llm.ship import ship
from tableload.session import scratch_path

PER_LABEL = 3000
PAIRS = 100_000
ROUNDS = 400
_STOP = frozenset(w.encode() for w in STOP_WORDS)
FEATURES = ("log_words", "word_length", "long_words", "symbols", "digits", "upper", "capitals", "exclaims", "stops",
            "sentence_ends", "commas", "distinct", "top_word", "repeats", "dup_lines", "line_words", "non_ascii")


def features(text: str | None) -> list[float]:
    """Length, symbol, case, stop-word, repetition and line ratios of a whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    chars = sum(map(len, words))
    tally = Counter(raw)
    part = lambda marks: sum(tally[c] for c in marks)
    upper, lower = part(range(65, 91)), part(range(97, 123))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        float(np.log1p(n)), chars / n, sum(len(w) * c > 0 and len(w) > 20 for w, c in counts.items()) / n,
        min(3.0, part(b"#*$%&|<>") / n), min(3.0, part(b"0123456789") / n), upper / (upper + lower + 1),
        sum(c for w, c in counts.items() if w[:1].isupper()) / n, min(3.0, part(b"!") / n),
        sum(c for w, c in counts.items() if w.lower().strip(b".,;:!?") in _STOP) / n,
        min(1.0, part(b".?") / n), min(1.0, part(b",;") / n), len(counts) / n, max(counts.values()) / n,
        1 - pairs / (n - 1) if n > 1 else 0.0, 1 - len(set(lines)) / len(lines), min(5.0, float(np.log1p(n / len(lines)))),
        sum(v for k, v in tally.items() if k >= 128) / len(raw),
    ]


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        """Summed row by row, so that a row has one strength in whatever batch it comes."""
        return (np.clip((rows - self.mean) / self.scale, -8, 8) * self.weights).sum(axis=1) + 0.0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strengths(rows) - self.cut, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS, ridge: float = 1e-3, seed: int = 3) -> Ranker:
    """Bradley-Terry weights by gradient steps on sampled (label 1, label 0) pairs; the cut is still 0."""
    d = len(FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w, v = np.zeros(d), np.zeros(d)
    for _ in range(rounds):
        push = -(diff / (1 + np.exp(np.clip(diff @ w, -30, 30)))[:, None]).mean(axis=0) + ridge * w
        v = 0.9 * v - 0.3 * push
        w = w + v
    return Ranker(mean, scale, w, 0.0)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _ordinals(ranker: Ranker) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Strengths as whole numbers of the same order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = ranker.strengths(_matrix(batch.column(0))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits))], names=["s"])
    return run


def _strength(ordinal: int) -> float:
    bits = np.array([ordinal], dtype=np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(np.float64)[0])


def _nth(ordinals: DataFrame, n: int) -> int:
    """The ``n``-th least (from 0) of the whole numbers ``s``: 16 bits a round, from the
    counts of their values."""
    rest, top = ordinals, 0
    for low in (48, 32, 16, 0):
        digit = F.shiftright("s", low)
        counts = sorted((r.d, r.n) for r in rest.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect())
        for d, many in counts:
            top = d
            if n < many:
                break
            n -= many
        rest = rest.filter(digit == top)
    return top


def _quantile(ordinals: DataFrame, k: int, total: int) -> float:
    """The cut with ``k`` of the strengths below, halfway between the neighbouring ones."""
    k = min(k, total - 1)
    if not k:
        return _strength(_nth(ordinals, 0))
    below = _nth(ordinals, k - 1)
    up_to, above = ordinals.agg(F.count_if(F.col("s") <= below), F.min(F.when(F.col("s") > below, F.col("s")))).first()
    return (_strength(below) + _strength(below if up_to > k else above)) / 2


def _learn(rows: DataFrame, labels: DataFrame, per_label: int, folder: str) -> Ranker:
    """The ranker, from the features (id, x) of labelled documents that are not held out."""
    spark = rows.sparkSession
    labels.select(labels["doc_id"].alias("lid"), labels["quality"].cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("lid").isNotNull() & ~held_out(F.col("lid"))).groupBy("lid").agg(
        F.min("label").alias("label")).write.parquet(f"{folder}/labels")
    # read again, so that the join may split an id with many rows
    marked = spark.read.parquet(f"{folder}/labels")
    rows.join(marked, F.col("id") == F.col("lid")).select("lid", "label", "x", F.xxhash64("x").alias("xh")) \
        .write.parquet(f"{folder}/labelled")
    labelled = spark.read.parquet(f"{folder}/labelled")
    total = dict(labelled.groupBy("label").agg(F.count("*")).collect())
    if len(total) < 2:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, dtype=int))
    order: list[Column | str] = [F.xxhash64(F.col("lid").cast("string")), "lid", "xh"]
    once = labelled.select("lid", "label", "xh").dropDuplicates()
    picked = once.filter("label = 0").orderBy(*order).limit(per_label).unionAll(
        once.filter("label = 1").orderBy(*order).limit(per_label))
    sample = labelled.join(F.broadcast(picked), ["lid", "label", "xh"]).dropDuplicates(["lid", "label", "xh"]) \
        .orderBy(*order).select("label", "x").collect()
    ranker = fit(np.array([r.x for r in sample]).reshape(-1, len(FEATURES)), np.array([r.label for r in sample], dtype=int))
    labelled.select("x").mapInArrow(_ordinals(ranker), "s long").write.parquet(f"{folder}/strengths")
    return replace(ranker, cut=_quantile(spark.read.parquet(f"{folder}/strengths"), total[0], total[0] + total[1]))


def _featured(docs: DataFrame, folder: str) -> DataFrame:
    """(id, x) of every document, from a table."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs.select(docs["doc_id"].alias("id"), docs["text"]).mapInArrow(_featurise, f"id {kind}, x array<double>") \
        .write.parquet(f"{folder}/features")
    return docs.sparkSession.read.parquet(f"{folder}/features")


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Ranker:
    """The ranker, from labelled documents that are not held out."""
    folder = scratch_path(docs.sparkSession, "quality-classifier")
    return _learn(_featured(docs, folder), labels, per_label, folder)


def _score(ranker: Ranker) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = ranker.scores(_matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])
    return run


def quality_classifier(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    folder = scratch_path(docs.sparkSession, "quality-classifier")
    rows = _featured(docs, folder)
    ranker = _learn(rows, labels, per_label, folder)
    return rows.select(F.col("id").cast("long").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "x").mapInArrow(
        _score(ranker), "doc_id long, held_out boolean, score double, predicted int")
