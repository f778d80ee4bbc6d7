"""Operator 7, language ID by error-correcting output codes.

Every learned language has a codeword of bits (all distinct splits of the languages for
few of them, seeded random splits for many).  One binary classifier per bit, a logistic
regression on hashed character 1- to 3-grams of the whole text, gives a margin.  Decoding
adds up, over the bits, the logistic loss of the margin against the codeword's bit,
weighted by how well the bit's classifier fits, and takes the codeword of least loss.
``score`` is the softmax of the losses; ``ambiguous`` flags scores below ``AMBIGUOUS``.

The classifiers are fitted on a bounded sample: at most ``PER_LANGUAGE`` documents of each
language, taken in hash order from those that are not held out; rows equal in id, text and
language are learned once.

Defined results: a null text or one without a letter is ``und`` with score 0; rows without
a language are predicted but not learned; with nothing to learn from all is ``und``; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.ship import ship

PER_LANGUAGE = 300
BUCKETS = 1 << 12
EXHAUSTIVE = 6          # up to so many languages the code holds every split
AMBIGUOUS = 0.6
UNKNOWN = "und"
_PIECE = 1 << 20        # characters handled at a time
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def gram_counts(text: str | None) -> np.ndarray:
    """Relative frequencies of hashed 1- to 3-grams; all 0 without a letter."""
    counts = np.zeros(BUCKETS)
    low = (text or "").lower()
    for at in range(0, len(low), _PIECE):
        points = np.frombuffer(low[at:at + _PIECE + 2].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        letter = _letters()[points]
        points = np.where(letter, points, np.uint64(0))
        here = min(_PIECE, len(points))
        gram, any_letter = np.zeros(len(points), dtype=np.uint64), np.zeros(len(points), dtype=bool)
        for n in range(3):
            if len(points) <= n:
                break
            size = len(points) - n
            gram, any_letter = gram[:size] * np.uint64(1_000_003) + points[n:] + np.uint64(1), any_letter[:size] | letter[n:]
            spread = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            use = min(here, size)
            counts += np.bincount(spread[:use][any_letter[:use]].astype(np.int64), minlength=BUCKETS)
    total = counts.sum()
    return counts / total if total else counts


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """(classes, bits) of +1 and -1; every column splits the classes."""
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= EXHAUSTIVE:
        splits = [[(s >> c) & 1 for c in range(classes)] for s in range(1, 1 << (classes - 1))]
        return np.array(splits).T * 2.0 - 1
    rng = np.random.default_rng(seed)
    columns: list[np.ndarray] = []
    while len(columns) < int(10 * np.log2(classes)) + 1:
        column = rng.integers(0, 2, classes) * 2.0 - 1
        if abs(column.sum()) < classes:
            columns.append(column)
    return np.array(columns).T


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray   # (BUCKETS, bits)
    bias: np.ndarray
    trust: np.ndarray     # weight of each bit's loss

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text)
        if not self.languages or not counts.any():
            return UNKNOWN, 0.0
        margin = np.sqrt(counts) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * margin) @ self.trust
        likely = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        return self.languages[best], float(likely[best] / likely.sum())


def fit(features: np.ndarray, labels: list[str], rounds: int = 300, ridge: float = 1e-4) -> Model:
    """Logistic regressions for all bits at once, by gradient steps with momentum."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    x = np.sqrt(features)
    y = code[[languages.index(v) for v in labels]] if labels else np.zeros((0, code.shape[1]))
    share = {v: labels.count(v) for v in languages}
    weight = np.array([1 / share[v] for v in labels])[:, None]
    weight = weight / weight.sum() if len(weight) else weight
    w, b = np.zeros((x.shape[1], code.shape[1])), np.zeros(code.shape[1])
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds if len(languages) > 1 else 0):
        push = -y * weight / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        vw = 0.9 * vw - 4.0 * (x.T @ push + ridge * w)
        vb = 0.9 * vb - 4.0 * push.sum(axis=0)
        w, b = w + vw, b + vb
    right = (np.sign(x @ w + b) == y) if len(languages) > 1 else np.ones_like(y, dtype=bool)
    trust = np.maximum(0.05, 2 * (right * weight).sum(axis=0) - 1) if len(labels) else np.ones(code.shape[1])
    return Model(languages, code, w, b, trust / trust.max())


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, out = batch.column(0), []
        for text in batch.column(1).to_pylist():
            out.append(gram_counts(text).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([langs, pa.array(out, pa.binary())], names=["lang", "features"])


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """The model, from the documents that are not held out and name their language."""
    ship(docs.sparkSession)
    open_rows = docs.filter(docs["lang"].isNotNull() & ~held_out(docs["doc_id"])).select(
        docs["doc_id"], docs["lang"], docs["text"], F.xxhash64(docs["doc_id"].cast("string"), docs["text"]).alias("h"))
    # only hashes are ranked; the rank limit is applied before the shuffle
    ranked = open_rows.filter(F.col("text").rlike("\\p{L}")).select("lang", "h").dropDuplicates().withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= per_language).drop("r")
    chosen = open_rows.join(F.broadcast(ranked), ["lang", "h"]).dropDuplicates(["lang", "h"])
    rows = chosen.select("lang", "text").mapInArrow(_featurise, "lang string, features binary").collect()
    features = np.array([np.frombuffer(r.features, dtype=np.float32) for r in rows], dtype=np.float64).reshape(-1, BUCKETS)
    return fit(features, [r.lang for r in rows])


def _predict(model: Model, ambiguous: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column(2).to_pylist()]
            langs, scores = [x[0] for x in found], [x[1] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([s < ambiguous for s in scores], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return run


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE, ambiguous: float = AMBIGUOUS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""
    model = learn(docs, per_language)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"]).mapInArrow(
        _predict(model, ambiguous), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
