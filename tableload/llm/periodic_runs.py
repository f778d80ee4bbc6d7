"""Periodic run detection: stretches of a text that repeat a few words again and again.

A run is a stretch of consecutive words with smallest period q that is at least ``max(least, times * q)`` words
long (6 and 4 here) and that no neighbouring word extends with the same period.  Words become numbers, and
the numbers of many documents lie in one array, with a number of its own after each document, so that no
period crosses from one document into the next.

* **Short periods** (up to ``SHORT``) are found by a direct lag scan: the places that equal the place q further.
* **Longer ones** are found by minimizers, scale by scale.  At scale Q, for periods in (Q/2, Q], a context is
  the Q words from a place; contexts get exact numbers by doubling (a context of 2Q words is a pair of numbers of
  Q words), so that no hash collision can lose a run.  Of every window of Q/2 contexts the places of the least
  scrambled number are kept.  A run of period q in (Q/2, Q] spans 4q words, so it holds a window and the same window
  q words later, both with all their contexts; their minima are kept and equal.  A context of Q >= q words recurs
  in the run at distance q and no earlier (else two periods would meet in their common divisor), so the two
  minima are neighbours among the kept places of that context.  Every such pair at a distance in (Q/2, Q] is a seed.
* **Extension.** A seed is extended word by word to both sides, in growing blocks, over the numbers themselves; seeds
  inside a stretch already found for their period are skipped.  A stretch whose period is a multiple of a
  smaller one is dropped: that period's run holds it.

The work is per document, without a shuffle.  A null text has no words and no runs; an empty one, likewise.  Repeated
rows and null ids keep their rows, an empty table gives none, other columns are not read.  Documents are taken
together up to ``GROUP_BYTES`` of text, so memory is bounded by the longest single text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tableload.llm.ship import ship
from tableload.llm.text import documents, mix64

LEAST, TIMES = 6, 4  # words, and periods, that a run has at least
SHORT = 8  # periods found by lag scans; a power of two
GROUP_BYTES = 4_000_000  # text taken together
Run = tuple[int, int, int]  # start, length, period


def _divisors(q: int) -> list[int]:
    """q divided by each of its prime factors."""
    out, rest, p = [], q, 2
    while rest > 1:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1 if p * p <= rest else max(1, rest - p)
    return out


def _primitive(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether the q words at ``start`` are no repetition of fewer words."""
    root = ids[start:start + q]
    return not any(np.array_equal(root[:-d], root[d:]) for d in _divisors(q))


def _needed(q: int, least: int, times: int) -> int:
    return max(least, times * q)


def _lag_scan(ids: np.ndarray, q: int, least: int, times: int) -> list[Run]:
    """Maximal stretches of period q, whole runs only."""
    if len(ids) <= q:
        return []
    same = ids[:-q] == ids[q:]
    edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    long = end - begin + q >= _needed(q, least, times)
    return [(int(b), int(e - b + q), q) for b, e in zip(begin[long], end[long], strict=True) if _primitive(ids, int(b), q)]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of two arrays of equal length are equal."""
    at, step = 0, 64
    while at < len(a):
        differ = np.flatnonzero(a[at:at + step] != b[at:at + step])
        if len(differ):
            return at + int(differ[0])
        at += step
        step *= 2
    return len(a)


def _extended(ids: np.ndarray, at: int, q: int) -> Run:
    """The longest stretch of period q around the place ``at`` and its image q words later."""
    right = _agree(ids[at:len(ids) - q], ids[at + q:])
    left = _agree(ids[:at][::-1], ids[q:at + q][::-1])
    return at - left, left + right + q, q


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, from running minima over blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _minimizers(numbers: np.ndarray, width: int) -> np.ndarray:
    """Places whose scrambled number is least in a window that holds them (ties all count)."""
    scrambled = mix64(numbers)
    if width == 1:
        return np.arange(len(numbers))
    if len(numbers) < width:
        return np.empty(0, np.int64)
    least = _window_minima(scrambled, width)
    # a place is kept if it equals the minimum of any of the windows over it: the largest of their minima
    flipped = ~np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    over = ~_window_minima(flipped, width)
    return np.flatnonzero(scrambled == over)


def _ranked(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers, different ones different numbers."""
    return np.unique(high << np.uint64(32) | low, return_inverse=True)[1].astype(np.uint64)


def _seeds(numbers: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbouring minimizers of equal context at distances in (scale / 2, scale]."""
    kept = _minimizers(numbers, scale // 2)
    order = np.argsort(numbers[kept], kind="stable")
    place, number = kept[order], numbers[kept][order]
    gap = np.diff(place)
    near = (number[1:] == number[:-1]) & (gap > scale // 2) & (gap <= scale)
    yield place[:-1][near], gap[near]


def _runs(ids: np.ndarray, longest: int, least: int, times: int) -> list[Run]:
    """All runs of an array in which no stretch is longer than ``longest``."""
    found = [run for q in range(1, min(SHORT, longest // times) + 1) for run in _lag_scan(ids, q, least, times)]
    # numbers of single words, then of contexts of 2, 4, ... words
    numbers, span, scale = ids.astype(np.uint64), 1, 2 * SHORT
    while times * (scale // 2 + 1) <= longest:
        while span < scale:
            numbers = _ranked(numbers[:-span], numbers[span:])
            span *= 2
        for places, gaps in _seeds(numbers, scale):
            order = np.lexsort((places, gaps))
            last, until = 0, -1
            for at, q in zip(places[order].tolist(), gaps[order].tolist(), strict=True):
                if q == last and at + q < until:
                    continue
                run = _extended(ids, at, q)
                last, until = q, run[0] + run[1]
                if run[1] >= _needed(q, least, times) and _primitive(ids, run[0], q):
                    found.append(run)
        scale *= 2
    return found


def runs_of(documents: Sequence[Sequence], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """The runs (start, length, period) of every document's words, by start, then period."""
    if times < 4:
        raise ValueError("runs of fewer than four periods are not found by the minimizers of a scale")
    numbering: defaultdict = defaultdict()
    numbering.default_factory = numbering.__len__
    lengths = np.array([len(w) for w in documents], np.int64)
    out: list[list[Run]] = [[] for _ in documents]
    # long documents by themselves, so that the high scales read only them
    for low, high in ((0, 128), (128, 2048), (2048, None)):
        chosen = [i for i, n in enumerate(lengths) if low <= n and (high is None or n < high)]
        if not chosen:
            continue
        total = int(lengths[chosen].sum()) + len(chosen)
        ids = np.empty(total, np.int64)
        begins, at = [], 0
        for i in chosen:
            begins.append(at)
            n = int(lengths[i])
            ids[at:at + n] = np.fromiter(map(numbering.__getitem__, documents[i]), np.int64, n)
            at += n + 1
        ends = np.array(begins, np.int64) + lengths[chosen]
        ids[ends] = len(numbering) + np.arange(len(chosen))  # each document ends in a number of its own
        for start, length, q in _runs(ids, int(lengths[chosen].max()), least, times):
            d = int(np.searchsorted(begins, start, side="right")) - 1
            out[chosen[d]].append((start - begins[d], length, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: Sequence, runs: Sequence[Run]) -> list:
    """The words without those that follow the first period of a run."""
    if not runs:
        return list(words)
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run of most periods (compared exactly); ties go to the least start, then period."""
    best = None
    for run in runs:
        if best is None or (run[1] * best[2], -run[0], -run[2]) > (best[1] * run[2], -best[0], -best[2]):
            best = run
    return best


def looped(doc_id: int | None, words: list) -> list:
    """The words as the registered query reads them: those of one document in ten (by its id's crc32)
    repeat a stretch of its own from some place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of documents, as many together as make up ``GROUP_BYTES``."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
        data = text.cast(pa.large_binary()).as_py() or b""
        ids.append(doc_id.as_py())
        texts.append(data.split())  # the blanks of bytes.split are the six of the word rule
        held += len(data)
        if held >= GROUP_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _mapped(docs: DataFrame, schema: str, rows: Callable, edit: Callable | None, least: int, times: int) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _groups(batch):
                if edit is not None:
                    texts = [edit(i, w) for i, w in zip(ids, texts, strict=True)]
                columns = rows(ids, texts, runs_of(texts, least, times))
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    arrow = pa.schema([(n, {"long": pa.int64(), "string": pa.string()}[t]) for n, t in
                       (c.strip().split() for c in schema.split(","))])
    return documents(docs, "doc_id", "text").mapInArrow(run, schema)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row for each run of a document: doc_id, start, length, period (word numbers from 0)."""
    def rows(ids, texts, runs):
        flat = [(i, *r) for i, rs in zip(ids, runs, strict=True) for r in rs]
        return dict(zip(("doc_id", "start", "length", "period"), map(list, zip(*flat, strict=True)), strict=True)) if flat else {
            "doc_id": [], "start": [], "length": [], "period": []}

    return _mapped(docs, "doc_id long, start long, length long, period long", rows, None, least, times)


def collapse_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, number of runs and the text with every run cut to its first period (words joined by one space)."""
    def rows(ids, texts, runs):
        return {"doc_id": ids, "n_runs": [len(r) for r in runs],
                "text": [b" ".join(collapsed(w, r)).decode() for w, r in zip(texts, runs, strict=True)]}

    return _mapped(docs, "doc_id long, n_runs long, text string", rows, None, least, times)


def run_digests(docs: DataFrame, edit: Callable[[int | None, list], list] | None = looped) -> DataFrame:
    """One row per document: its number of runs, its strongest run, and digests of all runs and of the
    collapsed text, after ``edit`` has changed the words."""
    def rows(ids, texts, runs):
        best = [strongest(r) for r in runs]
        part = lambda k: [b[k] if b else None for b in best]
        return {
            "doc_id": ids, "n_runs": [len(r) for r in runs], "start": part(0), "length": part(1), "period": part(2),
            "exponent_milli": [1000 * b[1] // b[2] if b else None for b in best],
            "runs_sha256": [hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in r).encode()).hexdigest() for r in runs],
            "collapsed_sha256": [hashlib.sha256(b" ".join(collapsed(w, r))).hexdigest() for w, r in zip(texts, runs, strict=True)]}

    return _mapped(docs, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                         "runs_sha256 string, collapsed_sha256 string", rows, edit, LEAST, TIMES)
