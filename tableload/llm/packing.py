"""Operator 9, packing: order-preserving dynamic programming over window cuts.

Each task reads its documents in order, as one stream of token ids.  Candidate cuts
are ends of documents, ends of sentences and, inside long unbroken stretches, every
STRIDE tokens; a cut costs what ``CUT`` says for its kind.  A window [i, j) of at most
``window`` tokens costs its padding plus the penalty of the cut at j, so

    best[j] = min over i of (best[i] + at[i]) + window - at[j] + cut[j]

and the inner minimum over the sliding range of i is the front of a monotone queue.
Windows whose length is a power of two need no padding and are tried beside it.
The stream is solved block by block; the last, open window of a block is carried
into the next.  What a task has left at its end is cut into powers of two.

No shuffle: a sequence holds pieces of neighbouring documents of one input split, and
its id is (partition, running number).  A repeated task reads the same split in the same
order, so it repeats the same rows.

Defined results: a null or empty text is a piece of one token (the end id); a document
longer than the window spans several sequences; repeated rows are packed one by one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.ship import ship
from tableload.llm.text import documents
from tableload.llm.tokens import encoder

WINDOW = 2048
END_ID = 1
STRIDE = 128            # spacing of cut candidates where no sentence ends
CUT = {"document": 0, "sentence": 2, "inside": 24}  # penalties in tokens
SEQUENCE_COST = 8       # tokens that a further sequence counts as
LEAST_POWER = 6         # 2^6: shortest unpadded window tried inside the stream
BLOCK = 1 << 18         # tokens solved at a time
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def cut_candidates(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (ascending, in 1..len) where a window may end, and their penalties.
    A document's own end id ends no sentence beyond its document cut."""
    n = len(ids)
    penalty = np.full(n + 1, -1, dtype=np.int64)
    penalty[1:][ends_sentence[ids]] = CUT["sentence"]
    penalty[doc_ends] = CUT["document"]
    at = np.flatnonzero(penalty[1:] >= 0) + 1
    edges = np.concatenate(([0], at, [n]))
    gaps = np.diff(edges)
    long = np.flatnonzero(gaps > STRIDE)
    if len(long):
        inside = np.concatenate([np.arange(edges[i] + STRIDE, edges[i + 1], STRIDE) for i in long])
        penalty[inside] = np.where(penalty[inside] < 0, CUT["inside"], penalty[inside])
        at = np.flatnonzero(penalty[1:] >= 0) + 1
    if n and (not len(at) or at[-1] != n):
        at = np.append(at, n)
        penalty[n] = CUT["inside"]
    return at, penalty[at]


def best_windows(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Chosen cut positions, ending with the last candidate: least padding plus penalties."""
    m = len(at)
    place = np.concatenate(([0], at))
    exact: list[tuple[int, ...]] = [()] * (m + 1)  # starts that make a window of 2^k tokens
    for k in range(LEAST_POWER, window.bit_length() - 1):
        i = np.searchsorted(place, place - (1 << k))
        for j in np.flatnonzero(place[np.minimum(i, m)] == place - (1 << k)).tolist():
            exact[j] += (int(i[j]),)
    pos, pen = place.tolist(), [0, *(penalty + SEQUENCE_COST).tolist()]
    best, came, value = [0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    queue: deque[int] = deque()  # starts by ascending value = best + position
    for j in range(1, m + 1):
        new = value[j - 1]
        while queue and value[queue[-1]] >= new:
            queue.pop()
        queue.append(j - 1)
        p = pos[j]
        while pos[queue[0]] < p - window:
            queue.popleft()
        source = queue[0]
        least = value[source] + window - p
        for i in exact[j]:
            if best[i] <= least:
                least, source = best[i], i
        best[j] = least = least + pen[j]
        value[j], came[j] = least + p, source
    cuts, j = [], m
    while j > 0:
        cuts.append(pos[j])
        j = came[j]
    return cuts[::-1]


def split_tail(length: int, window: int = WINDOW) -> list[int]:
    """Cut positions that leave no padding: full windows, then powers of two."""
    cuts, at = [], 0
    while at < length:
        at += min(window, 1 << ((length - at).bit_length() - 1))
        cuts.append(at)
    return cuts


class _Stream:
    """Tokens not yet emitted and the documents they belong to."""

    def __init__(self, window: int, ends_sentence: np.ndarray, first_sequence: int):
        self.window, self.ends_sentence, self.sequence = window, ends_sentence, first_sequence
        self.ids = np.empty(0, dtype="<u4")
        self.parts: list[tuple] = []  # (doc_id, tokens of it before, tokens here, tokens of it in all)
        self.fresh: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.fresh.append(ids)
        self.parts.append((doc_id, 0, len(ids), len(ids)))
        self.size += len(ids)

    def solve(self, last: bool) -> list[tuple]:
        self.ids = np.concatenate([self.ids, *self.fresh])
        self.fresh = []
        if not len(self.ids):
            return []
        ends = np.cumsum([p[2] for p in self.parts])
        at, penalty = cut_candidates(self.ids, ends, self.ends_sentence)
        cuts = best_windows(at, penalty, self.window)
        keep = cuts[-2] if len(cuts) > 1 else 0  # the window open at the end
        cuts = cuts[:-1]
        if last:
            cuts += [keep + c for c in split_tail(len(self.ids) - keep, self.window)]
        return self._emit(cuts)

    def _emit(self, cuts: list[int]) -> list[tuple]:
        rows, at, k = [], 0, 0
        parts = self.parts
        doc_id, before, here, total = parts[0] if parts else (None, 0, 0, 0)
        for cut in cuts:
            offset = 0
            while at < cut:
                take = min(here, cut - at)
                rows.append((doc_id, before, take, zlib.crc32(self.ids[at:at + take].tobytes()), total, self.sequence, offset))
                at, offset, before, here = at + take, offset + take, before + take, here - take
                if here == 0:
                    k += 1
                    if k < len(parts):
                        doc_id, before, here, total = parts[k]
            self.sequence += 1
        self.ids = self.ids[at:].copy()
        self.parts = [(doc_id, before, here, total), *parts[k + 1:]] if k < len(parts) else []
        self.size = len(self.ids)
        return rows


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece (columns of SCHEMA).  ``tokenizer``: path of a tokenizers file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        stream = _Stream(window, enc.ends_sentence(), TaskContext.get().partitionId() << 40)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 500):
                for doc_id, raw in zip(ids[at:at + 500], enc.encode(texts.slice(at, 500).to_pylist()), strict=True):
                    stream.add(doc_id, np.frombuffer(raw + end, dtype="<u4"))
                    if stream.size >= BLOCK:
                        yield _to_batch(stream.solve(last=False))
        yield _to_batch(stream.solve(last=True))

    ship(docs.sparkSession)
    return documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
