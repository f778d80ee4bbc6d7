"""Operator 4, substring dedup: repeated word windows by De Bruijn compaction.

A window is ``window`` (35) consecutive words of one document; every word covered by a
window that also starts anywhere else is removed.

The graph is a sparse De Bruijn graph of words.  Its *nodes* are marked word k-mers (20 of the
35 words of a window): those whose least 4-mer, by hash, is their first or their last.  The mark
depends on the k-mer alone, so equal windows hold equal nodes at equal places, and every
window holds at least one.  An *edge* is the longer k-mer of words from one node of a
document to its next; the two overlap, so both nodes and their distance tell its words.

1. Degrees.  Every chunk of documents reports its nodes with the edge before and the edge
   after (none where a document begins or ends, or where they differ).  Spark brings the
   reports of a node together: how often it occurs (once or more often) and whether it has a
   single edge in and a single edge out.
2. Compaction.  The nodes seen twice are joined back to the documents.  Where the only edge out of a
   node is the only edge into the next, both lie on one nonbranching path.  No occurrence
   of such a path can leave it in between, so each occurrence walks the whole path, and a
   document shows a path from its first to its last node: one join compacts it, however long.
   All windows inside a path repeat, as its nodes do.
3. Verification.  Windows that reach over the end of a path are decided at their source
   coordinates: where all nodes inside repeat, the hash of the window is counted.  Whether a
   window lies inside a path is the same wherever it occurs, so none is missed.

Documents are dealt into chunks of about ``CHUNK_ROWS`` rows or ``CHUNK_BYTES`` by a hash of the row,
and one exchange of the texts serves all three steps.  Rows equal in all columns are one row with a number of
copies before a step gathers them, so that no repeated row makes a chunk large; with two
copies or more, every window of the row repeats.  Chunks report a node once and a window hash once (twice if it repeats
inside the chunk), so a passage that a third of all documents share costs one row per chunk and hash,
and no step gathers more than one chunk or one row per chunk for a hash.

Nodes, edges and windows are known by 64-bit hashes.  A window inside a path rests on nodes and
edges, one across its end on nodes and on its own, other hash: a false match needs two collisions.

Defined results: a null or empty text has no words and keeps none; documents shorter than
a window stay whole; repeated rows are documents of their own, so their windows repeat; an
empty table gives no rows; other columns, of any type, pass through ``remove_repeats`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableload.llm.mixing import row_hash
from tableload.llm.ship import ship
from tableload.llm.text import WordHash, documents, mix64, rolling

WINDOW = 35
PART = 4  # words of the pieces whose least hash marks a k-mer
CHUNK_ROWS = 1000
CHUNK_BYTES = 16 << 20
_HASHES = WordHash()


def node_words(window: int, part: int) -> int:
    """Words of a node: the most for which every window still holds a marked k-mer."""
    if not 0 < part <= window:
        raise ValueError("a window must hold at least one part")
    return (window + 1 + part) // 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


class _Words:
    """Words of a chunk's documents, end to end, and the nodes among them."""

    def __init__(self, table: pa.Table, window: int, part: int):
        self.per_doc = [(t or "").encode().split() for t in table.column("text").to_pylist()]
        self.sizes = np.array([len(w) for w in self.per_doc], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.window = window
        self.copied = table.column("__copies").to_numpy() > 1  # by document
        flat: list[bytes] = [w for doc in self.per_doc for w in doc]
        self.hashes = _HASHES.of(flat)
        self.k = node_words(window, part)
        self.at, self.nodes = self._marked(part)  # places and hashes
        self.doc = np.searchsorted(self.ends, self.at, side="right")
        self.edges = self._edges()  # between each node and the next; 0 between documents

    def starts(self, length: int) -> np.ndarray:
        """Whether ``length`` words of one document that has a window start at each place."""
        ok = np.zeros(max(0, len(self.hashes) - length + 1), dtype=bool)
        for end, size in zip(self.ends.tolist(), self.sizes.tolist(), strict=True):
            if size >= self.window:
                ok[end - size:end - length + 1] = True
        return ok

    def windows(self) -> np.ndarray:
        return rolling(self.hashes, self.window)

    def _marked(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        scrambled = mix64(self.hashes)  # other word hashes than the windows use
        kmers = rolling(scrambled, self.k)
        if not len(kmers):
            return np.empty(0, dtype=np.int64), kmers
        parts, span = rolling(scrambled, part), self.k - part
        least = _least(parts, span + 1)
        marked = (parts[:len(kmers)] == least) | (parts[span:] == least)
        at = np.flatnonzero(marked & self.starts(self.k))
        return at, kmers[at]

    def _edges(self) -> np.ndarray:
        if len(self.at) < 2:
            return np.empty(0, dtype=np.uint64)
        gap = np.diff(self.at).astype(np.uint64)
        with np.errstate(over="ignore"):
            edge = mix64(mix64(self.nodes[:-1]) * np.uint64(3) + mix64(self.nodes[1:] + gap))
        return np.where(self.doc[1:] == self.doc[:-1], np.maximum(edge, np.uint64(1)), np.uint64(0))


def _once_or_twice(hashes: np.ndarray, copied: np.ndarray) -> np.ndarray:
    """Each hash once, and once more if it is there more than once or in a copied row."""
    found, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    np.add.at(counts, at[copied], 1)
    return np.concatenate([found, found[counts > 1]])


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _report_nodes(window: int, part: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes of a chunk, each once: 1 or 2 (or more) occurrences, its edge in and its edge out (0: none or several)."""
    def report(table: pa.Table) -> pa.Table:
        doc_words = _Words(table, window, part)
        nodes = doc_words.nodes
        order = np.argsort(nodes, kind="stable")
        nodes = nodes[order]
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.empty(0, dtype=np.int64)
        none = np.zeros(min(1, len(nodes)), dtype=np.uint64)

        def single(edges: np.ndarray) -> np.ndarray:
            if not len(first):
                return edges
            least, most = np.minimum.reduceat(edges[order], first), np.maximum.reduceat(edges[order], first)
            return np.where(least == most, least, np.uint64(0))

        seen = np.diff(np.append(first, len(nodes)))
        if len(first):
            seen = seen + np.maximum.reduceat(doc_words.copied[doc_words.doc][order].astype(np.int64), first)
        return pa.table({
            "h": _signed(nodes[first]), "edge_in": _signed(single(np.concatenate([none, doc_words.edges]))),
            "edge_out": _signed(single(np.concatenate([doc_words.edges, none]))),
            "seen": pa.array(np.minimum(seen, 2).astype(np.int32)),
            "__chunk": pa.array(np.full(len(first), table.column("__chunk")[0].as_py(), dtype=np.int32))})
    return report


# what a chunk is told of a hash: a repeated node (plus 1: one edge in, plus 2: one edge out) or a repeated window
_NODE, _WINDOW = 0, 4


def _repeated_nodes(reported: DataFrame) -> DataFrame:
    """(h, chunk, kind) of the nodes seen twice or more over all chunks."""
    everywhere = Window.partitionBy("h")

    def single(edge: str):
        return ((F.min(edge).over(everywhere) == F.max(edge).over(everywhere)) & (F.col(edge) != 0)).cast("int")

    return reported.withColumn("__n", F.sum("seen").over(everywhere)).withColumn(
        "kind", F.lit(_NODE) + single("edge_in") + 2 * single("edge_out")).filter("__n > 1").select("h", "__chunk", "kind")


def _repeated_windows(reported: DataFrame) -> DataFrame:
    """(h, chunk, kind) of the windows reported twice or more over all chunks."""
    return reported.withColumn("__n", F.count("*").over(Window.partitionBy("h"))).filter("__n > 1").select(
        "h", "__chunk", F.lit(_WINDOW).alias("kind")).dropDuplicates()


class _Paths:
    """The nonbranching paths of repeated nodes in a chunk, as first and end place, and the windows across their ends."""

    def __init__(self, doc_words: _Words, told: pa.Table):
        kinds = told.column("kind").to_numpy()
        hashes = told.column("h").to_numpy().view(np.uint64)
        self.windows = hashes[kinds == _WINDOW]
        hashes, kinds = hashes[kinds != _WINDOW], kinds[kinds != _WINDOW]
        order = np.argsort(hashes)
        hashes, kinds = hashes[order], kinds[order]
        at, nodes, window, k = doc_words.at, doc_words.nodes, doc_words.window, doc_words.k
        place = np.searchsorted(hashes, nodes)
        known = np.zeros(len(nodes), dtype=bool)
        inside = place < len(hashes)
        known[inside] = hashes[place[inside]] == nodes[inside]
        kind = np.zeros(len(nodes), dtype=np.int64)
        kind[known] = kinds[place[known]]
        linked = (doc_words.edges != 0) & (kind[:-1] & 2 > 0) & (kind[1:] & 1 > 0) if len(nodes) else np.empty(0, dtype=bool)
        begin = known & ~np.append(np.zeros(min(1, len(nodes)), dtype=bool), linked)
        end = known & ~np.append(linked, np.zeros(min(1, len(nodes)), dtype=bool))
        first, last = np.flatnonzero(begin), np.flatnonzero(end)
        long = at[last] + k - at[first] >= window
        self.names = nodes[first[long]]
        self.begins, self.ends = at[first[long]], at[last[long]] + k
        total = len(doc_words.hashes)
        inner = np.zeros(total + 1, dtype=np.int64)
        np.add.at(inner, self.begins, 1)
        np.add.at(inner, self.ends - window + 1, -1)
        unknown = np.zeros(total + 1, dtype=np.int64)
        unknown[at[~known] + 1] = 1
        unknown = np.cumsum(unknown)  # by place: unknown nodes before it
        starts = doc_words.starts(window)
        places = np.flatnonzero(starts & (np.cumsum(inner)[:len(starts)] == 0))
        self.across = places[unknown[places + window - k + 1] == unknown[places]]


def _report_windows(window: int, part: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def report(table: pa.Table, told: pa.Table) -> pa.Table:
        found = np.empty(0, dtype=np.uint64)
        if len(table) and len(told):
            doc_words = _Words(table, window, part)
            across = _Paths(doc_words, told).across
            copied = doc_words.copied[np.searchsorted(doc_words.ends, across, side="right")]
            found = _once_or_twice(doc_words.windows()[across], copied)
        chunk = table.column("__chunk")[0].as_py() if len(table) else 0
        return pa.table({"h": _signed(found), "__chunk": pa.array(np.full(len(found), chunk, dtype=np.int32))})
    return report


def _remove(window: int, part: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        doc_words = _Words(table, window, part)
        total = len(doc_words.hashes)
        cover = np.zeros(total + 1, dtype=np.int64)
        if len(told):
            paths = _Paths(doc_words, told)
            np.add.at(cover, paths.begins, 1)
            np.add.at(cover, paths.ends, -1)
            hit = paths.across[np.isin(doc_words.windows()[paths.across], paths.windows)]
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
        gone = np.cumsum(cover)[:total] > 0
        kept, removed = [], []
        for doc, end, size in zip(doc_words.per_doc, doc_words.ends.tolist(), doc_words.sizes.tolist(), strict=True):
            mask = gone[end - size:end]
            n = int(mask.sum())
            removed.append(n)
            kept.append((b" ".join(doc) if not n else b" ".join([w for w, g in zip(doc, mask.tolist(), strict=True) if not g])).decode())
        out = table.drop_columns(["__chunk"])
        out = out.set_column(out.column_names.index("text"), "text", pa.array(kept, type=pa.string()))
        for name, values in (("__n_words", doc_words.sizes), ("__n_removed", np.array(removed, dtype=np.int64))):
            out = out.append_column(name, pa.array(values))
        return out.append_column("__sha", pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept], type=pa.string()))
    return remove


def _spans(window: int, part: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def spans(table: pa.Table, told: pa.Table) -> pa.Table:
        doc_words = _Words(table, window, part)
        paths = _Paths(doc_words, told)
        doc = np.searchsorted(doc_words.ends, paths.begins, side="right")
        held = table.select(["doc_id", "__copies"]).take(pa.array(doc))
        return held.append_column("start", pa.array(paths.begins - (doc_words.ends - doc_words.sizes)[doc])).append_column(
            "n_words", pa.array(paths.ends - paths.begins)).append_column("path", _signed(paths.names))
    return spans


def _dealt(docs: DataFrame):
    """The rows in chunks, with __copies; equal rows as one."""
    ship(docs.sparkSession)
    rows, size = docs.select(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    chunks = max(rows // CHUNK_ROWS, size // CHUNK_BYTES) + 1
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    keys = ["doc_id", "text", *(["__told"] if others else [])]
    told = docs.withColumn("__told", row_hash(docs, others)) if others else docs
    dealt = told.withColumn("__chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int"))
    # grouped behind the exchange by chunk, which so stays the only one
    return dealt.repartition("__chunk").groupBy(*keys, "__chunk").agg(
        F.count("*").alias("__copies"), *[F.any_value(c).alias(c) for c in others]).drop("__told").groupBy("__chunk")


def _nodes(by_chunk, window: int, part: int) -> DataFrame:
    return _repeated_nodes(by_chunk.applyInArrow(
        _report_nodes(window, part), "h long, edge_in long, edge_out long, seen int, __chunk int"))


def _again(rows: DataFrame) -> DataFrame:
    """Each row as often as it has copies."""
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).drop("__copy", "__copies")


def _dedup(docs: DataFrame, window: int, part: int) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept words joined by one space, plus
    __n_words, __n_removed and __sha."""
    node_words(window, part)
    by_chunk = _dealt(docs)
    nodes = _nodes(by_chunk, window, part)
    windows = _repeated_windows(by_chunk.cogroup(nodes.groupBy("__chunk")).applyInArrow(
        _report_windows(window, part), "h long, __chunk int"))
    others = [docs.schema[c] for c in docs.columns if c not in ("doc_id", "text")]
    schema = T.StructType([docs.schema["doc_id"], docs.schema["text"], T.StructField("__copies", T.LongType()), *others,
                           T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()),
                           T.StructField("__sha", T.StringType())])
    return _again(by_chunk.cogroup(nodes.union(windows).groupBy("__chunk")).applyInArrow(_remove(window, part), schema))


def substring_dedup(docs: DataFrame, window: int = WINDOW, part: int = PART) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return _dedup(documents(docs, "doc_id", "text"), window, part).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
        F.col("__sha").alias("kept_sha256"))


def repeated_paths(docs: DataFrame, window: int = WINDOW, part: int = PART) -> DataFrame:
    """The compacted paths of at least a window, at every place where they occur: doc_id, start (words before it),
    n_words and path (one number for all occurrences).  What repeats across the end of a path is not in it."""
    node_words(window, part)
    held = documents(docs, "doc_id", "text")
    by_chunk = _dealt(held)
    schema = T.StructType([held.schema["doc_id"], T.StructField("__copies", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("path", T.LongType())])
    return _again(by_chunk.cogroup(_nodes(by_chunk, window, part).groupBy("__chunk")).applyInArrow(_spans(window, part), schema))


def remove_repeats(docs: DataFrame, window: int = WINDOW, part: int = PART) -> DataFrame:
    """The documents with the repeated words removed from ``text`` (and ``n_chars``, where
    there is such a column, counted anew).  Documents without a removed word keep their
    text as it was; a document of which nothing is left goes."""
    columns = docs.columns
    held = docs.select("doc_id", "text", F.struct(*[docs[c] for c in columns]).alias("__row"))
    done = _dedup(held, window, part).filter("NOT (__n_removed > 0 AND __n_removed = __n_words)")
    text = F.when(F.col("__n_removed") > 0, F.col("text")).otherwise(F.col("__row")["text"])
    return done.select(*[(text if c == "text" else F.when(F.col("__n_removed") > 0, F.length("text")).otherwise(
        F.col("__row")[c]).cast("long") if c == "n_chars" else F.col("__row")[c]).alias(c) for c in columns])
