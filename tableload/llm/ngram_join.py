"""Operator 2, n-gram Jaccard join: T-occurrence search with DivideSkip.

Two documents link when their sets of word 3-grams (64-bit hashes) have a Jaccard
similarity of at least ``percent``/100.  A set of n grams needs T = ceil(percent * n / 100)
of its grams in any partner.

1. Equal sets form a class (grouped by a 128-bit digest); one member stands for it.
2. A gram that only one class has can not be shared.  Grams below a fraction of the hash
   space (somewhat more than a partner may lack, by set size) are counted for all documents;
   a class with more than n - T single ones has no partner and is done.  Few classes besides
   true relatives remain.
3. Only texts of the remaining classes' representatives cross an exchange: a bitmap of their
   row codes, bounded in size, turns the other rows away before it, and the join behind it is
   exact.  The exchange deals by that code, which names the class from here on; the sets are
   written from it once, in buckets of the code, so that no search shuffles
   them by it again.  Each class posts the n - T + 1 first grams of a
   global order (grams below a fraction by frequency, then the others): two linked sets share a
   posted gram.  A gram with a frequency of one takes its place in that order, but links
   nothing and is not sent.  Each inverted list links its classes to its least class, and the
   components of these links are *families*: no link leaves a family.
4. A family is searched by T-occurrence: for each set, the lists of its grams are split
   DivideSkip-wise, the short ones heap-merged for candidates found T - L times, the L
   long ones binary-probed for the candidates only.  Candidates already connected to
   the set are skipped, so copies in the thousands cost one pass and no pairs.
   Families are dealt into chunks of bounded size; chunks exchange the leaders of their
   components until no more merge, and what then still differs in a family of several
   chunks is searched chunk against chunk.  Large families are dealt by set size: the sizes of
   linked sets differ by a tenth at most, so a chunk meets only those of its own and the
   neighbouring size levels.

Defined results: documents without words (or text) have an empty set, link with nothing
and are their own component; fewer words than three make one gram; ids may repeat (each
row is classed by its own text, and its component id is the least doc_id reached); null
ids are not counted as least while another id is reached; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.components import connected_components
from tableload.llm.ship import ship
from tableload.llm.text import WordHash, documents, mix64, rolling, words
from tableload.session import scratch_path

GRAM = 3
PERCENT = 90
SPREAD = 1.2             # how far the counted fraction exceeds the least that could suffice
CHUNK_GRAMS = 1_000_000  # grams of one search group
MARKS = 1 << 26          # bits of the bitmap at most
BUCKET = 1 << 15         # bits of one of Spark's bitmaps
_LOW_BATCH = 2000
_NO_ID = -(1 << 63)
_HASHES = WordHash()


def gram_set(text: str | None, k: int = GRAM) -> np.ndarray:
    """Sorted distinct gram hashes of a text, ASCII letters in lower case."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = _HASHES.of(found)
    if len(hashes) < k:  # the whole sequence, told apart from grams by its length
        return mix64(rolling(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(rolling(hashes, k))


def _needed(n, percent: int):
    return (percent * n + 99) // 100


def _digest(grams: np.ndarray) -> tuple[int, bytes]:
    raw = xxhash.xxh3_128_digest(grams.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), raw


def _counted(n, percent: int, spread: float):
    """Fraction of the hash space whose grams decide whether a set of ``n`` grams is done:
    the share it may miss in a partner, with room for chance, more in small sets."""
    return np.minimum(1.0, 1.08 * (100 - percent) / 100 + spread / np.sqrt(np.maximum(n, 1)))


def _measure(k: int, percent: int, spread: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per row: the class, the set's size, the grams it reports for counting and how many
    of them decide about itself.  A partner of a set of n grams has at most 100 n / percent,
    so a set reports what the smallest of its partners needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _LOW_BATCH):
                part = batch.slice(at, _LOW_BATCH)
                keys, wholes, sizes, low, own = [], [], [], [], []
                for text in part.column(2).to_pylist():
                    grams = gram_set(text, k)
                    key, whole = _digest(grams)
                    keys.append(key)
                    wholes.append(whole)
                    sizes.append(len(grams))
                    reach = _counted(percent * len(grams) // 100, percent, spread)
                    low.append(grams[:_below(grams, reach)].view(np.int64))
                    own.append(_below(grams, _counted(len(grams), percent, spread)))
                ends = np.cumsum([0, *map(len, low)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(low)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(keys, pa.int64()), pa.array(wholes, pa.binary()),
                     pa.array(sizes, pa.int64()), lists, pa.array(own, pa.int32())],
                    names=["id", "th", "key", "whole", "n", "low", "own"])
    return run


def _below(grams: np.ndarray, fraction: float) -> int:
    """How many of the sorted grams lie in the first ``fraction`` of the hash space."""
    return len(grams) if fraction >= 1 else int(np.searchsorted(grams, np.uint64(int(fraction * 2**64))))


def _sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _LOW_BATCH):
                part = batch.slice(at, _LOW_BATCH)
                sets = [gram_set(t, k).view(np.int64) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], names=["key", "n", "grams"])
    return run


def _marked(rows: DataFrame, codes: DataFrame, n_codes: int, limit: int) -> DataFrame:
    """``rows`` (with a column ``code``) without nearly all whose code is not in ``codes``: none that is there goes.
    Every code sets three bits in one bucket of a broadcast bitmap, which has 16 to 32 bits for each of the ``n_codes``
    codes and ``limit`` bits at most (a bucket at least)."""
    buckets = max(1, min(limit, 1 << (4 + n_codes.bit_length())) // BUCKET)
    bucket = F.pmod("code", F.lit(buckets)).alias("bucket")
    places = [F.pmod(F.xxhash64("code", F.lit(i)), F.lit(BUCKET)).cast("int") for i in range(3)]
    marks = codes.select(bucket, F.explode(F.array(*places)).alias("at")).groupBy("bucket").agg(
        F.bitmap_construct_agg(F.col("at").cast("long")).alias("marks"))

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring("marks", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(at, F.lit(8))) == 1

    return rows.select("*", bucket).join(F.broadcast(marks), "bucket") \
        .filter(is_set(places[0]) & is_set(places[1]) & is_set(places[2])).drop("bucket", "marks")


def _by_key(sets: DataFrame, path: str) -> DataFrame:
    """``sets``, dealt by ``key``, written to ``path`` in buckets of it, and read back: joins on the key deal the other
    side only.  Its table leaves the session's catalog at once; the files stay."""
    spark, table = sets.sparkSession, f"ngram_sets_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets.write.format("parquet").bucketBy(n, "key").option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


class Search:
    """T-occurrence search in one group of sets, with the components found so far."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, grams: np.ndarray, labels: np.ndarray, percent: int):
        order = np.lexsort((keys, sizes))
        ends = np.cumsum(sizes)
        self.keys, self.sizes, self.percent = keys[order], sizes[order], percent
        _, self.labels = np.unique(labels[order], return_inverse=True)
        place = np.empty(len(keys), dtype=np.int64)
        place[order] = np.arange(len(keys))
        # inverted lists: members ascending, and with them set sizes
        owner = np.repeat(place, sizes)
        by = np.lexsort((owner, grams))
        starts = np.flatnonzero(np.concatenate(([True], grams[by][1:] != grams[by][:-1])))
        self.lists = owner[by]
        self.bounds = np.append(starts, len(by))
        name = np.empty(len(by), dtype=np.int64)
        name[by] = np.repeat(np.arange(len(starts)), np.diff(self.bounds))
        self.names = [name[e - s:e] for e, s in zip(ends[order].tolist(), self.sizes.tolist(), strict=True)]

    def _merge(self, short: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that occur at least ``least`` times in the sorted short lists, and how often."""
        total = sum(map(len, short))
        if total <= 512:  # a heap over the list heads
            found, counts = [], []
            for x in heapq.merge(*[s.tolist() for s in short]):
                if found and found[-1] == x:
                    counts[-1] += 1
                else:
                    found.append(x)
                    counts.append(1)
            members, times = np.array(found, dtype=np.int64), np.array(counts, dtype=np.int64)
        else:  # the same merge, vectorised
            members, times = np.unique(np.concatenate(short), return_counts=True)
        enough = times >= least
        return members[enough], times[enough]

    def _query(self, r: int) -> None:
        n, mine = int(self.sizes[r]), self.labels[r]
        need = int(_needed(n, self.percent))
        lo = int(np.searchsorted(self.sizes, need))  # a partner has at least so many grams
        if lo >= r or (self.labels[lo:r] == mine).all():
            return
        spans = [(int(self.bounds[t]), int(self.bounds[t + 1])) for t in self.names[r].tolist()]
        lists = sorted((self.lists[a:b] for a, b in spans if b - a > 1), key=len)
        if len(lists) < need:
            return
        longest = len(lists[-1])
        # DivideSkip's balance between merging and probing
        skip = min(need - 1, len(lists), int(need / (0.05 * np.log2(longest + 1) + 1)))
        short, long = lists[:len(lists) - skip], lists[len(lists) - skip:]
        short = [s[np.searchsorted(s, lo):np.searchsorted(s, r)] for s in short]
        short = [s[self.labels[s] != mine] for s in short]
        members, times = self._merge([s for s in short if len(s)], need - skip) if any(map(len, short)) else (None, None)
        if members is None or not len(members):
            return
        for k, probed in enumerate(long):
            at = np.searchsorted(probed, members)
            at[at == len(probed)] = 0
            times = times + (probed[at] == members)
            if k % 8 == 7:
                keep = times + (len(long) - 1 - k) >= need
                members, times = members[keep], times[keep]
                if not len(members):
                    return
        linked = 100 * times >= self.percent * (n + self.sizes[members] - times)
        for label in np.unique(self.labels[members[linked]]).tolist():
            self.labels[self.labels == label] = mine

    def run(self) -> np.ndarray:
        """The least key of each member's component, in the order of ``self.keys``."""
        for r in range(len(self.keys)):
            self._query(r)
        least = np.full(int(self.labels.max(initial=0)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, self.labels, self.keys)
        return least[self.labels]


def _search(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = lambda c: table.column(c).to_numpy()
        grams = table.column("grams").combine_chunks()
        search = Search(column("key"), column("n"), grams.flatten().to_numpy(), column("comp"), percent)
        labels = column("comp")
        found = search.run()
        old = dict(zip(column("key").tolist(), labels.tolist(), strict=True))
        pairs = {(old[k], old.get(root, root)) for k, root in zip(search.keys.tolist(), found.tolist(), strict=True)}
        return pa.table({"u": pa.array([u for u, _ in pairs], pa.int64()), "v": pa.array([v for _, v in pairs], pa.int64())})
    return run


def _level(n: Column, percent: int) -> Column:
    """Size levels: the sizes of two linked sets lie in one level or in neighbouring ones."""
    if percent >= 100:
        return n.cast("int")
    step = math.log(100 / percent) * (1 + 1e-6)  # rounding never puts a partner two levels away
    return F.floor(F.log(n) / F.lit(step)).cast("int")


def _loads(members: DataFrame, chunk_grams: int, percent: int) -> DataFrame:
    """(fam, level, chunks): into how many chunks the sets of a family's size level are dealt.  A
    family that fits one chunk is one level."""
    levels = members.groupBy("fam", _level(F.col("n"), percent).alias("size_level")).agg(F.sum("n").alias("load"))
    whole = levels.groupBy("fam").agg((F.sum("load") < chunk_grams).alias("small"))
    chunks = (F.floor(F.col("load") / chunk_grams) + 1).cast("int")
    return levels.join(whole, "fam").select(
        "fam", "size_level", F.when(F.col("small"), F.lit(None)).otherwise(F.col("size_level")).cast("int").alias("level"),
        F.when(F.col("small"), 1).otherwise(chunks).alias("chunks"))


def _dealt(members: DataFrame, loads: DataFrame, percent: int) -> DataFrame:
    """Plus ``level`` (null in families of one chunk) and ``chunk``: members dealt into bounded groups."""
    placed = members.withColumn("size_level", _level(F.col("n"), percent)).join(loads, ["fam", "size_level"])
    return placed.withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")).drop("size_level", "chunks")


def _dealt_anew(loads: DataFrame, before: DataFrame) -> DataFrame:
    """Size levels whose number of chunks has changed: leaders of the others stay with leaders they were searched with."""
    a, b = loads.alias("a"), before.alias("b")
    return a.join(b, (F.col("a.fam") == F.col("b.fam")) & (F.col("a.size_level") == F.col("b.size_level"))
                  & F.col("a.level").eqNullSafe(F.col("b.level")) & (F.col("a.chunks") == F.col("b.chunks")), "left_anti")


def _facing(held: DataFrame, loads: DataFrame, percent: int) -> DataFrame:
    """Members (key, n, comp, fam, level, chunk) once for every chunk they have to meet: the others of their level
    and those of the neighbouring levels, unless such a chunk is wholly of the member's component or has
    no set of a size that can be linked with the member's."""
    per_level = loads.filter("level IS NOT NULL").select("fam", "level", "chunks")
    beside = per_level
    for name, step in (("above", 1), ("below", -1)):
        beside = beside.join(per_level.select("fam", (F.col("level") - step).alias("level"), F.col("chunks").alias(name)),
                             ["fam", "level"], "left")

    def chunks_of(step: int, name: str) -> Column:
        count = F.coalesce(F.col(name), F.lit(0))
        numbers = F.filter(F.sequence(F.lit(0), count), lambda c: c < count)
        return F.transform(numbers, lambda c: F.struct((F.col("level") + step).alias("level"), c.cast("int").alias("chunk")))

    met = [chunks_of(0, "chunks"), chunks_of(1, "above"), chunks_of(-1, "below")]
    own = F.struct("level", "chunk")
    pairs = held.join(beside, ["fam", "level"]).select(
        "key", "n", "comp", "fam", own.alias("own"), F.explode(F.concat(*met)).alias("other")).filter("own <> other")
    one = held.groupBy("fam", F.struct("level", "chunk").alias("other")).agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (percent * F.col("least") <= 100 * F.col("n")) & (percent * F.col("n") <= 100 * F.col("most"))
    return pairs.join(one, ["fam", "other"]).filter("NOT (lo = hi AND lo = comp)").filter(fits).select(
        "key", "n", "comp", "fam", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))


def _family_components(members: DataFrame, sets: DataFrame, percent: int, chunk_grams: int, folder: str) -> DataFrame:
    """(key, comp) of every member (key, n, fam): components of the links inside families.
    Grams are read from ``sets`` only where a group is searched."""
    def search(light: DataFrame, grams: DataFrame, *by: str) -> DataFrame:
        return light.select("key", "n", "comp", *by).join(grams.select("key", "grams"), "key").groupBy(*by).applyInArrow(
            _search(percent), "u long, v long")

    loads = _loads(members, chunk_grams, percent).checkpoint()
    dealt = _dealt(members, loads, percent).checkpoint()
    first = search(dealt.withColumn("comp", F.col("key")), sets, "fam", "level", "chunk")
    comps = first.select(F.col("u").alias("key"), F.col("v").alias("comp")).checkpoint()
    wide = dealt.filter("level IS NOT NULL").select("key", "n", "fam", "level", "chunk")
    if wide.isEmpty():
        return comps
    # only the sets of families in several chunks are read again, from a table of their own
    several = sets.select("key", "grams").join(wide.select("key"), "key", "left_semi")
    grams = _by_key(several.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key"), f"{folder}/wide")

    def renamed(links: DataFrame) -> DataFrame:
        """Components after the links (u, v), v the root of u, were applied."""
        to = links.select(F.col("u").alias("comp"), F.col("v").alias("root"))
        return comps.join(to, "comp", "left").select("key", F.coalesce("root", "comp").alias("comp")).checkpoint()

    before, dealt_by = None, loads
    while True:  # leaders: one member for each component of a family in several chunks
        leaders = wide.join(comps, "key").filter("key = comp").select("key", "n", "fam", "comp").checkpoint()
        now = leaders.count()
        if now == before:
            break
        before = now
        now_by = _loads(leaders, chunk_grams, percent).checkpoint()
        comps = renamed(search(_dealt(leaders, _dealt_anew(now_by, dealt_by), percent), grams, "fam", "level", "chunk"))
        dealt_by = now_by
    # families still in several components: chunks of neighbouring sizes face each other
    held = wide.join(comps, "key")
    open_fams = held.groupBy("fam").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("fam")
    facing = _facing(held.join(open_fams, "fam").checkpoint(), loads, percent).checkpoint()
    if facing.isEmpty():
        return comps
    # the components read their links more than once
    roots = connected_components(search(facing, grams, "fam", "a", "b").checkpoint())
    return renamed(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))


def ngram_join(docs: DataFrame, k: int = GRAM, percent: int = PERCENT, spread: float = SPREAD,
               chunk_grams: int = CHUNK_GRAMS, marks: int = MARKS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, plus ``component_key`` (null
    without words) and ``text_hash``, which tell rows of one id apart."""
    spark = docs.sparkSession
    ship(spark)
    base = documents(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")
    folder = scratch_path(spark, "ngram-join")
    base.mapInArrow(_measure(k, percent, spread),
                    "id long, th long, key long, whole binary, n long, low array<long>, own int") \
        .write.parquet(f"{folder}/measured")
    measured = spark.read.parquet(f"{folder}/measured")

    light = measured.select("id", "th", "key", "whole", "n")
    classes = light.filter("n > 0").groupBy("key", "whole").agg(
        F.min(F.struct("id", "th")).alias("rep"), F.min(F.when(F.col("id") != _NO_ID, F.col("id"))).alias("least"),
        F.first("n").alias("n"))
    # grams only one class reports, as far as they decide about that class
    reported = measured.select("key", F.posexplode("low").alias("pos", "gram"), "own")
    single = reported.groupBy("gram").agg(
        F.min("key").alias("key"), F.max("key").alias("k2"), F.max(F.col("pos") < F.col("own")).alias("own")) \
        .filter("key = k2 AND own").groupBy("key").agg(F.count("*").alias("single"))
    open_classes = classes.join(single, "key", "left").filter(
        F.coalesce("single", F.lit(0)) <= F.col("n") - F.floor((percent * F.col("n") + 99) / 100)) \
        .select("key", "whole", "least", F.xxhash64("rep.id", "rep.th").alias("code")).checkpoint()
    # texts of the remaining classes' representatives; equal rows of one id are one
    codes = open_classes.select("code")
    texts = _marked(base.select(F.xxhash64("id", "th").alias("code"), "text"), codes, codes.count(), marks) \
        .groupBy("code").agg(F.first("text").alias("text")).join(codes, "code")
    sets = _by_key(texts.mapInArrow(_sets(k), "key long, n long, grams array<long>"), f"{folder}/sets")

    # posted grams: the first of an order by frequency among the remaining sets, for the
    # grams below a fraction, and then the others in hash order
    fraction = min(1.0, 2 * (100 - percent) / 100)
    limit = int(fraction * 2**64)
    low = _is_low(F.col("gram"), limit)
    # a gram is in a set once, so a window holds a row of two numbers for each class at most
    same = Window.partitionBy("gram")
    first = sets.select("key", F.explode("grams").alias("gram")).filter(low)
    posted_low = first.withColumn("df", F.count("*").over(same)).filter("df > 1").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("low"))
    prefix = (F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1).cast("int")
    others = sets.select("key", prefix.alias("p"), F.size(F.filter("grams", lambda g: _is_low(g, limit))).alias("n_low"),
                         F.slice(F.filter("grams", lambda g: ~_is_low(g, limit)), F.lit(1), prefix).alias("rest"))
    shared = F.coalesce(F.transform("low", lambda x: x["gram"]), F.array().cast("array<long>"))
    posted = others.join(posted_low, "key", "left").select(
        "key", F.greatest(F.lit(0), F.col("p") - F.col("n_low") + F.size(shared)).alias("p"), F.concat(shared, "rest").alias("grams")) \
        .select("key", F.explode(F.slice("grams", F.lit(1), F.col("p"))).alias("gram")).checkpoint()
    edges = posted.select(F.col("key").alias("u"), F.min("key").over(same).alias("v")).filter("u <> v").dropDuplicates()
    families = connected_components(edges).select(F.col("node").alias("key"), F.col("root").alias("fam"))
    members = sets.select("key", "n").join(families, "key")
    comps = _family_components(members, sets, percent, chunk_grams, folder)

    met = comps.withColumnRenamed("key", "code").join(open_classes, "code")
    roots = met.groupBy("comp").agg(F.min("key").alias("component_key"), F.min("least").alias("component"))
    reached = met.join(roots, "comp").select("key", "whole", "component_key", "component")
    named = classes.join(reached, ["key", "whole"], "left").select(
        "key", "whole", F.coalesce("component_key", "key").alias("component_key"), F.coalesce("component", "least").alias("component"))
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    return light.join(named, ["key", "whole"], "left").select(
        own.alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(own).alias("component_id"),
        F.when(F.col("n") > 0, F.col("component_key")).alias("component_key"), F.col("th").alias("text_hash"))


def _is_low(gram, limit: int):
    """Whether the gram (stored as a signed number) is below ``limit`` as an unsigned one."""
    if limit >= 2**64:
        return F.lit(True)
    return (gram >= 0) & (gram < limit) if limit < 2**63 else (gram >= 0) | (gram < limit - 2**64)


def keep_one(docs: DataFrame, k: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of least id (of rows that share it, the one of
    least text hash; of equal rows, one).  Documents without words are all kept."""
    joined = ngram_join(docs, k, percent)
    heads = joined.filter("n_shingles > 0").groupBy("component_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("h"))
    heads = heads.select(F.coalesce("h.doc_id", F.lit(_NO_ID)).alias("__id"), F.col("h.text_hash").alias("__th"))
    text = F.coalesce(docs["text"], F.lit(""))
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
                       F.coalesce(docs["doc_id"].cast("long"), F.lit(_NO_ID)).alias("__id"),
                       F.xxhash64(text).alias("__th"), (F.size(words(text)) == 0).alias("__empty"))
    first = Window.partitionBy("__id", "__th").orderBy("__id")
    chosen = held.filter("NOT __empty").join(heads.dropDuplicates(), ["__id", "__th"], "left_semi").withColumn(
        "__n", F.row_number().over(first)).filter("__n = 1").select("__row")
    both = chosen.unionAll(held.filter("__empty").select("__row"))
    return both.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
