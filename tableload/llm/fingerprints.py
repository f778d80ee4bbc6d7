"""Operator 5, document fingerprints: a threshold-scaled sketch, DataFrame functions only.

A document's shingles are its runs of five words (fewer words: the whole sequence).
Its sketch keeps every 32-bit shingle hash below a fixed fraction of the hash space,
so sizes of intersections scale with the texts, however unequal.  If no hash falls below the
threshold, the smallest one is kept.  ``merge`` makes of two sketches exactly the sketch of both sets of
shingles together: a hash kept for want of a lower one goes when a lower one is there.
``containment`` (shared share of the smaller sketch) and ``resemblance`` compare two.

``fingerprint_edits`` also fingerprints each document's edited text, which ends with the
front of the next document in descending id order (after the last: the first).  Rows
equal in id and text are one row with a number of copies until the end: each copy but the
last is followed by its equal.  The order comes from a range partitioning of ids and text
hashes; only these and lengths pass through it.  Texts are shuffled once, by id, text hash
and length, and the needed front parts once more, so rows that share an id (or have none)
are spread by their texts and meet one row each.

Defined results: a null text is empty; texts without words have an empty sketch, and two
empty sketches are alike (1.0); rows that share an id follow each other by text hash
(64 bits, with the length taken for the text's identity within an id); null ids come last; a single row is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.text import documents, let, words
from tableload.session import shared_dir

SHINGLE = 5
FRACTION = 4  # one in FRACTION hashes is kept
_LOWEST = -(1 << 31)
_NO_ID = -(1 << 63)  # stands for a null id: last in descending order


_THRESHOLD = _LOWEST + (1 << 32) // FRACTION


def _kept(hashes: Column) -> Column:
    return let(F.filter(hashes, lambda x: x < _THRESHOLD), lambda low: F.when(
        F.size(low) > 0, F.array_sort(F.array_distinct(low))).when(
        F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<int>")))


def sketch(text: Column) -> Column:
    """Sorted distinct kept shingle hashes of a text, as array<int>."""
    shingles = lambda w: F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))), lambda i: F.hash(F.slice(w, i, SHINGLE)))
    ).when(F.size(w) > 0, F.array(F.hash(w))).otherwise(F.array().cast("array<int>"))
    return let(let(words(text), shingles), _kept)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two sketches' sets of shingles together; any order of merges gives the same."""
    return let(F.concat(a, b), _kept)


def as_text(kept: Column) -> Column:
    """A sketch as text: eight hex digits per hash, ascending."""
    return F.array_join(F.transform(kept, lambda x: F.lpad(F.hex(x.cast("long") - _LOWEST), 8, "0")), "")


def containment(a: Column, b: Column) -> Column:
    """Shared hashes over the smaller sketch; 1 for two empty sketches, 0 for one."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(smaller == 0, 0.0).otherwise(
        F.size(F.array_intersect(a, b)) / smaller)


def resemblance(a: Column, b: Column) -> Column:
    """Shared hashes over the union of two sketches."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        let(shared, lambda x: x / (F.size(a) + F.size(b) - x)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every document."""
    return documents(docs, "doc_id", "text").select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), as_text(sketch(F.col("text"))).alias("fingerprint"))


def _followers(ids: DataFrame, partitions: int) -> DataFrame:
    """For each text of an id (key, h, n): the one it follows in descending order of ids,
    as ``prev``; the last one precedes the first."""
    ranged = ids.repartitionByRange(partitions, F.col("key").desc(), "h", "n").withColumn("part", F.spark_partition_id()).checkpoint()
    order = Window.partitionBy("part").orderBy(F.col("key").desc(), "h", "n")
    me = F.struct("key", "h", "n")
    rows = ranged.withColumn("me", me).withColumn("prev", F.lag("me").over(order)).withColumn(
        "end", F.when(F.lead("me").over(order).isNull(), F.col("me")))
    ends = rows.filter("end is not null").select("part", "end")  # one row per partition
    by_part = Window.orderBy("part")
    all_parts = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fronts = ends.select(F.col("part"), F.coalesce(F.lag("end").over(by_part), F.last("end").over(all_parts)).alias("front"))
    return rows.join(F.broadcast(fronts), "part").select("key", "h", "n", F.coalesce("prev", "front").alias("prev"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and the resemblances resembles_edited and resembles_next."""
    spark = docs.sparkSession
    shared_dir(spark)
    base = documents(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), "text", F.xxhash64("text").alias("h"),
        F.length("text").alias("n"))
    told = ["key", "h", "n"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = _followers(base.select(*told).dropDuplicates(), partitions)
    # both uses of the texts read the same columns, so that they share one exchange
    rows = base.groupBy(*told).agg(F.first("text").alias("text"), F.count("*").alias("copies")) \
        .filter("copies > 0")  # always so; keeps the column, else the uses would differ
    donors = rows.join(links, told).select(
        F.col("prev.key").alias("key"), F.col("prev.h").alias("h"), F.col("prev.n").alias("n"),
        F.substring("text", F.lit(1), F.floor(F.col("prev.n") / 3).cast("int")).alias("front"),
        sketch(F.col("text")).alias("next_sketch"))
    # the last copy is followed by another text, the others by their equal
    third = F.floor(F.col("n") / 3).cast("int")
    last = F.struct(F.lit(1).cast("long").alias("times"), F.col("front"), F.col("next_sketch"))
    equal = F.struct((F.col("copies") - 1).alias("times"), F.substring("text", F.lit(1), third).alias("front"),
                     sketch(F.col("text")).alias("next_sketch"))
    pairs = rows.join(donors, told).select("key", "text", F.explode(
        F.when(F.col("copies") > 1, F.array(last, equal)).otherwise(F.array(last))).alias("next")).select(
        "key", "text", "next.times", "next.front", "next.next_sketch")
    own = F.when(F.col("key") != _NO_ID, F.col("key"))
    n = F.length("text")
    edited = pairs.select(own.alias("doc_id"), n.alias("n"), "text", "times", "next_sketch", F.concat(
        F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), "front").alias("edited"))
    sketched = edited.select(
        "doc_id", "times", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("a"), sketch(F.col("edited")).alias("b"), F.col("next_sketch").alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    found = sketched.select(
        "doc_id", "times", "n_chars", "edited_sha256", as_text(a).alias("fingerprint"), as_text(b).alias("edited_fingerprint"),
        containment(a, b).alias("near_edited"), containment(a, c).alias("near_next"),
        resemblance(a, b).alias("resembles_edited"), resemblance(a, c).alias("resembles_next"))
    return found.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).drop("copy", "times")
