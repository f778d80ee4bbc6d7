"""Operator 8, mixing sources to target weights, with DataFrame functions only.

Sources in code point order (null last) weigh 1, 2, 3, 1, 2, ... and share the sum
of all sizes.  No target exceeds ``max_repeat`` times its source's size; what is cut
off goes to the others by weight until none is above (``source_targets`` finds that
level in closed form).  Within a source, documents are ordered by a hash-random key.
The key space is split into ranges, so the prefix sum of sizes is a window inside
each (source, range) plus a prefix sum over the range totals: no task holds a whole
source.  A document is taken as often as whole epochs fit the budget, and the rest
of the budget is cut from the front of the order, inside the last document if need be.

The key is made of id and text, and rows equal in id, source and text are counted before
anything is shuffled: they are one entry with a number of copies, so null or repeated
ids and copies without end never meet in one window.

Defined results: a null text has size 0 and is never taken; a source without words
has target 0; null is a source of its own; copies of a row share their entry's budget in
turn, whole documents first; an empty table gives no rows; other columns, of any type and
name, are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableload.llm.text import documents, words

MAX_REPEAT = 3
SEED = "mix"
KEY_DIGITS = 3  # leading hex digits of the key that name its range: 16^3 ranges in each source


def _key(doc_id: Column, text_hash: Column) -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text_hash))


def _named(value: Column) -> Column:
    """A value as text that is never null, so that plain equality tells null from all else."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target): one row per source, from entries (source, size, copies).
    The windows below see one row per source, never documents."""
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", (F.row_number().over(named) - 1) % 3 + 1)
    cap = max_repeat * F.col("source_size")
    tight = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(tight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(tight.rowsBetween(0, Window.unboundedFollowing))
    level = weighed.withColumn("__all", F.sum("source_size").over(Window.partitionBy())).withColumn(
        "__level", (F.col("__all") - before).cast("double") / weights)
    top = F.max("__level").over(Window.partitionBy())
    return level.withColumn("__top", top).select(
        "source", "source_size", F.least(cap.cast("double"), F.col("__top") * F.col("weight")).alias("target"))


def _placed(entries: DataFrame, max_repeat: int, key_digits: int) -> DataFrame:
    """Entries (doc_id, source, size, text_hash, told, copies) with source_size, target, epochs and ``words``, what the
    copies of the entry take together beyond whole epochs."""
    weight = F.col("size") * F.col("copies")
    keyed = entries.withColumn("__k", _key(F.col("doc_id"), F.col("text_hash"))).withColumn(
        "__range", F.substring("__k", 1, key_digits)).withColumn("__s", F.coalesce("source", F.lit(""))).withColumn(
        "__null", F.col("source").isNull())
    group = ["__s", "__null", "__range"]
    totals = keyed.groupBy(*group).agg(F.sum(weight).alias("__sum"))
    over_ranges = Window.partitionBy("__s", "__null").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, F.coalesce(F.sum("__sum").over(over_ranges), F.lit(0)).alias("__offset"))
    targets = source_targets(entries, max_repeat).select(
        F.coalesce("source", F.lit("")).alias("__s"), F.col("source").isNull().alias("__null"), "source_size", "target")
    in_range = Window.partitionBy(*group).orderBy("__k", "doc_id", "size", "told").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("__before", F.coalesce(F.sum(weight).over(in_range), F.lit(0)))
    joined = placed.join(offsets, group).join(targets, ["__s", "__null"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("__offset") - F.col("__before")
    return joined.withColumn("epochs", epochs).withColumn("words", F.greatest(F.lit(0), F.least(weight, rest))).select(
        *entries.columns, "source_size", "target", "epochs", "words")


def _part(turn: Column) -> Column:
    """Words that the ``turn``-th copy takes of its entry's."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("words") - (turn - 1) * F.col("size")))


def mix(docs: DataFrame, max_repeat: int = MAX_REPEAT, key_digits: int = KEY_DIGITS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs
    (whole times the document is taken) and part (words of one more, partial, time)."""
    entries = documents(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), F.md5("text").alias("text_hash"))
    entries = entries.groupBy("doc_id", "source", "size", "text_hash").agg(
        F.count(F.lit(1)).alias("copies")).withColumn("told", F.lit(0))
    rows = _placed(entries, max_repeat, key_digits).withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.withColumn("part", _part(F.col("__turn"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("epochs") + F.col("part")).alias("taken"),
        "epochs", "part")


def row_hash(docs: DataFrame, columns: list[str]) -> Column:
    """Hash of the named columns, of any type (maps and variants as JSON)."""
    def plain(c: str) -> Column:
        kind = dict(docs.dtypes)[c]
        return F.to_json(F.struct(docs[c].alias("v"))) if "map<" in kind or "variant" in kind else docs[c]

    return F.xxhash64(*[plain(c) for c in columns]) if columns else F.lit(0).cast("long")


def mixed_documents(docs: DataFrame, max_repeat: int = MAX_REPEAT, key_digits: int = KEY_DIGITS) -> DataFrame:
    """The mix as documents: each taken whole as often as its epochs say, and once more
    up to its last taken word where the budget ends inside it.  Rows equal in every column are one
    entry with copies before the texts are shuffled; the copies use up their common part in turn."""
    columns = docs.columns
    text = F.coalesce(docs["text"], F.lit(""))
    held = docs.select(
        docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), F.size(words(text)).cast("long").alias("size"),
        F.md5(text).alias("text_hash"), row_hash(docs, [c for c in columns if c not in ("doc_id", "source", "text")]).alias("told"),
        F.struct(*[docs[c] for c in columns]).alias("__row"))
    keys = ["doc_id", "source", "size", "text_hash", "told"]
    entries = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    named = [_named(F.col("doc_id")).alias("__id"), _named(F.col("source")).alias("__source"), F.col("size").alias("__n"),
             F.col("text_hash").alias("__h"), F.col("told").alias("__told")]
    taken = _placed(entries, max_repeat, key_digits).filter((F.col("epochs") > 0) & (F.col("size") > 0) | (F.col("words") > 0)).select(
        *named, "size", "epochs", "words", "copies")
    rows = held.select(*named, "__row").groupBy("__id", "__source", "__n", "__h", "__told").agg(F.any_value("__row").alias("__row"))
    both = rows.join(taken, ["__id", "__source", "__n", "__h", "__told"]).withColumn(
        "__turn", F.explode(F.sequence(F.lit(1), F.col("copies")))).withColumn("__part", _part(F.col("__turn")).cast("int"))
    whole = F.col("__row")["text"]
    ends = F.split(whole, "(?<=[^ \t-\r])(?=[ \t-\r])", -1)  # one piece per word, blanks in front
    cut = F.when(F.col("__part") > 0, F.array(F.array_join(F.slice(ends, F.lit(1), F.col("__part")), ""))).otherwise(
        F.array().cast("array<string>"))
    texts = F.concat(F.array_repeat(whole, F.col("epochs").cast("int")), cut)
    return both.select("__row", F.explode(texts).alias("__t")).select(
        *[(F.col("__t") if c == "text" else F.length("__t").cast("long") if c == "n_chars" else F.col("__row")[c]).alias(c)
          for c in columns])


SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum({MAX_REPEAT} * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW o AS (ORDER BY CAST({MAX_REPEAT} * source_size AS DOUBLE) / weight, source ASC NULLS LAST)
), t AS (
  SELECT source, source_size, least(CAST({MAX_REPEAT} * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM l
), p AS (
  SELECT d.*, source_size, target, CAST(round(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p
), c AS (
  SELECT *, greatest(0, least(size, budget - epochs * source_size - before)) AS part FROM e
)
SELECT doc_id, source, size, source_size, target, CAST(size * epochs + part AS BIGINT) AS taken,
       CAST(epochs AS BIGINT) AS epochs, CAST(part AS BIGINT) AS part FROM c
"""
