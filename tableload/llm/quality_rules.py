"""Operator 6, quality rules: a threshold table compiled into one projection.

``measured`` counts, ``RULES`` holds the thresholds, ``kept`` compiles the table into one
boolean column.  Everything is a built-in expression over one row:
no shuffle, no user function, whole texts.

Defined results: a null or empty text has no words and fails the base rule; lines
without a word never count as duplicates; repeated rows are judged one by one;
other columns of the input are left out of ``quality_rules`` and kept by
``keep_quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.llm.text import BLANKS, documents, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she "
    "that the their they this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous ou par pas pour que "
    "qui sa se ses son sont sur un une vous "
    "als am auch auf aus bei das dass dem den der die ein eine einem einen einer es hat ich im ist mit "
    "nach nicht noch oder sich sie sind und vom von war wie zu zum zur "
    "al como con del el ella esta ha han las lo los no para pero por sin su sus una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``100 * part`` against ``percent * whole``, from ``min_words`` words on."""

    part: str
    whole: str
    percent: int
    at_most: bool
    min_words: int = 0

    def passes(self, m: Column) -> Column:
        part, limit = 100 * m[self.part], self.percent * m[self.whole]
        return (m["n_words"] < self.min_words) | (part <= limit if self.at_most else part >= limit)

    def sql(self) -> str:
        return f"(n_words < {self.min_words} OR 100 * {self.part} {'<=' if self.at_most else '>='} {self.percent} * {self.whole})"


RULES = (
    Rule("n_symbols", "n_words", 30, at_most=True),
    Rule("word_chars", "n_words", 200, at_most=False),
    Rule("word_chars", "n_words", 2500, at_most=True),
    Rule("n_stop_words", "n_words", 3, at_most=False, min_words=60),
    Rule("n_dup_lines", "n_lines", 50, at_most=True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _removed(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeat_words(ws: Column) -> Column:
    """Words covered by a window of WINDOW words that occurs twice or more in the array."""
    starts = F.when(F.size(ws) >= WINDOW, F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>"))
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(ws, i, WINDOW)).alias("h"),
                                                                  i.alias("i"))))
    twice = lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    covered = lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return let(let(windows, twice), covered)


def measured(text: Column) -> Column:
    """The COUNTS of a non-null text, as one struct of longs."""
    def counts(b: Column) -> Column:
        t, ws, lines = b["t"], b["w"], b["l"]
        found = {
            "n_words": F.size(ws),
            "word_chars": _removed(t, BLANKS),
            "n_symbols": F.length(t) - _removed(t, SYMBOLS),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeat_words(ws),
            "n_lines": F.size(lines),
            "n_stop_words": F.size(F.filter(ws, lambda x: F.lower(x).isin(STOP_WORDS))),
        }
        return F.struct(*[found[k].cast("long").alias(k) for k in COUNTS])

    lines = F.filter(F.split(text, "\n", -1), lambda x: _removed(x, BLANKS) > 0)
    return let(F.struct(text.alias("t"), words(text).alias("w"), lines.alias("l")), counts)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def kept(m: Column) -> Column:
    """The compiled threshold table over a struct of counts."""
    verdict = ~base_failed(m)
    for rule in RULES:
        verdict = verdict & rule.passes(m)
    return verdict


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``kept``."""
    counted = documents(docs, "doc_id", "text").select("doc_id", measured(F.col("text")).alias("m"))
    m = F.col("m")
    return counted.select("doc_id", *[m[k].alias(k) for k in COUNTS], base_failed(m).alias("base_failed"), kept(m).alias("kept"))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    return docs.filter(let(measured(F.coalesce(docs["text"], F.lit(""))), kept))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d
), win AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS j FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ws, lambda x: lower(x) IN ({', '.join(f"'{x}'" for x in STOP_WORDS)}))) AS BIGINT) AS n_stop_words
  FROM w LEFT JOIN rep USING (r)
), j AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND {' AND '.join(r.sql() for r in RULES)} AS kept FROM j
"""
