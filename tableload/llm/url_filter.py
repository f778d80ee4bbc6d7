"""URL filters: glob rules in one bit-parallel automaton, run over every canonical URL at once.

The canonical URL is a dot, the host (A-Z lower-cased) and the path, so that one pattern covers a host
and its subdomains.  In a glob ``**`` is any run of characters, ``*`` any run without a slash and ``?`` one
character other than a slash; every other character stands for itself.  A rule (host, path) is the glob
``**.host`` + path + ``**``, with ``*`` in place of the first ``**``, which keeps it inside the host.

All globs lie in one row of bits, packed into 64-bit words.  A glob takes a start bit and a bit for each of
its characters; a bit is set while the glob's characters up to there match the URL read so far.  One byte of
the URL moves every glob of every URL of a batch by a shift over the words, a mask of the places that take
that byte, and a mask of the places that a wildcard lets stay.  No rows are shuffled.

Null URLs and URLs without ``://`` have an empty host and path, which only ``**`` meets; so do empty URLs.  Rows
are judged one by one: repeated rows and null ids keep their places, an empty table gives none, and columns
of clashing names are not read.  Very long URLs are read whole: where few URLs are left in a batch, the
same steps run on whole integers, one URL after another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableload.llm.ship import ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEW = 16  # URLs still being read below which each is read by itself


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the URLs of a host and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> list[str]:
        return ["*", *f".{self.host}{self.path}", "**"]


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))
# The method's verdict on URLs that no rule covers: blocked if one of these meets, else allowed.
BLOCKED = ("*.spam-*/**", "*.free-bets.*/**", "*.cheap-pills.*/**", "*.casino-*/**", "*.ads-track.*/**", "*.adult-*/**")


def split_glob(text: str) -> list[str]:
    """The places of a glob: ``**``, ``*``, ``?`` or one character each."""
    out: list[str] = []
    at = 0
    while at < len(text):
        step = 2 if text.startswith("**", at) else 1
        out.append(text[at:at + step])
        at += step
    return out


class Automaton:
    """Several globs as masks over one row of bits; ``places`` are lists as ``split_glob`` gives."""

    def __init__(self, globs: Sequence[Sequence[str]]):
        anything, no_slash = np.ones(256, bool), np.ones(256, bool)
        no_slash[ord("/")] = False
        inner = np.zeros(256, bool)
        inner[0x80:0xC0] = True  # the further bytes of a character of several bytes
        takes: list[np.ndarray] = []
        stays: list[np.ndarray] = []
        self.start, self.accept, self.size = 0, [], len(globs)
        for glob in globs:
            self.start |= 1 << len(takes)
            takes.append(np.zeros(256, bool))
            stays.append(np.zeros(256, bool))
            for place in glob:
                if place == "**":
                    stays[-1] = stays[-1] | anything
                elif place == "*":
                    stays[-1] = stays[-1] | no_slash
                elif place == "?":
                    takes.append(no_slash & ~inner)
                    stays.append(inner.copy())
                else:
                    for byte in place.encode():
                        takes.append(np.arange(256) == byte)
                        stays.append(np.zeros(256, bool))
            self.accept.append(1 << (len(takes) - 1))
        whole = lambda rows: [sum(1 << i for i, r in enumerate(rows) if r[b]) for b in range(256)]
        self.takes, self.stays = whole(takes), whole(stays)
        self.words = max(1, -(-len(takes) // 64))
        self._takes = np.array([self._packed(m) for m in self.takes], np.uint64)
        self._stays = np.array([self._packed(m) for m in self.stays], np.uint64)
        self._accept = np.array([self._packed(m) for m in self.accept], np.uint64).reshape(-1, self.words)

    def _packed(self, mask: int) -> list[int]:
        return [(mask >> (64 * w)) & (2**64 - 1) for w in range(self.words)]

    def read_one(self, data: bytes, state: int) -> int:
        """The bits after ``data``, from the bits ``state``."""
        takes, stays = self.takes, self.stays
        for byte in data:
            state = (state << 1) & takes[byte] | state & stays[byte]
            if not state:
                break
        return state

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8 bytes): boolean (texts, globs)."""
        n = len(offsets) - 1
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")  # the longest first: those still read are a prefix
        begin, length = offsets[:-1][order], lengths[order]
        state = np.tile(np.array(self._packed(self.start), np.uint64), (n, 1))
        one, last = np.uint64(1), np.uint64(63)
        left, at = int((length > 0).sum()), 0
        while left >= FEW:
            byte = data[begin[:left] + at]
            now = state[:left]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> last
            state[:left] = moved & self._takes[byte] | now & self._stays[byte]
            at += 1
            left = int(np.searchsorted(-length, -at, side="left"))
        for i in range(left):
            whole = sum(int(w) << (64 * k) for k, w in enumerate(state[i]))
            state[i] = self._packed(self.read_one(data[begin[i] + at:begin[i] + length[i]].tobytes(), whole))
        found = np.empty((n, self.size), bool)
        found[order] = (state[:, None, :] & self._accept[None, :, :]).any(axis=2)
        return found


@lru_cache(maxsize=8)
def automaton(globs: tuple[tuple[str, ...], ...]) -> Automaton:
    """The automaton of the globs, built once in a Python worker."""
    return Automaton(globs)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_filter(pages: DataFrame, rules: Sequence[Rule] = RULES, blocked: Sequence[str] = BLOCKED,
               default: str = "allow", url: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns with host, path, rule (the text of the longest rule that fits; of equally long
    ones the first given; else null), pattern (the first of ``blocked`` that meets, where no rule fits) and verdict (the rule's,
    else ``block`` with a pattern and ``default`` without)."""
    rules = sorted(rules, key=lambda r: -len(r.text))
    globs = tuple(tuple(g) for g in [r.glob for r in rules] + [split_glob(g) for g in blocked])
    names = [r.text for r in rules] + list(blocked)
    verdicts = [r.verdict for r in rules] + ["block"] * len(blocked)
    ship(pages.sparkSession)

    def first_hit(urls: pa.Array) -> pa.Array:
        if isinstance(urls, pa.ChunkedArray):
            urls = urls.combine_chunks()
        urls = urls.cast(pa.large_binary())
        _, offsets, data = urls.buffers()
        offsets = np.frombuffer(offsets, np.int64)[urls.offset:urls.offset + len(urls) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        found = automaton(globs).matches(data, offsets)
        hit = np.where(found.any(axis=1), found.argmax(axis=1), -1) if found.shape[1] else np.full(len(urls), -1)
        return pa.array(hit.astype(np.int32))

    host, path = url_parts(pages[url])
    parts = pages.select(*[pages[c] for c in keep], host.alias("host"), path.alias("path"))
    if not globs:
        hit = F.lit(-1)
    else:
        dotted = F.when(parts["host"] != "", F.concat(F.lit("."), parts["host"], parts["path"])).otherwise(parts["path"])
        hit = F.arrow_udf(first_hit, "int")(dotted)
    parts = parts.withColumn("__hit", hit)
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values], F.lit(None).cast("string")),
                                F.when(F.col("__hit") < 0, len(values)).otherwise(F.col("__hit")))
    return parts.select(
        *keep, "host", "path",
        F.when(F.col("__hit") < len(rules), pick(names)).alias("rule"),
        F.when(F.col("__hit") >= len(rules), pick(names)).alias("pattern"),
        F.coalesce(pick(verdicts), F.lit(default)).alias("verdict"))

SQL = """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT *, CASE
    WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM u),
g AS (SELECT *, CASE WHEN rule IS NOT NULL OR NOT starts_with(path, '/') THEN NULL
    WHEN '.' || host LIKE '%.spam-%' THEN '*.spam-*/**'
    WHEN '.' || host LIKE '%.free-bets.%' THEN '*.free-bets.*/**'
    WHEN '.' || host LIKE '%.cheap-pills.%' THEN '*.cheap-pills.*/**'
    WHEN '.' || host LIKE '%.casino-%' THEN '*.casino-*/**'
    WHEN '.' || host LIKE '%.ads-track.%' THEN '*.ads-track.*/**'
    WHEN '.' || host LIKE '%.adult-%' THEN '*.adult-*/**' END AS pattern FROM j)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM g
"""
