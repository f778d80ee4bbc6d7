"""Word and shingle helpers shared by the operators of this package.

A word is a maximal run of characters other than space and U+0009..U+000D.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64


def words(text: Column) -> Column:
    """Words of a non-null text as an array of strings."""
    return F.array_remove(F.split(text, "[ \t-\r]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, so that others can not clash; a null text becomes empty."""
    return docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) if c == "text" else docs[c] for c in columns])


class WordHash(dict):
    """Word (bytes) to 64-bit hash, remembered up to a bounded number of words."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, word_list: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, word_list), dtype=np.uint64, count=len(word_list))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that order and low bits are random."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (polynomial modulo 2^64, scrambled)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * _ODD + hashes[j:j + n]
    return mix64(out)
