"""Adaptive context-mixing range coder for blocks of token ids.

Every block starts from the same state, so blocks decode independently; all blocks of a
segment are coded side by side, one id of each per step, as vector operations.

For each id the models of order 2 and 1 (slots keyed by the two or one previous ids, each
holding an id and a confidence) propose a candidate.  Three estimates that it is right
(adaptive probabilities given the order-2 confidence, the order-1 confidence and agreement,
and how often the block has had the candidate: order 0) are mixed in the logistic domain
with weights that learn from every outcome, and drive a binary decision.  An id that is
not the candidate is coded by adaptive order-0 frequencies of its magnitude and leading
bits, and plain remaining bits.  All arithmetic is on integers, so any machine decodes
what another one wrote.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

MAGIC = b"IDC2"
SLOT_BITS = 11
CONFIDENCE = 7
RECENT_BITS = 10
SAFE = 12               # plain bits that still fit a range narrowed by leading bits
LEAD = 4                # adaptive leading bits below the magnitude
TOTAL_BITS = 14         # frequencies of a context add up to this power of two
_LEAST = 1 << 30        # a range below it lets a word leave; ranges end at 2^62, bit 62 of low is a carry
_LOW, _WORD = _LEAST - 1, (1 << 32) - 1
_SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], dtype=np.int64)
_STRETCH = np.array([max(-2047, min(2047, round(256 * math.log((p + 0.5) / (4095.5 - p))))) for p in range(4096)], dtype=np.int64)
# by 8 * right + confidence: what a slot gains, and whether it takes the id instead
_GAIN = np.array([(s >> 1) - s for s in range(8)] + [min(s + 1, CONFIDENCE) - s for s in range(8)], dtype=np.int32)
_TAKES = np.array([s <= 1 for s in range(8)] + [False] * 8)


class _Writer:
    """``low`` and ``width`` of every lane's range.  Words are kept with their carries,
    which ``finish`` hands to the words before."""

    def __init__(self, lanes: int, steps: int, classes: int):
        self.low = np.zeros(lanes, dtype=np.int64)
        self.width = np.full(lanes, 1 << 62, dtype=np.int64)
        # a row per word, as lanes advance about together; most bits of an id: 12, twice 14, and plain ones
        self.words = np.zeros((steps * (40 + classes) // 32 + 4, lanes), dtype=np.int64)
        self.flat, self.to = self.words.reshape(-1), np.arange(lanes)

    def settle(self, low, width, lanes=None):
        m = (width < _LEAST).nonzero()[0]
        if len(m):
            of = m if lanes is None else lanes[m]
            to, left = self.to[of], low[m]
            self.flat[to] = left >> 30
            self.to[of] = to + len(self.to)
            low[m] = (left & _LOW) << 32
            width[m] <<= 32

    @staticmethod
    def bit(low, width, p, hit):
        bound = (width >> 12) * p
        low += np.where(hit, 0, bound)
        width[:] = np.where(hit, bound, width - bound)
        return hit

    @staticmethod
    def unit(low, width, bits):
        return width >> bits

    @staticmethod
    def count(low, unit):
        return None

    @staticmethod
    def narrow(low, width, unit, start, freq):
        low += unit * start
        np.multiply(unit, freq, out=width)

    def finish(self) -> list[bytes]:
        lanes = len(self.to)
        self.flat[self.to] = self.low >> 30
        self.flat[self.to + lanes] = (self.low & _LOW) << 2
        ends = self.to // lanes + 2
        words = self.words[:int(ends.max())]
        while (carries := words >> 32).any():
            words &= _WORD
            words[:-1] += carries[1:]
        words = words.T.astype("<u4", order="C")
        return [row[:n].tobytes() for row, n in zip(words, ends.tolist(), strict=True)]


class _Reader:
    """The same ranges; ``low`` holds how far the code lies above the range's start."""

    def __init__(self, blocks: list[bytes]):
        lanes, longest = len(blocks), max(map(len, blocks)) // 4
        words = np.zeros((lanes, longest + 4), dtype="<u4")
        for i, b in enumerate(blocks):
            words[i, :len(b) // 4] = np.frombuffer(b[:len(b) // 4 * 4], dtype="<u4")
        self.low = (words[:, 0].astype(np.int64) << 30) | (words[:, 1] >> 2)
        self.width = np.full(lanes, 1 << 62, dtype=np.int64)
        words = words.T
        self.flat = ((words[1:-1] << 30) | (words[2:] >> 2)).reshape(-1)  # a row per word: 32 bits, 62 bits on
        self.to = np.arange(lanes)
        self.end = self.to + lanes * (longest + 1)

    def settle(self, low, width, lanes=None):
        m = (width < _LEAST).nonzero()[0]
        if len(m):
            of = m if lanes is None else lanes[m]
            to = self.to[of]
            low[m] = (low[m] << 32) | self.flat[to]
            self.to[of] = np.minimum(to + len(self.to), self.end[of])
            width[m] <<= 32

    @staticmethod
    def bit(low, width, p, _hit):
        bound = (width >> 12) * p
        hit = low < bound
        low -= np.where(hit, 0, bound)
        width[:] = np.where(hit, bound, width - bound)
        return hit

    @staticmethod
    def unit(low, width, bits):
        unit = width >> bits
        np.minimum(low, (unit << bits) - 1, out=low)  # only damage lies above
        return unit

    @staticmethod
    def count(low, unit):
        return low // unit

    @staticmethod
    def narrow(low, width, unit, start, freq):
        low -= unit * start
        np.multiply(unit, freq, out=width)


class _Frequencies:
    """Adaptive cumulative frequencies of ``symbols`` symbols in ``contexts`` contexts of each lane."""

    def __init__(self, lanes: int, contexts: int, symbols: int):
        symbols = max(2, symbols)
        self.columns = -(-symbols // 8) * 8  # so that a row of comparisons is whole 64-bit words
        total, place = 1 << TOTAL_BITS, np.arange(self.columns)
        row = np.where(place < symbols, place * total // symbols, total)
        self.starts = np.tile(row.astype(np.int16), (lanes * contexts, 1))
        # where the starts move when a symbol comes: all room to it, save a little for each other one
        least = total // symbols // 64
        after = place[None, :] > np.arange(symbols)[:, None]
        toward = np.where(after, total - (symbols - place) * least, place * least)
        self.toward = np.where(place < symbols, toward, total).astype(np.int16)
        self.rows = np.zeros((lanes + 1, self.columns), dtype=np.int16)
        self.first = np.arange(lanes) * self.columns
        self.item = f"V{2 * self.columns}"  # a row as one item: moved at once

    def code(self, coder, low, width, row, symbols, rate):
        m = len(row)
        rows = self.rows[:m]
        self.starts.take(row, axis=0, out=rows, mode="clip")
        unit = coder.unit(low, width, TOTAL_BITS)
        count = coder.count(low, unit)
        if count is not None:
            under = np.bitwise_count((rows <= count.astype(np.int16)[:, None]).view(np.uint64))
            symbols = sum(under.T[1:], under.T[0]).astype(np.int64) - 1
        at = self.first[:m] + symbols
        flat = self.rows.reshape(-1)
        start = flat.take(at)
        freq = (flat.take(at + 1) - start) & ((1 << TOTAL_BITS) - 1)  # behind the last symbol comes a 0 or the total
        coder.narrow(low, width, unit, start, freq)
        step = self.toward.take(symbols, axis=0)
        step -= rows
        step >>= rate
        rows += step
        self.starts.view(self.item)[row] = rows.view(self.item)
        return symbols


def _magnitude(v: np.ndarray) -> np.ndarray:
    """Index of the highest set bit of positive numbers below 2^33."""
    return np.frexp(v.astype(np.float64))[1].astype(np.int64) - 1


def _run(coder, lengths: np.ndarray, classes: int, ids: np.ndarray, coded: bool) -> None:
    """Codes ``ids``, a row per step, or decodes into them; lengths do not increase."""
    lanes, steps = len(lengths), len(ids)
    kind = np.int32 if classes <= 28 else np.int64
    slots = np.zeros(2 * lanes << SLOT_BITS, dtype=kind)  # id << 3 | confidence; order 2, then order 1
    recent = np.zeros(lanes << RECENT_BITS, dtype=np.int8)
    magnitude, lead = _Frequencies(lanes, 1, classes), _Frequencies(lanes, classes, 1 << LEAD)
    adapt = np.full(3 * lanes * 16, 1 << 14, dtype=np.int64)  # order 2, order 1, order 0
    weights = np.full((3, lanes), 1 << 15, dtype=np.int64)
    offsets = np.arange(lanes) * 16 + np.arange(3)[:, None] * lanes * 16
    every = np.arange(lanes)
    slot = (np.arange(2)[:, None] * lanes + every) << SLOT_BITS
    mine = every << RECENT_BITS
    key, last = np.zeros((2, lanes), dtype=np.uint32), np.zeros(lanes, dtype=np.uint32)
    active = (lengths[None, :] > np.arange(steps)[:, None]).sum(axis=1)
    shift = np.uint32(32 - SLOT_BITS)
    places = np.empty((3, lanes), dtype=np.int64)
    n = lanes
    for t in range(steps):
        if int(active[t]) < n:
            n = int(active[t])
            key, last, slot, weights, offsets = key[:, :n], last[:n], slot[:, :n], weights[:, :n].copy(), offsets[:, :n]
            mine, places = mine[:n], places[:, :n].copy()
        rate = 3 if t < 16 else 4 if t < 64 else 5
        low, width = coder.low[:n], coder.width[:n]
        coder.settle(low, width)
        at = (key >> shift) + slot
        held = slots.take(at)
        sure, candidates = held & 7, held >> 3
        guess = np.where(sure[0] > 0, candidates[0], candidates[1]).astype(np.int64)
        places[0] = sure[0]
        np.multiply(candidates[1] == guess, 8, out=places[1])
        places[1] += sure[1]
        places[2] = recent.take(mine + (guess & ((1 << RECENT_BITS) - 1)))
        places += offsets
        chances = adapt.take(places)
        inputs = _STRETCH.take(chances >> 4)
        dot = (weights * inputs).sum(axis=0) >> 16
        p = _SQUASH.take(dot + 2047, mode="clip")
        x = ids[t, :n].astype(np.int64) if coded else guess
        hit = coder.bit(low, width, p, x == guess if coded else None)
        miss = (~hit).nonzero()[0]
        if len(miss):
            low, width = low[miss], width[miss]
            v = x[miss] + 1 if coded else None
            size = magnitude.code(coder, low, width, miss, _magnitude(v) if coded else None, rate)
            rest = np.maximum(size - LEAD, 0)
            coder.settle(low, width, miss)
            head = lead.code(coder, low, width, miss * classes + size, (v - (1 << size)) >> rest if coded else None, rate)
            if classes - 1 - LEAD > SAFE:
                coder.settle(low, width, miss)
            unit = coder.unit(low, width, rest)
            tail = v & ((1 << rest) - 1) if coded else coder.count(low, unit)
            coder.narrow(low, width, unit, tail, 1)
            coder.low[miss], coder.width[miss] = low, width
            if not coded:
                x[miss] = (1 << size) + (head << rest) + tail - 1
        if not coded:
            ids[t, :n] = x
        error = np.where(hit, 4096 * 6, 0) - p * 6
        inputs *= error
        inputs += 0x8000
        inputs >>= 16
        weights += inputs
        gain = np.where(hit, 65535, 0) - chances
        gain >>= 4
        chances += gain
        adapt[places] = chances
        new = x.astype(kind)
        seen = sure + ((candidates == new) << 3)
        held += _GAIN.take(seen)
        slots[at] = np.where(_TAKES.take(seen), (new << 3) | 1, held)
        here = mine + (x & ((1 << RECENT_BITS) - 1))
        recent[here] = np.minimum(recent.take(here) + 1, CONFIDENCE)
        a = x.astype(np.uint32)
        last += np.uint32(0x165667B1)
        np.multiply(a, np.uint32(0x2F0B4C47), out=key[0])
        key[0] += last
        np.multiply(a, np.uint32(0x2545F491), out=key[1])
        np.multiply(a, np.uint32(0x1E35A7BD), out=last)


def encode_segment(ids: np.ndarray, block: int) -> bytes:
    """Header, directory (bytes and crc32 of the ids of every block), payloads."""
    n = len(ids)
    lanes = -(-n // block)
    lengths = np.full(lanes, block, dtype=np.int64)
    classes = (int(ids.max(initial=0)) + 1).bit_length()  # magnitudes of id + 1
    if lanes:
        lengths[-1] = n - block * (lanes - 1)
    ids = np.ascontiguousarray(ids, dtype="<u4")
    payloads: list[bytes] = []
    if lanes:
        steps = np.zeros((min(block, n), lanes), dtype=np.uint32)
        whole = n // block
        steps[:, :whole] = ids[:whole * block].reshape(whole, -1).T if whole else 0
        steps[:n - whole * block, whole:] = ids[whole * block:, None]
        writer = _Writer(lanes, len(steps), classes)
        _run(writer, lengths, classes, steps, True)
        payloads = writer.finish()
    directory = b"".join(struct.pack("<II", len(p), zlib.crc32(ids[i * block:(i + 1) * block].tobytes()))
                         for i, p in enumerate(payloads))
    return MAGIC + struct.pack("<QIII", n, block, lanes, classes) + directory + b"".join(payloads)


def decode_segment(raw: bytes) -> np.ndarray:
    """The ids; raises ValueError where a block does not match its checksum."""
    if raw[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    n, block, lanes, classes = struct.unpack_from("<QIII", raw, 4)
    if not lanes:
        return np.empty(0, dtype="<u4")
    directory = [struct.unpack_from("<II", raw, 24 + 8 * i) for i in range(lanes)]
    at, payloads = 24 + 8 * lanes, []
    for size, _ in directory:
        payloads.append(raw[at:at + size])
        at += size
    lengths = np.full(lanes, block, dtype=np.int64)
    lengths[-1] = n - block * (lanes - 1)
    steps = np.zeros((int(lengths.max()), lanes), dtype=np.uint32)
    _run(_Reader(payloads), lengths, classes, steps, False)
    out = steps.T.astype("<u4").reshape(-1)[:n]
    for i, (_, crc) in enumerate(directory):
        if zlib.crc32(out[i * block:(i + 1) * block].tobytes()) != crc:
            raise ValueError(f"block {i} does not match its checksum")
    return out
