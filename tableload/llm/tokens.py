"""Whole-text token ids of a public tokenizer file, each distinct chunk encoded once.

A text is cut at single spaces and before single line ends, where the pre-tokenizers of
the public files always cut too, and the tokenizers library encodes every distinct chunk that the worker has
not met before.  Where a cut touches other white space, a pre-token may hold several
blanks; such texts go to the library whole.  New chunks are encoded many to a call, as one line, and
told apart in its ids: by the ids that begin with a space, or, where the tokenizer drops
spaces, by a mark between them; a line whose parts do not add up is encoded chunk by chunk.
Ids travel as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import os

import numpy as np

_BATCH = 20_000
_LONGEST = 200  # characters of a chunk that is remembered
_LINE = 200     # chunks encoded as one line
_MARK = "\x01"


class ChunkEncoder:
    """Encodes lists of texts; remembers at most ``limit`` chunks."""

    def __init__(self, path: str, limit: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = limit
        self._ends: np.ndarray | None = None
        # whether an id begins a chunk of a line, or stands for the mark before it
        self._begins = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self._marked = not self._ids("  ")  # spaces leave no ids
        if self._marked:
            mark = self._ids(_MARK)
            self._begins[mark if len(mark) == 1 else []] = True
        else:
            self._begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True  # byte-level space
        self.first: dict[str, bytes | None] = {}   # chunk at the start of a text; None: not to be cut there
        self.later: dict[str, bytes | None] = {}   # chunk after a space, without it, or with its line end

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), _BATCH):
            found = self.tokenizer.encode_batch_fast(texts[at:at + _BATCH], add_special_tokens=False)
            out += [np.array(x.ids, dtype="<u4").tobytes() for x in found]
        return out

    def _lines(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks behind a space each, without white space at their ends or the mark in them."""
        groups = [chunks[at:at + _LINE] for at in range(0, len(chunks), _LINE)]
        lead = f" {_MARK} " if self._marked else " "
        out: list[bytes] = []
        for group, raw in zip(groups, self._whole([lead + lead.join(g) for g in groups]), strict=True):
            at = np.flatnonzero(self._begins[np.frombuffer(raw, dtype="<u4")])
            if len(at) != len(group):
                out += self._whole([" " + x for x in group])
                continue
            starts = ((at + self._marked) * 4).tolist()
            ends = [*(at[1:] * 4).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        return out

    def _learn(self, memo: dict[str, bytes | None], chunks: set[str], lead: str) -> None:
        new = [x for x in chunks.difference(memo) if len(x) <= _LONGEST]
        if len(memo) + len(new) > self.limit:
            memo.clear()
            new = [x for x in chunks if len(x) <= _LONGEST]
        joined = [x for x in new if lead and x and not (x[0].isspace() or x[-1].isspace() or _MARK in x)]
        memo.update(zip(joined, self._lines(joined), strict=True))
        alone = [x for x in new if x not in memo]
        memo.update(zip(alone, self._whole([x if x[:1] == "\n" else lead + x for x in alone]), strict=True))
        for x in new:  # white space beside the cut
            inner = x[1:] if x[:1] == "\n" else x
            if x[-1:].isspace() or lead and (not inner or inner[0].isspace()):
                memo[x] = None

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object of ids per text."""
        out: list[bytes] = []
        for at in range(0, len(texts), 500):  # few texts at a time, so that new chunks stay few
            part = [t.replace("\n", " \n").split(" ") for t in texts[at:at + 500]]
            self._learn(self.first, {p[0] for p in part}, "")
            seen: set[str] = set()
            for pieces in part:
                seen.update(pieces[1:])
            self._learn(self.later, seen, " ")
            get = self.later.__getitem__
            for text, pieces in zip(texts[at:at + 500], part, strict=True):
                try:
                    pieces[0] = self.first[pieces[0]]
                    pieces[1:] = map(get, pieces[1:])
                    out.append(b"".join(pieces))
                except (TypeError, KeyError):  # a chunk that may not stand alone, or a long one
                    out += self._whole([text])
        return out

    def ends_sentence(self) -> np.ndarray:
        """For every id, whether its surface text ends a sentence or a line."""
        if self._ends is None:
            surface = (self.tokenizer.decode([i]) for i in range(self.tokenizer.get_vocab_size()))
            self._ends = np.array([t.rstrip(" ").endswith((".", "!", "?", "\n")) for t in surface])
        return self._ends


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of this file; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
