"""Operator 1, token counts: trie-shared dynamic programming.

A pre-token is a word with the word mark in front.  Its segmentation is the one of highest
score under a unigram model: given ``scores``, or the pieces of a public sentencepiece file, whose log
probabilities then follow from their ranks by Zipf's law (in whole thousandths, so sums are
exact); such counts are the model's, not the file's own BPE counts.  Among equal scores the fewest tokens count.  A character that is no piece falls
back to its UTF-8 bytes, one token each.

Distinct pre-tokens enter a trie.  A node holds the forward score and token count of the
prefix it spells, computed once when the node is made, from the pieces that end
there; so prefixes are never scored twice.  Terminal counts answer all further
occurrences.  A worker's trie is bounded and starts anew when full; the counts do not
depend on that.  A word of more than ``LONG_WORD`` characters shares no prefix worth keeping: it is scored
alone, over a window of as many prefixes as the longest piece has characters.  Texts are taken
in slices of bounded size.  No shuffle.

Defined results: null and empty texts have 0 tokens; repeated rows are counted one by one;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.ship import ship
from tableload.llm.text import BLANKS, documents

MARK = "▁"          # sentencepiece's word mark
MAX_NODES = 1_200_000
LONG_WORD = 256
SLICE_ROWS, SLICE_CHARS = 200, 4_000_000  # of texts counted together; one text may be longer
_BLANK_TABLE = str.maketrans({c: " " for c in BLANKS})
_TRIES: dict[str, Trie] = {}


def unigram_scores(path: str) -> dict[str, int]:
    """Piece to log probability in thousandths, from the pieces' ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    harmonic = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: round(-1000 * (math.log(r + 1) + harmonic)) for r, p in enumerate(pieces)}


def _reversed_pieces(scores: dict[str, int]) -> dict:
    """Pieces spelled backwards as nested dicts; the key "" holds a piece's score."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for char in reversed(piece):
            node = node.setdefault(char, {})
        node[""] = score
    return root


class Trie:
    """Forward scores of all prefixes met, and the token counts of the pre-tokens."""

    def __init__(self, scores: dict[str, int], max_nodes: int = MAX_NODES):
        self.max_nodes = max_nodes
        self.long_word = LONG_WORD
        self.longest = max(map(len, scores), default=1)
        self.pieces = _reversed_pieces(scores)
        self.byte_score = min(scores.values(), default=0) - 1000
        self.clear()

    def clear(self) -> None:
        self.terminal: dict[str, int] = {}
        self._clear_nodes()

    def _clear_nodes(self) -> None:
        self.child: dict[int, int] = {}  # (node, character) -> node
        self.score, self.tokens = [0], [0]

    def _insert(self, token: str) -> int:
        node, path, child = 0, [0], self.child
        score, tokens = self.score, self.tokens
        for end, char in enumerate(token):
            edge = node << 21 | ord(char)
            after = child.get(edge)
            if after is None:
                after = child[edge] = len(score)
                size = len(char.encode("utf-8", "surrogatepass"))
                best, count = score[node] + size * self.byte_score, tokens[node] + size
                # pieces that end here, shortest first
                back, start = self.pieces, end
                while start >= 0 and (back := back.get(token[start])) is not None:
                    if "" in back:
                        total = score[path[start]] + back[""]
                        if total > best or total == best and tokens[path[start]] + 1 < count:
                            best, count = total, tokens[path[start]] + 1
                    start -= 1
                score.append(best)
                tokens.append(count)
            node = after
            path.append(node)
        return tokens[node]

    def _alone(self, token: str) -> int:
        """Tokens of a long pre-token; scores of its last prefixes only, in a ring by length."""
        ring = self.longest + 1
        score, tokens = [0] * ring, [0] * ring
        for end, char in enumerate(token):
            size = len(char.encode("utf-8", "surrogatepass"))
            best, count = score[end % ring] + size * self.byte_score, tokens[end % ring] + size
            back, start = self.pieces, end
            while start >= 0 and (back := back.get(token[start])) is not None:
                if "" in back:
                    total = score[start % ring] + back[""]
                    if total > best or total == best and tokens[start % ring] + 1 < count:
                        best, count = total, tokens[start % ring] + 1
                start -= 1
            score[(end + 1) % ring], tokens[(end + 1) % ring] = best, count
        return tokens[len(token) % ring]

    def counts(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        if max(len(self.score), len(self.terminal)) > self.max_nodes:
            self.clear()
        new = set().union(*texts).difference(self.terminal) if texts else ()
        for word in new:
            if len(word) > self.long_word:
                self.terminal[word] = self._alone(MARK + word)
                continue
            if len(self.score) > self.max_nodes:
                self._clear_nodes()  # the counts of this call's words stay
            self.terminal[word] = self._insert(MARK + word)
        count = self.terminal.__getitem__
        found = [sum(map(count, t)) for t in texts]
        for word in new:
            if len(word) > self.long_word:
                del self.terminal[word]
        return found


def _trie(path: str, scores: dict[str, int] | None) -> Trie:
    key = path if scores is None else f"{path} {sorted(scores.items())}"
    if key not in _TRIES:
        _TRIES[key] = Trie(unigram_scores(path) if scores is None else scores)
    return _TRIES[key]


def slices(texts: list[str | None], rows: int = SLICE_ROWS, chars: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    """Consecutive texts, at most ``rows`` at a time; a slice ends when it holds ``chars`` characters."""
    part: list[str | None] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if len(part) == rows or size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def split_words(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_BLANK_TABLE).split(" ") if w]


def token_counts(docs: DataFrame, model: str, scores: dict[str, int] | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens of every document.  ``model``: path of a sentencepiece file; ``scores``:
    pieces (the word mark included) and their log probabilities in thousandths, in place of the file's."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(model, scores)
        for batch in batches:
            n_words, n_tokens = [], []
            for part in slices(batch.column(1).to_pylist()):
                texts = [split_words(t) for t in part]
                n_words += map(len, texts)
                n_tokens += trie.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long")
