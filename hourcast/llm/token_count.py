"""Word-piece token counts by a linear longest-match automaton.

The vocabulary becomes a trie with two roots: one for pieces that start a word, one
for pieces inside a word. Every node has a failure link, the node that holds what
is left after the longest pieces have been popped from its string, and the *number*
of pieces popped on the way. One pass over a word's characters then gives the
number of greedy longest-match pieces; no piece is ever built. Matching starts at the
word mark: where no longer piece goes on from it, the bare mark is a piece of its own.
A character that no piece starts with counts one token for each of its UTF-8 bytes, if
the vocabulary has the byte pieces. Without them, a word that greedy matching cannot
finish counts as one unknown token.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and no tokens.
Repeated rows are counted alike. Words are counted once per Arrow batch and
remembered between batches up to ``MEMO`` words, after which the memory is emptied.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from hourcast.llm.common import pick, prepare

#: Words whose counts a worker remembers.
MEMO = 600_000

#: What SentencePiece puts before a word.
MARK = "▁"


class Automaton:
    """``start`` pieces begin a word (the empty one: the bare mark), ``inner`` pieces go on within one.

    ``by_bytes``: a character without a piece counts its UTF-8 bytes.
    """

    def __init__(self, start, inner, by_bytes: bool = False) -> None:
        start, inner = list(start), list(inner)
        self.by_bytes = by_bytes
        self.child: dict[tuple[int, str], int] = {}
        self.is_piece = [False, False]
        parent, letter = [-1, -1], ["", ""]
        for root, pieces in ((0, start), (1, inner)):
            for piece in pieces:
                v = root
                for c in piece:
                    u = self.child.get((v, c))
                    if u is None:
                        u = self.child[v, c] = len(parent)
                        parent.append(v)
                        letter.append(c)
                        self.is_piece.append(False)
                    v = u
                if v != root:
                    self.is_piece[v] = True
        weight = {}
        if by_bytes:  # every letter can be popped alone
            for c in set(letter[2:]):
                v = self.child.get((1, c))
                if v is None:
                    v = self.child[1, c] = len(parent)
                    parent.append(1)
                    letter.append(c)
                    self.is_piece.append(False)
                if not self.is_piece[v]:
                    self.is_piece[v], weight[v] = True, n_bytes(c)
        n = len(parent)
        self.fail, self.popped = [-1] * n, [0] * n
        if "" in start or by_bytes:
            self.fail[0], self.popped[0] = 1, 1 if "" in start else n_bytes(MARK)
        below: dict[int, list[int]] = {}
        for v in range(2, n):
            below.setdefault(parent[v], []).append(v)
        queue = deque([0, 1])
        while queue:  # parents come before children
            u = queue.popleft()
            for v in below.get(u, ()):
                if self.is_piece[v]:
                    self.fail[v], self.popped[v] = 1, weight.get(v, 1)
                else:
                    z, k = self.fail[u], self.popped[u]
                    while z != -1 and (z, letter[v]) not in self.child:
                        k, z = k + self.popped[z], self.fail[z]
                    if z != -1:
                        self.fail[v], self.popped[v] = self.child[z, letter[v]], k
                queue.append(v)

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match; -1 if there is none."""
        if not word:
            return 0
        child, fail, popped = self.child, self.fail, self.popped
        u, n = 0, 0
        for c in word:
            v = child.get((u, c))
            while v is None:
                n += popped[u]
                u = fail[u]
                if u == -1:
                    if not self.by_bytes:
                        return -1
                    n, v = n + n_bytes(c), 1
                else:
                    v = child.get((u, c))
            u = v
        while u > 1:
            n += popped[u]
            u = fail[u]
        return -1 if u == -1 else n


def n_bytes(c: str) -> int:
    return len(c.encode("utf-8", "surrogatepass"))


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(word-start pieces, inner pieces) of a SentencePiece model file.

    The word mark is taken off the start pieces; the bare mark becomes the empty piece.
    Marked pieces are inner ones too, for words that hold the mark as a character.
    Byte pieces are not text: see ``has_bytes``.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    start, inner = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        if piece.startswith(MARK):
            start.append(piece[1:])
        inner.append(piece)
    return start, inner


def has_bytes(path: str) -> bool:
    """Whether the model file has a piece for each of the 256 bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(map(sp.is_byte, range(sp.get_piece_size()))) == 256


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch, and how many of them each text has (empty strings at a text's ends included)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def sums_by_text(values: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    end = np.cumsum(per_text)
    return total[end] - total[end - per_text]


class Counter:
    """Counts of a batch's texts; built once a worker from the vocabulary's path."""

    def __init__(self, path: str) -> None:
        self.automaton = Automaton(*vocabulary(path), by_bytes=has_bytes(path))
        self.memo: dict[str, int] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, tokens, unknown words) of every text."""
        words, per_text = split_words(texts)
        if not len(words):
            none = np.zeros(len(texts), dtype=np.int64)
            return none, none, none
        coded = words.dictionary_encode()
        memo, count = self.memo, self.automaton.count
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(memo.get, known))
        for i, n in enumerate(found):
            if n is None:
                found[i] = memo[known[i]] = count(known[i])
        if len(memo) > MEMO:
            memo.clear()
        n = np.array(found, dtype=np.int64)[coded.indices.to_numpy()]
        full = (n != 0).astype(np.int64)  # the empty string has no piece
        return tuple(sums_by_text(v, per_text) for v in (full, np.where(n < 0, 1, n), (n < 0).astype(np.int64)))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def default_vocabulary() -> str:
    """The public 32k vocabulary installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_words, n_tokens, n_unknown) for every row; ``path``: the vocabulary file, on every executor."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path or default_vocabulary())
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, count(batch.column("text")))],
                                             names=["id", "n_words", "n_tokens", "n_unknown"])

    return d.mapInArrow(run, "id long, n_words long, n_tokens long, n_unknown long")
