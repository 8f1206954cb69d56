"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared as token sequences (white-space words,
lower-cased, punctuation trimmed). Seeds, runs of ``MIN_MATCH`` tokens that both
share, are found by joining Karp-Rabin hashes: the items' hashes are a table, the
documents' hashes are rolled over whole texts, and every hit is checked token by
token. For pairs with seeds, the longest match that touches no marked token is
marked again and again until none of ``MIN_MATCH`` tokens is left; the marked
stretches (tiles) never overlap, so passages whose parts were moved about are
covered all the same. A document holds an item if its tiles cover at least
``COVERAGE`` of the item's tokens. An item shorter than ``MIN_MATCH`` is matched whole.

The items are a stated query set: they are taken in blocks of bounded size (by a
hash of the item, ``BLOCK_BYTES`` on average; one item is never split), each sent to the tasks.
One stage reads the documents once and holds every Arrow batch, its tokens cut once, against all
blocks in turn. Up to ``BLOCKS_HELD`` blocks stay in a task's memory; beyond that each is read
from the executor's copy for every batch and let go again. Ties between equally long matches go to the earlier place
in the item, then in the document.

Null texts and texts without tokens match nothing. Repeated documents are judged
one by one, repeated items (same id and text) once. Extra columns and clashing names
are allowed: the first column of a name counts, ``without_leaks`` returns all of them as they came.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from hourcast.llm.common import pick, prepare

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
#: Blocks that a task keeps in memory.
BLOCKS_HELD = 4
#: Seed hits of one document that are held at once; beyond, pairs are scanned diagonal by diagonal.
MAX_HITS = 1_000_000
#: Trimmed from both ends of a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…–—¿¡•·"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of a batch of texts and the number of tokens of each."""
    low = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    lists = pc.ascii_split_whitespace(low)
    words = pc.utf8_trim(lists.flatten(), characters=PUNCTUATION)
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    end = np.cumsum(per_text)
    some = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    return words.filter(full), some[end] - some[end - per_text]


def rolling(ids: np.ndarray, m: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all runs of ``m`` ids."""
    n = len(ids) - m + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(m):
        h = h * _BASE + x[k:k + n]
    return h


def tiles(item: np.ndarray, doc: np.ndarray, m: int, at_item: np.ndarray | None = None,
          at_doc: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in item, place in doc) of every tile.

    ``at_item`` and ``at_doc`` are the places of all equal runs of ``m`` tokens, if known.
    """
    if at_item is None:
        runs = _diagonal_runs(item, doc, m)
    else:
        diagonal = at_doc - at_item
        order = np.lexsort((at_item, diagonal))
        q, d = at_item[order], diagonal[order]
        first = np.concatenate(([True], (d[1:] != d[:-1]) | (q[1:] != q[:-1] + 1)))
        start = np.flatnonzero(first)
        size = np.diff(np.concatenate((start, [len(q)]))) + m - 1
        runs = [(-n, a, a + g) for n, a, g in zip(size.tolist(), q[start].tolist(), d[start].tolist(), strict=True)]
    heapq.heapify(runs)
    used_item, used_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    found = []
    while runs:
        n, a, b = heapq.heappop(runs)
        used = used_item[a:a - n] | used_doc[b:b - n]
        if not used.any():
            used_item[a:a - n] = used_doc[b:b - n] = True
            found.append((-n, a, b))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([True], used, [True])).astype(np.int8)))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j - i >= m:  # what is left of the match on either side of a mark
                heapq.heappush(runs, (i - j, a + i, b + i))
    return found


def _diagonal_runs(item: np.ndarray, doc: np.ndarray, m: int) -> list[tuple[int, int, int]]:
    """All maximal equal runs of ``m`` tokens or more, one diagonal at a time."""
    runs = []
    for shift in range(1 - len(item), len(doc)):
        a = max(0, -shift)
        n = min(len(item) - a, len(doc) - a - shift)
        if n < m:
            continue
        same = np.concatenate(([False], item[a:a + n] == doc[a + shift:a + shift + n], [False]))
        edge = np.flatnonzero(np.diff(same.astype(np.int8)))
        runs += [(i - j, a + i, a + shift + i) for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if j - i >= m]
    return runs


@dataclass
class Block:
    """Benchmark items ready for the seed join: token ids by item, and their runs by hash."""

    item_ids: list
    words: pa.Array
    items: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # run length -> sorted hashes, item, place
    min_match: int

    @classmethod
    def build(cls, rows: list[tuple[object, str]], min_match: int) -> "Block":
        flat, per_text = tokens(pa.array([t for _, t in rows], pa.string()))
        coded = flat.dictionary_encode()
        ids = coded.indices.to_numpy().astype(np.int64)
        items = np.split(ids, np.cumsum(per_text)[:-1]) if len(rows) else []
        by_length: dict[int, list] = {}
        for k, x in enumerate(items):
            if len(x):
                m = min(min_match, len(x))
                h = rolling(x, m)
                by_length.setdefault(m, []).append((h, np.full(len(h), k), np.arange(len(h))))
        seeds = {}
        for m, found in by_length.items():
            h, item, place = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.argsort(h, kind="stable")
            seeds[m] = h[order], item[order], place[order]
        return cls([i for i, _ in rows], coded.dictionary, items, seeds, min_match)

    def overlaps(self, flat: pa.Array, per_text: np.ndarray, coverage: float) -> list[tuple[int, int, int, int, int]]:
        """(row, item, covered tokens, tiles, longest tile) of every pair at ``coverage`` or more, from ``tokens`` of the texts."""
        if not self.seeds:
            return []
        ids = pc.fill_null(pc.index_in(flat, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(per_text)
        out = []
        for m, (hashes, item, place) in self.seeds.items():
            if len(ids) < m:
                continue
            known = np.concatenate(([0], np.cumsum(ids >= 0)))
            may = np.flatnonzero(known[m:] - known[:-m] == m)  # runs of tokens that items have
            if not len(may):
                continue
            h = np.zeros(len(may), dtype=np.uint64)
            for k in range(m):
                h = h * _BASE + (ids[may + k] + 1).astype(np.uint64)
            lo = np.searchsorted(hashes, h)
            hit = hashes[np.minimum(lo, len(hashes) - 1)] == h
            may, lo = may[hit], lo[hit]
            count = np.searchsorted(hashes, h[hit], side="right") - lo
            row = np.searchsorted(end, may, side="right")
            inside = may + m <= end[np.minimum(row, len(end) - 1)]  # not across two texts
            may, lo, count, row = may[inside], lo[inside], count[inside], row[inside]
            cut = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1, [len(row)])) if len(row) else [0]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                r = int(row[i])
                doc = ids[end[r] - per_text[r]:end[r]]
                out += [(r, *x) for x in self._row(doc, may[i:j] - (end[r] - per_text[r]), lo[i:j], count[i:j], m, item, place, coverage)]
        return out

    def _row(self, doc, at, lo, count, m, item, place, coverage) -> Iterator[tuple[int, int, int, int]]:
        many = int(count.sum()) > MAX_HITS
        if many:  # whole pairs are scanned instead; the items concerned come from the distinct hits
            distinct = np.unique(np.stack([lo, count]), axis=1)
            which = np.unique(np.concatenate([item[a:a + n] for a, n in distinct.T.tolist()]))
        else:
            first = np.cumsum(count) - count
            entry = np.repeat(lo - first, count) + np.arange(int(count.sum()))
            p, k, q = np.repeat(at, count), item[entry], place[entry]
            which = np.unique(k)
        for x in which.tolist():
            seq = self.items[x]
            if many:
                found = tiles(seq, doc, m)
            else:
                own = k == x
                a, b = q[own], p[own]
                same = np.ones(len(a), dtype=bool)
                for s in range(m):  # equal hashes may be different tokens
                    same &= seq[a + s] == doc[b + s]
                a, b = a[same], b[same]
                reach = np.zeros(len(seq) + 1, dtype=np.int64)
                np.add.at(reach, a, 1)
                np.add.at(reach, a + m, -1)
                if np.count_nonzero(np.cumsum(reach)[:-1]) < coverage * len(seq):
                    continue  # tiles lie within the seeds' reach
                found = tiles(seq, doc, m, a, b)
            covered = sum(n for n, _, _ in found)
            if found and covered >= coverage * len(seq):
                yield x, covered, len(found), max(n for n, _, _ in found)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, min_match: int, block_bytes: int) -> Iterator[Block]:
    """The distinct items in blocks of ``block_bytes`` on average, one at a time."""
    b = pick(benchmark, id=id_col, text=text_col).where("text is not null").distinct()
    size = b.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // block_bytes)
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        yield Block.build(sorted(((r["id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r)), min_match)


def _sent(benchmark: DataFrame, id_col: str, text_col: str, min_match: int, block_bytes: int) -> list[Broadcast]:
    """Every block as a broadcast; the driver holds one block at a time."""
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(b) for b in blocks(benchmark, id_col, text_col, min_match, block_bytes)]


def _in_turn(sent: list[Broadcast]) -> Iterator[Block]:
    for b in sent:
        yield b.value
        if len(sent) > BLOCKS_HELD:
            vars(b).pop("_value", None)  # read again from the executor's copy when it is next asked for


def overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH,
             coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item_id, item_tokens, covered, coverage, n_tiles, longest_tile) of every document and item it holds."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    schema = "id long, item_id long, item_tokens long, covered long, coverage double, n_tiles long, longest_tile long"
    sent = _sent(benchmark, item_id_col, item_text_col, min_match, block_bytes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cut = tokens(batch.column("text"))
            for b in _in_turn(sent):
                found = b.overlaps(*cut, coverage)
                rows = pa.array([r for r, *_ in found], pa.int64())
                size = [len(b.items[k]) for _, k, *_ in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(rows), pa.array([b.item_ids[k] for _, k, *_ in found], pa.int64()),
                    pa.array(size, pa.int64()), pa.array([c for _, _, c, _, _ in found], pa.int64()),
                    pa.array([f[2] / n for f, n in zip(found, size, strict=True)], pa.float64()),
                    pa.array([t for *_, t, _ in found], pa.int64()), pa.array([x for *_, x in found], pa.int64()),
                ], names=["id", "item_id", "item_tokens", "covered", "coverage", "n_tiles", "longest_tile"])

    return d.mapInArrow(run, schema)


def without_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df``, all its columns, that hold no item."""
    prepare(df.sparkSession)
    names, at = df.columns, df.columns.index(text_col)
    df = df.toDF(*[f"_{i}" for i in range(len(names))])
    sent = _sent(benchmark, item_id_col, item_text_col, min_match, block_bytes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cut = tokens(batch.column(at))
            clean = np.ones(batch.num_rows, dtype=bool)
            for b in _in_turn(sent):
                clean[[r for r, *_ in b.overlaps(*cut, coverage)]] = False
            yield batch.filter(pa.array(clean))

    return df.mapInArrow(run, df.schema).toDF(*names)
