"""Token ids in files, compressed by Re-Pair grammars with random access.

Texts are tokenized in ascending order of id and cut into shards of whole documents
(``SHARD_TOKENS`` ids; a longer document is a shard of its own). Within a shard the
most frequent pairs of neighbouring ids are replaced by new symbols, round after
round, until no pair is frequent enough to pay for its rule. A shard stores its
alphabet, the rules, how many ids each rule expands to, the remaining sequence and
its documents' ids and lengths. Running sums of the expansion lengths lead from any
position to the symbols that cover it, so a range is decoded without the rest of the
sequence (a read expands the shard's rules, which are few, once).

Files are Parquet with one row a shard: task and number of the shard, its ids'
count, and the shard in the binary layout of ``Shard.pack``. They are written by
Spark's committer, so a lost executor leaves no half-written shard.

Null texts count as empty; every document ends with ``END``, so none is without
ids. Null ids come first. Rows with equal id are ordered by their text's hash.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hourcast.llm.common import pick, prepare, running_total
from hourcast.llm.token_count import split_words

END = 1
SHARD_TOKENS = 1 << 17
#: Uses that make a rule worth its place.
MIN_USES = 8
PAIRS_PER_ROUND = 1024
#: Words whose ids a worker remembers, in two halves: those of late, and those before them.
MEMO = 1_000_000
MAGIC = b"RPS1"


#: A word of Latin letters, perhaps with stops or commas after it.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]*)")
#: Put between words that are encoded together; alone it is one id.
MARK = "\x01"


#: Settings under which a text's ids are its words' ids: white space is dropped, letters are lower-cased, and
#: runs of letters and of other characters are never joined (fixed values of the public word vocabulary).
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


class Encoder:
    """The tokenizers library, asked once for every word where the tokenizer's settings are ``WORDWISE``.

    Then a text's ids are its words' ids one after the other, and "Word," is looked up as "word"
    and ",": fewer words to ask for, the same ids. With any other settings whole texts are encoded.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.wordwise = all(settings.get(k) == v for k, v in WORDWISE.items()) and not settings["model"].get("dropout")
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids

    def ask(self, words: list[str], step: int = 256) -> None:
        """Put the words' ids into the memory; many words go into one call, apart by a mark."""
        plain = [w for w in words if MARK not in w] if len(self.mark) == 1 else []
        texts = [f" {MARK} ".join(plain[i:i + step]) for i in range(0, len(plain), step)]
        for k, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            cut = [-1, *np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)]
            data = ids.tobytes()
            for w, i, j in zip(plain[k * step:(k + 1) * step], cut[:-1], cut[1:], strict=True):
                self.memo[w] = data[4 * (i + 1):4 * j]
        rest = [w for w in words if w not in self.memo]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.memo[w] = np.array(e.ids, dtype="<u4").tobytes()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, with the end ids; ids of each text)."""
        if not self.wordwise:
            coded = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            each = [np.array([*e.ids, END], dtype="<u4") for e in coded]
            return (np.concatenate(each) if each else np.empty(0, dtype="<u4")), np.array([len(x) for x in each], dtype=np.int64)
        words, per_text = split_words(texts)
        coded = words.dictionary_encode()
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far faster than to_pylist
        memo, older = self.memo, self.older
        parts = list(map(memo.get, known))
        split = {}  # words not seen before, as letters and what follows
        for i, data in enumerate(parts):
            if data is None:
                if (data := older.get(known[i])) is not None:
                    parts[i] = memo[known[i]] = data  # used again: it stays
                    continue
                m = PLAIN.fullmatch(known[i])
                split[i] = (m[1].lower(), m[2]) if m else (known[i],)
        unknown = []
        for x in dict.fromkeys(x for two in split.values() for x in two):
            if x not in memo:
                if (data := older.get(x)) is not None:
                    memo[x] = data
                else:
                    unknown.append(x)
        self.ask(unknown)
        for i, two in split.items():
            parts[i] = memo[known[i]] = b"".join([memo[x] for x in two])
        if len(memo) > MEMO // 2:
            self.memo, self.older = {}, memo
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), dtype="<u4")
        first = np.cumsum(size) - size
        # every text is its words and one end id, which stands behind the dictionary's ids
        flat = np.append(flat, np.uint32(END))
        size, first = np.append(size, 1), np.append(first, len(flat) - 1)
        at = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(per_text), len(known))
        n = size[at]
        start = np.cumsum(n) - n
        ids = flat[np.repeat(first[at] - start, n) + np.arange(int(n.sum()))]
        total = np.append(start, len(ids))
        last = np.cumsum(per_text + 1)
        return ids, total[last] - total[last - per_text - 1]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass
class Shard:
    """Symbols below ``len(alphabet)`` are ids; the others are rules, in order of making."""

    alphabet: np.ndarray
    rules: np.ndarray    # (rules, 2) symbols
    lengths: np.ndarray  # ids a rule expands to
    sequence: np.ndarray
    docs: np.ndarray     # ids of the documents
    no_id: np.ndarray    # whose id is null
    sizes: np.ndarray    # ids of each document

    @classmethod
    def build(cls, ids: np.ndarray, docs: np.ndarray, no_id: np.ndarray, sizes: np.ndarray) -> "Shard":
        return cls(*re_pair(ids), docs, no_id, sizes)

    def pack(self) -> bytes:
        """Magic; counts; alphabet, rules and lengths (u32); symbol width; sequence; documents (i64, u8, u32)."""
        wide = len(self.alphabet) + len(self.rules) > 1 << 16
        head = struct.pack("<4s4IB", MAGIC, len(self.alphabet), len(self.rules), len(self.sequence), len(self.docs), wide)
        return b"".join([head, *(x.astype(t).tobytes() for x, t in (
            (self.alphabet, "<u4"), (self.rules, "<u4"), (self.lengths, "<u4"),
            (self.sequence, "<u4" if wide else "<u2"), (self.docs, "<i8"), (self.no_id, "u1"), (self.sizes, "<u4")))])

    @classmethod
    def unpack(cls, data: bytes) -> "Shard":
        magic, letters, rules, symbols, docs, wide = struct.unpack_from("<4s4IB", data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at, out = struct.calcsize("<4s4IB"), []
        for n, t in ((letters, "<u4"), (2 * rules, "<u4"), (rules, "<u4"), (symbols, "<u4" if wide else "<u2"),
                     (docs, "<i8"), (docs, "u1"), (docs, "<u4")):
            out.append(np.frombuffer(data, dtype=t, count=n, offset=at))
            at += out[-1].nbytes
        return cls(out[0], out[1].reshape(-1, 2), out[2], out[3], out[4], out[5].astype(bool), out[6])

    def decode(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``: all rules are expanded once, of the sequence only the symbols that cover them."""
        size = np.concatenate((np.ones(len(self.alphabet), dtype=np.int64), self.lengths.astype(np.int64)))
        end = np.cumsum(size[self.sequence])
        total = int(end[-1]) if len(end) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return self.alphabet[:0]
        a, b = np.searchsorted(end, start, side="right"), np.searchsorted(end, stop - 1, side="right") + 1
        before = int(end[a - 1]) if a else 0
        seq = self.sequence[a:b]
        first = np.concatenate((np.arange(len(self.alphabet)), len(self.alphabet) + np.cumsum(self.lengths, dtype=np.int64) - self.lengths))
        n = size[seq]
        at = np.repeat(first[seq] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self._ids_of_symbols()[at[start - before:stop - before]]

    def _ids_of_symbols(self) -> np.ndarray:
        """The alphabet, then every rule's ids: rules are few, so they are expanded once, all together."""
        seq, k = self.rules.astype(np.int64).ravel(), len(self.alphabet)
        while (rule := seq >= k).any():
            at = np.cumsum(1 + rule) - 1 - rule
            out = np.empty(len(seq) + int(rule.sum()), dtype=np.int64)
            out[at[~rule]] = seq[~rule]
            out[at[rule]], out[at[rule] + 1] = self.rules[seq[rule] - k].T
            seq = out
        return np.concatenate((self.alphabet, self.alphabet[seq]))


def re_pair(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, rules, expansion lengths, sequence); each round replaces the most frequent pairs."""
    if len(ids) and ids.max() < 1 << 20:  # a table instead of a sort
        place = np.zeros(int(ids.max()) + 1, dtype=np.int64)
        place[ids] = 1
        alphabet = np.flatnonzero(place)
        place[alphabet] = np.arange(len(alphabet))
        seq = place[ids]
    else:
        alphabet, seq = np.unique(ids, return_inverse=True)
        seq = seq.astype(np.int64)
    n, rules, lengths = len(alphabet), [], np.ones(len(alphabet), dtype=np.int64)
    while len(seq) >= MIN_USES:  # every round makes the sequence shorter
        code = seq[:-1] * n + seq[1:]
        bucket = (code * 0x9E3779B1 >> 7) & 0x3FFFF  # pairs in a rare bucket are rare
        at = np.flatnonzero(np.bincount(bucket, minlength=0x40000)[bucket] >= MIN_USES)
        code = code[at]
        ordered = np.sort(code)
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.empty(0, int)
        count = np.diff(np.append(first, len(ordered)))
        often = count >= MIN_USES
        pairs, count = ordered[first[often]], count[often]
        if not len(pairs):
            break
        if len(pairs) > PAIRS_PER_ROUND:
            pairs = np.sort(pairs[np.argsort(-count, kind="stable")[:PAIRS_PER_ROUND]])
        chosen = np.zeros(0x40000, dtype=bool)
        chosen[(pairs * 0x9E3779B1 >> 7) & 0x3FFFF] = True
        may = chosen[bucket[at]]
        at, code = at[may], code[may]
        which = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
        hit = pairs[which] == code
        at, which = at[hit], which[hit]
        # of neighbouring places every second one, from the left
        starts = np.concatenate(([True], at[1:] != at[:-1] + 1))
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        free = (np.arange(len(at)) - run) % 2 == 0
        at, which = at[free], which[free]
        used = np.bincount(which, minlength=len(pairs)) >= MIN_USES
        if not used.any():
            break
        at, which = at[used[which]], which[used[which]]
        name = n + np.cumsum(used) - 1
        left, right = np.divmod(pairs[used], n)
        rules.append(np.stack([left, right], axis=1))
        lengths = np.append(lengths, lengths[left] + lengths[right])
        seq[at] = name[which]
        seq = np.delete(seq, at + 1)
        n += int(used.sum())
    return alphabet, np.concatenate(rules) if rules else np.empty((0, 2), dtype=np.int64), lengths[len(alphabet):], seq


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every text and write the shards to ``path`` in ascending order of id.

    ``tokenizer`` is a file on every executor. Range partitioning deals the documents
    out in order; a task sorts its range, so shards follow each other by (task, shard).
    """
    spark = df.sparkSession
    prepare(spark)
    d = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encode, shard, held = TaskContext.get().partitionId(), encoder(tokenizer or default_tokenizer()), 0, []

        def build() -> pa.RecordBatch:
            nonlocal shard
            ids, docs, no_id, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            shard += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([shard - 1], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([Shard.build(ids, docs, no_id, sizes).pack()], pa.binary())],
                names=["task", "shard", "n_tokens", "data"])

        room = shard_tokens
        for batch in it:
            ids, sizes = encode(batch.column("text"))
            docs = batch.column("id")
            no_id = docs.is_null().to_numpy(zero_copy_only=False)
            docs = docs.fill_null(0).to_numpy()
            end, a = np.cumsum(sizes), 0
            while a < len(sizes):  # as many whole documents as there is room for
                base = end[a] - sizes[a]
                b = int(np.searchsorted(end, base + room, side="right"))
                if b == a and held:
                    yield build()
                    room = shard_tokens
                    continue
                b = max(b, a + 1)
                held.append((ids[base:end[b - 1]], docs[a:b], no_id[a:b], sizes[a:b]))
                room -= int(end[b - 1] - base)
                a = b
                if room <= 0:
                    yield build()
                    room = shard_tokens
        if held:
            yield build()

    ordered = d.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, "task int, shard int, n_tokens long, data binary").write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the files of ``path``."""
    shards = spark.read.parquet(path)
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # shards of up to a megabyte

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for task, number, data in zip(*(batch.column(c).to_pylist() for c in ("task", "shard", "data")), strict=True):
                s = Shard.unpack(data)
                ids = s.decode().astype("<u4")
                end = np.cumsum(s.sizes.astype(np.int64))
                first = end - s.sizes
                crc = [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(first.tolist(), end.tolist(), strict=True)]
                n = len(s.docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task, dtype=np.int32)), pa.array(np.full(n, number, dtype=np.int32)),
                     pa.array(s.docs, mask=s.no_id), pa.array(first), pa.array(s.sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["task", "shard", "id", "first", "n_tokens", "ids_crc32"])

    docs = shards.select("task", "shard", "data").mapInArrow(
        run, "task int, shard int, id long, first long, n_tokens long, ids_crc32 long")
    sizes = shards.select("task", "shard", "n_tokens")
    tasks = running_total(sizes.groupBy("task").agg(F.sum("n_tokens").alias("n")), "task", "n", "before_task")
    inner = F.sum("n_tokens").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_tokens")
    before = (sizes.withColumn("inner", inner).join(tasks.select("task", "before_task"), "task")
              .select("task", "shard", (F.col("before_task") + F.col("inner")).alias("before")))
    return (docs.join(before, ["task", "shard"])
            .select("id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))
