"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of documents. Time goes in rounds of one window (a sequence of
``CAPACITY`` tokens): each round a queue's deficit grows by its quantum, its
target share of a window, and the queue hands on as many grains of ``GRAIN`` tokens as its deficit
holds; the rest of the deficit is carried on to the next round. What the queues hand on, in
order, fills window after window; a round that does not fit goes on in the next window. A queue
that has run dry drops out, and the others fill the windows in their own proportions.

After r rounds a queue has handed on GRAIN * floor(r * quantum / GRAIN) tokens, or
all it has. So the deficits at the start of any window or partition follow from the
queues' totals alone: every task finds the place of its documents' tokens by itself, and
carries the deficits over its windows as one pass over all of them would.
Deficits are kept in whole units (shares in ``UNITS``-ths), not in floating point.

Documents are cut where a queue's turn or a window ends, and nowhere else. Every window is full;
what is left at the end is cut into sequences of falling powers of two, so there is no padding.

Targets are the sources' shares of all tokens, or ``weights`` (source -> weight). A
source with a target below one token a window is no queue of its own: these (and, with
``weights``, all that are not named) form one joint queue, so there are at most
``CAPACITY`` + 1 queues, or one more than weights. With ``weights``, the joint queue's target is
its share of the tokens. No queue's target is less than one unit.

A queue's order is that of the scan: by task, then by row. Texts are tokenized once, in
place, and written with their place in their task. Sums by (task, source) are exchanged, and
joined to the written ids: sent to all tasks while they are below the planner's broadcast
threshold, beyond it the ids are shuffled once by (task, source). Texts are never exchanged.

Null texts count as empty; every document ends with ``END``, so none is without ids.
A null source is a source. Null ids and repeated rows are documents of their own. An
empty table gives no row. Further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hourcast.llm.common import pick, prepare
from hourcast.llm.token_store import default_tokenizer, encoder
from hourcast.sinks.util import materialize

CAPACITY = 2048
GRAIN = 64
UNITS = 1 << 20
#: Tasks whose sums are added up first.
GROUP = 1024


@dataclass
class Rounds:
    """The queues' rounds: ``weight`` in units (of ``units`` in all), ``total`` tokens of each queue."""

    weight: np.ndarray
    total: np.ndarray
    capacity: int = CAPACITY
    grain: int = GRAIN

    def __post_init__(self) -> None:
        self.gain = self.capacity * self.weight           # a round's gain, in units
        self.price = self.grain * int(self.weight.sum())  # of a grain, in units

    def served(self, r: np.ndarray) -> np.ndarray:
        """(rounds, queues) tokens handed on after ``r`` rounds."""
        whole, rest = np.divmod(r[:, None], self.price)   # in two parts, so that no product overflows
        grains = whole * self.gain + rest * self.gain // self.price
        return np.minimum(np.minimum(grains, -(-self.total // self.grain)) * self.grain, self.total)

    def round_of(self, queue: np.ndarray, grain: np.ndarray) -> np.ndarray:
        """The round (from 1) in which a queue hands on its grain of that number (from 0)."""
        gain = self.gain[queue]
        whole, rest = np.divmod(grain + 1, gain)
        return whole * self.price - (-rest * self.price // gain)

    def begins(self, queue: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the order of all tokens, tokens handed on before) of the queue's turn in round ``r``."""
        rounds, at = np.unique(r, return_inverse=True)
        place, before = np.empty(len(r), dtype=np.int64), np.empty(len(r), dtype=np.int64)
        step = max(1, (1 << 21) // len(self.weight))
        order = np.argsort(at, kind="stable")
        cut = np.searchsorted(at[order], np.arange(0, len(rounds) + step, step))
        for k, a in enumerate(range(0, len(rounds), step)):
            now, last = self.served(rounds[a:a + step]), self.served(rounds[a:a + step] - 1)
            zero = np.zeros((len(now), 1), dtype=np.int64)
            ahead = np.hstack([zero, np.cumsum(now, axis=1)])           # queues before it are through
            behind = last.sum(axis=1, keepdims=True) - np.hstack([zero, np.cumsum(last, axis=1)])
            mine = order[cut[k]:cut[k + 1]]
            i, q = at[mine] - a, queue[mine]
            place[mine], before[mine] = ahead[i, q] + behind[i, q], last[i, q]
        return place, before


def place_documents(rounds: Rounds, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first token, tokens, place) of the pieces that turns cut documents into.

    A document holds the tokens ``start`` to ``start`` + ``n`` of its queue.
    """
    g = rounds.grain
    first, last = start // g, (start + n - 1) // g
    count = last - first + 1
    doc = np.repeat(np.arange(len(n)), count)
    grain = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    r = rounds.round_of(queue[doc], grain)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (r[1:] != r[:-1])))[:len(doc)]
    doc, grain, r = doc[new], grain[new], r[new]
    begin = np.maximum(grain * g, start[doc])
    place, before = rounds.begins(queue[doc], r)
    place = place + begin - before
    end = np.append(begin[1:], 0)
    is_last = np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    end[is_last] = (start + n)[doc[is_last]]
    return doc, begin - start[doc], end - begin, place


def sequence_starts(total: int, capacity: int = CAPACITY) -> np.ndarray:
    """Places at which the sequences after the full windows start: falling powers of two."""
    at, left, out = total - total % capacity, total % capacity, []
    while left:
        size = 1 << (left.bit_length() - 1)
        out.append(at)
        at, left = at + size, left - size
    return np.array(out, dtype=np.int64)


def cut_at_windows(doc, first, n, place, total: int, capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """(document, first token, tokens, sequence, offset): pieces cut where sequences end, neighbours joined."""
    full, tail = total // capacity, sequence_starts(total, capacity)
    end = place + n

    def sequence(at):
        return np.where(at < full * capacity, at // capacity, full + np.searchsorted(tail, at, side="right") - 1)

    def begin(s):
        return np.where(s < full, s * capacity, np.append(tail, total)[np.clip(s - full, 0, len(tail))])

    head = sequence(place)
    parts = sequence(end - 1) - head + 1
    k = np.repeat(np.arange(len(n)), parts)
    s = head[k] + np.arange(len(k)) - np.repeat(np.cumsum(parts) - parts, parts)
    a, b = np.maximum(place[k], begin(s)), np.minimum(end[k], begin(s + 1))
    doc, first, n, offset = doc[k], first[k] + a - place[k], b - a, a - begin(s)
    # turns that follow each other directly (the other queues have run dry) are one piece
    go_on = np.append(False, (doc[1:] == doc[:-1]) & (s[1:] == s[:-1]) & (offset[1:] == offset[:-1] + n[:-1]))[:len(doc)]
    head = np.flatnonzero(~go_on)
    return doc[head], first[head], np.add.reduceat(n, head) if len(head) else n, s[head], offset[head]


def tokens_in_place(df: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer: str) -> DataFrame:
    """(id, source, task, before, n, ids): every text's ids, and how many its source has before it in the task."""
    d = pick(df, id=id_col, text=text_col, source=source_col)
    d = d.select("id", "text", F.col("source").cast("string").alias("source"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encode, held = TaskContext.get().partitionId(), encoder(tokenizer), {}
        for batch in it:
            if not len(batch):
                continue
            ids, n = encode(batch.column("text"))
            before = []
            for s, k in zip(batch.column("source").to_pylist(), n.tolist(), strict=True):
                before.append(held.get(s, 0))
                held[s] = before[-1] + k
            small = not len(ids) or int(ids.max()) < 1 << 16
            data = ids.astype("<u2" if small else "<u4").tobytes()
            ends = np.concatenate(([0], np.cumsum(n) * (2 if small else 4)))
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("source"), pa.array(np.full(len(n), task, dtype=np.int32)),
                 pa.array(before, pa.int64()), pa.array(n.astype(np.int64)), data.cast(pa.binary())],
                names=["id", "source", "task", "before", "n", "ids"])

    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"id {kind}, source string, task int, before long, n long, ids binary")


def _queues(sources: DataFrame, weights: dict | None, capacity: int) -> tuple[dict, np.ndarray, np.ndarray]:
    """(source -> queue, weights in units, tokens) from (source, n); the joint queue is the last one."""
    total = sources.agg(F.sum("n")).first()[0] or 0
    if weights is None:  # at most ``capacity`` sources have so large a share
        own = {r["source"]: r["n"] for r in sources.where(F.col("n") * capacity >= F.lit(total)).collect()}
        share = {s: n / total for s, n in own.items()}
    else:
        whole = sum(weights.values())
        share = {s: w / whole for s, w in weights.items() if w * capacity >= whole}
        names = [s for s in share if s is not None]
        named = F.col("source").isin(names) | (F.col("source").isNull() if None in share else F.lit(False))
        own = {r["source"]: r["n"] for r in sources.where(named).collect()}
        share = {s: share[s] for s in own}
    order = sorted(own, key=lambda s: (-share[s], s is None, s or ""))
    rest = total - sum(own.values())
    tokens = np.array([own[s] for s in order] + [rest], dtype=np.int64)
    parts = [share[s] for s in order] + [rest / max(total, 1)]
    units = np.maximum(1, np.rint(np.array(parts) * UNITS)).astype(np.int64)
    return {s: k for k, s in enumerate(order)}, units, tokens


def _bases(sums: DataFrame) -> DataFrame:
    """(task, source, base): tokens of the queue before the task's first document of that source.

    ``sums`` has (task, source, queue, n). Sums of ``GROUP`` tasks are added up first, so
    no task sees more than a group's or the groups' totals of a queue.
    """
    by_task = sums.groupBy("queue", "task").agg(F.sum("n").alias("of_task")).withColumn("group", F.floor(F.col("task") / GROUP))
    groups = by_task.groupBy("queue", "group").agg(F.sum("of_task").alias("of_group"))
    upper = groups.select("queue", "group", (F.sum("of_group").over(Window.partitionBy("queue").orderBy("group")) - F.col("of_group")).alias("upper"))
    inner = F.sum("of_task").over(Window.partitionBy("queue", "group").orderBy("task")) - F.col("of_task")
    tasks = by_task.withColumn("inner", inner).join(upper, ["queue", "group"]).select("queue", "task", (F.col("upper") + F.col("inner")).alias("ahead"))
    within = F.sum("n").over(Window.partitionBy("queue", "task").orderBy(F.col("source").asc_nulls_first())) - F.col("n")
    return (sums.withColumn("within", within).join(tasks, ["queue", "task"])
            .select("task", "source", "queue", (F.col("ahead") + F.col("within")).alias("base")))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: dict | None = None, tokenizer: str | None = None, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """(id, source, start, length, ids, doc_tokens, sequence_id, offset): a row for every piece.

    ``ids`` are the piece's ids, little-endian unsigned 32-bit integers. ``tokenizer`` is a file on every executor.
    """
    spark = df.sparkSession
    prepare(spark)
    docs = materialize(tokens_in_place(df, id_col, text_col, source_col, tokenizer or default_tokenizer()), "tokens")
    sums = materialize(docs.groupBy("task", "source").agg(F.sum("n").alias("n")), "token_sums")
    number, units, tokens = _queues(sums.groupBy("source").agg(F.sum("n").alias("n")), weights, capacity)
    joint, total = len(units) - 1, int(tokens.sum())
    rounds = Rounds(units, tokens, capacity, grain)
    queue = F.lit(joint)
    if number:  # at most ``capacity`` entries
        listed = F.create_map(*[x for s, k in number.items() if s is not None for x in (F.lit(s), F.lit(k))]) if set(number) - {None} else None
        queue = F.coalesce(F.try_element_at(listed, F.col("source")), F.lit(joint)) if listed is not None else queue
        queue = F.when(F.col("source").isNull(), F.lit(number.get(None, joint))).otherwise(queue)
    bases = _bases(sums.withColumn("queue", queue.cast("int")))
    known = F.coalesce("source", F.lit("")), F.col("source").isNull()  # a null source joins itself
    bases = bases.select("task", "queue", "base", known[0].alias("_s"), known[1].alias("_no"))
    placed = docs.withColumns({"_s": known[0], "_no": known[1]}).join(bases, ["task", "_s", "_no"])
    placed = placed.select("id", "source", "queue", (F.col("base") + F.col("before")).alias("start"), "n", "ids")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not len(batch):
                continue
            n, start, of = (batch.column(c).to_numpy() for c in ("n", "start", "queue"))
            doc, first, size, place = place_documents(rounds, of.astype(np.int64), start, n)
            doc, first, size, sequence, offset = cut_at_windows(doc, first, size, place, total, capacity)
            ids = [np.frombuffer(b.as_buffer(), dtype="<u2" if len(b.as_buffer()) == 2 * k else "<u4").astype("<u4").tobytes()
                   for b, k in zip(batch.column("ids"), n.tolist(), strict=True)]
            pieces = [ids[d][4 * a:4 * (a + k)] for d, a, k in zip(doc.tolist(), first.tolist(), size.tolist(), strict=True)]
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("source").take(at), pa.array(first), pa.array(size), pa.array(pieces, pa.binary()),
                 pa.array(n[doc]), pa.array(sequence), pa.array(offset)],
                names=["id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"id {kind}, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
