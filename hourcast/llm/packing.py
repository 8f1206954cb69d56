"""Best-fit packing into sequences of several permitted lengths.

Documents are placed longest first. Each goes into the open bin whose free room is
the smallest that fits. If none fits, a bin is opened whose size costs least for
every token that the documents of this length would put into it (``cost`` of a
size: its length plus a fixed charge per sequence; ties: the larger size). Of bins
with equal room the first opened is taken. At the end each bin shrinks to the smallest permitted length that holds its contents.

The packing depends on the lengths alone, so it is planned on the histogram of
lengths, which has at most as many rows as the longest permitted length: bins in
the same state form one run of bin numbers, and a step of the plan puts equal
documents into a whole run. The plan reaches the tasks as a few arrays; every
document finds its bin from its rank in the order (length descending, id, piece).
The result is the same whatever the partitioning.

A document longer than the longest permitted length is cut into pieces of that
length and a rest. One without tokens (null or empty text) has a row with length 0
and no bin. Null ids come first; repeated rows are packed one by one.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourcast.llm.common import pick, ranked
from hourcast.sinks.util import materialize

CAPACITIES = (512, 1024, 2048, 4096)
#: Tokens that a sequence costs beside its length.
SEQUENCE_COST = 64


@dataclass
class Plan:
    """Steps by the rank of their first document, and runs of bins by their first bin."""

    rank: np.ndarray      # first rank of a step
    length: np.ndarray    # length of its documents
    bin: np.ndarray       # first bin
    each: np.ndarray      # documents a bin takes
    offset: np.ndarray    # tokens already in these bins
    run: np.ndarray       # first bin of a run
    capacity: np.ndarray  # its bins' final length
    used: np.ndarray      # its bins' tokens
    bins: int             # number of bins

    def place(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bin, offset in the bin, final length of the bin) for ranks."""
        k = np.searchsorted(self.rank, rank, side="right") - 1
        nth = rank - self.rank[k]
        b = self.bin[k] + nth // self.each[k]
        at = self.offset[k] + nth % self.each[k] * self.length[k]
        return b, at, self.capacity[np.searchsorted(self.run, b, side="right") - 1]


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES,
         cost: Callable[[int], float] = lambda c: c + SEQUENCE_COST) -> Plan:
    """Best fit, longest first, over (length -> number of documents)."""
    sizes = sorted(capacities)
    rooms: list[int] = []                                  # free rooms of open bins, ascending
    runs: dict[int, list[tuple[int, int, int]]] = {}       # room -> heap of (first bin, bins, size)
    steps, closed, bins, rank = [], [], 0, 0

    def put(room: int, first: int, n: int, size: int) -> None:
        if n and not room:
            closed.append((first, size, size))
        elif n:
            if room not in runs:
                insort(rooms, room)
            heapq.heappush(runs.setdefault(room, []), (first, n, size))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                size = min((c for c in sizes if c >= length),
                           key=lambda c: (cost(c) / (length * min(left, c // length)), -c))
                most = max(sizes) // length  # while no bin could take all that is left, the choice stays
                n = max(1, (left - most) // (size // length) + 1)
                put(size, bins, n, size)
                bins += n
                continue
            room = rooms[at]
            first, n, size = heapq.heappop(runs[room])
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            each = room // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0   # documents of one more, partly filled bin
            for m, take in ((full, each), (1, rest)):
                if m and take:
                    steps.append((rank, length, first, take, size - room))
                    rank += m * take
                    left -= m * take
                    put(room - take * length, first, m, size)
                    first, n = first + m, n - m
            put(room, first, n, size)
    closed += [(first, size, size - room) for room, group in runs.items() for first, n, size in group]
    closed.sort()
    step = np.array(steps, dtype=np.int64).reshape(-1, 5).T
    run = np.array(closed, dtype=np.int64).reshape(-1, 3).T
    shrunk = np.array(sizes, dtype=np.int64)[np.searchsorted(sizes, run[2])]
    return Plan(*step, run[0], shrunk, run[2], bins)


def pack(df: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens",
         capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """(id, piece, n_tokens, bin_id, offset, capacity) for every piece of every row.

    ``df`` should be cheap to read again (a table of lengths).
    """
    spark = df.sparkSession
    longest = max(capacities)
    d = pick(df, id=id_col, n=length_col).select("id", F.greatest(F.coalesce(F.col("n").cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    pieces = d.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0)))))
    pieces = pieces.select("id", F.col("piece").cast("long").alias("piece"),
                           F.least(F.lit(longest), F.col("n") - F.col("piece") * longest).cast("long").alias("n_tokens"))
    pieces = materialize(pieces, "pieces")
    histogram = {r["n_tokens"]: r["n"] for r in pieces.where("n_tokens > 0").groupBy("n_tokens")
                 .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``longest`` rows
    steps = plan(histogram, capacities)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = pieces.where("n_tokens > 0").withColumn("down", -F.col("n_tokens"))
    order = ranked(order, ["down", "id", "piece"], "packing_order", partitions).select("id", "piece", "n_tokens", "_rank")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            places = steps.place(batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, places)],
                                             names=["id", "piece", "n_tokens", "bin_id", "offset", "capacity"])

    id_type = pieces.schema["id"].dataType.simpleString()
    packed = order.mapInArrow(run, f"id {id_type}, piece long, n_tokens long, bin_id long, offset long, capacity long")
    none = F.lit(None).cast("long")
    empty = pieces.where("n_tokens = 0").select("id", "piece", "n_tokens", none.alias("bin_id"), none.alias("offset"), none.alias("capacity"))
    return packed.unionByName(empty)
