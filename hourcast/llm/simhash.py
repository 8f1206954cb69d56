"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Fingerprints: a text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+``
and hashed by shingles of ``shingle`` words (XXH64, seed 42; repeats count). A bit
is 1 if it is set in over half the hashes. A text with fewer words is one
shingle; one without words (or null) has fingerprint zero and links like any other.

Links: all pairs of *different* fingerprints at ``radius`` bits or fewer, found
exactly. The 64 bits are cut into more blocks than the radius, so two linked
fingerprints agree on all but ``radius`` blocks; rows are dealt out by every
choice of that many agreeing blocks. The rows of one cell are sorted by their
count of set bits and compared in tiles with exclusive-or and bit counts; a pair
of tiles whose bit counts differ beyond the radius is skipped. A cell with more
than ``TILE_ROWS`` rows (a hot group) is cut by bit count and salt, and only pairs
of such parts within the radius meet, in tasks of their own. From each cell
comes a spanning forest of its links, not the pairs.

Equal fingerprints are merged before any comparison, so copies cost one row.
Components use every link. Null ids keep their row; they take the smallest
non-null id of their component (null if there is none). Repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hourcast.llm.common import batches_by, connected_components, join_one, pick, prepare
from hourcast.sinks.util import materialize

SHINGLE = 4
RADIUS = 4
#: Rows of a cell, or of a part of a hot cell.
TILE_ROWS = 1024
#: Side of the tiles that are compared at once.
TILE = 256
#: Blocks are added until a cell holds about this many rows if bits were even.
CELL_ROWS = 4096

_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def hashes_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of a text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    digest = xxhash.xxh64_intdigest
    spans = zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist(), strict=True)
    return np.fromiter((digest(joined[i:j], 42) for i, j in spans), dtype=np.uint64, count=len(words) - shingle + 1)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    # each byte of a hash becomes eight byte-wide counters, which hold 255 rows
    lanes = _LANES[hashes.astype("<u8").view(np.uint8)].reshape(n, 8)
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    counts = np.ascontiguousarray(sums.astype("<u8")).view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp) for every row; ``fp`` is the fingerprint as a signed long."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fp = np.array([majority(hashes_of(x.as_py(), shingle)) for x in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp.view(np.int64))], names=["id", "text_hash", "fp"])

    return d.mapInArrow(run, "id long, text_hash long, fp long")


def _schemes(radius: int, n: int) -> list[tuple[int, ...]]:
    """Masks (as block lists) such that linked fingerprints agree on one of them at least."""
    for blocks in range(radius + 1, 17):
        keep = blocks - radius
        if n <= CELL_ROWS << (64 * keep // blocks):
            break
    edge = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edge[b + 1] - edge[b])) - 1) << edge[b] for b in chosen)
             for chosen in combinations(range(blocks), keep)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _cells(fps: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Deal distinct fingerprints out to cells (cell, side, pop, fp)."""
    masks = _schemes(radius, fps.count())
    pop = F.bit_count("fp").cast("int")
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("v"))
                               for i, m in enumerate(masks)]))
    rows = fps.select("fp", pop.alias("pop"), keys.alias("k")).select("fp", "pop", F.col("k.c").alias("c"), F.col("k.v").alias("v"))
    counts = rows.groupBy("c", "v", "pop").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("c", "v").agg(
        F.sum("n").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile_rows).cast("int").alias("parts")))).alias("parts"),
    ).where("total > 1")  # at most 65 bit counts a key
    rows = rows.join(total, ["c", "v"])
    salt = lambda parts: F.pmod(F.xxhash64("fp"), parts).cast("int")
    own = F.struct(F.col("pop").alias("p"), salt(F.col("parts")[F.col("pop")]).alias("s"))

    def partners() -> Column:
        near = F.filter(F.map_entries("parts"), lambda e: F.abs(e["key"] - F.col("pop")) <= radius)
        return F.flatten(F.transform(near, lambda e: F.transform(
            F.sequence(F.lit(0), e["value"] - 1), lambda s: F.struct(e["key"].alias("p"), s.alias("s")))))

    small = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("s")))
    rows = rows.withColumn("hot", F.col("total") > tile_rows)
    rows = rows.withColumn("own", F.when(F.col("hot"), own).otherwise(small[0]))
    rows = rows.withColumn("other", F.explode(F.when(F.col("hot"), partners()).otherwise(small)))
    return rows.select(
        F.xxhash64("c", "v", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "pop", "fp")


def cell_links(fp: np.ndarray, pop: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (a, b) of the links within one cell.

    Rows of two sides are compared across the sides, rows of one side among themselves.
    """
    order = np.lexsort((pop, side))
    fp, pop, side = fp[order], pop[order], side[order]
    cut = int(np.searchsorted(side, 1))
    cross = 0 < cut < len(fp)
    left = [(i, min(i + TILE, cut)) for i in range(0, cut, TILE)] if cross else [(i, min(i + TILE, len(fp))) for i in range(0, len(fp), TILE)]
    right = [(j, min(j + TILE, len(fp))) for j in range(cut, len(fp), TILE)] if cross else left
    found = []
    for i0, i1 in left:
        for j0, j1 in right:
            if not cross and j0 < i0:
                continue
            if pop[j0] - pop[i1 - 1] > radius or pop[i0] - pop[j1 - 1] > radius:
                continue
            near = np.bitwise_count(fp[i0:i1, None] ^ fp[None, j0:j1]) <= radius
            a, b = np.nonzero(near)
            a, b = a + i0, b + j0
            off = a != b if cross else a < b
            found.append((a[off], b[off]))
    a = np.concatenate([x for x, _ in found]) if found else np.empty(0, dtype=np.int64)
    b = np.concatenate([y for _, y in found]) if found else np.empty(0, dtype=np.int64)
    if not len(a):
        return fp[:0], fp[:0]
    label = np.arange(len(fp))
    while True:  # smallest index reachable, by links and by the labels' own labels
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(fp)))
    return fp[label[member]], fp[member]


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``fps.fp`` that connect what is linked."""
    prepare(fps.sparkSession)
    fps.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    cells = _cells(fps, radius, tile_rows)
    dealt = cells.repartition("cell").sortWithinPartitions("cell")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches_by(it, "cell"):
            cell = t["cell"].to_numpy()
            fp = t["fp"].to_numpy().view(np.uint64)
            pop, side = t["pop"].to_numpy(), t["side"].to_numpy()
            at = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
            out = [cell_links(fp[i:j], pop[i:j], side[i:j], radius)
                   for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) if j - i > 1]
            if out:
                a, b = (np.concatenate([x[k] for x in out]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, text_hash, fp, root, component) per row.

    ``component`` is the smallest id reachable by links, ``root`` names the class
    itself (ids may repeat or be null, so two classes may show the same component).
    """
    docs = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    reps = materialize(docs.groupBy("fp").agg(F.min("id").alias("rep")), "distinct_fps")
    roots = connected_components(links(reps.select("fp"), radius, tile_rows)).withColumnRenamed("node", "fp")
    reps = materialize(reps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted_fps")
    least = reps.groupBy("root").agg(F.min("rep").alias("component"))
    named = materialize(join_one(reps, least, "root").select("fp", "root", "component"), "components")
    return join_one(docs, named, "fp").select("id", "text_hash", "fp", "root", "component")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """One row of every class, with all its columns: the smallest id's (then the smallest text hash's).

    A null id comes after all others. Of equal rows of that id and text one is kept.
    """
    found = near_duplicates(df, id_col, text_col, shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k"))
    place = ["_none", "_key", "_text"]  # never null, so the join and the removal of equal rows share one shuffle of the texts
    first = first.select(F.col("k.none").alias("_none"), F.coalesce("k.id", F.lit(0)).alias("_key"), F.col("k.text_hash").alias("_text")).distinct()
    names = df.columns
    d = df.toDF(*[f"_{i}" for i in range(len(names))])
    key = F.col(f"_{names.index(id_col)}").cast("long")
    d = d.withColumns({"_none": key.isNull(), "_key": F.coalesce(key, F.lit(0)), "_text": F.xxhash64(f"_{names.index(text_col)}")})
    return d.join(first, place, "left_semi").dropDuplicates(place).drop(*place).toDF(*names)
