"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hourcast.sinks.util import materialize

#: Rows and bytes per Arrow batch handed to Python; long texts must not add up to gigabytes.
ARROW_ROWS = 2048
ARROW_BYTES = 16 << 20
#: A join key is hot if it has more rows than this and more than one in HOT_KEYS of all rows; so fewer than HOT_KEYS keys are.
HOT_ROWS = 1 << 20
HOT_KEYS = 4096


def prepare(spark: SparkSession) -> None:
    """Session settings of the Python stages: Arrow batches of bounded size, whatever the text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **named: str) -> DataFrame:
    """Select columns by exact name and give them the keywords' names.

    Works by position, so extra columns that repeat a name (in any case) or that
    carry the name of an output column never make a reference ambiguous; the
    first column of a repeated name is taken.
    """
    at = {out: df.columns.index(name) for out, name in named.items()}
    df = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return df.select(*[F.col(f"_{i}").alias(out) for out, i in at.items()])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda may be inlined by the optimizer and evaluated
    again for every element; a lambda variable never is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def batches_by(it: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup a partition sorted by ``key`` so that no key is split between tables.

    Holds one Arrow batch and the rows of the last key, so keys must have a
    bounded number of rows.
    """
    held: list[pa.RecordBatch] = []
    for batch in it:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        cut = _last_key_start(keys)
        if cut > 0:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _last_key_start(keys) -> int:
    """Position at which the last run of equal keys starts."""
    import numpy as np

    other = np.flatnonzero(keys != keys[-1])
    return int(other[-1]) + 1 if len(other) else 0


def ranked(df: DataFrame, order: list[str], name: str, partitions: int) -> DataFrame:
    """Adds ``_rank``, the row's 0-based place in the order of ``order``, over all rows.

    Range partitioning keeps the order across tasks and splits any hot key whose
    rows differ in a later column. The sorted rows are written once, so task
    numbers and places are fixed whatever executor is lost later; the tasks' sizes
    are then summed in two levels, so that no task sees more than the totals.
    """
    ordered = (df.repartitionByRange(partitions, *[F.col(c).asc_nulls_first() for c in order])
               .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
               .withColumn("_at", F.monotonically_increasing_id()))
    ordered = materialize(ordered, name)
    task = F.shiftright("_at", 33)
    sizes = ordered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_total(sizes, "_task", "_n", "_before")
    return (ordered.withColumn("_task", task)
            .join(F.broadcast(offsets.select("_task", "_before")), "_task")  # one row a task
            .withColumn("_rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_task", "_before", "_at"))


def join_one(many: DataFrame, one: DataFrame, key: str, how: str = "inner", rows: int | None = None) -> DataFrame:
    """``many`` joined ("inner" or "left") with ``one``, which has at most one row of bounded size a key.

    Rows of hot keys stay where they are: the few rows that ``one`` has for them are broadcast (fewer than ``HOT_KEYS``).
    All other rows meet by shuffle. Null keys match nothing. ``rows`` is the number of rows of ``many``, if known;
    both tables are read more than once, so they should be written ones or cheap.
    """
    if (many.count() if rows is None else rows) <= HOT_ROWS:  # no key can be hot
        return many.join(one, key, how)
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.agg(F.max("_n"), F.sum("_n")).first()
    if top[0] <= HOT_ROWS:
        return many.join(one, key, how)
    hot = materialize(counts.where(F.col("_n") > max(HOT_ROWS, top[1] // HOT_KEYS)).select(key, F.lit(True).alias("_hot")), "hot_keys")
    marked = many.join(F.broadcast(hot), key, "left")
    stays = F.col("_hot").isNotNull() | F.col(key).isNull()
    served = one.join(F.broadcast(hot.select(key)), key, "left_semi")
    return (marked.where(stays).drop("_hot").join(F.broadcast(served), key, how)
            .unionByName(marked.where(~stays).drop("_hot").join(one, key, how)))


def running_total(df: DataFrame, key: str, value: str, out: str, group: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows with a smaller ``key`` (a dense count).

    Groups of ``group`` neighbouring keys are summed first; only their totals meet
    in one task.
    """
    df = df.withColumn("_group", F.floor(F.col(key) / group))
    totals = df.groupBy("_group").agg(F.sum(value).alias("_total"))
    upper = totals.withColumn("_base", F.sum("_total").over(Window.orderBy("_group")) - F.col("_total"))
    inner = F.sum(value).over(Window.partitionBy("_group").orderBy(key)) - F.col(value)
    return (df.withColumn("_inner", inner).join(upper.select("_group", "_base"), "_group")
            .withColumn(out, F.col("_base") + F.col("_inner")).drop("_group", "_inner", "_base"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b), root the smallest node reachable.

    Alternating large-star and small-star steps: each round hangs the neighbours
    of a node on their smallest common neighbour, so the number of rounds grows
    with the logarithm of the longest path. Every round is written to the shared
    folder, which cuts the lineage; only a count and a checksum reach the driver.
    Nothing is gathered by node: minima are pre-aggregated and joined back, hubs without a shuffle (``join_one``).
    """
    def mark(e: DataFrame):
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    before = mark(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("m", "x"))
        large = join_one(both.where("y > x"), least, "x", rows=before[0]).select(F.col("y").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = join_one(large, small, "u", rows=before[0])
        e = materialize(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
