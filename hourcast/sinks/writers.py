"""Partitioned Parquet sinks (IO-07..IO-10, IO-11, IO-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourcast.schemas import NATIVE_VARIABLES
from hourcast.sinks.positional import write_positional
from hourcast.sources.datasets import listed_sites, missing_partitions, read_dataset, read_if_exists


def write_partitioned(df: DataFrame, root: str, partition_cols: list[str],
                      sort_cols: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write Parquet partitioned by ``partition_cols``.

    Overwrite is *dynamic*: only partitions present in ``df`` are replaced.
    Rows are rebalanced on the partition columns first (AQE splits a hot
    partition into several files instead of one huge task), then sorted within
    each task so files are ordered.
    """
    out = df.hint("rebalance", *partition_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    (out.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .parquet(root))


def write_stage2(df: DataFrame, root: str) -> None:
    """IO-07: stage-2 layout reference_datetime=/site_id=."""
    write_partitioned(df, root, ["reference_datetime", "site_id"], ["variable", "parameter", "datetime"])


def write_stage3(df: DataFrame, root: str) -> None:
    """IO-08 / IO-10: stage-3 layout site_id=, rows sorted by variable, datetime, parameter."""
    write_partitioned(df, root, ["site_id"], ["variable", "datetime", "parameter"])


def write_positional_runs(df: DataFrame, root: str, keys=("cycle", "start_date", "site_id")) -> None:
    """IO-09: one ``part-0.parquet`` for each (cycle, date, site), in folders of bare values (``read_positional`` reads them)."""
    write_positional(df, root, list(keys), ["variable", "parameter", "datetime"])


def land_forecast(raw: DataFrame, root: str, sites: DataFrame, dates: DataFrame,
                  cycles: list[str] | None = None, max_horizon: int | None = None,
                  short_cycle_horizon: int | None = 6) -> list[str]:
    """IO-11/IO-12: land already-tabular forecast rows for the wanted dates.

    Keeps the native variables, listed sites, wanted issue dates (``dates`` has
    a reference_datetime column) and cycles; cycle 00 in full, other cycles only
    up to ``short_cycle_horizon``. Writes reference_datetime partitions and
    returns the wanted dates.
    """
    df = raw.filter(F.col("variable").isin(NATIVE_VARIABLES))
    df = listed_sites(df, sites)
    # one value a wanted day: as literals they prune the scan to those partition folders
    wanted = sorted({str(r[0]) for r in dates.select("reference_datetime").collect()})
    df = df.filter(F.col("reference_datetime").isin(wanted))
    hz = F.col("horizon").try_cast("int")
    if cycles is not None and "cycle" in df.columns:
        df = df.filter(F.col("cycle").isin(list(cycles)))
    if short_cycle_horizon is not None and "cycle" in df.columns:
        df = df.filter((F.col("cycle") == "00") | (hz <= short_cycle_horizon))
    if max_horizon is not None:
        df = df.filter(hz <= max_horizon)
    write_partitioned(df, root, ["reference_datetime"], ["site_id", "variable", "datetime"], mode="overwrite")
    return wanted


def sync_partitions(spark: SparkSession, src_root: str, dst_root: str, column: str,
                    schema=None) -> list[str]:
    """IO-13: copy partitions of ``column`` that src has and dst lacks.

    Returns the copied values, None (rows without a value) last. A value counts as present once dst has a
    row of it; ``objects.sync_objects`` compares file by file. Existing dst partitions are untouched; an absent dst
    copies everything, a dst that cannot be read stops the job. Partitions are
    replaced whole (dynamic overwrite), so a repeated copy adds nothing.
    """
    src = read_dataset(spark, src_root, schema)
    dst = read_if_exists(spark, dst_root, src.schema)
    # one value a partition folder: as literals they prune the source scan
    missing = sorted((r[0] for r in missing_partitions(src, dst, column).collect()), key=lambda v: (v is None, v or ""))
    if missing:
        value = F.col(column).cast("string")
        wanted = value.isin([v for v in missing if v is not None])
        write_partitioned(src.filter(wanted | value.isNull() if None in missing else wanted), dst_root, [column])
    return missing
