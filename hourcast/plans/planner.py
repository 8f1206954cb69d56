"""Planner queries: what is missing or incomplete (PL-01..03, PL-07, PL-08, PL-11, PL-12, AG-05..08).

All return DataFrames; nothing is pulled to the driver. Dates are ISO strings
(they order correctly as text). ``run_date`` is always a parameter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourcast.schemas import (FULL_HORIZON, GATE_HORIZON_TAG, GATE_MEMBER_TAG, MEMBER_LIMIT,
                              PSEUDO_START, STAGE1_START)
from hourcast.sources.datasets import listing_days


def _d(x) -> F.Column:
    return F.to_date(F.lit(str(x)))


def date_range(spark: SparkSession, start, end, name: str = "reference_datetime") -> DataFrame:
    """SC-13: one row per day from start to end inclusive, as ISO text."""
    return (spark.range(1)
            .select(F.explode(F.sequence(_d(start), _d(end))).alias("d"))
            .select(F.date_format("d", "yyyy-MM-dd").alias(name)))


def backlog(spark: SparkSession, present: DataFrame, start, end,
            column: str = "reference_datetime") -> DataFrame:
    """Wanted days minus days present (left anti join, no NOT IN NULL trap)."""
    have = present.select(F.col(column).cast("string").alias(column)).distinct()
    return date_range(spark, start, end, column).join(have, column, "left_anti")


def _shift(run_date, days: int) -> str:
    return (_dt.date.fromisoformat(str(run_date)) + _dt.timedelta(days=days)).isoformat()


def stage1_backlog(spark, present: DataFrame, run_date, start=STAGE1_START) -> DataFrame:
    """PL-01: start .. yesterday, minus landed issue dates."""
    return backlog(spark, present, start, _shift(run_date, -1))


def pseudo_backlog(spark, present: DataFrame, run_date, start=PSEUDO_START) -> DataFrame:
    """PL-02: start .. today (inclusive), minus landed dates."""
    return backlog(spark, present, start, run_date)


def stage2_backlog(spark, present: DataFrame, run_date, lookback_days: int = 7) -> DataFrame:
    """PL-03: the last ``lookback_days`` days before run_date, minus produced dates."""
    return backlog(spark, present, _shift(run_date, -lookback_days), _shift(run_date, -1))


def horizon_reached(df: DataFrame, date_col: str = "start_date", member_col: str = "parameter",
                    horizon_col: str = "horizon", by=()) -> DataFrame:
    """AG-05: max horizon per (date, member), then the min of that per date:
    the horizon every member has reached."""
    per_member = (df.groupBy(date_col, *by, member_col)
                  .agg(F.max(F.col(horizon_col).cast("double")).alias("max_horizon")))
    return per_member.groupBy(date_col, *by).agg(F.min("max_horizon").alias("horizon"))


def plan_runs(stage1: DataFrame, stage2: DataFrame | None, dates: list[str], cycles=(0,),
              min_horizon: float = FULL_HORIZON, max_member: int = MEMBER_LIMIT,
              force: bool = False, state_var: str = "PRES",
              out_var: str = "air_temperature") -> DataFrame:
    """PL-07/PL-08: which (date, cycle) runs to (re)process.

    stage1 / stage2: legacy tables with start_date (text), cycle (int),
    parameter, horizon (numeric), variable, site_id. A run is kept when forced,
    when stage2 has no folder (no sites) for it, or when cycle 0's horizon
    reached by all members is below ``min_horizon`` (or unknown).
    """
    spark = stage1.sparkSession
    avail = horizon_reached(
        stage1.filter(F.col("start_date").isin(list(dates)) & (F.col("cycle") == 0)
                      & (F.col("parameter") < max_member) & (F.col("variable") == state_var)))
    runs = avail.select(F.col("start_date").alias("date"),
                        F.explode(F.array(*[F.lit(int(c)) for c in cycles])).alias("cycle"))
    runs = runs.withColumn("dir_parquet", F.concat_ws("/", F.col("cycle").cast("string"), "date"))
    if stage2 is not None:
        s2 = stage2.filter(F.col("start_date").isin(list(dates)))
        done = horizon_reached(
            s2.filter((F.col("cycle") == 0) & (F.col("parameter") < max_member)
                      & (F.col("variable") == out_var)), by=("cycle",)
        ).withColumnRenamed("start_date", "date")
        n_sites = (s2.groupBy(F.col("start_date").alias("date"), "cycle")
                   .agg(F.countDistinct("site_id").alias("files_present")))
        runs = runs.join(done, ["date", "cycle"], "left").join(n_sites, ["date", "cycle"], "left")
    else:
        runs = (runs.withColumn("horizon", F.lit(None).cast("double"))
                .withColumn("files_present", F.lit(None).cast("long")))
    incomplete = (F.col("cycle") == 0) & (F.coalesce(F.col("horizon"), F.lit(-1.0)) < min_horizon)
    files = F.when(incomplete, F.lit(None).cast("long")).otherwise(F.col("files_present"))
    runs = runs.withColumn("files_present", files)
    keep = F.lit(bool(force)) | F.col("files_present").isNull() | (F.col("files_present") == 0)
    return runs.filter(keep).select("date", "cycle", "dir_parquet", "horizon", "files_present")


def incomplete_dates(stage1: DataFrame, yesterday, full_horizon: float = FULL_HORIZON,
                     max_member: int = MEMBER_LIMIT, var: str = "TMP",
                     date_col: str = "reference_date") -> DataFrame:
    """PL-11: yesterday plus earlier dates where some member < max_member has
    a max horizon below full_horizon."""
    per = (stage1.filter(F.col("variable") == var)
           .groupBy(date_col, "parameter").agg(F.max(F.col("horizon").cast("double")).alias("max")))
    missing = (per.filter((F.col("parameter") < max_member) & (F.col("max") < full_horizon)
                          & (F.col(date_col) < F.lit(str(yesterday))))
               .select(F.col(date_col).cast("string").alias("date")).distinct())
    spark = stage1.sparkSession
    return spark.createDataFrame([(str(yesterday),)], "date string").union(missing)


def latest_landed_day(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """AG-07 / SC-07 / SC-08: newest day among landed folders, whose base names
    are dates (entries that are not dates are ignored). One row: latest_day."""
    from hourcast.functions.paths import basename
    day = F.try_to_date(basename(F.col(path_col)), "yyyy-MM-dd")
    return listing.agg(F.max(day).alias("latest_day"))


def availability_gate(listing: DataFrame, run_date, required_files: int = 1,
                      horizon_tag: str = GATE_HORIZON_TAG, member_tag: str = GATE_MEMBER_TAG,
                      cycle: str = "00", sub: str = "atmos/pgrb2ap5") -> DataFrame:
    """PL-12: is the newest upstream day complete enough to start?

    listing: one row per object path. The newest day among top-level names is
    found (AG-08, bad names ignored); files under <newest>/<cycle>/<sub>/ that
    contain ``horizon_tag`` and ``member_tag`` are counted. Returns one row:
    latest_day, latest_name, n_files, ready.
    """
    wanted = (F.col("path").startswith(F.concat_ws("/", "name", F.lit(cycle), F.lit(sub)))
              & F.col("path").contains(horizon_tag) & F.col("path").contains(member_tag))
    per_day = (listing_days(listing).filter(F.col("day").isNotNull())
               .groupBy("name", "day").agg(F.count(F.when(wanted, 1)).alias("n_files")))
    newest = per_day.agg(F.max(F.struct("day", "name", "n_files")).alias("top"))  # one pass, one row a folder
    return (newest.select(F.col("top.day").alias("latest_day"), F.col("top.name").alias("latest_name"),
                          F.coalesce("top.n_files", F.lit(0).cast("long")).alias("n_files"))
            .withColumn("ready", (F.col("n_files") >= required_files)
                        & (F.col("latest_day") == F.to_date(F.lit(str(run_date)))))
            .select("latest_day", "latest_name", "n_files", "ready"))
