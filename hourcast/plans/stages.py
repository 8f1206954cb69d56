"""Stage builds (PL-04, PL-05, PL-06, PL-09, PL-10, PL-17).

Each build has a pure ``*_frame`` function (DataFrame in, DataFrame out) and a
job function that reads the datasets, runs the frame for *all* dates or sites
in one plan, and writes partitioned Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hourcast.functions.naming import cf_name, flux_rename, member_number, pad_left
from hourcast.operators.hourly import to_hourly
from hourcast.operators.pseudo import repair_datetime
from hourcast.plans.planner import plan_runs, pseudo_backlog, stage1_backlog, stage2_backlog
from hourcast.schemas import LEGACY_START, PSEUDO, PSEUDO_START, STAGE1, STAGE1_START
from hourcast.session import drop_scratch, owns_scratch, scratch_dir
from hourcast.sinks import versioned
from hourcast.sinks.util import materialize
from hourcast.sinks.writers import land_forecast, write_partitioned, write_positional_runs, write_stage2, write_stage3
from hourcast.sources.datasets import (
    listed_sites, native_variables, partition_values, read_dataset, read_if_exists, read_partitions)

STAGE2_READ = T.StructType([
    T.StructField("family", T.StringType()),
    T.StructField("parameter", T.DoubleType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("variable", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("reference_datetime", T.StringType()),
    T.StructField("site_id", T.StringType()),
])
STAGE3_READ = T.StructType([
    T.StructField("family", T.StringType()),
    T.StructField("parameter", T.DoubleType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("variable", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("reference_datetime", T.DateType()),
    T.StructField("site_id", T.StringType()),
])
OUT_COLS = ["site_id", "family", "parameter", "datetime", "variable", "prediction", "reference_datetime"]


def finish(hourly: DataFrame, forecast: bool = True) -> DataFrame:
    """Member code -> number (``parameter``), issue time -> date (NULL for stage 3)."""
    ref = (F.to_date("reference_datetime") if forecast else F.lit(None).cast("date"))
    return hourly.select("site_id", "family", member_number("ensemble").alias("parameter"),
                         "datetime", "variable", "prediction", ref.alias("reference_datetime"))


def stage2_frame(stage1: DataFrame, sites: DataFrame, dates: DataFrame | None = None,
                 **hourly_kw) -> DataFrame:
    """PL-04: stage-1 forecasts of the wanted issue dates -> stage-2 rows.

    A wanted date absent from stage 1 simply yields no rows.
    """
    df = listed_sites(native_variables(stage1), sites)
    if dates is not None:
        df = df.join(dates.select(F.col("reference_datetime").cast("string").alias("reference_datetime")),
                     "reference_datetime", "left_semi")
    return finish(to_hourly(df, sites, ["reference_datetime"], pseudo=False, **hourly_kw), True)


@owns_scratch
def build_stage2(spark: SparkSession, stage1_root: str, stage2_root: str, sites: DataFrame,
                 run_date, lookback_days: int = 7, schema: T.StructType = STAGE1) -> list[str]:
    """Job: find missing stage-2 dates (PL-03), build them all in one plan, write. Returns the dates.

    ``schema`` is the stage-1 read schema (use TimestampType for ``datetime``
    when the files hold UTC-adjusted timestamps; the session runs in UTC).
    """
    produced = partition_values(read_if_exists(spark, stage2_root, STAGE2_READ), "reference_datetime")
    # At most ``lookback_days`` values: fetched so the scan is pruned to those
    # partition folders when it is planned (a join alone would list them all).
    wanted = sorted(r[0] for r in stage2_backlog(spark, produced, run_date, lookback_days).collect())
    if wanted:
        write_stage2(stage2_frame(wanted_stage1(spark, stage1_root, wanted, schema), sites), stage2_root)
    return wanted


def wanted_stage1(spark: SparkSession, root: str, dates: list[str], schema: T.StructType = STAGE1) -> DataFrame:
    """The scan of ``build_stage2``: only the wanted dates' partition folders."""
    return read_partitions(spark, root, "reference_datetime", dates, schema)


def stage3_frame(pseudo: DataFrame, sites: DataFrame, **hourly_kw) -> DataFrame:
    """PL-05: all pseudo-observations -> one continuous hourly history per site."""
    df = repair_datetime(listed_sites(native_variables(pseudo), sites))
    return finish(to_hourly(df, sites, ["site_id"], pseudo=True, **hourly_kw), False)


@owns_scratch
def rebuild_stage3(spark: SparkSession, pseudo_root: str, stage3_root: str, sites: DataFrame,
                   schema: T.StructType = PSEUDO) -> None:
    """Job: PL-05 for all listed sites in one plan."""
    write_stage3(stage3_frame(read_dataset(spark, pseudo_root, schema), sites), stage3_root)


def stage3_update_frame(stage3: DataFrame, pseudo: DataFrame, sites: DataFrame,
                        rewrite_days: int = 3, lookback_issue_days: int | None = None,
                        keep_new=lambda new: new, **hourly_kw) -> DataFrame:
    """PL-06: rows to write back for every site that has history and new data.

    Per site: cut-off = date(newest stored time) - rewrite_days; pseudo issues
    on or after the cut-off (``lookback_issue_days`` earlier if given) are
    redone; stored rows strictly before the first new time are kept. Both
    parts are de-duplicated. Sites without history are never started; sites
    without new rows are absent (their partition stays as it is). The new rows are
    used twice: ``keep_new`` may write them first.
    """
    stage3 = listed_sites(stage3, sites)
    last = stage3.groupBy("site_id").agg(F.max(F.to_date("datetime")).alias("last_day"))
    new = keep_new(stage3_new_rows(last, pseudo, sites, rewrite_days, lookback_issue_days, **hourly_kw))
    first_new = new.groupBy("site_id").agg(F.min("datetime").alias("first_new"))
    old = (stage3.select(*OUT_COLS).join(first_new, "site_id")
           .filter(F.col("datetime") < F.col("first_new")).drop("first_new").distinct())
    return new.unionByName(old)


def stage3_new_rows(last: DataFrame, pseudo: DataFrame, sites: DataFrame, rewrite_days: int = 3,
                    lookback_issue_days: int | None = None, **hourly_kw) -> DataFrame:
    """The redone rows of PL-06, without repeats, for the sites of ``last`` (site_id, last_day)."""
    look = rewrite_days if lookback_issue_days is None else lookback_issue_days
    cut = last.select("site_id",
                      F.date_format(F.date_sub("last_day", look), "yyyy-MM-dd").alias("read_from"),
                      F.date_sub("last_day", rewrite_days).alias("rewrite_from"))
    src = listed_sites(native_variables(pseudo), sites).join(cut, "site_id")
    src = src.filter(F.col("reference_datetime").cast("string") >= F.col("read_from"))
    src = repair_datetime(src.drop("read_from", "rewrite_from"))
    new = finish(to_hourly(src, sites, ["site_id"], pseudo=True, **hourly_kw), False)
    if look != rewrite_days:
        new = (new.join(cut.select("site_id", "rewrite_from"), "site_id")
               .filter(F.to_date("datetime") >= F.col("rewrite_from")).drop("rewrite_from"))
    return new.distinct()


@owns_scratch
def update_stage3(spark: SparkSession, pseudo_root: str, stage3_root: str, sites: DataFrame,
                  rewrite_days: int = 3, lookback_issue_days: int | None = None,
                  schema: T.StructType = PSEUDO) -> list[str]:
    """Job: PL-06 for all listed sites at once; returns the sites that have history.

    The result is staged in the shared checkpoint folder first, then swapped in with
    dynamic partition overwrite, so a failed job cannot lose history; the staging
    is deleted after the swap.
    """
    look = rewrite_days if lookback_issue_days is None else lookback_issue_days
    stage3 = read_if_exists(spark, stage3_root, STAGE3_READ)
    starts = site_starts(stage3, sites, look)
    if not starts:  # no history at all: nothing is ever started
        return []
    stage3 = stage3.filter(F.col("site_id").isin(sorted(starts)))
    pseudo = since(read_dataset(spark, pseudo_root, schema), starts)
    scratch = [scratch_dir(spark, "stage3-new"), scratch_dir(spark, "stage3-staging")]

    def keep_new(new: DataFrame) -> DataFrame:
        new.write.parquet(scratch[0])
        return spark.read.schema(new.schema).parquet(scratch[0])

    frame = stage3_update_frame(stage3, pseudo, sites, rewrite_days, lookback_issue_days, keep_new)
    write_partitioned(frame, scratch[1], ["site_id"])
    staged = read_if_exists(spark, scratch[1], STAGE3_READ)
    write_stage3(staged.select(*OUT_COLS), stage3_root)
    for path in scratch:
        drop_scratch(spark, path)
    return sorted(starts)


STAGE3_KEYS = ["site_id", "month"]
STAGE3_MONTHLY = T.StructType([*STAGE3_READ.fields, T.StructField("month", T.StringType())])


def _statistics() -> dict[str, F.Column]:
    """What a manifest of stage 3 knows of a (site, month): its rows, how many of them differ, its newest time."""
    return {"n_rows": F.count(F.lit(1)), "n_different": F.count_distinct(F.xxhash64(*[c for c in OUT_COLS if c != "site_id"])),
            "last_time": F.max("datetime")}


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.select(*OUT_COLS, F.date_format("datetime", "yyyy-MM").alias("month"))


@owns_scratch
def rebuild_stage3_published(spark: SparkSession, pseudo_root: str, root: str, sites: DataFrame,
                             schema: T.StructType = PSEUDO) -> int:
    """Job: PL-05 as a new published version, partitioned by site and month; returns its number."""
    rows = _by_month(stage3_frame(read_dataset(spark, pseudo_root, schema), sites))
    return versioned.publish(spark, root, rows, STAGE3_KEYS, None, _statistics(), ["variable", "datetime", "parameter"])


def read_stage3(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of a published stage 3."""
    return versioned.read_version(spark, root, STAGE3_MONTHLY, version).select(*OUT_COLS)


@owns_scratch
def update_stage3_published(spark: SparkSession, pseudo_root: str, root: str, sites: DataFrame, rewrite_days: int = 3,
                            lookback_issue_days: int | None = None, schema: T.StructType = PSEUDO) -> int | None:
    """Job: PL-06 by month, as a new published version; returns its number, or None if there is nothing to write.

    The rows are those of ``update_stage3``, but a site's months before its first new time are carried over by
    their line in the manifest. Read and written are the month of the first new time, the months after it, and, once,
    earlier months that hold repeated rows (a rebuild keeps them, an update removes them). Sites' newest times
    come from the manifest, so the history is not scanned either.
    """
    lines = versioned.manifest(spark, root)
    if lines is None:
        return None
    look = rewrite_days if lookback_issue_days is None else lookback_issue_days
    last = listed_sites(lines, sites).groupBy("site_id").agg(F.to_date(F.max("last_time")).alias("last_day"))
    last = last.where("site_id is not null and last_day is not null")
    starts = {r["site_id"]: r["start"] for r in last.select(
        "site_id", F.date_format(F.date_sub("last_day", look), "yyyy-MM-dd").alias("start")).collect()}  # one value a listed site
    if not starts:
        return None
    pseudo = since(read_dataset(spark, pseudo_root, schema), starts)
    new = materialize(stage3_new_rows(last, pseudo, sites, rewrite_days, lookback_issue_days), "stage3-new")
    first = new.groupBy("site_id").agg(F.min("datetime").alias("first_new"))
    first = materialize(first.select("site_id", "first_new", F.date_format("first_new", "yyyy-MM").alias("first_month")), "stage3-first")
    if first.isEmpty():
        return None
    placed = lines.join(first.select(F.col("site_id").alias("_site"), "first_month"), F.col("site_id") == F.col("_site"), "left")
    untouched = F.col("_site").isNull()
    earlier, clean = F.col("month") < F.col("first_month"), F.col("n_rows") == F.col("n_different")
    carry = materialize(placed.where(untouched | (earlier & clean)).drop("_site", "first_month"), "stage3-carried")
    again = placed.where(~untouched & ((F.col("month") == F.col("first_month")) | (earlier & ~clean)))
    wanted = [r["folder"] for r in again.select("folder").collect()]  # a month or so of each touched site
    old = versioned.read_version(spark, root, STAGE3_MONTHLY, where=F.col("folder").isin(wanted)).select(*OUT_COLS)
    old = (old.join(first.select("site_id", "first_new"), "site_id").filter(F.col("datetime") < F.col("first_new"))
           .drop("first_new").distinct())
    rows = _by_month(new.select(*OUT_COLS).unionByName(old.select(*OUT_COLS)))
    return versioned.publish(spark, root, rows, STAGE3_KEYS, carry, _statistics(), ["variable", "datetime", "parameter"])


STAGE2_KEYS = ["reference_datetime", "site_id"]


@owns_scratch
def build_stage2_published(spark: SparkSession, stage1_root: str, root: str, sites: DataFrame, run_date,
                           lookback_days: int = 7, schema: T.StructType = STAGE1) -> list[str]:
    """Job: ``build_stage2`` as a new published version: all missing dates appear together or not at all.

    Which dates exist is read from the manifest.
    """
    lines = versioned.manifest(spark, root)
    have = spark.createDataFrame([], "reference_datetime string") if lines is None else lines.select("reference_datetime")
    wanted = sorted(r[0] for r in stage2_backlog(spark, have, run_date, lookback_days).collect())  # at most lookback_days values
    if wanted:
        rows = stage2_frame(wanted_stage1(spark, stage1_root, wanted, schema), sites)
        versioned.publish(spark, root, rows, STAGE2_KEYS, lines, None, ["variable", "parameter", "datetime"])
    return wanted


def site_starts(stage3: DataFrame, sites: DataFrame, days: int) -> dict[str, str]:
    """First issue date to read again, by listed site with history (one value a listed site).

    Reads the time column of the listed sites' partitions only.
    """
    rows = (listed_sites(stage3, sites).groupBy("site_id")
            .agg(F.date_format(F.date_sub(F.max(F.to_date("datetime")), days), "yyyy-MM-dd").alias("start"))).collect()
    return {r["site_id"]: r["start"] for r in rows if r["site_id"] is not None and r["start"] is not None}


def since(pseudo: DataFrame, starts: dict[str, str]) -> DataFrame:
    """Rows of each site from its own start on, as literals: the partition part of the
    condition prunes folders, the site part row groups, so a site that stopped long
    ago does not make the others' old days be read."""
    groups: dict[str, list[str]] = {}
    for site, start in starts.items():
        groups.setdefault(start, []).append(site)
    keep = F.lit(False)
    for start, names in sorted(groups.items()):
        keep = keep | (F.col("site_id").isin(sorted(names)) & (F.col("reference_datetime").cast("string") >= start))
    return pseudo.filter(keep)


def legacy_stage3_frame(history: DataFrame | None, stage1: DataFrame, run_date,
                        start_date: str = LEGACY_START, accum_hours: int = 6,
                        places: DataFrame | None = None) -> DataFrame:
    """PL-10: legacy stage-3 append for all sites at once.

    Columns: datetime, site_id, longitude, latitude, family, parameter, variable,
    height, prediction. ``places`` (site_id, latitude, longitude) gives the
    coordinates; height is the history's or the variable's in stage 1 where those
    have the column, else NULL. ``legacy_reference_times`` adds the AG-13 column.

    history: datetime, site_id, family, parameter, variable, prediction (may be None).
    stage1:  legacy rows (start_date text, cycle int, site_id, parameter int,
             horizon numeric, datetime, variable, prediction, family).
    Per site: drop the newest stored day, redo from that day to run_date when
    that spans more than one day (sites without history from ``start_date``),
    using horizons 0 and 3 and keeping horizon < 6; union. Members are carried
    whole, NULL included. Disaggregation runs with horizon rules and
    solar reshaping off (the legacy chain had neither).
    """
    s1 = native_variables(stage1).filter(F.col("horizon").cast("double").isin(0.0, 3.0))
    sites = s1.select("site_id").distinct()
    if history is not None:
        h = history.withColumn("start_date", F.to_date("datetime"))
        last = h.groupBy("site_id").agg(F.max("start_date").alias("max_start"))
        kept = (h.join(last, "site_id").filter(F.col("start_date") != F.col("max_start"))
                .drop("start_date", "max_start"))
        plan = sites.join(last, "site_id", "left")
    else:
        kept = None
        plan = sites.withColumn("max_start", F.lit(None).cast("date"))
    plan = (plan.withColumn("from_day", F.coalesce("max_start", F.to_date(F.lit(start_date))))
            .filter(F.datediff(F.to_date(F.lit(str(run_date))), F.col("from_day")) >= 1))
    d1 = (s1.join(plan.select("site_id", "from_day"), "site_id")
          .filter((F.to_date("start_date") >= F.col("from_day"))
                  & (F.to_date("start_date") <= F.to_date(F.lit(str(run_date)))))
          .drop("start_date", "cycle", "from_day").distinct()
          .filter(F.col("horizon").cast("double") < 6))
    d1 = d1.withColumn("ensemble", F.col("parameter").cast("string"))
    hourly = to_hourly(d1.withColumn("horizon", F.lit(None).cast("string")), None, ["site_id"],
                       pseudo=True, use_solar_geom=False, horizon_rules=False,
                       accum_hours=accum_hours)
    new = hourly.select("datetime", "site_id", "family", F.col("ensemble").cast("int").alias("parameter"),
                        "variable", "prediction")
    if "height" in stage1.columns:  # a handful of variables
        heights = native_variables(stage1).groupBy(cf_name(flux_rename(F.col("variable"))).alias("variable")).agg(
            F.max("height").alias("height"))
        new = new.join(heights, "variable", "left")
    else:
        new = new.withColumn("height", F.lit(None).cast("string"))
    if kept is not None:
        height = F.col("height").cast("string") if "height" in kept.columns else F.lit(None).cast("string")
        new = new.unionByName(
            kept.select("datetime", "site_id", "family", F.col("parameter").cast("int").alias("parameter"),
                        "variable", "prediction", height.alias("height"))
            .join(plan.select("site_id"), "site_id", "left_semi"))
    if places is None:
        new = new.withColumns({c: F.lit(None).cast("double") for c in ("longitude", "latitude")})
    else:
        new = new.join(places.select("site_id", "longitude", "latitude"), "site_id", "left")
    return new.withColumn("family", F.lit("ensemble")).select(
        "datetime", "site_id", "longitude", "latitude", "family", "parameter", "variable", "height", "prediction")


def legacy_reference_times(rows: DataFrame) -> DataFrame:
    """AG-13: every row gets its site's earliest time as ``reference_datetime`` (an
    aggregate and a join: a site's history never has to fit in one task)."""
    first = rows.groupBy("site_id").agg(F.min("datetime").alias("reference_datetime"))
    return rows.join(first, "site_id")


def legacy_stage2_frame(stage1: DataFrame, runs: DataFrame, sites: DataFrame, **hourly_kw) -> DataFrame:
    """PL-09: legacy stage-2 build for planned runs, all runs in one plan.

    stage1: legacy rows (start_date, cycle int, site_id, parameter int, horizon
    numeric, datetime, variable, prediction, reference_datetime, family).
    runs: date, cycle (e.g. the output of plan_runs). Each (date, cycle) is a
    batch; members are carried whole, NULL included.
    """
    r = runs.select(F.col("date").alias("start_date"), F.col("cycle").cast("int").alias("cycle"))
    df = (native_variables(stage1).join(r, ["start_date", "cycle"], "left_semi")
          .withColumn("ensemble", F.col("parameter").cast("string"))
          .withColumn("horizon", pad_left(F.col("horizon").cast("int"), 3)))
    h = to_hourly(df, sites, ["start_date", "cycle", "reference_datetime"], pseudo=False, **hourly_kw)
    return h.select("start_date", "cycle", "site_id", "family",
                    F.col("ensemble").cast("int").alias("parameter"),
                    "datetime", "variable", "prediction", "reference_datetime")


@owns_scratch
def build_legacy_stage2(spark: SparkSession, stage1: DataFrame, runs: DataFrame, sites: DataFrame,
                        root: str) -> None:
    """Job: PL-09 + IO-09, one folder per (cycle, start_date, site_id)."""
    write_positional_runs(legacy_stage2_frame(stage1, runs, sites), root)


@owns_scratch
def stage2_chain(spark: SparkSession, raw: DataFrame, stage1_root: str, stage2_root: str,
                 sites: DataFrame, run_date, lookback_days: int = 7, start=None) -> list[str]:
    """PL-17: land the stage-1 backlog, then build the stage-2 backlog."""
    start = STAGE1_START if start is None else start
    present = partition_values(read_if_exists(spark, stage1_root, STAGE1), "reference_datetime")
    land_forecast(raw, stage1_root, sites, stage1_backlog(spark, present, run_date, start), cycles=["00"])
    return build_stage2(spark, stage1_root, stage2_root, sites, run_date, lookback_days)


@owns_scratch
def stage3_chain(spark: SparkSession, raw: DataFrame, pseudo_root: str, stage3_root: str,
                 sites: DataFrame, run_date, start=PSEUDO_START) -> list[str]:
    """PL-17: land the pseudo-observation backlog, then update stage 3."""
    present = partition_values(read_if_exists(spark, pseudo_root, PSEUDO), "reference_datetime")
    land_forecast(raw, pseudo_root, sites, pseudo_backlog(spark, present, run_date, start))
    return update_stage3(spark, pseudo_root, stage3_root, sites)


@owns_scratch
def legacy_chain(spark: SparkSession, stage1: DataFrame, stage2_root: str, stage3_root: str, sites: DataFrame,
                 dates: list[str], run_date, start_date: str = LEGACY_START) -> None:
    """PL-17: the legacy 1 -> 2 -> 3 chain: every planned run's stage 2, then the stage-3 append."""
    runs = plan_runs(stage1, None, dates, cycles=(0, 6, 12, 18), force=True)
    build_legacy_stage2(spark, stage1, runs, sites, stage2_root)
    rows = legacy_stage3_frame(None, stage1, run_date, start_date, places=sites)
    write_partitioned(rows, stage3_root, ["site_id"], ["datetime", "variable", "parameter"])
