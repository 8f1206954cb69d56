"""Registered queries: one callable per operator, each (spark, sf_dir) -> DataFrame.

Inputs are derived from the test tables by ``hourcast.sources.events_adapter``
(forecast and pseudo-observation shapes). Every query runs over the whole
derived tables. Values that pass through sines and means (shortwave, rpot,
bin step) are rounded to 6 places for the cross-engine comparison; exact
arithmetic results are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hourcast.functions.naming import cf_name, flux_rename, member_number
from hourcast.operators.hourly import (
    decode_keys, disaggregate, flux_duplicates, series_exceptions, solar_bin_table, to_hourly, with_potential)
from hourcast.operators.pseudo import flux_horizon_rule, repair_datetime, state_horizon_rule
from hourcast.operators.solar_ops import daily_means
from hourcast.operators.spine import hourly_spine, observations_on_spine
from hourcast.plans import planner, reports, stages
from hourcast.schemas import FLUX_VARIABLES, PSEUDO, STATE_VARIABLES
from hourcast.session import scratch_dir
from hourcast.sinks import objects, positional, versioned, writers
from hourcast.sinks.util import materialize
from hourcast.sources import datasets, legacy, store
from hourcast.sources.events_adapter import forecast, pseudo
from hourcast.sources.site_list import builtin_sites, read_sites, site_faults

SW = "surface_downwelling_shortwave_flux_in_air"
FB = ["reference_datetime"]  # forecast batches
PB = ["site_id"]             # pseudo-observation batches

# Fixed run parameters of the registered planner queries.
RUN_DATE = "2024-01-20"
PLANNER_MIN_HORIZON = 160
UPDATE_SPLIT = "2024-01-20"


def round_sw(df: DataFrame, col: str = "prediction") -> DataFrame:
    return df.withColumn(col, F.when(F.col("variable") == SW, F.round(col, 6)).otherwise(F.col(col)))


def _fc(spark, d):
    """Forecast-shaped input, derived once per query and checkpointed (it feeds
    several branches of each plan)."""
    return materialize(forecast(spark, d))


def _ps(spark, d):
    return materialize(pseudo(spark, d))


def _bmax(df: DataFrame, B: list[str]) -> DataFrame:
    # one row per batch; no hint: the planner sizes it at run time (AQE)
    return df.join(df.groupBy(*B).agg(F.max("datetime").alias("bmax")), B)


# --- inputs and rules -------------------------------------------------------

# The derived tables hold only rows that pass these rules, so each query first changes
# some rows (by their own values) in a way that the rule must catch.

def _changed(df: DataFrame, column: str, where, value) -> DataFrame:
    return df.withColumn(column, F.when(where, value).otherwise(F.col(column)))


def q_variable_filter(spark, d):
    """Rows at 21 h carry a ninth variable."""
    return datasets.native_variables(_changed(_ps(spark, d), "variable", F.hour("datetime") == 21, F.lit("VIS")))


def q_site_semi_join(spark, d):
    """Member gep02 belongs to a site that is not listed."""
    return datasets.listed_sites(_changed(_fc(spark, d), "site_id", F.col("ensemble") == "gep02", F.lit("NONE")),
                                 builtin_sites(spark))


def q_state_horizon_rule(spark, d):
    """Each site's newest rows have horizon 006: the exception of the rule."""
    p = _bmax(_ps(spark, d), PB)
    p = _changed(p, "horizon", F.col("datetime") == F.col("bmax"), F.lit("006"))
    return (p.filter(F.col("variable").isin(STATE_VARIABLES) & state_horizon_rule(True))
            .drop("bmax"))


def q_flux_horizon_rule(spark, d):
    return _ps(spark, d).filter(F.col("variable").isin(FLUX_VARIABLES) & flux_horizon_rule())


def q_pseudo_overlap(spark, d):
    p = _bmax(_ps(spark, d), PB)
    is_state = F.col("variable").isin(STATE_VARIABLES)
    kept = F.when(is_state, state_horizon_rule(True)).otherwise(flux_horizon_rule())
    return (p.select("site_id", F.when(is_state, "state").otherwise("flux").alias("class"),
                     "horizon", F.coalesce(kept, F.lit(False)).alias("kept"))
            .groupBy("site_id", "class", "horizon", "kept").agg(F.count("*").alias("n")))


def q_repair_datetime(spark, d):
    """Cycle 06 is stored five hours late."""
    late = F.timestamp_add("HOUR", F.lit(5), F.col("datetime"))
    return repair_datetime(_changed(_ps(spark, d), "datetime", F.col("cycle") == "06", late))


# --- inventories and backlogs -----------------------------------------------

def q_partition_inventory(spark, d):
    """Inventory of a partitioned dataset: folder names only, no column is read."""
    root = _land(spark, _ps(spark, d), "inventory")
    return datasets.partition_values(datasets.read_dataset(spark, root, PSEUDO), "reference_datetime")


def q_site_csv(spark, d):
    """Rows of each site of a list read from CSV (blanks around fields, as in the published list)."""
    root = scratch_dir(spark, "site-csv")
    blank = builtin_sites(spark).withColumn("site_id", F.concat(F.lit(" "), "site_id", F.lit(" ")))
    blank.write.option("header", True).csv(root)
    listed = datasets.listed_sites(_ps(spark, d), read_sites(spark, root))
    return (listed.groupBy("site_id").agg(F.count("*").alias("n"))
            .join(read_sites(spark, root), "site_id").select("site_name", "site_id", "latitude", "longitude", "n"))


def q_site_faults(spark, d):
    """Rows of the sites that a faulty list spoils: one repeated, one with a bad number, one without a longitude."""
    ps, root = _ps(spark, d), scratch_dir(spark, "site-faults")
    listed = builtin_sites(spark).join(ps.select("site_id").distinct(), "site_id", "left_semi")
    line = lambda lat, lon: F.concat_ws(",", F.lit("a site"), "site_id", lat, lon)
    lat, lon = F.col("latitude").cast("string"), F.col("longitude").cast("string")
    lines = listed.select(F.explode(F.when(F.col("site_id") == "TOOK", F.array(line(lat, lon), line(lat, lon)))
                                    .when(F.col("site_id") == "BARC", F.array(line(F.lit("29.6N"), lon)))
                                    .when(F.col("site_id") == "ALEX", F.array(line(lat, F.lit(""))))
                                    .otherwise(F.array(line(lat, lon)))).alias("value"))
    header = spark.createDataFrame([("site_name,site_id,latitude,longitude",)], "value string")
    header.unionByName(lines).coalesce(1).write.text(root)
    faults = site_faults(spark, root).groupBy("site_id", "fault").agg(F.count("*").alias("n_lines"))
    return faults.join(ps.groupBy("site_id").agg(F.count("*").alias("n_rows")), "site_id")


def q_series_exceptions(spark, d):
    """TS-02 / TS-09: RH of member gep01 has a value at the newest time only, UGRD a second one at every hour."""
    ps = _bmax(_ps(spark, d), PB)
    lone = (F.col("variable") == "RH") & (F.col("ensemble") == "gep01") & (F.col("datetime") != F.col("bmax"))
    ps = _changed(ps, "prediction", lone, F.lit(None)).drop("bmax")
    ps = ps.unionByName(ps.filter(F.col("variable") == "UGRD").withColumn("prediction", F.col("prediction") + 1))
    return series_exceptions(disaggregate(ps, PB, pseudo=True))


def q_stage1_backlog(spark, d):
    return planner.stage1_backlog(spark, _fc(spark, d), RUN_DATE, start="2023-12-28")


def q_pseudo_backlog(spark, d):
    return planner.pseudo_backlog(spark, _ps(spark, d), "2024-01-03", start="2023-12-25")


def q_stage2_backlog(spark, d):
    return planner.stage2_backlog(spark, _fc(spark, d), RUN_DATE, lookback_days=7)


# --- grid and aggregates ----------------------------------------------------

def q_series_max_time(spark, d):
    return _ps(spark, d).groupBy("site_id", "family", "ensemble").agg(F.max("datetime").alias("max_time"))


def q_batch_bounds(spark, d):
    return _fc(spark, d).groupBy("reference_datetime").agg(F.min("datetime").alias("bmin"),
                                                           F.max("datetime").alias("bmax"))


def q_hourly_spine(spark, d):
    return hourly_spine(_fc(spark, d), FB)


def q_observations_on_spine(spark, d):
    """RH lies half an hour off the grid; TMP has a second value at every hour."""
    ps = _ps(spark, d)
    off = F.timestamp_add("MINUTE", F.lit(30), F.col("datetime"))
    twice = ps.filter(F.col("variable") == "TMP").withColumn("prediction", F.col("prediction") + 1)
    moved = _changed(ps, "datetime", (F.col("variable") == "RH") & (F.hour("datetime") == 12), off)
    return observations_on_spine(moved.unionByName(twice), PB, pseudo=True)


# --- fills and units --------------------------------------------------------

def _filled(spark, d, variables, convert=False):
    dd = disaggregate(_fc(spark, d), FB, pseudo=False, convert=convert)
    return decode_keys(dd.filled.filter(F.col("variable").isin(variables)).drop("chunk"), dd.key_types)


def q_interpolate_states(spark, d):
    return _filled(spark, d, STATE_VARIABLES)


def q_backfill_fluxes(spark, d):
    return _filled(spark, d, FLUX_VARIABLES)


def q_unit_conversion(spark, d):
    return to_hourly(_fc(spark, d), None, FB, use_solar_geom=False, names=None)


def q_cf_rename(spark, d):
    native = flux_rename(F.col("variable"))
    return (_fc(spark, d).groupBy(native.alias("native")).agg(F.count("*").alias("n"))
            .withColumn("standard", cf_name(F.col("native"))))


def q_member_number(spark, d):
    """The members, and malformed codes made from them."""
    codes = _fc(spark, d).select("ensemble")
    bad = codes.select(F.explode(F.array(F.concat(F.lit("x"), "ensemble"), F.substring("ensemble", 1, 3))).alias("ensemble"))
    return codes.union(bad).distinct().withColumn("parameter", member_number("ensemble"))


# --- solar ------------------------------------------------------------------

def q_solar_bin_step(spark, d):
    """The step of every batch with its three flux variables, and were it reported with two or one."""
    fc, out = _fc(spark, d), None
    for n in (1, 2, 3):
        dropped = {1: ["DSWRF", "DLWRF"], 2: ["DSWRF"], 3: []}[n]
        dd = disaggregate(fc.filter(~F.col("variable").isin(dropped)) if dropped else fc, FB)
        dups = flux_duplicates(dd.src, dd.series, FB, dd.variables)
        step = decode_keys(solar_bin_table(dups, dd.series, dd.variables, FB), dd.key_types).select(
            F.lit(n).alias("n_fluxes"), "reference_datetime", F.round("bin_seconds", 6).alias("bin_seconds"))
        out = step if out is None else out.unionByName(step)
    return out


def q_solar_potential(spark, d):
    """rpot of every flux hour, with the batch's own step."""
    dd = disaggregate(_fc(spark, d), FB)
    rp = decode_keys(with_potential(dd, builtin_sites(spark)), dd.key_types)
    return rp.select("reference_datetime", "site_id", "family", "ensemble", flux_rename(F.col("variable")).alias("variable"),
                     "datetime", F.round("rpot", 6).alias("rpot"))


def q_daily_mean_broadcast(spark, d):
    dd = disaggregate(_fc(spark, d), FB)
    f = decode_keys(daily_means(with_potential(dd, builtin_sites(spark)), dd.skey + ["variable", "chunk"]), dd.key_types)
    return f.select("reference_datetime", "site_id", "family", "ensemble",
                    flux_rename(F.col("variable")).alias("variable"), "datetime",
                    F.round("avg_rpot", 6).alias("avg_rpot"), F.round("avg_sw", 6).alias("avg_sw"))


def q_reshape_shortwave(spark, d):
    h = to_hourly(_fc(spark, d), builtin_sites(spark), FB)
    return round_sw(h.filter(F.col("variable") == SW))


# --- whole operator ---------------------------------------------------------

def q_to_hourly_forecast(spark, d):
    return round_sw(to_hourly(_fc(spark, d), builtin_sites(spark), FB, pseudo=False))


def q_to_hourly_pseudo(spark, d):
    return round_sw(to_hourly(_ps(spark, d), builtin_sites(spark), PB, pseudo=True))


def q_to_hourly_no_solar(spark, d):
    return to_hourly(_fc(spark, d), None, FB, pseudo=False, use_solar_geom=False)


# --- stage jobs (written to the shared scratch folder and read back) ------------

def _land(spark, df, name, parts=("reference_datetime",)) -> str:
    root = scratch_dir(spark, name)
    writers.write_partitioned(df, root, list(parts))
    return root


def q_stage2_build(spark, d):
    sites = builtin_sites(spark)
    s1 = _land(spark, _fc(spark, d), "stage1")
    s2 = scratch_dir(spark, "stage2")
    stages.build_stage2(spark, s1, s2, sites, run_date="2024-02-05", lookback_days=35)
    out = datasets.read_dataset(spark, s2, stages.STAGE2_READ)
    return round_sw(out.withColumn("reference_datetime", F.to_date("reference_datetime")))


def q_stage2_chain(spark, d):
    """PL-17: land every missing stage-1 date from the raw forecast rows, then
    build the stage-2 backlog (one plan each)."""
    sites = builtin_sites(spark)
    s1, s2 = scratch_dir(spark, "chain-stage1"), scratch_dir(spark, "chain-stage2")
    stages.stage2_chain(spark, _fc(spark, d), s1, s2, sites, run_date="2024-02-05",
                        lookback_days=35, start="2023-12-25")
    out = datasets.read_dataset(spark, s2, stages.STAGE2_READ)
    return round_sw(out.withColumn("reference_datetime", F.to_date("reference_datetime")))


def q_stage3_rebuild(spark, d):
    sites = builtin_sites(spark)
    p = _land(spark, _ps(spark, d), "pseudo")
    s3 = scratch_dir(spark, "stage3")
    stages.rebuild_stage3(spark, p, s3, sites)
    return round_sw(datasets.read_dataset(spark, s3, stages.STAGE3_READ))


def q_stage3_chain(spark, d):
    """PL-17: stage 3 from the early dates, then land the missing dates and update."""
    sites = builtin_sites(spark)
    ps = _ps(spark, d)
    root = _land(spark, ps.filter(F.col("reference_datetime") < UPDATE_SPLIT), "chain-pseudo")
    s3 = scratch_dir(spark, "chain-stage3")
    stages.rebuild_stage3(spark, root, s3, sites)
    stages.stage3_chain(spark, ps, root, s3, sites, run_date="2024-02-05", start="2023-12-25")
    return round_sw(datasets.read_dataset(spark, s3, stages.STAGE3_READ))


def q_stage3_update(spark, d):
    sites = builtin_sites(spark)
    ps = _ps(spark, d)
    early = _land(spark, ps.filter(F.col("reference_datetime") < UPDATE_SPLIT), "pseudo-early")
    s3 = scratch_dir(spark, "stage3")
    stages.rebuild_stage3(spark, early, s3, sites)
    full = _land(spark, ps, "pseudo")
    stages.update_stage3(spark, full, s3, sites)
    return round_sw(datasets.read_dataset(spark, s3, stages.STAGE3_READ))


def _published_stage3(spark, d) -> str:
    """Stage 3 built from the early dates, then updated by month from all: versions 1 and 2."""
    sites, ps = builtin_sites(spark), _ps(spark, d)
    root = scratch_dir(spark, "stage3-published")
    stages.rebuild_stage3_published(spark, _land(spark, ps.filter(F.col("reference_datetime") < UPDATE_SPLIT), "pseudo-early"), root, sites)
    stages.update_stage3_published(spark, _land(spark, ps, "pseudo"), root, sites)
    return root


def q_stage3_update_published(spark, d):
    """PL-06 by month, atomically published: the newest version's rows."""
    return round_sw(stages.read_stage3(spark, _published_stage3(spark, d)))


def q_stage3_version_before(spark, d):
    """The version before an update stays readable: the rows of the rebuild."""
    return round_sw(stages.read_stage3(spark, _published_stage3(spark, d), version=1))


def q_stage2_published(spark, d):
    """PL-04 in two runs, each published whole; the second builds the dates the first had not reached."""
    sites, s1 = builtin_sites(spark), _land(spark, _fc(spark, d), "stage1")
    root = scratch_dir(spark, "stage2-published")
    for run_date in ("2024-01-10", "2024-02-05"):
        stages.build_stage2_published(spark, s1, root, sites, run_date, lookback_days=35)
    out = versioned.read_version(spark, root, stages.STAGE2_READ)
    return round_sw(out.withColumn("reference_datetime", F.to_date("reference_datetime")))


# --- planners ---------------------------------------------------------------

def _legacy_s1(spark, d):
    return legacy.legacy_stage1(_fc(spark, d))


def _legacy_s2(spark, d, skip="2024-01-15"):
    fc = _fc(spark, d).filter(F.col("reference_datetime") != skip)
    return legacy.legacy_stage2(stages.stage2_frame(fc, builtin_sites(spark)))


PLAN_DATES = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29", "2024-02-05"]


def q_site_horizon_reached(spark, d):
    s1 = _legacy_s1(spark, d).filter((F.col("cycle") == 0) & (F.col("parameter") < 31)
                                     & (F.col("variable") == "PRES"))
    return planner.horizon_reached(s1)


def q_run_planner(spark, d):
    return planner.plan_runs(_legacy_s1(spark, d), _legacy_s2(spark, d), PLAN_DATES,
                             min_horizon=PLANNER_MIN_HORIZON)


def q_run_planner_forced(spark, d):
    return planner.plan_runs(_legacy_s1(spark, d), _legacy_s2(spark, d), PLAN_DATES,
                             min_horizon=PLANNER_MIN_HORIZON, force=True)


def q_incomplete_dates(spark, d):
    return planner.incomplete_dates(_legacy_s1(spark, d), "2024-01-29", full_horizon=PLANNER_MIN_HORIZON)


def _listing(spark, d) -> DataFrame:
    fc = _fc(spark, d)
    member = F.when(F.col("ensemble") == "gec00", F.lit("gec00")).otherwise(
        F.concat(F.lit("gep"), F.substring("ensemble", 4, 2)))
    day = F.regexp_replace("reference_datetime", "-", "")
    files = fc.select(F.concat(F.lit("gefs."), day, F.lit("/00/atmos/pgrb2ap5/"), member,
                               F.lit(".t00z.pgrb2a.0p50.f"), F.col("horizon")).alias("path"))
    junk = fc.select(F.concat(F.lit("notes/"), F.col("site_id"), F.lit("/index.html")).alias("path"))
    return files.union(junk).distinct()


def q_latest_landed_day(spark, d):
    fc = _fc(spark, d)
    listing = fc.select(F.concat(F.lit("stage1/0/"), F.col("reference_datetime")).alias("path")).union(
        fc.select(F.concat(F.lit("stage1/0/"), F.col("site_id"), F.lit("/")).alias("path")))
    return planner.latest_landed_day(listing)


def q_availability_gate(spark, d):
    # the derived listing feeds several scalar subqueries: write it once
    return planner.availability_gate(materialize(_listing(spark, d), "listing"), "2024-01-29",
                                     required_files=1, horizon_tag="f006")


# --- reports ----------------------------------------------------------------

def q_report_stage1(spark, d):
    return reports.report_stage1(_legacy_s1(spark, d))


def q_report_short_cycles(spark, d):
    return reports.report_short_cycles(legacy.legacy_stage1(_ps(spark, d)))


def q_report_stage2(spark, d):
    return reports.report_stage2(_legacy_s2(spark, d, skip=""))


def q_report_stage3(spark, d):
    return reports.report_stage3(stages.stage3_frame(_ps(spark, d), builtin_sites(spark)))


# --- sources / sinks --------------------------------------------------------

def q_positional_partition_scan(spark, d):
    leg = legacy.legacy_stage1(_ps(spark, d))
    root = _land(spark, leg.withColumn("cycle", F.col("cycle").cast("string")), "legacy",
                 ("cycle", "start_date", "site_id"))
    schema = spark.read.parquet(root).drop("cycle", "start_date", "site_id").schema
    return datasets.read_positional(spark, root, ["cycle", "start_date", "site_id"], schema)


def q_positional_bare_scan(spark, d):
    """IO-02 on folders that carry bare values: one folder a cycle."""
    leg = materialize(legacy.legacy_stage1(_ps(spark, d)))
    root = scratch_dir(spark, "bare")
    for c in (0, 6, 12, 18):
        leg.filter(F.col("cycle") == c).drop("cycle").write.parquet(f"{root}/{c}")
    return datasets.read_positional(spark, root, ["cycle"], leg.drop("cycle").schema)


def q_land_forecast(spark, d):
    """RH has horizon 009, which only cycle 00 may keep; cycle 18 is not wanted, nor horizons above 9 (UGRD)."""
    ps = _changed(_ps(spark, d), "horizon", F.col("variable") == "RH", F.lit("009"))
    ps = _changed(ps, "horizon", F.col("variable") == "UGRD", F.lit("012"))
    dates = planner.date_range(spark, "2024-01-05", "2024-01-12")
    root = scratch_dir(spark, "landing")
    writers.land_forecast(ps, root, builtin_sites(spark), dates, cycles=["00", "06", "12"], max_horizon=9)
    return datasets.read_dataset(spark, root, PSEUDO)


def q_sync_partitions(spark, d):
    ps = _ps(spark, d)
    src = _land(spark, ps, "sync-src")
    dst = _land(spark, ps.filter(F.col("reference_datetime") < "2024-01-15"), "sync-dst")
    writers.sync_partitions(spark, src, dst, "reference_datetime", PSEUDO)
    return datasets.read_dataset(spark, dst, PSEUDO)


RUN_KEYS = ["cycle", "start_date", "site_id"]


def _runs(spark, d) -> DataFrame:
    """Legacy rows; those of member 2 have no site."""
    leg = legacy.legacy_stage1(_ps(spark, d))
    return materialize(_changed(leg, "site_id", F.col("parameter") == 2, F.lit(None)))


def q_positional_sink(spark, d):
    """IO-09: rows written as one file a (cycle, date, site), read back, with the number of files in each folder."""
    rows, root = _runs(spark, d), scratch_dir(spark, "positional")
    positional.write_positional(rows, root, RUN_KEYS)
    back = datasets.read_positional(spark, root, RUN_KEYS, rows.drop(*RUN_KEYS).schema)
    files = store.folder_values(store.list_objects(spark, root), RUN_KEYS).select(*[F.col(k).alias(f"f_{k}") for k in RUN_KEYS], "n_files")
    same = [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in RUN_KEYS]
    return back.join(files, same[0] & same[1] & same[2]).drop(*[f"f_{k}" for k in RUN_KEYS])


def q_listing_inventory(spark, d):
    """IO-05 on a store: the runs of a positional dataset and their files, from folder names alone."""
    root = scratch_dir(spark, "inventory-tree")
    positional.write_positional(_runs(spark, d), root, RUN_KEYS)
    return store.folder_values(store.list_objects(spark, root), RUN_KEYS[:2]).select("cycle", "start_date", "n_files")


def _tree(spark, paths: DataFrame) -> str:
    """A folder tree with one file for every path (of one depth)."""
    depth = paths.select(F.max(F.size(F.split("path", "/")))).first()[0]
    names = [f"level{k}" for k in range(depth)]
    root = scratch_dir(spark, "tree")
    levels = paths.select(F.lit(1).alias("one"), *[store.segment(F.col("path"), k + 1).alias(n) for k, n in enumerate(names)])
    positional.write_positional(levels, root, names)
    return root


def q_gate_from_store(spark, d):
    """PL-12 on a store: the forecast's files as a folder tree, listed without opening any."""
    files = _listing(spark, d).withColumn("path", F.regexp_replace("path", "^notes/(.*)/index.html$", "notes/$1/index.html/x/x"))
    root = _tree(spark, materialize(files, "paths"))
    return planner.availability_gate(materialize(store.list_objects(spark, root), "listing"), "2024-01-29",
                                     required_files=1, horizon_tag="f006")


def q_latest_day_from_store(spark, d):
    """AG-07 on a store: the newest of the day folders of a dataset, whatever else lies beside them."""
    fc = _fc(spark, d).select("reference_datetime", "site_id")
    paths = fc.select(F.concat_ws("/", F.lit("stage1"), "reference_datetime", "site_id").alias("path")).union(
        fc.select(F.concat_ws("/", F.lit("stage1"), "site_id", F.lit("notes")).alias("path"))).distinct()
    root = _tree(spark, materialize(paths, "paths"))
    return planner.latest_landed_day(store.list_folders(store.list_objects(spark, root), 2))


def q_sync_objects(spark, d):
    """IO-13 by object: the copy lacks some runs, has others in part and one with other rows; it becomes the source."""
    rows = _runs(spark, d)
    src, dst = scratch_dir(spark, "objects-src"), scratch_dir(spark, "objects-dst")
    positional.write_positional(rows, src, RUN_KEYS)
    early = F.col("start_date") < "2024-01-10"
    part = rows.filter(early & F.coalesce(F.col("site_id") != "BARC", F.lit(True)))  # a site is missing from every early run
    positional.write_positional(part.filter((F.col("cycle") != 18) | (F.col("variable") == "TMP")), dst, RUN_KEYS)
    copied = objects.sync_objects(spark, src, dst)
    again = objects.sync_objects(spark, src, dst)
    back = datasets.read_positional(spark, dst, RUN_KEYS, rows.drop(*RUN_KEYS).schema)
    return back.withColumns({"copied": F.lit(not copied.isEmpty()), "copied_again": F.lit(again.count())})


def q_stage3_append_legacy(spark, d):
    ps = legacy.legacy_stage1(_ps(spark, d))
    hist = stages.legacy_stage3_frame(None, ps.filter(F.col("start_date") < UPDATE_SPLIT), UPDATE_SPLIT,
                                      start_date="2023-12-01")
    hist = materialize(hist.drop("reference_datetime"))
    return stages.legacy_stage3_frame(hist, ps, "2024-01-31", places=builtin_sites(spark))


def _odd_members(rows: DataFrame) -> DataFrame:
    """Member 1 becomes 100 and member 2 unknown."""
    p = F.col("parameter")
    return rows.withColumn("parameter", F.when(p == 1, 100).when(p != 2, p))


def q_legacy_members(spark, d):
    """The legacy append with member 100 and unknown members, each site's first time on every row."""
    ps = _odd_members(legacy.legacy_stage1(_ps(spark, d)))
    rows = stages.legacy_stage3_frame(None, ps, "2024-01-31", start_date="2023-12-01", places=builtin_sites(spark))
    return stages.legacy_reference_times(rows)


def _legacy_dates(s1: DataFrame) -> list[str]:
    """All start dates (one value a day)."""
    return sorted(r[0] for r in s1.select("start_date").distinct().collect() if r[0] is not None)


def _legacy_read(spark, root):
    schema = T.StructType([T.StructField("family", T.StringType()), T.StructField("parameter", T.IntegerType()),
                           T.StructField("datetime", T.TimestampNTZType()), T.StructField("variable", T.StringType()),
                           T.StructField("prediction", T.DoubleType()), T.StructField("reference_datetime", T.TimestampNTZType())])
    rows = datasets.read_positional(spark, root, ["cycle", "start_date", "site_id"], schema)
    return rows.withColumn("cycle", F.col("cycle").cast("int"))


def q_legacy_stage2_build(spark, d):
    """Every run of every date, through the write job (one folder a cycle, date and site)."""
    s1 = materialize(legacy.legacy_stage1(_ps(spark, d)))
    runs = planner.plan_runs(s1, None, _legacy_dates(s1), cycles=(0, 6, 12, 18), force=True)
    root = scratch_dir(spark, "legacy-stage2")
    stages.build_legacy_stage2(spark, s1, runs, builtin_sites(spark), root)
    return round_sw(_legacy_read(spark, root))


def q_legacy_chain(spark, d):
    """PL-17, legacy: stage 2 of every run and the stage-3 append; rows of both by site and variable."""
    s1 = materialize(legacy.legacy_stage1(_ps(spark, d)))
    s2, s3 = scratch_dir(spark, "legacy-chain2"), scratch_dir(spark, "legacy-chain3")
    stages.legacy_chain(spark, s1, s2, s3, builtin_sites(spark), _legacy_dates(s1), "2024-01-31", "2023-12-01")
    count = lambda df, n: df.groupBy("site_id", "variable").agg(
        F.count("*").alias("n"), F.count("prediction").alias("n_values"), F.max("datetime").alias("last")).select(F.lit(n).alias("stage"), "*")
    return count(_legacy_read(spark, s2), 2).unionByName(count(spark.read.parquet(s3), 3))


QUERIES = {
    "variable_filter": q_variable_filter,
    "site_semi_join": q_site_semi_join,
    "state_horizon_rule": q_state_horizon_rule,
    "flux_horizon_rule": q_flux_horizon_rule,
    "partition_inventory": q_partition_inventory,
    "stage1_backlog": q_stage1_backlog,
    "pseudo_backlog": q_pseudo_backlog,
    "stage2_backlog": q_stage2_backlog,
    "series_max_time": q_series_max_time,
    "batch_bounds": q_batch_bounds,
    "hourly_spine": q_hourly_spine,
    "observations_on_spine": q_observations_on_spine,
    "interpolate_states": q_interpolate_states,
    "backfill_fluxes": q_backfill_fluxes,
    "unit_conversion": q_unit_conversion,
    "cf_rename": q_cf_rename,
    "member_number": q_member_number,
    "solar_bin_step": q_solar_bin_step,
    "solar_potential": q_solar_potential,
    "daily_mean_broadcast": q_daily_mean_broadcast,
    "reshape_shortwave": q_reshape_shortwave,
    "repair_datetime": q_repair_datetime,
    "pseudo_overlap": q_pseudo_overlap,
    "to_hourly_forecast": q_to_hourly_forecast,
    "to_hourly_pseudo": q_to_hourly_pseudo,
    "to_hourly_no_solar": q_to_hourly_no_solar,
    "stage2_build": q_stage2_build,
    "stage2_chain": q_stage2_chain,
    "stage3_rebuild": q_stage3_rebuild,
    "stage3_update": q_stage3_update,
    "stage3_append_legacy": q_stage3_append_legacy,
    "stage3_chain": q_stage3_chain,
    "legacy_members": q_legacy_members,
    "legacy_chain": q_legacy_chain,
    "site_csv": q_site_csv,
    "positional_bare_scan": q_positional_bare_scan,
    "legacy_stage2_build": q_legacy_stage2_build,
    "site_horizon_reached": q_site_horizon_reached,
    "run_planner": q_run_planner,
    "run_planner_forced": q_run_planner_forced,
    "incomplete_dates": q_incomplete_dates,
    "availability_gate": q_availability_gate,
    "latest_landed_day": q_latest_landed_day,
    "report_stage1": q_report_stage1,
    "report_short_cycles": q_report_short_cycles,
    "report_stage2": q_report_stage2,
    "report_stage3": q_report_stage3,
    "positional_partition_scan": q_positional_partition_scan,
    "land_forecast": q_land_forecast,
    "sync_partitions": q_sync_partitions,
    "positional_sink": q_positional_sink,
    "listing_inventory": q_listing_inventory,
    "gate_from_store": q_gate_from_store,
    "latest_day_from_store": q_latest_day_from_store,
    "sync_objects": q_sync_objects,
    "stage3_update_published": q_stage3_update_published,
    "stage3_version_before": q_stage3_version_before,
    "stage2_published": q_stage2_published,
    "site_faults": q_site_faults,
    "series_exceptions": q_series_exceptions,
}
