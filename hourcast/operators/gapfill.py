"""Hourly gap filling without materialising a spine join (TS-01..TS-03, WN-01, WN-02).

Semantics, per series (batch, site, family, ensemble, variable):

* the hourly grid runs from the *batch* minimum time to the *series* maximum
  time (over all variables of that site/member), every batch variable gets it,
  even one the series never observed;
* observations off that grid are dropped; several observations at one hour
  all stay (a duplicate key), ordered by (NULL first, horizon, value);
* ``linear`` (states): a missing value is interpolated by row position between
  the previous and next observed values, leading/trailing gaps take the nearest
  value, and a series with fewer than two values stays as it is;
* ``up`` (fluxes): a missing value takes the next observed value; trailing
  gaps stay NULL.

Plan, designed so no task ever holds a whole series:

1. Rows are keyed by (series, chunk) where a chunk is ``chunk_days`` UTC days.
   One shuffle brings each chunk's observations together with a header row per
   (series, chunk) (so chunks and variables without data still produce hours).
2. One window pass per chunk computes, for every row, the previous knot
   (running ``last ... ignore nulls``), the next knot (``lead ... ignore
   nulls``), the next observation's hour and the duplicate count.
3. A per-chunk summary (first/last knot, knot count, duplicate count) is
   aggregated on the same partitioning, then a small window over chunks gives
   each chunk the knot before and after it and its position offset.
4. Each row expands (``posexplode(sequence)``) into the hours up to the next
   observation; values come from arithmetic on the two knots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from hourcast.functions.timecols import add_hours, epoch_hour, hours_between
from hourcast.sinks.util import materialize

KIND_HEADER = 0
KIND_OBS = 1


def uniq(cols) -> list[str]:
    """Column list without repeats, first occurrence kept."""
    return list(dict.fromkeys(cols))


def _q(name: str) -> str:
    return f"`{name}`"


def _over(part: list[str], order: list[str]) -> str:
    return f"OVER (PARTITION BY {', '.join(map(_q, part))} ORDER BY {', '.join(order)})"


def fill_hourly(obs: DataFrame, series: DataFrame, variables: DataFrame, batch_cols: list[str],
                method: dict[str, str], chunk_days: int = 30) -> DataFrame:
    """Fill every series onto its hourly grid.

    obs:       batch_cols + site_id, family, ensemble, variable, datetime, prediction, horizon
               (already filtered by the horizon rules).
    series:    batch_cols + site_id, family, ensemble, bmin, n_hours, e0
               (grid = bmin + 0..n_hours hours; e0 = epoch hour of bmin).
    variables: batch_cols + variable (the batch's variables to put on the grid).
    method:    variable -> 'linear' | 'up'; variables not in it are dropped.

    Returns (filled, chunks): filled has batch_cols + site_id, family, ensemble,
    variable, datetime, prediction, plus ``chunk`` (a co-partitioning key for
    later steps); chunks has the key + chunk + n_dups (extra duplicate rows) + n_knots (values).
    """
    ch = int(chunk_days) * 24
    skey = uniq(batch_cols + ["site_id", "family", "ensemble"])
    key = skey + ["variable"]
    ckey = key + ["chunk"]

    vars_kept = variables.filter(F.col("variable").isin(list(method)))
    sv = series.join(vars_kept, batch_cols)  # header source: one row per (series, variable)

    c_lo = F.floor(F.col("e0") / ch)
    c_hi = F.floor((F.col("e0") + F.col("n_hours")) / ch)
    headers = (sv.withColumn("chunk", F.explode(F.sequence(c_lo, c_hi)))
               .select(*key, "chunk",
                       F.lit(KIND_HEADER).alias("kind"),
                       F.lit(None).cast("long").alias("k"),
                       F.lit(None).cast("double").alias("prediction"),
                       F.lit(None).cast("string").alias("horizon"),
                       "bmin", "n_hours", "e0"))

    o = obs.filter(F.col("variable").isin(list(method)))
    if not {"bmin", "n_hours", "e0"} <= set(obs.columns):  # series columns not attached yet
        o = o.join(series.select(*skey, "bmin", "n_hours", "e0"), skey)
    o = o.withColumn("k", hours_between("bmin", "datetime"))
    # keep observations on the hourly grid of the batch
    o = o.filter((F.col("k") >= 0) & (F.col("k") <= F.col("n_hours"))
                 & (add_hours("bmin", F.col("k")) == F.col("datetime")))
    o = o.select(*key, F.floor((F.col("e0") + F.col("k")) / ch).alias("chunk"),
                 F.lit(KIND_OBS).alias("kind"), "k", "prediction", "horizon",
                 "bmin", "n_hours", "e0")

    # chunk range of hours (relative to bmin); one ordering for every window
    # below (a real column, not an expression, so Spark sorts once and stacks
    # the window passes on that sort)
    # (chunk is never NULL; said here, so that the join below adds no such filter to one of its sides only)
    u = headers.unionByName(o).filter(F.col("chunk").isNotNull()).select(
        "*",
        F.greatest(F.lit(0).cast("long"), F.col("chunk") * ch - F.col("e0")).alias("k_lo"),
        F.least(F.col("n_hours"), (F.col("chunk") + 1) * ch - 1 - F.col("e0")).alias("k_hi"),
        F.col("prediction").isNotNull().alias("has_value"))
    order_cols = ["kind", "k", "has_value", F.col("horizon").asc_nulls_first(),
                  F.col("prediction").asc_nulls_first()]
    w = W.partitionBy(*ckey).orderBy(*order_cols)
    wrun = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    over = _over(ckey, ["`kind`", "`k`", "`has_value`", "`horizon` ASC NULLS FIRST",
                        "`prediction` ASC NULLS FIRST"])

    # pass 1: next observation's hour, duplicate flag
    u = u.select("*", F.lead("k").over(w).alias("next_k"), F.lag("k").over(w).alias("lag_k"))
    # pass 2: duplicates so far (positions count rows, not hours)
    dup = F.when((F.col("kind") == KIND_OBS) & (F.col("k") == F.col("lag_k")), 1).otherwise(0)
    u = u.select("*", dup.alias("dup"), F.sum(dup).over(wrun).alias("dups"))
    is_knot = (F.col("kind") == KIND_OBS) & F.col("has_value")
    u = u.select("*", F.when(is_knot, F.col("k") + F.col("dups")).alias("kp"),
                 F.when(is_knot, F.col("prediction")).alias("kv"))
    # pass 3: previous knot (at or before), next knot (strictly after)
    u = u.select("*",
                 F.last("kp", True).over(wrun).alias("prev_p"),
                 F.last("kv", True).over(wrun).alias("prev_v"),
                 F.expr(f"lead(`kp`) IGNORE NULLS {over}").alias("next_p"),
                 F.expr(f"lead(`kv`) IGNORE NULLS {over}").alias("next_v"))

    # per-chunk summary. It takes the chunk's grid along, so it needs the very columns that the rows themselves
    # need, and the planner reuses the one exchange of the observations for both
    grid = ["bmin", "k_lo", "k_hi"]
    summ = (u.groupBy(*ckey)
            .agg(F.count("kv").alias("n_knots"), F.sum("dup").alias("n_dups"),
                 F.min("kp").alias("first_p"), F.min_by("kv", "kp").alias("first_v"),
                 F.max("kp").alias("last_p"), F.max_by("kv", "kp").alias("last_v"),
                 *[F.max(c).alias(f"chunk_{c}") for c in grid]))
    wk = W.partitionBy(*key).orderBy("chunk")
    summ = summ.withColumn("off", F.coalesce(
        F.sum("n_dups").over(wk.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")))
    summ = summ.select("*", (F.col("first_p") + F.col("off")).alias("first_g"),
                       (F.col("last_p") + F.col("off")).alias("last_g"))
    before = wk.rowsBetween(W.unboundedPreceding, -1)
    after = wk.rowsBetween(1, W.unboundedFollowing)
    summ = summ.select(
        *ckey, "off", "n_dups", "n_knots", *[f"chunk_{c}" for c in grid],
        F.last("last_g", True).over(before).alias("pc_p"),
        F.last("last_v", True).over(before).alias("pc_v"),
        F.first("first_g", True).over(after).alias("nc_p"),
        F.first("first_v", True).over(after).alias("nc_v"),
        F.sum("n_knots").over(W.partitionBy(*key)).alias("n_knots_series"))

    r = u.join(summ, ckey)
    r = r.withColumns({c: F.coalesce(f"chunk_{c}", c) for c in grid})

    # hours each row stands for: an observation itself plus the gap after it
    g_lo = F.when(F.col("kind") == KIND_OBS, F.col("k")).otherwise(F.col("k_lo"))
    g_hi0 = F.coalesce(F.col("next_k") - 1, F.col("k_hi"))
    g_hi = F.when(F.col("kind") == KIND_OBS, F.greatest(F.col("k"), g_hi0)).otherwise(g_hi0)
    r = r.withColumn("hours", F.when(g_hi >= g_lo, F.sequence(g_lo, g_hi))
                     .otherwise(F.array().cast("array<long>")))
    r = r.select("*", F.posexplode("hours").alias("pos", "kk"))

    is_self = (F.col("kind") == KIND_OBS) & (F.col("pos") == 0)
    own = F.when(is_self, F.col("prediction"))
    p = (F.col("kk") + F.col("dups") + F.col("off")).cast("double")
    p0 = F.coalesce(F.col("prev_p") + F.col("off"), F.col("pc_p")).cast("double")
    v0 = F.when(F.col("prev_p").isNotNull(), F.col("prev_v")).otherwise(F.col("pc_v"))
    p1 = F.coalesce(F.col("next_p") + F.col("off"), F.col("nc_p")).cast("double")
    v1 = F.when(F.col("next_p").isNotNull(), F.col("next_v")).otherwise(F.col("nc_v"))

    linear = (F.when(own.isNotNull(), own)
              .when(F.col("n_knots_series") < 2, F.lit(None))
              .when(p0.isNull(), v1)
              .when(p1.isNull(), v0)
              .otherwise(v0 + (v1 - v0) * ((p - p0) / (p1 - p0))))
    up = F.coalesce(own, v1)
    mcol = F.create_map(*[F.lit(x) for kv in method.items() for x in kv])[F.col("variable")]
    value = F.when(mcol == "linear", linear).otherwise(up)

    filled = r.select(*key, "chunk", add_hours("bmin", F.col("kk")).alias("datetime"),
                      value.cast("double").alias("prediction"))
    return filled, summ.select(*ckey, "n_dups", "n_knots")


def series_tables(obs: DataFrame, batch_cols: list[str]):
    """Series and batch-variable tables from the raw batch (all variables, all horizons).

    Returns (series, variables, stats): series has batch_cols + site_id, family, ensemble,
    bmin, bmax, smax, n_hours, e0; variables has batch_cols + variable; stats is
    the materialised per (series, variable) table both are derived from (its
    row count bounds theirs).
    """
    skey = uniq(batch_cols + ["site_id", "family", "ensemble"])
    sv = materialize(obs.groupBy(*skey, "variable").agg(F.min("datetime").alias("vmin"),
                                                       F.max("datetime").alias("vmax")))
    series = sv.groupBy(*skey).agg(F.min("vmin").alias("smin"), F.max("vmax").alias("smax"))
    bounds = series.groupBy(*batch_cols).agg(F.min("smin").alias("bmin"), F.max("smax").alias("bmax"))
    if batch_cols:  # an aggregate and a join: no task holds a batch's series
        series = series.join(bounds, batch_cols)
    else:
        series = series.withColumns({c: bounds.select(c).scalar() for c in ("bmin", "bmax")})
    series = (series.withColumn("n_hours", hours_between("bmin", "smax"))
              .withColumn("e0", epoch_hour("bmin"))
              .drop("smin"))
    variables = sv.select(*batch_cols, "variable").distinct()
    return series, variables, sv
