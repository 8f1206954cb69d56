"""Explicit hourly grid (TS-01) and observations placed on it (JN-04).

``to_hourly`` never materialises the grid as a join input; these operators
exist for inspection and reports, and build the grid chunk by chunk so the
hours of one long series are generated by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourcast.functions.timecols import add_hours
from hourcast.operators import gapfill
from hourcast.operators.hourly import prepare
from hourcast.operators.pseudo import flux_horizon_rule, state_horizon_rule
from hourcast.schemas import FLUX_VARIABLES, STATE_VARIABLES


def hourly_spine(df: DataFrame, batch_cols=("reference_datetime",), chunk_days: int = 30) -> DataFrame:
    """Per batch: every (site, family, ensemble) present x every batch variable x
    every hour from the batch's first time to that series' last time."""
    B = list(batch_cols)
    series, variables, _ = gapfill.series_tables(prepare(df, B), B)
    skey = gapfill.uniq(B + ["site_id", "family", "ensemble"])
    ch = chunk_days * 24
    sv = series.join(variables, B)
    c_lo = F.floor(F.col("e0") / ch)
    c_hi = F.floor((F.col("e0") + F.col("n_hours")) / ch)
    chunks = sv.withColumn("chunk", F.explode(F.sequence(c_lo, c_hi)))
    chunks = chunks.hint("rebalance")  # as many tasks as the series table's size asks for
    k_lo = F.greatest(F.lit(0).cast("long"), F.col("chunk") * ch - F.col("e0"))
    k_hi = F.least(F.col("n_hours"), (F.col("chunk") + 1) * ch - 1 - F.col("e0"))
    hours = chunks.withColumn("k", F.explode(F.sequence(k_lo, k_hi)))
    return hours.select(*skey, "variable", add_hours("bmin", F.col("k")).alias("datetime"))


def observations_on_spine(df: DataFrame, batch_cols=("reference_datetime",), pseudo: bool = False,
                          chunk_days: int = 30) -> DataFrame:
    """JN-04: observations (after the horizon rules) right-joined onto the grid;
    off-grid observations drop out, several at one hour all stay."""
    B = list(batch_cols)
    spine = hourly_spine(df, B, chunk_days)
    src = prepare(df, B)
    skey = gapfill.uniq(B + ["site_id", "family", "ensemble"])
    bmax = src.groupBy(*B).agg(F.max("datetime").alias("bmax"))
    obs = (src.join(bmax, B) if B
           else src.withColumn("bmax", bmax.select("bmax").scalar()))
    keep = (F.when(F.col("variable").isin(STATE_VARIABLES), state_horizon_rule(pseudo))
            .when(F.col("variable").isin(FLUX_VARIABLES), flux_horizon_rule()).otherwise(F.lit(False)))
    obs = obs.filter(keep).select(*skey, "variable", "datetime", "prediction")
    spine = spine.filter(F.col("variable").isin(STATE_VARIABLES + FLUX_VARIABLES))
    return spine.join(obs, skey + ["variable", "datetime"], "left")
