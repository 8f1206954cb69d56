"""Solar steps on tables: bin step (TS-05) and shortwave reshaping (TS-06, WN-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from hourcast.functions.solar import potential_shortwave, wrap_longitude
from hourcast.functions.timecols import add_hours, day_of_year_frac

STEP = 1.0 / 24  # the usual difference of day-of-year between successive hours


def bin_step_seconds(series: DataFrame, batch_cols: list[str], n_flux_vars: DataFrame,
                     flux_dups: DataFrame) -> DataFrame:
    """Exact median time step of the flux frame, per batch, in seconds.

    The flux frame of a batch, sorted by (site, family, ensemble, datetime), holds
    for every series every hour from the batch start to the series end, once
    per flux variable, plus duplicate observation rows. The median of
    successive day-of-year differences over that whole frame is found from
    counts instead of a global sort:

    * zeros: rows sharing an hour with the row before (V-1 per hour, plus duplicates);
    * one step of 1/24 day between successive hours of a series;
    * a year wrap (Dec 31 23:00 -> Jan 1 00:00) where a series crosses a year;
    * one jump back to the batch start between successive series.

    A weighted median over this small histogram equals the median over the frame
    (up to the last bits of the 1/24 steps). Returns batch_cols + bin_seconds.

    series:      batch_cols + site_id, family, ensemble, bmin, n_hours
    n_flux_vars: batch_cols + n_vars   (flux variables on the grid, > 0)
    flux_dups:   batch_cols + n_dups   (extra duplicate flux rows)
    """
    skey = ["site_id", "family", "ensemble"]
    ws = W.partitionBy(*batch_cols).orderBy(*skey) if batch_cols else W.orderBy(*skey)
    end = add_hours("bmin", F.col("n_hours"))
    s = (series.join(n_flux_vars, batch_cols)
         .select(*batch_cols, "n_vars", "n_hours", "bmin", end.alias("end"),
                 F.lead(F.lit(1)).over(ws).isNull().alias("is_last")))
    # every series row emits its share of the histogram (value, weight)
    wrap_years = F.sequence(F.year("bmin") + 1, F.greatest(F.year("end"), F.year("bmin")))
    wrap_value = lambda y: F.lit(1.0) - (F.dayofyear(F.make_date(y - 1, F.lit(12), F.lit(31)))
                                         + F.lit(23) / 24)
    n_wrap = F.year("end") - F.year("bmin")
    parts = F.concat(
        F.array(
            F.struct(F.lit(0.0).alias("value"),
                     ((F.col("n_vars") - 1) * (F.col("n_hours") + 1)).alias("w")),
            F.struct(F.lit(STEP).alias("value"), (F.col("n_hours") - n_wrap).alias("w")),
            F.struct((day_of_year_frac("bmin") - day_of_year_frac("end")).alias("value"),
                     F.when(F.col("is_last"), 0).otherwise(1).cast("long").alias("w"))),
        F.transform(F.when(n_wrap > 0, wrap_years).otherwise(F.array().cast("array<int>")),
                    lambda y: F.struct(wrap_value(y).alias("value"), F.lit(1).cast("long").alias("w"))))
    per_series = s.select(*batch_cols, F.explode(parts).alias("h")).select(*batch_cols, "h.value", "h.w")
    dups = flux_dups.select(*batch_cols, F.lit(0.0).alias("value"), F.col("n_dups").cast("long").alias("w"))
    hist = (per_series.unionByName(dups).filter(F.col("w") > 0)
            .groupBy(*batch_cols, "value").agg(F.sum("w").alias("w")))
    wb = W.partitionBy(*batch_cols) if batch_cols else W.partitionBy(F.lit(0))
    hist = hist.select("*", F.sum("w").over(wb).alias("n"),
                       F.sum("w").over(wb.orderBy("value").rowsBetween(W.unboundedPreceding, 0)).alias("cum"))
    lo = F.floor((F.col("n") + 1) / 2)
    hi = F.floor(F.col("n") / 2) + 1
    med = (hist.groupBy(*batch_cols)
           .agg(F.min(F.when(F.col("cum") >= lo, F.col("value"))).alias("v_lo"),
                F.min(F.when(F.col("cum") >= hi, F.col("value"))).alias("v_hi")))
    return med.select(*batch_cols, ((F.col("v_lo") + F.col("v_hi")) / 2 * 86400).alias("bin_seconds"))


def add_potential(fluxes: DataFrame, sites: DataFrame, dt_col: str = "bin_seconds",
                  only: str | None = None) -> DataFrame:
    """Attach rpot (potential shortwave) to every row (or only to rows of
    variable ``only``; NULL elsewhere); unknown sites get NULL."""
    doy = day_of_year_frac("datetime")
    f = fluxes.join(sites.select("site_id", "latitude", "longitude"), "site_id", "left")
    rpot = potential_shortwave(F.col("doy"), wrap_longitude("longitude"), F.col("latitude"), F.col(dt_col))
    # SC-18: the equation of time is only defined for day-of-year <= 367; a
    # violation stops the job, as the original assertion does (never for real dates)
    rpot = F.when(F.assert_true(F.col("doy") <= 367, "day of year above 367").isNull(), rpot)
    if only is not None:
        rpot = F.when(F.col("variable") == only, rpot)
    return (f.withColumn("doy", doy).withColumn("rpot", rpot)
            .drop("doy", "latitude", "longitude"))


def daily_means(fluxes: DataFrame, group_cols: list[str], only: str | None = None) -> DataFrame:
    """WN-03: daily mean of rpot and of the value (NULLs skipped), on every row.

    With ``only``, just that variable's rows form days; the others are groups of one
    hour (their means are of no use), so that they pass without a wide frame.

    The frame is the whole day, read in time order, so the floating-point sum
    is the same on every run and every retry.
    """
    wd = (W.partitionBy(*group_cols, "_day")
          .orderBy("datetime", F.col("prediction").asc_nulls_first())
          .rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    day = F.to_date("datetime").cast("timestamp_ntz")
    if only is not None:
        day = F.when(F.col("variable") == only, day).otherwise(F.col("datetime"))
    return (fluxes.withColumn("_day", day)
            .select("*", F.avg("rpot").over(wd).alias("avg_rpot"),
                    F.avg("prediction").over(wd).alias("avg_sw"))
            .drop("_day"))


def reshape_shortwave(fluxes: DataFrame, group_cols: list[str], shortwave: str = "DSWRF") -> DataFrame:
    """Give daily shortwave the diurnal shape of rpot, keeping the daily mean.

    For the shortwave variable: rpot * (daily mean value / daily mean rpot)
    where the daily mean rpot is > 0; the value is kept where it is <= 0 (polar
    night); NULL where it is unknown (site without coordinates). Daily means
    skip NULLs and are taken per ``group_cols`` + UTC date.
    """
    f = daily_means(fluxes, group_cols, only=shortwave)
    is_sw = F.col("variable") == shortwave
    new = (F.when(~is_sw, F.col("prediction"))
           .when(F.col("avg_rpot") > 0, F.col("rpot") * (F.col("avg_sw") / F.col("avg_rpot")))
           .when(F.col("avg_rpot") <= 0, F.col("prediction")))
    return f.withColumn("prediction", new).drop("avg_rpot", "avg_sw")
