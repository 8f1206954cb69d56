"""to_hourly (TS-10): coarse ensemble forecasts -> hourly, converted, renamed.

One call handles any number of *batches* at once. A batch is what one call of
the original per-date / per-site loop saw: every "global" (start time, newest
time, variable set, solar bin step) is taken per batch, and batch_cols are part
of every grouping, window and join key. Use ``["reference_datetime"]`` for
forecast builds and ``["site_id"]`` for pseudo-observation histories.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from hourcast.functions.naming import cf_name, flux_rename, flux_units, state_units
from hourcast.operators import gapfill
from hourcast.operators.pseudo import flux_horizon_rule, state_horizon_rule
from hourcast.operators.solar_ops import add_potential, bin_step_seconds, reshape_shortwave
from hourcast.schemas import ACCUM_HOURS, CF_NAMES, FLUX_VARIABLES, SHORTWAVE, STATE_VARIABLES
from hourcast.sinks.util import materialize


def _batch_cols(batch_cols) -> list[str]:
    return list(batch_cols or [])


def prepare(df: DataFrame, batch_cols: list[str]) -> DataFrame:
    """Project the input to the columns the operator uses; NaN is stored as NULL."""
    cols = set(df.columns)
    horizon = F.col("horizon").cast("string") if "horizon" in cols else F.lit(None).cast("string")
    extra = [c for c in batch_cols if c not in ("site_id", "family", "ensemble")]
    return df.select(*extra, "site_id", "family", "ensemble", "datetime", "variable",
                     F.nanvl(F.col("prediction").cast("double"), F.lit(None).cast("double"))
                     .alias("prediction"), horizon.alias("horizon"),
                     *([F.col("reference_datetime")] if "reference_datetime" in cols
                       and "reference_datetime" not in extra else []))


def encode_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, dict]:
    """Key columns as text that is never NULL, and their types.

    The reference's joins match missing to missing; with keys encoded once, every
    grouping, window and equi-join treats a NULL key as a value like any other.
    """
    types = {k: df.schema[k].dataType for k in keys}
    return df.withColumns({k: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys}), types


def decode_keys(df: DataFrame, types: dict) -> DataFrame:
    """The key columns as they were (columns that are absent are skipped)."""
    return df.withColumns({k: F.when(F.col(k) != "", F.substring(F.col(k), 2, 1 << 30)).cast(t)
                           for k, t in types.items() if k in df.columns})


def disaggregate(df: DataFrame, batch_cols=("reference_datetime",), pseudo: bool = False,
                 horizon_rules: bool = True, accum_hours: int = ACCUM_HOURS,
                 chunk_days: int = 30, methods: dict | None = None, convert: bool = True):
    """Steps TS-01..TS-03: grid, horizon rules, fills, unit steps.

    Returns a namespace with ``filled`` (batch cols + site_id, family, ensemble,
    variable, datetime, prediction, chunk), ``chunks``, ``series``, ``variables``,
    ``skey`` and ``key_types``. Key columns are encoded; ``decode_keys`` gives
    them back.
    """
    B = _batch_cols(batch_cols)
    skey = gapfill.uniq(B + ["site_id", "family", "ensemble"])
    src, key_types = encode_keys(prepare(df, B), skey)
    series, variables, _ = gapfill.series_tables(src, B)
    # one join attaches everything the rules and the fill need from the series table
    obs = src.join(series.select(*skey, "bmax", "bmin", "n_hours", "e0"), skey)
    if horizon_rules:
        keep = (F.when(F.col("variable").isin(STATE_VARIABLES), state_horizon_rule(pseudo))
                .when(F.col("variable").isin(FLUX_VARIABLES), flux_horizon_rule())
                .otherwise(F.lit(False)))
        obs = obs.filter(keep)
    if methods is None:
        methods = {v: "linear" for v in STATE_VARIABLES}
        methods.update({v: "up" for v in FLUX_VARIABLES})
    filled, chunks = gapfill.fill_hourly(obs.drop("bmax"), series, variables, B, methods, chunk_days)
    if convert:
        is_state = F.col("variable").isin(STATE_VARIABLES)
        value = F.when(is_state, state_units(F.col("variable"), F.col("prediction"))) \
            .otherwise(flux_units(F.col("variable"), F.col("prediction"), accum_hours))
        # the APCP -> PRATE rename waits until the end: renaming a key column here
        # would hide the (series, chunk) partitioning from the solar windows
        filled = filled.withColumn("prediction", value)
    return SimpleNamespace(filled=filled, chunks=chunks, series=series, variables=variables,
                           skey=skey, B=B, src=src, key_types=key_types)


def series_exceptions(d) -> DataFrame:
    """TS-02 / TS-09: what ``disaggregate`` (its result ``d``) could not do as usual, one row a series with something to report.

    Columns: batch cols, site_id, family, ensemble, variable, ``n_values`` (observed values on the grid),
    ``n_duplicates`` (rows beyond the first of an hour; they all survive) and ``unfilled`` (a state with
    fewer than two values, left as it is). Added up from the chunk summaries that the filling itself uses, so no
    observation is read or moved for it.
    """
    per = d.chunks.groupBy(*d.skey, "variable").agg(F.sum("n_knots").alias("n_values"), F.sum("n_dups").alias("n_duplicates"))
    per = per.withColumn("unfilled", F.col("variable").isin(STATE_VARIABLES) & (F.col("n_values") < 2))
    return decode_keys(per.filter(F.col("unfilled") | (F.col("n_duplicates") > 0)), d.key_types)


def with_potential(d, sites: DataFrame, bin_seconds: float | None = None,
                   rows: DataFrame | None = None, only: str | None = None) -> DataFrame:
    """TS-04/TS-05: rows of ``disaggregate`` output with rpot attached.

    ``rows`` defaults to the flux rows; with ``only`` set, rpot is computed for
    that variable and NULL elsewhere (the rows pass through unchanged).
    """
    out = d.filled.filter(~F.col("variable").isin(STATE_VARIABLES)) if rows is None else rows
    B = d.B
    if bin_seconds is None:
        dt = solar_bin_table(flux_duplicates(d.src, d.series, B, d.variables), d.series, d.variables, B)
        out = (out.join(dt, B, "left") if B
               else out.withColumn("bin_seconds", dt.select("bin_seconds").scalar()))
    else:
        out = out.withColumn("bin_seconds", F.lit(float(bin_seconds)))
    coded, _ = encode_keys(sites.select("site_id", "latitude", "longitude"), ["site_id"])
    return add_potential(out, coded, only=only)


def to_hourly(df: DataFrame, sites: DataFrame | None = None, batch_cols=("reference_datetime",),
              pseudo: bool = False, use_solar_geom: bool = True, horizon_rules: bool = True,
              accum_hours: int = ACCUM_HOURS, bin_seconds: float | None = None,
              names: dict | None = CF_NAMES, chunk_days: int = 30,
              keep_chunk: bool = False) -> DataFrame:
    """Disaggregate a long forecast table to hourly values.

    df columns: site_id, family, ensemble, horizon (3-digit text), datetime,
    variable (native names), prediction, reference_datetime, plus batch_cols.
    sites: site_id, latitude, longitude (needed when use_solar_geom).

    Output: batch_cols + site_id, family, ensemble, datetime, variable,
    prediction, reference_datetime (batch issue time as timestamp, or NULL
    for pseudo-observations).
    """
    d = disaggregate(df, batch_cols, pseudo, horizon_rules, accum_hours, chunk_days)
    B, out = d.B, d.filled
    if use_solar_geom:
        if sites is None:
            raise ValueError("use_solar_geom needs a sites table (site_id, latitude, longitude)")
        # one pipeline for all variables: rpot only where it is used (shortwave),
        # daily means on the (series, chunk) partitioning the rows already have
        out = with_potential(d, sites, bin_seconds, rows=out, only=SHORTWAVE)
        out = reshape_shortwave(out, d.skey + ["variable", "chunk"], SHORTWAVE).drop("rpot", "bin_seconds")

    out = decode_keys(out, d.key_types).withColumn("variable", flux_rename(F.col("variable")))
    if names is not None:
        out = out.withColumn("variable", cf_name(F.col("variable"), names))
    out = out.withColumn("reference_datetime", _reference(d.src, B, pseudo))
    cols = [c for c in B if c not in ("site_id", "family", "ensemble", "reference_datetime")]
    cols += ["site_id", "family", "ensemble", "datetime", "variable", "prediction", "reference_datetime"]
    # PF-16: output columns follow the input's column order where they exist
    cols = [c for c in df.columns if c in cols] + [c for c in cols if c not in df.columns]
    if keep_chunk:
        cols.append("chunk")
    return out.select(*cols)


def _reference(src: DataFrame, B: list[str], pseudo: bool):
    """Issue time of the batch as a timestamp; NULL for pseudo-observations."""
    if pseudo or "reference_datetime" not in src.columns:
        return F.lit(None).cast("timestamp_ntz")
    if "reference_datetime" in B:
        return F.to_timestamp_ntz(F.col("reference_datetime").cast("string"))
    raise ValueError("forecast batches need reference_datetime among batch_cols")


def solar_bin_table(dups: DataFrame, series: DataFrame, variables: DataFrame,
                    B: list[str]) -> DataFrame:
    """Per batch: exact median step (seconds) of the flux frame (TS-05).

    dups: batch cols + n_dups (extra flux rows from several observations at one
    hour), e.g. ``flux_duplicates``.
    """
    nflux = (variables.filter(F.col("variable").isin(FLUX_VARIABLES))
             .groupBy(*B).agg(F.count("*").alias("n_vars")))
    return bin_step_seconds(series, B, nflux, dups)


def flux_duplicates(src: DataFrame, series: DataFrame, B: list[str], variables: DataFrame) -> DataFrame:
    """Extra flux rows per batch: on-grid flux observations (after the flux
    horizon rule) sharing an hour with another.

    Only batches with a single flux variable are looked at. With two or more the
    steps of zero, (variables - 1) for every hour, outnumber all other steps, so the
    median is 0 whatever the duplicates; their rows are not read.
    """
    skey = gapfill.uniq(B + ["site_id", "family", "ensemble"])
    one = (variables.filter(F.col("variable").isin(FLUX_VARIABLES)).groupBy(*B)
           .agg(F.count("*").alias("n")).filter(F.col("n") == 1))
    if B:
        found = materialize(one.select(*B), "one_flux_batches")  # from the small series statistics
        if found.isEmpty():
            return src.sparkSession.createDataFrame([], T.StructType(
                [*(src.schema[c] for c in B), T.StructField("n_dups", T.LongType())]))
        src = src.join(found, B, "left_semi")
    o = (src.filter(F.col("variable").isin(FLUX_VARIABLES) & flux_horizon_rule())
         .select(*skey, "variable", "datetime")
         .join(series.select(*skey, "bmin"), skey))
    k = F.timestamp_diff("HOUR", F.col("bmin"), F.col("datetime"))
    o = o.filter(F.timestamp_add("HOUR", k, F.col("bmin")) == F.col("datetime"))
    per_hour = o.groupBy(*skey, "variable", "datetime").agg(F.count("*").alias("n"))
    return (per_hour.filter(F.col("n") > 1).groupBy(*B)
            .agg(F.sum(F.col("n") - 1).alias("n_dups")))
