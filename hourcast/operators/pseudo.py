"""Pseudo-observation rules (PF-05, PF-06, TS-08, TS-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hourcast.schemas import FLUX_DROP_HORIZON, STATE_DROP_HORIZON


def state_horizon_rule(pseudo: bool, bmax: str = "bmax") -> Column:
    """States: forecasts keep every horizon; pseudo-observations drop hour 6
    except at the batch's newest time. A NULL horizon is dropped unless at the
    newest time (three-valued logic, as in the original filter)."""
    if not pseudo:
        return F.lit(True)
    return (F.col("horizon") != STATE_DROP_HORIZON) | (F.col("datetime") == F.col(bmax))


def flux_horizon_rule() -> Column:
    """Fluxes: drop exactly horizon '003' (and NULL horizons)."""
    return F.col("horizon") != FLUX_DROP_HORIZON


def repair_datetime(df: DataFrame) -> DataFrame:
    """TS-08: valid time = date(reference_datetime) + horizon h + cycle h.

    Where the stored datetime differs, the rebuilt one wins; a NULL in any input
    gives NULL (only non-NULL stored times are replaced).
    """
    base = F.to_date(F.col("reference_datetime").cast("string")).cast("timestamp_ntz")
    hz = F.col("horizon").try_cast("int")
    cy = F.col("cycle").try_cast("int")
    new = F.timestamp_add("HOUR", cy, F.timestamp_add("HOUR", hz, base))
    dt = F.col("datetime").cast("timestamp_ntz")
    return df.withColumn("datetime", F.when(dt != new, new).otherwise(F.when(new.isNotNull(), dt)))
