"""Variable names, unit steps and member numbers (1.4, TS-07, SC-01)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from hourcast.schemas import (ACCUM_HOURS, CF_NAMES, KELVIN_OFFSET, RATE_NAME, RH_DIVISOR)


def cf_name(variable: Column | str, names: dict | None = None) -> Column:
    """Native name -> standard name; names not in the map pass through."""
    names = CF_NAMES if names is None else names
    variable = F.col(variable) if isinstance(variable, str) else variable
    m = F.create_map(*[F.lit(x) for x in chain(*names.items())])
    return F.coalesce(m[variable], variable)


def state_units(variable: Column, value: Column) -> Column:
    """TMP + 273, RH / 100, other states unchanged."""
    return (F.when(variable == "TMP", value + F.lit(KELVIN_OFFSET))
            .when(variable == "RH", value / F.lit(RH_DIVISOR))
            .otherwise(value))


def flux_units(variable: Column, value: Column, accum_hours: int = ACCUM_HOURS) -> Column:
    """APCP accumulation -> rate over ``accum_hours``; other fluxes unchanged."""
    return F.when(variable == "APCP", value / F.lit(float(accum_hours * 60 * 60))).otherwise(value)


def flux_rename(variable: Column) -> Column:
    return F.when(variable == "APCP", F.lit(RATE_NAME)).otherwise(variable)


def pad_left(x: Column | str, width: int, fill: str = "0") -> Column:
    """SC-04: left-pad to ``width``; longer text is kept whole (plain lpad would cut it)."""
    x = F.col(x) if isinstance(x, str) else x
    x = x.cast("string")
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, fill))


def member_number(ensemble: Column | str) -> Column:
    """Characters 4-5 of the member code as a number; anything else -> NULL."""
    ensemble = F.col(ensemble) if isinstance(ensemble, str) else ensemble
    return F.substring(ensemble, 4, 2).try_cast("double")
