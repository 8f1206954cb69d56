"""Fixed vocabularies and table schemas.

Everything in the "fixed values" blocks must stay equal to the upstream
pipeline's values for results to match; they are stated here once, in their
natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Native forecast variables, their class, unit steps and names.
# ---------------------------------------------------------------------------
NATIVE_VARIABLES = ["PRES", "TMP", "RH", "UGRD", "VGRD", "APCP", "DSWRF", "DLWRF"]
STATE_VARIABLES = ["PRES", "RH", "TMP", "UGRD", "VGRD"]
FLUX_VARIABLES = ["APCP", "DSWRF", "DLWRF"]
KELVIN_OFFSET = 273.0          # TMP + 273 (not 273.15)
RH_DIVISOR = 100.0             # RH / 100
ACCUM_HOURS = 6                # APCP / (6 * 60 * 60), renamed PRATE
RATE_NAME = "PRATE"
SHORTWAVE = "DSWRF"
SOLAR_CONSTANT = 1366.0
# Output names (UGRD/VGRD are swapped against their usual meaning, kept as is).
CF_NAMES = {
    "TMP": "air_temperature",
    "PRES": "air_pressure",
    "RH": "relative_humidity",
    "DLWRF": "surface_downwelling_longwave_flux_in_air",
    "DSWRF": "surface_downwelling_shortwave_flux_in_air",
    "PRATE": "precipitation_flux",
    "VGRD": "eastward_wind",
    "UGRD": "northward_wind",
    "APCP": "precipitation_amount",
}
# Horizon codes the pseudo-observation rules look at.
STATE_DROP_HORIZON = "006"     # states: drop unless at the batch's newest time
FLUX_DROP_HORIZON = "003"      # fluxes: drop exactly this code
# Completeness thresholds of the planners.
FULL_HORIZON = 840
MEMBER_LIMIT = 31
GATE_HORIZON_TAG = "f384"
GATE_MEMBER_TAG = "gep"
# Default start dates of the landing backlogs.
STAGE1_START = "2024-02-01"
PSEUDO_START = "2020-10-01"
LEGACY_START = "2020-09-25"
# ---------------------------------------------------------------------------

# Table schemas.
STAGE1 = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("ensemble", T.StringType()),
    T.StructField("horizon", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("variable", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("reference_datetime", T.StringType()),
])

PSEUDO = T.StructType(STAGE1.fields[:4] + [T.StructField("cycle", T.StringType())] + STAGE1.fields[4:])

SITES = T.StructType([
    T.StructField("site_name", T.StringType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
