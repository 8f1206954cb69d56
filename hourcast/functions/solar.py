"""Solar geometry as column expressions (TS-04).

Formulas for the equation of time, the cosine of the solar zenith angle and
potential shortwave radiation. All times are UTC; ``doy`` is day of year plus
hour/24, longitudes are in 0-360.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from hourcast.schemas import SOLAR_CONSTANT

PI = math.pi


def _c(x):
    return F.col(x) if isinstance(x, str) else (F.lit(x) if isinstance(x, (int, float)) else x)


# ---------------------------------------------------------------------------
# Coefficients of the published equation of time (seconds) and the
# sun's declination at the solstices (degrees).
# ---------------------------------------------------------------------------
EOT_PHASE = (279.5, 0.9856)
EOT_SIN = {1: -104.7, 2: 596.2, 4: 4.3}
EOT_COS = {1: -429.3, 2: -2.0, 3: 19.3}
DECLINATION = -23.45
# ---------------------------------------------------------------------------


def equation_of_time(doy) -> Column:
    """Equation of time in hours."""
    doy = _c(doy)
    f = F.lit(PI) / 180 * (F.lit(EOT_PHASE[0]) + F.lit(EOT_PHASE[1]) * doy)
    terms = [F.lit(a) * F.sin(f if k == 1 else k * f) for k, a in EOT_SIN.items()]
    terms += [F.lit(a) * F.cos(f if k == 1 else k * f) for k, a in EOT_COS.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total / 3600


def cos_zenith(doy, lat, lon, dt, hr) -> Column:
    """Cosine of the solar zenith angle, clipped at 0 (NULL stays NULL).

    ``dt`` is the length of a time bin in seconds; the solar time is shifted to
    the middle of the bin.
    """
    doy, lat, lon, dt, hr = map(_c, (doy, lat, lon, dt, hr))
    et = equation_of_time(doy)
    merid0 = F.floor(lon / 15).cast("double") * 15
    merid = F.when(merid0 < 0, merid0 + 15).otherwise(merid0)
    lc = (lon - merid) * -4 / 60
    tz = merid / 360 * 24
    midbin = F.lit(0.5) * dt / 86400 * 24
    t0 = F.lit(12.0) + lc - et - tz - midbin
    h = F.lit(PI) / 12 * (hr - t0)
    dec = F.lit(DECLINATION) * F.lit(PI) / 180 * F.cos(2 * F.lit(PI) * (doy + 10) / 365)
    cosz = (F.sin(lat * F.lit(PI) / 180) * F.sin(dec)
            + F.cos(lat * F.lit(PI) / 180) * F.cos(dec) * F.cos(h))
    return F.when(cosz < 0, F.lit(0.0)).otherwise(cosz)


def potential_shortwave(doy, lon, lat, dt) -> Column:
    """Top-of-atmosphere shortwave (W m-2) for each hour: 1366 * cos(zenith)."""
    doy = _c(doy)
    hr = (doy - F.floor(doy)) * 24
    return F.lit(SOLAR_CONSTANT) * cos_zenith(doy, lat, lon, dt, hr)


def wrap_longitude(lon) -> Column:
    """Negative (west) longitudes to 0-360."""
    lon = _c(lon)
    return F.when(lon < 0, F.lit(360.0) + lon).otherwise(lon)
