"""to_hourly written naively in DuckDB SQL: explicit spine, left join, window fills.

This is an independent formulation (spine materialised, position = row_number,
exact global lag + median for the solar bin step) used to check the Spark
operator, which is join-free and chunked.
"""

from __future__ import annotations

import math

# Stated here on their own, so that a wrong vocabulary in the library shows.
STATE_VARIABLES = ["PRES", "TMP", "RH", "UGRD", "VGRD"]
FLUX_VARIABLES = ["APCP", "DSWRF", "DLWRF"]
# The sites of the derived tables.
SITE_LIST = [
    ("Ordway-Swisher Biological Station - Barco Lake", "BARC", 29.67647, -82.00909),
    ("Toolik Lake", "TOOK", 68.630692, -149.610636),
    ("Falling Creek Reservoir", "fcre", 37.303153, -79.837217),
    ("Lake Alexandrina", "ALEX", -35.436808, 139.168997),
]

PI = f"{math.pi!r}::DOUBLE"


def D(x: float) -> str:
    """A DOUBLE literal (DuckDB reads 1.5 as DECIMAL)."""
    return f"({float(x)!r}::DOUBLE)"


def _lst(xs):
    return ", ".join(f"'{x}'" for x in xs)


STATES = _lst(STATE_VARIABLES)
FLUXES = _lst(FLUX_VARIABLES)


def sites_cte(name: str = "sites") -> str:
    rows = ",\n    ".join(f"('{sid}', {D(lat)}, {D(lon)})" for _, sid, lat, lon in SITE_LIST)
    return f"""{name}(site_id, latitude, longitude) AS (
  SELECT * FROM (VALUES
    {rows}))"""


def doy_sql(ts: str) -> str:
    return f"(dayofyear({ts}) + hour({ts}) / 24)"


def rpot_sql(doy: str, lat: str, lon: str, dt: str) -> str:
    """1366 * cos(zenith), same operation order as hourcast.functions.solar."""
    f = f"({PI} / 180 * ({D(279.5)} + {D(0.9856)} * {doy}))"
    et = (f"(({D(-104.7)} * sin({f}) + {D(596.2)} * sin(2 * {f}) + {D(4.3)} * sin(4 * {f})"
          f" - {D(429.3)} * cos({f}) - {D(2.0)} * cos(2 * {f}) + {D(19.3)} * cos(3 * {f})) / 3600)")
    merid0 = f"(floor({lon} / 15) * 15)"
    merid = f"(CASE WHEN {merid0} < 0 THEN {merid0} + 15 ELSE {merid0} END)"
    lc = f"(({lon} - {merid}) * -4 / 60)"
    tz = f"({merid} / 360 * 24)"
    midbin = f"({D(0.5)} * {dt} / 86400 * 24)"
    t0 = f"({D(12.0)} + {lc} - {et} - {tz} - {midbin})"
    hr = f"(({doy} - floor({doy})) * 24)"
    h = f"({PI} / 12 * ({hr} - {t0}))"
    dec = f"({D(-23.45)} * {PI} / 180 * cos(2 * {PI} * ({doy} + 10) / 365))"
    cosz = (f"(sin({lat} * {PI} / 180) * sin({dec}) + cos({lat} * {PI} / 180) * cos({dec}) * cos({h}))")
    return f"({D(1366.0)} * (CASE WHEN {cosz} < 0 THEN {D(0.0)} ELSE {cosz} END))"


def to_hourly_sql(src: str, out: str, batch: list[str], pseudo: bool, use_solar: bool = True,
                  horizon_rules: bool = True, accum_hours: int = 6, sites: str = "sites",
                  keep_bin: bool = False) -> str:
    """CTEs computing to_hourly of CTE ``src`` into CTE ``out``.

    Output columns: batch cols (other than series keys), site_id, family,
    ensemble, datetime, variable, prediction, reference_datetime.
    """
    p = out + "_"
    on = lambda a, b, cols: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)
    series = ["site_id", "family", "ensemble"]
    bx = [c for c in batch if c not in series]  # batch columns beyond the series keys
    B = ", ".join(batch)
    BX = "".join(f"{c}, " for c in bx)
    skey = ", ".join(bx + series)
    key = skey + ", variable"
    horizon_rule_state = "TRUE" if not pseudo else "(o.horizon <> '006' OR o.datetime = b.bmax)"
    if horizon_rules:
        obs_filter = (f"(o.variable IN ({STATES}) AND {horizon_rule_state})"
                      f" OR (o.variable IN ({FLUXES}) AND o.horizon <> '003')")
    else:
        obs_filter = f"o.variable IN ({STATES}, {FLUXES})"
    ref = "CAST(NULL AS TIMESTAMP)" if pseudo else "CAST(reference_datetime AS TIMESTAMP)"
    ordering = "datetime, prediction IS NOT NULL, horizon ASC NULLS FIRST, prediction ASC NULLS FIRST"
    ctes = f"""
{p}src AS (SELECT {BX}site_id, family, ensemble, horizon, datetime, variable,
    CASE WHEN isnan(prediction) THEN NULL ELSE prediction END AS prediction FROM {src}),
{p}stats AS (SELECT {skey}, max(datetime) AS smax, min(datetime) AS smin FROM {p}src GROUP BY ALL),
{p}bounds AS (SELECT {B}, min(smin) AS bmin, max(smax) AS bmax FROM {p}stats GROUP BY ALL),
{p}vars AS (SELECT DISTINCT {B}, variable FROM {p}src),
{p}spine AS (
  SELECT {", ".join("s." + c for c in bx + series)}, v.variable, b.bmax,
         unnest(generate_series(b.bmin, s.smax, INTERVAL 1 HOUR)) AS datetime
  FROM {p}stats s JOIN {p}bounds b ON {on("s", "b", batch)} JOIN {p}vars v ON {on("s", "v", batch)}
  WHERE v.variable IN ({STATES}, {FLUXES})),
{p}obs AS (
  SELECT o.* FROM {p}src o JOIN {p}bounds b ON {on("o", "b", batch)} WHERE {obs_filter}),
{p}j AS (
  SELECT sp.*, o.prediction, o.horizon FROM {p}spine sp
  LEFT JOIN {p}obs o ON {on("sp", "o", bx + series + ["variable"])} AND sp.datetime = o.datetime),
{p}w1 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ordering}) AS pos FROM {p}j),
{p}w2 AS (SELECT *,
  last_value(CASE WHEN prediction IS NOT NULL THEN pos END IGNORE NULLS) OVER wp AS p0,
  last_value(prediction IGNORE NULLS) OVER wp AS v0,
  first_value(CASE WHEN prediction IS NOT NULL THEN pos END IGNORE NULLS) OVER wf AS p1,
  first_value(prediction IGNORE NULLS) OVER wf AS v1,
  count(prediction) OVER (PARTITION BY {key}) AS nk
  FROM {p}w1
  WINDOW wp AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wf AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{p}filled AS (
  SELECT {skey}, datetime, variable,
    CASE WHEN variable IN ({STATES}) THEN
      CASE WHEN prediction IS NOT NULL THEN prediction WHEN nk < 2 THEN NULL
           WHEN p0 IS NULL THEN v1 WHEN p1 IS NULL THEN v0
           ELSE v0 + (v1 - v0) * ((pos - p0) / (p1 - p0)) END
    ELSE v1 END AS prediction
  FROM {p}w2),
{p}units AS MATERIALIZED (
  SELECT {skey}, datetime,
    CASE WHEN variable = 'APCP' THEN 'PRATE' ELSE variable END AS variable,
    CASE WHEN variable = 'TMP' THEN prediction + {D(273.0)}
         WHEN variable = 'RH' THEN prediction / {D(100.0)}
         WHEN variable = 'APCP' THEN prediction / {D(accum_hours * 3600)}
         ELSE prediction END AS prediction
  FROM {p}filled)"""
    if use_solar:
        doy = doy_sql("u.datetime")
        ctes += f""",
{p}flux AS MATERIALIZED (SELECT u.*, s.latitude,
    CASE WHEN s.longitude < 0 THEN {D(360.0)} + s.longitude ELSE s.longitude END AS lonw,
    {doy} AS doy
  FROM {p}units u LEFT JOIN {sites} s USING (site_id) WHERE u.variable NOT IN ({STATES})),
{p}diff AS (SELECT {B}, doy - lag(doy) OVER (PARTITION BY {B} ORDER BY site_id, family, ensemble, datetime) AS d
  FROM {p}flux),
{p}dt AS (SELECT {B}, median(d) * 86400 AS bin_seconds FROM {p}diff WHERE d IS NOT NULL GROUP BY ALL),
{p}rp AS MATERIALIZED (SELECT f.*, {rpot_sql("f.doy", "f.latitude", "f.lonw", "dt.bin_seconds")} AS rpot
  FROM {p}flux f LEFT JOIN {p}dt dt ON {on("f", "dt", batch)}),
{p}sw AS MATERIALIZED (SELECT *,
    avg(rpot) OVER (PARTITION BY {key}, CAST(datetime AS DATE)) AS avg_rpot,
    avg(prediction) OVER (PARTITION BY {key}, CAST(datetime AS DATE)) AS avg_sw
  FROM {p}rp),
{p}fluxes AS MATERIALIZED (SELECT {skey}, datetime, variable,
    CASE WHEN variable <> 'DSWRF' THEN prediction
         WHEN avg_rpot > 0 THEN rpot * (avg_sw / avg_rpot)
         WHEN avg_rpot <= 0 THEN prediction END AS prediction
  FROM {p}sw),
{p}all AS MATERIALIZED (SELECT * FROM {p}units WHERE variable IN ({STATES})
  UNION ALL SELECT * FROM {p}fluxes)"""
    else:
        ctes += f""",
{p}all AS MATERIALIZED (SELECT * FROM {p}units)"""
    names = ("CASE variable WHEN 'TMP' THEN 'air_temperature' WHEN 'PRES' THEN 'air_pressure'"
             " WHEN 'RH' THEN 'relative_humidity'"
             " WHEN 'DLWRF' THEN 'surface_downwelling_longwave_flux_in_air'"
             " WHEN 'DSWRF' THEN 'surface_downwelling_shortwave_flux_in_air'"
             " WHEN 'PRATE' THEN 'precipitation_flux' WHEN 'VGRD' THEN 'eastward_wind'"
             " WHEN 'UGRD' THEN 'northward_wind' WHEN 'APCP' THEN 'precipitation_amount'"
             " ELSE variable END")
    BXO = "".join(f"{c}, " for c in bx if c != "reference_datetime")
    ctes += f""",
{out} AS MATERIALIZED (SELECT {BXO}site_id, family, ensemble, datetime, {names} AS variable, prediction,
    {ref} AS reference_datetime FROM {p}all)"""
    if keep_bin and use_solar:
        ctes += f""",
{out}_bin AS (SELECT * FROM {p}dt)"""
    return ctes
