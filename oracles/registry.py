"""DuckDB SQL for every registered query (same column names and types)."""

from __future__ import annotations

from oracles import adapter
from oracles.hourly import D, FLUXES, SITE_LIST, STATES, sites_cte, to_hourly_sql

SW = "surface_downwelling_shortwave_flux_in_air"
RUN_DATE = "2024-01-20"
PLANNER_MIN_HORIZON = 160
UPDATE_SPLIT = "2024-01-20"
PLAN_DATES = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29", "2024-02-05"]

P = adapter.PSEUDO
F = adapter.FORECAST
BOTH = adapter.BOTH
SITES = sites_cte()


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


HOURLY_COLUMNS = "site_id, family, ensemble, datetime, variable, prediction, reference_datetime"
STAGE_COLUMNS = HOURLY_COLUMNS.replace("ensemble", "parameter")


def rsw(rel: str, columns: str = STAGE_COLUMNS) -> str:
    """Columns of rel with shortwave values rounded to 6 places."""
    rounded = f"CASE WHEN variable = '{SW}' THEN round(prediction, 6) ELSE prediction END AS prediction"
    return f"SELECT {columns.replace('prediction', rounded, 1)} FROM {rel}"


def days(start: str, end: str, name: str = "reference_datetime") -> str:
    return (f"SELECT strftime(d, '%Y-%m-%d') AS {name} FROM "
            f"generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY) t(d)")


def backlog(start, end, present_rel):
    return (f"SELECT * FROM ({days(start, end)}) w WHERE NOT EXISTS "
            f"(SELECT 1 FROM {present_rel} p WHERE p.reference_datetime = w.reference_datetime)")


MEMBER = "TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE)"

# forecast hourly (stage-2 frame) and pseudo hourly (stage-3 frame)
HF = to_hourly_sql("forecast", "hf", ["reference_datetime"], False)
HP = to_hourly_sql("pseudo", "hp", ["site_id"], True)
STAGE2 = """stage2 AS (SELECT site_id, family, TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS parameter,
  datetime, variable, prediction, CAST(reference_datetime AS DATE) AS reference_datetime FROM hf)"""
STAGE3 = """stage3 AS (SELECT site_id, family, TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS parameter,
  datetime, variable, prediction, CAST(NULL AS DATE) AS reference_datetime FROM hp)"""

LEGACY1 = """legacy1 AS (SELECT 0 AS cycle, reference_datetime AS start_date, reference_datetime AS reference_date,
  site_id, CAST(TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS INTEGER) AS parameter,
  TRY_CAST(horizon AS DOUBLE) AS horizon, variable, datetime,
  CAST(CAST(reference_datetime AS DATE) AS TIMESTAMP) AS reference_datetime, prediction, family
  FROM forecast)"""
LEGACY1P = """legacy1p AS (SELECT TRY_CAST(cycle AS INTEGER) AS cycle, reference_datetime AS start_date,
  reference_datetime AS reference_date, site_id,
  CAST(TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS INTEGER) AS parameter,
  TRY_CAST(horizon AS DOUBLE) AS horizon, variable, datetime,
  CAST(CAST(reference_datetime AS DATE) AS TIMESTAMP) + to_hours(TRY_CAST(cycle AS INTEGER)) AS reference_datetime,
  prediction, family FROM pseudo)"""


def legacy2(skip: str) -> str:
    fc = f"fcs AS (SELECT * FROM forecast WHERE reference_datetime <> '{skip}')"
    h = to_hourly_sql("fcs", "h2", ["reference_datetime"], False)
    l2 = """legacy2 AS (SELECT 0 AS cycle, CAST(CAST(reference_datetime AS DATE) AS VARCHAR) AS start_date,
  CAST(CAST(reference_datetime AS DATE) AS VARCHAR) AS reference_date, site_id,
  TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS parameter,
  CAST(date_diff('hour', reference_datetime, datetime) AS DOUBLE) AS horizon,
  variable, datetime, prediction, family FROM h2)"""
    return ",\n".join([fc, SITES, h, l2])


def plan_runs(dates, force: bool) -> str:
    dl = ", ".join(f"'{d}'" for d in dates)
    return W(F, LEGACY1, legacy2("2024-01-15"), f"""
avail AS (SELECT start_date, min(mh) AS horizon FROM (
   SELECT start_date, parameter, max(horizon) AS mh FROM legacy1
   WHERE start_date IN ({dl}) AND cycle = 0 AND parameter < 31 AND variable = 'PRES'
   GROUP BY ALL) GROUP BY ALL),
runs AS (SELECT start_date AS date, c.cycle FROM avail CROSS JOIN (SELECT 0 AS cycle) c),
s2 AS (SELECT * FROM legacy2 WHERE start_date IN ({dl})),
done AS (SELECT start_date AS date, cycle, min(mh) AS horizon FROM (
   SELECT start_date, cycle, parameter, max(horizon) AS mh FROM s2
   WHERE cycle = 0 AND parameter < 31 AND variable = 'air_temperature' GROUP BY ALL) GROUP BY ALL),
nsites AS (SELECT start_date AS date, cycle, count(DISTINCT site_id) AS files_present FROM s2 GROUP BY ALL),
j AS (SELECT r.date, CAST(r.cycle AS INTEGER) AS cycle, CAST(r.cycle AS VARCHAR) || '/' || r.date AS dir_parquet,
  d.horizon, CASE WHEN r.cycle = 0 AND coalesce(d.horizon, -1.0) < {float(PLANNER_MIN_HORIZON)!r}
  THEN NULL ELSE n.files_present END AS files_present
  FROM runs r LEFT JOIN done d ON d.date = r.date AND d.cycle = r.cycle
  LEFT JOIN nsites n ON n.date = r.date AND n.cycle = r.cycle)""") + f"""
SELECT * FROM j WHERE {str(bool(force)).upper()} OR files_present IS NULL OR files_present = 0"""


def legacy_stage3_run(name: str, src: str, hist: str | None, run_date: str, start: str) -> str:
    """CTEs for one legacy stage-3 append run into CTE ``name``."""
    n = name
    ctes = [f"""{n}_s1 AS (SELECT * FROM {src} WHERE variable IN ({STATES}, {FLUXES})
  AND horizon IN (0.0, 3.0))"""]
    if hist is None:
        ctes.append(f"""{n}_plan AS (SELECT DISTINCT site_id, DATE '{start}' AS from_day FROM {n}_s1)""")
        ctes.append(f"{n}_kept AS (SELECT * FROM (SELECT NULL::TIMESTAMP AS datetime, NULL::VARCHAR AS site_id,"
                    " NULL::VARCHAR AS family, NULL::INTEGER AS parameter, NULL::VARCHAR AS variable,"
                    " NULL::DOUBLE AS prediction) WHERE FALSE)")
    else:
        ctes.append(f"""{n}_last AS (SELECT site_id, max(CAST(datetime AS DATE)) AS max_start FROM {hist} GROUP BY ALL)""")
        ctes.append(f"""{n}_plan AS (SELECT s.site_id, coalesce(l.max_start, DATE '{start}') AS from_day
  FROM (SELECT DISTINCT site_id FROM {n}_s1) s LEFT JOIN {n}_last l USING (site_id))""")
        ctes.append(f"""{n}_kept AS (SELECT h.datetime, h.site_id, h.family, h.parameter, h.variable, h.prediction
  FROM {hist} h JOIN {n}_last l USING (site_id) WHERE CAST(h.datetime AS DATE) <> l.max_start)""")
    ctes.append(f"""{n}_run AS (SELECT * FROM {n}_plan WHERE date_diff('day', from_day, DATE '{run_date}') >= 1)""")
    ctes.append(f"""{n}_d1 AS (SELECT DISTINCT s.reference_date, s.site_id, s.parameter, s.horizon, s.variable,
  s.datetime, s.reference_datetime, s.prediction, s.family,
  CAST(s.parameter AS VARCHAR) AS ensemble, CAST(NULL AS VARCHAR) AS horizon_s
  FROM {n}_s1 s JOIN {n}_run r USING (site_id)
  WHERE CAST(s.start_date AS DATE) >= r.from_day AND CAST(s.start_date AS DATE) <= DATE '{run_date}'
    AND s.horizon < 6)""")
    ctes.append(f"""{n}_in AS (SELECT site_id, family, ensemble, horizon_s AS horizon, datetime, variable, prediction
  FROM {n}_d1)""")
    ctes.append(to_hourly_sql(f"{n}_in", f"{n}_h", ["site_id"], True, use_solar=False, horizon_rules=False))
    ctes.append(f"""{n}_new AS (SELECT datetime, site_id, family, CAST(ensemble AS INTEGER) AS parameter,
  variable, prediction FROM {n}_h)""")
    ctes.append(f"""{n}_all AS (SELECT * FROM {n}_new UNION ALL
  SELECT k.* FROM {n}_kept k WHERE k.site_id IN (SELECT site_id FROM {n}_run))""")
    ctes.append(f"""{n} AS (SELECT a.datetime, a.site_id, p.longitude, p.latitude, 'ensemble' AS family, a.parameter,
  a.variable, CAST(NULL AS VARCHAR) AS height, a.prediction, f.first AS reference_datetime FROM {n}_all a
  JOIN (SELECT site_id, min(datetime) AS first FROM {n}_all GROUP BY ALL) f USING (site_id)
  LEFT JOIN sites p USING (site_id))""")
    return ",\n".join(ctes)


LEGACY2_RUNS = """l2in AS (SELECT start_date, cycle, site_id, family,
  CAST(parameter AS VARCHAR) AS ensemble,
  lpad(CAST(CAST(horizon AS INTEGER) AS VARCHAR), 3, '0') AS horizon, datetime, variable, prediction,
  reference_datetime FROM legacy1p
  WHERE variable IN ({S}, {F}) AND cycle IN (0, 6, 12, 18)
    AND start_date IN (SELECT start_date FROM legacy1p WHERE cycle = 0 AND parameter < 31
                       AND variable = 'PRES'))"""


ORACLE = {
    "variable_filter": W(P) + f" SELECT * FROM pseudo WHERE variable IN ({STATES}, {FLUXES}) AND hour(datetime) <> 21",
    "site_semi_join": W(F, SITES) + " SELECT * FROM forecast WHERE site_id IN (SELECT site_id FROM sites) AND ensemble <> 'gep02'",
    "state_horizon_rule": W(P, "b AS (SELECT site_id, max(datetime) AS bmax FROM pseudo GROUP BY ALL)")
    + f""" SELECT p.* REPLACE (CASE WHEN p.datetime = b.bmax THEN '006' ELSE horizon END AS horizon)
      FROM pseudo p JOIN b USING (site_id)
      WHERE p.variable IN ({STATES}) AND (p.horizon <> '006' OR p.datetime = b.bmax)""",
    "flux_horizon_rule": W(P) + f" SELECT * FROM pseudo WHERE variable IN ({FLUXES}) AND horizon <> '003'",
    "pseudo_overlap": W(P, "b AS (SELECT site_id, max(datetime) AS bmax FROM pseudo GROUP BY ALL)")
    + f""" SELECT site_id, class, horizon, kept, count(*) AS n FROM (
      SELECT p.site_id, CASE WHEN variable IN ({STATES}) THEN 'state' ELSE 'flux' END AS class, horizon,
        coalesce(CASE WHEN variable IN ({STATES}) THEN (horizon <> '006' OR datetime = bmax)
                      ELSE horizon <> '003' END, FALSE) AS kept
      FROM pseudo p JOIN b USING (site_id)) GROUP BY ALL""",
    "repair_datetime": W(P) + """ SELECT * EXCLUDE (new) REPLACE (
      CASE WHEN datetime <> new THEN new WHEN new IS NOT NULL THEN datetime END AS datetime) FROM (
      SELECT *, CAST(CAST(reference_datetime AS DATE) AS TIMESTAMP)
        + to_hours(TRY_CAST(horizon AS INTEGER)) + to_hours(TRY_CAST(cycle AS INTEGER)) AS new FROM (
        SELECT * REPLACE (CASE WHEN cycle = '06' THEN datetime + INTERVAL 5 HOUR ELSE datetime END AS datetime) FROM pseudo))
      """.replace("FROM (\n", "FROM (\n").rstrip() + "",
    "partition_inventory": W(P) + " SELECT DISTINCT reference_datetime FROM pseudo",
    "stage1_backlog": W(F, "present AS (SELECT DISTINCT reference_datetime FROM forecast)")
    + " " + backlog("2023-12-28", "2024-01-19", "present"),
    "pseudo_backlog": W(P, "present AS (SELECT DISTINCT reference_datetime FROM pseudo)")
    + " " + backlog("2023-12-25", "2024-01-03", "present"),
    "stage2_backlog": W(F, "present AS (SELECT DISTINCT reference_datetime FROM forecast)")
    + " " + backlog("2024-01-13", "2024-01-19", "present"),
    "series_max_time": W(P) + " SELECT site_id, family, ensemble, max(datetime) AS max_time FROM pseudo GROUP BY ALL",
    "batch_bounds": W(F) + " SELECT reference_datetime, min(datetime) AS bmin, max(datetime) AS bmax FROM forecast GROUP BY ALL",
    "hourly_spine": W(F, SITES, HF) + " SELECT reference_datetime, site_id, family, ensemble, variable, datetime FROM hf_spine",
    "observations_on_spine": W(P, """odd AS (SELECT * REPLACE (CASE WHEN variable = 'RH' AND hour(datetime) = 12
        THEN datetime + INTERVAL 30 MINUTE ELSE datetime END AS datetime) FROM pseudo
      UNION ALL SELECT * REPLACE (prediction + 1 AS prediction) FROM pseudo WHERE variable = 'TMP')""", SITES,
                               to_hourly_sql("odd", "ho", ["site_id"], True))
    + " SELECT site_id, family, ensemble, variable, datetime, prediction FROM ho_j",
    "interpolate_states": W(F, SITES, HF) + f" SELECT * FROM hf_filled WHERE variable IN ({STATES})",
    "backfill_fluxes": W(F, SITES, HF) + f" SELECT * FROM hf_filled WHERE variable IN ({FLUXES})",
    "unit_conversion": W(F, SITES, HF) + """ SELECT site_id, family, ensemble, datetime, variable, prediction,
      CAST(CAST(reference_datetime AS DATE) AS TIMESTAMP) AS reference_datetime FROM hf_units""",
    "cf_rename": W(F) + """ SELECT native, n, CASE native WHEN 'TMP' THEN 'air_temperature' WHEN 'PRES' THEN 'air_pressure'
      WHEN 'RH' THEN 'relative_humidity' WHEN 'DLWRF' THEN 'surface_downwelling_longwave_flux_in_air'
      WHEN 'DSWRF' THEN 'surface_downwelling_shortwave_flux_in_air' WHEN 'PRATE' THEN 'precipitation_flux'
      WHEN 'VGRD' THEN 'eastward_wind' WHEN 'UGRD' THEN 'northward_wind' WHEN 'APCP' THEN 'precipitation_amount'
      ELSE native END AS standard FROM (
      SELECT CASE WHEN variable = 'APCP' THEN 'PRATE' ELSE variable END AS native, count(*) AS n
      FROM forecast GROUP BY ALL)""",
    "member_number": W(F, """codes AS (SELECT ensemble FROM forecast UNION SELECT 'x' || ensemble FROM forecast
        UNION SELECT substr(ensemble, 1, 3) FROM forecast)""") + f" SELECT ensemble, {MEMBER} AS parameter FROM codes",
    "solar_bin_step": W(F, "fc1 AS (SELECT * FROM forecast WHERE variable NOT IN ('DSWRF', 'DLWRF'))",
                        "fc2 AS (SELECT * FROM forecast WHERE variable <> 'DSWRF')", SITES,
                        *[to_hourly_sql(src, f"h{n}", ["reference_datetime"], False, keep_bin=True)
                          for n, src in ((1, "fc1"), (2, "fc2"), (3, "forecast"))])
    + " UNION ALL ".join(f" SELECT {n} AS n_fluxes, reference_datetime, round(bin_seconds, 6) AS bin_seconds FROM h{n}_bin"
                         for n in (1, 2, 3)),
    "solar_potential": W(F, SITES, HF) + """ SELECT reference_datetime, site_id, family, ensemble, variable, datetime,
      round(rpot, 6) AS rpot FROM hf_rp""",
    "daily_mean_broadcast": W(F, SITES, HF) + """ SELECT reference_datetime, site_id, family, ensemble, variable,
      datetime, round(avg_rpot, 6) AS avg_rpot, round(avg_sw, 6) AS avg_sw FROM hf_sw""",
    "reshape_shortwave": W(F, SITES, HF) + " " + rsw(f"(SELECT * FROM hf WHERE variable = '{SW}')", HOURLY_COLUMNS),
    "to_hourly_forecast": W(F, SITES, HF) + " " + rsw("hf", HOURLY_COLUMNS),
    "to_hourly_pseudo": W(P, SITES, HP) + " " + rsw("hp", HOURLY_COLUMNS),
    "to_hourly_no_solar": W(F, SITES, to_hourly_sql("forecast", "hn", ["reference_datetime"], False,
                                                    use_solar=False)) + " SELECT * FROM hn",
    "stage2_build": W(F, SITES, HF, STAGE2) + " " + rsw("stage2"),
    "stage3_rebuild": W(P, SITES, HP, STAGE3) + " " + rsw("stage3"),
    "stage2_chain": W(F, SITES, HF, STAGE2) + " " + rsw("stage2"),
    "stage3_update": W(P, SITES,
                       f"early AS (SELECT * FROM pseudo WHERE reference_datetime < '{UPDATE_SPLIT}')",
                       to_hourly_sql("early", "he", ["site_id"], True),
                       """hist AS (SELECT site_id, family, TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS parameter,
  datetime, variable, prediction, CAST(NULL AS DATE) AS reference_datetime FROM he)""",
                       """cut AS (SELECT site_id, strftime(max(CAST(datetime AS DATE)) - INTERVAL 3 DAY, '%Y-%m-%d') AS read_from
  FROM hist GROUP BY ALL)""",
                       """recent AS (SELECT p.* FROM pseudo p JOIN cut c USING (site_id) WHERE p.reference_datetime >= c.read_from)""",
                       to_hourly_sql("recent", "hr", ["site_id"], True),
                       """new AS (SELECT DISTINCT site_id, family, TRY_CAST(substr(ensemble, 4, 2) AS DOUBLE) AS parameter,
  datetime, variable, prediction, CAST(NULL AS DATE) AS reference_datetime FROM hr)""",
                       "first_new AS (SELECT site_id, min(datetime) AS first_new FROM new GROUP BY ALL)",
                       """old AS (SELECT DISTINCT h.* FROM hist h JOIN first_new f USING (site_id) WHERE h.datetime < f.first_new)""",
                       "final AS (SELECT * FROM new UNION ALL SELECT * FROM old)")
    + " " + rsw("final"),
    "stage3_append_legacy": W(P, LEGACY1P, SITES,
                              f"early1 AS (SELECT * FROM legacy1p WHERE start_date < '{UPDATE_SPLIT}')",
                              legacy_stage3_run("r1", "early1", None, UPDATE_SPLIT, "2023-12-01"),
                              "hist AS (SELECT datetime, site_id, family, parameter, variable, prediction FROM r1)",
                              legacy_stage3_run("r2", "legacy1p", "hist", "2024-01-31", "2023-12-01"))
    + " SELECT * EXCLUDE (reference_datetime) FROM r2",
    "legacy_members": W(P, LEGACY1P, SITES, """odd AS (SELECT * REPLACE (CASE parameter WHEN 1 THEN 100 WHEN 2 THEN NULL
        ELSE parameter END AS parameter) FROM legacy1p)""",
                        legacy_stage3_run("r1", "odd", None, "2024-01-31", "2023-12-01")) + " SELECT * FROM r1",
    "legacy_chain": W(P, LEGACY1P, SITES, LEGACY2_RUNS.format(S=STATES, F=FLUXES),
                      to_hourly_sql("l2in", "l2h", ["start_date", "cycle", "reference_datetime"], False),
                      legacy_stage3_run("r1", "legacy1p", None, "2024-01-31", "2023-12-01"))
    + """ SELECT 2 AS stage, site_id, variable, count(*) AS n, count(prediction) AS n_values, max(datetime) AS last
      FROM l2h GROUP BY ALL UNION ALL
      SELECT 3, site_id, variable, count(*), count(prediction), max(datetime) FROM r1 GROUP BY ALL""",
    "site_csv": W(P, "named(site_name, site_id, latitude, longitude) AS (VALUES "
                  + ", ".join(f"('{n}', '{i}', {D(a)}, {D(o)})" for n, i, a, o in SITE_LIST) + ")")
    + """ SELECT site_name, site_id, latitude, longitude, n FROM named
      JOIN (SELECT site_id, count(*) AS n FROM pseudo GROUP BY ALL) USING (site_id)""",
    "positional_bare_scan": W(P, LEGACY1P) + " SELECT * REPLACE (CAST(cycle AS VARCHAR) AS cycle) FROM legacy1p",
    "legacy_stage2_build": W(P, LEGACY1P, SITES, LEGACY2_RUNS.format(S=STATES, F=FLUXES),
                             to_hourly_sql("l2in", "l2h", ["start_date", "cycle", "reference_datetime"], False))
    + " " + rsw("""(SELECT start_date, cycle, site_id, family, CAST(ensemble AS INTEGER) AS parameter,
      datetime, variable, prediction, reference_datetime FROM l2h)""", f"start_date, cycle, {STAGE_COLUMNS}"),
    "site_horizon_reached": W(F, LEGACY1) + """ SELECT start_date, min(mh) AS horizon FROM (
      SELECT start_date, parameter, max(horizon) AS mh FROM legacy1
      WHERE cycle = 0 AND parameter < 31 AND variable = 'PRES' GROUP BY ALL) GROUP BY ALL""",
    "run_planner": plan_runs(PLAN_DATES, False),
    "run_planner_forced": plan_runs(PLAN_DATES, True),
    "incomplete_dates": W(F, LEGACY1) + f""" SELECT '2024-01-29' AS date UNION ALL
      SELECT DISTINCT reference_date AS date FROM (
        SELECT reference_date, parameter, max(horizon) AS mx FROM legacy1 WHERE variable = 'TMP' GROUP BY ALL)
      WHERE parameter < 31 AND mx < {float(PLANNER_MIN_HORIZON)!r} AND reference_date < '2024-01-29'""",
    "availability_gate": W(F, """listing AS (SELECT DISTINCT path FROM (
        SELECT 'gefs.' || replace(reference_datetime, '-', '') || '/00/atmos/pgrb2ap5/'
          || CASE WHEN ensemble = 'gec00' THEN 'gec00' ELSE 'gep' || substr(ensemble, 4, 2) END
          || '.t00z.pgrb2a.0p50.f' || horizon AS path FROM forecast
        UNION ALL SELECT 'notes/' || site_id || '/index.html' FROM forecast))""",
                           """d AS (SELECT path, split_part(path, '/', 1) AS name,
        TRY_STRPTIME(regexp_replace(split_part(path, '/', 1), '^gefs\\.(\\d{8})$', '\\1'), '%Y%m%d')::DATE AS day
        FROM listing)""",
                           "latest AS (SELECT max(day) AS latest_day, arg_max(name, day) AS latest_name FROM d WHERE day IS NOT NULL)",
                           """files AS (SELECT count(*) AS n_files FROM d JOIN latest ON d.name = latest.latest_name
        WHERE starts_with(d.path, latest.latest_name || '/00/atmos/pgrb2ap5')
          AND contains(d.path, 'f006') AND contains(d.path, 'gep'))""")
    + " SELECT latest_day, latest_name, n_files, (n_files >= 1 AND latest_day = DATE '2024-01-29') AS ready FROM latest, files",
    "latest_landed_day": W(F, """listing AS (SELECT 'stage1/0/' || reference_datetime AS path FROM forecast
        UNION ALL SELECT 'stage1/0/' || site_id || '/' FROM forecast)""")
    + """ SELECT max(TRY_STRPTIME(regexp_replace(regexp_replace(path, '/+$', ''), '^.*/', ''), '%Y-%m-%d')::DATE)
      AS latest_day FROM listing""",
    "report_stage1": W(F, LEGACY1, """per AS (SELECT reference_date, parameter, max(horizon) AS max FROM legacy1
        WHERE variable = 'TMP' GROUP BY ALL)""")
    + " SELECT * FROM per WHERE reference_date = (SELECT max(reference_date) FROM per) ORDER BY parameter LIMIT 100",
    "report_short_cycles": W(P, LEGACY1P, """nd AS (SELECT max(CAST(reference_date AS DATE)) AS d FROM legacy1p
        WHERE variable = 'TMP' AND cycle = 0)""")
    + """ SELECT reference_date, cycle, horizon, reference_datetime, datetime FROM legacy1p, nd
      WHERE variable = 'TMP' AND cycle IN (6, 12, 18) AND site_id = 'fcre' AND parameter = 1
        AND CAST(reference_date AS DATE) IN (nd.d, nd.d - INTERVAL 1 DAY)
      ORDER BY reference_date DESC, cycle DESC, horizon, datetime LIMIT 93""",
    "report_stage2": W(F, legacy2(""))
    + """ SELECT reference_date, parameter, max(horizon) AS max FROM legacy2 WHERE variable = 'air_temperature'
      GROUP BY ALL ORDER BY reference_date DESC, parameter LIMIT 62""",
    "report_stage3": W(P, SITES, HP, STAGE3)
    + """ SELECT datetime FROM stage3 WHERE site_id = 'fcre' AND variable = 'air_temperature' AND parameter = 1
      ORDER BY datetime DESC LIMIT 48""",
    "positional_partition_scan": W(P, LEGACY1P) + """ SELECT CAST(cycle AS VARCHAR) AS cycle, start_date, site_id,
      reference_date, parameter, horizon, variable, datetime, reference_datetime, prediction, family FROM legacy1p""",
    "land_forecast": W(P, SITES, """odd AS (SELECT * REPLACE (CASE variable WHEN 'RH' THEN '009' WHEN 'UGRD' THEN '012'
        ELSE horizon END AS horizon) FROM pseudo)""") + """ SELECT * FROM odd WHERE site_id IN (SELECT site_id FROM sites)
      AND reference_datetime BETWEEN '2024-01-05' AND '2024-01-12' AND cycle IN ('00', '06', '12')
      AND TRY_CAST(horizon AS INTEGER) <= 9 AND (cycle = '00' OR TRY_CAST(horizon AS INTEGER) <= 6)""",
    "sync_partitions": W(P) + " SELECT * FROM pseudo",
}
RUNS = """runs AS (SELECT CAST(cycle AS VARCHAR) AS cycle, start_date,
  CASE WHEN parameter = 2 THEN NULL ELSE site_id END AS site_id, * EXCLUDE (cycle, start_date, site_id) FROM legacy1p)"""
ORACLE["positional_sink"] = W(P, LEGACY1P, RUNS) + " SELECT *, CAST(1 AS BIGINT) AS n_files FROM runs"
ORACLE["listing_inventory"] = W(P, LEGACY1P, RUNS) + """ SELECT cycle, start_date, count(DISTINCT coalesce(site_id, '')) AS n_files
  FROM runs GROUP BY ALL"""
ORACLE["gate_from_store"] = ORACLE["availability_gate"]
ORACLE["latest_day_from_store"] = ORACLE["latest_landed_day"]
ORACLE["sync_objects"] = W(P, LEGACY1P, RUNS) + " SELECT *, true AS copied, 0 AS copied_again FROM runs"
ORACLE["stage3_chain"] = ORACLE["stage3_update"]  # landing the missing dates gives the same input
ORACLE["stage3_update_published"] = ORACLE["stage3_update"]
ORACLE["stage3_version_before"] = W(P, SITES, f"early AS (SELECT * FROM pseudo WHERE reference_datetime < '{UPDATE_SPLIT}')",
                                    to_hourly_sql("early", "hp", ["site_id"], True), STAGE3) + " " + rsw("stage3")
ORACLE["stage2_published"] = ORACLE["stage2_build"]
ORACLE["site_faults"] = W(P) + """ SELECT site_id, CASE site_id WHEN 'TOOK' THEN 'repeated' WHEN 'BARC' THEN 'unreadable' ELSE 'no place' END AS fault,
  CASE site_id WHEN 'TOOK' THEN CAST(2 AS BIGINT) ELSE 1 END AS n_lines, count(*) AS n_rows
  FROM pseudo WHERE site_id IN ('TOOK', 'BARC', 'ALEX') GROUP BY ALL"""
ORACLE["series_exceptions"] = W(P, """lone AS (SELECT p.* REPLACE (CASE WHEN variable = 'RH' AND ensemble = 'gep01'
    AND p.datetime <> (SELECT max(q.datetime) FROM pseudo q WHERE q.site_id = p.site_id) THEN NULL ELSE prediction END AS prediction) FROM pseudo p)""",
                                "odd AS (SELECT * FROM lone UNION ALL SELECT * REPLACE (prediction + 1 AS prediction) FROM lone WHERE variable = 'UGRD')",
                                to_hourly_sql("odd", "hx", ["site_id"], True, use_solar=False)) + f"""
  SELECT *, variable IN ({STATES}) AND n_values < 2 AS unfilled FROM (SELECT site_id, family, ensemble, variable,
    count(prediction) AS n_values, count(*) - count(DISTINCT datetime) AS n_duplicates FROM hx_j GROUP BY site_id, family, ensemble, variable)
  WHERE n_duplicates > 0 OR (variable IN ({STATES}) AND n_values < 2)"""
