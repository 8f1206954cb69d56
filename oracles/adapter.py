"""The events adapter in DuckDB SQL (mirror of hourcast.sources.events_adapter)."""

MAPPED = """
mapped AS (
  SELECT
    CASE user_id % 4 WHEN 0 THEN 'fcre' WHEN 1 THEN 'BARC' WHEN 2 THEN 'TOOK' ELSE 'ALEX' END AS site_id,
    'ensemble' AS family,
    CASE WHEN (user_id // 4) % 3 = 0 THEN 'gec00' ELSE 'gep0' || CAST((user_id // 4) % 3 AS VARCHAR) END AS ensemble,
    CASE event_id % 8 WHEN 0 THEN 'PRES' WHEN 1 THEN 'TMP' WHEN 2 THEN 'RH' WHEN 3 THEN 'UGRD'
      WHEN 4 THEN 'VGRD' WHEN 5 THEN 'APCP' WHEN 6 THEN 'DSWRF' ELSE 'DLWRF' END AS variable,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST((hour(ts) // 3) * 3 AS BIGINT)) AS datetime,
    CASE WHEN ((hour(ts) // 3) * 3) % 6 = 3 THEN 3
         WHEN event_id % 8 >= 5 OR (event_id // 8) % 2 = 1 THEN 6 ELSE 0 END AS hz,
    value
  FROM events
)"""

PSEUDO = MAPPED + """,
pseudo AS (
  SELECT site_id, family, ensemble, lpad(CAST(hz AS VARCHAR), 3, '0') AS horizon,
         lpad(CAST(hour(datetime - to_hours(hz)) AS VARCHAR), 2, '0') AS cycle,
         datetime, variable, max(value) AS prediction,
         strftime(datetime - to_hours(hz), '%Y-%m-%d') AS reference_datetime
  FROM mapped
  GROUP BY ALL
)"""

FORECAST = MAPPED + """,
forecast AS (
  SELECT site_id, family, ensemble,
         lpad(CAST(date_diff('day', date_trunc('week', CAST(datetime AS DATE)), CAST(datetime AS DATE)) * 24
                   + hour(datetime) AS VARCHAR), 3, '0') AS horizon,
         datetime, variable, max(value) AS prediction,
         strftime(date_trunc('week', CAST(datetime AS DATE)), '%Y-%m-%d') AS reference_datetime
  FROM mapped
  GROUP BY ALL
)"""

BOTH = PSEUDO + "," + FORECAST.replace(MAPPED + ",", "", 1)
