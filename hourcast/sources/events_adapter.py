"""Derive forecast-shaped tables from the driver's ``events`` table.

The test data has no weather table, so a fixed integer mapping turns each event
into one forecast value (site, member, variable, valid time, issue cycle and
horizon). The same mapping is written as SQL in ``oracles`` so both engines see
identical inputs. Only integer arithmetic and ``max`` are used, so the inputs
are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourcast.functions.naming import pad_left
from hourcast.schemas import NATIVE_VARIABLES

# ---------------------------------------------------------------------------
# user_id % 4 picks the site, event_id % 8 the variable.
# ---------------------------------------------------------------------------
ADAPTER_SITES = ["fcre", "BARC", "TOOK", "ALEX"]
ADAPTER_VARIABLES = NATIVE_VARIABLES
# ---------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "value")


def _mapped(events: DataFrame) -> DataFrame:
    """One row per event: site, member, variable, valid time and issue offset."""
    uid, eid = F.col("user_id"), F.col("event_id")
    m = F.pmod(F.floor(uid / 4), F.lit(3))
    vi = F.pmod(eid, F.lit(8))
    h3 = F.floor(F.hour("ts") / 3) * 3
    day = F.to_date("ts").cast("timestamp_ntz")
    hz = (F.when(F.pmod(F.col("h3"), F.lit(6)) == 3, F.lit(3))
          .when((F.col("vi") >= 5) | (F.pmod(F.floor(eid / 8), F.lit(2)) == 1), F.lit(6))
          .otherwise(F.lit(0)))
    return (events
            .select(eid, uid, "value", "ts", vi.alias("vi"), h3.cast("int").alias("h3"),
                    m.alias("m"), day.alias("day"))
            .select(
                F.element_at(F.array(*[F.lit(s) for s in ADAPTER_SITES]),
                             (F.pmod(uid, F.lit(4)) + 1).cast("int")).alias("site_id"),
                F.lit("ensemble").alias("family"),
                F.when(F.col("m") == 0, F.lit("gec00"))
                 .otherwise(F.concat(F.lit("gep0"), F.col("m").cast("string"))).alias("ensemble"),
                F.element_at(F.array(*[F.lit(v) for v in ADAPTER_VARIABLES]),
                             (F.col("vi") + 1).cast("int")).alias("variable"),
                F.timestamp_add("HOUR", F.col("h3"), F.col("day")).alias("datetime"),
                hz.alias("hz"),
                "value",
            ))


def pseudo_from_events(events: DataFrame) -> DataFrame:
    """Pseudo-observation shape: every cycle's first hours (000/003/006)."""
    m = _mapped(events)
    issue = F.timestamp_add("HOUR", -F.col("hz"), F.col("datetime"))
    return (m.select("site_id", "family", "ensemble", "datetime", "variable", "value",
                     pad_left(F.col("hz"), 3).alias("horizon"),
                     pad_left(F.hour(issue), 2).alias("cycle"),
                     F.date_format(issue, "yyyy-MM-dd").alias("reference_datetime"))
            .groupBy("site_id", "family", "ensemble", "horizon", "cycle", "datetime", "variable",
                     "reference_datetime")
            .agg(F.max("value").alias("prediction"))
            .select("site_id", "family", "ensemble", "horizon", "cycle", "datetime", "variable",
                    "prediction", "reference_datetime"))


def forecast_from_events(events: DataFrame) -> DataFrame:
    """Forecast (stage-1) shape: weekly issue batches, horizon = hours since the Monday."""
    m = _mapped(events)
    d = F.to_date("datetime")
    monday = F.date_sub(d, F.pmod(F.dayofweek(d) + 5, F.lit(7)).cast("int"))
    hours = F.datediff(d, F.col("monday")) * 24 + F.hour("datetime")
    return (m.withColumn("monday", monday)
            .select("site_id", "family", "ensemble", "datetime", "variable", "value",
                    pad_left(hours, 3).alias("horizon"),
                    F.date_format("monday", "yyyy-MM-dd").alias("reference_datetime"))
            .groupBy("site_id", "family", "ensemble", "horizon", "datetime", "variable",
                     "reference_datetime")
            .agg(F.max("value").alias("prediction"))
            .select("site_id", "family", "ensemble", "horizon", "datetime", "variable",
                    "prediction", "reference_datetime"))


def pseudo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_from_events(read_events(spark, sf_dir))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_from_events(read_events(spark, sf_dir))
