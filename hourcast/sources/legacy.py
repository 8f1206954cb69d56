"""Legacy table shapes (numeric member, numeric horizon, integer cycle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourcast.functions.naming import member_number


def legacy_stage1(df: DataFrame) -> DataFrame:
    """Current stage-1 / pseudo rows -> legacy columns.

    cycle int, start_date text (= reference_date), site_id, parameter int,
    horizon double, variable, datetime, reference_datetime (issue time),
    prediction, family.
    """
    cycle = F.col("cycle").try_cast("int") if "cycle" in df.columns else F.lit(0)
    day = F.to_date(F.col("reference_datetime").cast("string"))
    return df.select(
        cycle.alias("cycle"),
        F.col("reference_datetime").cast("string").alias("start_date"),
        F.col("reference_datetime").cast("string").alias("reference_date"),
        "site_id",
        member_number("ensemble").cast("int").alias("parameter"),
        F.col("horizon").try_cast("double").alias("horizon"),
        "variable", "datetime",
        F.timestamp_add("HOUR", cycle, day.cast("timestamp_ntz")).alias("reference_datetime"),
        "prediction", "family")


def legacy_stage2(stage2: DataFrame) -> DataFrame:
    """Stage-2 rows -> legacy columns with horizon = hours since issue, cycle 0."""
    ref = F.col("reference_datetime").cast("timestamp_ntz")
    return stage2.select(
        F.lit(0).alias("cycle"),
        F.col("reference_datetime").cast("string").alias("start_date"),
        F.col("reference_datetime").cast("string").alias("reference_date"),
        "site_id", "parameter",
        F.timestamp_diff("HOUR", ref, F.col("datetime")).cast("double").alias("horizon"),
        "variable", "datetime", "prediction", "family")
