"""Completeness reports (PL-13..PL-16): sorted, first-n listings.

Every ``limit`` here is the feature (a top-n report); sort keys are complete
so the first n rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def report_stage1(stage1: DataFrame, n: int = 100, var: str = "TMP",
                  date_col: str = "reference_date") -> DataFrame:
    """PL-13: max horizon per member at the newest issue date."""
    per = (stage1.filter(F.col("variable") == var)
           .groupBy(date_col, "parameter").agg(F.max(F.col("horizon").cast("double")).alias("max")))
    newest = per.agg(F.max(date_col).alias("_newest"))
    return (per.join(newest, F.col(date_col) == F.col("_newest")).drop("_newest")
            .orderBy("parameter").limit(n))


def report_short_cycles(stage1: DataFrame, n: int = 93, var: str = "TMP", site: str = "fcre",
                        member: int = 1, cycles=(6, 12, 18), date_col: str = "reference_date") -> DataFrame:
    """PL-14: the short cycles of the newest two issue dates for one site/member."""
    newest = (stage1.filter((F.col("variable") == var) & (F.col("cycle") == 0))
              .agg(F.max(F.to_date(date_col))).scalar())
    rows = (stage1.filter((F.col("variable") == var) & F.col("cycle").isin(list(cycles))
                          & (F.col("site_id") == site) & (F.col("parameter") == member))
            .filter(F.to_date(date_col).isin(newest, F.date_sub(newest, 1)))
            .select(date_col, "cycle", "horizon", "reference_datetime", "datetime"))
    return rows.orderBy(F.desc(date_col), F.desc("cycle"), "horizon", "datetime").limit(n)


def report_stage2(stage2: DataFrame, n: int = 62, var: str = "air_temperature",
                  date_col: str = "reference_date") -> DataFrame:
    """PL-15: max horizon per issue date and member, newest first."""
    return (stage2.filter(F.col("variable") == var)
            .groupBy(date_col, "parameter").agg(F.max(F.col("horizon").cast("double")).alias("max"))
            .orderBy(F.desc(date_col), "parameter").limit(n))


def report_stage3(stage3: DataFrame, n: int = 48, site: str = "fcre", member: float = 1,
                  var: str = "air_temperature") -> DataFrame:
    """PL-16: newest stored times of one site and member."""
    return (stage3.filter((F.col("site_id") == site) & (F.col("variable") == var)
                          & (F.col("parameter") == member))
            .select("datetime").orderBy(F.desc("datetime")).limit(n))
