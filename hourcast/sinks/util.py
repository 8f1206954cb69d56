"""Materialisation of derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hourcast.session import scratch_dir


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute a derived table once and cut its lineage.

    The rows are written as Parquet to a fresh folder under the shared
    checkpoint folder and read back: one job (an eager reliable checkpoint of
    an unpersisted plan computes it twice), columnar, and the read-back plan
    carries real size statistics. A lost executor never forces recomputation
    from the raw scan.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
