"""Incremental trigger for the stage-3 update (PL-06) with Structured Streaming.

The original pipeline finds new pseudo-observation dates by listing folders on
a daily schedule and redoes the last days of history. Here a file-source stream
over the landing folder replaces the listing: the stream's checkpoint records
which files were seen, ``Trigger.AvailableNow`` processes whatever arrived and
stops, and each micro-batch runs the ordinary batch update for the sites it
touched. Late files for old dates are handled by the same rule as before: the
update re-reads the last ``rewrite_days`` days of issues for those sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourcast.plans.stages import update_stage3
from hourcast.schemas import PSEUDO


def stage3_stream(spark: SparkSession, pseudo_root: str, stage3_root: str, sites: DataFrame,
                  checkpoint: str, rewrite_days: int = 3):
    """Start an AvailableNow stream that updates stage 3 for newly landed files.

    ``checkpoint`` is a shared folder that stays the same from run to run: it holds
    which files were seen. Returns the StreamingQuery (call ``awaitTermination()``).
    """
    landed = (spark.readStream.schema(PSEUDO)
              .option("basePath", pseudo_root)
              .parquet(pseudo_root))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        touched = batch.select("site_id").distinct()
        todo = sites.join(touched, "site_id", "left_semi")
        if todo.limit(1).count() == 0:  # nothing for listed sites in this batch
            return
        update_stage3(batch.sparkSession, pseudo_root, stage3_root, todo, rewrite_days)

    return (landed.select("site_id", "reference_datetime")
            .writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
