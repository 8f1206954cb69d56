from pyspark.sql import functions as F

from hourcast.plans import stages
from hourcast.session import scratch_dir
from hourcast.sinks.writers import write_partitioned
from hourcast.sources import datasets
from hourcast.sources.events_adapter import pseudo as adapter_pseudo
from hourcast.sources.site_list import builtin_sites
from hourcast.streaming import stage3_stream


def test_stream_updates_like_batch(spark):
    sites = builtin_sites(spark)
    ps = adapter_pseudo(spark, "/root/testdata/sf0.001")
    early = scratch_dir(spark, "early")
    write_partitioned(ps.filter(F.col("reference_datetime") < "2024-01-20"), early, ["reference_datetime"])
    s3a, s3b = scratch_dir(spark, "s3a"), scratch_dir(spark, "s3b")
    stages.rebuild_stage3(spark, early, s3a, sites)
    stages.rebuild_stage3(spark, early, s3b, sites)
    landing = scratch_dir(spark, "landing")
    write_partitioned(ps, landing, ["reference_datetime"])
    q = stage3_stream(spark, landing, s3a, sites, scratch_dir(spark, "stream-checkpoint"))
    q.awaitTermination()
    stages.update_stage3(spark, landing, s3b, sites)
    a = sorted(map(tuple, datasets.read_dataset(spark, s3a, stages.STAGE3_READ).collect()), key=str)
    b = sorted(map(tuple, datasets.read_dataset(spark, s3b, stages.STAGE3_READ).collect()), key=str)
    assert a == b and len(a) > 0
