"""Published versions: whole or not at all, and updates that don't grow with the history."""

import datetime as dt

import pytest
from conftest import pseudo
from pyspark.sql import functions as F

from hourcast.plans import stages
from hourcast.session import scratch_dir
from hourcast.sinks import versioned, writers
from hourcast.sources.site_list import builtin_sites

SCHEMA = "v double, site string, day string"


def table(spark, rows):
    return spark.createDataFrame([(float(v), s, d) for v, s, d in rows], SCHEMA)


def read(spark, root, version=None):
    return sorted(((r.v, r.site, r.day) for r in versioned.read_version(spark, root, table(spark, []).schema, version).collect()), key=str)


KEYS = ["site", "day"]
FIRST = [(1.0, "a", "d1"), (2.0, "a", "d2"), (3.0, None, "d1"), (4.0, "x/y", "d1")]


def test_versions_are_whole_and_carried(spark):
    root = scratch_dir(spark, "published")
    assert versioned.versions(spark, root) == [] and versioned.manifest(spark, root) is None and read(spark, root) == []
    assert versioned.publish(spark, root, table(spark, FIRST), KEYS, statistics={"n": F.count(F.lit(1))}) == 1
    assert read(spark, root) == sorted(FIRST, key=str)
    lines = versioned.manifest(spark, root)
    assert {(r.site, r.day, r.n, r.version, r.n_files) for r in lines.collect()} == {(s, d, 1, 1, 1) for _, s, d in FIRST}
    new = [(9.0, None, "d1"), (8.0, None, "d1"), (7.0, "b", "d3")]
    assert versioned.publish(spark, root, table(spark, new), KEYS, lines, {"n": F.count(F.lit(1))}) == 2
    want = sorted([r for r in FIRST if r[1] is not None] + new, key=str)
    assert read(spark, root) == want and read(spark, root, 1) == sorted(FIRST, key=str)
    assert {r.n for r in versioned.manifest(spark, root).collect() if r.site is None} == {2}
    assert versioned.read_version(spark, root, table(spark, []).schema, where=F.col("site") == "a").count() == 2
    with pytest.raises(ValueError, match="not published"):
        versioned.manifest(spark, root, 5)
    # nothing new: everything is carried
    assert versioned.publish(spark, root, table(spark, []), KEYS, versioned.manifest(spark, root), {"n": F.count(F.lit(1))}) == 3
    assert read(spark, root) == want


def test_a_dead_job_changes_nothing(spark):
    root = scratch_dir(spark, "published")
    versioned.publish(spark, root, table(spark, FIRST), KEYS)
    bad = table(spark, [(k, "a", f"d{k}") for k in range(40)]).repartition(8).withColumn(
        "v", F.when(F.col("v") == 33.0, F.raise_error("killed").cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        versioned.publish(spark, root, bad, KEYS, versioned.manifest(spark, root))
    table(spark, [(50, "left", "over")]).write.mode("append").partitionBy(*KEYS).parquet(root + "/publication=2")  # written, never published
    assert versioned.versions(spark, root) == [1] and read(spark, root) == sorted(FIRST, key=str)
    assert versioned.publish(spark, root, table(spark, [(5, "a", "d1")]), KEYS, versioned.manifest(spark, root)) == 2
    assert read(spark, root) == sorted([(5.0, "a", "d1"), *FIRST[1:]], key=str)


def test_old_versions_are_dropped(spark):
    root = scratch_dir(spark, "published")
    for k in range(4):
        versioned.publish(spark, root, table(spark, [(k, "a", "d1"), (k, "a", f"n{k}")]), KEYS, versioned.manifest(spark, root))
    want = {v: read(spark, root, v) for v in (3, 4)}
    assert versioned.drop_old_versions(spark, root, keep=2) == 2  # (a, d1) of versions 1 and 2
    assert versioned.versions(spark, root) == [3, 4] and {v: read(spark, root, v) for v in (3, 4)} == want
    assert versioned.drop_old_versions(spark, root, keep=2) == 0


def observations(spark, days, first=dt.date(2024, 1, 1)):
    rows = []
    for d in range(days):
        for site in ("fcre", "BARC"):
            for cycle in ("00", "12"):
                for variable in ("TMP", "DSWRF"):
                    for horizon in ("000", "006"):
                        rows.append((site, "gec00", variable, 24 * d + int(cycle) + int(horizon), horizon, cycle, float(d + int(horizon)), str(first + dt.timedelta(d))))
    return pseudo(spark, rows)


def history(spark, days):
    """Hourly rows of two sites, as an update would have left them."""
    hours = spark.range(24 * days).select(F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("datetime"))
    return hours.select(F.explode(F.array(F.lit("fcre"), F.lit("BARC"))).alias("site_id"), F.lit("ensemble").alias("family"), F.lit(0.0).alias("parameter"),
                        "datetime", F.lit("air_temperature").alias("variable"), F.hour("datetime").cast("double").alias("prediction"),
                        F.lit(None).cast("date").alias("reference_datetime"))


def updated(spark, days):
    """(bytes and partitions that an update of two days writes, partitions of the dataset)"""
    sites, root, p = builtin_sites(spark), scratch_dir(spark, "published"), scratch_dir(spark, "pseudo")
    versioned.publish(spark, root, stages._by_month(history(spark, days)), stages.STAGE3_KEYS, None, stages._statistics())
    writers.write_partitioned(observations(spark, days + 2).filter(F.col("datetime") >= F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days - 6))), p, ["reference_datetime"])
    number = stages.update_stage3_published(spark, p, root, sites)
    lines = versioned.manifest(spark, root)
    written = lines.filter(F.col("version") == number).agg(F.sum("n_bytes"), F.count("*")).first()
    return written[0], written[1], lines.count()


def test_an_update_does_not_grow_with_the_history(spark):
    short, long = updated(spark, 40), updated(spark, 161)  # both end on the ninth of a month
    assert long[2] == short[2] + 8 and long[1] == short[1] == 2  # one month of each site
    assert abs(long[0] - short[0]) < 0.1 * short[0]


def test_an_update_by_month_gives_the_same_rows(spark):
    sites = builtin_sites(spark)
    old, new, root, plain = (scratch_dir(spark, n) for n in ("old", "new", "published", "plain"))
    writers.write_partitioned(observations(spark, 40), old, ["reference_datetime"])
    writers.write_partitioned(observations(spark, 42), new, ["reference_datetime"])
    stages.rebuild_stage3_published(spark, old, root, sites)
    stages.rebuild_stage3(spark, old, plain, sites)
    stages.update_stage3(spark, new, plain, sites)
    rows = stages._by_month(stages.read_stage3(spark, root))  # a rebuild may leave repeated rows; here one site's all are
    versioned.publish(spark, root, rows.unionByName(rows.filter("site_id = 'BARC'")), stages.STAGE3_KEYS, None, stages._statistics())
    assert not versioned.manifest(spark, root).filter("n_rows > n_different and month = '2024-01'").isEmpty()
    stages.update_stage3_published(spark, new, root, sites)
    a, b = stages.read_stage3(spark, root), spark.read.schema(stages.STAGE3_READ).parquet(plain).select(*stages.OUT_COLS)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert versioned.manifest(spark, root).filter("n_rows > n_different").isEmpty()


def test_update_of_nothing_and_of_unlisted_sites(spark):
    sites = builtin_sites(spark)
    p, root = scratch_dir(spark, "pseudo"), scratch_dir(spark, "published")
    writers.write_partitioned(observations(spark, 3), p, ["reference_datetime"])
    assert stages.update_stage3_published(spark, p, root, sites) is None
    stages.rebuild_stage3_published(spark, p, root, sites)
    before = sorted(map(str, stages.read_stage3(spark, root).collect()))
    assert stages.update_stage3_published(spark, p, root, sites.filter("site_id = 'TOOK'")) is None
    assert stages.update_stage3_published(spark, p, root, sites.filter("site_id = 'fcre'")) == 2
    after = stages.read_stage3(spark, root)
    assert sorted(map(str, after.filter("site_id = 'BARC'").collect())) == [x for x in before if "'BARC'" in x]
