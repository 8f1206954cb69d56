"""Listings, the positional sink and the copy by object: what they read, write and leave behind."""

import os

import pytest
from conftest import at
from pyspark.sql import functions as F

from hourcast.session import scratch_dir
from hourcast.sinks.objects import missing_objects, sync_objects
from hourcast.sinks.positional import write_positional
from hourcast.sources import datasets, store

KEYS = ["cycle", "site_id"]
SCHEMA = "cycle int, site_id string, datetime timestamp_ntz, prediction double"


def local(path):
    return path.removeprefix("file:")


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), local(root)) for d, _, names in os.walk(local(root)) for f in names)


def rows(spark, values):
    return spark.createDataFrame([(c, s, at(k), float(k)) for c, s, k in values], SCHEMA)


def read(spark, root):
    df = datasets.read_positional(spark, root, KEYS, rows(spark, []).drop(*KEYS).schema)
    return sorted(((r.cycle, r.site_id, r.datetime, r.prediction) for r in df.collect()), key=str)


ODD = ["fcre", None, "", "a/b", "x=y", "50%", "%NULL", "_hidden", ".dot", "é ü+", "a b", "*"]


def test_one_file_a_key_and_all_values_come_back(spark):
    root = scratch_dir(spark, "positional")
    values = [(c, s, k) for c in (0, 6) for s in ODD for k in (1, 2, 3)]
    write_positional(rows(spark, values).repartition(5), root, KEYS)
    found = files(root)
    assert len(found) == 2 * len(ODD) and all(f.endswith("/part-0.parquet") and f.count("/") == 2 for f in found)
    assert "0/fcre/part-0.parquet" in found and "6/%NULL/part-0.parquet" in found
    assert read(spark, root) == sorted(((str(c), s, at(k), float(k)) for c, s, k in values), key=str)
    one = datasets.read_positional(spark, root, KEYS, rows(spark, []).drop(*KEYS).schema, {"site_id": "a/b", "cycle": 6})
    assert one.count() == 3
    inventory = store.folder_values(store.list_objects(spark, root), KEYS).collect()
    assert {(r.cycle, r.site_id) for r in inventory} == {(str(c), s) for c in (0, 6) for s in ODD} and {r.n_files for r in inventory} == {1}


def test_a_key_is_replaced_whole_and_others_stay(spark):
    root = scratch_dir(spark, "positional")
    write_positional(rows(spark, [(0, "a", 1), (0, "a", 2), (0, "b", 1)]), root, KEYS)
    write_positional(rows(spark, [(0, "a", 7)]), root, KEYS)
    assert [(s, v) for _, s, _, v in read(spark, root)] == [("a", 7.0), ("b", 1.0)]
    write_positional(rows(spark, []), root, KEYS)
    assert len(files(root)) == 2


def test_a_failed_job_leaves_nothing(spark):
    root = scratch_dir(spark, "positional")
    write_positional(rows(spark, [(0, "a", 1)]), root, KEYS)
    good = rows(spark, [(c, "s", k) for c in range(20) for k in range(50)])
    bad = good.withColumn("prediction", F.when((F.col("cycle") == 13) & (F.col("prediction") == 49.0), F.raise_error("stop").cast("double"))
                          .otherwise(F.col("prediction")))
    with pytest.raises(Exception, match="stop"):
        write_positional(bad, root, KEYS)
    assert files(root) == ["0/a/part-0.parquet"] and os.listdir(local(root)) == ["0"]


def test_a_listing_opens_no_file(spark):
    root = scratch_dir(spark, "tree")
    for path, size in (("gefs.20240101/00/x.bin", 3), ("gefs.20240102/00/y z+é.bin", 2), ("gefs.20240102/06/x.bin", 5), ("top", 1), ("gefs.20240102/_done", 1), ("empty", 0)):
        os.makedirs(os.path.dirname(os.path.join(local(root), path)), exist_ok=True)
        with open(os.path.join(local(root), path), "wb") as f:
            f.write(b"x" * size)
    listing = store.list_objects(spark, root)
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    assert {(r.path, r.length) for r in listing.collect()} == {
        ("gefs.20240101/00/x.bin", 3), ("gefs.20240102/00/y z+é.bin", 2), ("gefs.20240102/06/x.bin", 5), ("top", 1)}
    folders = {(r.path, r.n_files, r.n_bytes) for r in store.list_folders(listing, 1).collect()}
    assert folders == {("gefs.20240101", 1, 3), ("gefs.20240102", 2, 7)}
    assert {r.day for r in datasets.listing_days(listing).collect() if r.day} == {at(0).date(), at(24).date()}
    assert {r.path for r in store.list_objects(spark, root, "gefs.*02/06").collect()} == {"gefs.20240102/06/x.bin"}
    assert store.list_objects(spark, root + "/none").count() == 0 and store.list_objects(spark, root, "none*").count() == 0


def test_sync_completes_partial_null_and_absent_partitions(spark):
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    df = rows(spark, [(c, s, k) for c in (0, 6, 12) for s in ("a", None, "b") for k in range(20)])
    df.filter("prediction < 10").repartition(1).write.partitionBy(*KEYS).parquet(src)
    df.filter("prediction < 10 and cycle < 12 and site_id is not null").repartition(1).write.partitionBy(*KEYS).parquet(dst)
    sync_objects(spark, src, dst)  # other names: nothing of dst's own is touched
    df.filter("prediction >= 10").repartition(1).write.mode("append").partitionBy(*KEYS).parquet(src)  # a second file a folder
    with open(os.path.join(local(dst), next(f for f in files(src) if f.endswith(".parquet") and "cycle=6" in f)), "ab") as f:
        f.write(b"torn")
    wanted = {r.path for r in missing_objects(spark, src, dst).collect()}
    assert len(wanted) in (9, 10)  # the new ones, and the torn one if it was an old one
    assert {r.path for r in sync_objects(spark, src, dst).collect()} == wanted
    assert {f for f in files(src) if "/part" in f and "/." not in f} <= set(files(dst)) and not [f for f in files(dst) if "_sync" in f]
    for f in (f for f in files(src) if "/part" in f and "/." not in f):
        with open(os.path.join(local(src), f), "rb") as a, open(os.path.join(local(dst), f), "rb") as b:
            assert a.read() == b.read()
    assert sync_objects(spark, src, dst).count() == 0
    assert sync_objects(spark, src + "/none", dst).count() == 0


def test_sync_partitions_copies_the_null_partition(spark):
    from hourcast.sinks import writers
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    df = rows(spark, [(0, s, 1) for s in ("a", None)])
    writers.write_partitioned(df, src, ["site_id"])
    writers.write_partitioned(df.filter("site_id is not null"), dst, ["site_id"])
    schema = datasets.read_dataset(spark, src).schema
    assert writers.sync_partitions(spark, src, dst, "site_id", schema) == [None]
    assert {r.site_id for r in datasets.read_dataset(spark, dst, schema).collect()} == {"a", None}
    assert writers.sync_partitions(spark, src, dst, "site_id", schema) == []
