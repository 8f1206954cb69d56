"""Jobs: what they read, what they keep, and how they fail."""

import datetime as dt
import glob
import os
from types import SimpleNamespace

import pytest
from conftest import at, pseudo, series, stage1
from pyspark.sql import functions as F

from hourcast.operators.hourly import to_hourly
from hourcast.plans import planner, stages
from hourcast.schemas import PSEUDO
from hourcast.session import drop_scratch, scratch_dir
from hourcast.sinks import writers
from hourcast.sources import datasets
from hourcast.sources.site_list import builtin_sites

FB = ["reference_datetime"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def local(path):
    return path.removeprefix("file:")


def spoil(root, partition):
    """A file in one partition that no reader can open."""
    folder = os.path.join(local(root), partition)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-bad.parquet"), "wb") as f:
        f.write(b"this is not a parquet file")


def three_days(spark):
    rows = [("fcre", "gec00", "TMP", h, "000", "00", 1.0 + h, f"2024-01-0{1 + h // 24}") for h in (0, 24, 48)]
    return pseudo(spark, rows)


def rows_of(spark, root):
    return sorted(map(str, datasets.read_dataset(spark, root, PSEUDO).collect()))


def test_sync_copies_once_and_only_what_is_missing(spark):
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    writers.write_partitioned(three_days(spark), src, FB)
    assert writers.sync_partitions(spark, src, dst, "reference_datetime", PSEUDO) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    first = rows_of(spark, dst)
    assert len(first) == 3
    assert writers.sync_partitions(spark, src, dst, "reference_datetime", PSEUDO) == []
    assert rows_of(spark, dst) == first


def test_sync_reads_only_missing_partitions(spark, monkeypatch):
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    writers.write_partitioned(three_days(spark), src, FB)
    writers.write_partitioned(three_days(spark).filter("reference_datetime < '2024-01-03'"), dst, FB)
    jobs = []
    write = writers.write_partitioned
    monkeypatch.setattr(writers, "write_partitioned", lambda df, *a, **k: (jobs.append(plan(df)), write(df, *a, **k)))
    assert writers.sync_partitions(spark, src, dst, "reference_datetime", PSEUDO) == ["2024-01-03"]
    scan = jobs[0].split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "2024-01-03" in scan and "2024-01-01" not in scan
    assert len(rows_of(spark, dst)) == 3


def test_a_failing_read_is_not_an_absent_dataset(spark, monkeypatch):
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    writers.write_partitioned(three_days(spark), src, FB)
    assert datasets.read_if_exists(spark, dst, PSEUDO).isEmpty()

    def fail(spark_, root, schema=None):
        if root == dst:
            raise OSError("the store does not answer")
        return read(spark_, root, schema)
    read = datasets.read_dataset
    monkeypatch.setattr(datasets, "read_dataset", fail)
    with pytest.raises(OSError):
        writers.sync_partitions(spark, src, dst, "reference_datetime", PSEUDO)
    assert not os.path.exists(local(dst))


def test_landing_reads_only_wanted_dates(spark):
    src, dst = scratch_dir(spark, "src"), scratch_dir(spark, "dst")
    writers.write_partitioned(three_days(spark), src, FB)
    spoil(src, "reference_datetime=2024-01-03")
    raw = datasets.read_dataset(spark, src, PSEUDO)
    got = writers.land_forecast(raw, dst, builtin_sites(spark), planner.date_range(spark, "2024-01-01", "2024-01-02"))
    assert got == ["2024-01-01", "2024-01-02"] and len(rows_of(spark, dst)) == 2


def test_stage2_job_reads_only_wanted_dates(spark):
    root, out = scratch_dir(spark, "s1"), scratch_dir(spark, "s2")
    rows = stage1(spark, [("fcre", "gec00", "TMP", h, f"{h:03d}", 1.0) for h in (0, 3, 6)])
    writers.write_partitioned(rows, root, FB)
    spoil(root, "reference_datetime=2023-12-01")
    assert "2024-01-01" in plan(stages.wanted_stage1(spark, root, ["2024-01-01"])).split("PartitionFilters: ")[1]
    assert stages.build_stage2(spark, root, out, builtin_sites(spark), "2024-01-03", 7)[-2:] == ["2024-01-01", "2024-01-02"]
    assert {r[0] for r in datasets.read_dataset(spark, out, stages.STAGE2_READ).select("reference_datetime").distinct().collect()} == {"2024-01-01"}


def history(spark, days):
    return spark.createDataFrame([("ensemble", 1.0, dt.datetime.fromisoformat(d), "air_temperature", 1.0, None, s) for s, d in days.items()],
                                 stages.STAGE3_READ)


def test_a_stale_site_does_not_widen_the_update(spark):
    sites = builtin_sites(spark).filter(F.col("site_id").isin("fcre", "BARC"))
    starts = stages.site_starts(history(spark, {"fcre": "2024-01-05", "BARC": "2024-01-04", "TOOK": "2022-03-01"}), sites, 3)
    assert starts == {"fcre": "2024-01-02", "BARC": "2024-01-01"}  # TOOK is not listed
    root = scratch_dir(spark, "pseudo")
    writers.write_partitioned(three_days(spark), root, FB)
    spoil(root, "reference_datetime=2022-03-01")
    recent = stages.since(datasets.read_dataset(spark, root, PSEUDO), starts)
    assert "2024-01-01" in plan(recent).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert sorted(r.reference_datetime for r in recent.collect()) == ["2024-01-02", "2024-01-03"]


def test_update_leaves_no_staging(spark):
    sites = builtin_sites(spark)
    p, s3 = scratch_dir(spark, "pseudo"), scratch_dir(spark, "stage3")
    writers.write_partitioned(three_days(spark), p, FB)
    stages.rebuild_stage3(spark, p, s3, sites)
    before = set(glob.glob(os.path.join(os.path.dirname(local(s3)), "stage3-*")))
    assert stages.update_stage3(spark, p, s3, sites) == ["fcre"]
    assert set(glob.glob(os.path.join(os.path.dirname(local(s3)), "stage3-*"))) == before
    assert stages.update_stage3(spark, p, scratch_dir(spark, "none"), sites) == []


def test_scratch_needs_a_shared_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(conf=conf, sparkContext=context))
    with pytest.raises(ValueError):
        drop_scratch(None, "/data/stage3")


def legacy(spark, rows):
    return spark.createDataFrame([("2024-01-01", 0, "fcre", m, float(h), at(h), v, x, at(0), "ensemble", "2024-01-01") for m, h, v, x in rows],
                                 "start_date string, cycle int, site_id string, parameter int, horizon double, datetime timestamp_ntz, "
                                 "variable string, prediction double, reference_datetime timestamp_ntz, family string, reference_date string")


def test_members_are_carried_whole(spark):
    rows = legacy(spark, [(m, h, "TMP", float(10 * (m or 7) + h)) for m in (10, 100, None) for h in (0, 3)])
    out = stages.legacy_stage3_frame(None, rows, "2024-01-03", "2023-12-31", places=builtin_sites(spark)).collect()
    assert {r.parameter for r in out} == {10, 100, None}
    assert {r.prediction for r in out if r.parameter is None and r.datetime == at(0)} == {70.0 + 273}
    assert len([r for r in out if r.parameter == 100]) == 4 and {round(r.latitude, 3) for r in out} == {37.303}
    runs = spark.createDataFrame([("2024-01-01", 0)], "date string, cycle int")
    two = stages.legacy_stage2_frame(rows, runs, builtin_sites(spark)).collect()
    assert {r.parameter for r in two} == {10, 100, None}


def test_null_keys_are_kept(spark):
    rows = stage1(spark, [("fcre", "gec00", "TMP", h, f"{h:03d}", 1.0 + h) for h in (0, 3)])
    rows = rows.unionByName(rows.withColumn("family", F.lit(None).cast("string")).withColumn("prediction", F.col("prediction") + 5))
    rows = rows.unionByName(rows.withColumn("ensemble", F.lit(None).cast("string")))
    out = to_hourly(rows, None, FB, use_solar_geom=False)
    assert out.count() == 16 and out.filter("family is null").count() == 8
    assert sorted(series(out.filter("family is null"), "fcre", "gec00", "air_temperature").values()) == [279.0, 280.0, 281.0, 282.0]
    assert out.schema["family"].dataType.simpleString() == "string" and dict(out.dtypes)["reference_datetime"] == "timestamp_ntz"


def test_gate_reads_the_listing_once(spark):
    root = scratch_dir(spark, "listing")
    paths = ["gefs.20240102/00/atmos/pgrb2ap5/gep01.f006", "gefs.20240101/00/atmos/pgrb2ap5/gep01.f006", "x/index.html"]
    spark.createDataFrame([(p,) for p in paths], "path string").write.parquet(root)
    gate = planner.availability_gate(spark.read.parquet(root), "2024-01-02", 1, "f006")
    assert plan(gate).count("FileScan") <= 2
    assert [tuple(r) for r in gate.collect()] == [(dt.date(2024, 1, 2), "gefs.20240102", 1, True)]


def test_scopes_delete_what_they_made(spark):
    from hourcast.session import ScratchScope
    from hourcast.sinks.util import materialize
    there = lambda: set(os.listdir(os.path.dirname(local(scratch_dir(spark)))))
    before = there()
    with ScratchScope(spark) as outer:
        with ScratchScope(spark) as inner:
            a = materialize(spark.range(3), "inner")
            b = inner.hand_over(a.selectExpr("id * 2 as id"), "kept")
        assert sorted(r.id for r in b.collect()) == [0, 2, 4]
        assert [x.split("-")[0] for x in there() - before] == ["kept"]
        c = outer.hand_over(b, "result")
    assert [x.split("-")[0] for x in there() - before] == ["result"] and c.count() == 3
    with pytest.raises(ZeroDivisionError), ScratchScope(spark):
        materialize(spark.range(3), "failed")
        1 / 0
    drop_scratch(spark, c.scratch_path)
    assert there() == before


def test_jobs_leave_no_scratch(spark):
    sites = builtin_sites(spark)
    p, s3, s2 = (scratch_dir(spark, n) for n in ("pseudo", "stage3", "stage2"))
    writers.write_partitioned(three_days(spark), p, FB)
    there = lambda: set(os.listdir(os.path.dirname(local(p))))
    before = there()
    stages.rebuild_stage3(spark, p, s3, sites)
    stages.update_stage3(spark, p, s3, sites)
    stages.build_stage2(spark, p, s2, sites, "2024-01-03", 2)
    assert there() - before == {os.path.basename(s3), os.path.basename(s2)}


def test_faulty_site_lists_are_refused(spark, tmp_path):
    from hourcast.sources.site_list import read_sites, site_faults
    path = tmp_path / "sites.csv"
    path.write_text("site_name,site_id,latitude,longitude\nA, a ,1.0,2.0\nB,b,one,2.0\nC,c,1.0\nD,,1.0,2.0\nE,e,91.0,2.0\nF,f,1.0,2.0\nF2,f,1.0,2.0\nG,g,,2.0\n")
    faults = {(r.site_id, r.fault) for r in site_faults(spark, str(path)).collect()}
    assert faults == {("b", "unreadable"), ("c", "no place"), (None, "no id"), ("e", "no place"), ("f", "repeated"), ("g", "no place")}
    with pytest.raises(ValueError, match="b: unreadable .B,b,one,2.0."):
        read_sites(spark, str(path))
    assert [tuple(r) for r in read_sites(spark, str(path), strict=False).collect()] == [("A", "a", 1.0, 2.0)]


def test_exceptions_are_counted(spark):
    from hourcast.operators.hourly import disaggregate, series_exceptions
    rows = stage1(spark, [("fcre", "gec00", "TMP", 0, "000", 1.0), ("fcre", "gec00", "TMP", 3, "003", None), ("fcre", "gec00", "RH", 0, "000", 1.0),
                          ("fcre", "gec00", "RH", 3, "003", 2.0), ("fcre", "gec00", "RH", 3, "003", 2.0), ("fcre", "gec00", "RH", 3, "003", None)])
    got = {r.variable: (r.n_values, r.n_duplicates, r.unfilled) for r in series_exceptions(disaggregate(rows, FB)).collect()}
    assert got == {"TMP": (1, 0, True), "RH": (3, 2, False)}
    assert series_exceptions(disaggregate(rows.limit(0), FB)).count() == 0
