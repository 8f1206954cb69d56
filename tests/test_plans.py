"""Planner truth table, availability gate, stage-3 update seam, plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourcast.operators.hourly import to_hourly
from hourcast.plans import planner, stages
from hourcast.session import scratch_dir
from hourcast.sinks.writers import write_partitioned
from hourcast.sources import datasets
from hourcast.sources.events_adapter import pseudo as adapter_pseudo
from hourcast.sources.site_list import builtin_sites
from hourcast.schemas import PSEUDO

SF = "/root/testdata/sf0.001"


def legacy_rows(spark, rows):
    return spark.createDataFrame(rows, "start_date string, cycle int, site_id string, parameter int, "
                                       "horizon double, variable string")


def test_run_planner_truth_table(spark):
    s1 = legacy_rows(spark, [(d, 0, "fcre", m, 840.0, "PRES") for d in ("d1", "d2", "d3") for m in (0, 1)])
    s2 = legacy_rows(spark, [("d1", 0, "fcre", 0, 840.0, "air_temperature"),
                             ("d1", 0, "fcre", 1, 840.0, "air_temperature"),
                             ("d2", 0, "fcre", 0, 840.0, "air_temperature"),
                             ("d2", 0, "fcre", 1, 384.0, "air_temperature")])
    got = {r.date: r for r in planner.plan_runs(s1, s2, ["d1", "d2", "d3"]).collect()}
    assert set(got) == {"d2", "d3"}       # d1 complete; d2 below 840; d3 never produced
    assert got["d2"].horizon == 384.0 and got["d3"].files_present is None
    forced = planner.plan_runs(s1, s2, ["d1", "d2", "d3"], force=True)
    assert forced.count() == 3
    assert planner.plan_runs(s1, None, ["d1"]).count() == 1


def test_availability_gate(spark):
    def gate(paths, run_date):
        df = spark.createDataFrame([(p,) for p in paths], "path string")
        return planner.availability_gate(df, run_date).collect()[0]
    ok = ["gefs.20240130/00/atmos/pgrb2ap5/gep01.t00z.pgrb2a.0p50.f384",
          "gefs.20240129/00/atmos/pgrb2ap5/gep01.t00z.pgrb2a.0p50.f384", "index.html"]
    r = gate(ok, "2024-01-30")
    assert r.ready and r.latest_name == "gefs.20240130" and r.n_files == 1
    early = ["gefs.20240130/00/atmos/pgrb2ap5/gep01.t00z.pgrb2a.0p50.f120",
             "gefs.20240129/00/atmos/pgrb2ap5/gep01.t00z.pgrb2a.0p50.f384"]
    assert not gate(early, "2024-01-30").ready
    assert not gate(ok, "2024-01-31").ready     # newest day is not today


def test_backlogs(spark):
    present = spark.createDataFrame([("2024-01-02",), ("2024-01-04",)], "reference_datetime string")
    got = sorted(r[0] for r in planner.stage1_backlog(spark, present, "2024-01-06", "2024-01-01").collect())
    assert got == ["2024-01-01", "2024-01-03", "2024-01-05"]
    got = sorted(r[0] for r in planner.pseudo_backlog(spark, present, "2024-01-04", "2024-01-03").collect())
    assert got == ["2024-01-03"]
    got = sorted(r[0] for r in planner.stage2_backlog(spark, present, "2024-01-06", 3).collect())
    assert got == ["2024-01-03", "2024-01-05"]


def test_stage3_update_is_stable(spark):
    """Runs repeat once the cut-off stops moving; history before the seam is kept."""
    sites = builtin_sites(spark)
    ps = adapter_pseudo(spark, SF)
    early, full = scratch_dir(spark, "early"), scratch_dir(spark, "full")
    write_partitioned(ps.filter(F.col("reference_datetime") < "2024-01-20"), early, ["reference_datetime"])
    write_partitioned(ps, full, ["reference_datetime"])
    s3 = scratch_dir(spark, "stage3")

    def snapshot():
        return sorted(map(tuple, datasets.read_dataset(spark, s3, stages.STAGE3_READ).collect()), key=str)

    stages.rebuild_stage3(spark, early, s3, sites)
    run1 = snapshot()
    stages.update_stage3(spark, full, s3, sites)      # cut-off from the early history
    run2 = snapshot()
    stages.update_stage3(spark, full, s3, sites)      # cut-off moves to the newest day
    run3 = snapshot()
    stages.update_stage3(spark, full, s3, sites)      # cut-off unchanged
    run4 = snapshot()
    assert run3 == run4
    # rows strictly before the first cut-off day survive the first update untouched
    last = {}
    for r in run1:
        last[r[6]] = max(last.get(r[6], r[2]), r[2])
    cut = {k: v.date() - dt.timedelta(days=3) for k, v in last.items()}  # per site
    before = [r for r in run1 if r[2].date() < cut[r[6]]]
    assert before and before == [r for r in run2 if r[2].date() < cut[r[6]]]
    assert max(r[2] for r in run2) > max(r[2] for r in run1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_python_and_pushes_filters(spark, tmp_path):
    ps = adapter_pseudo(spark, SF)
    root = str(tmp_path / "pseudo")
    write_partitioned(ps, root, ["reference_datetime"])
    src = datasets.native_variables(datasets.read_dataset(spark, root, PSEUDO))
    src = src.filter(F.col("reference_datetime") >= "2024-01-20")
    plan = _plan(src)
    assert "PushedFilters: [In(variable" in plan and "PartitionFilters" in plan
    h = to_hourly(src, builtin_sites(spark), ["site_id"], pseudo=True)
    text = h._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_stage2_build_prunes_stage1_partitions(spark):
    from hourcast.sources.events_adapter import forecast
    root, out = scratch_dir(spark, "s1"), scratch_dir(spark, "s2")
    write_partitioned(forecast(spark, SF), root, ["reference_datetime"])
    missing = stages.build_stage2(spark, root, out, builtin_sites(spark), "2024-01-10", 3)
    got = datasets.read_dataset(spark, out, stages.STAGE2_READ)
    assert {r[0] for r in got.select("reference_datetime").distinct().collect()} == {"2024-01-08"}
    assert missing == ["2024-01-07", "2024-01-08", "2024-01-09"]


def test_update_never_starts_a_site_without_history(spark):
    from hourcast.sources.events_adapter import pseudo as adapter_pseudo
    sites = builtin_sites(spark)
    ps = adapter_pseudo(spark, SF)
    hist = stages.stage3_frame(ps.filter((F.col("site_id") == "fcre")
                                         & (F.col("reference_datetime") < "2024-01-20")), sites)
    out = stages.stage3_update_frame(hist, ps, sites)
    got = {r[0] for r in out.select("site_id").distinct().collect()}
    assert got == {"fcre"}   # BARC, TOOK, ALEX have new rows but no history


def test_observations_are_shuffled_once(spark):
    """The summary of the chunks reuses the exchange that brings a chunk's rows together."""
    import re

    from hourcast.sinks.util import materialize
    from hourcast.sources.events_adapter import forecast
    rows = materialize(forecast(spark, SF).repartition(6))
    out = to_hourly(rows, None, ["reference_datetime"], use_solar_geom=False)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    chunks = [k for k, line in enumerate(plan) if re.search(r"Exchange hashpartitioning\([^)]*chunk", line)]
    shuffled = [k for k in chunks if "ReusedExchange" not in plan[k] and "Union" in plan[k + 1]]
    assert len(shuffled) == 1 and any("ReusedExchange" in plan[k] for k in chunks)
