"""Hand-made fixtures for the edges the adapter data does not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import at, pseudo, series, stage1
from hourcast.functions.naming import member_number
from hourcast.operators.hourly import disaggregate, flux_duplicates, solar_bin_table, to_hourly
from hourcast.operators.pseudo import repair_datetime
from hourcast.sources.site_list import builtin_sites, read_sites

FB = ["reference_datetime"]
AT, PR, RH = "air_temperature", "air_pressure", "relative_humidity"


def hourly(spark, rows, **kw):
    kw.setdefault("use_solar_geom", False)
    return to_hourly(stage1(spark, rows), builtin_sites(spark) if kw["use_solar_geom"] else None,
                     FB, **kw)


def test_gap_linear(spark):
    rows = [("fcre", "gec00", "TMP", 0, "000", 10.0), ("fcre", "gec00", "TMP", 3, "003", 16.0),
            ("fcre", "gec00", "TMP", 9, "009", 4.0), ("fcre", "gec00", "PRES", 12, "012", 1000.0)]
    out = hourly(spark, rows)
    tmp = series(out, "fcre", "gec00", AT)
    want = [10, 12, 14, 16, 14, 12, 10, 8, 6, 4, 4, 4, 4]
    assert [tmp[at(h)] for h in range(13)] == [w + 273.0 for w in want]
    pres = series(out, "fcre", "gec00", PR)  # one value only: left unchanged
    assert pres[at(12)] == 1000.0 and all(pres[at(h)] is None for h in range(12))
    assert out.count() == 26


def test_late_start_and_short_member(spark):
    rows = [("fcre", "gec00", "TMP", 0, "000", 1.0), ("fcre", "gec00", "TMP", 6, "006", 7.0),
            ("fcre", "gep01", "TMP", 6, "006", 5.0), ("fcre", "gep01", "TMP", 12, "012", 11.0)]
    out = hourly(spark, rows)
    a, b = series(out, "fcre", "gec00", AT), series(out, "fcre", "gep01", AT)
    assert len(a) == 7 and len(b) == 13  # per-series end, batch-wide start
    assert [b[at(h)] - 273 for h in range(6)] == [5.0] * 6  # constant head
    assert [round(b[at(h)] - 273, 9) for h in range(6, 13)] == [5.0, 6, 7, 8, 9, 10, 11]


def test_missing_variable_kept_as_null(spark):
    rows = [("fcre", "gec00", "TMP", 0, "000", 1.0), ("fcre", "gec00", "TMP", 3, "003", 2.0),
            ("fcre", "gec00", "RH", 0, "000", 50.0), ("fcre", "gec00", "RH", 3, "003", 60.0),
            ("BARC", "gec00", "TMP", 0, "000", 1.0), ("BARC", "gec00", "TMP", 3, "003", 2.0)]
    out = hourly(spark, rows)
    rh = series(out, "BARC", "gec00", RH)
    assert len(rh) == 4 and all(v is None for v in rh.values())
    assert series(out, "fcre", "gec00", RH)[at(1)] == pytest.approx(0.5 + 0.1 / 3)


def test_flux_tail_and_rate(spark):
    rows = [("fcre", "gec00", "APCP", 6, "006", 21600.0), ("fcre", "gec00", "TMP", 0, "000", 1.0),
            ("fcre", "gec00", "TMP", 12, "012", 1.0), ("fcre", "gec00", "APCP", 9, "003", 43200.0)]
    out = to_hourly(stage1(spark, rows), None, FB, use_solar_geom=False, names=None)
    pr = series(out, "fcre", "gec00", "PRATE")
    assert [pr[at(h)] for h in range(7)] == [1.0] * 7
    assert all(pr[at(h)] is None for h in range(7, 13))  # 003 dropped; trailing NULL


def test_newest_hour6_exception(spark):
    rows = [("fcre", "gec00", "TMP", 0, "000", "00", 1.0, "2024-01-01"),
            ("fcre", "gec00", "TMP", 3, "003", "00", 2.0, "2024-01-01"),
            ("fcre", "gec00", "TMP", 3, "006", "18", 9.0, "2023-12-31"),
            ("fcre", "gec00", "TMP", 6, "006", "00", 5.0, "2024-01-01")]
    out = to_hourly(pseudo(spark, rows), None, ["site_id"], pseudo=True, use_solar_geom=False)
    tmp = series(out, "fcre", "gec00", AT)
    assert tmp[at(3)] == 275.0  # non-newest 006 dropped
    assert tmp[at(6)] == 278.0  # newest time kept from 006


def test_newest_both_duplicate_survives(spark):
    rows = [("fcre", "gec00", "TMP", 3, "003", "00", 2.0, "2024-01-01"),
            ("fcre", "gec00", "TMP", 6, "000", "06", 5.0, "2024-01-01"),
            ("fcre", "gec00", "TMP", 6, "006", "00", 7.0, "2024-01-01")]
    out = to_hourly(pseudo(spark, rows), None, ["site_id"], pseudo=True, use_solar_geom=False)
    tmp = out.filter(F.col("variable") == AT)
    at6 = sorted(r.prediction for r in tmp.filter(F.col("datetime") == at(6)).collect())
    assert at6 == [278.0, 280.0]
    s = series(tmp, "fcre", "gec00", AT)
    assert s[at(4)] == pytest.approx(276.0) and s[at(5)] == pytest.approx(277.0)


def test_flux_hour0_null_takes_same_time_value(spark):
    rows = [("fcre", "gec00", "APCP", 6, "000", "06", None, "2024-01-01"),
            ("fcre", "gec00", "APCP", 6, "006", "00", 21600.0, "2024-01-01"),
            ("fcre", "gec00", "TMP", 0, "000", "00", 1.0, "2024-01-01")]
    out = to_hourly(pseudo(spark, rows), None, ["site_id"], pseudo=True, use_solar_geom=False)
    pr = out.filter(F.col("variable") == "precipitation_flux")
    assert pr.filter(F.col("datetime") == at(6)).count() == 2
    assert {r.prediction for r in pr.collect()} == {1.0}


def _sw_rows(site, base, days=2):
    rows = []
    for h in range(0, days * 24 + 1, 6):
        rows.append((site, "gec00", "DSWRF", h, f"{h:03d}", 100.0, base))
        rows.append((site, "gec00", "DLWRF", h, f"{h:03d}", 300.0, base))
        rows.append((site, "gec00", "APCP", h, f"{h:03d}", 0.0, base))
    return rows


def test_shortwave_daily_mean_preserved(spark):
    base = dt.datetime(2024, 6, 1)
    out = to_hourly(stage1(spark, _sw_rows("fcre", base), "2024-06-01"), builtin_sites(spark), FB)
    sw = out.filter(F.col("variable") == "surface_downwelling_shortwave_flux_in_air")
    day = sw.filter(F.to_date("datetime") == dt.date(2024, 6, 1))
    vals = [r.prediction for r in day.collect()]
    assert len(vals) == 24 and min(vals) >= 0
    assert sum(vals) / 24 == pytest.approx(100.0)
    assert max(vals) > 100.0  # shaped by the sun


def test_polar_night_value_kept(spark):
    base = dt.datetime(2024, 12, 10)
    out = to_hourly(stage1(spark, _sw_rows("TOOK", base), "2024-12-10"), builtin_sites(spark), FB)
    sw = out.filter(F.col("variable") == "surface_downwelling_shortwave_flux_in_air")
    assert {r.prediction for r in sw.collect()} == {100.0}


def test_unknown_site_shortwave_null_others_kept(spark):
    base = dt.datetime(2024, 6, 1)
    out = to_hourly(stage1(spark, _sw_rows("ZZZZ", base), "2024-06-01"), builtin_sites(spark), FB)
    sw = out.filter(F.col("variable") == "surface_downwelling_shortwave_flux_in_air").collect()
    lw = out.filter(F.col("variable") == "surface_downwelling_longwave_flux_in_air").collect()
    assert all(r.prediction is None for r in sw)
    assert {r.prediction for r in lw} == {300.0}


@pytest.mark.parametrize("fluxes,expected", [(["DSWRF"], 3600.0), (["DSWRF", "DLWRF", "APCP"], 0.0)])
def test_bin_step(spark, fluxes, expected):
    rows = [r for r in _sw_rows("fcre", dt.datetime(2024, 6, 1)) if r[2] in fluxes]
    rows += [("BARC",) + r[1:] for r in rows]
    dd = disaggregate(stage1(spark, rows, "2024-06-01"), FB)
    got = solar_bin_table(flux_duplicates(dd.src, dd.series, FB, dd.variables), dd.series, dd.variables, FB).collect()
    assert len(got) == 1 and got[0].bin_seconds == pytest.approx(expected, abs=1e-6)


def test_repair_datetime(spark):
    rows = [("fcre", "gec00", "TMP", 12, "006", "06", 1.0, "2024-01-01"),   # stored 12:00, rebuilt 12:00
            ("fcre", "gec00", "TMP", 18, "006", "06", 1.0, "2024-01-01"),   # off by 6 h -> 12:00
            ("fcre", "gec00", "TMP", 12, None, "06", 1.0, "2024-01-01")]    # NULL horizon -> NULL
    out = repair_datetime(pseudo(spark, rows)).orderBy(F.col("horizon").asc_nulls_last()).collect()
    assert [r.datetime for r in out] == [at(12), at(12), None]


def test_member_number(spark):
    df = spark.createDataFrame([("gec00",), ("gep07",), ("mean",), ("gep30",)], "ensemble string")
    got = [r.p for r in df.select(member_number("ensemble").alias("p")).collect()]
    assert got == [0.0, 7.0, None, 30.0]


def test_site_csv_blanks(spark, tmp_path):
    p = tmp_path / "sites.csv"
    p.write_text("site_name,site_id,latitude,longitude\n"
                 "Lake Alexandrina, ALEX,-35.436808, 139.168997\n")
    r = read_sites(spark, str(p)).collect()[0]
    assert r.site_id == "ALEX" and r.longitude == pytest.approx(139.168997)


def test_chunk_boundaries_do_not_change_results(spark):
    rows = [("fcre", "gec00", "TMP", h, f"{h:03d}", float(h % 7)) for h in range(0, 24 * 9, 9)]
    rows += [("fcre", "gec00", "APCP", h, f"{h:03d}", float(h)) for h in range(6, 24 * 9, 30)]
    a = to_hourly(stage1(spark, rows), None, FB, use_solar_geom=False, chunk_days=1)
    b = to_hourly(stage1(spark, rows), None, FB, use_solar_geom=False, chunk_days=30)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_pad_left_keeps_long_text(spark):
    from hourcast.functions.naming import pad_left
    df = spark.createDataFrame([("6",), ("840",), ("1234",)], "h string")
    assert [r[0] for r in df.select(pad_left("h", 3)).collect()] == ["006", "840", "1234"]


def test_output_follows_input_column_order(spark):
    rows = [("fcre", "gec00", "TMP", 0, "000", 1.0), ("fcre", "gec00", "TMP", 3, "003", 2.0)]
    df = stage1(spark, rows)
    df = df.select("reference_datetime", "datetime", "variable", "prediction", "site_id", "family",
                   "ensemble", "horizon")
    out = to_hourly(df, None, FB, use_solar_geom=False)
    assert out.columns == ["reference_datetime", "datetime", "variable", "prediction", "site_id",
                           "family", "ensemble"]


def _brute_bin_seconds(series_hours, base):
    """Median of successive day-of-year diffs over the flux frame (one flux variable)."""
    import statistics
    doys = []
    for n in series_hours:  # series in sort order, each from the batch start
        for h in range(n + 1):
            t = base + dt.timedelta(hours=h)
            doys.append(t.timetuple().tm_yday + t.hour / 24)
    diffs = [b - a for a, b in zip(doys, doys[1:])]
    return statistics.median(diffs) * 86400


@pytest.mark.parametrize("hours", [(30, 30), (30, 2), (1, 1, 1), (0, 40)])
def test_bin_step_year_wrap_matches_brute_force(spark, hours):
    base = dt.datetime(2023, 12, 31, 12)
    sites = ["BARC", "TOOK", "fcre"][:len(hours)]
    rows = []
    for site, n in zip(sites, hours):
        rows.append((site, "gec00", "DSWRF", 0, "000", 100.0, base))
        rows.append((site, "gec00", "DSWRF", n, f"{n:03d}", 100.0, base))
    dd = disaggregate(stage1(spark, rows, "2023-12-31"), FB)
    got = solar_bin_table(flux_duplicates(dd.src, dd.series, FB, dd.variables), dd.series, dd.variables, FB).collect()
    want = _brute_bin_seconds(hours, base)
    assert got[0].bin_seconds == pytest.approx(want, abs=1e-6)


def test_utc_timestamps_give_same_result(spark):
    """Files holding UTC-adjusted timestamps (TIMESTAMP) give the same hours as NTZ."""
    from hourcast.sources.events_adapter import forecast
    fc = forecast(spark, "/root/testdata/sf0.001")
    a = to_hourly(fc, builtin_sites(spark), FB)
    b = to_hourly(fc.withColumn("datetime", F.col("datetime").cast("timestamp")), builtin_sites(spark), FB)
    b = b.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")) \
         .withColumn("reference_datetime", F.col("reference_datetime").cast("timestamp_ntz"))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
