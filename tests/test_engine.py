import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import make_store

from gridclimate.engine import ClimateEngine
from gridclimate.sources.store import ObservationStore, select_window

D = dt.datetime


@pytest.fixture(scope="module")
def engine(spark):
    store = make_store(spark, [(10.0, 20.0), (-10.0, -20.0), (15.0, 20.0)], ("T2M", "RH2M"))
    return ClimateEngine(spark, store)


def test_point(engine):
    out = engine.point("10° 0.0' N", "20.0 E", "20230101", "2023-01-02", ["RH2M", "PS"])
    assert out.columns == ["obs_ts", "RH2M", "PS"]
    assert sorted(map(tuple, out.collect())) == [(D(2023, 1, 1), 0.0, None), (D(2023, 1, 2), 1.0, None)]
    empty = engine.point(60, 60, "2023-01-01", "2023-01-03", ["T2M"]).orderBy("obs_ts").collect()
    assert [tuple(r) for r in empty] == [(D(2023, 1, d), None) for d in (1, 2, 3)]


@pytest.mark.parametrize("args, message", [
    ((0, 0, "05/03/2023", "2023-03-06", ["T2M"]), "ambiguous"), ((0, 0, "2023-01-02", "2023-01-01", ["T2M"]), "start after end"),
    ((91, 0, "2023-01-01", "2023-01-02", ["T2M"]), "latitude"), ((0, 0, "2023-01-01", "2023-01-02", []), "no parameters"),
])
def test_point_refuses(engine, args, message):
    with pytest.raises(ValueError, match=message):
        engine.point(*args)


def test_multi_point(engine):
    sites = [{"lat": 10, "lon": 20, "name": "a"}, (-10.0, -20.0), {"lat": "north", "lon": 1, "name": "lost"},
             {"lat": 1, "lon": 1, "wind_elevation": 5, "name": "windy"}, (50.0, 50.0)]
    answer, failed = engine.multi_point(sites, "2023-01-01", "2023-01-02", ["T2M"])
    assert sorted((r["site_id"], r["obs_ts"].day, r["T2M"]) for r in answer.collect() if r["T2M"] is not None) == [
        (0, 1, 0.0), (0, 2, 1.0), (1, 1, 100.0), (1, 2, 101.0)]
    assert answer.where("T2M is null").select("site_id").distinct().count() == 1
    assert {r["name"]: r["reason"] for r in failed.collect()} == {
        "lost": "cannot read latitude", "windy": "wind elevation outside [10, 300]"}


def test_transect_and_region(engine):
    out = engine.transect((10, 20), (15, 20), "2023-01-01", "2023-01-01", ["T2M"], num_points=3)
    assert {r["name"]: r["T2M"] for r in out.collect()} == {"Point_1": 0.0, "Point_2": None, "Point_3": 200.0}
    with pytest.raises(ValueError):
        engine.transect((10, 20), (15, 20), "2023-01-01", "2023-01-01", ["T2M"])
    box = engine.region(9, 12, 19, 21, "2023-01-01", "2023-01-02", ["T2M"])
    assert box.columns == ["obs_ts", "lat", "lon", "T2M"] and box.count() == 2
    assert engine.region_between(("9 N", "19 E"), (12, 21), "2023-01-01", "2023-01-02", ["T2M"]).count() == 2
    with pytest.raises(ValueError, match="wider"):
        engine.region(0, 5, 0, 4, "2023-01-01", "2023-01-02", ["T2M"])
    with pytest.raises(ValueError, match="more than 1"):
        engine.region(0, 4, 0, 4, "2023-01-01", "2023-01-02", ["T2M", "PS"])


def test_hourly_rules(spark, engine):
    hourly = ClimateEngine(spark, engine.rows, "hourly")
    with pytest.raises(ValueError, match="GWETTOP"):
        hourly.multi_point([(0, 0)], "2023-01-01", "2023-01-02", ["GWETTOP"])
    with pytest.raises(ValueError, match="hourly regional"):
        hourly.region(0, 4, 0, 4, "2023-01-01", "2023-01-02", ["T2M"])
    with pytest.raises(ValueError):
        ClimateEngine(spark, engine.rows, "weekly")


def test_plan_and_summary(spark, engine):
    asks = spark.createDataFrame([("T2M", 200, 320, D(2022, 12, 30), D(2023, 1, 5))],
                                 "param string, cell_lat int, cell_lon int, start_date timestamp_ntz, end_date timestamp_ntz")
    plan = engine.fetch_plan(asks, ["param", "cell_lat", "cell_lon"]).orderBy("range_no").collect()
    assert [(r["start_key"], r["end_key"]) for r in plan] == [("20221230", "20221231"), ("20230104", "20230105")]
    row = engine.summarize(engine.point(10, 20, "2023-01-01", "2023-01-02", ["T2M"]), ["T2M"]).first()
    assert (row["data_points"], row["missing_values"], row["temporal"]) == (2, 0, "daily")
    assert engine.parameters().count() == 18


def test_point_reads_only_its_partitions(spark, shared):
    """Against a written store the cell, window and parameters reach the scan."""
    store = ObservationStore(spark, shared + "/obs")
    store.append(make_store(spark, [(10.0, 20.0), (50.0, 50.0)], ("T2M", "PS")), order="ingest_seq")
    engine = ClimateEngine(spark, store)
    out = engine.point(10, 20, "2023-01-01", "2023-01-02", ["T2M"])
    assert out.count() == 2
    text = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "obs_ts" in line]
    assert scans and all("cell_lat" in line.split("PushedFilters")[1] for line in scans)
    assert all("param" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans)


def test_end_of_day(spark):
    rows = spark.createDataFrame([(D(2023, 1, 1, h),) for h in range(24)], "obs_ts timestamp_ntz")
    assert select_window(rows, start="2023-01-01", end="2023-01-01").count() == 1
    assert select_window(rows, start="2023-01-01", end="2023-01-01", end_of_day=True).count() == 24
    assert rows.where(F.col("obs_ts").isNull()).count() == 0


def test_whole_end_day_and_warnings(spark):
    stamps = [(D(2023, 1, 1) + dt.timedelta(hours=h), float(h)) for h in range(72)]
    rows = spark.createDataFrame([("hourly", "T2M", 200, 320, "base", t, x) for t, x in stamps],
                                 "temporal string, param string, cell_lat int, cell_lon int, variant string, obs_ts timestamp_ntz, value double")
    for whole, hours in ((True, 48), (False, 25)):
        asked = ClimateEngine(spark, rows, "hourly", end_of_day=whole)
        assert asked.point(10.0, 20.0, "2023-01-01", "2023-01-02", ["T2M"]).count() == hours
        assert asked.point(-60.0, 20.0, "2023-01-01", "2023-01-02", ["T2M"]).count() == hours  # the NULL calendar
    with pytest.warns(UserWarning, match="unknown parameter"):
        ClimateEngine(spark, rows, "hourly").point(10.0, 20.0, "2023-01-01", "2023-01-02", ["T2M", "NO_SUCH"])


def test_fetch_plan_reads_the_kept_coverage(spark, shared):
    store = ObservationStore(spark, shared + "/obs")
    store.append(make_store(spark, [(10.0, 20.0)], ("T2M",)), order="ingest_seq")
    asks = spark.createDataFrame([("T2M", 200, 320, D(2022, 12, 30), D(2023, 1, 5))],
                                 "param string, cell_lat int, cell_lon int, start_date timestamp_ntz, end_date timestamp_ntz")
    plan = ClimateEngine(spark, store).fetch_plan(asks, ["param", "cell_lat", "cell_lon"])
    assert [(r["start_key"], r["end_key"]) for r in plan.orderBy("range_no").collect()] == [("20221230", "20221231"), ("20230104", "20230105")]
    assert "obs_ts" not in plan._jdf.queryExecution().executedPlan().toString()  # no history is scanned


def test_sites_with_unreadable_numbers_fail_by_name(spark, engine):
    sites = spark.createDataFrame([("farm_A", "10", "20", "high"), ("farm_B", "10", "20", None)], "site_id string, lat string, lon string, elevation string")
    answer, failed = engine.multi_point(sites, "2023-01-01", "2023-01-01", ["T2M"])
    assert [r["site_id"] for r in answer.collect()] == ["farm_B"]
    assert [(r["site_id"], r["reason"]) for r in failed.collect()] == [("farm_A", "unreadable elevation")]
