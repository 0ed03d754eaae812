import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridclimate.operators import requests as Q
from gridclimate.sources import catalog as cat
from gridclimate.sources.store import coverage

D, DAY = dt.datetime, dt.date


def validate(spark, params, temporal="daily", start=DAY(2023, 1, 1), end=DAY(2023, 1, 31), wind=None):
    df = spark.createDataFrame([(params, temporal, start, end, wind)],
                               "params array<string>, temporal string, start_date date, end_date date, wind_elevation double")
    row = Q.validate_requests(df).first()
    return row["violations"], row["warnings"]


def test_limits(spark):
    codes = cat.ALL_GROUP
    assert validate(spark, codes) == ([], [])
    assert validate(spark, (codes * 2)[:21])[0] == ["more than 20 parameters"]
    hourly = [c for c in codes if c not in cat.DAILY_ONLY]
    assert validate(spark, hourly, "hourly")[0] == []
    assert validate(spark, (hourly * 2)[:16], "hourly")[0] == ["more than 15 parameters"]
    assert validate(spark, [])[0] == ["no parameters"]
    assert validate(spark, ["T2M"], "weekly")[0] == ["unknown resolution"]


def test_wind_and_dates(spark):
    assert validate(spark, ["T2M"], wind=10.0)[0] == [] and validate(spark, ["T2M"], wind=300.0)[0] == []
    for bad in (5.0, 400.0):
        assert validate(spark, ["T2M"], wind=bad)[0] == ["wind elevation outside [10, 300]"]
    assert validate(spark, ["T2M"], start=DAY(2023, 2, 1))[0] == ["start after end"]
    assert validate(spark, ["T2M"], start=DAY(2023, 1, 31))[0] == []


@pytest.mark.parametrize("code", cat.DAILY_ONLY)
def test_daily_only(spark, code):
    assert validate(spark, [code, "T2M"], "hourly")[0] == [f"daily-only parameter on hourly request: {code}"]
    assert validate(spark, [code])[0] == []


def test_warnings(spark):
    assert validate(spark, ["INVALID_PARAM"]) == ([], ["unknown parameter: INVALID_PARAM"])
    early = ["starts before the data does"]
    assert validate(spark, ["T2M"], start=DAY(1980, 12, 31))[1] == early
    assert validate(spark, ["T2M"], start=DAY(1982, 1, 1))[1] == []
    assert validate(spark, ["ALLSKY_SFC_SW_DWN"], start=DAY(1982, 1, 1))[1] == early
    assert validate(spark, ["T2M"], "hourly", start=DAY(2000, 1, 1))[1] == early


def test_boxes(spark):
    rows = [(1, 0.0, 5.0, 0.0, 4.0), (2, 0.0, 4.0, 0.0, 5.0), (3, 10.0, 5.0, 0.0, 4.0), (4, 0.0, 4.0, 10.0, 5.0),
            (5, -23.5, -20.0, -47.0, -44.0), (6, 88.0, 91.0, 0.0, 4.0), (7, 0.0, 4.5, 0.0, 4.5)]
    df = spark.createDataFrame(rows, "id int, lat_min double, lat_max double, lon_min double, lon_max double")
    got = {r["id"]: r["violations"] for r in Q.validate_regions(df).collect()}
    assert got[1] == got[2] == ["box wider than 4.5 degrees"]
    assert got[3] == ["lat_min not below lat_max"] and got[4] == ["lon_min not below lon_max"]
    assert got[5] == [] and got[7] == [] and got[6] == ["box outside the globe"]
    full = df.withColumns({"params": F.array(F.lit("T2M"), F.lit("PS")), "temporal": F.lit("hourly"),
                           "s": F.lit(DAY(2023, 1, 1)), "e": F.lit(DAY(2023, 1, 2))})
    row = Q.validate_regions(full, "params", "temporal", "s", "e").where("id = 5").first()
    assert row["violations"] == ["no hourly regional data", "more than 1 parameter"]
    good, bad = Q.split_requests(Q.validate_regions(df))
    assert (good.count(), bad.count()) == (2, 5)


def plan(spark, held, start, end, temporal="daily"):
    obs = spark.createDataFrame([(1, h) for h in held], "k int, obs_ts timestamp_ntz")
    ask = spark.createDataFrame([(1, start, end, temporal)], "k int, start_date timestamp_ntz, end_date timestamp_ntz, temporal string")
    planned = Q.missing_ranges(ask, coverage(obs, ["k"]), ["k"])
    return [(r["range_start"], r["range_end"]) for r in Q.fetch_plan(planned).orderBy("range_no").collect()]


def test_fetch_plan(spark):
    jan = lambda d, h=0: D(2023, 1, d, h)
    assert plan(spark, [], jan(1), jan(3)) == [(jan(1), jan(3))]
    assert plan(spark, [jan(2)], jan(1), jan(3)) == [(jan(1), jan(1)), (jan(3), jan(3))]
    assert plan(spark, [jan(1), jan(5)], jan(2), jan(4)) == []
    assert plan(spark, [jan(10), jan(12)], jan(1), jan(3)) == [(jan(1), jan(9))]
    assert plan(spark, [jan(1), jan(3)], jan(10), jan(12)) == [(jan(4), jan(12))]
    assert plan(spark, [jan(1, h) for h in range(24)], jan(1), jan(1), "hourly") == []
    assert plan(spark, [jan(1, h) for h in range(20)], jan(1), jan(2), "hourly") == [(jan(1, 20), jan(2, 23))]


def test_hit_rate(spark):
    schema = "k int, ranges array<struct<range_start: timestamp_ntz, range_end: timestamp_ntz>>"
    df = spark.createDataFrame([(1, []), (2, [(D(2023, 1, 1), D(2023, 1, 2))]), (3, [])], schema)
    row = Q.plan_hit_rate(df).first()
    assert tuple(row) == (3, 2, 1, 66.7)
    assert tuple(Q.plan_hit_rate(df.where("k > 9")).first()) == (0, 0, 0, 0.0)


def test_served_from(spark):
    span = [(D(2023, 1, 1), D(2023, 1, 2))]
    rows = [(1, [], D(2023, 1, 1), "HTTP 500"), (2, span, None, "ok"), (3, span, D(2023, 1, 1), "HTTP 500"),
            (4, span, None, "HTTP 500"), (5, span, D(2023, 1, 1), "HTTP 422: no"), (6, span, D(2023, 1, 1), "HTTP 400")]
    df = spark.createDataFrame(rows, "k int, ranges array<struct<a: timestamp_ntz, b: timestamp_ntz>>, held_min timestamp_ntz, fetch_status string")
    got = {r["k"]: r["served_from"] for r in Q.served_from(df).collect()}
    assert got == {1: "store", 2: "fresh", 3: "stale", 4: "error", 5: "error", 6: "error"}


def test_failures(spark):
    ask = spark.range(10).withColumnRenamed("id", "k")
    done = ask.where("k < 2")
    why = spark.createDataFrame([(2, "b"), (3, "a"), (4, "b"), (5, "c")], "k long, reason string")
    failed = Q.failed_points(ask, done, why, ["k"])
    assert {r["k"]: r["reason"] for r in failed.collect()} == {
        2: "b", 3: "a", 4: "b", 5: "c", **{k: "no data returned" for k in range(6, 10)}}
    row = Q.failure_sample(failed, "k").first()
    assert tuple(row) == (8, "2: b; 3: a; 4: b; 5: c; 6: no data returned", 3, "b, a")
    none = Q.failure_sample(failed.where("k > 99"), "k").first()
    assert (none["failed_count"], none["more_count"], none["messages"]) == (0, 0, "")


def test_request_key(spark):
    def key(params, temporal="daily", elevation=None):
        df = spark.createDataFrame([(params, temporal, elevation)], "p array<string>, t string, e double")
        nothing = F.lit(None).cast("double")
        return df.select(Q.request_key(F.col("p"), F.col("t"), F.lit(1.0), F.lit(2.0), F.col("e"), nothing,
                                       F.lit(None).cast("string")).alias("k")).first()["k"]
    base = key(["T2M", "PS"])
    assert base.startswith("v1_") and len(base) == 67 and base == key(["T2M", "PS"])
    assert len({base, key(["PS", "T2M"]), key(["T2M", "PS"], "hourly"), key(["T2M", "PS"], elevation=5.0)}) == 4


def test_catalog(spark):
    rows = {r["param"]: r for r in cat.catalog(spark).collect()}
    assert len(rows) == 18 and sum(r["in_default"] for r in rows.values()) == 7
    assert sum(r["availability"]["hourly_start"] is None for r in rows.values()) == 3
    assert sum(r["native_grid"]["lat_step"] == 1.0 for r in rows.values()) == 2
    assert cat.catalog_group(spark, "nonsense").count() == 7 and cat.catalog_group(spark, "all").count() == 18
    with pytest.raises(ValueError):
        cat.catalog_group(spark, "nonsense", strict=True)
    assert cat.describe_param(spark, "t2m").first()["param"] == "T2M"
    with pytest.raises(ValueError):
        cat.describe_param(spark, "nope")
    grid = cat.with_catalog(spark.createDataFrame([("FOO",), ("ALLSKY_SFC_SW_DWN",)], "param string"), resolution="hourly")
    got = {r["param"]: (r["grid_lat_step"], r["grid_lon_step"], r["unit"]) for r in grid.collect()}
    assert got == {"FOO": (0.5, 0.625, None), "ALLSKY_SFC_SW_DWN": (1.0, 1.0, "W/m²")}


def test_request_keys_tell_places_and_absent_parts_apart(spark):
    schema = "lat double, lon double, e double, w double, surf string, p array<string>"
    rows = [(1.0, 2.0, None, None, None, ["T2M"]), (1.0000001, 2.0, None, None, None, ["T2M"]), (None, 2.0, None, None, None, ["T2M"]), (2.0, None, None, None, None, ["T2M"]),
            (1.0, 2.0, 5.0, None, None, ["T2M"]), (1.0, 2.0, None, 5.0, None, ["T2M"]), (1.0, 2.0, None, None, "\\N", ["T2M"]), (1.0, 2.0, None, None, "-", ["T2M"]),
            (1.0, 2.0, None, None, "a|b", ["T2M"]), (1.0, 2.0, None, None, None, ["T2M", "PS"]), (1.0, 2.0, None, None, None, ["T2M,PS"]), (1.0, 2.0, None, None, None, None),
            (1.0, 2.0, None, None, None, []), (0.0, 2.0, None, None, None, ["T2M"])]
    df = spark.createDataFrame(rows, schema)

    def keys(frame):
        return [r[0] for r in frame.select(Q.request_key(F.col("p"), F.lit("daily"), F.col("lat"), F.col("lon"), F.col("e"), F.col("w"), F.col("surf"))).collect()]

    found = keys(df)
    assert len(set(found)) == len(rows) and all(k.startswith("v1_") and len(k) == 67 for k in found)
    assert keys(df.where("lat = 0").withColumn("lat", F.lit(-0.0))) == found[-1:]


def test_holes_are_sought_per_block(spark):
    """Where keys and requests are shuffled to meet, a key's stamps are still dealt over its blocks, not left in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = [d for d in range(800) if d % 100] + [7, 7]  # from 2022-01-02 on, a day missing in every hundred, one held three times
        obs = spark.createDataFrame([(k, "daily", d) for k in (1, 2) for d in days] + [(1, "daily", None), (3, "daily", None)], "k int, temporal string, d int").select(
            "k", "temporal", F.expr("cast(date_add(date'2022-01-01', d) as timestamp_ntz)").alias("obs_ts"))
        asked = spark.createDataFrame([(1, "daily", "2022-01-01", "2024-12-31"), (1, "daily", "2022-02-01", "2022-02-02"), (3, "daily", "2022-01-05", "2022-01-05")],
                                      "k int, temporal string, start_date string, end_date string")
        out = Q.fetch_holes(asked, obs, ["k", "temporal"])
        text = out._jdf.queryExecution().executedPlan().toString()
        assert any("Exchange hashpartitioning(" in x and "_block#" in x for x in text.splitlines())
        got = sorted((r["k"], r["start_date"], r["start_key"], r["end_key"]) for r in out.collect())
        first = dt.date(2022, 1, 1)
        holes = [(first + dt.timedelta(d)).strftime("%Y%m%d") for d in range(0, 800, 100)]
        want = [(1, "2022-01-01", x, x) for x in holes] + [(1, "2022-01-01", (first + dt.timedelta(800)).strftime("%Y%m%d"), "20241231"), (3, "2022-01-05", "20220105", "20220105")]
        assert got == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
