import datetime as dt
import json

from pyspark.sql import functions as F

from gridclimate.plans.points import to_wide
from gridclimate.sources import responses as R

D = dt.datetime
# Three parameters whose keys do not agree, over a leap day.
DAILY = {"properties": {"parameter": {
    "PRECTOTCORR": {"20240228": 0.0, "20240229": 31.25},
    "WS10M": {"20240229": 4.75, "20240301": -999},
    "T2M_MAX": {"20240228": -7.5, "20240229": -999, "20240301": 0.25}}},
    "geometry": {"type": "Point", "coordinates": [-61.875, -38.25]}}


def feature(spot, **series):
    return {"geometry": {"coordinates": spot}, "properties": {"parameter": series}}


REGION = {"features": [
    feature([-62.5, -38.0, 214.0], WS10M={"20240229": 3.5, "20240301": 6.0}, RH2M={"20240229": 71.0}),
    feature([-61.875, -38.0], WS10M={"20240229": -999, "20240301": 5.5}),
    feature([-61.25, -38.5, 180.5], WS10M={"20240229": 2.25, "202403": 1.0, "20240230": 1.0, "2024022900": 1.0}),
    feature([-61.25], WS10M={"20240229": 9.0}), feature([-61.25, -138.5], WS10M={"20240229": 9.0}), feature([None, 1.0], WS10M={"20240229": 9.0})]}


def bodies(spark, *docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "response_id int, body string")


def test_daily(spark):
    wide = to_wide(R.ingest_point(bodies(spark, DAILY)), ["obs_ts"], ["PRECTOTCORR", "WS10M", "T2M_MAX"]).orderBy("obs_ts").collect()
    assert [tuple(r) for r in wide] == [(D(2024, 2, 28), 0.0, None, -7.5), (D(2024, 2, 29), 31.25, 4.75, None), (D(2024, 3, 1), None, None, 0.25)]


def test_hourly(spark):
    doc = {"properties": {"parameter": {"WS10M": {"2024022923": 2.5, "2024030100": -999, "20240301": 3.0}}}}
    rows = R.ingest_point(bodies(spark, doc)).orderBy("obs_ts", "temporal").collect()
    assert [(r["temporal"], r["obs_ts"], r["value"]) for r in rows] == [
        ("hourly", D(2024, 2, 29, 23), 2.5), ("daily", D(2024, 3, 1), 3.0), ("hourly", D(2024, 3, 1), None)]


def test_partial_and_empty(spark):
    part = {"properties": {"parameter": {"T2M": {"20220704": 21.75}}}}
    empty = {"properties": {"parameter": {}}}
    rows = to_wide(R.ingest_point(bodies(spark, part, empty, {})), ["obs_ts"], ["T2M", "ALLSKY_SFC_SW_DWN"]).collect()
    assert [tuple(r) for r in rows] == [(D(2022, 7, 4), 21.75, None)]


def test_coercion_and_bad_keys(spark):
    doc = {"properties": {"parameter": {"T2M": {"20230101": "n/a", "20230102": "7.5", "20230103": None, "202301": 1, "20231399": 2}}}}
    rows = {r["obs_ts"].day: r["value"] for r in R.ingest_point(bodies(spark, doc)).collect()}
    assert rows == {1: None, 2: 7.5, 3: None}
    bad = {r["date_key"]: r["reason"] for r in R.bad_date_keys(bodies(spark, doc)).collect()}
    assert bad == {"202301": "unrecognised date key", "20231399": "unreadable date key"}


def test_region(spark):
    rows = R.ingest_region(bodies(spark, REGION)).collect()
    got = {(r["param"], r["lat"], r["lon"], r["obs_ts"].day): (r["elevation"], r["value"]) for r in rows}
    assert got == {("WS10M", -38.0, -62.5, 29): (214.0, 3.5), ("WS10M", -38.0, -62.5, 1): (214.0, 6.0), ("RH2M", -38.0, -62.5, 29): (214.0, 71.0),
                   ("WS10M", -38.0, -61.875, 29): (None, None), ("WS10M", -38.0, -61.875, 1): (None, 5.5), ("WS10M", -38.5, -61.25, 29): (180.5, 2.25)}
    left = sorted((r["date_key"] or "", r["reason"]) for r in R.region_quarantine(bodies(spark, REGION, {"messages": ["too big"]})).collect())
    assert left == [("", "coordinates out of range"), ("", "no coordinates"), ("", "no coordinates"), ("", "too big"),
                    ("2024022900", "no daily date key"), ("20240230", "no daily date key"), ("202403", "no daily date key")]
    stored = R.region_store_rows(bodies(spark, REGION)).collect()
    assert len(stored) == 6 and {(r["cell_lat"], r["cell_lon"]) for r in stored if r["param"] == "RH2M"} == {(104, 188)}


def test_errors(spark):
    docs = [json.dumps(DAILY), json.dumps({"messages": ["a", "b"]}), json.dumps({"error": "boom"}), "{broken", "oops", json.dumps({"x": 1})]
    status = [200, 400, 200, 200, 500, 422]
    assert {r["response_id"]: r["reason"] for r in R.response_errors(bodies(spark, *docs)).collect()}[1] == "a; b"  # no status landed
    df = spark.createDataFrame([(i, b, s) for i, (b, s) in enumerate(zip(docs, status))], "response_id int, body string, http_status int")
    got = {r["response_id"]: r["reason"] for r in R.response_errors(df).collect()}
    assert got == {1: "HTTP 400: a; b", 2: "boom", 3: "not JSON", 4: "HTTP 500", 5: "HTTP 422"}
    assert {r["response_id"] for r in R.ingest_point(df).collect()} == {0}
    assert {r["response_id"] for r in R.response_errors(bodies(spark, REGION, {"error": "x"}), "region").collect()} == {1}


def test_read_layouts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(DAILY, indent=1))
    (tmp_path / "b" / "many.json").write_text(json.dumps(DAILY) + "\n" + json.dumps({**DAILY, "x": 1}) + "\n")
    assert R.ingest_point(R.read_responses(spark, str(tmp_path / "a"))).count() == 7
    lines = R.read_responses(spark, str(tmp_path / "b"), "lines")
    assert R.ingest_point(lines).count() == 14 and lines.select("response_id").distinct().count() == 2


def test_export_round_trip(spark):
    for temporal, stamps in (("daily", [D(2022, 12, 31), D(2023, 1, 1)]), ("hourly", [D(2023, 1, 1, 0), D(2023, 1, 1, 1)])):
        rows = [(7, "T2M", stamps[0], 10.5), (7, "T2M", stamps[1], None), (7, "RH2M", stamps[0], 1.0)]
        obs = spark.createDataFrame(rows, "site_id int, param string, obs_ts timestamp_ntz, value double")
        docs = R.export_responses(obs, ["site_id"], temporal)
        assert docs.count() == (2 if temporal == "daily" else 1)
        assert all('"properties"' in json.dumps(json.loads(r["body"])) for r in docs.collect())
        back = R.ingest_point(docs.withColumnRenamed("year", "response_id"))
        assert sorted((r["site_id"], r["param"], r["obs_ts"], r["value"]) for r in back.collect() if r["value"] is not None) == [
            (7, "RH2M", stamps[0], 1.0), (7, "T2M", stamps[0], 10.5)]
        assert back.where("value is null").count() == 1 and {r["temporal"] for r in back.collect()} == {temporal}


def test_odd_date_keys(spark):
    """Only keys a strict date parser takes are taken."""
    keys = ["20230101", "2023010123", "2023010124", "+2023010", "-2023010", " 0230101", "2023 101", "202301 1", "2023-1-1", "2023010a",
            "2023010 1", "202301011 ", "20230229", "20240229", "2023011", "202301010203", "00000101", "２０２３０１０１"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"] for r in df.where(R.date_key_timestamp(F.col("k")).isNotNull()).collect()}
    assert got - {"00000101"} == {"20230101", "2023010123", "20240229"}
    back = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' t").select(R.date_key(F.col("t")), R.date_key(F.col("t"), True)).first()
    assert tuple(back) == ("20240310", "2024031002")
