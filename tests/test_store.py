import datetime as dt
import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from gridclimate.operators import requests as req
from gridclimate.operators.merge import keep_first, merge_keep_first, union_columns
from gridclimate.sources.sinks import resolve_format, write_result
from gridclimate.plans import points
from gridclimate.sources.files import remove, touch
from gridclimate.sources.responses import point_outcomes, quarantine, read_responses
from gridclimate.sources.store import ObservationStore, coverage, upsert
from gridclimate.streaming.ingest import (
    checkpoint_path, drop_repeats, first_arrivals, held_arrivals, response_stream, retry_waiting, stream_into_store)

D = dt.datetime
SCHEMA = "temporal string, param string, cell_lat int, cell_lon int, variant string, obs_ts timestamp_ntz, value double, rank long"


def rows(spark, *items):
    return spark.createDataFrame([("daily", p, la, lo, "base", ts, v, i) for i, (p, la, lo, ts, v) in enumerate(items)], SCHEMA)


def content(store, **kw):
    return sorted(((r["param"], r["cell_lat"], r["obs_ts"], r["value"]) for r in store.read(**kw).collect()), key=str)


def test_append_is_keep_first_and_idempotent(spark, shared):
    store = ObservationStore(spark, shared + "/obs")
    assert store.read().count() == 0 and store.stats().first()["total_size"] == "0.00 B"
    first = rows(spark, ("T2M", 1, 2, D(2023, 1, 1), 5.0), ("T2M", 1, 2, D(2023, 1, 1), 6.0), ("T2M", 1, 2, D(2023, 1, 2), None))
    store.append(first, order="rank", seq=1)
    store.append(first, order="rank", seq=2)
    store.append(rows(spark, ("T2M", 1, 2, D(2023, 1, 2), 9.0), ("T2M", 1, 2, D(2024, 1, 3), 7.0), ("RH2M", 1, 2, D(2023, 1, 1), 50.0)), order="rank", seq=3)
    assert content(store) == sorted([("T2M", 1, D(2023, 1, 1), 5.0), ("T2M", 1, D(2023, 1, 2), None),
                                     ("T2M", 1, D(2024, 1, 3), 7.0), ("RH2M", 1, D(2023, 1, 1), 50.0)], key=str)
    assert content(store, params=["T2M"], start="2023-01-02", end="2023-12-31") == [("T2M", 1, D(2023, 1, 2), None)]
    cover = {r["param"]: (r["held_min"], r["held_max"], r["held_rows"]) for r in store.coverage().collect()}
    assert cover["T2M"] == (D(2023, 1, 1), D(2024, 1, 3), 3)
    stats = store.stats().first()
    assert (stats["entries"], stats["row_count"], stats["oldest"]) == (2, 4, D(2023, 1, 1))
    assert stats["total_bytes"] > 0 and stats["total_size"].endswith("iB")
    store.append(first.where("1 = 0"), order="rank")


def test_fill_null(spark, shared):
    store = ObservationStore(spark, shared + "/obs", on_conflict="fill_null")
    store.append(rows(spark, ("T2M", 1, 2, D(2023, 1, 1), None), ("T2M", 1, 2, D(2023, 1, 2), 2.0)), order="rank", seq=1)
    store.append(rows(spark, ("T2M", 1, 2, D(2023, 1, 1), None), ("T2M", 1, 2, D(2023, 1, 1), 4.0), ("T2M", 1, 2, D(2023, 1, 2), 9.0)), order="rank", seq=2)
    store.append(rows(spark, ("T2M", 1, 2, D(2023, 1, 1), 8.0)), order="rank", seq=3)
    assert content(store) == [("T2M", 1, D(2023, 1, 1), 4.0), ("T2M", 1, D(2023, 1, 2), 2.0)]
    with pytest.raises(ValueError):
        ObservationStore(spark, shared, on_conflict="other")


def test_store_pruning(spark, shared):
    store = ObservationStore(spark, shared + "/obs")
    store.append(rows(spark, *[("T2M", i, i, D(2020 + i, 1, 1), 1.0) for i in range(4)], ("RH2M", 1, 1, D(2021, 1, 1), 1.0)), order="rank")
    plan = store.read("daily", ["T2M"], "2021-01-01", "2022-06-30")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "param" in scan.split("PartitionFilters")[1] and "year" in scan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(obs_ts" in scan


def test_merge_order(spark):
    schema = "k int, obs_ts timestamp_ntz, seq long, value double"
    held = spark.createDataFrame([(1, D(2023, 1, 2), 5, None)], schema)
    one = spark.createDataFrame([(1, D(2023, 1, 1), 2, 25.0), (1, D(2023, 1, 1), 1, 24.0), (1, D(2023, 1, 2), 0, 1.0)], schema)
    two = spark.createDataFrame([(1, D(2023, 1, 1), 0, 99.0), (1, D(2023, 1, 3), 9, 27.0)], schema)
    out = merge_keep_first([held, one, two], ["k", "obs_ts"], "seq").orderBy("obs_ts").collect()
    assert [(r["obs_ts"].day, r["value"], r["source"]) for r in out] == [(1, 24.0, 1), (2, None, 0), (3, 27.0, 2)]
    assert keep_first(one, ["k", "obs_ts"], "seq").count() == 2
    both = upsert(held, one, ["k", "obs_ts"], "seq")
    assert both.count() == 2


def test_union_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, T2M double")
    b = spark.createDataFrame([(2, 3.0)], "k int, RH2M double")
    assert sorted(map(tuple, union_columns(a, b).collect()), key=str) == [(1, 2.0, None), (2, None, 3.0)]


def test_sinks(spark, tmp_path):
    assert resolve_format("x") == "csv" and resolve_format("x", "JSON") == "json" and resolve_format("x.pq") == "parquet"
    with pytest.warns(UserWarning):
        assert resolve_format("x.parquet", "csv") == "parquet"
    with pytest.raises(ValueError):
        resolve_format("x", "xlsx")
    df = spark.createDataFrame([(D(2023, 1, 1), None, 2.5)], "date timestamp_ntz, name string, T2M double")
    assert write_result(df, str(tmp_path / "o.json")) == "json"

    def written(folder):
        return "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / folder / "part-*"))))

    text = written("o.json")
    assert json.loads(text) == {"date": "2023-01-01T00:00:00.000", "name": None, "T2M": 2.5}
    assert write_result(df, str(tmp_path / "o.csv")) == "csv"
    assert written("o.csv").startswith("date,name,T2M\n")
    assert write_result(df, str(tmp_path / "o"), "parquet") == "parquet"
    assert spark.read.parquet(str(tmp_path / "o")).first()["T2M"] == 2.5
    many = spark.range(100).select((99 - F.col("id")).alias("n"))
    write_result(many, str(tmp_path / "s.csv"), order_by=["n"])
    assert [line for line in written("s.csv").split() if line != "n"] == [str(i) for i in range(100)]


def landed(value, day="20230101", lat=10.0, lon=20.0):
    return json.dumps({"properties": {"parameter": {"T2M": {day: value}}}, "geometry": {"coordinates": [lon, lat]}})


def test_stream_ingest_twice(spark, shared, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.json").write_text(landed(-999))
    (inbox / "b.json").write_text(landed(2.0))
    (inbox / "bad.json").write_text("{")
    store = ObservationStore(spark, shared + "/obs")
    check = shared + "/ingest"

    (inbox / "nowhere.json").write_text(json.dumps({"properties": {"parameter": {"T2M": {"20230101": 1.0}}}}))
    (inbox / "odd.json").write_text(landed(1.0, "202301"))

    def run(folder):
        stream_into_store(response_stream(spark, str(inbox)), store, folder, folder + "-rejects").awaitTermination()

    run(check)
    assert content(store) == [("T2M", 200, D(2023, 1, 1), None)]
    rejects = {r["response_id"].split("/")[-1]: r["reason"] for r in spark.read.parquet(check + "-rejects").collect()}
    assert rejects == {"bad.json": "not JSON", "nowhere.json": "no coordinates", "odd.json": "unrecognised date key"}
    (inbox / "c.json").write_text(landed(3.0))
    (inbox / "d.json").write_text(landed(4.0, "20230102"))
    run(check)
    want = [("T2M", 200, D(2023, 1, 1), None), ("T2M", 200, D(2023, 1, 2), 4.0)]
    assert content(store) == want
    # A lost checkpoint delivers every file again and still changes nothing.
    run(shared + "/ingest_again")
    assert content(store) == want


def test_batches_do_not_change_the_store(spark, shared, tmp_path):
    """What landed first wins however the files are cut into batches, and bad bodies never enter."""
    import os

    inbox = tmp_path / "cuts"
    inbox.mkdir()
    off_globe = [(95.0, 20.0), (-95.0, 20.0), (10.0, 700.0), (None, None)]
    texts = [("z", landed(1.0)), ("y", landed(2.0)), ("x", landed(3.0, "20230102")), ("w", landed(4.0, "20230102"))]
    texts += [(f"bad{i}", landed(9.0, lat=lat, lon=lon)) for i, (lat, lon) in enumerate(off_globe)] + [("said", json.dumps({"messages": ["no such place"]}))]
    for i, (name, text) in enumerate(texts):
        (inbox / f"{name}.json").write_text(text)
        os.utime(inbox / f"{name}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # names run against time
    for cut in (1, 2, 100):
        store = ObservationStore(spark, f"{shared}/cut{cut}")
        for turn in range(2):  # the second delivery adds nothing
            stream_into_store(response_stream(spark, str(inbox), cut), store, f"{shared}/check{cut}-{turn}").awaitTermination()
            assert content(store) == [("T2M", 200, D(2023, 1, 1), 1.0), ("T2M", 200, D(2023, 1, 2), 3.0)]
        rejected = [r["reason"] for r in spark.read.parquet(f"{shared}/cut{cut}-rejects").collect()]
        assert sorted(set(rejected)) == ["coordinates out of range", "no coordinates", "no such place"]


def test_append_refuses_rows_without_a_key(spark, shared):
    rows = spark.createDataFrame([("daily", "T2M", None, 1, "base", D(2023, 1, 1), 1.0, 1)],
                                 "temporal string, param string, cell_lat int, cell_lon int, variant string, obs_ts timestamp_ntz, value double, seq long")
    with pytest.raises(ValueError):
        ObservationStore(spark, shared + "/holes").append(rows, order="seq")


def test_late_first_arrivals_stay(spark, shared, tmp_path):
    inbox = str(tmp_path / "late")
    days = [10, 11, 12, 13, 1, 13]  # the fifth file is older than all before it
    for day in days:
        spark.createDataFrame([(1, D(2023, 1, day))], "k int, obs_ts timestamp_ntz").coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema("k int, obs_ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(inbox)
    for check in ("a", "b"):  # a lost checkpoint repeats nothing
        first_arrivals(stream, ["k", "obs_ts"], shared + "/first", f"{shared}/{check}").awaitTermination()
    assert sorted(r["obs_ts"].day for r in spark.read.parquet(shared + "/first").collect()) == sorted(set(days))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_drop_repeats(spark, tmp_path, kind):
    inbox = tmp_path / "in"
    schema = f"k int, obs_ts {kind}, value double"
    for i, batch in enumerate([[(1, D(2023, 1, 1), 1.0), (2, D(2023, 1, 1), 2.0)], [(1, D(2023, 1, 1), 3.0), (1, D(2023, 1, 2), 4.0)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema(schema).parquet(str(inbox))
        q = (drop_repeats(stream, ["k", "obs_ts"], "obs_ts", "3 days").writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r["k"], r["obs_ts"].day, r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 1, 1.0), (1, 2, 4.0), (2, 1, 2.0)]


def test_checkpoint_path(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert checkpoint_path(spark, "x") == base.rstrip("/") + "/x"
    else:
        assert checkpoint_path(spark, "x", "/shared/") == "/shared/x"
        with pytest.raises(ValueError):
            checkpoint_path(spark, "x")


def covered(df):
    return sorted(map(tuple, df.select("param", "cell_lat", "held_min", "held_max", "held_rows").collect()))


@pytest.mark.parametrize("rule", ["keep_first", "fill_null"])
def test_coverage_follows_the_appends(spark, shared, rule):
    """After overlapping appends, a lost one and a fold, coverage equals a scan of the whole store."""
    store = ObservationStore(spark, shared + "/obs", on_conflict=rule)

    def append(seq, *items):
        store.append(rows(spark, *items), order="rank", seq=seq)
        assert covered(store.coverage()) == covered(coverage(store.read()))

    append(1, ("T2M", 1, 2, D(2023, 1, 2), None), ("T2M", 1, 2, D(2023, 1, 3), 1.0), ("PS", 5, 2, D(2023, 1, 3), 1.0))
    append(2, ("T2M", 1, 2, D(2023, 1, 2), 4.0), ("T2M", 1, 2, D(2022, 12, 31), 4.0))  # fills a NULL, goes back a year
    append(3, ("T2M", 1, 2, D(2023, 1, 2), 5.0), ("PS", 5, 2, D(2023, 1, 3), 2.0))  # nothing new
    store.fold()
    append(4, ("PS", 5, 2, D(2023, 1, 9), 2.0), ("RH2M", 300, 500, D(2023, 1, 9), 2.0))
    # an append that was lost after its rows were written and before they were counted
    remove(spark, f"{store.ledger}/delta-4")
    touch(spark, f"{store.ledger}/_open-4")
    assert covered(store.coverage()) != covered(coverage(store.read()))
    append(5, ("T2M", 1, 2, D(2024, 2, 1), 4.0))
    assert glob.glob(f"{store.ledger}/_open-*") == []
    store.fold()
    store.fold()
    append(6, ("T2M", 1, 2, D(2024, 2, 2), 4.0))
    store.fold()
    assert covered(store.coverage()) == covered(coverage(store.read()))
    assert [p for p in glob.glob(f"{store.ledger}/*") if "delta-1" in p] == []  # merged two folds ago
    # a fold lost before its marker is not read
    rows(spark, ("T2M", 9, 9, D(2023, 1, 1), 1.0)).selectExpr("temporal", "param", "cell_lat", "cell_lon", "variant", "obs_ts as held_min", "obs_ts as held_max",
                                                             "1L as held_rows").write.parquet(f"{store.ledger}/fold-99")
    assert covered(store.coverage()) == covered(coverage(store.read()))
    assert store.coverage(["param"]).where("param = 'T2M'").first()["held_rows"] == 5
    assert store.stats().first()["row_count"] == store.read().count()


@pytest.mark.parametrize("rule", ["keep_first", "fill_null"])
def test_compaction_keeps_rows_and_survives_a_loss(spark, shared, rule):
    store = ObservationStore(spark, shared + "/obs", on_conflict=rule)
    for seq in range(1, 6):
        store.append(rows(spark, *[("T2M", la, 2, D(2023, 1, seq), None if la == 5 else float(la)) for la in (5, 300)],
                          ("T2M", 5, 2, D(2023, 1, 1), 7.0), ("PS", 5, 2, D(2022, 1, seq), 1.0)), order="rank", seq=seq)
    whole, figures = content(store), covered(store.coverage())
    files = store.files().count()
    # a run lost midway: part of the next snapshot is written, no marker
    half = shared + "/obs/temporal=daily/param=T2M/year=2023"
    spark.read.parquet(f"{half}/snapshot=0").limit(3).write.partitionBy("tile").parquet(f"{half}/snapshot=1")
    assert content(store) == whole and store.files().count() == files
    assert store.compact() == 2
    assert content(store) == whole and covered(store.coverage()) == figures
    assert store.files().count() == 3 < files
    assert store.compact() == 0
    # appends go to the live snapshot, see what was compacted, and can be compacted again
    store.append(rows(spark, ("T2M", 5, 2, D(2023, 1, 1), 9.0), ("T2M", 5, 2, D(2023, 1, 9), 9.0)), order="rank", seq=7)
    after = content(store)
    assert len(after) == len(whole) + 1 and store.files().count() == 4
    assert store.compact(params=["PS"]) == 0 and store.compact(temporal="daily", params=["T2M"]) == 1
    assert content(store) == after and store.files().count() == 3
    assert not glob.glob(f"{half}/snapshot=0")  # gone with the compaction after next
    assert covered(store.coverage()) == covered(coverage(store.read()))


def test_odd_names_are_shelves_too(spark, shared):
    store = ObservationStore(spark, shared + "/obs")
    store.append(rows(spark, ("A b+c/d=1%", 1, 2, D(2023, 1, 1), 1.0), ("007", 1, 2, D(2023, 1, 1), 2.0)), order="rank", seq=1)
    store.append(rows(spark, ("A b+c/d=1%", 1, 2, D(2023, 1, 2), 3.0), ("007", 1, 2, D(2023, 1, 1), 5.0)), order="rank", seq=2)
    assert store.compact() == 1
    assert [(r[0], r[3]) for r in content(store)] == [("007", 2.0), ("A b+c/d=1%", 1.0), ("A b+c/d=1%", 3.0)]
    assert {r["param"] for r in store.files().collect()} == {"007", "A b+c/d=1%"} and store.read("daily", ["007"]).count() == 1


def test_manifest_before_and_after_the_bodies(spark, shared, tmp_path):
    """Options, resolution and status come from the manifest; what it does not list yet waits."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i, name in enumerate(["high", "plain", "late", "refused", "hours"]):
        (inbox / f"{name}.json").write_text(landed(float(i), lat=10.0 + i))

    def named(path):
        return read_responses(spark, str(path)).first()["response_id"]

    names = {p.name.split(".")[0]: named(p) for p in inbox.iterdir()}
    schema = "response_id string, elevation double, resolution string, http_status int"
    lines = {"high": (names["high"], 120.0, "daily", 200), "plain": (names["plain"], None, None, None), "refused": (names["refused"], None, "daily", 422),
             "hours": (names["hours"], None, "hourly", 200), "late": (names["late"], 80.5, "daily", 200)}
    known = ["high", "plain", "refused"]
    store, check = ObservationStore(spark, shared + "/obs"), shared + "/ck"

    def manifest():
        return spark.createDataFrame([lines[k] for k in known] * 2, schema)  # listed twice

    def run(cut=2):
        stream_into_store(response_stream(spark, str(inbox), cut), store, check, manifest=manifest).awaitTermination()

    def variants():
        return sorted((r["variant"], r["value"]) for r in store.read().collect())

    def reasons():
        return {r["response_id"].split("/")[-1]: r["reason"] for r in spark.read.parquet(store.path + "-rejects").collect()}

    run()
    assert variants() == [("base", 1.0), ("elev=120.0", 0.0)] and reasons() == {"refused.json": "HTTP 422"}
    assert retry_waiting(store, check, manifest) == 2  # nothing new is known
    known.append("late")
    (inbox / "more.json").write_text(landed(9.0, "20230105"))
    lines["more"] = (named(inbox / "more.json"), 120.0, "daily", 200)
    known.append("more")
    run()  # the next batch takes along what waited
    assert variants() == [("base", 1.0), ("elev=120.0", 0.0), ("elev=120.0", 9.0), ("elev=80.5", 2.0)]
    known.append("hours")
    assert retry_waiting(store, check, manifest) == 0 and retry_waiting(store, check, manifest) == 0
    assert reasons() == {"refused.json": "HTTP 422", "hours.json": "date key of another resolution"}
    before = variants()
    check = shared + "/again"  # a lost checkpoint delivers everything once more
    run(1)
    assert variants() == before
    sites = spark.createDataFrame([(1, 10.0, 20.0, "a", 120.0), (2, 10.0, 20.0, "b", None), (3, 12.0, 20.0, "c", 80.5)], "site_id long, lat double, lon double, name string, elevation double")
    found = points.multi_point(store.read(), sites, "2023-01-01", "2023-01-05", ["T2M"])
    assert sorted((r["site_id"], r["T2M"]) for r in found.collect()) == [(1, 0.0), (1, 9.0), (3, 2.0)]


def test_one_parse_serves_rows_and_rejects(spark):
    bodies = [("good", landed(1.0)), ("bad", "{"), ("odd", landed(1.0, "2023")), ("empty", json.dumps({"properties": {"parameter": {}}, "geometry": {"coordinates": [1, 2]}})),
              ("lost", json.dumps({"properties": {"parameter": {"T2M": {"20230101": 1}}}}))]
    df = spark.createDataFrame(bodies, "response_id string, body string")
    out = point_outcomes(df, place=True)
    assert out._jdf.queryExecution().executedPlan().toString().count("from_json(StructField(properties") == 1
    got = {r["response_id"]: (r["param"], r["value"], r["reason"]) for r in out.collect()}
    assert got == {"good": ("T2M", 1.0, None), "bad": (None, None, "not JSON"), "odd": ("T2M", 1.0, "unrecognised date key"), "lost": (None, None, "no coordinates")}
    kept = {tuple(r) for r in quarantine(df, place=True).collect()}
    assert kept == {tuple(r) for r in out.where("reason is not null").select("response_id", "param", "date_key", "reason").collect()}


def test_arrivals_read_only_their_folders(spark, shared, tmp_path):
    inbox, out = str(tmp_path / "days"), shared + "/first"
    schema = "k int, obs_ts timestamp_ntz"
    for day in (10, 11, 12, 13):
        spark.createDataFrame([(k, D(2023, 1, day)) for k in range(20)], schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    for check in "ab":
        first_arrivals(stream, ["k", "obs_ts"], out, f"{shared}/{check}", day="obs_ts").awaitTermination()
    assert spark.read.parquet(out).count() == 80
    new = spark.createDataFrame([(1, D(2023, 1, 12), dt.date(2023, 1, 12), 3)], schema + ", key_day date, key_bucket int")
    held = held_arrivals(spark, out, schema + ", key_day date, key_bucket int", new)
    scan = next(x for x in held._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    filters = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "key_day" in filters and "key_bucket" in filters
    assert all("key_day=2023-01-12/key_bucket=3" in r[0] for r in held.select(F.col("_metadata.file_path")).collect())


def test_gaps_and_holes_against_a_calendar(spark):
    """Long and short histories of days and hours against sets of stamps, blocks crossed and keys uneven."""
    r = random.Random(11)
    start = {"daily": D(2019, 1, 1), "hourly": D(2022, 11, 1)}
    step = {"daily": dt.timedelta(days=1), "hourly": dt.timedelta(hours=1)}
    held = {}
    for key, temporal, n, share in (("hot", "daily", 2000, 0.9), ("thin", "daily", 900, 0.02), ("hours", "hourly", 4000, 0.95), ("one", "daily", 40, 0.03), ("full", "daily", 500, 1.0)):
        held[key, temporal] = sorted(start[temporal] + i * step[temporal] for i in range(n) if r.random() < share)
    obs = spark.createDataFrame([(k, t, ts, v) for (k, t), stamps in held.items() for ts in stamps for v in (1.0, None)], "param string, temporal string, obs_ts timestamp_ntz, value double")
    asks = []
    for i in range(60):
        key, temporal = r.choice([*held, ("never", "daily")])
        s = start[temporal] + dt.timedelta(days=r.randint(-40, 2100 if temporal == "daily" else 200))
        asks.append((i, key, temporal, s, s + dt.timedelta(days=r.randint(-2, 800 if temporal == "daily" else 60))))
    df = spark.createDataFrame(asks, "id int, param string, temporal string, start_date timestamp_ntz, end_date timestamp_ntz")
    got = {}
    for x in req.fetch_holes(df, obs, ["param", "temporal"]).collect():
        got.setdefault(x["id"], []).append((x["range_start"], x["range_end"]))
    for i, key, temporal, s, e in asks:
        have, at, want = set(held.get((key, temporal), [])), s, []
        last = e + dt.timedelta(hours=23) if temporal == "hourly" else e
        while at <= last:
            if at not in have:
                if want and want[-1][1] == at - step[temporal]:
                    want[-1] = (want[-1][0], at)
                else:
                    want.append((at, at))
            at += step[temporal]
        assert sorted(got.get(i, [])) == want, (i, key)


def test_stale_requests_get_their_held_rows(spark):
    schema = "id int, param string, temporal string, start_date timestamp_ntz, end_date timestamp_ntz, served_from string"
    asks = [(1, "T2M", "daily", D(2022, 12, 30), D(2023, 1, 2), "stale"), (2, "T2M", "daily", D(2023, 1, 1), D(2023, 1, 2), "error"),
            (3, "T2M", "hourly", D(2023, 1, 1), D(2023, 1, 1), "stale"), (4, "PS", "daily", D(2023, 1, 1), D(2023, 1, 2), "stale"),
            (5, "T2M", "daily", D(2023, 1, 2), D(2023, 1, 1), "stale")]
    obs = [("T2M", "daily", D(2022, 12, 29) + dt.timedelta(days=i), float(i)) for i in range(8)] + [("T2M", "hourly", D(2023, 1, 1, h), None) for h in range(24)]
    history = spark.createDataFrame(obs, "param string, temporal string, obs_ts timestamp_ntz, value double")
    got = req.stale_rows(spark.createDataFrame(asks, schema), history, ["param", "temporal"]).collect()
    assert sorted((r["id"], r["value"]) for r in got if r["id"] == 1) == [(1, 1.0), (1, 2.0), (1, 3.0), (1, 4.0)]
    assert sum(r["id"] == 3 for r in got) == 24 and {r["id"] for r in got} == {1, 3}
