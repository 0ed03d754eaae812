"""Streaming jobs over the driver's tables, run to the end of what has landed.

They write a store, so they need the folder the cluster shares. Each run takes
a new subfolder: the store and the stream's checkpoint start empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.functions.grid import with_cell
from gridclimate.sources.responses import fill_to_null
from gridclimate.sources.store import ObservationStore
from gridclimate.streaming.ingest import first_arrivals as first_seen
from gridclimate.streaming.ingest import checkpoint_path, retry_waiting, stream_into_store
from gridclimate.workload import views as v


def run_folder(spark: SparkSession, name: str) -> str:
    """New folder under `spark.checkpoint.dir`, or, in a local session that names none, under the warehouse."""
    local = spark.sparkContext.master.startswith("local")
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}", spark.conf.get("spark.sql.warehouse.dir") if local else None)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream, as landed raw observations."""
    schema = v.table(spark, sf_dir, "events").schema
    # A pattern, because a plain path must be a folder and the table may be one file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return spark.sql(v.SQL["v_obs_raw"], events=events)


def body_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed point response per event, with the site's coordinates in the body; a later event landed later."""
    sites = v.view(spark, sf_dir, "v_points").select("site_id", "lat", "lon")
    raw = event_stream(spark, sf_dir).join(sites, "site_id")
    series = F.create_map(F.date_format("obs_date", "yyyyMMdd"), F.col("raw_value"))
    body = F.to_json(F.struct(F.struct(F.create_map("param", series).alias("parameter")).alias("properties"),
                              F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry")))
    return raw.select(F.col("seq").alias("response_id"), body.alias("body"), (F.col("seq") * 1000).alias("landed"))


def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store content after streaming every event body into an empty store."""
    folder = run_folder(spark, "ingest")
    store = ObservationStore(spark, folder + "/store")
    stream_into_store(body_stream(spark, sf_dir), store, folder + "/checkpoint").awaitTermination()
    return store.read()


def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was asked for with each body: the site's elevation, the resolution and the status of the answer."""
    sites = v.view(spark, sf_dir, "v_points").select("site_id", "lat", "elevation")
    raw = v.view(spark, sf_dir, "v_obs_raw").join(sites, "site_id")
    return raw.select(F.col("seq").alias("response_id"), "lat", "elevation", F.lit("daily").alias("resolution"), F.lit(200).alias("http_status"))


def ingest_requests(spark: SparkSession, sf_dir: str) -> ObservationStore:
    """Every event body streamed into an empty store under its request's options.

    The manifest of the northern sites is there from the start, that of the southern ones
    lands after the bodies, which wait for it.
    """
    folder = run_folder(spark, "requests")
    store, asked = ObservationStore(spark, folder + "/store"), request_manifest(spark, sf_dir)
    checkpoint = folder + "/checkpoint"
    stream_into_store(body_stream(spark, sf_dir), store, checkpoint, manifest=lambda: asked.where("lat >= 0")).awaitTermination()
    retry_waiting(store, checkpoint, lambda: asked)
    return store


def refused_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a stream whose manifest says that some answers were refused and some asked for hours."""
    folder = run_folder(spark, "refused")
    kind = F.col("response_id") % 6
    asked = request_manifest(spark, sf_dir).withColumns({
        "http_status": F.when(kind == 1, F.lit(422)).when(kind == 2, F.lit(500)).otherwise(F.col("http_status")),
        "resolution": F.when(kind == 3, F.lit("hourly")).otherwise(F.col("resolution"))})
    store = ObservationStore(spark, folder + "/store")
    stream_into_store(body_stream(spark, sf_dir), store, folder + "/checkpoint", folder + "/rejects", lambda: asked).awaitTermination()
    return spark.read.schema("response_id bigint, param string, date_key string, reason string").parquet(folder + "/rejects").drop("batch")


#: Quarters of the events that overlapping batches bring.
BATCHES = [[0], [0, 1], [1, 2], [2, 3]]


def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a store row, repeats included."""
    raw = v.view(spark, sf_dir, "v_obs_raw").join(v.view(spark, sf_dir, "v_points").select("site_id", "lat", "lon"), "site_id")
    return with_cell(raw).select(
        F.lit("daily").alias("temporal"), "param", "cell_lat", "cell_lon", F.lit("base").alias("variant"),
        F.col("obs_date").cast("timestamp_ntz").alias("obs_ts"), fill_to_null(F.col("raw_value")).alias("value"), "seq")


def append_quarters(spark: SparkSession, sf_dir: str, store: ObservationStore, batches: list[list[int]]) -> None:
    for part in batches:
        store.append(landed_rows(spark, sf_dir).where((F.col("seq") % 4).isin(part)), order="seq")


def appended_store(spark: SparkSession, sf_dir: str, turns: int = len(BATCHES)) -> ObservationStore:
    """A store after a number of overlapping batches of the events."""
    store = ObservationStore(spark, run_folder(spark, "append") + "/store")
    append_quarters(spark, sf_dir, store, BATCHES[:turns])
    return store


def stored_observations(spark: SparkSession, sf_dir: str) -> ObservationStore:
    """A store that all events were appended to at once."""
    store = ObservationStore(spark, run_folder(spark, "stored") + "/store")
    store.append(landed_rows(spark, sf_dir), order="seq")
    return store


def first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys left after dropping repeats inside the stream."""
    folder = run_folder(spark, "arrivals")
    keys = ["site_id", "param", "obs_date"]
    first_seen(event_stream(spark, sf_dir), keys, folder + "/out", folder + "/checkpoint", day="obs_date").awaitTermination()
    return spark.read.schema("site_id bigint, param string, obs_date date").parquet(folder + "/out")
