"""Streaming ingest of landed response files.

`stream_into_store` and `first_arrivals` are the exact paths: each micro-batch is
appended keep-first, and a batch replayed after a failure adds nothing.
`drop_repeats` is the light path for consumers of the stream itself.

A request manifest (one row per response: `response_id` and, as far as known, `resolution`,
`http_status`, `elevation`, `wind_elevation`, `wind_surface`) may land before or after the bodies.
Bodies that it does not list yet wait in a folder of their own and are tried again with every batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridclimate.functions.dates import clock_micros
from gridclimate.functions.grid import variant_of, with_cell
from gridclimate.sources.files import matching, remove
from gridclimate.sources.responses import point_outcomes
from gridclimate.sources.store import ROW_KEY, ObservationStore

#: What a manifest may say of a response, beside its `response_id`.
MANIFEST = {"resolution": "string", "http_status": "int", "elevation": "double", "wind_elevation": "double", "wind_surface": "string"}
#: Responses that may land within one millisecond and still be ranked by name.
SAME_INSTANT = 1 << 22

Manifest = Callable[[], DataFrame]


def response_stream(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """Stream of landed bodies, one document per file.

    The file name is taken here: it is not available inside `foreachBatch`.
    """
    return (spark.readStream.format("text").option("wholetext", True)
            .option("maxFilesPerTrigger", max_files).load(path)
            .select(F.col("_metadata.file_path").alias("response_id"), F.col("value").alias("body"),
                    F.unix_micros("_metadata.file_modification_time").alias("landed")))


def checkpoint_path(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """Folder for a stream's checkpoint, under the cluster's shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not base:
        raise ValueError("set spark.checkpoint.dir or pass a shared folder")
    return f"{base.rstrip('/')}/{name}"


def arrival_order(bodies: DataFrame) -> DataFrame:
    """`response_id` and `arrival`, a number per response in the order of landing, then name.

    The file source cuts batches in the order of landing too, so whichever way the
    same files are cut, the same one comes first; only files of one and the same
    millisecond may be cut in another order than by name. Names are ranked within
    their millisecond alone, so no task sorts a whole batch.
    """
    seen = bodies.select("response_id", "landed").groupBy("response_id").agg(F.min("landed").alias("landed"))
    instant = F.floor(F.col("landed") / 1000)
    rank = F.row_number().over(Window.partitionBy("_ms").orderBy("response_id"))
    return seen.withColumn("_ms", instant).select("response_id", (F.col("_ms") * SAME_INSTANT + rank).cast("long").alias("arrival"))


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """One row per response of a manifest, absent columns as NULL; of conflicting rows the smallest."""
    known = [F.col(c).cast(kind).alias(c) if c in manifest.columns else F.lit(None).cast(kind).alias(c) for c, kind in MANIFEST.items()]
    one = manifest.where("response_id is not null").select("response_id", F.struct(*known).alias("_m")).groupBy("response_id").agg(F.min("_m").alias("_m"))
    return one.select("response_id", "_m.*")


def store_rows(outcomes: DataFrame) -> DataFrame:
    """Usable outcomes as store rows; cell and variant come from the body's place and the request's options."""
    options = [F.col(c) if c in outcomes.columns else F.lit(None).cast(MANIFEST[c]) for c in ("elevation", "wind_elevation", "wind_surface")]
    placed = with_cell(outcomes.where("reason is null"))
    return placed.withColumn("variant", variant_of(*options)).select(*ROW_KEY, "value", "response_id")


def _generations(spark: SparkSession, folder: str) -> dict[tuple[int, int], str]:
    """Finished lists of waiting bodies, by batch and try."""
    found = {}
    for path in matching(spark, f"{folder}/batch-*-try-*/_SUCCESS"):
        cut = re.search(r"batch-(\d+)-try-(\d+)/_SUCCESS$", path)
        found[int(cut[1]), int(cut[2])] = path.rpartition("/")[0]
    return found


def _settle(bodies: DataFrame, store: ObservationStore, rejects: str, manifest: Manifest | None, waiting: str) -> None:
    """Put what can be used into the store, what cannot into `rejects`, what the manifest does not list into `waiting`.

    Each target is overwritten or idempotent, so a call that failed can be made again.
    """
    ranked = "landed" in bodies.columns
    if manifest is not None:
        listed = manifest_rows(manifest()).withColumn("_listed", F.lit(True))
        met = bodies.join(listed, "response_id", "left")
        met.where("_listed is null").select(*bodies.columns).write.mode("overwrite").parquet(waiting)
        bodies = met.where("_listed").drop("_listed")
    # One parse serves both targets; a lost executor only means parsing its part again.
    outcomes = point_outcomes(bodies.drop("landed"), place=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        outcomes.where("reason is not null").select("response_id", "param", "date_key", "reason").write.mode("overwrite").parquet(rejects)
        rows = store_rows(outcomes)
        if ranked:
            rows = rows.join(arrival_order(bodies), "response_id").drop("response_id")
        store.append(rows, order="arrival" if ranked else "response_id")
    finally:
        outcomes.unpersist()


def stream_into_store(stream: DataFrame, store: ObservationStore, checkpoint: str, rejects: str | None = None,
                      manifest: Manifest | None = None) -> StreamingQuery:
    """Append everything that has landed, then stop. What landed earlier wins, by name where it landed together.

    What cannot be used goes to the folder `rejects`, beside the store if none is
    named. Each batch overwrites its own subfolder there, so a replayed batch
    leaves no second copy. A stream without `landed` is ordered by `response_id`.

    `manifest` returns the request manifest as it stands, read anew for every batch. It gives each
    response its HTTP status, its resolution and the options that make its variant. Bodies it does not
    list wait beside the checkpoint and are tried again with the next batch, or by `retry_waiting`;
    among rows of one key those that came out of waiting are later than those stored before.
    """
    folder, spark = (rejects or f"{store.path}-rejects").rstrip("/"), store.spark
    pending = f"{checkpoint.rstrip('/')}-waiting"

    def write(batch: DataFrame, epoch: int) -> None:
        before = {k: v for k, v in _generations(spark, pending).items() if k[0] < epoch}
        if before:
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(before[max(before)]))
        _settle(batch, store, f"{folder}/batch={epoch}", manifest, f"{pending}/batch-{epoch}-try-0")
        # The list read just now stays, for a replay of this batch; those before it are done with.
        for old in sorted(before)[:-1]:
            remove(spark, before[old])

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def retry_waiting(store: ObservationStore, checkpoint: str, manifest: Manifest, rejects: str | None = None) -> int:
    """Try the waiting bodies again while no batch is at work; returns how many still wait."""
    spark, pending = store.spark, f"{checkpoint.rstrip('/')}-waiting"
    lists = _generations(spark, pending)
    if not lists:
        return 0
    batch, turn = max(lists)
    folder = (rejects or f"{store.path}-rejects").rstrip("/")
    left = f"{pending}/batch-{batch}-try-{turn + 1}"
    _settle(spark.read.parquet(lists[batch, turn]), store, f"{folder}/batch={batch}-{turn + 1}", manifest, left)
    return spark.read.parquet(left).count()


#: Hash buckets of the keys of a day, and days of a batch that are named one by one.
ARRIVAL_BUCKETS, MANY_DAYS = 8, 1000


def first_arrivals(stream: DataFrame, keys: list[str], path: str, checkpoint: str, day: str | None = None) -> StreamingQuery:
    """Write each key once, when it first arrives, however late; then stop.

    The keys written so far are the state, so none is forgotten and a replayed batch adds nothing.
    They lie in folders by the day of the key column `day` (all in one without it) and by a hash of the whole key. A batch
    reads only the folders that its own keys belong to, so its cost follows what it brings, not what was ever written.
    """
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.select(*keys).schema.fields)
    kinds = f"{plain}, key_day date, key_bucket int"

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        of_day = F.col(day).cast("date") if day else F.lit(None).cast("date")
        new = batch.select(*keys).distinct().withColumns({
            "key_day": F.coalesce(of_day, F.lit("1970-01-01").cast("date")), "key_bucket": F.pmod(F.xxhash64(*keys), F.lit(ARRIVAL_BUCKETS)).cast("int")})
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = new
            held = held_arrivals(spark, path, kinds, new)
            if held is not None:
                same = [new[k].eqNullSafe(held[k]) for k in (*keys, "key_day", "key_bucket")]
                out = new.join(held, reduce(lambda a, b: a & b, same), "left_anti")
            (out.hint("rebalance", "key_day", "key_bucket").write.mode("append").partitionBy("key_day", "key_bucket").parquet(path))
        finally:
            new.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def held_arrivals(spark: SparkSession, path: str, kinds: str, new: DataFrame) -> DataFrame | None:
    """Keys written before, of the folders that `new` touches; nothing before the first write."""
    try:
        held = spark.read.schema(kinds).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    days = [r["key_day"] for r in new.select("key_day").distinct().limit(MANY_DAYS + 1).collect()]
    buckets = [r["key_bucket"] for r in new.select("key_bucket").distinct().collect()]  # ARRIVAL_BUCKETS at most
    if len(days) <= MANY_DAYS:
        held = held.where(F.col("key_day").isin(days))
    return held.where(F.col("key_bucket").isin(buckets))


def drop_repeats(rows: DataFrame, keys: list[str], stamp: str, delay: str) -> DataFrame:
    """Keep the first arrival per key inside the stream; state is dropped once the watermark passes.

    A light helper: keys that arrive later than the delay are dropped. `first_arrivals` keeps them.
    A watermark needs a zoned stamp, so a naive one is read as UTC on the side.
    """
    instant = F.timestamp_micros(clock_micros(F.col(stamp), rows.schema[stamp].dataType))
    return (rows.withColumn("_event_time", instant).withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(keys).drop("_event_time"))
