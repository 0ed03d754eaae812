"""Observation store: append-only Parquet, one row per key and stamp.

Layout: `temporal=…/param=…/year=…/snapshot=…/tile=…`, files sorted by cell and stamp. A
shelf is one resolution, parameter and year; of its snapshots one is live, number 0 unless
a marker `_live-<n>` beside them names a later one. A question lists only the shelves it
asks for, then prunes by tile, and row groups by cell and stamp. Appends are idempotent: a
batch written twice, or a job restarted after its write, adds nothing the second time. One
writer at a time is assumed; readers need no lock.

Beside the store, `<path>-coverage` holds what each append added per key (first and last stamp,
number of stamps), so coverage never scans the history.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclimate.functions.dates import iso_bound
from gridclimate.functions.grid import tile_of
from gridclimate.functions.text import format_bytes
from gridclimate.operators.merge import fill_null_merge, keep_first, new_rows
from gridclimate.sources.files import matching, remove, touch

KEY = ["temporal", "param", "cell_lat", "cell_lon", "variant"]
ROW_KEY = [*KEY, "obs_ts"]
STORE_SCHEMA = T.StructType([
    T.StructField("cell_lat", T.IntegerType()),
    T.StructField("cell_lon", T.IntegerType()),
    T.StructField("variant", T.StringType()),
    T.StructField("obs_ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("ingest_seq", T.LongType()),
    T.StructField("fills", T.BooleanType()),  # the stamp was held before, as NULL
    T.StructField("temporal", T.StringType()),
    T.StructField("param", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("snapshot", T.IntegerType()),
    T.StructField("tile", T.IntegerType()),
])
SHELF = ["temporal", "param", "year"]
PARTITIONS = [*SHELF, "snapshot", "tile"]
SORT = ["cell_lat", "cell_lon", "variant", "obs_ts"]
COVERAGE_SCHEMA = ("temporal string, param string, cell_lat int, cell_lon int, variant string,"
                   " held_min timestamp_ntz, held_max timestamp_ntz, held_rows bigint")
#: Shelves of a batch that are named one by one; a batch of more is cut by its years alone.
MANY_SHELVES = 4000
#: Coverage deltas that an append lets pile up before it folds them.
MANY_DELTAS = 64
#: Size that compaction packs a tile's files to.
FILE_BYTES = 128 << 20

Shelf = tuple[str, str, int]


def select_window(obs: DataFrame, temporal: str | None = None, params: list[str] | None = None,
                  start: datetime | str | None = None, end: datetime | str | None = None,
                  end_of_day: bool = False, tiles: list[int] | None = None) -> DataFrame:
    """Filter by resolution, parameters, tiles and an inclusive time window.

    Bounds are instants: a bare end date stops at its midnight unless
    `end_of_day` is set. When the table has a `year` column the window is also stated on it, and
    `tiles` where it has a `tile` column, so the scan lists only the partitions it needs.
    """
    if temporal:
        obs = obs.where(F.col("temporal") == temporal)
    if params:
        obs = obs.where(F.col("param").isin(list(params)))
    if tiles is not None and "tile" in obs.columns:
        obs = obs.where(F.col("tile").isin(tiles))
    for bound, low in ((start, True), (end, False)):
        if bound is None:
            continue
        text = iso_bound(bound)
        stamp = F.lit(text).cast("timestamp_ntz")
        if low:
            obs = obs.where(F.col("obs_ts") >= stamp)
        elif end_of_day and len(text) == 10:
            obs = obs.where(F.col("obs_ts") < stamp + F.expr("interval 24 hours"))
        else:
            obs = obs.where(F.col("obs_ts") <= stamp)
        if "year" in obs.columns:
            year = int(text[:4])
            obs = obs.where(F.col("year") >= year if low else F.col("year") <= year)
    return obs


def coverage(obs: DataFrame, keys: list[str] | None = None, stamp: str = "obs_ts") -> DataFrame:
    """First and last stamp held per key; rows with NULL values count as held."""
    return obs.groupBy(*(keys or KEY)).agg(
        F.min(stamp).alias("held_min"), F.max(stamp).alias("held_max"), F.count("*").alias("held_rows"))


def fold_coverage(parts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Coverage of several parts, or of coarser keys, from their coverages."""
    return parts.groupBy(*(keys or KEY)).agg(
        F.min("held_min").alias("held_min"), F.max("held_max").alias("held_max"), F.sum("held_rows").alias("held_rows"))


class ObservationStore:
    """Reads and appends observations under one path.

    `on_conflict='keep_first'` never replaces a held row, NULL or not.
    `on_conflict='fill_null'` also appends a value where only NULL is held, and
    reads resolve each key to its first non-NULL value.
    """

    def __init__(self, spark: SparkSession, path: str, on_conflict: str = "keep_first"):
        if on_conflict not in ("keep_first", "fill_null"):
            raise ValueError("on_conflict must be 'keep_first' or 'fill_null'")
        self.spark, self.path, self.on_conflict = spark, path.rstrip("/"), on_conflict
        self.ledger = f"{self.path}-coverage"

    # --- reading ----------------------------------------------------------------------

    def _shelves(self) -> dict[Shelf, tuple[str, int]]:
        """Folder and live snapshot of every shelf: folder names alone, no file is listed."""
        found: dict[Shelf, tuple[str, int]] = {}
        for entry in matching(self.spark, f"{self.path}/temporal=*/param=*/year=*/*"):
            folder, _, name = entry.rpartition("/")
            temporal, param, year = (unquote(part.partition("=")[2]) for part in folder.split("/")[-3:])
            marked = re.fullmatch(r"_live-(\d+)", name)
            if marked or name == "snapshot=0":
                key = (temporal, param, int(year))
                found[key] = folder, max(int(marked[1]) if marked else 0, found.get(key, (folder, 0))[1])
        return found

    def _files(self, shelves: dict[Shelf, tuple[str, int]]) -> DataFrame | None:
        """Live files of the shelves; nothing where there are none."""
        if not shelves:
            return None
        paths = [f"{folder}/snapshot={live}" for folder, live in shelves.values()]
        return self.spark.read.schema(STORE_SCHEMA).option("basePath", self.path).parquet(*paths)

    def _rows(self, shelves: dict[Shelf, tuple[str, int]]) -> DataFrame:
        stored = self._files(shelves)
        return self.spark.createDataFrame([], STORE_SCHEMA) if stored is None else stored

    def rows(self, temporal: str | None = None, params: Iterable[str] | None = None,
             first_year: int | None = None, last_year: int | None = None) -> DataFrame:
        """Stored rows as they are, of the shelves asked for; empty before the first append."""
        params = None if params is None else set(params)
        asked = {k: v for k, v in self._shelves().items()
                 if (temporal is None or k[0] == temporal) and (params is None or k[1] in params)
                 and (first_year is None or k[2] >= first_year) and (last_year is None or k[2] <= last_year)}
        return self._rows(asked).drop("snapshot")

    def read(self, temporal: str | None = None, params: list[str] | None = None,
             start: datetime | str | None = None, end: datetime | str | None = None,
             end_of_day: bool = False, tiles: list[int] | None = None) -> DataFrame:
        """Observations in a window, one row per key and stamp; `tiles` leaves the other tiles unread."""
        years = [None if b is None else int(iso_bound(b)[:4]) for b in (start, end)]
        held = select_window(self.rows(temporal, params, *years), temporal, params, start, end, end_of_day, tiles)
        if self.on_conflict == "fill_null":
            return fill_null_merge(held, [*ROW_KEY, "year", "tile"], "ingest_seq")
        return held.drop("fills")

    # --- appending ----------------------------------------------------------------------

    def append(self, batch: DataFrame, order: str = "ingest_seq", seq: int | None = None) -> None:
        """Add the rows of `batch` that are not held yet.

        `order` ranks repeats inside the batch. All rows written get the same
        `ingest_seq`, larger for later appends. A row without a whole key could
        never be found again, so it is refused.
        """
        seq = int(time.time() * 1e6) if seq is None else seq
        for name in matching(self.spark, f"{self.ledger}/_open-*"):  # an append that was lost between its rows and its coverage
            self._record(int(name.rpartition("-")[2]), self._shelves())
        first = fill_null_merge if self.on_conflict == "fill_null" else keep_first
        incoming = first(batch.select(*ROW_KEY, "value", order), ROW_KEY, order).drop(order).withColumns({
            "year": F.year("obs_ts"), "tile": tile_of(F.col("cell_lat"), F.col("cell_lon"), F.col("param"))})
        # Read several times below; a lost executor only means recomputing a part.
        incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            holes = F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ROW_KEY]))
            # as many tiles as the globe has, so the set is small
            span = incoming.agg(F.min("year").alias("low"), F.max("year").alias("high"), holes.alias("holes"), F.collect_set("tile").alias("tiles")).first()
            if span["holes"]:
                raise ValueError(f"{span['holes']} rows without a whole key")
            if span["low"] is None:
                return
            named = [tuple(r) for r in incoming.select(*SHELF).distinct().limit(MANY_SHELVES + 1).collect()]
            shelves = {k: v for k, v in self._shelves().items()
                       if (k in set(named) if len(named) <= MANY_SHELVES else span["low"] <= k[2] <= span["high"])}
            held = self._rows(shelves).where(F.col("tile").isin(span["tiles"]))
            out = self._fresh(incoming, held).withColumns({
                "ingest_seq": F.lit(seq).cast("bigint"), "snapshot": self._live_snapshot(shelves)})
            touch(self.spark, f"{self.ledger}/_open-{seq}")
            # Rebalance splits a partition that is too big for one file and joins
            # small ones; the sort gives tight row-group statistics.
            (out.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, *SORT)
             .write.mode("append").partitionBy(*PARTITIONS).parquet(self.path))
            written = {k: v for k, v in self._shelves().items() if len(named) > MANY_SHELVES or k in set(named)}
            self._record(seq, written)
        finally:
            incoming.unpersist()
        if len(self._deltas()) > MANY_DELTAS:
            self.fold()

    def _fresh(self, incoming: DataFrame, held: DataFrame) -> DataFrame:
        """Incoming rows to write, with `fills`. Both sides meet once, on the keys the batch mentions.

        The held side is first cut to these keys: the semi join streams the big side past the
        small one, so the store is neither built into a hash table nor, for a small batch, shuffled.
        """
        keys = incoming.select(*ROW_KEY)
        if self.on_conflict == "keep_first":
            touched = held.select(*ROW_KEY).join(keys, ROW_KEY, "left_semi")
            return incoming.join(touched, ROW_KEY, "left_anti").withColumn("fills", F.lit(False))
        touched = held.select(*ROW_KEY, "value").join(keys, ROW_KEY, "left_semi")
        known = touched.groupBy(*ROW_KEY).agg(F.max(F.col("value").isNotNull()).alias("_known"))
        met = incoming.join(known, ROW_KEY, "left").withColumn("fills", F.col("_known").isNotNull())
        return met.where("_known is null or (not _known and value is not null)").drop("_known")

    @staticmethod
    def _live_snapshot(shelves: dict[Shelf, tuple[str, int]]) -> Column:
        """Live snapshot of a row's shelf; 0 for a new shelf."""
        later = {"\x1f".join(map(str, k)): live for k, (_, live) in shelves.items() if live}
        if not later:
            return F.lit(0)
        named = F.create_map(*[F.lit(x) for pair in later.items() for x in pair])
        return F.coalesce(F.try_element_at(named, F.concat_ws("\x1f", *SHELF)), F.lit(0))

    # --- coverage -----------------------------------------------------------------------

    def _record(self, seq: int, shelves: dict[Shelf, tuple[str, int]]) -> None:
        """Write what an append added per key, from the rows it wrote, and close its marker.

        Row-group statistics of `ingest_seq` leave older files unread. Done again, it replaces itself.
        """
        own = self._rows(shelves).where(F.col("ingest_seq") == seq)
        added = own.groupBy(*KEY).agg(F.min("obs_ts").alias("held_min"), F.max("obs_ts").alias("held_max"),
                                      F.count_if(~F.col("fills")).alias("held_rows"))
        added.write.mode("overwrite").parquet(f"{self.ledger}/delta-{seq}")
        remove(self.spark, f"{self.ledger}/_open-{seq}")

    def _deltas(self) -> dict[int, str]:
        return {int(p.rpartition("-")[2]): p for p in matching(self.spark, f"{self.ledger}/delta-*")}

    def _folded(self) -> list[int]:
        """Finished folds, by the last append each holds."""
        return sorted(int(p.rpartition("-")[2]) for p in matching(self.spark, f"{self.ledger}/_live-*"))

    def coverage(self, keys: list[str] | None = None) -> DataFrame:
        """First and last stamp and number of stamps per key, from the last fold and the deltas after it."""
        folds, deltas = self._folded(), self._deltas()
        last = folds[-1] if folds else None
        paths = [f"{self.ledger}/fold-{last}"] if folds else []
        paths += [p for seq, p in sorted(deltas.items()) if last is None or seq > last]
        if not paths:  # nothing recorded: an empty store, or one whose ledger was taken away
            return coverage(self.read(), keys)
        return fold_coverage(self.spark.read.schema(COVERAGE_SCHEMA).parquet(*paths), keys)

    def fold(self) -> None:
        """Merge the coverage deltas into one table. What the fold before held is removed; a run lost midway changes nothing."""
        before, deltas = self._folded(), self._deltas()
        open_deltas = [s for s in deltas if not before or s > before[-1]]
        if not open_deltas:
            return
        last = max(open_deltas)
        self.coverage().write.mode("overwrite").parquet(f"{self.ledger}/fold-{last}")
        touch(self.spark, f"{self.ledger}/_live-{last}")
        if before:  # readers of the fold before may still be at work on the deltas merged now, so these stay till next time
            for seq in (s for s in deltas if s <= before[-1]):
                remove(self.spark, deltas[seq])
            for seq in before:
                remove(self.spark, f"{self.ledger}/_live-{seq}")
                remove(self.spark, f"{self.ledger}/fold-{seq}")

    # --- compaction ---------------------------------------------------------------------

    def files(self, shelves: dict[Shelf, tuple[str, int]] | None = None) -> DataFrame:
        """One row per live file: shelf, tile, path and bytes. No content is read."""
        shelves = self._shelves() if shelves is None else shelves
        schema = "temporal string, param string, year int, tile int, path string, length long"
        if not shelves:
            return self.spark.createDataFrame([], schema)
        paths = [f"{folder}/snapshot={live}" for folder, live in shelves.values()]
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(paths)

        def part(name: str) -> Column:  # a plus sign in a folder name is one
            return F.url_decode(F.replace(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))

        return listed.select(part("temporal").alias("temporal"), part("param").alias("param"), part("year").cast("int").alias("year"),
                             part("tile").cast("int").alias("tile"), "path", "length")

    def compact(self, temporal: str | None = None, params: list[str] | None = None, file_bytes: int = FILE_BYTES) -> int:
        """Rewrite the shelves whose files can be packed into fewer of about `file_bytes`; returns how many were.

        Rows of a shelf go to its next snapshot, range-cut by tile, cell and stamp, so the new files do not
        overlap; where NULLs were filled only the answer is kept. The marker that makes a snapshot live is written when all
        its files are; until then nobody reads it, and the next run clears it away. The snapshot
        before stays for readers at work and goes with the next compaction.
        """
        found = {k: v for k, v in self._shelves().items()
                 if (temporal is None or k[0] == temporal) and (params is None or k[1] in params)}
        for folder, live in found.values():
            for entry in matching(self.spark, f"{folder}/snapshot=*"):
                if int(entry.rpartition("=")[2]) != live:
                    remove(self.spark, entry)
            for entry in matching(self.spark, f"{folder}/_live-*"):
                if int(entry.rpartition("-")[2]) != live:
                    remove(self.spark, entry)
        packed = F.greatest(F.ceil(F.sum("length") / file_bytes), F.lit(1))
        tiles = self.files(found).groupBy(*SHELF, "tile").agg(F.count("*").alias("now"), packed.alias("then"), F.sum("length").alias("size"))
        worth = tiles.groupBy(*SHELF).agg(F.sum("now").alias("now"), F.sum("then").alias("then")).where("then < now").collect()  # a row per shelf
        chosen = {k: found[k] for k in ((r["temporal"], r["param"], r["year"]) for r in worth)}
        if not chosen:
            return 0
        rows = self._rows(chosen)
        if self.on_conflict == "fill_null":
            # the stamp counts once in the coverage, with the row that came first
            rows = fill_null_merge(rows, [*ROW_KEY, "year", "tile"], "ingest_seq").withColumn("fills", F.lit(False))
        upcoming = {k: (folder, live + 1) for k, (folder, live) in chosen.items()}
        rows = rows.drop("snapshot").withColumn("snapshot", self._live_snapshot(upcoming))
        (rows.repartitionByRange(int(sum(r["then"] for r in worth)), *PARTITIONS, *SORT).sortWithinPartitions(*PARTITIONS, *SORT)
         .write.mode("append").partitionBy(*PARTITIONS).parquet(self.path))
        for folder, live in upcoming.values():
            touch(self.spark, f"{folder}/_live-{live}")
        return len(upcoming)

    # --- figures ------------------------------------------------------------------------

    def stats(self) -> DataFrame:
        """One row: entries (keys), rows, oldest and newest stamp, file bytes and their display.

        Keys, rows and stamps come from the coverage, bytes from the file list; the history is not read.
        """
        held = self.coverage().agg(
            F.count("*").alias("entries"), F.coalesce(F.sum("held_rows"), F.lit(0)).alias("row_count"),
            F.min("held_min").alias("oldest"), F.max("held_max").alias("newest"))
        size = self.files().agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
        # Two single-row tables folded into one row.
        both = held.unionByName(size, allowMissingColumns=True)
        return (both.agg(*[F.max(c).alias(c) for c in ("entries", "row_count", "oldest", "newest", "total_bytes")])
                .withColumn("total_size", format_bytes(F.col("total_bytes"))))


def upsert(held: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Content of a keep-first store after adding `batch` to `held`."""
    fresh = new_rows(batch, held, keys, order)
    return held.unionByName(fresh.select(*held.columns))
