"""Training-order materialisation of token ids (operator 3).

Method: token ids of all documents, each closed by the end id, are laid end to end and
cut into sequences of a fixed length; the sequences of a task are stored once, and a
sequence's place among all stored rows is its index. A keyed Feistel permutation of
0 .. N-1, with cycle-walking, gives every index its global slot. Slot / records-per-shard
is the shard, and a shard is one partition: its task sorts the shard's records by slot and writes
them as one file of raw records of one stride (slot, number of ids, unsigned 16-bit ids, a closing byte).
Training order is the order of the bytes, so a reader resumes at slot s by opening the file of shard
s / per_shard (`part-<shard>-...`) at byte (s % per_shard) * stride. Nothing sorts again between the sort and
the file, so the places hold however often it spills; whoever reads a shard has them checked.

The shards are written by Spark's text sink, which writes bytes as they are, so files
appear only when their task has committed. The closing byte is that sink's line end.

Defined cases: a null or empty text is its end id; null ids are kept; repeated rows are
tokenised like any other; a text longer than a piece is a piece of its own; an empty table writes no shards; the last sequence of a task
is filled up with zeros, its number of ids says where; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, mapped, mix, shared_folder, small_side, stored, use_package
from gridclimate.llm.tokens import default_path, token_pieces

LENGTH = 2048
PER_SHARD = 4096
HEAD = 12
ROUNDS = 6
#: Sequences handed on together, and written files whose first indices every task is sent.
TOGETHER, SMALL_FILES = 1000, 200_000


def stride(length: int = LENGTH) -> int:
    """Bytes of a record."""
    return HEAD + 2 * length + 1


def feistel(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Slots of indices: a permutation of 0 .. size - 1, chosen by the key.

    The network permutes a x b cells with a * b >= size; a slot beyond the size goes round again.
    """
    a = max(int(np.ceil(np.sqrt(size))), 1)
    b = -(-size // a) if size else 1
    out = index.astype(np.int64).copy()
    going = np.arange(len(out))
    while len(going):
        left, right, wide, narrow = out[going] // b, out[going] % b, a, b
        for i in range(ROUNDS):
            salt = U64((key * 0x9E3779B97F4A7C15 + i * 0xC2B2AE3D27D4EB4F) % 2**64)
            turn = (mix(right.astype(U64) * U64(0xD6E8FEB86659FD93) + salt) >> U64(1)).astype(np.int64)
            left, right, wide, narrow = right, (left + turn) % wide, narrow, wide
        out[going] = left * b + right if ROUNDS % 2 == 0 else left * a + right
        going = going[out[going] >= size]
    return out


def sequences(docs: DataFrame, length: int, tokenizer: str) -> DataFrame:
    """Stored sequences: packed ids (compressed), number of ids, the documents in them and where in the sequence each begins."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec, names = pa.Codec("zstd", compression_level=3), ["ids", "n", "doc_ids", "begins"]
        rest, owners, begins, id_type = np.zeros(0, np.uint16), [], np.zeros(0, np.int64), None

        def closed(ids: np.ndarray, n: int, doc_ids: list, at: np.ndarray):
            """Sequences of ids (a row each) with the documents that begin at the places `at` of all of them."""
            first = np.searchsorted(at, np.arange(len(ids)) * length, side="right") - 1  # the document that a sequence opens with
            after = np.searchsorted(at, np.arange(1, len(ids) + 1) * length, side="left")
            counts = after - first
            take = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            inside = np.maximum(at[take] - np.repeat(np.arange(len(ids)) * length, counts), 0)
            return pa.RecordBatch.from_arrays([
                pa.array([codec.compress(row.tobytes(), asbytes=True) for row in ids], pa.binary()), pa.array([n] * len(ids), pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array([doc_ids[i] for i in take.tolist()], id_type)),
                pa.ListArray.from_arrays(offsets, pa.array(inside, pa.int32()))], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            doc_ids = batch.column(0).to_pylist()
            for row, ids, edges in token_pieces(batch.column(1), tokenizer):
                owners += doc_ids[row:row + len(edges) - 1]
                begins = np.concatenate([begins, len(rest) + edges[:-1]])
                rest = np.concatenate([rest, ids])
                whole = len(rest) // length
                for a in range(0, whole, TOGETHER):
                    b = min(a + TOGETHER, whole)
                    # from the document that is open where the block begins
                    low, high = np.searchsorted(begins, a * length, side="right") - 1, np.searchsorted(begins, b * length, side="left")
                    yield closed(rest[a * length:b * length].reshape(-1, length), length, owners[low:high], begins[low:high] - a * length)
                if whole:
                    low = len(owners) if whole * length == len(rest) else np.searchsorted(begins, whole * length, side="right") - 1
                    rest, owners, begins = rest[whole * length:].copy(), owners[low:], begins[low:] - whole * length
        if len(rest):
            yield closed(np.pad(rest, (0, length - len(rest)))[None, :], len(rest), owners, begins)

    path = shared_folder(docs.sparkSession, "sequences")
    out = mapped(docs.select("doc_id", "text"), run, f"ids binary, n int, doc_ids array<{kind}>, begins array<int>")
    out.write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def slotted(rows: DataFrame, key: int) -> tuple[DataFrame, int]:
    """The stored rows with their slot, and how many there are. Rows are numbered by file and place in it."""
    at = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = stored(at.groupBy("file").agg(F.count("*").alias("rows")), "sequence-files")
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row per written file
    starts = stored(sizes.select(F.col("file").alias("of"), F.coalesce(before, F.lit(0)).alias("start")), "sequence-starts")
    use_package(rows.sparkSession)

    @F.pandas_udf("long")
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(feistel(index.to_numpy(dtype=np.int64), total, key))

    placed = at.join(small_side(starts, SMALL_FILES), F.col("file") == F.col("of"))
    return placed.withColumn("slot", slot(F.col("start") + F.col("row"))).drop("file", "row", "of", "start"), total


def write_shards(docs: DataFrame, path: str, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD, tokenizer: str | None = None) -> DataFrame:
    """Write the shards, one file `path/part-<shard>-...` each, and return the stored index: slot, shard, record, n, doc_ids, begins."""
    rows, total = slotted(sequences(docs, length, tokenizer or default_path()), key)
    rows = rows.withColumn("shard", F.floor(F.col("slot") / F.lit(per_shard)).cast("long"))
    shards = max(-(-total // per_shard), 1)

    def run(batches):
        codec = pa.Codec("zstd")
        for batch in batches:
            out = []
            for slot, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                out.append(slot.to_bytes(8, "little") + n.to_bytes(4, "little") + codec.decompress(ids.as_buffer(), 2 * length, asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    # a shard is a partition, so its records lie in the file as they were sorted
    sent = rows.select("slot", "n", "ids", "shard").repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    records = mapped(sent.drop("shard"), run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\n").text(path)
    index = rows.select("slot", "shard", (F.col("slot") % per_shard).alias("record"), F.col("n").cast("long").alias("n"), "doc_ids", "begins")
    return stored(index, "shard-index")


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Every record of the shard files: slot, shard (from the file's name), record (its place in the file), number of ids and
    their checksum (unsigned little-endian 32-bit ids).

    A record that does not lie where its slot says stops the job. A file holds `per_shard` records at most.
    """
    form = np.dtype([("slot", "<u8"), ("n", "<u4"), ("ids", "<u2", (length,)), ("end", "u1")])

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = np.frombuffer(content.as_buffer(), dtype=form)
                places = np.arange(len(records), dtype=np.int64)
                slots = records["slot"].astype(np.int64)
                if not np.array_equal(slots, shard * per_shard + places):
                    raise ValueError(f"records of shard {shard} do not lie in the order of their slots")
                sums = [zlib.crc32(ids[:n].astype("<u4").tobytes()) for ids, n in zip(records["ids"], records["n"].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots), pa.array([shard] * len(slots), pa.int64()), pa.array(places), pa.array(records["n"].astype(np.int64)), pa.array(sums, pa.int64())],
                    ["slot", "shard", "record", "n", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    named = files.select(F.regexp_extract("path", r"/part-(\d+)-[^/]*$", 1).cast("long").alias("shard"), "content")
    return mapped(named, run, "slot long, shard long, record long, n long, ids_crc32 long")


def token_shards(docs: DataFrame, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD, tokenizer: str | None = None) -> DataFrame:
    """Write all sequences and read them back: slot, shard, record, n_tokens, ids_crc32, the distinct doc_ids, and of every
    piece of a document the place where it begins (`begins`)."""
    spark, path = docs.sparkSession, shared_folder(docs.sparkSession, "shards")
    index = write_shards(docs, path, key, length, per_shard, tokenizer)
    if not index.head(1):
        return index.select("slot", "shard", "record", F.col("n").alias("n_tokens"), F.lit(0).cast("long").alias("ids_crc32"), "doc_ids", "begins")
    back = read_shards(spark, path, length, per_shard).withColumnRenamed("n", "n_tokens")
    return index.drop("n").join(back, ["slot", "shard", "record"]).select(
        "slot", "shard", "record", "n_tokens", "ids_crc32", F.array_distinct("doc_ids").alias("doc_ids"), "begins")
