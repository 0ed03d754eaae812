"""Shared folder, materialised intermediates and vectorised text hashing.

The hashing helpers work on Arrow string columns inside `mapInArrow` tasks: a
column is cut into pieces of a bounded number of bytes, and all texts of a piece
are hashed together with numpy. A longer single text is walked in segments.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Texts hashed together, in bytes of UTF-8.
PIECE_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and Python, and what Spark sets by itself.
BATCH_SETTING, BATCH_BYTES, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", f"{8 << 20}b", f"{64 << 20}b"
#: Bytes of strings in a frame that is sent to every task, at most.
SMALL_BYTES = 64 << 20
#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared `spark.checkpoint.dir`.

    A local session that names none (tests, notebooks) uses its warehouse folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words in place and return them."""
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, 256, dtype=U64)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(PIECE_BYTES + 1, base, dtype=U64), np.full(PIECE_BYTES + 1, pow(base, -1, 2**64), dtype=U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; a null is an empty text."""
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]] if len(offsets) > 1 else data[:0]


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `PIECE_BYTES`, or of one longer row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def _hash_segment(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start bytes of the words of one segment; no word crosses a cut."""
    blank = SPACE[data]
    begins, ends = ~blank, ~blank
    begins[1:] &= blank[:-1]
    ends[:-1] &= blank[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    begins[inner] = ~blank[inner]
    ends[inner - 1] = ~blank[inner - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = _powers()
    sums = np.zeros(len(data) + 1, dtype=U64)
    codes = _byte_codes()[LOWER[data]]
    codes *= up[:len(data)]
    np.cumsum(codes, out=sums[1:])
    return mix((sums[ends + 1] - sums[begins]) * down[begins]), begins


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` (A-Z lower-cased) of texts laid end to end, and words per text."""
    if len(data) <= PIECE_BYTES:
        hashes, begins = _hash_segment(data, offsets)
        edges = np.searchsorted(begins, offsets)
        return hashes, np.diff(edges)
    parts, at = [], 0  # one long text
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(SPACE[data[at:end]])
            if not len(gaps):  # a single word longer than a segment
                stop = at
                while stop < len(data) and not SPACE[data[stop]]:
                    stop += 1
                parts.append(_long_word(data[at:stop]))
                at = stop
                continue
            end = at + int(gaps[-1]) + 1
        parts.append(_hash_segment(data[at:end], offsets[:0])[0])
        at = end
    hashes = np.concatenate(parts)
    return hashes, np.array([len(hashes)])


def _long_word(data: np.ndarray) -> np.ndarray:
    import hashlib

    digest = hashlib.blake2b(digest_size=8)
    for at in range(0, len(data), PIECE_BYTES):
        digest.update(LOWER[data[at:at + PIECE_BYTES]].tobytes())
    return np.frombuffer(digest.digest(), dtype=U64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each place of a run of word hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=U64)
    out = np.full(count, n, dtype=U64)
    for j in range(n):
        out *= U64(0x9FB21C651E98DF25)
        out += words[j:j + count]
        out ^= out >> U64(29)
    return mix(out)


def text_shingles(words: np.ndarray, counts: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-word shingles of each text; a shorter text is one shingle, an empty one has none."""
    grams, at = gram_hashes(words, n), 0
    for count in counts.tolist():
        if count >= n:
            yield np.unique(grams[at:at + count - n + 1])
        elif count:
            yield gram_hashes(words[at:at + count], count)
        else:
            yield grams[:0]
        at += count


def use_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, if the cluster has not installed it.

    Rows of texts are large, so the session's Arrow batches are lowered from Spark's default size; a size
    that was set on purpose stays.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """`mapInArrow` whose workers find this package, and give memory back when a task ends: they live on, idle, beside the JVM."""
    use_package(df.sparkSession)

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return free memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def small_side(df: DataFrame, rows: int, text_bytes: int = SMALL_BYTES) -> DataFrame:
    """The frame with a broadcast hint if it has at most so many rows and bytes of text; else as it is, for a shuffle join.

    The frame must be stored already: it is counted and measured.
    """
    size = F.lit(0).cast("long")
    for field in df.schema:
        if field.dataType.typeName() in ("string", "binary"):
            size += F.coalesce(F.octet_length(field.name), F.lit(0))
    n, held = df.agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= text_bytes else df


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo `folds`; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)
