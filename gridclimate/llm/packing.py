"""Packing along a space-filling curve (operator 9).

Method: a document's token ids, hashed to cells with damped counts, make a vector that
a fixed random matrix projects to four dimensions. Its place on the Hilbert curve through
them is the sort key: texts alike in words lie near each other. Documents are range-sorted
by the key and laid end to end; every 2048 tokens close a sequence, so documents are cut
freely and sequences have no gaps. What is left at the end of a range is cut into
sequences of a power of two, which need no padding.

Equal keys (copies) spread over ranges by id. A task holds one open sequence, whatever
the size of its range. Token ids are computed once and stored before the sort.

Defined cases: a null or empty text is its end id alone; null ids and repeated rows are
packed like any other row; an empty table gives no pieces; a text longer than a piece is
tokenised whole; other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import mapped, shared_folder
from gridclimate.llm.tokens import KEPT_BYTES, default_path, token_pieces

LENGTH = 2048
DIMENSIONS, BITS = 4, 12
#: Cells that token ids are hashed to.
CELLS = 4096
#: Token bytes of one Arrow batch.
BATCH_BYTES = 8 << 20


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    """Projected unit vector of every token id (16 bits) by its cell."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    cells = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(np.int64)
    return np.random.default_rng(5).standard_normal((CELLS, DIMENSIONS))[cells]


def project(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Coordinates in 0 .. 2^BITS - 1 of documents whose ids lie end to end."""
    sizes = np.diff(edges)
    pairs = (np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 16) | ids
    pairs.sort()
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    weights = 1 + np.log(np.diff(first, append=len(pairs)))
    begins = np.searchsorted(pairs[first], np.arange(len(sizes), dtype=np.int64) << 16)
    v = np.add.reduceat(weights[:, None] * _projection()[pairs[first] & 0xFFFF], begins, axis=0) / np.sqrt(np.add.reduceat(weights * weights, begins))[:, None]
    return np.minimum((1 << BITS) / (1 + np.exp(-1.702 * v)), (1 << BITS) - 1).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows), by the transposed form of the curve."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:  # undo the rotations from the coarsest level down
        low = level - 1
        for i in range(n):
            flip = (x[i] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    twist, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        twist = np.where((x[n - 1] & level) != 0, twist ^ (level - 1), twist)
        level >>= 1
    x ^= twist
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def tokenised(docs: DataFrame, tokenizer: str, kept: int = KEPT_BYTES) -> DataFrame:
    """doc_id, token ids (16 bits each) and curve key of every document, stored."""
    def run(batches):
        for batch in batches:
            for row, ids, edges in token_pieces(batch.column(1), tokenizer, kept):
                # a text has its end id at least, so none is empty
                keys, data, spans = hilbert_keys(project(ids, edges)), ids.tobytes(), (2 * edges).tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(keys)), pa.array(keys), pa.array([data[a:b] for a, b in zip(spans, spans[1:])], pa.binary())],
                    ["doc_id", "key", "ids"])

    path = shared_folder(docs.sparkSession, "tokens")
    out = mapped(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, ids binary")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def power_cuts(length: int) -> list[int]:
    """Powers of two that add up to a length, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, kept: int = KEPT_BYTES) -> DataFrame:
    """Pieces of documents in sequences, with their ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    `kept` bounds the bytes of words whose ids a worker remembers: more cost memory, fewer cost time.
    """
    rows = tokenised(docs, tokenizer or default_path(), kept)
    spread = F.xxhash64(F.col("doc_id").cast("string"), F.octet_length("ids"))
    rows = rows.withColumn("spread", spread).repartitionByRange("key", "spread").sortWithinPartitions("key", "spread", "doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        open_pieces, filled, ready = [], 0, []

        def flush():
            columns = list(zip(*ready))
            types = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) if t else pa.array(c, type=id_type) for c, t in zip(columns, types)]
            ready.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        id_type, held = None, 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids.as_py()
                total, start = len(ids) // 2, 0
                while start < total:
                    take = min(total - start, length - filled)
                    open_pieces.append((doc_id, start, take, ids[2 * start:2 * (start + take)], total, sequence, filled))
                    start, filled = start + take, filled + take
                    if filled == length:
                        ready += open_pieces
                        held += 2 * length
                        open_pieces, filled, sequence = [], 0, sequence + 1
                        if held >= BATCH_BYTES:
                            yield flush()
                            held = 0
        # the open rest, cut at powers of two
        cuts, at = power_cuts(filled), 0
        for doc_id, start, take, ids, total, _, _ in open_pieces:
            done = 0
            while done < take:
                part = min(take - done, cuts[0] - at)
                ready.append((doc_id, start + done, part, ids[2 * done:2 * (done + part)], total, sequence, at))
                done, at = done + part, at + part
                if at == cuts[0]:
                    cuts, at, sequence = cuts[1:], 0, sequence + 1
        if ready:
            yield flush()

    return mapped(rows.select("doc_id", "ids"), run,
                  f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def packed_index(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """The pieces with a checksum in place of their ids (each as an unsigned little-endian 32-bit number)."""
    def run(batches):
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(x.as_buffer(), dtype=np.uint16).astype("<u4").tobytes()) for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64()), *batch.columns[4:]], [*batch.schema.names[:3], "ids_crc32", *batch.schema.names[4:]])

    pieces = pack(docs, length, tokenizer)
    fields = ", ".join(f"{'ids_crc32 long' if f.name == 'ids' else f'{f.name} {f.dataType.simpleString()}'}" for f in pieces.schema.fields)
    return mapped(pieces, run, fields)
