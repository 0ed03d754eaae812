"""Language-model scores by stupid backoff (operator 10).

Method: the n-grams of all documents are counted in tables partitioned by hash, joined
back to the n-grams of the documents, and summed per document. A word after its history
scores count(history, word) / count(history) if that n-gram was counted `CUTOFF` times or
more, else `BACKOFF` times the score after a shorter history; a single word scores its
share of all words.

Rows are exploded n-grams of a block of documents, sorted by hash and packed by hash
bucket as compressed differences, so that an n-gram costs 5 to 6 bytes in the shuffle and
appears once a block however often it occurs: no n-gram is hot, and a bucket grows with the
input divided by the number of buckets, which follows the input's size. Replies have the
counts, compressed, in the order of the questions, and texts travel compressed. Documents are
read twice, so they must come from stored rows.

Defined cases: null and empty texts have no words and a null score; rows with null or
repeated ids are counted and scored like any other; an empty table gives no rows; a text
longer than a block is a block of its own; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, gram_hashes, mapped, pieces, string_buffers, use_package, word_hashes

ORDER, BACKOFF, CUTOFF = 3, 0.4, 1
#: Bytes of text of a block, and of the share of a bucket.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20

EMPTY = pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})


def _blocks(batches):
    """Batches of (doc_id, text) as blocks with a number that a second reading gives again."""
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    held, size = [], 0
    for batch in batches:
        sizes = np.cumsum(np.diff(string_buffers(batch.column(1))[0]))
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = max(int(np.searchsorted(sizes, before + BLOCK_BYTES - size, side="right")), at if held else at + 1)
            end = min(end, batch.num_rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                size += int(sizes[end - 1]) - before
                at = end
            if at < batch.num_rows or size >= BLOCK_BYTES:
                yield number, pa.Table.from_batches(held)
                held, size, number = [], 0, number + 1
    if held:
        yield number, pa.Table.from_batches(held)


def block_grams(texts: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams of a block for n = 1 .. order, texts end to end, and words per text.

    Place i of the n-th array is the n-gram that ends at word i; 0 where the text has no n words there.
    """
    offsets, data = string_buffers(texts)
    parts, counts = [], []
    for a, b in pieces(offsets):
        hashes, own = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        parts.append(hashes)
        counts.append(own)
    words = np.concatenate(parts) if parts else np.zeros(0, dtype=U64)
    counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = []
    for n in range(1, order + 1):
        own = np.zeros(len(words), dtype=U64)
        own[n - 1:] = gram_hashes(words, n) | U64(1)  # never 0
        own[place < n - 1] = 0
        out.append(own)
    return out, counts


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(grams)
    return np.unique(every[every != 0], return_counts=True)


def _count_type(words_in_all: int) -> str:
    """The smallest number that holds any count of a corpus of so many words."""
    return "<u4" if words_in_all < 1 << 32 else "<u8"


def pack(numbers: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Unsigned numbers, first all lowest bytes, then all next ones, compressed: high bytes, mostly 0, take no room."""
    return squeeze.compress(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def unpack(packed: pa.Scalar, kind: str, expand: zstandard.ZstdDecompressor) -> np.ndarray:
    """What `pack` was given."""
    planes = np.frombuffer(expand.decompress(packed.as_buffer()), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _ask(bits: int, order: int, kind: str):
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        names = ["bucket", "block", "grams", "counts"]
        for number, block in _blocks(batches):
            grams, counts = _distinct(block_grams(block.column(1), order)[0])
            buckets = (grams >> U64(64 - bits)).astype(np.int32)
            edges = np.flatnonzero(np.diff(buckets, prepend=-1))
            steps = np.diff(grams, prepend=U64(0)).astype("<u8")
            steps[edges] = grams[edges]
            counts = counts.astype(kind)
            rows = [(int(buckets[a]), number, pack(steps[a:b], squeeze), pack(counts[a:b], squeeze)) for a, b in zip(edges, [*edges[1:], len(grams)])]
            for at in range(0, len(rows), 4096):
                columns = list(zip(*rows[at:at + 4096]))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                                                  pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names)

    return run


def _count(kind: str):
    def run(bucket: pa.Table) -> pa.Table:
        squeeze, expand = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        sizes, grams, counts = [], [], []
        for steps, own in zip(bucket.column("grams"), bucket.column("counts")):
            grams.append(np.cumsum(unpack(steps, "<u8", expand), dtype=U64))
            counts.append(unpack(own, kind, expand))
            sizes.append(len(grams[-1]))
        _, where = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(counts))[where].astype(kind)  # doubles are exact for any count there is
        edges = np.cumsum([0, *sizes])
        replies = [pack(total[a:b], squeeze) for a, b in zip(edges, edges[1:])]
        return pa.table({"block": bucket.column("block"), "bucket": bucket.column("bucket"), "counts": pa.array(replies, pa.binary())})

    return run


def _score(order: int, words_in_all: int, backoff: float, cutoff: int, count_type: str, kind: pa.DataType):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        rows = block.column("rows")  # one at most
        docs = pa.ipc.open_stream(rows[0].as_buffer()).read_all() if len(rows) else EMPTY
        grams, counts = block_grams(docs.column("text"), order)
        distinct, _ = _distinct(grams)
        parts = sorted(zip(replies.column("bucket").to_pylist(), replies.column("counts")), key=lambda x: x[0])
        expand = zstandard.ZstdDecompressor()
        known = np.concatenate([unpack(x, count_type, expand) for _, x in parts]) if parts else np.zeros(0, dtype=count_type)

        def counted(own: np.ndarray) -> np.ndarray:
            out = np.zeros(len(own))
            filled = own != 0
            out[filled] = known[np.searchsorted(distinct, own[filled])]
            return out

        numbers = [counted(own) for own in grams]
        score = np.log(np.maximum(numbers[0], 1)) - np.log(max(words_in_all, 1))
        for n in range(2, order + 1):
            history = np.concatenate([[1.0], numbers[n - 2][:-1]])
            whole = np.log(np.maximum(numbers[n - 1], 1)) - np.log(np.maximum(history, 1))
            shorter = np.where(grams[n - 1] != 0, score + np.log(backoff), score)
            score = np.where(numbers[n - 1] >= cutoff, whole, shorter)
        owner = np.repeat(np.arange(len(counts)), counts)
        sums = np.bincount(owner, weights=score, minlength=len(counts))
        mean = [s / c if c else None for s, c in zip(sums.tolist(), counts.tolist())]
        return pa.table({"doc_id": docs.column("doc_id").cast(kind), "n_words": pa.array(counts, pa.int64()), "log_score": pa.array(mean, pa.float64())})

    return run


def backoff_scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, cutoff: int = CUTOFF) -> DataFrame:
    """doc_id, n_words and log_score (mean natural log of the words' scores) of every document (doc_id, text)."""
    spark = docs.sparkSession
    use_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, (size // BUCKET_BYTES).bit_length())

    def sizes(batches):
        for batch in batches:
            total = 0
            offsets, data = string_buffers(batch.column(0))
            for a, b in pieces(offsets):
                total += int(word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[1].sum())
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    words_in_all = mapped(docs.select("text"), sizes, "n long").agg(F.sum("n")).first()[0] or 0
    kind = _count_type(words_in_all)
    asked = mapped(docs, _ask(bits, order, kind), "bucket int, block long, grams binary, counts binary")
    replies = asked.groupBy("bucket").applyInArrow(_count(kind), "block long, bucket int, counts binary")

    def whole(batches):
        for number, block in _blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, block.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(block)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

    blocks = mapped(docs, whole, "block long, rows binary")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _score(order, words_in_all, backoff, cutoff, kind, pa.int64()), "doc_id long, n_words long, log_score double")
