"""Quality classifier: naive Bayes support vectors (operator 7).

Method: a text is the set of its hashed word n-grams of one and two tokens. A token is
a run of letters, of digits or of one other sign, and carries its shape (lower case,
capitals, mixed); four equal tokens in a row are also the n-gram "again". Naive Bayes
log-count ratios scale the indicators; a linear hinge-loss model is fitted by dual
coordinate descent. Every text is read whole.

Defined cases: a null text is an empty one; texts without tokens score just below a
half; without training texts of both labels every score is just below a half. Labels are
learnt only from ids outside the held-out fold; language, source and id are no inputs.
A null id is in no fold and teaches nothing; repeated rows score alike; an empty table gives no
rows; long texts are read whole; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, crc_fold
from gridclimate.llm.linear import fit, labelled, scores

CELL_BITS = 18
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]{1,8}|_+")
#: Tokens hashed at a time.
SPAN = 1 << 20


def _codes(tokens: list[str]) -> np.ndarray:
    known = {t: zlib.crc32(t.lower().encode("utf-8", "surrogatepass")) | (t.isupper() << 32) | (t[:1].isupper() << 33) for t in set(tokens)}
    return np.fromiter((known[t] for t in tokens), dtype=np.int64, count=len(tokens)).astype(U64)


def _cell(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> U64(29))) * U64(0xD6E8FEB86659FD93) >> U64(64 - CELL_BITS)).astype(np.int64)


def word_cells(text: str) -> np.ndarray:
    """Sorted distinct cells of a text."""
    parts, last, tokens = [], np.zeros(0, dtype=U64), []

    def add(tokens: list[str], last: np.ndarray) -> np.ndarray:
        codes = np.concatenate([last, _codes(tokens)])
        parts.append(_cell(codes))
        if len(codes) > 1:
            parts.append(_cell(codes[:-1] * U64(0xC2B2AE3D27D4EB4F) + codes[1:]))
            if ((codes[3:] == codes[2:-1]) & (codes[2:-1] == codes[1:-2]) & (codes[1:-2] == codes[:-3])).any():
                parts.append(_cell(np.array([1], dtype=U64)))
        return codes[-3:]

    for match in TOKEN.finditer(text):
        tokens.append(match[0])
        if len(tokens) >= SPAN:
            last, tokens = add(tokens, last), []
    if tokens:
        add(tokens, last)
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)


def cells_of(column: pa.Array) -> Iterator[np.ndarray]:
    for text in column:
        yield word_cells(text.as_py() or "")


def quality_model(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1):
    """Model of `labels.quality`, from ids outside the held-out fold."""
    train = labels.where(crc_fold(F.col("doc_id"), folds) != held_out)
    return fit(labelled(docs, train, "quality"), cells_of, 1 << CELL_BITS)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = scores(docs, quality_model(docs, labels, folds, held_out), cells_of, ["doc_id"])
    return scored.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
