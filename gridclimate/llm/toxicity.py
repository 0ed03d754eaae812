"""Toxicity from character n-grams (operator 4).

Method: a text, lower-cased, is the set of its hashed runs of 3, 4 and 5 code points,
blanks and punctuation included, so that word beginnings count. Naive Bayes log-count
ratios of the cells, from all labelled training texts, scale the indicators; a linear
model is fitted on them. Every text is read whole.

Defined cases: a null text is an empty one; texts without cells score just below a half;
without training texts of both labels every score is just below a half. Labels are
learnt only from ids outside the held-out fold; language, source and id are no inputs.
A null id is in no fold and teaches nothing; repeated rows score alike; an empty table gives no
rows; long texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import U64, crc_fold
from gridclimate.llm.linear import fit, labelled, scores

CELL_BITS = 18
ORDERS = (3, 4, 5)
#: Code points hashed at a time; longer texts overlap by the longest run.
SPAN = 1 << 20


def char_cells(text: str) -> np.ndarray:
    """Sorted distinct cells of a text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    seen, few = None, []
    if len(points) > 4000:
        seen = np.zeros(1 << CELL_BITS, dtype=bool)
    for at in range(0, max(len(points), 1), SPAN):
        part = points[at:at + SPAN + ORDERS[-1] - 1].astype(U64)
        run = part
        for k in range(1, ORDERS[-1]):
            run = run[:-1] * U64(0x9E3779B97F4A7C15) + part[k:]
            run ^= run >> U64(29)
            if k + 1 in ORDERS:
                cells = (run * U64(0xD6E8FEB86659FD93) >> U64(64 - CELL_BITS)).astype(np.int64)
                if seen is None:
                    few.append(cells)
                else:
                    seen[cells] = True
    return np.flatnonzero(seen) if seen is not None else np.unique(np.concatenate(few))


def cells_of(column: pa.Array) -> Iterator[np.ndarray]:
    for text in column:
        yield char_cells(text.as_py() or "")


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0):
    """Model of `labels.toxic`, from ids outside the held-out fold."""
    train = labels.where(crc_fold(F.col("doc_id"), folds) != held_out)
    return fit(labelled(docs, train, "toxic"), cells_of, 1 << CELL_BITS)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = scores(docs, toxicity_model(docs, labels, folds, held_out), cells_of, ["doc_id"])
    return scored.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
