"""Linear models on scaled n-gram indicators, shared by the two classifiers.

A text is a set of hashed n-gram cells. The log-count ratio of a cell is taken over
every labelled training text, counted in Spark; the weights are fitted by dual
coordinate descent for the squared hinge loss on a bounded sample of labelled texts
that one task receives; both leave as tables of `cells` numbers. Cells of fewer than
`LEAST_TEXTS` training texts are left out. Slope and offset of the logistic score come
from margins of training texts that neither weights nor ratios have seen: each of
`PARTS` parts of the sample is judged by a model without it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import mapped, small_side, stored

#: Labelled texts of each class that the weights are fitted on, at most.
FIT_ROWS = 3000
#: Label rows sent to every task at most; beyond, the join shuffles.
SMALL_ROWS = 1_000_000
EPOCHS, COST = 10, 1.0
#: Training texts that a cell is in, at least, and parts of the sample that are left out in turn.
LEAST_TEXTS, PARTS = 3, 4

#: Distinct cells of each text of a batch.
CellsOf = Callable[[pa.Array], Iterator[np.ndarray]]


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of the two classes' shares of each cell (one added); `counts` is 2 x cells, label 0 first."""
    p = counts + 1.0
    p /= p.sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def frequent_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-count ratios, 0 for cells of fewer than `LEAST_TEXTS` texts."""
    return np.where(counts.sum(axis=0) >= LEAST_TEXTS, log_count_ratios(counts), 0.0).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cells: int,
                            cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of min |w|^2 / 2 + cost * sum max(0, 1 - y wx)^2; both classes weigh the same in sum."""
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.where(labels > 0, max((labels == 0).sum(), 1) / max((labels > 0).sum(), 1), 1.0)
    diagonal = 1 / (2 * cost * share)
    norms = np.array([v @ v for v in values]) + diagonal
    weights, dual, random = np.zeros(cells), np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i]) - 1 + diagonal[i] * dual[i]
            new = max(dual[i] - gradient / norms[i], 0.0)
            if new != dual[i]:
                weights[rows[i]] += (new - dual[i]) * sign[i] * values[i]
                dual[i] = new
    return weights


def scaled(ratios: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Indicators times ratios, at unit length."""
    v = ratios[cells]
    return v / max(np.sqrt(v @ v), 1e-12)


def calibration(margins: np.ndarray, labels: np.ndarray, totals: tuple[float, float]) -> tuple[float, float]:
    """Slope and offset of 1 / (1 + exp(-(slope margin + offset))) from margins of both labels.

    A half is the cut with the smallest sum of the two classes' shares of errors, each times the root
    of the class's `totals`, between counting errors and counting shares; the slope has the smallest
    log loss about it, classes weighing the same.
    """
    y, n = np.where(labels > 0, 1.0, -1.0), np.array([(labels == 0).sum(), (labels > 0).sum()])
    order = np.argsort(margins, kind="stable")
    m, own = margins[order], labels[order] > 0
    weight = np.sqrt(np.array(totals)) / n
    # all below a cut are called 0
    gain = np.concatenate([[0.0], np.cumsum(np.where(own, -weight[1], weight[0]))])
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    cuts = np.concatenate([[m[0] - 1e-3], (m[1:] + m[:-1]) / 2, [m[-1] + 1e-3]])
    cut, share = float(cuts[best[len(best) // 2]]), 0.5 / n[(labels > 0).astype(int)]
    grid = np.geomspace(0.5, 16, 31)
    slope = float(grid[np.argmin([(share * np.logaddexp(0, -k * y * (margins - cut))).sum() for k in grid])])
    return slope, -slope * cut


def fit(train: DataFrame, cells_of: CellsOf, cells: int, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Ratios, weights, slope and offset from labelled texts (doc_id, text, label 0 or 1).

    Without texts of both labels there is nothing to tell apart: all weights are 0.
    """
    def count(batches):
        total = np.zeros((2, cells), dtype=np.int64)
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for label, own in zip(labels, cells_of(batch.column(0))):
                total[label, own] += 1
        at = np.flatnonzero(total.any(axis=0))
        for a in range(0, len(at), 50_000):
            own = at[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[0, own]), pa.array(total[1, own])], ["cell", "n0", "n1"])

    def learn(batches):
        rows, labels = [], []
        for batch in batches:
            labels += batch.column(1).to_pylist()
            rows += [own.astype(np.int32) for own in cells_of(batch.column(0))]
        labels = np.array(labels, dtype=np.int64)
        both = 0 < labels.sum() < len(labels)
        weights = dual_coordinate_descent(rows, [scaled(ratios, own) for own in rows], labels, cells) if both else np.zeros(cells)
        # equal texts are in the same part
        parts = np.array([zlib.crc32(own.tobytes()) % PARTS for own in rows], dtype=np.int64)
        left, margins = np.zeros(len(rows), dtype=bool), np.zeros(len(rows))
        for part in range(PARTS if both else 0):
            out, rest = np.flatnonzero(parts == part), np.flatnonzero(parts != part)
            if not 0 < labels[rest].sum() < len(rest):
                continue
            less = counts.copy()
            for i in out:
                less[labels[i], rows[i]] -= 1
            other = frequent_ratios(less)
            own_weights = dual_coordinate_descent([rows[i] for i in rest], [scaled(other, rows[i]) for i in rest], labels[rest], cells)
            margins[out] = [own_weights[rows[i]] @ scaled(other, rows[i]) for i in out]
            left[out] = True
        slope, offset = calibration(margins[left], labels[left], totals) if 0 < labels[left].sum() < left.sum() else (1.0, 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()]), pa.array([slope]), pa.array([offset])], ["weights", "slope", "offset"])

    counted = mapped(train.select("text", F.col("label").cast("int").alias("label")), count, "cell long, n0 long, n1 long") \
        .groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = np.zeros((2, cells))
    for batch in counted.toArrow().to_batches():
        at = batch.column(0).to_numpy()
        counts[0, at], counts[1, at] = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    ratios = frequent_ratios(counts)
    found = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    totals = float(found.get(0, 0)), float(found.get(1, 0))
    # a text counts once under an id, however often the row is repeated, so the one task gets 2 * fit_rows rows at most
    keyed = train.withColumn("hash", F.xxhash64("text")).withColumn("turn", F.xxhash64("doc_id", "hash"))
    keys = keyed.select("label", "turn", "doc_id", "hash").distinct()
    names = [keys.where(F.col("label") == label).orderBy("turn", "doc_id", "hash").limit(fit_rows) for label in (0, 1)]
    chosen = stored(names[0].union(names[1]).select("doc_id", "hash"), "fit")
    drawn = keyed.join(F.broadcast(chosen), ["doc_id", "hash"], "left_semi").dropDuplicates(["doc_id", "hash"])
    sample = drawn.select("text", F.col("label").cast("int").alias("label"))
    one = mapped(sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), "label"), learn, "weights binary, slope double, offset double").first()
    if one is None:
        return ratios, np.zeros(cells, dtype=np.float32), 1.0, 0.0
    return ratios, np.frombuffer(one[0], dtype=np.float32), one[1], one[2]


def scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float, float], cells_of: CellsOf, keep: list[str], name: str = "score") -> DataFrame:
    """The columns `keep` of every row of `docs` (text, ...) and its score, 0 to 1, under the given name.

    A text without cells scores just below a half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("text", *[c for c in keep if c != "text"])
    passed = [rows.columns.index(c) for c in keep]

    def run(batches):
        ratios, weights, slope, offset = shared.value
        gains = (ratios * weights).astype(np.float64)
        squares = ratios.astype(np.float64) ** 2
        for batch in batches:
            out = []
            for own in cells_of(batch.column(0)):
                margin = gains[own].sum() / max(np.sqrt(squares[own].sum()), 1e-12) if len(own) else 0.0
                out.append(1 / (1 + np.exp(-((slope * margin + offset if len(own) else 0.0) or -1e-6))))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in passed], pa.array(out, pa.float64())], [*keep, name])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return mapped(rows, run, f"{fields}, `{name}` double")


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text and label of the documents that `labels` (doc_id, label column) names; null labels and ids are left out."""
    own = stored(labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label")), "labels")
    return docs.select("doc_id", "text").join(small_side(own, SMALL_ROWS), "doc_id")
