"""Embedding whitening (operator 12).

Method: entries become integers, so their sums over all vectors are exact. The covariance
is summed from vectors centred first, a partial matrix a task. Its components come from
spectral divide and conquer: the polar factor of the shifted covariance (QDWH: dynamically
weighted Halley iterations, by QR factors and, once well conditioned, by solving) is the sign of
the shifted matrix, half of it plus the identity projects onto the space of the larger
eigenvalues. Orthonormal bases of that space and of its complement split the matrix into
two smaller ones, until single components are left. The components are sent to every task, which whitens
its rows.

Only the covariance (dimensions squared) reaches the driver; a vector may have `MOST_DIMENSIONS` entries.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped,
as are vectors of another length than most (the longer of two equally frequent ones); null
ids and repeated rows count like any other row; an empty table, or one without usable rows, gives no
rows. Entries beyond 2^53 / 64 in size count as that. A component without variance
(eigenvalue at rounding level of the trace) has whitened values 0, and the identity is
compared on the others; with no variance at all every share is 0. A deviation that no long
holds is null. Other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import mapped, stored

COMPONENTS = 32
#: Steps of an entry, and what is added to make entries positive.
SCALE, SHIFT = 64, 1_000_000
MOST_DIMENSIONS = 2048
#: Rows multiplied together.
BLOCK = 4096
EPS = np.finfo(float).eps
TOP = 1 << 53


def integer_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and x, the integer entries, of every row with a usable vector."""
    usable = f"forall(`{vector}`, e -> e is not null and not isnan(e) and abs(e) < double('infinity'))"
    whole = f"transform(`{vector}`, e -> floor(least(greatest(double(e) * {SCALE}d, -{TOP}d), {TOP}d)) + {SHIFT}L)"
    return table.where(F.col(vector).isNotNull() & F.expr(usable)).select(F.col(key), F.expr(whole).alias("x"))


def _matrices(column: pa.Array, kind: type, size: int | None = None):
    """Row numbers and entries, as a matrix, of the vectors of each length; of one length if it is named."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for n in [size] if size is not None else np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        for at in range(0, len(rows), BLOCK):
            part = rows[at:at + BLOCK]
            yield part, values[offsets[part][:, None] + np.arange(n)].astype(kind, copy=False)


def exact_sums(vectors: DataFrame) -> tuple[int, int, np.ndarray]:
    """Length of most vectors, how many have it, and their sum (Python integers). Vectors without entries count for nothing."""
    def run(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for rows, x in _matrices(batch.column(0), np.int64):
                safe = x.shape[1] and max(int(x.max()), -int(x.min())) * len(x) < 1 << 62
                added = (x if safe else x.astype(object)).sum(axis=0).astype(object)
                held = totals.setdefault(x.shape[1], [0, 0])
                held[0], held[1] = held[0] + len(rows), held[1] + added
        for size, (n, sums) in totals.items():
            if size:
                yield pa.RecordBatch.from_arrays([
                    pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                    pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))], ["size", "i", "n", "s"])

    parts = stored(mapped(vectors.select("x"), run, "size int, i int, n long, s decimal(38,0)"), "vector-sums")
    best = parts.where("i = 0").groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return 0, 0, np.zeros(0, object)
    if best["size"] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {best['size']} entries; at most {MOST_DIMENSIONS} are whitened")
    sums = parts.where(F.col("size") == best["size"]).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()  # a row per dimension
    return best["size"], best["n"], np.array([int(r["s"]) for r in sums], dtype=object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly: as 64-bit numbers where they hold it, else as Python integers."""
    if max(int(np.abs(x).max(initial=0)), 1) * n < 1 << 61:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def covariance(rows: DataFrame, column: str, size: int, n: int, centre) -> np.ndarray:
    """Covariance of the vectors of a column, divisor n; `centre` maps a block of them to centred doubles."""
    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _matrices(batch.column(0), np.int64 if batch.schema.field(0).type.value_type == pa.int64() else float, size):
                c = centre(x)
                total += c.T @ c
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    cells = mapped(rows.select(column), run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()  # half a matrix
    out = np.zeros((size, size))
    out[cells["i"], cells["j"]] = cells["v"]
    return (out + np.triu(out, 1).T) / n


# --- spectral divide and conquer ----------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley iterations."""
    eye = np.eye(len(a))
    x, low = a / np.linalg.norm(a), EPS
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        weight = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            step = (weight - b / c) / np.sqrt(c) * q[:len(a)] @ q[len(a):].T
        else:
            step = (weight - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        new = b / c * x + step
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (weight + b * square) / (1 + c * square), 1.0)
        if 1 - low < 10 * EPS:
            low = 1 - EPS
            if moved < np.cbrt(EPS):
                break
    return (x + x.T) / 2


def _halves(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first k columns span the space of the larger eigenvalues, and k; None where none stand apart."""
    m, diagonal = len(a), np.diag(a)
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(m))
    if spread <= 4 * m * EPS * scale:
        return None
    guess = np.random.default_rng(m).standard_normal((m, m))
    best = None
    # The mean lies between the least and the largest eigenvalue; a shift that meets an eigenvalue is moved.
    for shift in (np.median(diagonal), mean, mean + spread / (7 * m), mean - spread / (7 * m), mean + spread / (3 * m), mean - spread / (3 * m)):
        project = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
        k = int(round(np.trace(project)))
        if not 0 < k < m:
            continue
        basis = guess
        for _ in range(2):  # a step of subspace iteration makes up for an unlucky guess
            basis, _ = np.linalg.qr(np.hstack([project @ basis[:, :k], basis[:, k:] - project @ basis[:, k:]]))
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or left < best[0]:
            best = left, basis, k
        if left <= 10 * m * EPS * scale:
            break
    return best and best[1:]


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling, and their unit vectors as columns, the largest entry of each positive."""
    scale = np.linalg.norm(v)
    basis, open_parts = np.eye(len(v)), [(0, len(v))]
    while open_parts:
        begin, end = open_parts.pop()
        if end - begin < 2:
            continue
        own = basis[:, begin:end]
        a = own.T @ v @ own
        found = _halves((a + a.T) / 2, scale)
        if found:
            turn, k = found
            basis[:, begin:end] = own @ turn
            open_parts += [(begin, begin + k), (begin + k, end)]
    values = np.einsum("ij,ij->j", basis, v @ basis)
    order = np.argsort(-values, kind="stable")
    basis = basis[:, order] / np.linalg.norm(basis[:, order], axis=0)
    return values[order], basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(v))] < 0, -1.0, 1.0)


# --- whitening ------------------------------------------------------------------------------

def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """Whitened vectors (key, deviation, whitened: array of up to `most` components), stored, and the fit.

    The fit holds n, sums, values, vectors (all components), explained and identity_error.
    """
    vectors = integer_vectors(table, vector, key)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, deviation long, whitened array<double>"
    size, n, sums = exact_sums(vectors)
    if not n:
        return table.sparkSession.createDataFrame([], schema), {"n": 0, "size": 0}

    def centre(x):
        return (centred(x, n, sums) / n).astype(float)

    v = covariance(vectors, "x", size, n, centre)
    values, basis = components(v)
    trace = float(np.trace(v))
    shown = min(most, size)
    live = values[:shown] > size * EPS * trace
    turn = basis[:, :shown] * np.where(live, 1 / np.sqrt(np.where(live, values[:shown], 1.0)), 0.0)

    def run(batches):
        for batch in batches:
            for rows, x in _matrices(batch.column(1), np.int64, size):
                whole = centred(x, n, sums)
                small = whole.dtype != object and int(np.abs(whole).max(initial=0)) ** 2 * size < 1 << 62
                squares = (whole if small else whole.astype(object)) ** 2
                deviation = [int(s) if s < 1 << 63 else None for s in squares.sum(axis=1)]
                white = (whole / n).astype(float) @ turn
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * shown, pa.int32()), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(deviation, pa.int64()), lists], [key, "deviation", "whitened"])

    white = stored(mapped(vectors, run, schema), "whitened")
    means = np.array([r["m"] for r in white.select(F.posexplode("whitened").alias("i", "w")).groupBy("i").agg(F.avg("w").alias("m")).orderBy("i").collect()])
    seen = covariance(white, "whitened", shown, n, lambda x: x - means)
    error = np.abs(seen - np.eye(shown))[np.ix_(live, live)].max(initial=0.0)
    return white, {"n": n, "size": size, "sums": sums, "values": values, "vectors": basis, "identity_error": float(error),
                   "explained": values / trace if trace > 0 else np.zeros(size)}


def whitened_rows(table: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    white, fit = whiten(table, vector, key, most)
    shares = [float(e) for e in fit.get("explained", [])[:most]] or [0.0]
    return (white.select(key, "deviation", F.posexplode("whitened").alias("__i", "whitened"))
            .select(key, (F.col("__i") + 1).alias("component"), F.lit(fit["n"]).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(F.array(*map(F.lit, shares)), F.col("__i") + 1).alias("explained"),
                    F.lit(fit.get("identity_error", 0.0)).alias("identity_error")))
