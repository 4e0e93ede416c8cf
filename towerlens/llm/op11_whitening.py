"""Whitening of embeddings by mixed-precision principal components.

Rows become integer vectors; the fit list is each distinct vector once, so copies are
folded before the shuffle and a vector in a third of all rows costs one row a task. Its
size and sums are exact. Every task adds up the products of its rows, less the rounded
mean, as exact integers, and the parts of each cell are added as integers too: the
covariance is the correctly rounded one, in any order of the rows and however often a task reruns.

The covariance (dimensions squared, no more) is decomposed on the driver. Eigenvectors in
32 bits are corrected by Ogita-Aishima iterations: matrix products in extended
precision give the residuals of orthogonality and of diagonality and from these a correction of
quadratic convergence. Eigenvalues too close for that are handled as clusters:
the shifted matrix on the cluster's subspace is solved alone and the subspace turned.
Then one pass over the rows projects them, and one over the fit list measures the
covariance of what comes out.

Defined results: rows whose vector is null, or holds null or non-finite entries, are dropped, and so
are empty vectors and rows whose vector has another length than most valid ones (of lengths
as frequent, the greatest counts). Entries beyond a long are set to its bounds, as Spark's floor does.
Repeated rows and rows that tie each get their own rows; null ids stay null. Components
whose eigenvalue is not above the rounding of the trace do not exist: one distinct vector, or
an empty table, gives no rows. Among equal eigenvalues any turn of the eigenvectors is as good.
A deviation beyond a long is null. Other columns, whatever their names, are never read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import read_table
from towerlens.session import shared_dir

#: Rows multiplied at once, and corrections at most (three suffice but for clusters).
BLOCK, CORRECTIONS = 4096, 12

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def difference(x: np.ndarray, near: list[int]) -> np.ndarray:
    """x - near in exact integers: of 64 bits where these hold it."""
    if max(map(abs, near), default=0) < 1 << 62 and (np.abs(x.astype(np.float64)) < 2.0 ** 62).all():
        return x - np.array(near, dtype=np.int64)
    return x.astype(object) - np.array(near, dtype=object)


def products(y: np.ndarray) -> np.ndarray:
    """y.T @ y in exact integers, by products of 20-bit parts: a block's sums stay below 2**53."""
    limbs = []
    while len(y) and max(int(y.max()), -int(y.min())) >= 1 << 20:
        limbs.append((y & ((1 << 20) - 1)).astype(np.float64))
        y = y >> 20
    limbs.append(y.astype(np.float64))
    return sum((p.T @ q).astype(np.int64).astype(object) << (20 * (i + j))
               for i, p in enumerate(limbs) for j, q in enumerate(limbs))


def integer_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers and integer vectors of the valid rows, grouped by length: floor(256 * entry)."""
    size = column.value_lengths().fill_null(-1).to_numpy()
    rows, out = [], []
    ends = np.append(0, np.cumsum(np.maximum(size, 0)))
    flat = column.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        x = values[(ends[at][:, None] + np.arange(n)).ravel()].reshape(len(at), n)
        fine = np.isfinite(x).all(axis=1)
        if fine.any():
            x = np.floor(256 * x[fine])
            whole = np.clip(x, -2.0 ** 62, 2.0 ** 62).astype(np.int64)
            whole[x >= 2.0 ** 63], whole[x < -2.0 ** 63] = _HIGH, _LOW
            beyond = (np.abs(x) > 2.0 ** 62) & (np.abs(x) < 2.0 ** 63)
            whole[beyond] = x[beyond].astype(np.int64)
            rows.append(at[fine])
            out.append(whole)
    return rows, out


def packed(x: np.ndarray) -> list[bytes]:
    """Each vector as bytes, equal for equal vectors: entries of 16 bits where they fit, else of 64."""
    short = ((x >= -(1 << 15)) & (x < 1 << 15)).all(axis=1)
    return [(b"\2" + v.astype("<i2").tobytes()) if s else (b"\10" + v.astype("<i8").tobytes()) for v, s in zip(x, short.tolist())]


def unpacked(blobs: list[bytes]) -> np.ndarray:
    if not blobs:
        return np.zeros((0, 0), dtype=np.int64)
    return np.array([np.frombuffer(b, dtype="<i2" if b[0] == 2 else "<i8", offset=1) for b in blobs], dtype=np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for at in range(0, len(b), BLOCK):
            yield unpacked(b.column("x").slice(at, BLOCK).to_pylist())


def fit_list(vectors: DataFrame) -> DataFrame:
    """(x, size, copies): each distinct integer vector once, packed, and the rows that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in integer_vectors(b.column("vector"))[1]:
                found = Counter(packed(x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array([x.shape[1]] * len(found), pa.int32()),
                     pa.array(list(found.values()), pa.int64())], ["x", "size", "copies"])

    return vectors.select("vector").mapInArrow(run, "x binary, size int, copies long").groupBy("x", "size").agg(
        F.sum("copies").alias("copies"))


#: Exact numbers of cells: ``value`` holds digits of base 2**80, ``digit`` tells which.
PARTS, BASE_BITS = "i int, j int, digit int, value decimal(38,0)", 80


def parts(cells: list[tuple[int, int, int]]) -> pa.RecordBatch:
    rows = [(i, j, k, v) for i, j, value in cells
            for k, v in ((0, int(value) & ((1 << BASE_BITS) - 1)), (1, int(value) >> BASE_BITS)) if v or k == 0]
    i, j, digit, value = zip(*rows)
    return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in (i, j, digit)), pa.array(value, pa.decimal128(38, 0))],
                                      ["i", "j", "digit", "value"])


def cell_sums(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums of parts; there are as many cells as dimensions squared at most."""
    out: dict[tuple[int, int], int] = {}
    for r in rows.groupBy("i", "j", "digit").agg(F.sum("value").alias("value")).collect():
        out[r.i, r.j] = out.get((r.i, r.j), 0) + (int(r.value) << (BASE_BITS * r.digit))
    return out


def sums(fitted: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for x in blocks(batches):
            n, total = n + len(x), total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield parts([(-1, -1, n)] + [(k, -1, v) for k, v in enumerate(total)])

    cells = cell_sums(fitted.select("x").mapInArrow(run, PARTS))
    n = cells.pop((-1, -1), 0)
    return n, [cells[k] for k in sorted(cells)]


def covariance(fitted: DataFrame, n: int, total: list[int]) -> list[list[Fraction]]:
    """Exact covariance: products of vectors less the rounded mean, less those of what rounding left."""
    near = [round(Fraction(s, n)) for s in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for x in blocks(batches):
            more = products(difference(x, near))
            out = more if out is None else out + more
        if out is not None:
            d = len(out)
            yield parts([(i, j, out[i, j]) for i in range(d) for j in range(i, d)])

    cells = cell_sums(fitted.select("x").mapInArrow(run, PARTS))
    left = [Fraction(s, n) - m for s, m in zip(total, near)]
    return [[Fraction(cells[min(i, j), max(i, j)], n) - left[i] * left[j] for j in range(len(near))]
            for i in range(len(near))]


def extended(value: Fraction) -> np.longdouble:
    """A fraction in extended precision."""
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix in extended precision."""
    d, top = len(a), np.abs(a).max(initial=0)
    if not d or not top:
        return np.zeros(d, np.longdouble), np.eye(d, dtype=np.longdouble)
    a = a / top
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm, eye = np.longdouble(np.linalg.norm(a.astype(np.float64), 2)), np.eye(d, dtype=np.longdouble)
    for _ in range(CORRECTIONS):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        reach = 2 * (np.sqrt((off ** 2).sum()) + norm * np.sqrt((r ** 2).sum()))  # Frobenius bounds the 2-norm
        gap = value[None, :] - value[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.where(np.abs(gap) <= reach, r / 2, (s + value[None, :] * r) / gap)
        e = (e - e.T + r) / 2  # e + e.T = r: small gaps shall not cost orthogonality
        x = x + x @ e
        for group in clusters(value, reach):
            x[:, group] = turned(a, x[:, group])
        if np.abs(e).max() < 1e-12:  # what is left is its square
            break
    value = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-value, kind="stable")
    return value[order] * top, x[:, order]


def clusters(value: np.ndarray, reach: np.longdouble) -> list[np.ndarray]:
    """Eigenvalues that a chain of gaps up to ``reach`` holds together, two at least."""
    order = np.argsort(value)
    cut = np.flatnonzero(np.diff(value[order]) > reach) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def turned(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The basis ``v`` of a cluster's subspace, turned to its eigenvectors by a shifted problem of its own."""
    v = v.copy()
    for k in range(v.shape[1]):
        for _ in range(2):
            v[:, k] -= v[:, :k] @ (v[:, :k].T @ v[:, k])
        v[:, k] /= np.sqrt(v[:, k] @ v[:, k])
    small = v.T @ (a @ v)
    small = (small + small.T) / 2
    small -= np.trace(small) / len(small) * np.eye(len(small), dtype=np.longdouble)
    size = np.abs(small).max()
    if size == 0:
        return v
    turn = np.linalg.eigh((small / size).astype(np.float64))[1].astype(np.longdouble)
    return v @ turn @ (3 * np.eye(len(turn), dtype=np.longdouble) - turn.T @ turn) / 2


def projected(x: np.ndarray, n: int, total: list[int], axes: np.ndarray) -> np.ndarray:
    """(x - mean) on the scaled axes."""
    near = [round(Fraction(s, n)) for s in total]
    left = np.array([float(Fraction(s, n) - m) for s, m in zip(total, near)])
    return (difference(x, near).astype(np.float64) - left) @ axes


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2, exact; null beyond a long."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, total), default=0)
    if top * top * max(len(total), 1) <= _HIGH:
        return ((n * x - np.array(total, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    wide = ((n * x.astype(object) - np.array(total, dtype=object)) ** 2).sum(axis=1).tolist()
    return [v if v <= _HIGH else None for v in wide]


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for rows (id, vector)."""
    spark = vectors.sparkSession
    schema = ("id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    folder = f"{shared_dir(spark)}/whitening-{uuid.uuid4().hex}"
    fit_list(vectors).write.parquet(folder)
    fitted = spark.read.parquet(folder)
    most = fitted.groupBy("size").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    size = most["size"]
    fitted = fitted.where(F.col("size") == size)
    n, total = sums(fitted)
    exact = covariance(fitted, n, total)
    matrix = np.array([[extended(v) for v in row] for row in exact], dtype=np.longdouble).reshape(len(total), len(total))
    value, axes = eigenvectors(matrix)
    trace = np.trace(matrix) if len(matrix) else np.longdouble(0)
    real = int((value[:components] > trace * len(matrix) * np.finfo(np.float64).eps).sum()) if len(matrix) else 0
    scaled = (axes[:, :real] / np.sqrt(value[:real])).astype(np.float64)
    share = (value[:real] / trace).astype(np.float64) if real else np.zeros(0)
    error = identity_error(fitted, n, total, scaled) if real else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in zip(*integer_vectors(b.column("vector"))):
                if x.shape[1] != size or not real:
                    continue
                for at in range(0, len(x), BLOCK):
                    part = x[at: at + BLOCK]
                    ids = b.column("id").take(pa.array(np.repeat(rows[at: at + BLOCK], real)))
                    m = len(part)
                    off = [v for v in deviations(part, n, total) for _ in range(real)]
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, real + 1, dtype=np.int32), m)), pa.array([n] * (m * real), pa.int64()),
                         pa.array(off, pa.int64()), pa.array(projected(part, n, total, scaled).ravel()),
                         pa.array(np.tile(share, m)), pa.array(np.full(m * real, error))],
                        ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)


def identity_error(fitted: DataFrame, n: int, total: list[int], axes: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, measured on its rows."""
    k = axes.shape[1]
    where = [(i, j) for i in range(k) for j in range(i, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for x in blocks(batches):
            w = projected(x, n, total, axes)
            first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in where] + list(range(k)), pa.int32()), pa.array([j for _, j in where] + [-1] * k, pa.int32()),
             pa.array([second[p] for p in where] + first.tolist(), pa.float64())], ["i", "j", "value"])

    rows = fitted.select("x").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(
        F.sum("value").alias("value")).collect()
    cell = {(r.i, r.j): r.value / n for r in rows}
    return float(max(abs(cell[i, j] - cell[i, -1] * cell[j, -1] - (i == j)) for i, j in where))


def embedding_rows(table: DataFrame) -> DataFrame:
    """The two columns that are read, as (id, vector)."""
    return table.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(embedding_rows(read_table(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")
