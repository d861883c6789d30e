"""Embedding whitening by shifted CholeskyQR.

Entries are put on an integer grid (``floor(SCALE * c)``; an offset added to all of them
would cancel out everywhere below), so sums over any number of rows are exact. The distinct grid vectors are the fit list A, centred by its exact
mean before anything is multiplied. Forming A'A and taking its eigenvalues would lose
every direction whose spread is below 1e-8 of the widest; so A is orthogonalised:

* a distributed pass adds up the Gram matrix of the current rows;
* its Cholesky factor R comes from the Gram matrix, in the first pass with a small
  shift on the diagonal, so that it exists however badly conditioned A is;
* the next pass works on the rows times the inverse of all factors so far (triangular
  solves, task by task), and this repeats until the Gram matrix is the identity.

The product of the factors is the R of A = QR, and the singular value decomposition
of this one small matrix gives the components and their spread. Q is never stored:
rows are solved anew in every pass, from a table of the distinct vectors.

What reaches the driver are sums of fixed size, dimension times dimension numbers, added
up by Spark beforehand. Components without spread are left out (a constant dimension
or one that others determine, up to ``NO_SPREAD`` of the widest).

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry
or one beyond ``WIDEST`` on the grid are dropped; of vectors of several lengths those of
the most frequent length stay (of equally frequent ones, the longest). Repeated rows
get equal results and count once in the fit. No rows or one distinct vector: no
components, so no rows. Equal eigenvalues: any orthonormal choice, the same for all
rows. A component's largest entry is positive. Other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, read_table, scratch_path

SCALE = 64
WIDEST = 1 << 40
COMPONENTS = 16
#: Passes at most, and when the rows count as orthonormal.
PASSES, ORTHONORMAL = 8, 1e-11
NO_SPREAD = 1e-13
#: Rows worked on at once.
BLOCK = 4096
LONG_MAX = (1 << 63) - 1


def on_grid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dims, x): the vectors that stay, as little-endian 64-bit integers
    ``floor(SCALE * c)``."""
    def run(batches):
        for batch in batches:
            vectors = batch.column(1)
            flat = vectors.flatten()
            dims = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            entries = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
            grid = np.floor(entries * SCALE)
            bad = ~(np.abs(grid) <= WIDEST)
            owner = np.repeat(np.arange(len(dims)), dims)
            good = (np.bincount(owner[bad], minlength=len(dims)) == 0) & (dims > 0)
            x = np.where(bad, 0, grid).astype("<i8")
            ends = np.cumsum(dims)
            raw = [x[e - d:e].tobytes() for e, d in zip(ends[good].tolist(), dims[good].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)), pa.array(dims[good], pa.int32()), pa.array(raw, pa.binary())],
                ["vec_id", "dims", "x"])

    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return narrow.mapInArrow(run, "vec_id long, dims int, x binary")


def _blocks(batches, column: int, dims: int):
    """Integer matrices of some thousand rows, and the batch's rows that they are."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, np.frombuffer(b"".join(part.column(column).to_pylist()), "<i8").reshape(-1, dims)


def _summed(cells: DataFrame) -> dict[tuple[int, int], float]:
    """Sums by cell (i, j), at most as many as one matrix has."""
    return {(r["i"], r["j"]): r["v"] for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def _cells(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(matrix.shape)
    return pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                       pa.array(matrix.ravel(), pa.float64())], ["i", "j", "v"])


class Fit:
    """Exact sums of the fit list and what is made of them."""

    def __init__(self, n: int, sums: list[int], factor: np.ndarray | None = None):
        self.n, self.sums, self.dims = n, sums, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64) if n else np.zeros(self.dims, np.int64)
        self.part = np.array([(s % n) / n for s in sums]) if n else np.zeros(self.dims)
        self.factor = factor
        self.values, self.vectors, self.trace = np.zeros(0), np.zeros((self.dims, 0)), 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows minus the mean; the difference of integers first, so nothing is lost."""
        return (x - self.whole) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum((n x - S)^2) of each row, exactly; null if it doesn't fit a long."""
        n, rows = self.n, [int(v) for v in self.sums]
        widest = max((max(abs(int(lo) * n - s), abs(int(hi) * n - s))
                      for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), rows)), default=0)
        if widest * widest * max(1, self.dims) <= LONG_MAX:
            d = x * n - np.array(rows, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((int(c) * n - s) ** 2 for c, s in zip(row, rows)) for row in x.tolist()]
        return [v if v <= LONG_MAX else None for v in exact]

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor, the first one first."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def _gram(fit_list: DataFrame, fit: Fit, factors: list[np.ndarray]) -> np.ndarray:
    def run(batches):
        total = np.zeros((fit.dims, fit.dims))
        for _, x in _blocks(batches, 0, fit.dims):
            q = _solved(fit.centred(x), factors)
            total += q.T @ q
        yield _cells(total)

    out = np.zeros((fit.dims, fit.dims))
    for (i, j), v in _summed(fit_list.mapInArrow(run, "i int, j int, v double")).items():
        out[i, j] = v
    return (out + out.T) / 2


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of gram + shift; a larger shift while there is none."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, np.trace(gram) * 1e-16)


def shifted_cholesky_qr(fit_list: DataFrame, fit: Fit) -> np.ndarray:
    """R of the centred fit list's QR, composed over the passes."""
    unit, d = np.finfo(float).eps / 2, fit.dims
    gram, factors = _gram(fit_list, fit, []), []
    if not np.trace(gram) > 0:
        return np.zeros((d, d))
    # the shift that the method's analysis asks for, with the rows that one sum adds up
    shift = 11 * (min(fit.n, BLOCK) * d + d * (d + 1)) * unit * np.trace(gram)
    for _ in range(PASSES):
        factors.append(_cholesky(gram, shift))
        gram = _gram(fit_list, fit, factors)
        shift = 0.0
        live = np.diag(gram) > 0.5  # a direction without spread stays short of length 1
        if np.abs(gram - np.eye(d))[np.ix_(live, live)].max(initial=0.0) < ORTHONORMAL:
            break
    factors.append(_cholesky(gram, 0.0))
    whole = np.eye(d)
    for r in factors:
        whole = r @ whole
    return whole


def fit_components(fit_list: DataFrame, dims: int) -> Fit:
    """Components of a table (x) of distinct vectors on the grid."""
    def run(batches):
        n, sums = 0, [0] * dims
        for _, x in _blocks(batches, 0, dims):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]  # a block's sum fits 64 bits
        yield pa.RecordBatch.from_arrays([pa.array([*range(dims), dims], pa.int32()),
                                          pa.array([str(v) for v in [*sums, n]], pa.string())], ["i", "v"])

    total = {r["i"]: int(r["v"]) for r in fit_list.mapInArrow(run, "i int, v string").groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    fit = Fit(total.get(dims, 0), [total.get(i, 0) for i in range(dims)])
    if fit.n < 2:
        return fit
    _, spread, right = np.linalg.svd(shifted_cholesky_qr(fit_list, fit))
    if not spread[0] > 0:
        return fit
    fit.trace = float((spread ** 2).sum() / fit.n)
    real = spread > NO_SPREAD * spread[0]
    vectors = right[real].T
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    fit.values, fit.vectors = spread[real] ** 2 / fit.n, vectors * signs
    return fit


def identity_error(fit_list: DataFrame, fit: Fit, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    def run(batches):
        total = np.zeros((k + 1, k))
        for _, x in _blocks(batches, 0, fit.dims):
            w = fit.whitened(x, k)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield _cells(total)

    total = np.zeros((k + 1, k))
    for (i, j), v in _summed(fit_list.mapInArrow(run, "i int, j int, v double")).items():
        total[i, j] = v
    mean = total[k] / fit.n
    return float(np.abs(total[:k] / fit.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component: vec_id, component (from 1), n (of
    the fit list), deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    grid = on_grid(rows, id_col, vector_col)
    lengths = grid.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], SCHEMA)
    dims = lengths["dims"]
    kept = grid.filter(F.col("dims") == dims)
    path = scratch_path(spark, f"whitening-{uuid.uuid4().hex}")
    kept.select("x").distinct().write.parquet(path)
    fit_list = spark.read.parquet(path)
    fit = fit_components(fit_list, dims)
    k = min(components, len(fit.values))
    if not k:
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(fit_list, fit, k)
    drop_table(spark, path)
    explained = (fit.values[:k] / fit.trace).tolist()

    def run(batches):
        for part, x in _blocks(batches, 1, dims):
            w, n = fit.whitened(x, k), len(x)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(n), k)))
            deviation = pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()), pa.array(np.full(n * k, fit.n), pa.int64()),
                 deviation, pa.array(w.ravel(), pa.float64()), pa.array(np.tile(explained, n), pa.float64()),
                 pa.array(np.full(n * k, error), pa.float64())], [f.split()[0] for f in SCHEMA.split(", ")])

    return kept.select("vec_id", "x").mapInArrow(run, SCHEMA)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
