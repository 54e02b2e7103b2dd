"""Embedding whitening: components by QDWH spectral divide and conquer, then broadcast whitening.

The covariance of the distinct vectors is reduced over the cluster.  Its
symmetric eigenproblem is split again and again: the polar factor U of
A - mean(eigenvalues) * I, computed by the dynamically weighted Halley
iteration, has the eigenvalues +1 and -1, so (U + I) / 2 projects onto the
invariant subspace of the eigenvalues over the mean.  A basis of either
subspace gives a smaller problem, until blocks of one dimension, or of one
eigenvalue, are left.

The covariance has as many entries as the square of the dimension, which does
not grow with the rows; it and the components are all that leaves the tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
EPS = np.finfo(np.float64).eps


def polar_factor(a: np.ndarray, least: float = EPS) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH (QR form), for singular values over ``least`` of the norm."""
    n = len(a)
    x = a / np.linalg.norm(a)  # Frobenius: not below the spectral norm
    low = least
    for _ in range(30):
        # Weights that lift the least singular value as far as a step can.
        d = np.cbrt(4 * (1 - low**2) / low**4)
        h = math.sqrt(1 + d) + math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * math.sqrt(1 + d)))) / 2
        h = max(h, 1.0)
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, np.eye(n)]))
        new = (b / c) * x + (h - b / c) / math.sqrt(c) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        moved, x = np.linalg.norm(new - x), new
        if abs(1 - low) < 10 * EPS and moved < math.sqrt(EPS):
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces over and under a shift near the mean; None if all eigenvalues agree."""
    n = len(a)
    mean = np.trace(a) / n
    off = a - mean * np.eye(n)
    spread = np.linalg.norm(off) / math.sqrt(n)
    if spread <= 4 * n * EPS * max(np.linalg.norm(a) / math.sqrt(n), abs(mean)):
        return None
    best = None
    # An eigenvalue on the shift has no sign; other shifts within the spread then part the spectrum.
    for shift in (0.0, 0.11, -0.13, 0.29, -0.31, 0.47, -0.53, 0.71, -0.73):
        u = polar_factor(off - shift * spread * np.eye(n))
        p = (u + np.eye(n)) / 2
        k = round(float(np.trace(p)))
        if not 0 < k < n:
            continue
        # A basis of the projector's range: QR of its image of a fixed random basis, once refined.
        seed = np.random.default_rng(0).standard_normal((n, n))
        v, _ = np.linalg.qr(np.hstack([p @ seed[:, :k], (np.eye(n) - p) @ seed[:, k:]]))
        over, under = v[:, :k], v[:, k:]
        fault = np.linalg.norm(under.T @ a @ over) / np.linalg.norm(off)
        if best is None or fault < best[0]:
            best = fault, over, under
        if fault < 100 * n * EPS:
            break
    if best is None:
        return None
    return best[1], best[2]


def components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    n = len(a)
    count = min(count, n)
    if n == 0 or count == 0:
        return np.zeros(0), np.zeros((n, 0))
    if n == 1:
        return a[0, :1].copy(), np.ones((1, 1))
    bases = split(a)
    if bases is None:
        return np.diag(a)[:count].copy(), np.eye(n)[:, :count]
    values, vectors = [], []
    for basis in bases:  # over the shift first
        got = sum(map(len, values))
        if got < count:
            part = basis.T @ a @ basis
            e, v = components((part + part.T) / 2, count - got)
            values.append(e)
            vectors.append(basis @ v)
    e, v = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def principal(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``components`` with re-orthonormalised vectors and Rayleigh quotients; directions without variance are left out."""
    e, v = components(covariance, count)
    if not len(e):
        return e, v
    v, _ = np.linalg.qr(v)
    e = np.einsum("ij,ij->j", v, covariance @ v)
    held = e > len(covariance) * EPS * max(np.trace(covariance), 0.0)
    e, v = e[held], v[:, held]
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def lattice(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows with a finite vector, and it as longs: floor(256 * c)."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False))).withColumn("x", F.transform(v, lambda c: F.floor(c * SCALE).cast("long")))


def whole(column, dim: int) -> np.ndarray:
    """Lists of longs as a matrix; shorter ones are filled up with zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends, flat = rows.offsets.to_numpy(), rows.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), dim), dtype=np.int64)
    out[np.arange(dim)[None, :] < np.diff(ends)[:, None]] = flat[ends[0]:ends[-1]]
    return out


def from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: as longs where they fit, else as Python's integers."""
    most = max(int(np.abs(x.astype(object)).max()) if x.size and x.min(initial=0) == np.iinfo(np.int64).min else int(np.abs(x).max(initial=0)), 1)
    if n * most + max(map(abs, sums), default=0) < 2**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def square_sums(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares per row; null beyond a long."""
    if d.dtype != object and d.size and int(np.abs(d).max()) ** 2 * d.shape[1] < 2**62:
        return (d * d).sum(axis=1).tolist()
    out = [sum(v * v for v in row) for row in d.tolist()]
    return [v if v < 2**63 else None for v in out]


def gram(values: DataFrame, n: int, to_rows) -> np.ndarray:
    """Sum of the outer products of centred rows, over n: ``to_rows`` maps an Arrow batch to a centred matrix.

    A task reduces its rows to one matrix; the upper halves are added by entry.
    """

    def run(batches):
        total = None
        for b in batches:
            m = to_rows(b)
            total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"])

    entries = values.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()  # dim * (dim + 1) / 2 rows
    i, j = entries.column("i").to_numpy(), entries.column("j").to_numpy()
    dim = int(i.max(initial=-1)) + 1
    out = np.zeros((dim, dim))
    out[i, j] = entries.column("s").to_numpy() / n
    return np.maximum(out, out.T) if dim == 1 else out + out.T - np.diag(np.diag(out))


def fit(points: DataFrame, count: int = 4) -> dict:
    """n, sums, dim, eigenvalues, components, trace and identity_error of the distinct ``x`` of ``points``."""
    distinct = written(points.select("x").distinct(), "whiten")
    n, dim = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    model = {"n": n, "dim": dim, "sums": [0] * dim, "values": np.zeros(0), "vectors": np.zeros((dim, 0)), "trace": 0.0, "error": 0.0}
    if not n or not dim:
        return model
    if distinct.where(F.size("x") < dim).limit(1).count():  # filled up, some may have become equal
        distinct = written(distinct.select(F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))).alias("x")).distinct(), "whiten")
        n = distinct.count()
    sums = distinct.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    by_place = {r["at"]: int(r["s"]) for r in sums.collect()}  # dim rows
    total = [by_place[i] for i in range(dim)]

    def centred(b):
        return from_mean(whole(b.column("x"), dim), n, total).astype(np.float64) / n

    covariance = gram(distinct, n, centred)
    values, vectors = principal(covariance, count)
    model.update(n=n, sums=total, values=values, vectors=vectors, trace=float(np.trace(covariance)))
    if len(values):
        shared = distinct.sparkSession.sparkContext.broadcast(vectors / np.sqrt(values))
        mean = _means(distinct, n, lambda b: centred(b) @ shared.value, len(values))
        checked = gram(distinct, n, lambda b: centred(b) @ shared.value - mean)
        model["error"] = float(np.abs(checked - np.eye(len(values))).max())
    return model


def _means(values: DataFrame, n: int, to_rows, dim: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(dim)
        for b in batches:
            total += to_rows(b).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total)], ["i", "s"])

    rows = values.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # dim rows
    return np.array([r["s"] for r in sorted(rows)]) / n


def whiten_vectors(vectors: DataFrame, count: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue) per row and component.

    Rows whose vector is null or holds null, NaN or infinity are left out;
    a null id stays.  Shorter vectors (also empty ones) are filled up with
    zeros to the longest.  Repeated rows and ids all stay, repeated vectors
    are fitted once.  Components without variance are left out, so equal
    vectors alone, a single row and an empty table give no rows.  deviation is
    null beyond a long; entries beyond a long after scaling are the nearest
    long.  Other columns, whatever their names, are not read.
    """
    rows = lattice(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")), "v").select("vec_id", "x")
    model = fit(rows, count)
    n, dim, sums, k = model["n"], model["dim"], model["sums"], len(model["values"])
    shared = vectors.sparkSession.sparkContext.broadcast(model["vectors"] / np.sqrt(model["values"]) if k else model["vectors"])
    names = ["vec_id", "component", "n", "deviation", "whitened"]

    def run(batches):
        for b in batches:
            if b.num_rows and k:
                d = from_mean(whole(b.column("x"), dim), n, sums)
                w = (d.astype(np.float64) / n) @ shared.value
                each = np.repeat(np.arange(b.num_rows), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                     pa.array(np.full(len(each), n)), pa.array(square_sums(d), pa.int64()).take(pa.array(each)), pa.array(w.ravel())], names)

    told = rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double")
    values = [float(v) for v in model["values"]]
    eigen = F.element_at(F.array(*[F.lit(v) for v in values]), F.col("component")) if k else F.lit(None).cast("double")
    return told.select(*names, (eigen / F.lit(model["trace"] or 1.0)).alias("explained"), F.lit(model["error"]).alias("identity_error"), eigen.alias("eigenvalue"))
