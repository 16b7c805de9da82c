"""Whitening of vectors by the principal components of their distinct values.

Sums and products are gathered over all distinct vectors in tasks; the driver gets matrices whose size depends
on the dimension alone. The eigenvectors come from spectral divide and conquer: the polar factor of the shifted
covariance, by dynamically weighted Halley steps on QR, gives the projector onto the components above the
shift, and each of the two invariant subspaces is split again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.llm.frames import stored

EPS = float(np.finfo(float).eps)
#: Entries of a vector times the scale are below this, or the vector has no whole numbers to stand for it.
LARGEST = 2.0**53


def polar_sign(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: for each eigenvector the sign of its eigenvalue."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low, eye = EPS / 4, np.eye(n)  # a bound below the least singular value; too small a bound costs a step or two
    for _ in range(40):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2)) if low < 1 else 0.0
        p = np.sqrt(1 + d)
        w = p + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * p), 0.0))
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        y = (b / c) * x + (w - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        y = (y + y.T) / 2
        moved, x = np.linalg.norm(y - x), y
        low = min(low * (w + b * l2) / (1 + c * l2), 1.0)
        if 1 - low < 10 * EPS and moved < 1e-5:
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the eigenvectors above the shift, and how many those are."""
    n = len(a)
    shifted = a - shift * np.eye(n)
    if not np.linalg.norm(shifted):
        return None
    projector = (polar_sign(shifted) + np.eye(n)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < n:
        return None
    upper, _ = np.linalg.qr(projector @ rng.standard_normal((n, k)))
    upper, _ = np.linalg.qr(projector @ upper)
    rest = rng.standard_normal((n, n - k))
    rest -= projector @ rest
    basis, _ = np.linalg.qr(np.hstack([upper, rest - upper @ (upper.T @ rest)]))
    return basis, k


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, to double precision.

    Where eigenvalues agree to double precision any basis of their space may come out.
    """
    a = (a + a.T) / 2
    scale, rng = np.linalg.norm(a), np.random.default_rng(0)

    def solve(m: np.ndarray) -> np.ndarray:
        n = len(m)
        middle = np.diag(m)
        if n == 1 or np.linalg.norm(m - middle.mean() * np.eye(n)) <= 8 * EPS * scale:
            return np.eye(n)
        best, least = None, np.inf
        low, high = middle.min(), middle.max()
        spread = np.linalg.norm(m - middle.mean() * np.eye(n))
        tries = [float(np.median(middle)), float(middle.mean()), float(low + high) / 2]
        tries += [float(middle.mean() + spread * t) for t in (0.3, -0.3, 0.15, -0.15, 0.07, -0.07, 0.03, -0.03, 0.01, -0.01)]
        for shift in tries:  # the first that lies between eigenvalues and not on one
            found = _split(m, shift, rng)
            if found is None:
                continue
            basis, k = found
            turned = basis.T @ m @ basis
            off = np.linalg.norm(turned[:k, k:])
            if off < least:
                best, least = (basis, k, turned), off
            if off <= 16 * EPS * n * scale:
                break
        if best is None:
            return np.eye(n)
        basis, k, turned = best
        parts = [solve((p + p.T) / 2) for p in (turned[:k, :k], turned[k:, k:])]
        return np.hstack([basis[:, :k] @ parts[0], basis[:, k:] @ parts[1]])

    vectors = solve(a)
    vectors = vectors @ (1.5 * np.eye(len(a)) - 0.5 * (vectors.T @ vectors))  # orthogonal to the last digit
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, dims, x`` of rows whose vector is whole: ``x`` is each entry times the scale, rounded down.

    A null vector goes, and one with an entry that is null, not finite or beyond 2^53 after scaling.
    """

    def run(batches):
        for batch in batches:
            lists = batch.column("v")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            values = np.floor(flat.fill_null(np.nan).to_numpy(zero_copy_only=False) * scale)
            with np.errstate(invalid="ignore"):
                bad = ~(np.abs(values) < LARGEST)
            row = np.repeat(np.arange(len(sizes)), sizes)
            good = lists.is_valid().to_numpy(zero_copy_only=False).astype(bool)
            good[row[bad]] = False
            kept = good[row]
            offsets = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32)
            x = pa.ListArray.from_arrays(offsets, values[kept].astype(np.int64))
            ids = batch.column("vec_id").filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes[good].astype(np.int32)), x], ["vec_id", "dims", "x"])

    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return named.mapInArrow(run, "vec_id long, dims int, x array<long>")


def _block(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


class Centre:
    """Count and sums of the fitted vectors, and the largest entry; differences to their mean, exactly."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums, self.dims = n, sums, len(sums)
        reach = n * largest + max(map(abs, sums), default=0)
        self.fits, self.squares_fit = reach < 1 << 62, reach * reach * max(self.dims, 1) < 1 << 62

    def apart(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``: whole numbers."""
        if self.fits:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``apart``; null where it exceeds 64 bits."""
        y = self.apart(x)
        if self.squares_fit:
            return np.einsum("ij,ij->i", y, y).tolist()
        exact = (y.astype(object) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]


def centre_of(fit: DataFrame, dims: int) -> Centre:
    """Count, sums and largest entry of ``x`` over all rows; one row per dimension leaves each task."""

    def run(batches):
        n, largest, sums = 0, 0, [0] * dims
        for batch in batches:
            x = _block(batch, dims)
            if len(x):
                n += len(x)
                largest = max(largest, int(np.abs(x).max()))
                small = largest * len(x) < 1 << 62
                sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0) if small else x.astype(object).sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims), pa.array([str(s) for s in sums]), pa.array([largest] * dims)], ["i", "n", "s", "largest"]
            )

    found = (
        fit.select("x").mapInArrow(run, "i int, n long, s string, largest long")
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("largest").alias("largest"))
        .orderBy("i").collect()
    )
    return Centre(found[0]["n"] if found else 0, [int(r["s"]) for r in found], found[0]["largest"] if found else 0)


def products(fit: DataFrame, dims: int, turn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer product of ``turn``'s row with itself: each task adds up its own matrix,
    and the matrices' rows are added up by number."""

    def multiply(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = turn(_block(batch, dims))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "row"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(*batch.columns, strict=True):
                row = np.frombuffer(row.as_buffer())
                sums[i.as_py()] = sums[i.as_py()] + row if i.as_py() in sums else row
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([r.tobytes() for r in sums.values()], pa.binary())], ["i", "row"])

    found = fit.select("x").mapInArrow(multiply, "i int, row binary").repartition("i").mapInArrow(add, "i int, row binary").orderBy("i").collect()
    return np.array([np.frombuffer(r["row"]) for r in found]).reshape(width, width)


def whiten(
    rows: DataFrame, components: int = 4, scale: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component.

    The fit is over each distinct ``x`` once (see ``whole_vectors``), ``n`` of them: covariances have divisor
    ``n`` and are of centred values. Component 1 has the largest variance. ``deviation`` is the exact sum of
    ``(n * x - sum)^2``, null beyond 64 bits; ``whitened`` the centred vector along the component over the
    root of its variance; ``explained`` the variance's share of all; ``identity_error`` how far the covariance
    of the whitened fit is from the identity.

    Vectors have the length most rows have, of equally frequent ones the largest; others go. Components
    without variance, beyond rounding, are left out, so equal vectors, a single row or an empty table give no
    row. Repeated rows stay rows of their own. Other columns of ``rows`` are not looked at.
    """
    spark = rows.sparkSession
    found = stored(whole_vectors(rows, key, vector, scale), "whole-vectors")
    common = found.groupBy("dims").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    result = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dims:
        return spark.createDataFrame([], result)
    found = found.where(F.col("dims") == dims)
    fit = stored(found.select("x").distinct(), "distinct-vectors")
    centre = centre_of(fit, dims)
    n = centre.n
    variance = products(fit, dims, centre.centred, dims) / max(n, 1)
    values, vectors = eigen(variance) if n else (np.empty(0), np.empty((dims, 0)))
    kept = np.flatnonzero(values[:components] > dims * EPS * max(values[0], 0)) if len(values) else np.empty(0, int)
    turn = vectors[:, kept] / np.sqrt(values[kept])
    width = len(kept)
    white = products(fit, dims, lambda x: centre.centred(x) @ turn, width) / max(n, 1) if width else np.empty((0, 0))
    error = float(np.abs(white - np.eye(width)).max()) if width else 0.0
    share = values[kept] / np.trace(variance)
    shared = spark.sparkContext.broadcast((centre, turn, share))

    def run(batches):
        centre, turn, share = shared.value
        width = turn.shape[1]
        for batch in batches if width else ():
            x = _block(batch, dims)
            m = len(x)
            times = lambda column: column.take(pa.array(np.repeat(np.arange(m), width)))
            yield pa.RecordBatch.from_arrays(
                [
                    times(batch.column("vec_id")), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)), pa.array(np.full(m * width, n)),
                    times(pa.array(centre.deviations(x), pa.int64())), pa.array((centre.centred(x) @ turn).ravel()),
                    pa.array(np.tile(share, m)), pa.array(np.full(m * width, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return found.select("vec_id", "x").mapInArrow(run, result)
