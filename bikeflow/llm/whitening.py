"""Whitening of embeddings: principal components of distinct vectors by pivoted Cholesky and one-sided Jacobi.

Entries are laid on a grid of 1/256, as integers. The scatter is summed about integers next to the means, so entries are
centred before they are multiplied and the sums stay exact (whole numbers in doubles) in any order of tasks; the rest of the
mean, at most a half, is taken off afterwards. The driver holds one matrix of dimensions squared, whatever the rows. It is
factored with pivots, ``A = L L'``, and the columns of the triangular ``L`` are rotated in pairs until they are orthogonal:
their squared lengths are the eigenvalues and their directions the components, to high relative accuracy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from bikeflow.llm.common import map_arrow
from bikeflow.plans.runtime import cut

GRID = 256
LARGEST = 2**62        # entries beyond it become it, so that differences still fit 64 bits
SLICE = 1 << 20        # entries that are worked on at once
SWEEPS = 60
BRANCHES = 8           # tasks that add up what all others have summed
LIMB = 21              # bits of a part of an entry whose sums fit 64 bits for up to 2**42 rows


def grid_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``x`` (entries as ``floor(256 * c)``): the rows whose vector has entries, none null or not finite.

    A value beyond 2**62 becomes that. Rows that repeat stay; a null id stays null; other columns play no part.
    """
    schema = to_arrow_schema(StructType.fromDDL("vec_id bigint, x array<bigint>"))

    def run(batches):
        for b in batches:
            v = b.column("v")
            length = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            parent = pc.list_parent_indices(v).to_numpy(zero_copy_only=False)
            c = v.flatten().to_numpy(zero_copy_only=False)
            good = length > 0
            good[parent[~np.isfinite(c)]] = False
            x = np.clip(np.floor(GRID * c[good[parent]]), -LARGEST, LARGEST).astype(np.int64)
            ends = np.r_[0, np.cumsum(length[good])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(x), type=schema.field("x").type)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").filter(pa.array(good)), lists], schema=schema)

    plain = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return plain.mapInArrow(run, "vec_id bigint, x array<bigint>")


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as rows of a matrix."""
    rows = max(SLICE // dims, 1)
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            part = b.slice(lo, rows)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(vectors: DataFrame, dims: int, add: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray | None:
    """The sum over all rows of what ``add`` makes of a matrix of them; None without rows."""

    def one(batches):
        total = None
        for _, x in _matrices(batches, dims):
            total = add(x) if total is None else total + add(x)
        if total is not None:
            yield {"sums": [total]}

    def several(batches):
        total = None
        for b in batches:
            for s in b.column("sums"):
                s = s.values.to_numpy()
                total = s if total is None else total + s
        if total is not None:
            yield {"sums": [total]}

    # A row per task, then a row per branch, which is all that the driver gets.
    ddl = f"sums array<{kind}>"
    rows = map_arrow(map_arrow(vectors, one, ddl).repartition(BRANCHES), several, ddl).collect()
    return sum(np.array(r["sums"]) for r in rows) if rows else None


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``f`` with ``f @ f.T`` equal to the positive semidefinite ``a``; triangular but for the order of its rows.

    It has a column per pivot, largest remaining diagonal entry first, and stops where what remains is rounding.
    """
    d = len(a)
    left = np.diag(a).astype(float)
    floor = d * np.finfo(float).eps * max(left.max(initial=0), 0)
    f = np.zeros((d, d))
    for k in range(d):
        p = int(left.argmax())
        if left[p] <= floor:
            return f[:, :k]
        f[:, k] = (a[:, p] - f[:, :k] @ f[p, :k]) / np.sqrt(left[p])
        f[left == -np.inf, k] = 0
        left -= f[:, k] ** 2
        left[p] = -np.inf
    return f


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns as rounds of disjoint pairs."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if max(a, b) < n]
        out.append((np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(f: np.ndarray) -> np.ndarray:
    """The columns of ``f`` rotated in pairs until they are orthogonal; ``f @ f.T`` stays."""
    f = f.copy()
    rounds = _rounds(f.shape[1])
    small = np.finfo(float).eps * np.sqrt(max(len(f), 1))
    for _ in range(SWEEPS):
        turned = False
        for p, q in rounds:
            a, b = f[:, p], f[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            open_ = np.abs(ab) > small * np.sqrt(aa * bb)
            if not open_.any():
                continue
            turned = True
            zeta = np.where(open_, (bb - aa) / np.where(open_, 2 * ab, 1), 0)
            t = np.where(open_, np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            f[:, p], f[:, q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return f


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found. Components are columns, by falling eigenvalue; the largest entry of each is positive."""

    dims: int
    n: int                      # distinct vectors
    centre: np.ndarray          # integers next to the means
    rest: list[int]             # sums about the centre, exact
    eigenvalues: np.ndarray     # of the covariance, above rounding
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """Whitened coordinates of vectors (rows) on the first ``k`` components."""
        mean = np.array([r / self.n for r in self.rest])
        return ((x - self.centre) - mean) @ (self.components[:, :k] / np.sqrt(self.eigenvalues[:k]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per vector the exact sum over dimensions of ``(n * x - S) ** 2``; None where that needs over 63 bits."""
        y = x - self.centre
        rough = ((self.n * y.astype(float) - np.array(self.rest, float)) ** 2).sum(1)
        safe = rough < 2.0**62
        z = self.n * y[safe] - np.array(self.rest)
        out: list[int | None] = [None] * len(x)
        for i, v in zip(np.flatnonzero(safe).tolist(), (z * z).sum(1).tolist(), strict=True):
            out[i] = v
        for i in np.flatnonzero(~safe & (rough < 2.0**64)):
            exact = sum((self.n * int(v) - r) ** 2 for v, r in zip(y[i], self.rest, strict=True))
            out[i] = exact if exact < 2**63 else None
        return out


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Each ``x`` once. Repeats are merged before the shuffle, so a vector that many rows share costs a row per task."""
    return cut(vectors.select("x").distinct())


def commonest_length(distinct: DataFrame) -> int:
    """The length that most of the vectors have, the larger one in a tie; 0 without vectors."""
    row = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return row["d"] if row else 0


def fit(distinct: DataFrame, dims: int) -> Whitening | None:
    """The components of ``distinct`` vectors (``x``, of length ``dims``); None without any spread."""

    def limbs(x):
        low = (1 << LIMB) - 1
        return np.r_[(x >> 2 * LIMB).sum(0), (x >> LIMB & low).sum(0), (x & low).sum(0), len(x)]

    sums = _summed(distinct, dims, limbs, "bigint")
    if sums is None:
        return None
    n = int(sums[-1])
    high, middle, low = (sums[i * dims : (i + 1) * dims].tolist() for i in range(3))
    total = [(h << 2 * LIMB) + (m << LIMB) + v for h, m, v in zip(high, middle, low, strict=True)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]
    about = np.array(centre, np.int64)
    upper = np.triu_indices(dims)

    def products(x):
        y = (x - about).astype(float)
        return (y.T @ y)[upper]

    scatter = np.zeros((dims, dims))
    scatter[upper] = _summed(distinct, dims, products, "double")
    part = np.array(rest, float)
    scatter = np.triu(scatter - np.outer(part, part / n))
    scatter += np.triu(scatter, 1).T
    columns = one_sided_jacobi(pivoted_cholesky(scatter))
    length = np.sqrt((columns**2).sum(0))
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return None
    units = columns[:, order] / length[order]
    units *= np.where(units[np.abs(units).argmax(0), np.arange(len(order))] < 0, -1, 1)
    return Whitening(dims, n, about, rest, length[order] ** 2 / n, units, float(np.trace(scatter)) / n)


def identity_error(distinct: DataFrame, model: Whitening, k: int) -> float:
    """How far the covariance of the whitened fit list is from the identity, at the worst entry."""
    k = min(k, len(model.eigenvalues))

    def add(x):
        w = model.project(x, k)
        return np.r_[w.sum(0), (w.T @ w).ravel()]

    sums = _summed(distinct, model.dims, add, "double") / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(embeddings: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``SCHEMA``: for each row with a usable vector its coordinate on each of the first ``k`` components, with unit variance.

    The components are those of the distinct vectors, on the grid of ``grid_vectors``. Rows without a usable vector go, and rows
    whose vector is not as long as most distinct ones. Repeated rows and null ids each have their own rows. Components without
    variance have no coordinates: a rank below ``k`` gives fewer rows, a single distinct vector or an empty table none.
    ``deviation`` is null where it does not fit a bigint. Components of equal variance are any basis of their space.
    """
    vectors = grid_vectors(embeddings, id_col, vector_col)
    distinct = distinct_vectors(vectors)
    dims = commonest_length(distinct)
    distinct = distinct.filter(F.size("x") == dims)
    model = fit(distinct, dims) if dims else None
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    k = min(k, len(model.eigenvalues))
    error, shared = identity_error(distinct, model, k), model.eigenvalues[:k] / model.trace

    def work(batches):
        for part, x in _matrices(batches, dims):
            m = len(x)
            yield {
                "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m), "n": np.full(m * k, model.n),
                "deviation": [v for v in model.deviations(x) for _ in range(k)],
                "whitened": model.project(x, k).ravel(),
                "explained": np.tile(shared, m), "identity_error": np.full(m * k, error),
            }

    return map_arrow(vectors.filter(F.size("x") == dims), work, SCHEMA)
