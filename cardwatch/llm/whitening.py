"""Whitening components of embeddings by shifted CholeskyQR.

The centred rows A (n x d) are never gathered. A pass over the table adds up, task by task, the Gram matrix
of A inv(R): R is what the passes before it have composed, and the triangular solve is made for each batch
of rows on its own. A Cholesky factor of that Gram matrix is composed onto R:

1. the first Gram matrix gets a small shift, so that its factor exists whatever the condition of A;
2. two more passes orthogonalise what the shift and rounding left over. A Gram matrix that is singular (constant or
   dependent dimensions, fewer rows than dimensions) is shifted in pass 2 too; in the last pass its symmetric root
   stands in for the factor.

Then A = Q R with orthonormal Q, and the singular values and right vectors of the small R are those of A.

Entries become whole numbers first, and sums over them are whole numbers, so that centring loses nothing. Partial Gram
matrices are added cell by cell on the executors; the driver sees d * d numbers a pass, whatever the number of rows. A
pass keeps nothing and reads the table again; a lost task is one task done again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Passes that orthogonalise; the first is shifted.
PASSES = 3
#: Entries so large that they are no whole number of 64 bits after scaling count as not finite.
MOST = 2.0**52


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x): the rows that take part, entries as whole numbers floor(1024 c) + 100000.

    Rows go whose vector is null or empty or holds a null, NaN or infinite entry (or one beyond 2**52), and, as they
    lack entries, those whose length is not the most frequent one (of equally frequent ones the largest).
    """
    small = lambda v: F.abs(v.cast("double")) <= MOST
    # Catalyst may compute the entries before the filter, so they hold for any value.
    whole = F.transform(
        F.col(column), lambda v: F.when(small(v), F.floor(v.cast("double") * SCALE) + F.lit(OFFSET))
    )
    fine = F.forall(F.col(column), lambda v: F.coalesce(small(v), F.lit(False)))
    rows = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & fine)
    lengths = rows.groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.agg(F.max_by("d", F.struct("n", "d")).alias("d")).first()["d"]
    return rows.where(F.size(column) == F.lit(best)).select(F.col(id_column).alias("id"), whole.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return pc.list_flatten(x).to_numpy(zero_copy_only=False).reshape(len(x), -1)


@dataclass
class Centre:
    """Number of rows, exact sums and the largest entry's size."""

    n: int
    sums: list[int]
    most: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in 64 bits if they suffice, else as Python's whole numbers."""
        if 2 * self.n * self.most < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


def centre(rows: DataFrame) -> Centre | None:
    """One aggregate a dimension; sums have 38 digits."""
    placed = rows.select(F.posexplode("x").alias("i", "v"))
    sums = (
        placed.groupBy("i")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(18,0)")).alias("s"), F.max(F.abs("v")).alias("most"))
        .orderBy("i").collect()
    )
    return Centre(sums[0]["n"], [int(r["s"]) for r in sums], max(r["most"] for r in sums)) if sums else None


def solve_upper(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a inv(r) for upper triangular r, column by column; a column without a pivot becomes zero."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        rest = a[:, j] - q[:, :j] @ r[:j, j]
        q[:, j] = rest / r[j, j] if r[j, j] else 0.0
    return q


def _cells(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"]
        )


def _partial_gram(batches: Iterator[pa.RecordBatch], at: Centre, factors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if len(batch):
            a = at.centred(_matrix(batch))
            for r in factors:
                a = solve_upper(a, r)
            total = a.T @ a if total is None else total + a.T @ a
    yield from _cells(total)


def _summed(rows: DataFrame, task, d: int) -> np.ndarray:
    """The sum of the tasks' symmetric matrices; at most d (d + 1) / 2 cells reach the driver."""
    cells = rows.mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((d, d))
    for c in cells:
        out[c["i"], c["j"]] = out[c["j"], c["i"]] = c["v"]
    return out


def _factor(gram: np.ndarray, shift: float) -> np.ndarray | None:
    """The upper Cholesky factor, or None if there is none."""
    try:
        return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        return None


def _root(gram: np.ndarray) -> np.ndarray:
    """A symmetric root of a Gram matrix that may be singular."""
    e, v = np.linalg.eigh(gram)
    return (v * np.sqrt(np.maximum(e, 0))) @ v.T


def compose(rows: DataFrame, at: Centre) -> np.ndarray:
    """R of the centred rows, composed of the factors of all passes."""
    d, unit = len(at.sums), np.finfo(float).eps / 2
    factors: list[np.ndarray] = []
    whole = np.eye(d)
    for turn in range(PASSES):
        gram = _summed(rows, partial(_partial_gram, at=at, factors=factors), d)
        shift = 11 * (at.n * d + d * (d + 1)) * unit * float(np.trace(gram))
        if turn == 0:
            # Without any spread there is nothing to factor.
            r = _factor(gram, shift) if shift else np.zeros((d, d))
        elif turn < PASSES - 1:
            r = _factor(gram, 0.0)
            r = _factor(gram, shift) if r is None else r
        else:
            r = _factor(gram, 0.0)
            r = _root(gram) if r is None else r
        if r is None:
            r = _root(gram)
        whole = r @ whole
        factors = [*factors, r]
        if not r.any():
            break
    return whole


@dataclass
class Whitening:
    """``axes`` holds a unit component a column; ``values`` are their eigenvalues, falling; ``trace`` is their sum over all."""

    at: Centre
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.at.centred(x) @ self.axes / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The components of usable rows; those without spread (to double precision) are left out. None without rows."""
    at = centre(rows)
    if at is None:
        return None
    r = compose(rows, at)
    _, sigma, right = np.linalg.svd(r)
    values = sigma**2 / at.n
    there = values > (max(len(values), 8) * np.finfo(float).eps) ** 2 * max(float(values[0]), 1.0) * 1e6
    k = min(components, int(there.sum()))
    return Whitening(at, right[:k].T.copy(), values[:k], float(values.sum()))


def _partial_moments(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """Sums of products of the whitened entries; a last column of ones gives their sums."""
    total = None
    for batch in batches:
        if len(batch):
            w = model.whiten(_matrix(batch))
            w = np.hstack([w, np.ones((len(w), 1))])
            total = w.T @ w if total is None else total + w.T @ w
    yield from _cells(total)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    sums = _summed(rows, partial(_partial_moments, model=model), k + 1) / model.at.n
    covariance = sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k])
    return float(np.abs(covariance - np.eye(k)).max())


_OUT = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def _project(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    for batch in batches:
        m = len(batch)
        if not (m and k):
            continue
        x = _matrix(batch)
        y = model.at.deviations(x)
        # A row's sum of squares may pass 64 bits; Python's whole numbers hold it.
        peak = int(np.abs(y).max())
        y = y if peak * peak * y.shape[1] < 1 << 62 else y.astype(object)
        squares = pa.array([int(s) for s in (y * y).sum(axis=1)], pa.decimal128(38, 0))
        at = np.repeat(np.arange(m), k)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
             pa.array(np.full(m * k, model.at.n)), squares.take(pa.array(at)),
             pa.array(model.whiten(x).reshape(-1)), pa.array(np.tile(model.values / model.trace, m))],
            names=["id", "component", "n", "deviation", "whitened", "explained"],
        )


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    ``n`` counts the usable rows (see ``usable`` for those that go); ``deviation`` is the exact sum over dimensions of
    (n x - S)^2, of up to 38 digits. Components are numbered from 1 by falling eigenvalue; those without spread do not
    exist, so equal rows alone, or a single one, give no rows, as does an empty table. Rows that repeat, ids that
    repeat and null ids take part each. Ties of eigenvalues give some orthonormal basis, the same for all rows. Other
    columns are ignored, whatever their names. Ids are whole numbers.
    """
    rows = usable(vectors.select(F.col(id_column).cast("long").alias(id_column), column), id_column, column)
    model = fit(rows, components)
    if model is None:
        model = Whitening(Centre(0, [], 0), np.zeros((0, 0)), np.zeros(0), 0.0)
    error = identity_error(rows, model)
    return rows.mapInArrow(partial(_project, model=model), _OUT).withColumn("identity_error", F.lit(error))
