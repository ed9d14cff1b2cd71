"""Whitening of embeddings by their leading principal components, found with LOBPCG.

Vectors become integers first (floor(SCALE * entry) + SHIFT), so that count and sums are exact. The covariance is never built: each step
multiplies it with a block of directions, every task adding up centred rows times (centred rows times block), the tasks' sums being
added by row of the block in the tasks' order. The driver holds blocks of dimension x three times the components, no vectors. Each step does Rayleigh-Ritz on
the span of iterate, residuals and previous directions (LOBPCG); it ends when every wanted component's residual |Vx - ex| is at most RESIDUAL of the largest
eigenvalue, measured with products of that very block, or else with an error.

Rows whose vector is null, has null, NaN or infinite entries, or another length than most rows (on a tie the longer) are left out. Components whose eigenvalue
is below ZERO of the trace cannot be scaled to one and are left out, so constant vectors or a single one have none; an empty table has none. Rows alike count
as often as they occur. Any other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.llm.common import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Directions beyond those wanted, so that the last ones converge as fast as the first.
GUARD = 8
RESIDUAL = 1e-12
#: Where rounding of the products stops the residuals short of that, this much is still a certificate.
FLOOR = 1e-9
STEPS = 300
ZERO = 1e-12
#: Rows that are centred at once.
ROWS = 4096


@dataclass
class Whitening:
    """n vectors with sums `sums` (exact); unit components as columns, eigenvalues falling; trace; largest residual; identity_error."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    identity_error: float = 0.0

    @property
    def whole(self) -> np.ndarray:
        """The whole part of the mean; the rest is below one, so that x - mean loses nothing."""
        return self.sums // max(self.n, 1)

    @property
    def rest(self) -> np.ndarray:
        return (self.sums - self.whole * self.n) / max(self.n, 1)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The usable rows, as a struct `row`, and their integer vector `x`, written."""
    v = F.col(vector)
    fine = v.isNotNull() & F.forall(v, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    usable = rows.where(fine).select(F.struct(*(F.col(c) for c in rows.columns)).alias("row"), x.cast("array<bigint>").alias("x"))
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    return materialize(usable.where(F.size("x") == (lengths[0].d if lengths else 0)))


def _blocks(batches: Iterator[pa.RecordBatch], d: int, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for _, x in _blocks(batches, d, 0):
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "s"])

    return run


def _product(model: Whitening, block: np.ndarray):
    """Each task's sum of centred rows times (centred rows times block), row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(block.shape), False
        for _, x in _blocks(batches, len(block), 0):
            c = model.centred(x)
            total, seen = total + c.T @ (c @ block), True
        if seen:
            task = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(np.full(len(total), task)), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "task", "v"])

    return run


def _gram(model: Whitening, scaled: np.ndarray):
    """Each task's sums of products of whitened rows with one another and with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = scaled.shape[1] + 1
        total, seen = np.zeros((k, k)), False
        for _, x in _blocks(batches, len(scaled), 0):
            w = np.hstack([model.centred(x) @ scaled, np.ones((len(x), 1))])
            total, seen = total + w.T @ w, True
        if seen:
            task = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array(np.arange(k)), pa.array(np.full(k, task)), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "task", "v"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """One row of the block: the sum of all tasks' parts in the tasks' order."""
    order = np.argsort(table["task"].to_numpy(), kind="stable")
    parts = [np.frombuffer(v, np.float64) for v in table["v"].to_pylist()]
    total = np.zeros(len(parts[0]))
    for j in order:
        total = total + parts[j]
    return pa.table({"i": table["i"][:1], "v": pa.array([total.tobytes()], pa.binary())})


def _collected(parts: DataFrame) -> np.ndarray:
    """Tasks' blocks (i, task, v) added up; a group holds a row of a block for each task."""
    rows = parts.groupBy("i").applyInArrow(_added, "i long, v binary").collect()
    return np.stack([np.frombuffer(bytes(r.v), np.float64) for r in sorted(rows, key=lambda r: r.i)])


def _orthonormal(x: np.ndarray, more: np.ndarray) -> np.ndarray:
    """x (orthonormal) and an orthonormal basis of what more adds to its span."""
    for _ in range(2):
        more = more - x @ (x.T @ more)
    size = np.linalg.norm(more, axis=0)
    more = more[:, size > 0] / size[size > 0]
    for _ in range(2):
        more = more - x @ (x.T @ more)
    u, s, _ = np.linalg.svd(more, full_matrices=False)
    u = u[:, s > 1e-8][:, : len(x) - x.shape[1]]
    return np.linalg.qr(np.hstack([x, u]))[0]


def lobpcg(product, d: int, wanted: int, guard: int = GUARD, residual: float = RESIDUAL) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors as columns, and the largest residual over the largest eigenvalue.

    product: multiplies the symmetric, positive semidefinite matrix with a block of columns.
    """
    m, wanted = min(d, wanted + guard), min(d, wanted)
    x = np.linalg.qr(np.random.default_rng(7).standard_normal((d, m)))[0]
    more, best, stuck = np.zeros((d, 0)), np.inf, 0
    for _ in range(STEPS):
        basis = _orthonormal(x, more) if more.shape[1] else x
        image = product(basis)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:m], turn[:, ::-1][:, :m]
        previous = basis[:, m:] @ turn[m:]
        x, vx = basis @ turn, image @ turn
        rest = vx - x * values
        worst = float(np.linalg.norm(rest[:, :wanted], axis=0).max() / max(values[0], 1e-300)) if values[0] > 0 else 0.0
        if worst <= residual:
            break
        best, stuck = (worst, 0) if worst < 0.5 * best else (best, stuck + 1)
        if stuck >= 6 and worst <= FLOOR:  # rounding holds it up
            break
        more = np.hstack([rest, previous])
    else:
        raise ArithmeticError(f"components are not certain after {STEPS} steps: residual {worst:.3g}")
    return values[:wanted], x[:, :wanted], worst


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of a table of integers()."""
    x = vectors.select("x")
    head = x.head(1)
    if not head or not head[0].x:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    d = len(head[0].x)
    parts = x.mapInArrow(_sums(d), "n long, s array<long>")
    n = parts.agg(F.sum("n")).first()[0]
    by_dim = parts.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    model = Whitening(n, np.array([r.v for r in sorted(by_dim, key=lambda r: r.i)], np.int64), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    kind = "i long, task long, v binary"
    norms = x.mapInArrow(_norms(model), "v double").agg(F.sum("v")).first()[0]
    model.trace = float(norms) / n
    values, vectors_, worst = lobpcg(lambda block: _collected(x.mapInArrow(_product(model, block), kind)) / n, d, components)
    keep = values > ZERO * max(model.trace, 0) if model.trace > 0 else np.zeros(len(values), bool)
    model.components, model.values, model.residual = vectors_[:, keep], values[keep], worst
    if keep.any():
        gram = _collected(x.mapInArrow(_gram(model, model.components / np.sqrt(model.values)), kind)) / n
        cov = gram[:-1, :-1] - np.outer(gram[:-1, -1], gram[-1, :-1])
        model.identity_error = float(np.abs(cov - np.eye(len(cov))).max())
    return model


def _norms(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for _, x in _blocks(batches, len(model.sums), 0):
            total += float((model.centred(x) ** 2).sum())
        yield pa.record_batch([pa.array([total])], names=["v"])

    return run


def _whitened(model: Whitening):
    """row, x: the row, its whitened values and sum over (n * x - sum) ** 2, exact whatever its size."""
    scaled = model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, len(model.sums), 1):
            w = model.centred(x) @ scaled
            reach = model.n * (int(np.abs(x - model.whole).max()) + 1)
            far = x.astype(object) if reach * reach * x.shape[1] >= 2**63 else x
            off = far * model.n - model.sums
            deviation = pa.array([int(v) for v in (off * off).sum(axis=1)], pa.decimal128(38, 0))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.record_batch([part.column(0), values, deviation], names=["row", "whitened", "deviation"])

    return run


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """row, whitened (a value for each component), deviation (decimal) for every row of integers()."""
    schema = T.StructType([vectors.schema["row"], *T.StructType.fromDDL("whitened array<double>, deviation decimal(38,0)").fields])
    if not model.n:
        return vectors.sparkSession.createDataFrame([], schema)
    return vectors.select("row", "x").mapInArrow(_whitened(model), schema)
