"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers (``floor(1024 c) + 100000``), so sums and deviations are exact.
The centred rows X are never formed as a whole nor squared: each step multiplies them by a right
vector and their transpose by the left vector that comes out (one pass over
blocks of rows), and reorthogonalises both against all earlier ones. Left vectors
are as long as the table; they are kept as what they are linear in, ``u = X w``
with a ``w`` as wide as a vector, so a task recomputes its part of all of them and a lost
executor loses nothing. The singular vectors of the small bidiagonal matrix, turned back by
the right vectors, are the components; its singular values give the deviations.

A right vector that vanishes (an eigenvalue met twice, a closed subspace) is replaced by a new
one orthogonal to all others. All steps are taken, one per dimension, unless what is left
of the variance is below ``FLAT`` of it; ``steps`` bounds them for very wide vectors, then
the last components are approximate.

Rows whose vector is null or holds a null, NaN or infinite entry are left out, as
are those of another length than most. Equal rows count each. Components of no
variance (below ``FLAT`` of the trace) are left out, so an empty table, a single row
or equal rows give no result. Null keys are kept. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import map_batches
from obsflow.sources.session import scratch_path

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS = 4096
FLAT = 1e-12
_LARGEST = 1 << 62
_WIDEST = Decimal(10) ** 38


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``v`` (doubles) of the rows that count."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where("v IS NOT NULL AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = DOUBLE('Infinity'))")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (common.d if common else 0)).where("size(v) > 0")


def whole_numbers(column: pa.Array) -> np.ndarray:
    """Rows of integers of a list column without nulls; scaled entries beyond 2^62 stay there."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    scaled = np.clip(np.floor(flat * SCALE), -_LARGEST, _LARGEST).astype(np.int64)
    return (scaled + SHIFT).reshape(len(column), -1)


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows packed into binary blocks, stored in the shared folder."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = whole_numbers(batch["v"].slice(at, BLOCK_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["n", "x"])

    path = scratch_path(rows.sparkSession, "whitening-blocks")
    map_batches(rows.select("v"), pack, "n int, x binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _sums(blocks: DataFrame, work: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> list:
    """Sum over all rows of what ``work`` gives for a block, added in a fixed order.

    A task sends one number per place; the driver gets one per place.
    """
    kind = pa.decimal128(38, 0) if exact else pa.float64()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, raw in zip(batch["n"].to_pylist(), batch["x"], strict=True):
                part = work(np.frombuffer(raw.as_buffer(), np.int64).reshape(n, -1))
                total = part if total is None else total + part
        if total is not None:
            values = pa.array([Decimal(int(t)) for t in total], kind) if exact else pa.array(total, kind)
            part_id = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array([part_id] * len(total), pa.int32()), values], names=["place", "part", "value"])

    sums = map_batches(blocks.select("n", "x"), run, f"place int, part int, value {'decimal(38,0)' if exact else 'double'}")
    if exact:
        found = sums.groupBy("place").agg(F.sum("value").alias("value"))
    else:
        found = sums.groupBy("place").agg(F.expr("aggregate(array_sort(collect_list(struct(part, value))), 0D, (s, e) -> s + e.value)").alias("value"))
    return [r.value for r in sorted(found.collect(), key=lambda r: r.place)]


@dataclass(frozen=True)
class Whitening:
    """Fitted components: ``basis`` has one column each, ``variances`` fall."""

    n: int
    sums: tuple[int, ...]
    basis: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


class Centring:
    """Rows less their mean, ``x - S / n``, without rounding before the last step."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        whole = [s // n for s in sums]
        self.whole = np.array(whole, np.int64)
        self.rest = np.array([float(Decimal(s - n * w) / n) for s, w in zip(sums, whole, strict=True)])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest


def _fresh(chance: np.random.Generator, right: list[np.ndarray], width: int) -> np.ndarray:
    """A unit vector at random, orthogonal to the right vectors so far."""
    return _against(chance.standard_normal(width), right)[0]


def _against(r: np.ndarray, vectors: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """``r`` made orthogonal to unit vectors (twice, which is enough) and its length; the direction has length 1."""
    if vectors:
        v = np.stack(vectors)
        for _ in range(2):
            r = r - v.T @ (v @ r)
    length = float(np.linalg.norm(r))
    return (r / length if length else r), length


def bidiagonalise(step: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]], width: int, total: float, steps: int | None = None):
    """Right vectors and the small matrix ``U' X V`` of Golub-Kahan-Lanczos.

    ``step(q, W)`` runs over the rows: with ``t = X q`` it gives ``X' t``, ``t' t`` and
    ``U' t`` where ``U = X W``. ``total`` is the sum of squares of all rows.
    """
    chance = np.random.default_rng(42)
    right: list[np.ndarray] = []
    left: list[np.ndarray] = []
    back: list[np.ndarray] = []
    entries: list[tuple[int, int, float]] = []
    v, beta, seen = _fresh(chance, right, width), 0.0, 0.0
    while len(right) < min(width, steps or width) and total - seen > FLAT * total:
        place = len(right)
        right.append(v)
        q = v - beta * left[-1] if beta else v
        w = np.stack(left, axis=1) if left else np.zeros((width, 0))
        y, square, overlap = step(q, w)
        if left:
            # Reorthogonalised against every earlier left vector; X' of them is known.
            q = q - w @ overlap
            y = y - np.stack(back, axis=1) @ overlap
        alpha = float(np.sqrt(max(0.0, square - float(overlap @ overlap))))
        if beta:
            entries.append((len(left) - 1, place, beta))
        seen += beta * beta
        beta, length = 0.0, 0.0
        if alpha * alpha > FLAT * FLAT * total:
            entries.append((len(left), place, alpha))
            left.append(q / alpha)
            back.append(y / alpha)
            seen += alpha * alpha
            v, length = _against(back[-1] - alpha * v, right)
        if length * length > FLAT * FLAT * total:
            beta = length
        else:
            v = _fresh(chance, right, width)
    small = np.zeros((max(1, len(left)), len(right)))
    for i, k, value in entries:
        if k < len(right):
            small[i, k] = value
    return (np.stack(right, axis=1) if right else np.zeros((width, 0))), small


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums; in Python's integers where 64 bits might not do."""
    return x.astype(object).sum(axis=0) if np.abs(x).max() > 1 << 40 else x.sum(axis=0)


def fit(rows: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """Components of ``v`` of the rows from :func:`usable`; None without rows or variance."""
    blocks = _blocks(rows)
    sizes = blocks.selectExpr("sum(n) AS n", "max(length(x) DIV n) DIV 8 AS width").first()
    if not sizes.n:
        return None
    n, width = int(sizes.n), int(sizes.width)
    sums = tuple(int(s) for s in _sums(blocks, _column_sums, exact=True))
    centred = Centring(n, sums)
    (total,) = _sums(blocks, lambda x: np.array([np.square(centred(x)).sum()]))
    if total <= 0:
        return None

    def step(q: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        def work(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            t = c @ q
            return np.concatenate([c.T @ t, [t @ t], (c @ w).T @ t])

        got = np.array(_sums(blocks, work))
        return got[:width], float(got[width]), got[width + 1 :]

    right, small = bidiagonalise(step, width, total, steps)
    _, values, turn = np.linalg.svd(small)
    basis = right @ turn.T[:, : len(values)]
    variances = values**2 / n
    trace = total / n
    keep = np.flatnonzero(variances > FLAT * trace)[:components]
    basis, variances = basis[:, keep], variances[keep]
    sign = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(len(keep))])
    basis = basis * sign
    scaled, k = basis / np.sqrt(variances), len(keep)

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x) @ scaled
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    got = np.array(_sums(blocks, products))
    mean = got[:k] / n
    error = np.abs(got[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(n, sums, basis, variances, variances / trace, float(error))


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[Decimal | None]:
    """Per row the sum over dimensions of ``(n x - S)^2``, exact; null from 10^38."""
    s = np.array(sums, object)
    reach = n * max(int(np.abs(x).max()), 1) + max(abs(v) for v in sums)
    far = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums))) if reach < 1 << 63 else _LARGEST
    if reach < 1 << 62 and far * far * len(sums) < 1 << 63:
        exact = np.square(n * x - s.astype(np.int64)).sum(axis=1).tolist()
    else:
        exact = [sum(e * e for e in row) for row in (n * x.astype(object) - s)]
    return [Decimal(int(e)) if e < _WIDEST else None for e in exact]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``key``, ``deviation`` (decimal) and ``whitened`` (one number per component) of rows from :func:`usable`."""
    kind = rows.schema["key"].dataType.simpleString()
    centred = Centring(model.n, model.sums)
    scaled = model.basis / np.sqrt(model.variances)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                x = whole_numbers(piece["v"])
                y = centred(x) @ scaled
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
                far = pa.array(deviations(x, model.n, model.sums), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([piece["key"], far, lists], names=["key", "deviation", "whitened"])

    return map_batches(rows, work, f"key {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """One row per usable vector and component, numbered from 1 by falling variance.

    Columns: ``key``, ``component``, ``n``, ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.
    """
    rows = usable(vectors, key, vector)
    model = fit(rows, components, steps)
    kind = rows.schema["key"].dataType.simpleString()
    if model is None:
        schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    long = transform(rows, model).select("key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return long.select(
        F.col("key").alias(key),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
