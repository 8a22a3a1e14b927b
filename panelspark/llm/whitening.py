"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance is never formed. Each step is a pass over the stored vectors that sums X'(XQ) for a
few columns Q, X being centred first; tasks return matrices of dimension x columns, whatever the
number of vectors. A Chebyshev recurrence of such passes damps the part of the spectrum below the
block's least Ritz value, a QR step makes the block orthonormal again, and a Rayleigh-Ritz step
gives eigenpairs with their residuals. The pairs are certified when all residuals are within
rounding and a block with fresh random guard columns finds no larger eigenvalue.

Entries become whole numbers first, so counts, sums, means and deviations are exact. The fit
uses each distinct vector once, so copies don't weigh; all rows are projected.

Rows whose vector is null or holds null or non-finite entries are left out. Shorter vectors, empty
ones too, count as padded with the entry 0. Repeated rows and null or repeated ids give rows as
any. Entries beyond 2**62 in size count as 2**62. Components without variance (fewer distinct
vectors than dimensions) don't exist, so equal vectors or an empty table give no rows. A deviation that
no long can hold is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import Batches
from panelspark.session import materialize

SCALE, OFFSET = 64, 1_000_000

#: Vectors of a stored block.
BLOCK = 4096

#: Matrices that the driver adds up itself; more are added in tasks first.
FAN_IN = 256

#: Steps of the Lanczos run that bounds the spectrum, and degree of a filter at most.
BOUND_STEPS, DEGREE = 10, 12

#: Growth of the largest direction in a filter, so that smaller ones stay within double precision.
GROWTH = 1e8

#: Residuals, relative to the largest eigenvalue: certified at once, or when they no longer fall.
EXACT, ACCEPTED = 2e-15, 1e-11

#: Eigenvalues below this share of the largest are zero but for rounding.
ZERO = 1e-11

ROUNDS = 60


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` distinct vectors, their sums, and per component eigenvalue and unit vector (a column)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return _centre(self.n, self.sums)


def _centre(n: int, sums) -> tuple[np.ndarray, np.ndarray]:
    """The mean as a whole number and a remainder, so that centring is exact but for one rounding."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    rest = [(s - n * w) / n for s, w in zip(sums, whole, strict=True)]
    return np.array(whole, np.int64), np.array(rest, np.float64)


def _whole(column: pa.Array, scale: int, offset: int, width: int) -> np.ndarray:
    """floor(scale * entry) + offset of a list column, padded to a width."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(scale * flat), -float(1 << 62), float(1 << 62)).astype(np.int64) + offset
    if len(sizes) and (sizes == width).all():
        return whole.reshape(len(sizes), width)
    grid = np.full((len(sizes), width), offset, np.int64)
    grid[np.arange(width) < sizes[:, None]] = whole
    return grid


def _usable(df: DataFrame, vector: str) -> DataFrame:
    wide = F.col(vector).cast("array<double>")
    return df.filter(F.col(vector).isNotNull() & F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def _encode(grid: np.ndarray) -> list[bytes]:
    """A row's whole numbers as bytes; equal rows are equal bytes."""
    small = (np.abs(grid) < 1 << 31).all(1)
    narrow = grid.astype("<i4")
    return [b"4" + narrow[i].tobytes() if s else b"8" + grid[i].astype("<i8").tobytes() for i, s in enumerate(small.tolist())]


def _decode(code: bytes) -> np.ndarray:
    return np.frombuffer(code, f"<i{code[:1].decode()}", offset=1)


def _blocks(df: DataFrame, vector: str, scale: int, offset: int, width: int) -> DataFrame:
    """Each distinct vector once, in stored blocks: rows, size of an entry in bytes, and the entries less ``offset``."""

    def codes(batches: Batches) -> Batches:
        for batch in batches:
            grid = _whole(batch.column(0), scale, offset, width) - offset
            yield pa.RecordBatch.from_arrays([pa.array(_encode(grid), pa.binary())], names=["code"])

    def pack(batches: Batches) -> Batches:
        def block(codes: list[bytes]) -> pa.RecordBatch:
            grid = np.stack([_decode(c).astype("<i8") for c in codes])
            size = next(s for s in (2, 4, 8) if s == 8 or np.abs(grid).max(initial=0) < 1 << (8 * s - 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([len(codes)], pa.int32()), pa.array([size], pa.int32()), pa.array([grid.astype(f"<i{size}").tobytes()], pa.binary())],
                names=["rows", "size", "grid"])

        waiting: list[bytes] = []
        for batch in batches:
            waiting += batch.column(0).to_pylist()
            while len(waiting) >= BLOCK:
                yield block(waiting[:BLOCK])
                waiting = waiting[BLOCK:]
        if waiting:
            yield block(waiting)

    distinct = df.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(codes, "code binary").distinct()
    return materialize(distinct.mapInArrow(pack, "rows int, size int, grid binary"), "whitening-vectors")


def _grids(batches: Batches, width: int, offset: int):
    for batch in batches:
        for rows, size, grid in zip(*(batch.column(n).to_pylist() for n in ("rows", "size", "grid")), strict=True):
            yield np.frombuffer(grid, f"<i{size}").reshape(rows, width).astype(np.int64) + offset


def _total(blocks: DataFrame, function: Callable[[np.ndarray], np.ndarray], width: int, offset: int) -> np.ndarray:
    """The sum over all blocks of a matrix of fixed shape computed from each, 8 bytes an entry."""

    def run(batches: Batches) -> Batches:
        total = None
        for grid in _grids(batches, width, offset):
            part = function(grid)
            total = part if total is None else total + part
        if total is not None:
            yield _matrix(total)

    def add(batches: Batches) -> Batches:
        total = None
        for batch in batches:
            for kind, part in zip(batch.column("kind").to_pylist(), batch.column("part").to_pylist(), strict=True):
                part = np.frombuffer(part, kind)
                total = part if total is None else total + part
        if total is not None:
            yield _matrix(total)

    schema = "kind string, part binary"
    parts = blocks.mapInArrow(run, schema)
    n_parts = blocks.rdd.getNumPartitions()
    while n_parts > FAN_IN:
        n_parts = -(-n_parts // FAN_IN)
        parts = parts.repartition(n_parts).mapInArrow(add, schema)
    found = [np.frombuffer(r.part, r.kind) for r in parts.collect()]
    return np.sum(found, axis=0)


def _matrix(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.dtype.str]), pa.array([total.tobytes()], pa.binary())], names=["kind", "part"])


class _Passes:
    """Passes of V Q over the stored blocks, V being their covariance."""

    def __init__(self, blocks: DataFrame, n: int, sums, width: int, offset: int):
        self.blocks, self.n, self.sums, self.width, self.offset, self.count = blocks, n, sums, width, offset, 0

    def total(self, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        whole, rest = _centre(self.n, self.sums)
        return _total(self.blocks, lambda grid: function((grid - whole).astype(np.float64) - rest), self.width, self.offset)

    def times(self, q: np.ndarray) -> np.ndarray:
        self.count += 1
        return self.total(lambda x: x.T @ (x @ q)).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0] / self.n)

    def identity_error(self, to_unit: np.ndarray) -> float:
        k = to_unit.shape[1]

        def moments(x: np.ndarray) -> np.ndarray:
            w = x @ to_unit
            return np.vstack([w.T @ w, w.sum(0)[None, :]])

        found = self.total(moments).reshape(k + 1, k) / self.n
        return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max(initial=0.0))


def _lower_bound(v: _Passes, rng: np.random.Generator) -> float:
    """A value below the least eigenvalue: the least Ritz value of a Lanczos run less its residual."""
    q = rng.standard_normal((v.width, 1))
    basis = [q / np.linalg.norm(q)]
    alpha, beta = [], []
    for _ in range(min(BOUND_STEPS, v.width)):
        y = v.times(basis[-1])
        alpha.append(float((basis[-1].T @ y)[0, 0]))
        for b in basis + basis:
            y = y - b * (b.T @ y)
        beta.append(float(np.linalg.norm(y)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)):
            beta[-1] = 0.0
            break
        basis.append(y / beta[-1])
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, float(values[0] - abs(beta[-1] * vectors[-1, 0])))


def _filter(v: _Passes, q: np.ndarray, low: float, high: float, largest: float) -> np.ndarray:
    """The Chebyshev polynomial of V, of absolute value 1 at most on [low, high], times Q."""
    centre, half = (high + low) / 2, (high - low) / 2
    step = np.arccosh(max((largest - centre) / half, 1 + 1e-12))
    degree = int(min(DEGREE, max(2, np.log(2 * GROWTH) // step)))
    before, now = q, (v.times(q) - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, (v.times(now) - centre * now) * (2 / half) - before
    return now


def _ritz(v: _Passes, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, their vectors, and the norms of V q - value q."""
    q, _ = np.linalg.qr(y)
    q, _ = np.linalg.qr(q)
    vq = v.times(q)
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, vq = q @ turn, vq @ turn
    return values, q, np.linalg.norm(vq - q * values, axis=0)


def _eigenpairs(v: _Passes, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    rng = np.random.default_rng(0)
    width = v.width
    block = min(width, 3 * components)
    values, q, residuals = _ritz(v, rng.standard_normal((width, block)))
    wanted = min(components, width)
    if block < width:
        low, worst = _lower_bound(v, rng), np.inf

        def improved(values: np.ndarray, q: np.ndarray):
            high = max(values[-1], low + 1e-9 * values[0])
            return _ritz(v, _filter(v, q, low, high, values[0]))

        for _ in range(ROUNDS):
            last, worst = worst, residuals[:wanted].max() / max(values[0], 1e-300)
            if worst > EXACT * np.sqrt(width) and (worst > ACCEPTED or worst <= last / 2):
                values, q, residuals = improved(values, q)
                continue
            # Fresh guard columns: an eigenvector that the first block missed would show here.
            fresh = _ritz(v, np.hstack([q[:, :wanted], rng.standard_normal((width, block - wanted))]))
            probe = improved(*fresh[:2])
            if (probe[0][:wanted] <= values[:wanted] + 1e-9 * values[0]).all():
                break
            (values, q, residuals), worst = probe, np.inf
        else:
            raise ArithmeticError(f"no certified components after {ROUNDS} rounds: residual {worst:.1e}")
    kept = int((values[:wanted] > ZERO * values[0]).sum()) if values[0] > 0 else 0
    q = q[:, :kept]
    q = q * np.where(q[np.abs(q).argmax(0), np.arange(kept)] < 0, -1.0, 1.0)
    return values[:kept], q, float((residuals[:kept].max(initial=0.0)) / max(values[0], 1e-300))


def fit(df: DataFrame, components: int = 16, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Mean and leading components of the distinct vectors; None if there are none."""
    usable = _usable(df.select(vector), vector)
    width = usable.agg(F.max(F.size(vector))).first()[0]
    if not width:
        return None
    blocks = _blocks(usable, vector, scale, offset, width)

    def counts(grid: np.ndarray) -> np.ndarray:
        # Sums of upper and lower halves, which stay within 64 bits.
        return np.concatenate([[len(grid)], (grid >> 32).sum(0), (grid & 0xFFFFFFFF).sum(0)]).astype("<i8")

    found = [int(x) for x in _total(blocks, counts, width, offset)]
    n, sums = found[0], tuple((h << 32) + low for h, low in zip(found[1 : width + 1], found[width + 1 :], strict=True))
    passes = _Passes(blocks, n, sums, width, offset)
    trace = passes.trace()
    if trace == 0.0:
        return None
    values, vectors, residual = _eigenpairs(passes, components)
    error = passes.identity_error(vectors / np.sqrt(values))
    return Whitening(n, sums, values, vectors, trace, residual, passes.count, error)


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(grid: np.ndarray, model: Whitening, whole: np.ndarray) -> list[int | None]:
    """Sums over dimensions of (n x - S)^2, exact."""
    n = model.n
    rest = [s - n * int(w) for s, w in zip(model.sums, whole, strict=True)]
    most = int(np.abs(grid - whole).max(initial=0)) + 1
    if len(rest) * (n * most) ** 2 < 1 << 62:
        off = (grid - whole) * n - np.array(rest, np.int64)
        return np.einsum("ij,ij->i", off, off).tolist()
    exact = [sum((n * (x - int(w)) - r) ** 2 for x, w, r in zip(row, whole, rest, strict=True)) for row in grid.tolist()]
    return [x if x < 1 << 63 else None for x in exact]


def whiten(
    df: DataFrame, model: Whitening | None, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """A row for each usable row and component: ``vec_id`` and the columns of SCHEMA."""
    key = df.schema[vec_id].dataType.simpleString()
    rows = _usable(df.select(vec_id, vector), vector).select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    schema = f"vec_id {key}, {SCHEMA}"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    whole, rest = model.centre()
    k, width = len(model.values), len(whole)
    to_unit = model.vectors / np.sqrt(model.values)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            grid = _whole(batch.column("v"), scale, offset, width)
            w = ((grid - whole).astype(np.float64) - rest) @ to_unit
            at = np.repeat(np.arange(len(grid)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(grid))),
                pa.array(np.full(len(at), model.n, np.int64)),
                pa.array(_deviations(grid, model, whole), pa.int64()).take(pa.array(at)),
                pa.array(w.ravel()),
                pa.array(np.tile(model.values / model.trace, len(grid))),
                pa.array(np.full(len(at), model.identity_error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
