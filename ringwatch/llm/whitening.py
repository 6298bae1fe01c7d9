"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed: all that is asked of the data are products of the centred vectors with a
thin block, computed by Spark over all rows and summed there. A search subspace is grown by the solutions
of projected correction equations, one for every eigenpair that is not found yet, solved together by a few
steps of MINRES, each of which is one product. Rayleigh-Ritz takes the best pairs out of the subspace;
those whose residual has reached double precision are locked, in order, until all are.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, cut, longs, mapped, pick

COMPONENTS = 32
#: Extra directions kept beside the wanted ones, and MINRES steps for one round of corrections.
GUARD, INNER_STEPS = 4, 12
#: Eigenvalues below this share of the greatest are rounding, not spread.
RANK_SHARE = 1e-13
UNIT, SHIFT = 64, 1_000_000
#: Components beyond this would not fit exact whole-number sums.
LARGEST = 2.0 ** 40


@dataclass(frozen=True)
class Whitening:
    """The fit: ``n`` vectors, exact sums per dimension (without the shift), eigenvalues, eigenvectors as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """Rows minus the mean: the whole part of the mean is taken off exactly, the rest as a double."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (whole - base) - rest

    def deviations(self, whole: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of (n * x - S)^2 for each row, as decimal(38, 0)."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        offset = whole - base
        reach = (int(np.abs(offset).max(initial=0)) + 1) * self.n
        kind = pa.decimal128(38, 0)
        if reach * reach * self.dim < 2 ** 63:
            gaps = offset * self.n - rest
            return pa.array((gaps * gaps).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(kind)
        # Too large for 64 bits: the square is taken apart, and its three sums are joined as whole numbers of any size.
        if reach * max(reach // self.n, self.n) * self.dim >= 2 ** 63:
            offset, rest = offset.astype(object), rest.astype(object)
        squares, mixed, fixed = (offset * offset).sum(axis=1), (offset * rest).sum(axis=1), sum(int(r) ** 2 for r in rest)
        exact = [self.n * self.n * int(s) - 2 * self.n * int(m) + fixed for s, m in zip(squares, mixed)]
        return pa.array([decimal.Decimal(e) for e in exact], kind)


def whole_vectors(table: DataFrame) -> DataFrame:
    """vec_id, x: floor(64 * c) of every usable vector as a written table; the constant shift cancels out when centred.

    A vector is usable if it is not null, holds neither null nor non-finite entries and has the length that
    most such vectors have (of several, the greatest; empty vectors never).
    """
    vectors = pick(table, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    usable = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    sizes = usable.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    chosen = sizes.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = chosen[0]["dim"] if chosen else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = _matrix(batch.column(1), np.float64, dim)
            if np.abs(entries).max(initial=0.0) > LARGEST / UNIT:
                raise OverflowError(f"an entry is beyond {LARGEST / UNIT}: exact sums of its squares do not fit")
            yield batch_of(vec_id=batch.column(0), x=_lists(np.floor(entries * UNIT).astype(np.int64)))

    kind = usable.schema["vec_id"].dataType.simpleString()
    return cut(mapped(usable.filter(F.size("embedding") == dim), work, f"vec_id {kind}, x array<bigint>"))


def _matrix(column: pa.Array, kind: type, dim: int) -> np.ndarray:
    """The lists of a column, all of the same length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), dim)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def _summed(rows: DataFrame, task: Callable[[Iterator[np.ndarray]], np.ndarray | None], dim: int, width: int) -> np.ndarray:
    """The sum over all tasks of a ``dim`` x ``width`` matrix of doubles, added up by Spark row by row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = task(_matrix(b.column(0), np.int64, -1) for b in batches if b.num_rows)
        if total is not None:
            yield batch_of(j=pa.array(np.arange(len(total), dtype=np.int32)), p=_lists(total))

    parts = mapped(rows.select("x"), work, "j int, p array<double>")
    added = parts.groupBy("j").agg(F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(width)]).alias("p"))
    out = np.zeros((dim, width))
    for row in added.collect():
        out[row["j"]] = row["p"]
    return out


def _matrix_task(make: Callable[[np.ndarray], np.ndarray]):
    """A task's work for ``_summed``: ``make`` of every batch, added up."""
    def task(batches: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for whole in batches:
            part = make(whole)
            total = part if total is None else total + part
        return total
    return task


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = 42) -> Whitening | None:
    """Eigenpairs of the covariance of ``whole_vectors``; None where there are none."""
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if not n:
        return None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(dim, dtype=object)
        for batch in batches:
            totals = totals + _matrix(batch.column(0), np.int64, dim).sum(axis=0)
        yield batch_of(j=pa.array(np.arange(dim, dtype=np.int32)), s=longs(totals.astype(np.int64)))

    sums = mapped(rows.select("x"), task, "j int, s bigint").groupBy("j").agg(F.sum("s").alias("s")).orderBy("j").collect()
    mean = Whitening(n, [row["s"] for row in sums], np.zeros(0), np.zeros((dim, 0)), 0.0)
    squares = _summed(rows, _matrix_task(lambda whole: (mean.centred(whole) ** 2).sum(axis=0)[:, None]), dim, 1)
    trace = float(squares.sum()) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(whole: np.ndarray) -> np.ndarray:
            centred = mean.centred(whole)
            return centred.T @ (centred @ block)
        return _summed(rows, _matrix_task(part), dim, block.shape[1]) / n

    values, vectors = eigenpairs(product, dim, min(components, dim), trace, seed)
    return Whitening(n, mean.sums, values, vectors, trace)


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, trace: float,
               seed: int = 42, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenpairs of a symmetric positive semidefinite operator, by falling eigenvalue.

    ``product`` applies it to a block of columns. Pairs of eigenvalue zero, up to rounding, are left out.
    """
    if trace <= 0 or not wanted:
        return np.zeros(0), np.zeros((dim, 0))
    width = min(dim, wanted + GUARD)
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(dim, width)), np.zeros((dim, 0)))
    image = product(basis)
    for _ in range(rounds):
        gram = basis.T @ image
        values, turn = np.linalg.eigh((gram + gram.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = basis @ turn, image @ turn
        residual = ritz_image - ritz * values
        goal = 8 * np.finfo(float).eps * math.sqrt(dim) * values[0]
        settled = np.linalg.norm(residual[:, :wanted], axis=0) <= goal
        locked = int(np.argmin(settled)) if not settled.all() else wanted
        if locked == wanted or basis.shape[1] == dim:
            kept = int((values[:wanted] > RANK_SHARE * values[0]).sum())
            # One more turn on the subspace itself takes off what the long products have rounded.
            return values[:kept], _orthonormal(ritz[:, :kept], np.zeros((dim, 0)))
        # Locked pairs come first in the subspace and stay in it; corrections are sought for the open ones.
        sought = np.flatnonzero(~settled)
        sought = sought[sought >= locked]
        steps = _corrections(product, ritz[:, :wanted], values[sought], residual[:, sought])
        if basis.shape[1] + len(sought) > min(dim, 3 * width):
            basis, image = ritz[:, :width], ritz_image[:, :width]
        fresh = _orthonormal(steps, basis)
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + basis.shape[1]).normal(size=(dim, len(sought))), basis)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"{wanted - locked} of {wanted} eigenpairs had not settled after {rounds} rounds")


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns spanning ``block`` outside of ``against``, to full precision; directions that vanish are left out."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    kept = against
    for column in block.T:
        for _ in range(3):
            before = np.linalg.norm(column)
            column = column - kept @ (kept.T @ column)
            after = np.linalg.norm(column)
            if after > 0.7 * before:
                break
        if kept.shape[1] < len(column) and after > 1e-12:
            kept = np.hstack([kept, (column / after)[:, None]])
    return kept[:, against.shape[1]:]


def _corrections(product: Callable[[np.ndarray], np.ndarray], found: np.ndarray, shifts: np.ndarray,
                 residual: np.ndarray) -> np.ndarray:
    """Approximate solutions t of (I - QQ')(A - s I)(I - QQ') t = -r for every column, with Q = ``found``, by MINRES.

    All columns take their steps together, so a step is one product of the data; a column that has reached
    a hundredth of its residual, or whose Krylov space is exhausted, rests.
    """
    def outside(block: np.ndarray) -> np.ndarray:
        return block - found @ (found.T @ block)

    now = outside(-residual)
    size = np.linalg.norm(now, axis=0)
    start = np.where(size > 0, size, 1.0)
    solution, old = np.zeros_like(now), np.zeros_like(now)
    now = now / start
    step, step_before = np.zeros_like(now), np.zeros_like(now)
    beta, left = np.zeros_like(size), size.copy()
    cos, sin, cos_before, sin_before = (np.ones_like(size), np.zeros_like(size), np.ones_like(size), np.zeros_like(size))
    going = size > 0
    for _ in range(INNER_STEPS):
        if not going.any():
            break
        # Lanczos: the next direction, orthogonal to the last two.
        image = outside(product(now) - now * shifts)
        alpha = (now * image).sum(axis=0)
        ahead = image - now * alpha - old * beta
        beta_next = np.linalg.norm(ahead, axis=0)
        # The two rotations before act on the new column of the tridiagonal matrix; a third one clears it.
        far = sin_before * beta
        near = cos_before * beta
        middle = cos * near + sin * alpha
        diagonal = -sin * near + cos * alpha
        length = np.hypot(diagonal, beta_next)
        safe = np.where(length > 0, length, 1.0)
        going &= length > 0
        cos_next, sin_next = diagonal / safe, beta_next / safe
        direction = (now - step * middle - step_before * far) / safe
        solution = solution + np.where(going, cos_next * left, 0.0) * direction
        left = -sin_next * left
        step_before, step = step, direction
        cos_before, sin_before, cos, sin = cos, sin, cos_next, sin_next
        going &= (np.abs(left) > 0.01 * size) & (beta_next > 1e-14 * np.abs(shifts).max(initial=1e-300))
        old, now = now, ahead / np.where(beta_next > 0, beta_next, 1.0)
        beta = beta_next
    return outside(solution)


def whiten(rows: DataFrame, fitted: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for the rows of ``whole_vectors``."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema)
    scaled = fitted.vectors / np.sqrt(fitted.values)
    width, explained = len(fitted.values), fitted.values / fitted.trace
    means = _summed(rows, _matrix_task(lambda whole: (fitted.centred(whole) @ scaled).sum(axis=0)[:, None]), width, 1)[:, 0] / fitted.n

    def square(whole: np.ndarray) -> np.ndarray:
        gaps = fitted.centred(whole) @ scaled - means
        return gaps.T @ gaps

    spread = _summed(rows, _matrix_task(square), width, width) / fitted.n
    error = float(np.abs(spread - np.eye(width)).max())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch.column(1), np.int64, fitted.dim)
            count = len(whole)
            yield batch_of(
                vec_id=batch.column(0).take(pa.array(np.repeat(np.arange(count), width))),
                component=pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                n=longs(np.full(count * width, fitted.n)),
                deviation=fitted.deviations(whole).take(pa.array(np.repeat(np.arange(count), width))),
                whitened=pa.array((fitted.centred(whole) @ scaled).ravel()),
                explained=pa.array(np.tile(explained, count)),
                identity_error=pa.array(np.full(count * width, error)))

    return mapped(rows, work, schema)


def whitened(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable vector (vec_id, embedding), one row per vector and component.

    Vectors that are null, hold null or non-finite entries, are empty or differ in length from most take no
    part and give no rows. ``deviation`` is exact up to 38 digits. Repeated ids and vectors count and come out as often as they are there. Null ids
    are kept. Fewer components than asked for come out where the vectors span fewer directions; equal
    vectors and an empty table give no rows. Entries beyond 2^34 are refused. Other columns are ignored.
    """
    rows = whole_vectors(table)
    return whiten(rows, fit(rows, components))
