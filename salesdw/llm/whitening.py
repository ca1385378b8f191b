"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(64 * c) + 1000000 per entry. The distinct x vectors are the fit list; their number
n and sums S are exact, so an entry is centred without rounding as (n * x - S) / n. The covariance V (divisor n) is never
formed: one pass over the staged fit list gives V @ Q for a block Q of some more columns than components are wanted.
Each partition multiplies its rows, and sums per dimension meet in one small aggregate.

An iteration takes Rayleigh-Ritz vectors of the block from such a pass. Its residuals |V q - e q| certify it: they are
at most ``tolerance`` times the largest eigenvalue, or do not fall any more at 100 times that (else it fails). Otherwise a
Chebyshev polynomial of V, by its three-term recurrence with one pass a degree, damps the spectrum between a lower
bound (from a few Lanczos steps) and the block's last Ritz value, QR makes the columns orthonormal, and the next
iteration begins. The degree follows from the gain that is still needed. What reaches the driver is a block of (dimensions x columns) numbers a pass.

Left out are vectors that are null, empty or hold null or non-finite entries (or
one of 2^40 and more), and those of another length than most
vectors (of equally frequent lengths the longer counts). Repeated vectors count once in the fit; repeated rows each
get their result. Components whose eigenvalue is zero to precision (as of a fit list of few vectors) are not returned,
so a table of equal vectors, like an empty one, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.staging import Staging

SCALE, SHIFT = 64, 1_000_000
GUARD_COLUMNS = 32
LONGEST_DEGREE = 24
LARGEST = 2.0**40  # of an entry, so that whole numbers stay exact


class NotCertified(RuntimeError):
    """The residuals stay above the bound."""


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: rows n, sums per dimension, eigenvalues, their vectors (dimensions x components)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float


def whole_numbers(vector: str) -> Column:
    return F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda c: F.floor(c * SCALE) + SHIFT)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """``row`` (a struct of all columns) and ``x`` of the rows that take part."""
    finite = F.forall(F.col(f"`{vector}`").cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    whole = F.struct(*[F.col(f"`{name}`") for name in rows.columns]).alias("row")
    size = F.size(F.col(f"`{vector}`"))
    taken = rows.where(F.coalesce(finite, F.lit(False)) & (size > 0))
    sizes = taken.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max_by("size", F.struct("n", "size"))).scalar()
    return taken.where(size == most).select(whole, whole_numbers(vector).alias("x"))


def numbers_of(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def gram_pass(fit: DataFrame, n: int, sums: np.ndarray, block: np.ndarray, project: bool = False) -> np.ndarray:
    """V @ block; with ``project`` instead block' V block, from the projected rows themselves. One job."""
    columns = block.shape[1]
    height = columns if project else block.shape[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = numbers_of(batch.column(0))
            if len(x):
                c = centred(x, n, sums)
                y = c @ block
                part = (y if project else c).T @ y
                total = part if total is None else total + part
        if total is not None:
            at = np.arange(height, dtype=np.int32)
            names = [f"c{number}" for number in range(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(at), *map(pa.array, total.T)], names=["at", *names])

    schema = "at int, " + ", ".join(f"c{number} double" for number in range(columns))
    parts = fit.select("x").mapInArrow(rows, schema)
    summed = parts.groupBy("at").agg(*[F.sum(f"c{number}").alias(f"c{number}") for number in range(columns)])
    result = np.zeros((height, columns))
    for row in summed.collect():  # dimensions x columns numbers
        result[row["at"]] = row[1:]
    return result / n


def chebyshev_filter(apply, block: np.ndarray, applied: np.ndarray, degree: int, low: float, high: float) -> np.ndarray:
    """A polynomial of V times ``block`` that is small on [low, high] and grows fast above; ``applied`` is V @ block."""
    middle, half = (high + low) / 2, (high - low) / 2
    before, now = block, (applied - middle * block) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (apply(now) - middle * now) / half - before
        size = np.abs(now).max()
        if size > 1e100:
            before, now = before / size, now / size
    return now


def lower_end(apply, dimensions: int, steps: int = 6) -> float:
    """A bound under the spectrum from a few Lanczos steps: the least Ritz value less the last residual, zero at least."""
    vector = np.random.default_rng(17).standard_normal((dimensions, 1))
    basis, diagonal, beside = [vector / np.linalg.norm(vector)], [], []
    for _ in range(min(steps, dimensions)):
        image = apply(basis[-1])
        diagonal.append(float((basis[-1].T @ image)[0, 0]))
        for _ in range(2):
            for known in basis:
                image = image - known * float((known.T @ image)[0, 0])
        beside.append(float(np.linalg.norm(image)))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(image / beside[-1])
    size = len(diagonal)
    tridiagonal = np.diag(diagonal) + np.diag(beside[: size - 1], 1) + np.diag(beside[: size - 1], -1)
    return max(float(np.linalg.eigvalsh(tridiagonal)[0]) - beside[size - 1], 0.0)


def fit(distinct: DataFrame, components: int = 16, tolerance: float = 2e-14, iterations: int = 60) -> Whitening | None:
    """Fit on a staged list of different vectors ``x``; None for an empty one."""
    dimensions = distinct.select(F.size("x").alias("d")).first()
    if dimensions is None:
        return None
    d = dimensions["d"]
    n = distinct.count()
    per_entry = distinct.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("s"))
    sums = np.zeros(d, np.int64)
    for row in per_entry.collect():  # one row a dimension
        sums[row["at"]] = row["s"]

    passes = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return gram_pass(distinct, n, sums, block)

    trace = total_variance(distinct, n, sums)
    wanted, columns = min(components, d), min(d, components + GUARD_COLUMNS)
    block = np.linalg.qr(np.random.default_rng(13).standard_normal((d, columns)))[0]
    low = lower_end(apply, d) if columns < d else 0.0
    last = math.inf
    for _ in range(iterations):
        applied = apply(block)
        ritz, turn = np.linalg.eigh((block.T @ applied + applied.T @ block) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, applied = block @ turn, applied @ turn
        if ritz[0] <= 0:
            return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), trace, passes, 0.0)
        residual = float(np.linalg.norm(applied - block * ritz, axis=0)[:wanted].max() / ritz[0])
        if residual <= tolerance or (residual <= 100 * tolerance and residual > last / 2):
            real = ritz[:wanted] > 1e-12 * ritz[0]
            vectors = np.linalg.qr(block)[0][:, :wanted][:, real]
            return Whitening(n, sums, ritz[:wanted][real], vectors, trace, passes, residual)
        last = residual
        high = max(float(ritz[-1]), low + 1e-9 * float(ritz[0]))
        reach = max((2 * float(ritz[wanted - 1]) - high - low) / (high - low), 1 + 1e-9)
        needed = math.log(residual / tolerance) / math.log(reach + math.sqrt(reach * reach - 1))
        degree = int(min(max(math.ceil(needed), 3), LONGEST_DEGREE))
        block = np.linalg.qr(chebyshev_filter(apply, block, applied, degree, low, high))[0]
    raise NotCertified(f"residual {residual:.1e} after {passes} passes")


def total_variance(fit_list: DataFrame, n: int, sums: np.ndarray) -> float:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = centred(numbers_of(batch.column(0)), n, sums) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array([float(np.square(c).sum())])], names=["part"])

    return fit_list.select("x").mapInArrow(rows, "part double").agg(F.sum("part").alias("s")).first()["s"] / n


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, from one pass over the rows."""
    if not len(model.values):
        return 0.0
    covariance = gram_pass(fit_list, model.n, model.sums, model.vectors / np.sqrt(model.values), project=True)
    return float(np.abs(covariance - np.eye(len(model.values))).max())


def whiten(rows: DataFrame, vector: str, staging: Staging, components: int = 16) -> DataFrame:
    """For each row that takes part and component, numbered from 1 by falling eigenvalue: ``row`` (a struct of the row's
    columns), component, n, deviation (sum over dimensions of (n * x - S)^2; one beyond a long fails), whitened,
    explained, identity_error."""
    taken = usable(rows, vector)
    taken = staging.put(taken, "usable-vectors")
    fit_list = staging.put(taken.select("x").dropDuplicates(["x"]), "fit-list")
    model = fit(fit_list, components)
    schema = T.StructType([taken.schema["row"]]).add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit_list, model)
    n, sums, count = model.n, model.sums, len(model.values)
    scaled = model.vectors / np.sqrt(model.values)
    shares = model.values / model.trace

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spread = n * numbers_of(batch.column(1)) - sums
            deviation = exact_squares(spread)
            whitened = (spread / n) @ scaled
            each = pa.array(np.repeat(np.arange(batch.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(np.repeat(deviation, count)),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(shares, batch.num_rows)),
                    pa.array(np.full(len(each), error)),
                ],
                names=["row", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return taken.mapInArrow(results, schema)


def exact_squares(spread: np.ndarray) -> np.ndarray:
    """Row sums of squares; fails where a long cannot hold one."""
    largest = np.square(spread.astype(np.float64)).sum(axis=1).max(initial=0)
    if largest >= 9.2e18:
        raise OverflowError(f"deviation {largest:.3e} is beyond a long")
    return np.square(spread).sum(axis=1)
