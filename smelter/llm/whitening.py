"""Whitening by shifted CholeskyQR.

With the centred rows as a tall matrix A, each pass over the data sums up the small
matrix A^T A on the executors; its Cholesky factor R turns A into A R^-1, whose columns
are closer to orthonormal. The first pass adds a shift, so that rounding can't make the
matrix indefinite. The product of all factors is the R of A = QR. Its singular values
and right singular vectors are those of A, hence the covariance's eigenvalues and
eigenvectors, without having squared the condition number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import Scratch
from smelter.llm.vectors import matrix, whole_vectors

COMPONENTS = 4
#: Passes over the data; three are enough in theory.
MOST_PASSES = 6
#: Distance from the identity at which the columns count as orthonormal.
ORTHONORMAL = 1e-13
#: A singular value below this share of the largest is rounding.
ZERO = 1e-12
ROUNDING = float(np.finfo(np.float64).eps) / 2
#: Sums are kept as high and low part, so that 64 bits hold them for 2^36 rows.
LOW = 26
FOUND = "vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Centre:
    """The number of rows and the sums of their columns, both exact."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part is taken off before anything is rounded."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums)^2 for each row, exact; null where 64 bits don't hold it."""
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        if x.shape[1] * most * most < 1 << 62:
            off = self.n * x - np.array(self.sums, np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = (sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x)
        return [v if v < 1 << 63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """Components as columns, their eigenvalues, shares of the variance and what is left to the identity."""

    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def apply(self, rows: np.ndarray) -> np.ndarray:
        """Centred rows on the components, over the square root of their eigenvalues; NaN where that is 0."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.eigenvalues > 0, 1 / np.sqrt(self.eigenvalues), np.nan)
        return (rows @ self.components) * scale


def cholesky(gram: np.ndarray) -> np.ndarray:
    """Upper R with R^T R = gram; a column that depends on those before it gets a row of zeros."""
    dims = len(gram)
    r = np.zeros_like(gram)
    for j in range(dims):
        pivot = gram[j, j] - r[:j, j] @ r[:j, j]
        if pivot > 16 * dims * ROUNDING * gram[j, j]:
            r[j, j] = np.sqrt(pivot)
            r[j, j + 1 :] = (gram[j, j + 1 :] - r[:j, j] @ r[:j, j + 1 :]) / r[j, j]
    return r


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows R^-1 by substitution, column by column; columns without a pivot become 0."""
    out = np.zeros_like(rows)
    for j in np.flatnonzero(np.diag(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def totals(fit: DataFrame, dims: int) -> Centre:
    """Number of rows and sums of columns, from one row for each task."""

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            n += len(x)
            high += (x >> LOW).sum(axis=0)
            low += (x & ((1 << LOW) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n] * dims, pa.int64()), "j": pa.array(range(dims), pa.int32()), "high": high, "low": low})

    sums = fit.select("x").mapInArrow(part, "n long, j int, high long, low long").groupBy("j").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    rows = sorted(sums.collect())  # one for each dimension
    return Centre(rows[0]["n"] if rows else 0, tuple((r["high"] << LOW) + r["low"] for r in rows))


def gram(fit: DataFrame, dims: int, rows_of, width: int) -> np.ndarray:
    """The sum of q^T q over all rows, where `rows_of` makes `width` columns q from rows x.

    Each task sends its own sum, `width` lists of `width` numbers; only their total goes to the driver.
    """

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            q = rows_of(matrix(batch.column(0), dims))
            total += q.T @ q
        flat = pa.array(total.ravel())
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(width * width), pa.int32()), "value": flat})

    summed = fit.select("x").mapInArrow(part, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(width * width)
    for row in summed.collect():  # width * width numbers, whatever the number of rows
        out[row["at"]] = row["value"]
    return out.reshape(width, width)


def factor(fit: DataFrame, dims: int, centre: Centre) -> np.ndarray:
    """The R of the centred rows' QR decomposition."""
    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray) -> np.ndarray:
        rows = centre.centred(x)
        for r in factors:
            rows = solve(rows, r)
        return rows

    for _ in range(MOST_PASSES):
        found = gram(fit, dims, orthogonalised, dims)
        if not factors:
            shift = 11 * (centre.n * dims + dims * (dims + 1)) * ROUNDING * np.linalg.norm(found, 2)
            kept = np.diag(found) > 0
            found = found + np.diag(np.where(kept, shift, 0))
        elif np.abs(found - np.diag(kept.astype(float))).max(initial=0) <= ORTHONORMAL * dims:
            break
        factors.append(cholesky(found))
        kept = np.diag(factors[-1]) > 0
    whole = np.eye(dims)
    for r in factors:
        whole = r @ whole
    return whole


def whitening(fit: DataFrame, dims: int, centre: Centre, most: int = COMPONENTS) -> Whitening:
    """The first components of the rows of `fit`, each in the direction that makes its largest entry positive."""
    _, sizes, directions = np.linalg.svd(factor(fit, dims, centre))
    sizes = np.where(sizes > ZERO * max(sizes[0], 0), sizes, 0.0)
    components = directions[:most].T
    largest = np.abs(components).argmax(axis=0)
    components = components * np.where(components[largest, range(components.shape[1])] < 0, -1.0, 1.0)
    variances = sizes * sizes / centre.n
    total = variances.sum()
    found = Whitening(components, variances[:most], variances[:most] / total if total else np.zeros(components.shape[1]))
    varying = int((found.eigenvalues > 0).sum())
    if not varying:
        return found
    covariance = gram(fit, dims, lambda x: found.apply(centre.centred(x))[:, :varying], varying) / centre.n
    return Whitening(found.components, found.eigenvalues, found.explained, float(np.abs(covariance - np.eye(varying)).max()))


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """For each usable row of `embeddings` and each of the first components: vec_id, component, n, deviation, whitened, explained, identity_error.

    `whole_vectors` says which rows are usable and makes their vectors x of whole
    numbers. The fit list has each distinct x once: n of them with sums S. `deviation`
    is the sum of (n * x - S)^2, null where it is beyond 64 bits. Components are
    numbered from 1 by falling variance; vectors of d entries have at most d. A component without
    variance has a null `whitened` and an `explained` of 0, and `identity_error` is
    taken over the others (null if there are none). Repeated rows give repeated
    results, a null vec_id stays null, other columns are ignored, a table without
    usable rows gives no rows.
    """
    spark = embeddings.sparkSession
    rows, dims = whole_vectors(embeddings, "vec_id")
    schema = FOUND.format(kind=rows.schema["vec_id"].dataType.simpleString())
    if not dims:
        return spark.createDataFrame([], schema)
    with Scratch(spark) as scratch:
        fit = scratch.write(rows.select("x").distinct(), "fit")
        centre = totals(fit, dims)
        model = whitening(fit, dims, centre, most)
    count = model.components.shape[1]

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            values = model.apply(centre.centred(x)).ravel()
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(each), centre.n)),
                    "deviation": pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
                    "whitened": pa.array(values, mask=np.isnan(values)),
                    "explained": pa.array(np.tile(model.explained, len(x))),
                    "identity_error": pa.array([model.identity_error] * len(each), pa.float64()),
                }
            )

    return rows.mapInArrow(report, schema)
