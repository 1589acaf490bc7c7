"""Whitened principal components of vectors, from a covariance that loses nothing to rounding."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.embedding_dedup import matrix
from duplexa.llm.scratch import Scratch
from duplexa.llm.worker_cache import claim

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: floor(SCALE * c) is held within this, so that doubles hold it and what is subtracted from it.
LARGEST = 2.0**52
#: Rows whose products are summed at once, bits of a slice, slices of a double-double: sums of
#: ROWS products of two slices have log2(ROWS) + 2 * BITS <= 53 bits, so BLAS gives them exactly.
ROWS, BITS, SLICES = 1024, 21, 5
#: Groups that tasks' partial sums are merged in before the last merge.
FAN = 64
#: A component with no more than this share of the first one's variance has none.
NO_VARIANCE = 1e-13
LIMIT = 2**63 - 1
#: Refining steps at most, and the change after which none follows: it is squared by the next.
STEPS, ENOUGH = 6, 1e-10


def present(column: str) -> F.Column:
    """True for vectors that are not null and have only finite components."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & fine, F.lit(False))


def two_sum(a, b):
    """The rounded sum and, exactly, what rounding took from it."""
    s = a + b
    other = s - a
    return s, (a - (s - other)) + (b - other)


def scaled(rows: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) as doubles. OFFSET is left out: it cancels wherever a mean is subtracted."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * rows), -LARGEST, LARGEST)


def centred(rows: np.ndarray, mean: tuple[np.ndarray, np.ndarray]):
    """rows - mean as high and low parts, for a mean in high and low parts."""
    high, low = two_sum(rows, -mean[0])
    return two_sum(high, low - mean[1])


def sliced(high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """Slices of BITS bits that add up to high + low, cut off by adding and subtracting a power of two by column."""
    out = []
    for _ in range(SLICES):
        _, exponent = np.frexp(np.abs(high).max(axis=0, initial=0.0))
        cut = np.ldexp(1.0, exponent + 53 - BITS)
        part = (high + cut) - cut
        high, low = two_sum(high - part, low)
        out.append(part)
    return out


def add_products(total, high: np.ndarray, low: np.ndarray):
    """total, high and low parts, plus the outer products of the rows with themselves.

    Products of two slices are summed exactly by a matrix product; those sums are added to
    the total with the rounding of each addition kept in the low part.
    """
    for at in range(0, len(high), ROWS):
        parts = sliced(high[at : at + ROWS], low[at : at + ROWS])
        # The smallest first.
        for order in range(SLICES - 1, -1, -1):
            for i in range(order + 1):
                sum_, lost = two_sum(total[0], parts[i].T @ parts[order - i])
                total = sum_, total[1] + lost
        total = two_sum(*total)
    return total


def _sums(batches):
    """By dimension: sums of floor(SCALE * c) in two halves that 64 bits hold; and the number of rows."""
    n, high, low = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        rows = scaled(matrix(batch.column("vector"))).astype(np.int64)
        if grow := max(0, rows.shape[1] - len(high)):
            high, low = np.pad(high, (0, grow)), np.pad(low, (0, grow))
        n += len(rows)
        high[: rows.shape[1]] += (rows >> 26).sum(axis=0)
        low[: rows.shape[1]] += (rows & (2**26 - 1)).sum(axis=0)
    # Dimension -1 carries the count, which every task has, even of vectors without components.
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(-1, len(high)), pa.int32()), pa.array([n, *high], pa.int64()), pa.array([0, *low], pa.int64())], ["dimension", "high", "low"]
    )


def _products(mean, whole: bool):
    width = len(mean[0])

    def run(batches):
        claim()
        total = np.zeros((width, width)), np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = matrix(batch.column("vector").slice(at, ROWS), width)
                total = add_products(total, *centred(scaled(rows) if whole else rows, mean))
        part = TaskContext.get().partitionId() % FAN
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([part] * width, pa.int32()), pa.array(list(total[0]), pa.list_(pa.float64())), pa.array(list(total[1]), pa.list_(pa.float64()))],
            ["dimension", "part", "high", "low"],
        )

    return run


def _merge(keys, batches):
    """One row of the matrix: high parts of all tasks added with the rounding kept, low parts beside it."""
    total = None
    for batch in batches:
        for high, low in zip(batch.column("high"), batch.column("low")):
            high, low = (np.array(v.values.to_numpy(zero_copy_only=False)) for v in (high, low))
            if total is not None:
                high, lost = two_sum(total[0], high)
                low = low + total[1] + lost
            total = two_sum(high, low)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k.as_py()], pa.int32()) for k in keys] + [pa.array([list(t)], pa.list_(pa.float64())) for t in total], ["dimension", "part"][: len(keys)] + ["high", "low"]
    )


def products(rows: DataFrame, mean: tuple[np.ndarray, np.ndarray], whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """High and low parts of the sum of outer products of centred ``vector``s. A matrix, of the vectors' width, reaches the driver."""
    kinds = "high array<double>, low array<double>"
    parts = rows.select("vector").mapInArrow(_products(mean, whole), f"dimension int, part int, {kinds}")
    parts = parts.groupBy("dimension", "part").applyInArrow(_typed(_merge), f"dimension int, part int, {kinds}")
    merged = parts.groupBy("dimension").applyInArrow(_typed(_merge), f"dimension int, {kinds}").collect()
    merged = sorted((r["dimension"], r["high"], r["low"]) for r in merged)
    return np.array([h for _, h, _ in merged]), np.array([low for _, _, low in merged])


def _typed(function):
    # Spark tells the form of the function by its annotations.
    from collections.abc import Iterator

    def run(keys: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(keys, batches)

    run.__annotations__ = {"keys": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def principal(high: np.ndarray, low: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, eigenvectors as columns, and the trace of (high + low) / n.

    The solver reduces the matrix to a tridiagonal one and splits that in two, again and
    again (the library's symmetric divide-and-conquer driver). Refining steps in longer
    doubles, seldom over two, then use what the low parts know: each vector is mended in the
    directions whose eigenvalues differ from its own.
    """
    a = (high.astype(np.longdouble) + low) / n
    a = (a + a.T) / 2
    _, x = np.linalg.eigh(a.astype(np.float64))
    x = x[:, ::-1].astype(np.longdouble)
    for _ in range(STEPS):
        off = np.eye(len(a), dtype=np.longdouble) - x.T @ x
        turned = x.T @ (a @ x)
        values = np.diag(turned) / (1 - np.diag(off))
        beyond = turned - np.diag(values)
        unsure = 2 * (np.abs(beyond).sum(axis=0).max() + np.abs(values).max() * np.abs(off).sum(axis=0).max())
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > unsure
        turn = np.where(apart, (turned + values[None, :] * off) / np.where(apart, gap, 1) - off / 2, 0)
        # A turn has opposite entries across the diagonal; what rounding makes of them would bend the vectors.
        change = off / 2 + (turn - turn.T) / 2
        x = x + x @ change
        if np.abs(change).max() < ENOUGH:
            break
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64), float(np.trace(a))


def _score(n: int, sums: list[int], mean, axes: np.ndarray):
    """Of each row: the exact sum of squares of n * x - S, and its components."""
    held = np.array([s % 2**64 for s in sums], np.uint64)

    def run(batches):
        claim()
        for batch in batches:
            rows = scaled(matrix(batch.column("vector"), len(sums)))
            high, low = centred(rows, mean)
            with np.errstate(over="ignore"):
                # Whole numbers modulo 2**64: right wherever the sum itself is below.
                away = rows.astype(np.int64).view(np.uint64) * np.uint64(n % 2**64) - held
                deviation = (away * away).sum(axis=1, dtype=np.uint64).view(np.int64)
                about = ((high * n) ** 2).sum(axis=1)
            for i in np.nonzero(about > 2.0**62)[0]:
                deviation[i] = min(LIMIT, sum((n * int(v) - s) ** 2 for v, s in zip(rows[i], sums)))
            found = high @ axes + low @ axes
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviation, pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))],
                ["id", "deviation", "vector"],
            )

    return run


KIND = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    A vector's entries become x = floor(1024 * c) + 100000. Sums S are exact; products of
    x - S / n, centred first and held as double-doubles, are summed by task with the
    rounding kept, and tasks' high and low parts are merged the same way, in two rounds.
    ``whitened`` is x - S / n on a component over the root of its variance, ``deviation``
    the exact sum of (n * x - S) ** 2, ``explained`` the component's share of all variance
    and ``identity_error`` the largest entry of the covariance of ``whitened`` less the
    identity, from a pass over all rows. Only matrices of the vectors' width reach the driver.

    Vectors that are null or hold null or non-finite entries are dropped. Shorter vectors
    count as ending in zeros. Rows that repeat an id, or have none, are rows of their own.
    Entries beyond 2**52 / 1024 are held there, deviations beyond 64 bits at the limit.
    Vectors of fewer dimensions have fewer components. A component without variance (equal
    vectors, fewer vectors than dimensions) keeps its rows, with a null ``whitened``, and
    does not enter ``identity_error``; that and ``explained`` are null if none has any.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    kind = dict(vectors.dtypes)[id_col]
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(present("vector"))
    parts = rows.select("vector").mapInArrow(_sums, "dimension int, high long, low long")
    totals = {r["dimension"]: r["high"] * 2**26 + r["low"] for r in parts.groupBy("dimension").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    n, width = totals.get(-1, 0) >> 26, len(totals) - 1
    if not n or width < 1:
        return spark.createDataFrame([], f"{id_col} {kind}, {KIND}")
    sums = [totals[d] for d in range(width)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    mean = mean, np.array([float(Fraction(s, n) - Fraction(m)) for s, m in zip(sums, mean.tolist())])
    values, axes, trace = principal(*products(rows, mean, whole=True), n)
    k = min(components, width)
    real = [bool(v > NO_VARIANCE * values[0]) for v in values[:k]]
    roots = np.sqrt(np.where(real, values[:k], 1.0))
    scores = scratch.save(rows.mapInArrow(_score(n, sums, mean, axes[:, :k] / roots), f"id {kind}, deviation long, vector array<double>"), "scores")
    error = None
    if used := [c for c in range(k) if real[c]]:
        own = scores.select(F.array(*(F.get("vector", F.lit(c)) for c in used)).alias("vector"))
        middle = np.array(own.agg(*(F.avg(F.get("vector", F.lit(c))) for c in range(len(used)))).first(), np.float64)
        high, low = products(own, (middle, np.zeros(len(used))), whole=False)
        error = float(np.abs((high + low) / n - np.eye(len(used))).max())
    entries = F.array(
        *(
            F.struct(
                F.lit(c + 1).alias("component"),
                (F.get("vector", F.lit(c)) if real[c] else F.lit(None).cast("double")).alias("whitened"),
                F.lit(max(0.0, float(values[c])) / trace if trace > 0 else None).cast("double").alias("explained"),
            )
            for c in range(k)
        )
    )
    return scores.select("id", "deviation", F.explode(entries).alias("c")).select(
        F.col("id").alias(id_col), "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error")
    )
