"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one row kept of each group."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.components import connected_components, forest
from duplexa.llm.scratch import Scratch

CELL_ROWS = 2048
MAX_CELLS = 4096
SAMPLE_PER_CELL = 32
#: Rows of a cell that one task holds: of those at home there, and of visitors.
BLOCK_ROWS, VISITORS = 4096, 16_384
#: Two linked vectors lie at most REACH standard deviations of their difference's share in one
#: direction apart across a border; up to REACH ** 2 dimensions that is all of the difference.
REACH = 3.0


def usable(column: str) -> F.Column:
    """True for vectors with a direction: not null, all components finite, not all zero."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & fine & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column, width: int = 0) -> np.ndarray:
    """A list column of doubles as rows; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit_cells(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centres of spherical k-means over unit rows, begun from evenly spaced ones."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def spread_of(rows: np.ndarray) -> float:
    """In how many directions rows vary: the square of the variances' sum over the sum of their squares; 1 at least."""
    if len(rows) < 2:
        return 1.0
    own = np.linalg.eigvalsh(np.atleast_2d(np.cov(rows.T)))
    return max(1.0, float(own.sum() ** 2 / max((own * own).sum(), 1e-300)))


def border_margin(threshold: float, directions: float) -> float:
    """How far beyond a cell's border a vector is also compared there.

    Unit vectors at cosine ``threshold`` are sqrt(2 - 2 threshold) apart, and so is at
    most, across a border, either of two that it parts; that much finds every pair. In
    many directions only a part of the difference lies across one border.
    """
    return math.sqrt(max(0.0, 2 - 2 * threshold)) * min(1.0, REACH / math.sqrt(directions))


def _assign(centres: np.ndarray, margin: float):
    gaps = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-12))

    def run(batches):
        for batch in batches:
            rows = matrix(batch.column("vector"), centres.shape[1])[:, : centres.shape[1]]
            rows = unit(rows)
            for at in range(0, len(rows), 1024):
                part = rows[at : at + 1024]
                near = part @ centres.T
                home = near.argmax(axis=1)
                best = near[np.arange(len(part)), home][:, None]
                # A visitor comes only to cells numbered below its own, so a pair meets once.
                visits = ((best - near) <= margin * gaps[home]) & (np.arange(len(centres))[None] < home[:, None])
                visits[np.arange(len(part)), home] = True
                row, cell = np.nonzero(visits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell.astype(np.int32)),
                        pa.array(cell == home[row]),
                        batch.column("rep").slice(at, len(part)).take(pa.array(row)),
                        batch.column("copies").slice(at, len(part)).take(pa.array(row)),
                        pa.FixedSizeListArray.from_arrays(pa.array(part[row].ravel()), part.shape[1]).cast(pa.list_(pa.float64())),
                    ],
                    ["cell", "home", "rep", "copies", "vector"],
                )

    return run


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    dot = math.fsum(a * b)
    return dot / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def _links(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy(zero_copy_only=False)
        lo, hi = int(table.column("lo")[0].as_py()), int(table.column("hi")[0].as_py())
        rows, reps = matrix(table.column("vector")), table.column("rep").to_numpy()
        copies = table.column("copies").to_numpy()
        left, right = np.nonzero(side == lo)[0], np.nonzero(side == hi)[0]
        added, edges_a, edges_b = np.zeros(len(reps), np.int64), [], []
        for at in range(0, len(left) if len(right) else 0, 512):
            x = left[at : at + 512]
            near = rows[x] @ rows[right].T
            link = near >= threshold
            for i, j in zip(*np.nonzero(np.abs(near - threshold) < 1e-13)):
                link[i, j] = _exact(rows[x[i]], rows[right[j]]) >= threshold
            if lo == hi:
                link &= x[:, None] != right[None]
                added[x] += link @ copies[right]
            else:
                added[x] += link @ copies[right]
                added[right] += copies[x] @ link
            i, j = np.nonzero(link)
            a, b = forest(reps[x[i]], reps[right[j]])
            edges_a.append(a)
            edges_b.append(b)
        a, b = forest(np.concatenate(edges_a or [reps[:0]]), np.concatenate(edges_b or [reps[:0]]))
        root = dict(zip(a.tolist(), b.tolist()))
        hit = np.nonzero(added)[0]
        return pa.table(
            {
                "rep": pa.array(reps[hit]),
                "added": pa.array(added[hit]),
                "root": pa.array([root.get(r, r) for r in reps[hit].tolist()], pa.int64()),
            }
        )

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    cell_rows: int = CELL_ROWS,
    exact: bool = False,
) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id reachable by links), kept.

    Equal vectors are one class from the start and count as linked. k-means is fitted on
    a bounded sample (SAMPLE_PER_CELL rows a cell, MAX_CELLS cells at most); every vector
    is indexed. A vector is compared in its own cell and in cells whose border is within
    ``border_margin``, for as many directions as the sample varies in; up to 9, that finds
    every link, and beyond, some in a thousand of those that a border parts may be missed.
    With ``exact`` the margin is that of one direction and none is missed, at the price of
    more visits. Links found are exact. Cells over BLOCK_ROWS rows are compared block by
    block, however large, and only counts and a spanning forest leave a block.

    Null vectors, zero vectors and those with null or non-finite components link with
    nothing, nor do rows without an id. Shorter vectors count as ending in zeros. Rows that repeat an id are vectors
    of their own. Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "cells")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    linked = usable("vector") & F.col("id").isNotNull()
    keyed = rows.where(linked).select(
        "id", "vector", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(7), "vector").alias("k2")
    )
    classes = scratch.save(
        keyed.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "classes"
    )
    width, n = classes.select(F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count("*")).first()
    alone = rows.where(~linked).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if n:
        k = max(1, min(MAX_CELLS, -(-n // cell_rows)))
        sample = classes.orderBy(F.xxhash64("k1")).select("vector").limit(k * SAMPLE_PER_CELL).toArrow().column(0)
        sample = unit(matrix(sample, width))
        centres, margin = fit_cells(sample, k), border_margin(threshold, 1 if exact else spread_of(sample))
        placed = classes.select("rep", "copies", "vector").mapInArrow(
            _assign(centres, margin), "cell int, home boolean, rep long, copies long, vector array<double>"
        )
        placed = scratch.save(placed, "placed")
        blocks = placed.groupBy("cell").agg(
            F.ceil(F.count_if("home") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.count_if(~F.col("home")) / VISITORS).cast("int").alias("visits")
        )
        # The block table has a row a cell, MAX_CELLS at most. Visitors' blocks are numbered after the home blocks, with which alone they meet.
        own = F.when(F.col("home"), F.expr("pmod(xxhash64(rep), blocks)")).otherwise(F.expr("blocks + pmod(xxhash64(rep), greatest(visits, 1))"))
        others = F.when(F.col("home"), F.expr("sequence(0, blocks + visits - 1)")).when(F.col("blocks") > 0, F.expr("sequence(0, greatest(blocks, 1) - 1)"))
        spread = placed.join(F.broadcast(blocks), "cell").withColumn("side", own.cast("int"))
        pairs = spread.withColumn("other", F.explode(others)).select(
            "cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "rep", "copies", "vector"
        )
        found = scratch.save(
            pairs.groupBy("cell", "lo", "hi").applyInArrow(_links(threshold), "rep long, added long, root long"), "links"
        )
        parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
        counts = found.groupBy("rep").agg(F.sum("added").alias("added"))
        grouped = (
            classes.select("k1", "k2", "rep", "copies")
            .join(counts, "rep", "left")
            .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
            .select(
                "k1",
                "k2",
                (F.coalesce("added", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"),
            )
        )
        alone = alone.union(keyed.select("id", "k1", "k2").join(grouped, ["k1", "k2"]).select("id", "n_links", "component_id"))
    return alone.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
