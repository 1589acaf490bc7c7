"""Exact top-k by integer inner product with bounds from segment means and deviations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duplexa.llm.embedding_dedup import matrix
from duplexa.shipping import ship

CANDIDATE_ROWS = 8192
QUERY_ROWS = 1024
#: Segments of each resolution, coarse to fine.
LEVELS = (2, 8, 32)


def segment_features(rows: np.ndarray, segments: int) -> np.ndarray:
    """Weighted means and deviations of equal segments (the last may end in zeros).

    For one segment of length L, x.y = L mx my + sum (x - mx)(y - my), and the sum is at
    most L sx sy. So the product of two rows' features is never below their inner product.
    """
    length = -(-rows.shape[1] // segments)
    padded = np.zeros((len(rows), segments * length))
    padded[:, : rows.shape[1]] = rows
    cut = padded.reshape(len(rows), segments, length)
    mean = cut.mean(axis=2)
    rest = cut - mean[:, :, None]
    return np.concatenate([mean * np.sqrt(length), np.sqrt((rest * rest).sum(axis=2))], axis=1)


def _products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered doubles, held within 64 bits."""
    out = np.zeros(len(rows), np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        small = np.abs(q).max(initial=0) * np.abs(rows).max(axis=1, initial=0) * max(1, len(q)) < 2**53
    out[small] = (rows[small] @ q).astype(np.int64)
    if not small.all():
        own = [int(x) for x in q]
        for i in np.nonzero(~small)[0]:
            out[i] = max(-(2**63), min(2**63 - 1, sum(a * int(b) for a, b in zip(own, rows[i]))))
    return out


def best_of_block(queries, query_ids, rows, ids, k: int, levels=LEVELS):
    """(query index, row index, score) of each query's k best rows, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    use = [s for s in levels if 1 < -(-rows.shape[1] // s)] or [1]
    made = [(segment_features(queries, s), segment_features(rows, s)) for s in use]
    out = []
    for at in range(0, len(queries), 64):
        coarse = made[0][0][at : at + 64] @ made[0][1].T
        for i, bound in enumerate(coarse, at):
            other = ids != query_ids[i]
            # A bound beyond doubles rules nothing out.
            bound = np.where(other, np.where(np.isfinite(bound), bound, np.inf), -np.inf)
            slack = 1e-9 * (1 + np.abs(bound[np.isfinite(bound)]).max(initial=0))
            first = np.argpartition(-bound, k - 1)[:k] if len(bound) > k else np.arange(len(bound))
            first = first[other[first]]
            seed = _products(queries[i], rows[first])
            least = seed.min() if len(seed) >= k else -np.inf
            left = np.nonzero((bound >= least - slack) & other)[0]
            for q_feats, r_feats in made[1:]:
                if len(left) <= 4 * k:
                    break
                left = left[~(r_feats[left] @ q_feats[i] < least - slack)]
            score = _products(queries[i], rows[left])
            pick = np.argsort(-score.astype(object) if score.min(initial=0) == -(2**63) else -score, kind="stable")[:k]
            out += [(i, left[p], score[p]) for p in pick]
    return out, ids


def _search(k: int, levels):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            width = max(int(t.column("vector").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for t in (left, right))
            width = max(width, 1)
            own = left.column("vec_id").to_numpy()
            with np.errstate(over="ignore", invalid="ignore"):
                top = np.finfo(np.float64).max
                queries, rows = (np.clip(np.floor(1024 * matrix(t.column("vector"), width)), -top, top) for t in (left, right))
                found, ids = best_of_block(queries, own, rows, right.column("vec_id").to_numpy(), k, levels)
            cols["query_id"] = [own[i] for i, _, _ in found]
            cols["vec_id"] = [ids[j] for _, j, _ in found]
            cols["score"] = [s for _, _, s in found]
        return pa.table({name: pa.array(v, pa.int64()) for name, v in cols.items()})

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    levels: tuple[int, ...] = LEVELS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k rows of highest inner product of floor(1024 x).

    Queries and rows meet in blocks (QUERY_ROWS by CANDIDATE_ROWS), each block pair one
    task's work. Within one, bounds from segment means and deviations thin out the rows,
    coarse to fine; what is left is scored exactly. Every task returns k rows a query.

    Vectors that are null or hold null or non-finite components take no part. Ties go to
    the smaller id. Rows with the query's id are never its candidates; a query id that
    repeats is searched once, with its smallest vector. Shorter vectors count as ending
    in zeros; scores beyond 64 bits are held at the limits. Fewer than k rows: all of
    them. Other columns are ignored; an empty table gives an empty result.
    """

    def clean(frame):
        vector = F.col(vector_col).cast("array<double>")
        rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
        fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))

    ship(vectors.sparkSession)
    rows = clean(vectors)
    asked = clean(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, q = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n // CANDIDATE_ROWS)), max(1, -(-q // QUERY_ROWS))
    spread = lambda frame, own, parts, other, others: frame.select(
        "*", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
    )
    left = spread(asked, "qb", query_blocks, "rb", row_blocks)
    right = spread(rows, "rb", row_blocks, "qb", query_blocks)
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(_search(k, levels), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
