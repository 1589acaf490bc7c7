"""Ordinal cumulative-link regression on graded texts, with hashed word and shape features."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from duplexa.llm.worker_cache import claim
from duplexa.shipping import ship

BUCKETS = 1 << 18
#: The upper buckets are for shapes, of which there are few.
SHAPES = 1 << 12
#: Words and stems are below, immediate repeats at it, shapes above.
LAST = BUCKETS - SHAPES - 1
#: Letters that longer words of one stem share.
STEM = 4
#: Labelled rows that a fit reads at most, those of smallest id hash.
SAMPLE_ROWS = 8000
#: Features on fewer than LEAST_ROWS labelled rows, or one in ROWS_EACH of them, get no weight;
#: nor do words whose share of rows differs by less than this log ratio across every threshold.
LEAST_ROWS, ROWS_EACH, LEAST_RATIO = 4, 800, 1.5
REMEMBERED = 400_000
#: Runs of letters and of digits count as one sign of a shape, and this many signs tell one from others.
SHAPE_SIGNS = 8
SHAPE_RULES = [(re.compile(p), r) for p, r in ((r"[^\W\d_]*[a-zà-öø-ÿ][^\W\d_]*", "a"), (r"[^\W\d_]+", "A"), (r"\d+", "0"))]
LETTERS = re.compile(r"[\W_]+")


def _bucket(text: str, size: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little") % size


class _Chunks(dict):
    """chunk -> buckets of its word, its stem and its shape in one number; BUCKETS stands for none."""

    def __missing__(self, chunk):
        shape = chunk
        for rule, to in SHAPE_RULES:
            shape = rule.sub(to, shape)
        word = LETTERS.sub("", chunk).lower()
        stem = _bucket("stem " + word[:STEM], LAST) if len(word) > STEM else BUCKETS
        word = _bucket(word, LAST) if word else BUCKETS
        found = word << 40 | stem << 20 | (BUCKETS - SHAPES + _bucket(shape[:SHAPE_SIGNS], SHAPES))
        if len(self) < REMEMBERED:
            self[chunk] = found
        return found


_known = _Chunks()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: 1 for each distinct word and stem, 8 times its share for each shape and for immediate repeats.

    A shape is that of a whole run without white space, told by its first SHAPE_SIGNS signs.
    """
    words = (text or "").split()
    both = np.fromiter(map(_known.__getitem__, words), np.int64, len(words))
    word = np.unique(np.concatenate([both >> 40, both >> 20 & 0xFFFFF]))
    shape, n = np.unique(both & 0xFFFFF, return_counts=True)
    word = word[word < BUCKETS]
    again = np.count_nonzero(both[1:] == both[:-1])
    total = max(1, len(words))
    return np.concatenate([word, shape, [LAST]]), np.concatenate([np.ones(len(word)), 8 * n / total, [8 * again / total]])


@dataclass
class OrdinalModel:
    """P(grade <= k) = logistic(thresholds[k] - weights . features)."""

    weights: np.ndarray
    thresholds: np.ndarray
    rows: int

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade, a row for each score."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds[None] - score[:, None], -500, 500)))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))], axis=1), axis=1)


def fit(indices: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, levels: int, rounds: int = 200, decay: float = 1e-3) -> OrdinalModel:
    """Full-batch Adam on the mean negative log likelihood, shared weights and ordered thresholds.

    A feature's values are first scaled by how far its share of rows differs across a
    threshold (a log ratio, shrunk for rare features), so that telling words count more
    than the noise of the many others.
    """
    n = len(grades)
    share = np.cumsum(np.bincount(grades, minlength=levels) + 1)[:-1] / (n + levels) if n else np.arange(1, levels) / levels
    theta = np.log(share / (1 - share))
    weights = np.zeros(BUCKETS)
    if not n:
        return OrdinalModel(weights, theta, 0)
    flat, value = np.concatenate(indices), np.concatenate(values)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(i) for i in indices])
    frequent = np.bincount(flat, minlength=BUCKETS) >= max(LEAST_ROWS, n / ROWS_EACH)
    keep = frequent[flat]
    used, number = np.nonzero(frequent)[0], np.cumsum(frequent, dtype=np.int32) - 1
    col, row, value = number[flat[keep]], row[keep], value[keep]
    scale = np.zeros(len(used))
    for k in range(levels - 1):
        below = grades[row] <= k
        one, other = (np.bincount(col[m], weights=np.minimum(value[m], 1), minlength=len(used)) for m in (below, ~below))
        ratio = np.log((one + 1) / ((grades <= k).sum() + 2)) - np.log((other + 1) / ((grades > k).sum() + 2))
        scale = np.maximum(scale, np.abs(ratio) * np.sqrt((one + other) / (one + other + 10)))
    told = (scale >= LEAST_RATIO) | (used >= LAST)
    keep, number = told[col], np.cumsum(told, dtype=np.int32) - 1
    used, scale, col, row, value = used[told], scale[told], number[col[keep]], row[keep], value[keep]
    value = value * scale[col]
    w = np.zeros(len(used))
    gaps = np.log(np.maximum(np.diff(theta), 1e-3))
    state = [np.zeros(len(w) + levels - 1), np.zeros(len(w) + levels - 1)]
    low, high = np.maximum(grades - 1, 0), np.minimum(grades, levels - 2)
    for t in range(1, rounds + 1):
        theta = theta[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights=w[col] * value, minlength=n)
        logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        up = np.where(grades < levels - 1, logistic(theta[high] - score), 1)
        down = np.where(grades > 0, logistic(theta[low] - score), 0)
        p = np.maximum(up - down, 1e-12)
        d_up, d_down = up * (1 - up) / p, down * (1 - down) / p
        d_score = (d_up - d_down) / n
        d_w = np.bincount(col, weights=d_score[row] * value, minlength=len(w)) + decay * w
        d_theta = np.zeros(levels - 1)
        np.add.at(d_theta, high, -np.where(grades < levels - 1, d_up, 0) / n)
        np.add.at(d_theta, low, np.where(grades > 0, d_down, 0) / n)
        tail = np.cumsum(d_theta[::-1])[::-1]
        slope = np.concatenate([d_w, [tail[0]], tail[1:] * np.exp(gaps)])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope * slope
        step = 0.15 * (1 - t / (rounds + 1)) * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-9)
        w -= step[: len(w)]
        theta[0] -= step[len(w)]
        gaps -= step[len(w) + 1 :]
    theta = theta[0] + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    weights[used] = w * scale
    return OrdinalModel(weights, theta, n)


def _featurize(batches):
    claim(_known)
    for batch in batches:
        made = [features(x.as_py()) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.float32()))],
            ["grade", "indices", "values"],
        )


def train(documents: DataFrame, grades: DataFrame, levels: int, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on at most ``sample_rows`` of ``grades(id, grade)``, the rows of smallest id hash.

    Null ids and null grades are left out. Without labelled rows the model knows nothing
    and ``score`` accepts every document.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = grades.select(F.col(id_col).alias("id"), F.col("grade").cast("int")).where("id is not null and grade is not null")
    rows = rows.where((F.col("grade") >= 0) & (F.col("grade") < levels)).orderBy(F.xxhash64("id"), "id", "grade").limit(sample_rows).toArrow()
    chosen = spark.createDataFrame(rows)  # sample_rows at most, so it may be broadcast
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "id").select("grade", "text").mapInArrow(_featurize, "grade int, indices array<int>, values array<float>").toArrow()
    indices, values = ([np.asarray(x.values) for x in found.column(name)] for name in ("indices", "values"))
    grade = np.asarray(found.column("grade"), dtype=np.int64)
    # Whatever order the tasks end in, sums are taken in one order.
    order = np.lexsort(([float(v.sum()) for v in values], [int(i.sum(dtype=np.int64)) for i in indices], [len(i) for i in indices], grade))
    return fit([indices[i] for i in order], [values[i] for i in order], grade[order], levels)


def _score(shared, text_col: str, least: int, cutoff: float):
    def run(batches):
        model = shared.value
        claim(_known)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                score = np.zeros(part.num_rows)
                for i, text in enumerate(part.column(text_col)):
                    index, value = features(text.as_py())
                    score[i] = model.weights[index] @ value
                p = model.grades(score)
                tail = p[:, least:].sum(axis=1)
                made = [p @ np.arange(p.shape[1]), tail, (tail >= cutoff) | (model.rows == 0)]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x) for x in made)], [*part.schema.names, *OUTPUT])

    return run


OUTPUT = ("expected_grade", "tail_probability", "accepted")


def score(documents: DataFrame, model: OrdinalModel, least_grade: int, cutoff: float = 0.5, text_col: str = "text") -> DataFrame:
    """``documents`` with expected_grade, tail_probability (of least_grade or better) and accepted.

    One pass without a shuffle; the weights (BUCKETS doubles) are broadcast. Columns that
    have the new names already are replaced. A null or empty text has no features, so the
    thresholds alone grade it. Repeated rows are scored each; an empty table gives an
    empty result.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop(*OUTPUT)
    schema = StructType([*rows.schema.fields, *(StructField(n, DoubleType()) for n in OUTPUT[:2]), StructField(OUTPUT[2], BooleanType())])
    return rows.mapInArrow(_score(shared, text_col, least_grade, cutoff), schema)


#: 0: poor; 1: well written but toxic; 2: well written and clean.
LEVELS = 3


def grade_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from 0/1 marks of quality and toxicity; a null mark counts as no label."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))
