"""Repeated runs of lines: a suffix array over line-id sequences by distributed prefix doubling, read by its intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from duplexa.llm.scratch import Scratch

#: A repeated run counts from this many lines on, or from one line of this many characters.
MIN_LINES, MIN_CHARS = 2, 40
#: A place is a row of the table, by id and key, and the number of one of its lines that are not blank.
PLACE = ("id", "key", "k")


def _lines(rows: DataFrame) -> DataFrame:
    """(id, key, k, chars, a, b): a row for each line that is not blank; equal 128-bit ids (a, b) are equal lines."""
    kept = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    named = F.transform(kept, lambda x: F.struct(F.char_length(x).alias("chars"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))
    return rows.select("id", "key", F.posexplode(named)).select("id", "key", F.col("pos").alias("k"), "col.*")


def _ranked(suffixes: DataFrame, first: str, second: str, depth: int) -> DataFrame:
    """The suffixes that share their first ``depth`` lines with another: rank, copies, and whether an earlier place has them.

    Suffixes that are equal so far are a group, counted before the shuffle; only groups
    are sorted, over the whole table, and a group's number in that order is the rank of
    all its members. They get it by an equi-join, which may be split where a group is large.
    """
    place = F.struct(*PLACE)
    groups = suffixes.groupBy(first, second).agg(F.count("*").alias("copies"), F.min(place).alias("first")).where("copies > 1")
    order = groups.repartitionByRange(first, second).sortWithinPartitions(first, second)
    # Numbers grow from partition to partition, and so along the order.
    order = order.withColumn("rank", F.monotonically_increasing_id())
    extra = [c for c in ("chars",) if c in suffixes.columns]
    joined = suffixes.join(order, [first, second])
    return joined.select(*PLACE, *extra, "rank", "copies", (place > F.col("first")).alias("later"), F.lit(depth).alias("depth"))


def suffix_intervals(rows: DataFrame, min_lines: int, scratch: Scratch) -> list[DataFrame]:
    """For each depth 1, 2, 4, ... (and min_lines) the intervals of the suffix array with that common prefix, a row a member.

    ``rows`` has id, key and text, one row for each (id, key). Ranks by the first h lines
    and those h places on give ranks by 2h lines. A suffix that is alone at some depth is
    alone from there on, and none that leads to it is any deeper in a group, so both are
    left out of later rounds: rounds end when no run that long repeats, and their tables
    shrink on the way. A document's end equals nothing.
    """
    levels = [scratch.save(_ranked(_lines(rows), "a", "b", 1), "depth1")]
    depth = 1
    while levels[-1].limit(1).count():
        # Overlapping runs make lengths that are no power of two.
        shift = min(depth, min_lines - depth) if depth < min_lines else depth
        now = levels[-1]
        none = F.lit(None).cast("long")
        ends = now.select(*PLACE, F.col("rank").alias("r1"), none.alias("r2")).union(
            now.where(F.col("k") >= shift).select("id", "key", F.col("k") - shift, none, "rank")
        )
        pairs = ends.groupBy(*PLACE).agg(F.max("r1").alias("r1"), F.max("r2").alias("r2")).where("r1 is not null and r2 is not null")
        depth += shift
        levels.append(scratch.save(_ranked(pairs, "r1", "r2", depth), f"depth{depth}"))
    return levels


def _edit(text_col: str):
    """Rows without the lines that runs cover, ``__runs`` being (line that is not blank, depth)."""

    def run(batches):
        for batch in batches:
            runs = batch.column("__runs")
            texts = batch.column(text_col)
            lines = pc.fill_null(pc.add(pc.count_substring(texts, "\n"), 1), 0).cast(pa.int64())
            removed, spans = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            hit = np.nonzero(pc.is_valid(runs).to_numpy(zero_copy_only=False))[0]
            if len(hit):
                texts = texts.to_pylist()
                starts, flat = runs.offsets.to_numpy(), runs.values
                places, depths = (flat.field(n).to_numpy(zero_copy_only=False) for n in range(2))
                for row in hit.tolist():
                    some = slice(starts[row], starts[row + 1])
                    parts = texts[row].split("\n")
                    solid = np.array([n for n, x in enumerate(parts) if x.strip(" ")])
                    change = np.zeros(len(solid) + 1, np.int64)
                    np.add.at(change, places[some], 1)
                    np.add.at(change, places[some] + depths[some], -1)
                    gone = np.zeros(len(parts), bool)
                    gone[solid[np.cumsum(change[:-1]) > 0]] = True
                    removed[row] = np.count_nonzero(gone)
                    spans[row] = np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))
                    texts[row] = "\n".join([x for x, out in zip(parts, gone.tolist()) if not out])
                texts = pa.array(texts, pa.string())
            columns = [texts if n == text_col else batch.column(n) for n in batch.schema.names if n != "__runs"]
            names = [n for n in batch.schema.names if n != "__runs"]
            yield pa.RecordBatch.from_arrays([*columns, lines, pa.array(removed), pa.array(spans)], [*names, "n_lines", "n_removed", "n_runs"])

    return run


def dedup_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
    min_copies: int | None = None,
) -> DataFrame:
    """``documents`` without later copies of repeated line runs, and n_lines, n_removed, n_runs.

    A line goes if it lies in a run of ``min_lines`` lines or more, or is a line of
    ``min_chars`` characters, that also begins at an earlier place; places are ordered by
    (id, line). With ``min_copies``, a shorter line goes too if the whole table has it
    that often. Lines are 128-bit ids; suffixes of the id sequences are ranked by prefix
    doubling (``suffix_intervals``). Members of an interval share its depth in lines; all
    but the one at the first place lose as many. A maximal repeated run is what the
    deepest intervals of its suffixes cover together. Blank lines belong to no run and stay.

    Nothing is gathered but a document's own runs, and the text moves once, to meet them.
    Null text stays null with zero lines. Rows that repeat id and text are one document
    and lose the same lines; rows of one id with different texts are documents of their
    own, in order of a hash of the text. Columns with the new names are replaced, all
    others are kept; an empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "lines")
    docs = documents.drop("n_lines", "n_removed", "n_runs").withColumn(text_col, F.col(text_col).cast("string"))
    again = docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    key = F.xxhash64(text_col) if again else F.lit(0).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    levels = suffix_intervals(rows.dropDuplicates(["id", "key"]) if again else rows, min_lines, scratch)
    counts = F.col("chars") >= min_chars
    if min_copies is not None:
        counts |= F.col("copies") >= min_copies
    covers = levels[0].where(F.lit(True) if min_lines == 1 else counts)
    covers = covers.where("later").select(*PLACE, "depth")
    for level in levels[1:]:
        covers = covers.union(level.where(F.col("later") & (F.col("depth") >= min_lines)).select(*PLACE, "depth"))
    deepest = covers.groupBy(*PLACE).agg(F.max("depth").alias("depth"))
    runs = deepest.groupBy("id", "key").agg(F.collect_list(F.struct("k", "depth")).alias("__runs")).withColumnsRenamed({"id": "__id", "key": "__key"})
    met = F.col(id_col).eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    joined = docs.join(runs, met, "left").select(*docs.columns, "__runs")
    fields = [StructField(f.name, StringType()) if f.name == text_col else f for f in docs.schema.fields]
    schema = StructType([*fields, *(StructField(n, LongType()) for n in ("n_lines", "n_removed", "n_runs"))])
    return joined.mapInArrow(_edit(text_col), schema)
