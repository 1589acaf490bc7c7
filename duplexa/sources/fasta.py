"""FASTA records as rows."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duplexa.shipping import ship
from duplexa.sources.files import status

#: Bases that lines are joined to before they leave the task that read them.
PIECE = 65_536
PIECES = "file string, block long, record int, id string, at long, bases string"


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence): id is the header's first word; lines are joined, blank ones skipped, text before the first header dropped.

    A record is one row, as short ones may be; ``tiles`` reads long ones.
    """
    whole = F.array_sort(F.collect_list(F.struct("begin", "bases")))
    rows = read_pieces(spark, path).groupBy("file", "head", "id").agg(whole.alias("parts"))
    return rows.select("id", F.array_join(F.transform("parts", lambda p: p["bases"]), "").alias("sequence"))


def _pieces(batches):
    """Lines of a partition, in their order, as pieces of records: (file, block, number of the record in the block, id, place in the block's part of it, bases).

    Record 0 of a block is what goes on there from the block before, without an id.
    """
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in PIECES.split(", ")]
    where, record, name, at, held, size, out, out_size = None, 0, None, 0, [], 0, [], 0

    def cut():
        nonlocal at, held, size, out_size
        # A record without bases is told too: it ends the one before it.
        if where is not None and (size or at == 0):
            out.append((*where, record, name, at, "".join(held)))
            at, out_size = at + size, out_size + size
        held, size = [], 0

    def batch_out():
        nonlocal out, out_size
        made = pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names)
        out, out_size = [], 0
        return made

    for batch in batches:
        for line, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block"))):
            if (file, block) != where:
                cut()
                where, record, name, at = (file, block), 0, None, 0
            if line.startswith(">"):
                cut()
                record, name, at = record + 1, (line[1:].split() or [""])[0], 0
                continue
            bases = "".join(line.split())
            held.append(bases)
            size += len(bases)
            if size >= PIECE:
                cut()
        if out_size >= 64 * PIECE or len(out) >= 10_000:
            yield batch_out()
    cut()
    if out:
        yield batch_out()


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, head, id, begin, total, bases): records in pieces, each with its place in its record (from 0) and the record's length.

    Lines are read in as many tasks as Spark splits the files into, and joined to pieces
    there. A piece before a block's first header belongs to the record that the latest
    block with a header ends in; how far that is into it, a window over blocks tells, two
    numbers a block. So a record of any length is many rows of many tasks. A line is one
    row. ``head`` tells records of one id apart. Text before a file's first header is
    dropped, as are records without an id; records without bases give one empty piece.
    """
    status(spark, path)
    ship(spark)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    pieces = lines.mapInArrow(_pieces, PIECES)
    sizes = pieces.groupBy("file", "block", "record").agg(F.max("id").alias("id"), F.sum(F.length("bases").cast("long")).alias("n"))
    # Of each block: bases that go on from before, and the record it ends in.
    ends = sizes.groupBy("file", "block").agg(
        F.sum(F.when(F.col("record") == 0, F.col("n"))).alias("carried"), F.max(F.when(F.col("record") > 0, F.struct("record", "id", "n"))).alias("open")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.last(F.when(F.col("open").isNotNull(), F.struct("block", "open")), ignorenulls=True).over(before)
    gone = F.coalesce(F.sum(F.coalesce("carried", F.lit(0))).over(before), F.lit(0))
    ends = ends.withColumns({"latest": latest, "gone": gone})
    # Bases carried before the latest header are no part of the record it begins.
    mark = F.last(F.when(F.col("open").isNotNull(), F.col("gone") + F.coalesce("carried", F.lit(0))), ignorenulls=True).over(before)
    goes_on = ends.withColumn("since", F.col("gone") - mark).where("latest IS NOT NULL").select(
        "file", "block", F.lit(0).alias("record"), F.col("latest.block").alias("from_block"), F.col("latest.open").alias("from"), "since"
    )
    placed = pieces.join(goes_on, ["file", "block", "record"], "left")
    own = F.col("record") > 0
    placed = placed.select(
        "file",
        F.when(own, F.struct("block", "record")).otherwise(F.struct(F.col("from_block").alias("block"), F.col("from.record").alias("record"))).alias("head"),
        F.when(own, F.col("id")).otherwise(F.col("from.id")).alias("id"),
        F.when(own, F.col("at")).otherwise(F.col("from.n") + F.col("since") + F.col("at")).alias("begin"),
        "bases",
        own.alias("begins"),
    ).where("id <> ''")
    totals = sizes.join(goes_on, ["file", "block", "record"], "left").select(
        "file", F.when(own, F.struct("block", "record")).otherwise(F.struct(F.col("from_block").alias("block"), F.col("from.record").alias("record"))).alias("head"), "n"
    )
    totals = totals.groupBy("file", "head").agg(F.sum("n").alias("total"))
    joined = placed.join(totals, ["file", "head"]).where("bases <> '' OR (begins AND total = 0)")
    return joined.select("file", "head", "id", "begin", "total", "bases")


def read_tiles(spark: SparkSession, path: str, overlap: int, size: int) -> DataFrame:
    """(id, offset, low, total, sequence, size): a file's records cut into tiles of ``size`` starts with ``overlap`` bases beyond each end.

    The rows that cutting whole records gives, without a whole record anywhere: pieces go
    to the tiles they touch, and a tile is put together from its few pieces.
    """
    pieces = read_pieces(spark, path).where("bases <> ''")
    length = F.length("bases").cast("long")
    first, last = F.greatest(F.floor((F.col("begin") - overlap) / size), F.lit(0)), F.floor((F.col("begin") + length - 1 + overlap) / size)
    parts = pieces.withColumn("number", F.explode(F.sequence(first, F.least(last, F.floor((F.col("total") - 1) / size)))))
    low = F.greatest(F.col("number") * size - overlap, F.lit(0))
    begin = F.greatest(F.col("begin"), low)
    end = F.least(F.col("begin") + length, (F.col("number") + 1) * size + overlap)
    parts = parts.select("file", "head", "id", "number", "total", begin.alias("begin"), F.substring("bases", (begin - F.col("begin") + 1).cast("int"), (end - begin).cast("int")).alias("bases"))
    tiles = parts.groupBy("file", "head", "id", "number", "total").agg(F.array_sort(F.collect_list(F.struct("begin", "bases"))).alias("parts"))
    offset = F.col("number") * size
    return tiles.select(
        "id",
        offset.cast("int").alias("offset"),
        F.greatest(offset - overlap, F.lit(0)).cast("int").alias("low"),
        F.col("total").cast("int").alias("total"),
        F.array_join(F.transform("parts", lambda p: p["bases"]), "").alias("sequence"),
        F.lit(size).alias("size"),
    )


def tiles(spark: SparkSession, path: str) -> Callable[[int, int], DataFrame]:
    """A file's records for what cuts them into tiles of its own width; FileNotFoundError at once where there is no file."""
    status(spark, path)
    return lambda overlap, size: read_tiles(spark, path, overlap, size)


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def read_sirnas(spark: SparkSession, path: str) -> DataFrame:
    """siRNA records; raises ValueError if an id is there twice."""
    records = read_fasta(spark, path)
    twice = [r["id"] for r in duplicate_ids(records).orderBy("id").limit(5).collect()]
    if twice:
        raise ValueError(f"siRNA ids occur more than once: {', '.join(twice)}")
    return records
