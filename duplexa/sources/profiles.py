"""Accessibility profiles and on-target lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.sources.files import status


#: Places that one row of a blocked profile holds.
BLOCK = 1024

# Fixed value: how a chromosome's own profile file is named.
FILE_NAME = r"^(.*?)(?:\.accessibility)?(?:\.parquet)?$"


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, strand, position, u array<float>) from Parquet profiles of any layout.

    Files hold blocks (what ``write_profiles`` makes), or position, strand and u1..uN. The
    chromosome is a column, the folder's partition, or the file's name, as in
    ``chr1.accessibility.parquet``.
    """
    rows = _read(spark, path)
    return places(rows) if "block" in rows.columns else rows


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Profiles of any layout as blocks; those written as blocks are read as they are."""
    return blocks(_read(spark, path))


def _read(spark: SparkSession, path: str) -> DataFrame:
    status(spark, path)
    rows = spark.read.option("recursiveFileLookup", "false").parquet(path)
    name = F.col("chrom").cast("string") if "chrom" in rows.columns else F.regexp_extract("_metadata.file_name", FILE_NAME, 1)
    if "block" in rows.columns:
        return rows.select(name.alias("chrom"), "strand", *BLOCK_COLUMNS)
    if "u" in rows.columns:
        return rows.select(name.alias("chrom"), "strand", "position", "u")
    widths = sorted((int(c[1:]), c) for c in rows.columns if c[0] == "u" and c[1:].isdigit())
    return rows.select(name.alias("chrom"), "strand", "position", F.array(*(c for _, c in widths)).alias("u"))


BLOCK_COLUMNS = ["block", "low", "high", "width", "gaps", "values"]


def blocks(profiles: DataFrame) -> DataFrame:
    """A row for BLOCK places: chrom, strand, block, low, high, width, gaps, values.

    ``values`` holds the block's rows of ``width`` energies one behind the other, from
    place ``low`` to ``high``; where places are missing in between, ``gaps`` lists those
    that are there. Of rows that repeat a place the least counts. What is in blocks already is left as it is.
    """
    if "block" in profiles.columns:
        return profiles
    row = F.struct("position", "u")
    number = F.floor((F.col("position") - 1) / BLOCK).cast("long")
    packed = profiles.where("position IS NOT NULL").groupBy("chrom", "strand", number.alias("block")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.max(F.coalesce(F.size("u"), F.lit(0))).alias("width")
    )
    single = F.filter("rows", lambda x, i: (i == 0) | (F.get("rows", i - 1)["position"] != x["position"]))
    packed = packed.withColumn("rows", single)
    packed = packed.withColumns({"low": F.get("rows", F.lit(0))["position"], "high": F.element_at("rows", -1)["position"]})
    full = F.transform("rows", lambda x: F.slice(F.concat(F.coalesce(x["u"], F.array().cast("array<float>")), F.array_repeat(F.lit(None).cast("float"), F.col("width"))), 1, F.col("width")))
    gapless = F.size("rows") == F.col("high") - F.col("low") + 1
    return packed.select(
        "chrom",
        "strand",
        "block",
        "low",
        "high",
        "width",
        F.when(~gapless, F.transform("rows", lambda x: x["position"])).alias("gaps"),
        F.flatten(full).cast("array<float>").alias("values"),
    )


def places(blocked: DataFrame) -> DataFrame:
    """Blocks taken apart: a row for each place."""
    count = F.coalesce(F.size("gaps"), F.col("high") - F.col("low") + 1).cast("int")
    rows = blocked.select("chrom", "strand", "low", "gaps", "width", "values", F.explode(F.sequence(F.lit(0), count - 1)).alias("n"))
    position = F.coalesce(F.get("gaps", F.col("n")), F.col("low") + F.col("n")).cast("int")
    return rows.select("chrom", "strand", position.alias("position"), F.slice("values", F.col("n") * F.col("width") + 1, F.col("width")).alias("u"))


def write_profiles(profiles: DataFrame, path: str) -> None:
    """Blocks, in one folder a chromosome and strand, so that readers of few chromosomes open few files."""
    blocks(profiles).write.partitionBy("chrom", "strand").mode("overwrite").parquet(path)


def read_on_targets(spark: SparkSession, path: str) -> DataFrame:
    """(sirna_id, target_id): tab-separated, comment and short lines skipped; of several rows for an id the last counts."""
    status(spark, path)
    rows = spark.read.text(path).where("value not like '#%'").select(F.split("value", "\t").alias("f"), F.monotonically_increasing_id().alias("n"))
    rows = rows.where(F.size("f") >= 2).select(F.trim(F.col("f")[0]).alias("sirna_id"), F.trim(F.col("f")[1]).alias("target_id"), "n")
    return rows.groupBy("sirna_id").agg(F.max_by("target_id", "n").alias("target_id"))
