"""Joining binding sites with the features they overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the finest bins, and how many bins a feature may fill before it moves to coarser ones.
BIN_WIDTH, BINS_EACH = 1024, 64


def _bins(start: Column, end: Column, width: Column) -> tuple[Column, Column]:
    """First and last bin of a half-open interval; an empty interval touches the places beside it."""
    low, high = F.least(start, end - 1), F.greatest(start, end - 1)
    return F.floor(low / width), F.floor(high / width)


def level_count(features: DataFrame, bin_width: int = BIN_WIDTH) -> int:
    """How many levels the longest feature needs; an action over the features' ends."""
    longest = features.agg(F.max(F.abs(F.col("end") - F.col("start")))).first()[0] or 0
    levels = 1
    while bin_width * BINS_EACH**levels < longest:
        levels += 1
    return levels


def bin_features(features: DataFrame, bin_width: int, levels: int) -> DataFrame:
    """Features by (chrom, strand, __level, __bin), a row for each bin; those too long for a level's bins are on a coarser one."""
    widths = F.array(*(F.lit(bin_width * BINS_EACH**n) for n in range(levels)))
    own_level = F.lit(levels - 1)
    for n in range(levels - 2, -1, -1):
        own_level = F.when(F.abs(F.col("end") - F.col("start")) <= bin_width * BINS_EACH ** (n + 1), n).otherwise(own_level)
    right = features.select(
        "chrom",
        "strand",
        F.col("start").alias("trans_start"),
        F.col("end").alias("trans_end"),
        own_level.alias("__level"),
        *(c for c in features.columns if c not in ("chrom", "strand", "start", "end")),
    )
    low, high = _bins(F.col("trans_start"), F.col("trans_end"), F.get(widths, F.col("__level")))
    return right.withColumn("__t0", low).withColumn("__bin", F.explode(F.sequence(low, high)))


def bin_sites(sites: DataFrame, bin_width: int, levels: list[int]) -> DataFrame:
    """Sites by (chrom, strand, __level, __bin) on each of the levels that features use."""
    left = sites.withColumn("__level", F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0] if levels else 0))
    width = F.lit(bin_width) * F.pow(F.lit(float(BINS_EACH)), "__level").cast("long")
    low, high = _bins(F.col("start"), F.col("end"), width)
    return left.withColumn("__p0", low).withColumn("__bin", F.explode(F.sequence(low, high)))


def met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Binned sites with the binned features they overlap; a pair is taken in one bin only, the later of its two first bins."""
    # Bins first: a sort compares its first column by numbers, and few rows share a bin where very many share a chromosome.
    joined = left.join(right, BIN_KEY[::-1])
    both = (F.col("start") < F.col("trans_end")) & (F.col("end") > F.col("trans_start")) & (F.col("__bin") == F.greatest("__p0", "__t0"))
    return joined.where(both).drop("__level", "__bin", "__p0", "__t0")


BIN_KEY = ["chrom", "strand", "__level", "__bin"]


def overlap_join(sites: DataFrame, features: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Every site with every feature on its chromosome and strand that satisfies site.start < end and site.end > start.

    An equi-join on (chrom, strand, level, bin), not a range join over a chromosome, so
    that work follows the number of neighbours and a dense stretch is many keys. A feature
    too long for its level's bins is put on a coarser level; sites are put on the levels
    that features use. A pair is taken in one bin only: the later of its two first bins.
    Rows with a null in a key or an end match nothing. Feature columns that clash are
    named trans_start and trans_end; energies and other columns stay. Features that many
    runs share are better stored once, by ``stored_features.store``.
    """
    levels = level_count(features, bin_width)
    return met(bin_sites(sites, bin_width, list(range(levels))), bin_features(features, bin_width, levels))


#: Places in a bin of merge_intervals.
MERGE_WIDTH = 1 << 20

SITE_KEY = ["sirna_id", "chrom", "start", "end", "strand", "energy", "transcript_id"]


def one_per_transcript(pairs: DataFrame, dealt: list[str] | None = None) -> DataFrame:
    """One row for each site and transcript: the pair of smallest feature start, end and gene.

    Exons of one transcript and repeated predictions collapse. An aggregation of the
    least struct, combined before the shuffle, where a row number would gather and sort.
    With ``dealt``, some of the key's columns, rows are shuffled by those uncombined: they
    are sorted once, and later aggregations by those columns and others need no shuffle.
    """
    key = [c for c in SITE_KEY if c in pairs.columns]
    if dealt:
        pairs = pairs.repartition(*dealt)
    rest = [c for c in pairs.columns if c not in key]
    first = [c for c in ("trans_start", "trans_end", "gene_id") if c in rest]
    best = F.min(F.struct(*first, *(c for c in rest if c not in first))).alias("__best")
    # Aggregated in a sort, by starts first, which few rows share.
    return pairs.groupBy(*sorted(key, key=lambda c: c != "start")).agg(best).select(*key, *(F.col(f"__best.{c}").alias(c) for c in rest))


def transcript_join(sites: DataFrame, features: DataFrame) -> DataFrame:
    """Sites whose chromosome is a transcript's id, a row for each of its features; the strand does not matter."""
    right = features.select(
        F.col("transcript_id").alias("__key"),
        *(F.col(c).alias(f"{c}_trans") for c in ("chrom", "start", "end", "strand")),
        "gene_id",
        "exp_value",
    )
    return sites.join(right, F.col("chrom") == F.col("__key")).withColumnRenamed("__key", "transcript_id")


def intersect(sites: DataFrame, features: DataFrame, mode: str = "gw") -> DataFrame:
    """``tw``: by transcript; ``gw``: by place, one row for each site and transcript."""
    check_mode(mode)
    return transcript_join(sites, features) if mode == "tw" else one_per_transcript(overlap_join(sites, features))


def check_mode(mode: str) -> None:
    if mode not in ("gw", "tw"):
        raise ValueError(f"mode is gw or tw, not {mode!r}")


def merge_intervals(intervals: DataFrame, padding: int = 0, by: tuple[str, ...] = ("chrom", "strand"), bin_width: int = MERGE_WIDTH) -> DataFrame:
    """Unions of intervals at most ``padding`` apart, by key; rows with a null in a key or an end are left out.

    Rows are dealt by key and bin of starts, so that a key is many tasks, and merged within
    bins there; only those unions go on. What bins hand to later ones, their greatest end
    and how many unions they begin, runs over a key, a row a bin. A bin's unions that an
    earlier one reaches into belong to the union that is open there.
    """
    key = [*by, "__bin"]
    rows = intervals.select(*by, "start", "end").withColumn("__bin", F.floor(F.col("start") / bin_width))
    # Said of every column, so that joins find nothing to add on one of their sides alone and the shuffle of rows is used again.
    for name in (*key, "start", "end"):
        rows = rows.where(F.col(name).isNotNull())
    bare = rows
    order = Window.partitionBy(*key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__new", F.coalesce(F.col("start") > reach + padding, F.lit(True)).cast("long"))
    # Of equal intervals the one that begins a union comes first, in whatever order they were above.
    order = Window.partitionBy(*key).orderBy("start", "end", F.desc("__new"))
    rows = rows.withColumn("__own", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    within = rows.groupBy(*key, "__own").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    before = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    # From the rows themselves: greatest ends are combined before they move, and nothing is sorted for them.
    reached = bare.groupBy(*key).agg(F.max("end").alias("__end")).select(*key, F.max("__end").over(before).alias("__reach"))
    within = within.join(reached, key).withColumn("__new", F.coalesce(F.col("start") > F.col("__reach") + padding, F.lit(True)).cast("long"))
    begun = within.groupBy(*key).agg(F.sum("__new").alias("__begun")).select(*key, F.coalesce(F.sum("__begun").over(before), F.lit(0)).alias("__before"))
    running = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    numbered = within.withColumn("__n", F.sum("__new").over(running)).join(begun, key).withColumn("__n", F.col("__n") + F.col("__before"))
    return numbered.groupBy(*by, "__n").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__n")
