"""The energy of opening a binding site, looked up in accessibility profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.functions.sequences import quantise
from duplexa.sources.profiles import BLOCK, blocks, places

#: Of a place beyond its profile or without one, and of a place that a profile leaves out.
OUT_OF_BOUNDS, ABSENT = 10.0, 25.5
#: Profiles whose lengths are sent to all tasks, bytes of blocks that are, and bytes of blocks that a task may hold.
SENT_PROFILES, SENT_BYTES, HELD = 10_000, 8 << 20, 256 << 20


def profile_bounds(profiles: DataFrame) -> DataFrame:
    """(chrom, strand, __size, __width): a profile's last place and longest stretch, from its small columns alone."""
    size, width = ("high", F.col("width")) if "block" in profiles.columns else ("position", F.coalesce(F.size("u"), F.lit(0)))
    return profiles.where(F.col(size).isNotNull()).groupBy("chrom", "strand").agg(F.max(size).alias("__size"), F.max(width).alias("__width"))


def opening_energy(sites: DataFrame, profiles: DataFrame, mirror_minus_strand: bool = False) -> DataFrame:
    """``sites`` with opening_energy: the profile at the site's 3' place, for a stretch of the site's length.

    On '+' the place is ``end``, on others ``start``. Longer sites use the longest stretch
    there is. A site that begins before place 1, ends beyond its profile or has none gets
    OUT_OF_BOUNDS, a place that its profile leaves out ABSENT.

    Two left joins: on the profile's length for the bounds, a row a chromosome and strand,
    and on the block of BLOCK places in which the energy lies, where an array index finds
    it. A genome of 3e9 bases is 6e6 rows of the join. Up to SENT_PROFILES rows of bounds
    are read by an action, which also tells how much the blocks hold, and sent to all
    tasks, as are SENT_BYTES of blocks. Beyond that, while a partition of blocks has at
    most HELD bytes a task holds it and sites pass by unsorted, so that a block in which
    very many sites lie takes no memory for them. What is larger yet, or has more bounds,
    is sorted and merged, which may spill.
    """
    blocked = blocks(profiles)
    bounds = profile_bounds(profiles)
    known, size = bounds.limit(SENT_PROFILES + 1).collect(), None
    if len(known) <= SENT_PROFILES:
        bounds = F.broadcast(sites.sparkSession.createDataFrame(known, bounds.schema))
        size = sum(r["__size"] * r["__width"] * 4 for r in known)
    length = F.greatest(F.col("end") - F.col("start") + 1, F.lit(1))
    place = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    rows = sites.join(bounds, ["chrom", "strand"], "left")
    if mirror_minus_strand:
        place = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("__size") + 1 - F.col("start"))
    rows = rows.withColumn("__place", place).withColumn("__block", F.floor((F.col("__place") - 1) / BLOCK).cast("long"))
    parts = blocked.select("chrom", "strand", F.col("block").alias("__block"), *(F.col(c).alias(f"__{c}") for c in ("low", "gaps", "values")), F.col("width").alias("__own"))
    if size is not None and size <= SENT_BYTES:
        parts = F.broadcast(parts)
    elif size is not None and size <= HELD * int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        parts = parts.hint("shuffle_hash")
    rows = rows.join(parts, ["chrom", "strand", "__block"], "left")
    # The row within the block, from 0; without gaps it is the distance from the first.
    listed = F.array_position("__gaps", F.col("__place").cast("int")) - 1
    row = F.when(F.col("__gaps").isNull(), F.col("__place") - F.col("__low")).when(listed >= 0, listed)
    column = F.least(length, F.col("__width")) - 1
    at = F.when((row >= 0) & (column < F.col("__own")), row * F.col("__own") + column)
    found = F.coalesce(F.get("__values", at.cast("int")).cast("double"), F.lit(ABSENT))
    inside = F.col("__size").isNotNull() & (F.col("start") >= 1) & (F.col("end") <= F.col("__size"))
    energy = F.when(inside, quantise(found)).otherwise(F.lit(OUT_OF_BOUNDS))
    return rows.withColumn("opening_energy", energy).select(*(c for c in sites.columns if c != "opening_energy"), "opening_energy")


def guard_profiles(sites: DataFrame, profiles: DataFrame) -> None:
    """ValueError if no site's chromosome has a profile: every energy would be OUT_OF_BOUNDS. Ends at the first site that has one."""
    known = profiles.select("chrom").distinct()
    if sites.limit(1).count() and not sites.select("chrom").join(known, "chrom", "left_semi").limit(1).count():
        raise ValueError("no chromosome of the sites has a profile")


def precomputed_energy(sites: DataFrame, energies: DataFrame) -> DataFrame:
    """``sites`` with the opening_energy that a table gives for exactly their places; 10.0 where it has none."""
    key = ["chrom", "start", "end", "strand"]
    given = energies.groupBy(*key).agg(F.min("opening_energy").alias("opening_energy"))
    joined = sites.drop("opening_energy").join(given, key, "left")
    return joined.withColumn("opening_energy", F.coalesce(F.col("opening_energy").cast("double"), F.lit(OUT_OF_BOUNDS)))


def profile_range(profiles: DataFrame, chrom: str, strand: str, start: int, end: int) -> DataFrame:
    """A profile's rows from place ``start`` to ``end``; filters reach the scan.

    ValueError where there is no profile of the chromosome and strand, or the places go beyond it.
    """
    if start < 1 or end < start:
        raise ValueError(f"places {start} to {end} are not in a profile")
    own = profiles.where((F.col("chrom") == chrom) & (F.col("strand") == strand))
    last = own.agg(F.max("high" if "block" in own.columns else "position")).first()[0]
    if last is None:
        raise ValueError(f"no profile of {chrom} {strand}")
    if end > last:
        raise ValueError(f"places {start} to {end} go beyond the profile of {chrom} {strand}, which ends at {last}")
    if "block" in own.columns:
        own = places(own.where(F.col("block").between((start - 1) // BLOCK, (end - 1) // BLOCK)))
    return own.where(F.col("position").between(start, end))
