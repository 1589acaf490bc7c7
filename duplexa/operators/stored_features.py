"""Annotation prepared once: features in bins, stored in buckets by them, and joined where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.operators import overlap
from duplexa.sources import bucketed

#: Rows of binned features that one bucket holds, about; buckets at least.
BUCKET_ROWS, BUCKETS = 2_000_000, 8
FORM = 1


def store(features: DataFrame, path: str, bin_width: int = overlap.BIN_WIDTH) -> None:
    """Write features (chrom, start, end, strand and more) under ``path`` for joins by place and by transcript.

    Two tables: features by (chrom, strand, level, bin) and by transcript, each in buckets.
    The levels that features use are kept beside them, so joins need not look for the
    longest feature. Rows are ranged by bucket, so that a bin of very many is several files.
    """
    spark = features.sparkSession
    bucketed.drop_facts(spark, path)
    binned = overlap.bin_features(features, bin_width, overlap.level_count(features, bin_width))
    counts = {r["__level"]: r["n"] for r in binned.groupBy("__level").agg(F.count("*").alias("n")).collect() if r["__level"] is not None}
    buckets = max(BUCKETS, -(-sum(counts.values()) // BUCKET_ROWS))
    number = lambda keys: F.expr(f"pmod(hash({', '.join(keys)}), {buckets})")
    bucketed.write(binned.repartitionByRange(buckets, number(overlap.BIN_KEY), "trans_start"), f"{path}/places", buckets, overlap.BIN_KEY)
    bucketed.write(features.repartitionByRange(buckets, number(["transcript_id"]), "start"), f"{path}/transcripts", buckets, ["transcript_id"])
    ddl = lambda frame: ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes)
    bucketed.write_facts(
        spark,
        path,
        {"form": FORM, "bin_width": bin_width, "levels": sorted(counts), "buckets": buckets, "places": ddl(binned), "transcripts": ddl(features)},
    )


def is_stored(spark: SparkSession, path: str) -> bool:
    known = bucketed.read_facts(spark, path)
    return bool(known) and known.get("form") == FORM and "levels" in known


def _known(spark: SparkSession, path: str) -> dict:
    if not is_stored(spark, path):
        raise ValueError(f"no stored features in {path}")
    return bucketed.read_facts(spark, path)


def features(spark: SparkSession, path: str) -> DataFrame:
    """The features as they were stored."""
    known = _known(spark, path)
    return bucketed.read(spark, f"{path}/transcripts", known["transcripts"], known["buckets"], ["transcript_id"])


def overlap_join(sites: DataFrame, path: str) -> DataFrame:
    """The rows of ``overlap.overlap_join`` with the features stored under ``path``, which are not shuffled; no action."""
    known = _known(sites.sparkSession, path)
    right = bucketed.read(sites.sparkSession, f"{path}/places", known["places"], known["buckets"], overlap.BIN_KEY)
    kinds = dict(right.dtypes)
    left = overlap.bin_sites(sites, known["bin_width"], known["levels"])
    # Keys of the stored kinds, so that the buckets are those of the join.
    left = left.withColumns({c: F.col(c).cast(kinds[c]) for c in overlap.BIN_KEY})
    return overlap.met(left, right)


def intersect(sites: DataFrame, path: str, mode: str = "gw") -> DataFrame:
    """``overlap.intersect`` with stored features."""
    overlap.check_mode(mode)
    if mode == "tw":
        return overlap.transcript_join(sites, features(sites.sparkSession, path))
    return overlap.one_per_transcript(overlap_join(sites, path))
