"""Which genes each siRNA may silence by mistake: off-target chances by siRNA, chromosome and gene.

python -m jobs.gene_risk --tables DIR --output DIR [--settings FILE]

Reads lineitem (binding sites), orders (features with expression) and part (on-targets)
and writes one Parquet folder a chromosome. A rerun replaces the whole output, so it may
be repeated at any time; readers of the old files should be done by then.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duplexa.functions.parameters import Config, sweep, thermal_energy
from duplexa.operators import overlap, scoring
from duplexa.plans import workload
from jobs.common import HERE, command_line, load_settings

LOG = logging.getLogger("jobs.gene_risk")
SETTINGS = str(HERE / "gene_risk.json")
#: Decimal places of chances, and files that one chromosome is written in at most.
PLACES, SPREAD = 9, 32
DEFAULTS = {"alpha": "1.0", "gamma": "1.0", "theta": "", "temperature": 37.0}


def column(config: Config) -> str:
    """p, p_a0_8_g0_9 or p_t0_85: a name that every format takes."""
    name = f"p_t{config.theta}" if config.theta is not None else f"p_a{config.alpha}_g{config.gamma}" if config.suffix else "p"
    return name.replace(".", "_")


def gene_risk(sites: DataFrame, features: DataFrame, on_targets: DataFrame, given: dict) -> DataFrame:
    """A row for each siRNA, chromosome and gene that it has sites in.

    Sites and features meet in an equi-join on bins, once for each siRNA's least energy,
    where no pair is shuffled, and once for the sums. Pairs are dealt by siRNA and
    transcript, so they are made one a transcript and added up by transcript after one
    shuffle; genes take those sums. A siRNA's partition function is the sum of its genes'
    weights, and ``energy_rank`` counts its genes by their strongest site: windows over
    genes, not over sites. Chances are rounded, so that a rerun, which may add in another
    order, gives the same. Sites without a siRNA are left out.
    """
    configs, rt = sweep(given["alpha"], given["gamma"], given["theta"]), thermal_energy(given["temperature"])
    sites = sites.where(F.col("sirna_id").isNotNull())
    pairs = overlap.overlap_join(sites, features)
    least = pairs.groupBy("sirna_id").agg(scoring.least_energy(pairs))
    met = scoring.prepare(overlap.one_per_transcript(pairs, ["sirna_id", "chrom", "transcript_id"]))
    rows = scoring.with_known(met, least, on_targets, scoring.few_sirnas(sites))
    gene, names = ["chrom", "sirna_id", "gene_id"], [column(c) for c in configs]
    weights = [F.sum(scoring.weight(c, F.col("E_min"), rt)).alias(name) for c, name in zip(configs, names, strict=True)]
    by_transcript = rows.groupBy(*gene, "transcript_id").agg(
        F.count("*").alias("n_sites"), F.min("energy").alias("least_energy"), F.max("is_on_target").alias("is_on_target"), *weights
    )
    genes = by_transcript.groupBy(*gene).agg(
        F.sum("n_sites").alias("n_sites"),
        F.count("transcript_id").alias("n_transcripts"),
        F.min("least_energy").alias("least_energy"),
        F.max("is_on_target").alias("is_on_target"),
        *(F.sum(name).alias(name) for name in names),
    )
    own = Window.partitionBy("sirna_id")
    z = {name: F.sum(name).over(own) for name in names}
    chances = [F.round(F.when(z[name] > 0, F.col(name) / z[name]).otherwise(F.lit(0.0)), PLACES).alias(name) for name in names]
    order = own.orderBy("least_energy", "chrom", "gene_id")
    ranked = F.row_number().over(order).alias("energy_rank")
    return genes.select(*gene, "n_sites", "n_transcripts", "least_energy", "is_on_target", *chances, ranked)


def run(spark: SparkSession, tables: str, output: str, settings: str = SETTINGS) -> DataFrame:
    """Score the sites of ``tables``, write the genes' risks under ``output`` and return them as read back."""
    given = load_settings(spark, settings, DEFAULTS)
    sites, features = workload.sites(spark, tables), workload.features(spark, tables)
    LOG.info("read %d sites and %d features from %s", sites.count(), features.count(), tables)
    risks = gene_risk(sites, features, workload.targets(spark, tables), given)
    risks.repartition("chrom", F.pmod(F.xxhash64("sirna_id"), F.lit(SPREAD))).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("chrom").parquet(output)
    written = spark.read.schema(risks.schema).parquet(output)
    LOG.info("wrote %d genes' risks under %s", written.count(), output)
    return written


if __name__ == "__main__":
    command_line("gene_risk", run, {"tables": "folder of the tables", "output": "folder to write"})
