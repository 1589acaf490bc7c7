"""The public calls: off_targets, accessibility, index and search."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.functions.parameters import Config, check_seed, seed_spec, sweep
from duplexa.operators import accessibility as opening
from duplexa.operators import folding, kmer_index, overlap, scoring, stored_features
from duplexa.operators import search as searching
from duplexa.plans import reports
from duplexa.sources import annotation, fasta, files, predictions, profiles


@dataclass
class OffTargets:
    """``sites`` with probabilities, ``sums`` by siRNA, and the configs they are for."""

    sites: DataFrame
    sums: DataFrame
    configs: list[Config]
    #: The sites as they went into the sums' configs, and the on-target found apart from them.
    matched: DataFrame | None = None
    on_target: dict | None = None

    @property
    def summary(self) -> DataFrame:
        """P, Z and Zoff by siRNA and config; of sites that name no siRNA the one row of totals."""
        return scoring.summary(self.sums, self.configs) if "sirna_id" in self.sums.columns else self.sums


def load_sites(spark: SparkSession, path: str) -> DataFrame:
    """A prediction file, or a folder of them; the folder's sites know their siRNA's raw_e_min."""
    if files.status(spark, path).isDirectory():
        return predictions.read_prediction_folder(spark, path)
    return spark.read.parquet(path) if path.endswith(".parquet") else predictions.read_predictions(spark, path)


def off_targets(
    spark: SparkSession,
    predictions_file: str | None = None,
    sirna_fasta: str | None = None,
    target_fasta: str | None = None,
    target_index: str | None = None,
    gtf_file: str | None = None,
    feature_type: str = "exon",
    expression_metric: str = "RPKM",
    transcriptome_format: str = "auto",
    accessibility_dir: str | None = None,
    genome_file: str | None = None,
    window_size: int = 80,
    max_span: int = 40,
    unpaired_prob: int = 30,
    temperature: float = 37.0,
    on_target_file: str | None = None,
    on_target_predictions: str | None = None,
    query_file: str | None = None,
    on_target_expression: float = 1000.0,
    on_target_accessibility: str | None = None,
    on_target_ids_file: str | None = None,
    alpha: str = "1.0",
    gamma: str = "1.0",
    theta: str = "",
    sense_only: bool = False,
    predictions_type: str = "gw",
    mirror_minus_strand: bool = False,
    precomputed_accessibility: str | None = None,
    risearch_file: str | None = None,
    on_target_risearch_file: str | None = None,
    n_workers: int = 1,
) -> OffTargets:
    """Score every binding site within its siRNA.

    Sites come from prediction files, or from a search of ``sirna_fasta`` in
    ``target_fasta``. With ``gtf_file`` they are joined with the annotation, or with what
    ``prepare`` stored of one, and opening energies come from ``precomputed_accessibility`` (a Parquet table by place), from
    ``accessibility_dir``, or from folding ``genome_file``, or are 0. With a folder of
    predictions and ``sirna_fasta``, clamps are anchored at each siRNA's energy against itself.
    Everything up to the result is one lazy plan; sums are there for one siRNA as well.

    Sites that name no siRNA are scored together, with one partition function; an on-target
    found apart then adds its weight and a row of its own, named onTarget. ``risearch_file``
    and ``on_target_risearch_file`` are other names of ``predictions_file`` and
    ``on_target_predictions``; ``n_workers`` is taken and left to Spark.
    """
    predictions_file = predictions_file or risearch_file
    on_target_predictions = on_target_predictions or on_target_risearch_file
    if predictions_file:
        sites = load_sites(spark, predictions_file)
        if sirna_fasta and "raw_e_min" in sites.columns:
            sites = predictions.with_self_energy(sites, searching.self_energies(fasta.read_sirnas(spark, sirna_fasta)))
    elif sirna_fasta:
        if not (target_fasta or target_index):
            raise ValueError("sirna_fasta needs target_fasta or target_index")
        sites = search(spark, sirna_fasta, target_fasta, target_index).select(*predictions.SITE)
    else:
        raise ValueError("no input: give predictions, or siRNAs and a target")
    if sense_only:
        sites = predictions.on_strand(sites)
    if gtf_file and stored_features.is_stored(spark, gtf_file):
        sites = stored_features.intersect(sites, gtf_file, predictions_type)
    elif gtf_file:
        known = annotation.read_annotation(spark, gtf_file, feature_type, expression_metric, transcriptome_format)
        sites = overlap.intersect(sites, known, predictions_type)
    if precomputed_accessibility:
        files.status(spark, precomputed_accessibility)
        sites = opening.precomputed_energy(sites, spark.read.parquet(precomputed_accessibility))
    elif accessibility_dir:
        known = profiles.read_blocks(spark, accessibility_dir)
        if predictions_file:
            opening.guard_profiles(sites, known)
        sites = opening.opening_energy(sites, known, mirror_minus_strand)
    elif genome_file:
        folded = folding.fold(fasta.tiles(spark, genome_file), window_size, max_span, unpaired_prob, temperature, quantised=True)
        sites = opening.opening_energy(sites, folded, mirror_minus_strand)
    configs = sweep(alpha, gamma, theta)
    targets = profiles.read_on_targets(spark, on_target_ids_file) if on_target_ids_file else None
    external = on_target = None
    if on_target_predictions or (on_target_file and query_file):
        energy, own, place = _on_target(
            spark, on_target_predictions, on_target_file, query_file, on_target_accessibility, (window_size, max_span, unpaired_prob, temperature)
        )
        on_target = {"energy": energy, "opening_energy": own, "expression": float(on_target_expression)}
    if "sirna_id" not in sites.columns:
        if len(configs) > 1 or targets is not None:
            raise ValueError("sweeps and on-target ids need sites that name their siRNA")
        scored, totals = scoring.score_together(sites, temperature, on_target and on_target | place)
        return OffTargets(scored, totals, configs, sites, on_target)
    if on_target:
        external = sites.select("sirna_id").distinct().select(
            "sirna_id", F.lit(energy).alias("energy"), F.lit(own).alias("opening_energy"), F.lit(float(on_target_expression)).alias("expression")
        )
    scored = scoring.score_by_sirna(sites, configs, targets, temperature, external)
    return OffTargets(scored.sites, scored.sums, configs, sites, on_target)


def _on_target(spark: SparkSession, found: str | None, target: str | None, query: str | None, profile: str | None, fold: tuple) -> tuple[float, float, dict]:
    """Energy, opening energy and place of the best on-target site: from its file, or searched; from its profile, or folded.

    Without a site both are 0; without a profile or sequence the opening energy is.
    """
    if found:
        energy, start, end, strand = predictions.best_site_in_text(spark, found)
    else:
        best = searching.search(fasta.read_fasta(spark, query), fasta.tiles(spark, target)).agg(F.min(F.struct("energy", "start", "end", "strand")).alias("b"))
        energy, start, end, strand = best.first()["b"] or (0.0, 0, 0, "+")
    where = {"chrom": "onTarget", "start": start, "end": end, "strand": strand}
    if not energy or not (profile or target):
        return float(energy), 0.0, where
    window, span, unpaired, temperature = fold
    rows = profiles.read_profiles(spark, profile) if profile else folding.fold(fasta.tiles(spark, target), window, span, unpaired, temperature)
    place = spark.createDataFrame([("onTarget", start, end, strand)], "chrom string, start int, end int, strand string")
    return float(energy), float(opening.opening_energy(place, rows.withColumn("chrom", F.lit("onTarget"))).first()["opening_energy"]), where


def accessibility(
    spark: SparkSession, genome: str, window_size: int = 80, max_span: int = 40, unpaired_prob: int = 30, temperature: float = 37.0, output: str | None = None
) -> DataFrame:
    """Profiles of a genome; with ``output`` they are quantised, written, and read from there."""
    folded = folding.fold(fasta.tiles(spark, genome), window_size, max_span, unpaired_prob, temperature, quantised=bool(output))
    if output:
        profiles.write_profiles(folded, output)
        return profiles.read_profiles(spark, output)
    return folded


def prepare(
    spark: SparkSession, gtf_file: str, output: str, feature_type: str = "exon", expression_metric: str = "RPKM", transcriptome_format: str = "auto"
) -> str:
    """Store an annotation's features for many runs, which then name ``output`` as their gtf_file; returns it.

    It is read and checked once, here; runs join it where it lies, without shuffling it.
    """
    stored_features.store(annotation.read_annotation(spark, gtf_file, feature_type, expression_metric, transcriptome_format), output)
    return output


def index(spark: SparkSession, target: str, output: str | None = None, k: int = kmer_index.K) -> str:
    """Write a target's k-mer index, in which searches find seeds without reading the target; returns the folder.

    An index of the target as it is now is used as it is.
    """
    where = output or target.rsplit(".", 1)[0] + ".idx"
    return kmer_index.ensure(spark, fasta.tiles(spark, target), target, where, k)


def search(
    spark: SparkSession,
    query: str,
    target: str | None = None,
    index: str | None = None,
    seed_length: int | str = 6,
    max_extension: int = 20,
    energy_threshold: float = -10.0,
    seed_start: int | None = None,
    seed_end: int | None = None,
    seed_wobble: bool = True,
    matrix: str = "t04",
) -> DataFrame:
    """Binding sites of a siRNA file in a target file or its index; the seed may be given as 7, '2:8' or '2:8/7'."""
    if isinstance(seed_length, str):
        seed_start, seed_end, seed_length = seed_spec(seed_length)
    check_seed(seed_start, seed_end, seed_length, matrix)
    if not (target or index):
        raise ValueError("give a target or its index")
    given = (seed_length, max_extension, energy_threshold, seed_start, seed_end, seed_wobble, matrix)
    if index:
        files.status(spark, index)
        return kmer_index.find(fasta.read_sirnas(spark, query), index, *given)
    return searching.search(fasta.read_sirnas(spark, query), fasta.tiles(spark, target), *given)


__all__ = ["OffTargets", "accessibility", "index", "load_sites", "off_targets", "prepare", "reports", "search"]
