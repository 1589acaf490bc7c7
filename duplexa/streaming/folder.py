"""Scoring prediction files as they arrive, whole siRNAs a file or a siRNA in many."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from duplexa.functions.parameters import DEFAULT_TEMPERATURE, Config, thermal_energy
from duplexa.operators import overlap, scoring
from duplexa.plans import reports
from duplexa.sources import predictions


def score_arrivals(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    features: DataFrame | None = None,
    configs: list[Config] | None = None,
    temperature: float = DEFAULT_TEMPERATURE,
    files_each: int = 64,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Watch ``folder`` and write sites and sums of new files under ``output``, once for each batch.

    A partition function needs all sites of its siRNA, so a file must hold whole siRNAs;
    then batches are independent and no state is kept between them. A batch that is
    repeated after a failure overwrites its own folder.
    """
    configs = configs or [Config()]
    arriving = spark.readStream.schema(predictions.RAW).option("sep", "\t").option("maxFilesPerTrigger", files_each).csv(folder)

    def score(batch: DataFrame, number: int) -> None:
        sites = batch.select(*predictions.SITE).where(F.col("sirna_id").isNotNull())
        sites = predictions.with_raw_minimum(sites)
        if features is not None:
            sites = overlap.one_per_transcript(overlap.overlap_join(sites, features))
        scored = scoring.score_by_sirna(sites, configs, temperature=temperature)
        reports.write_sites(reports.without_intermediates(scored.sites), f"{output}/sites/batch={number}", "parquet")
        scored.sums.write.mode("overwrite").parquet(f"{output}/sums/batch={number}")
        if after:
            after(number)

    return arriving.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sum_arrivals(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    features: DataFrame | None = None,
    configs: list[Config] | None = None,
    temperature: float = DEFAULT_TEMPERATURE,
    files_each: int = 64,
) -> StreamingQuery:
    """Watch ``folder``, whose files may hold any part of a siRNA's sites, and keep sites and mergeable sums under ``output``.

    Each batch writes its sites and its siRNAs' sums, a row a siRNA; ``arrived`` adds the
    sums up. So the result is that of one run over all files, in whatever order they come.
    With features a prediction that several files repeat counts once, as there: the stream
    keeps the sites it has seen in its state, by all of their columns. Clamps depend on a
    siRNA's least energy, which a later file may lower: ValueError.
    """
    configs = configs or [Config()]
    if any(c.theta is None and c.suffix for c in configs):
        raise ValueError("clamped configs need all sites of a siRNA at once")
    rt = thermal_energy(temperature)
    arriving = spark.readStream.schema(predictions.RAW).option("sep", "\t").option("maxFilesPerTrigger", files_each).csv(folder)
    arriving = arriving.select(*predictions.SITE).where(F.col("sirna_id").isNotNull())
    if features is not None:
        arriving = arriving.dropDuplicates(predictions.SITE)

    def add(sites: DataFrame, number: int) -> None:
        if features is not None:
            sites = overlap.one_per_transcript(overlap.overlap_join(sites, features))
        # Written first, as the batch would be read and joined twice; a repeated batch overwrites both.
        where = f"{output}/sites/batch={number}"
        sites.write.mode("overwrite").parquet(where)
        written = sites.sparkSession.read.schema(sites.schema).parquet(where)
        sums = scoring.partition_sums(scoring.prepare(written).withColumn("is_on_target", F.lit(False)), configs, rt)
        sums.write.mode("overwrite").parquet(f"{output}/sums/batch={number}")

    return arriving.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrived(spark: SparkSession, output: str, configs: list[Config] | None = None, temperature: float = DEFAULT_TEMPERATURE) -> scoring.Scored:
    """All sites under ``output`` with their probabilities, and the merged sums; configs and temperature as they were summed."""
    sums = scoring.merged_sums(spark.read.parquet(f"{output}/sums").drop("batch"))
    sites = scoring.prepare(spark.read.parquet(f"{output}/sites").drop("batch")).withColumn("is_on_target", F.lit(False))
    return scoring.Scored(scoring.with_probabilities(sites, sums, configs or [Config()], thermal_energy(temperature)), sums)
