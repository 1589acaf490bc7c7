"""Where siRNA seeds match in target texts, kept up to date as texts arrive.

python -m jobs.seed_screen --tables DIR --output DIR --checkpoint DIR [--settings FILE]

A file stream over the documents table takes the files that its checkpoint does not know,
and ends when it has them all. Each batch is a folder of the output, replaced as a whole
if the batch is repeated after a failure, so that no text is counted twice or left out. A
second run over the same input reads and writes nothing. A table that grows gets new
files; files that are known by name are not read again. Where many siRNAs share a seed, a
batch is kept as texts by seed and, beside them, siRNAs by seed, which ``hits`` joins.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.functions.sequences import spelt
from duplexa.operators import search
from duplexa.plans import workload
from jobs.common import HERE, command_line, load_settings, there

LOG = logging.getLogger("jobs.seed_screen")
SETTINGS = str(HERE / "seed_screen.json")
DEFAULTS = {"seed_start": 2, "seed_length": 7, "seed_wobble": False, "files_each": 64}
#: What the stream reads of a text.
TEXT = "doc_id long, text string, lang string"
HITS = "seed string, sirna_id string, doc_id long, n_sites long, first_site int, batch long, lang string"
#: Of batches that are kept by seed, the folder in the output of their siRNAs, which readers of the output pass over; and its rows.
SIRNAS, MEMBERS = "_sirnas", "seed string, sirna_id string, times long, batch long"
#: Rows of siRNAs that are sent to all tasks to meet texts by seed, some 100 MB; more are joined by a shuffle.
SENT_SIRNAS = 2_000_000
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Files that one language of a batch is written in at most.
SPREAD = 32
BATCH = re.compile(r"/batch=(\d+)/")


def seeds_of(sirnas: DataFrame, given: dict) -> DataFrame:
    """kmer, sirna_id, times: what a siRNA's seed pairs with, as texts spell it."""
    length, start = given["seed_length"], given["seed_start"]
    q = search.query_kmers(sirnas, length, start, start + length - 1, given["seed_wobble"])
    return q.groupBy("kmer", "sirna_id").agg(F.count("*").alias("times"))


def several(q: DataFrame) -> bool:
    """Whether a siRNA has several spellings, as G-U pairs give them, so that a text may match it by more than one."""
    return q.groupBy("sirna_id").count().where("count > 1").limit(1).count() > 0


def text_seeds(texts: DataFrame, length: int, summed: bool = False) -> DataFrame:
    """lang, deal, doc_id, kmer, n, first_site (from 1): each text's k-mers.

    Texts are dealt by language and document, as the writer needs them, which is all that is
    shuffled: their k-mers are counted where they are. Rows that repeat a doc_id add up; an
    empty lang is none, as partitions have it. Where something is ``summed`` by text later
    Spark counts, so that it knows how rows lie.
    """
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lang, deal = F.when(F.col("lang") != "", F.col("lang")).alias("lang"), F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).alias("deal")
    dealt = texts.select(lang, deal, "doc_id", "text").repartition(tasks, "lang", "deal")
    records = dealt.select("lang", "deal", F.col("doc_id").alias("id"), spelt(F.col("text")).alias("sequence"))
    if not summed:
        return search.count_kmers(records.sortWithinPartitions("lang", "id"), length).withColumnRenamed("id", "doc_id")
    tiles = search.tile_bases(records, length, keep=("lang", "deal"))
    places = search.spell(tiles, length).select("lang", "deal", F.col("id").alias("doc_id"), (F.col("low") + F.col("at") + 1).cast("int").alias("place"), "kmer")
    return places.groupBy("lang", "deal", "doc_id", "kmer").agg(F.count("*").alias("n"), F.min("place").alias("first_site"))


def seed_hits(texts: DataFrame, sirnas: DataFrame, given: dict) -> DataFrame:
    """sirna_id, doc_id, lang, n_sites, first_site (from 1): each siRNA's seed matches in each text.

    Where the siRNAs' k-mers are too many to be sent to all tasks, the counted k-mers of
    texts are joined by a shuffle.
    """
    text = ["lang", "deal", "doc_id"]
    q = seeds_of(sirnas, given)
    sent, many = search.sent_whole(q), several(q)
    found = text_seeds(texts, given["seed_length"], many).join(F.broadcast(q) if sent else q, "kmer").select(*text, "sirna_id", (F.col("n") * F.col("times")).alias("n_sites"), "first_site")
    if not sent:
        found = found.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "deal")
    if many:
        found = found.groupBy(*text, "sirna_id").agg(F.sum("n_sites").alias("n_sites"), F.min("first_site").alias("first_site"))
    return found.select("sirna_id", "doc_id", "lang", "n_sites", "first_site")


def by_seed(q: DataFrame) -> bool:
    """Whether so many siRNAs share a seed that a batch is kept as texts by seed and siRNAs by seed: their pairs would outnumber both."""
    return bool(search.crowd(q)) and not several(q)


def batches(rows: DataFrame) -> int:
    return len({BATCH.search(file)[1] for file in rows.inputFiles()})


def stored(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame | None]:
    """What stands in the output: hits by siRNA or by seed, and the siRNAs of the batches that are by seed, if there are any."""
    own = f"{output}/{SIRNAS}"
    return spark.read.schema(HITS).parquet(output), spark.read.schema(MEMBERS).parquet(own) if there(spark, own) else None


def hits(spark: SparkSession, output: str) -> DataFrame:
    """All batches' rows as one table: a siRNA and text that several batches have become one row.

    Texts by seed meet their siRNAs here, unshuffled while those can be sent. Only texts that
    several batches have are summed, unless those are very many.
    """
    if not there(spark, output):
        return spark.createDataFrame([], HITS).drop("batch", "seed")
    columns = ["sirna_id", "doc_id", "lang", "n_sites", "first_site"]
    rows, members = stored(spark, output)
    if members is not None:
        packed = members.groupBy("batch", "seed").agg(F.collect_list(F.struct("sirna_id", "times")).alias("sirnas"))
        packed = F.broadcast(packed) if members.limit(SENT_SIRNAS + 1).count() <= SENT_SIRNAS else packed

    def whole(some: DataFrame) -> DataFrame:
        if members is None:
            return some.select(*columns)
        met = some.where("seed IS NOT NULL").drop("sirna_id").join(packed, ["batch", "seed"]).withColumn("s", F.explode("sirnas"))
        met = met.select("s.sirna_id", "doc_id", "lang", (F.col("n_sites") * F.col("s.times")).alias("n_sites"), "first_site")
        return some.where("seed IS NULL").select(*columns).union(met)

    # Within a batch they are one row already.
    if batches(rows) < 2:
        return whole(rows)
    summed = lambda some: whole(some).groupBy(*columns[:3]).agg(F.sum("n_sites").alias("n_sites"), F.min("first_site").alias("first_site"))
    again = rows.select("batch", "doc_id", "lang").distinct().groupBy("doc_id", "lang").count().where("count > 1").select(F.col("doc_id").alias("__doc"), F.col("lang").alias("__lang"))
    if not search.sent_whole(again):
        return summed(rows)
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("lang").eqNullSafe(F.col("__lang"))
    return whole(rows.join(F.broadcast(again), same, "left_anti")).union(summed(rows.join(F.broadcast(again), same, "left_semi")))


def pairs(spark: SparkSession, output: str) -> int:
    """siRNA and text pairs of all batches, those by seed counted without pairing them."""
    rows, members = stored(spark, output)
    n = rows.where("seed IS NULL").count() if members is not None else rows.count()
    if members is not None:
        texts = rows.where("seed IS NOT NULL").groupBy("batch", "seed").agg(F.count("*").alias("texts"))
        n += texts.join(members.groupBy("batch", "seed").agg(F.count("*").alias("sirnas")), ["batch", "seed"]).agg(F.expr("coalesce(sum(texts * sirnas), 0)")).first()[0]
    return n


def run(spark: SparkSession, tables: str, output: str, checkpoint: str, settings: str = SETTINGS) -> DataFrame:
    """Screen the texts of ``tables`` that are new to ``checkpoint``, and return all hits under ``output``.

    The output belongs to its checkpoint: with batches there and no checkpoint, ValueError.
    """
    given = load_settings(spark, settings, DEFAULTS)
    if there(spark, output) and not there(spark, checkpoint):
        raise ValueError(f"{output} holds batches of another checkpoint than {checkpoint}")
    # As a pattern the path may be a file or a folder.
    texts = spark.readStream.schema(TEXT).option("maxFilesPerTrigger", given["files_each"]).parquet(f"{tables}/documents.parque[t]")

    def screen(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        sirnas = workload.oligos(session, tables)[0]
        q = seeds_of(sirnas, given)
        if by_seed(q):
            q.withColumnRenamed("kmer", "seed").write.mode("overwrite").parquet(f"{output}/{SIRNAS}/batch={number}")
            seeds = q.select("kmer").distinct()
            found = text_seeds(batch, given["seed_length"]).join(F.broadcast(seeds) if search.sent_whole(seeds) else seeds, "kmer", "left_semi")
            found = found.select(F.col("kmer").alias("seed"), "doc_id", F.col("n").alias("n_sites"), "first_site", "lang")
        else:
            found = seed_hits(batch, sirnas, given)
        # A task holds few languages: files side by side spare a sort of its rows.
        before = session.conf.get(WRITERS, None)
        session.conf.set(WRITERS, SPREAD)
        try:
            found.write.mode("overwrite").partitionBy("lang").parquet(f"{output}/batch={number}")
        finally:
            session.conf.unset(WRITERS) if before is None else session.conf.set(WRITERS, before)

    query = texts.writeStream.foreachBatch(screen).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    for done in query.recentProgress:
        LOG.info("batch %d: read %d texts from %s", done["batchId"], done["numInputRows"], tables)
    whole = hits(spark, output)
    LOG.info("%d siRNA and text pairs under %s", pairs(spark, output) if there(spark, output) else 0, output)
    return whole


if __name__ == "__main__":
    command_line("seed_screen", run, {"tables": "folder of the tables", "output": "folder to write", "checkpoint": "the stream's checkpoint"})
