"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.llm import line_dedup, minhash_dedup, packing, quality_classifier, suffix_dedup
from duplexa.llm.queries import word_bpe
from duplexa.llm.scratch import Scratch

#: A single line shorter than line dedup's minimum counts as boilerplate from this many copies on.
MIN_COPIES = 10


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is at least one half; the others go."""
    labels = quality_classifier.grade_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = quality_classifier.train(docs, labels, quality_classifier.LEVELS)
    return quality_classifier.score(docs, model, quality_classifier.LEVELS - 1).where("accepted").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs and of short lines that MIN_COPIES places have."""
    return _counted(line_dedup.dedup_lines(docs, min_copies=MIN_COPIES).select(docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its five-word shingles.

    A document without words, or with a null id, is a group of its own, and its row stays.
    """
    found = minhash_dedup.near_duplicates(docs, words=5, percent=80)
    # What goes is joined away, and not what stays kept, as a null id equals none.
    return docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte runs of 50 and more that a document of smaller id has."""
    cut = suffix_dedup.dedup_substrings(docs, with_text=True).where("n_removed > 0")
    # Rows of one id may differ in text, so a row is known by both.
    cut = cut.select(F.col("doc_id").alias("__cut_id"), F.col("text_sha256").alias("__cut_sha"), "kept_text").dropDuplicates(["__cut_id", "__cut_sha"])
    joined = docs.join(cut, (F.col("doc_id") == F.col("__cut_id")) & (F.sha2("text", 256) == F.col("__cut_sha")), "left")
    text = F.when(F.col("__cut_id").isNotNull(), F.col("kept_text")).otherwise(F.col("text"))
    return _counted(joined.withColumn("text", text).select(docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 2048 tokens."""
    return packing.pack(docs, word_bpe(), with_ids=False).drop("ids")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", select_quality),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each over the table that the one before it wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = scratch.save(docs, f"stage{n}")
            if n:
                scratch.drop(f"stage{n - 1}")
    return docs
