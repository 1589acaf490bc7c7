"""Predicted binding sites from tab-separated or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

from duplexa.sources.files import status

RAW = StructType(
    [
        StructField("sirna_id", StringType()),
        StructField("q_start", IntegerType()),
        StructField("q_end", IntegerType()),
        StructField("chrom", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("strand", StringType()),
        StructField("energy", FloatType()),
    ]
)
SITE = ["sirna_id", "chrom", "start", "end", "strand", "energy"]


def read_predictions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sites of one file, several, or a folder; columns after the eighth are left unread, rows without id dropped."""
    rows = spark.read.csv(path, schema=RAW, sep="\t", quote="", mode="PERMISSIVE")
    return rows.select(*SITE).where(F.col("sirna_id").isNotNull())


def with_raw_minimum(sites: DataFrame) -> DataFrame:
    """``raw_e_min``: a siRNA's least energy before any filter. One row a siRNA is joined back."""
    return sites.join(sites.groupBy("sirna_id").agg(F.min("energy").alias("raw_e_min")), "sirna_id")


def read_prediction_folder(spark: SparkSession, path: str) -> DataFrame:
    """All of a folder's own prediction files as one table, with ``raw_e_min``; Parquet files hold it already. Subfolders are not looked into."""
    names = list_prediction_files(spark, path)
    stored, text = ([n for n in names if n.endswith(".parquet") == kind] for kind in (True, False))
    tables = []
    if text:
        rows = spark.read.csv(text, schema=RAW, sep="\t", quote="").select(*SITE).where(F.col("sirna_id").isNotNull())
        tables.append(with_raw_minimum(rows))
    if stored:
        tables.append(spark.read.parquet(*stored))
    if not tables:
        raise FileNotFoundError(f"no prediction files in {path}")
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def list_prediction_files(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's prediction files, sorted; through Spark's file systems."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().toString() for f in files]
    return sorted(n for n in names if n.endswith((".gz", ".tsv", ".out", ".parquet")))


def on_strand(sites: DataFrame, strand: str = "+") -> DataFrame:
    """Sites of one strand; the filter reaches the scan."""
    return sites.where(F.col("strand") == strand)


def site_keys(sites: DataFrame) -> DataFrame:
    """(chrom, strand, n): how many sites each chromosome and strand has."""
    return sites.groupBy("chrom", "strand").agg(F.count("*").alias("n"))


def with_self_energy(sites: DataFrame, energies: DataFrame) -> DataFrame:
    """``raw_e_min`` from ``energies`` (sirna_id, e_min) for the siRNAs that it has; a row a siRNA is joined.

    Clamps are then anchored at the siRNA's energy against itself and not at the least in its file.
    """
    least = energies.groupBy("sirna_id").agg(F.min("e_min").cast("float").alias("__own"))
    return sites.join(least, "sirna_id", "left").withColumn("raw_e_min", F.coalesce("__own", "raw_e_min")).drop("__own")


def prediction_summary(sites: DataFrame) -> DataFrame:
    """One row: counts, energy range, and the sorted chromosomes and strands."""
    return sites.agg(
        F.count("*").alias("n_predictions"),
        F.min("energy").alias("min_energy"),
        F.max("energy").alias("max_energy"),
        F.countDistinct("sirna_id").alias("n_sirnas"),
        F.sort_array(F.collect_set("chrom")).alias("chroms"),
        F.sort_array(F.collect_set("strand")).alias("strands"),
    )


def best_site_in_text(spark: SparkSession, path: str) -> tuple[float, int, int, str]:
    """Energy, start, end and strand of a white-space separated file's best site; (0, 0, 0, '+') if it has none."""
    status(spark, path)
    cut = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(cut.alias("f")).where(F.size("f") >= 8)
    rows = rows.select(
        F.expr("try_cast(f[7] as double)").alias("energy"),
        F.expr("try_cast(f[4] as int)").alias("start"),
        F.expr("try_cast(f[5] as int)").alias("end"),
        F.col("f")[6].alias("strand"),
    ).dropna()
    best = rows.agg(F.min(F.struct("energy", "start", "end", "strand")).alias("b")).first()["b"]
    return tuple(best) if best else (0.0, 0, 0, "+")


def rank_within(sites: DataFrame, column: str = "energy") -> DataFrame:
    """Sites with their rank by energy within the siRNA."""
    order = Window.partitionBy("sirna_id").orderBy(column, "chrom", "start", "end", "strand")
    return sites.withColumn("rank", F.row_number().over(order))
