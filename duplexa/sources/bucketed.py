"""Bucketed Parquet at explicit paths: written once, then joined in place by its keys."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.sources import files


def _name() -> str:
    return f"duplexa_{uuid.uuid4().hex}"


def write(frame: DataFrame, path: str, buckets: int, keys: list[str]) -> None:
    """``frame`` under ``path``, in buckets by ``keys``, in order within them. What was there is replaced.

    The writer wants a table's name; it is dropped again, which leaves the files.
    """
    spark, name = frame.sparkSession, _name()
    try:
        frame.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read(spark: SparkSession, path: str, schema: str, buckets: int, keys: list[str]) -> DataFrame:
    """What ``write`` wrote, known to be in buckets, so that joins and groups by the keys need no shuffle of it."""
    name, by = _name(), ", ".join(keys)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def write_facts(spark: SparkSession, path: str, facts: dict) -> None:
    """What readers of a stored thing need to know of it, written last: without its facts a thing is not finished."""
    spark.range(1).select(F.lit(json.dumps(facts)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def read_facts(spark: SparkSession, path: str) -> dict | None:
    """The facts of what is stored under ``path``; None where nothing is, or nothing finished."""
    if not files.exists(spark, f"{path}/facts/_SUCCESS"):
        return None
    row = spark.read.text(f"{path}/facts").first()
    return json.loads(row["value"]) if row else None


def drop_facts(spark: SparkSession, path: str) -> None:
    """From now on nothing finished is there."""
    files.delete(spark, f"{path}/facts")
