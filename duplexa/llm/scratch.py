"""Tables that cut lineage, kept in the folder which the whole cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from duplexa.shipping import ship


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where that is unset, a folder of this machine, if Spark runs on it alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        folder = tempfile.mkdtemp(prefix="duplexa-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Written tables of one operator run: ``save`` writes and rereads, ``drop`` deletes.

    Parquet in shared storage outlives lost executors and is compressed, unlike the
    blocks of a checkpoint. What a result still reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.option("compression", "zstd").parquet(path)
        # Spark deletes a finished step's shuffles once the driver's heap has let go of them, which with much memory it may never do by itself.
        self.spark._jvm.System.gc()
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
