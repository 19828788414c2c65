"""Tables written under the folder that driver and executors share, where a plan must be cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a local folder of our own on a local master (tests), the warehouse on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.startswith("local"):
            base = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/sievelog/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read again."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(table: DataFrame) -> DataFrame:
    """A table as it is read, dealt out anew if it comes in fewer parts than there are cores (small files)."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
