"""Helpers that the operators share: scratch tables in the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import shared_dir

WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Tables written under the shared folder, so that lineage is cut and a lost executor costs no recomputation of earlier steps."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/sievelog/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(conf).delete(path, True)


def rows_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: A key is hot if it has more than one in HOT of all rows, so there are never more hot keys than that.
HOT = 10_000


def met(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``table`` (key, n: its number of rows, ...) on the key. Hot keys are few and are broadcast, so
    their rows stay where they are."""
    hot = table.filter(F.col("n") > max(1000, total // HOT))
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.filter(F.col("n") <= max(1000, total // HOT)), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def fresh(df: DataFrame, prefix: str) -> str:
    """The prefix, made longer until no column begins with it."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix += "_"
    return prefix


def carried(df: DataFrame, names: list[str]) -> list:
    """The columns for a trip through pandas: whole numbers as text, because pandas keeps them beside nulls as floats."""
    whole = ("tinyint", "smallint", "int", "bigint")
    return [F.col(c).cast("string").alias(c) if df.schema[c].dataType.simpleString() in whole else F.col(c) for c in names]


def connected(edges: DataFrame, scratch: Scratch, tag: str = "cc") -> DataFrame:
    """Components of an undirected graph given as (a long, b long): returns (node, root), root the smallest node reachable.

    Minimum labels travel along edges and are then short-cut through the label's own label, so chains shrink
    geometrically. Each round is written to the shared folder. A hub's edges meet its label in a plain join whose
    sides AQE can split, and minima are combined before the shuffle. Without edges there are no rounds: each job takes
    some MB of the driver's memory, however few its rows.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.save(edges.filter("a <> b").select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct(), f"{tag}-edges")
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), f"{tag}-0")
    step = 0
    while True:
        step += 1
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("heard"))
        moved = scratch.save(labels.join(heard, "node").select("node", F.least("root", "heard").alias("root"), F.col("root").alias("old")), f"{tag}-{step}m")
        up = moved.select(F.col("node").alias("root"), F.col("root").alias("top"))
        done = scratch.save(moved.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("old")).alias("changed")), f"{tag}-{step}")
        scratch.drop(f"{tag}-{step}m")
        scratch.drop(f"{tag}-{step - 1}")
        labels = done.select("node", "root")
        if done.filter("changed").isEmpty():
            return labels
