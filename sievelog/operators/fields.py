"""Text values of records of any shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_leaves(df: DataFrame, body: str, key: str = "record_id", depth: int = 20) -> DataFrame:
    """(record_id, path, key, value) of the text values of VARIANT records, to a depth of 20.

    Each level's children are exploded; what is left at a level decides whether there is another, so shallow records cost
    few steps.
    """
    spark = df.sparkSession
    level = df.select(F.col(key).alias("record_id"), F.lit("$").alias("path"), F.lit("").alias("key"), F.col(body).alias("v"))
    found = None
    for _ in range(depth):
        child = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "value"))
        path = F.when(F.col("name").isNotNull(), F.concat("path", F.lit("."), "name")).otherwise(F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        child = child.select("record_id", path.alias("path"), F.coalesce("name", "key").alias("key"), F.col("value").alias("v"))
        kind = F.schema_of_variant("v")
        leaves = child.filter(kind == "STRING").select("record_id", "path", "key", F.col("v").cast("string").alias("value"))
        found = leaves if found is None else found.union(leaves)
        level = child.filter(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        if level.isEmpty():
            break
    return found
