"""Places of rows in a whole order, without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import saved


def indexed(df: DataFrame, order: list[str], name: str = "__index", parts: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 0) in the order of the columns; ties in any order.

    Rows are dealt to ranges of the whole order once, sorted there and written with their place in the range; what lies
    before a range is the sum of the sizes of the written ranges before it. So both numbers stem from the same rows.
    """
    many = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(many, *order).sortWithinPartitions(*order)
    placed = saved(ranged.withColumn("__place", F.monotonically_increasing_id()), "ranged")
    part, nth = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))  # one row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("__part", part).join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part").withColumn(name, nth + F.col("__before")).drop("__part", "__before", "__place")
