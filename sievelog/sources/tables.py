"""Readers: tolerant NDJSON, event and object tables, catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_lines(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows with ``body`` VARIANT, rows that aren't JSON); blank lines are in neither."""
    parsed = df.filter(F.trim(F.col(column)) != "").withColumn("body", F.try_parse_json(F.col(column)))
    return parsed.filter("body IS NOT NULL"), parsed.filter("body IS NULL").drop("body")


def read_ndjson(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_lines(spark.read.text(path))


def timeuuid_seconds(column: Column) -> Column:
    """Epoch seconds of a time-based UUID."""
    ticks = F.conv(F.concat(F.substring(column, 16, 3), F.substring(column, 10, 4), F.substring(column, 1, 8)), 16, 10).cast("decimal(20,0)")
    return ((ticks - F.lit(122192928000000000).cast("decimal(20,0)")) / 10000000).cast("double")


def read_partitions(events: DataFrame, index: DataFrame, orgs: list[str]) -> DataFrame:
    """Rows of the partitions that the index names for the organisations."""
    return events.join(index.filter(F.col("org_id").isin(orgs)), ["org_id", "partition"], "left_semi")


def read_objects(df: DataFrame, kind: str, orgs: list[str]) -> DataFrame:
    """Objects of the organisations, parsed, with their kind; rows that aren't JSON are left out."""
    good, _ = parse_lines(df.filter(F.col("org_id").isin(orgs)), "object")
    return good.withColumns({"kind": F.lit(kind), "_org_id": F.col("org_id")})


def route(body: Column) -> Column:
    """Which output a record goes to: incident, artifact or other."""
    has = lambda *names: F.coalesce(*[F.try_variant_get(body, f"$.{n}", "variant") for n in names]).isNotNull()
    return F.when(has("nodes") & has("edges"), "incident").when(has("messageType", "messagetype"), "artifact").otherwise("other")


def alias(body: Column, camel: str, kind: str = "string") -> Column:
    """A field under its camel-case or lower-case name; a null counts as absent."""
    return F.coalesce(F.try_variant_get(body, f"$.{camel}", kind), F.try_variant_get(body, f"$.{camel.lower()}", kind))
