"""Readers of a rule catalogue, of a customer's configuration and of a registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCT = "struct<name:string,vendor:string,streams:array<string>,frameworks:map<string,array<string>>>"
CATALOGUE = f"lead_rules array<struct<id:int,description:string,criteria:string,client_set_id:int,server_set_id:int,product_id:int>>, sets map<string,string>, products map<string,{PRODUCT}>, stream_to_product map<string,struct<product_name:string,vendor:string>>"


def read_catalogue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rules, sets, products, streams) of one JSON document; parts that are absent are empty. A rule without a
    description is named by its number."""
    doc = spark.read.schema(CATALOGUE).json(path, multiLine=True)
    rules = doc.select(F.inline("lead_rules")).select(F.col("id").alias("rule_id"), F.coalesce("description", F.concat(F.lit("Rule-"), F.col("id").cast("string"))).alias("description"), "criteria", F.coalesce("client_set_id", F.lit(0)).alias("client_set_id"), F.coalesce("server_set_id", F.lit(0)).alias("server_set_id"), "product_id")
    sets = doc.select(F.explode("sets").alias("k", "role")).select(F.col("k").cast("int").alias("set_id"), "role")
    products = doc.select(F.explode("products").alias("k", "p")).select(F.col("k").cast("int").alias("product_id"), F.col("p.name").alias("product_name"), F.col("p.vendor").alias("vendor_name"), "p.streams", "p.frameworks")
    streams = doc.select(F.explode("stream_to_product").alias("stream", "p")).select("stream", "p.product_name", F.col("p.vendor").alias("vendor_name"))
    return rules, sets, products, streams


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """(kind, name, value) of a customer's organisations, display names, domains and ids; names that begin with a low line
    are comments."""
    doc = spark.read.schema("organizations map<string,string>, organization_display_names map<string,string>, customer_domains array<string>, organization_ids map<string,string>").json(path, multiLine=True)
    parts = [doc.select(F.lit(kind).alias("kind"), F.explode(column).alias("name", "value")) for kind, column in (("org", "organizations"), ("display", "organization_display_names"), ("org_id", "organization_ids"))]
    parts.append(doc.select(F.lit("domain").alias("kind"), F.explode("customer_domains").alias("name"), F.lit(None).cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(~F.col("name").startswith("_"))


def seeds(config: DataFrame) -> DataFrame:
    """What a registry is grown from before any record is read: a configuration's organisations, display names and domains
    (category, value, record_id, start, as ``grow_registry`` takes them)."""
    kind = F.col("kind")
    rows = config.filter(kind.isin("org", "display", "domain"))
    return rows.select(F.when(kind == "domain", "domain").otherwise("org").alias("category"), F.col("name").alias("value"), kind.alias("record_id"), F.lit(0).alias("start"))


def read_registry(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Entries of a written registry, of one category if named; the filter reaches the files."""
    from ..operators.registry import SCHEMA

    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.filter(F.col("category") == category) if category else rows
