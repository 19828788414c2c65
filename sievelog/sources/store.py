"""The event and object stores that records are extracted from: tables laid out by organisation and partition.

An index names each organisation's partitions. Readers join it on the folders' columns, so Spark reads only the folders
that the index leaves (dynamic partition pruning), and the index is a table of one row a folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import parse_lines, timeuuid_seconds

EVENT = "created_at string, artifact_json string, org_id string, partition string"
OBJECT = "id string, created_at string, partition string, object string, kind string, org_id string"
#: Object tables and what each is called once extracted (fixed values); the third has ids instead of partitions.
KINDS = {"incidents": "incidents", "nodes": "nodes", "threat_hits": "threat_hits", "incident_summary": "incident_summaries"}


def write_events(events: DataFrame, path: str) -> None:
    """Events (org_id, partition, created_at, artifact_json), a folder for each organisation and partition. Rows are dealt by
    a hash of the row within each folder, so a partition that holds a third of all rows is many tasks."""
    events.select("org_id", "partition", "created_at", "artifact_json").write.mode("overwrite").partitionBy("org_id", "partition").parquet(path)


def partition_index(events: DataFrame) -> DataFrame:
    """(org_id, partition, day, first_created_at) of the folders that hold anything."""
    first = F.min(timeuuid_seconds(F.col("created_at")))
    return events.groupBy("org_id", "partition").agg(first.alias("first_created_at")).select("org_id", "partition", F.to_date(F.timestamp_seconds("first_created_at")).alias("day"), "first_created_at")


def read_events(spark: SparkSession, path: str, index: DataFrame, orgs: list[str], newest: int = 0) -> tuple[DataFrame, DataFrame]:
    """(records, bad rows) of the organisations' partitions in the index, of each organisation's newest days if a number is
    named. A record has its ``body`` (VARIANT), ``_partition``, ``_created_at`` (seconds; 0 without an id) and
    ``_created_at_uuid``; what isn't JSON is a bad row."""
    from ..operators.labels import newest_periods

    wanted = newest_periods(index.filter(F.col("org_id").isin(orgs)), newest).select("org_id", "partition")
    stored = spark.read.schema(EVENT).parquet(path)
    rows = stored.join(F.broadcast(wanted) if small(wanted) else wanted, ["org_id", "partition"])
    good, bad = parse_lines(rows, "artifact_json")
    return good.select("org_id", "body", F.col("partition").alias("_partition"), seconds("created_at").alias("_created_at"), F.col("created_at").alias("_created_at_uuid")), bad


#: Rows of an index up to which it is broadcast: a few MB.
SMALL = 100_000


def small(df: DataFrame) -> bool:
    return df.limit(SMALL + 1).count() <= SMALL


def seconds(column: str) -> Column:
    return F.coalesce(timeuuid_seconds(F.col(column)), F.lit(0.0))


def write_objects(objects: DataFrame, path: str) -> None:
    """Objects (kind, org_id, id, created_at, partition, object), a folder for each kind and organisation."""
    objects.select("kind", "org_id", "id", "created_at", "partition", "object").write.mode("overwrite").partitionBy("kind", "org_id").parquet(path)


def read_objects(spark: SparkSession, path: str, orgs: list[str], kinds: tuple[str, ...] = tuple(KINDS)) -> tuple[DataFrame, DataFrame]:
    """(records, bad rows) of all kinds in one table: ``kind``, ``body``, ``_org_id``, and ``_partition`` with
    ``_created_at``, or for threat hits ``_threat_id``."""
    stored = spark.read.schema(OBJECT).parquet(path).filter(F.col("org_id").isin(orgs) & F.col("kind").isin(*kinds))
    good, bad = parse_lines(stored, "object")
    hit = F.col("kind") == "threat_hits"
    name = F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), F.col("kind"))
    return good.select(name.alias("kind"), "body", F.col("org_id").alias("_org_id"), F.when(~hit, F.col("partition")).alias("_partition"), F.when(~hit, seconds("created_at")).alias("_created_at"), F.when(hit, F.col("id")).alias("_threat_id")), bad


def with_metadata(records: DataFrame, body: str = "body") -> Column:
    """The record's JSON text with its metadata columns (names that begin with a low line) as further fields; a column that
    is null leaves no field."""
    meta = [F.col(c) for c in records.columns if c.startswith("_") and c != "_metadata"]
    text, more = F.to_json(F.col(body)), F.to_json(F.struct(*meta))
    inner = F.substring(text, 2, F.length(text) - 2)
    added = F.substring(more, 2, F.length(more) - 2)
    return F.concat(F.lit("{"), F.concat_ws(",", F.nullif(inner, F.lit("")), F.nullif(added, F.lit(""))), F.lit("}"))


def write_extract(records: DataFrame, path: str, by: tuple[str, ...] = ("org_id", "_partition")) -> None:
    """NDJSON of extracted records, a folder for each value of ``by``; those columns stay in the records too."""
    lines = records.select(*[F.col(c).alias(f"{c.lstrip('_')}") for c in by], with_metadata(records).alias("value"))
    lines.write.mode("overwrite").partitionBy(*[c.lstrip("_") for c in by]).text(path)
