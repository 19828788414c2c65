"""Published forms: the flat signal table, its files and its metadata, routed records, the review sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of the flat table in order: name, columns it may come from, default. Lists become JSON text.
SIGNAL = (
    ("timestamp", ("_created_at", "epoch"), 0.0), ("message_type", ("message_type", "messageType"), ""), ("stream_name", ("stream", "streamName"), ""), ("pipeline", ("pipeline", "pipelineName"), ""),
    ("src_ip", ("client_ip", "clientIP"), ""), ("dst_ip", ("server_ip", "serverIP"), ""), ("src_port", ("client_port", "clientPort"), ""), ("dst_port", ("server_port", "serverPort"), ""), ("protocol", ("protocol",), ""),
    ("src_host", ("client_host", "senderHost"), ""), ("dst_host", ("server_host", "serverHostname"), ""), ("username", ("username", "userName"), ""), ("action", ("action",), ""), ("severity", ("severity", "severityLabel"), ""), ("vendor_code", ("vendor_code", "vendorCode"), ""),
    ("message_sanitized", ("message",), ""), ("label_binary", ("label_binary",), "unknown"), ("label_confidence", ("label_confidence",), 0.0), ("attack_techniques", ("attack_techniques",), None), ("attack_tactics", ("attack_tactics",), None), ("defense_techniques", ("defense_techniques",), None),
    ("mo_name", ("mo_name",), ""), ("suspicion_score", ("suspicion", "suspicion_score"), 0.0), ("lifecycle_stage", ("lifecycle_stage",), ""), ("disposition", ("disposition",), "Unprocessed"), ("disposition_category", ("disposition_category",), "automated"), ("is_false_positive", ("is_false_positive",), False), ("status_name", ("status_name",), ""),
    ("incident_ids", ("incident_ids",), None), ("matched_rules", ("matched_rules",), None), ("set_roles", ("set_roles",), None), ("product_name", ("product_name",), ""), ("vendor_name", ("vendor_name",), ""),
)


def to_signal(events: DataFrame) -> DataFrame:
    """The flat table of 33 columns. A field that is missing or null has its default; further columns are left out."""
    out = []
    for name, sources, default in SIGNAL:
        held = [F.col(c) for c in sources if c in events.columns]
        if default is None:
            value = F.to_json(F.coalesce(*held, F.array().cast("array<string>"))) if held else F.lit("[]")
        else:
            kind = {str: "string", float: "double", bool: "boolean"}[type(default)]
            value = F.coalesce(*[c.cast(kind) for c in held], F.lit(default))
        out.append(value.alias(name))
    return events.select(*out)


def write_signal(signal: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """CSV and Parquet under ``path``, in order of time; a range of times is one task, and a file holds so many rows at most."""
    ordered = signal.orderBy(F.col("timestamp").asc_nulls_last())
    ordered.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(f"{path}/signals.csv")
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/signals.parquet")


def signal_metadata(signal: DataFrame) -> DataFrame:
    """(name, value, n): the number of records, the columns, and how often each type, label and stream occurs."""
    kinds = {"message_type_distribution": "message_type", "label_distribution": "label_binary", "stream_distribution": "stream_name"}
    pairs = F.explode(F.array(F.struct(F.lit("total_records").alias("name"), F.lit("").alias("value")), *[F.struct(F.lit(k).alias("name"), F.col(c).alias("value")) for k, c in kinds.items()]))
    counts = signal.select(pairs.alias("x")).groupBy("x.name", "x.value").agg(F.count("*").alias("n"))
    columns = signal.sparkSession.createDataFrame([("column", c, i) for i, c in enumerate(signal.columns)], "name string, value string, n long")
    return counts.unionByName(columns)


def most_common(counts: DataFrame, n: int = 5) -> DataFrame:
    """The n values that occur most; ties by value."""
    return counts.orderBy(F.col("n").desc(), "value").limit(n)


def serialized(df: DataFrame) -> Column:
    """A row as JSON: bytes as lower-case hex, times as ISO text."""
    shown = {"binary": lambda c: F.lower(F.hex(c)), "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), "date": lambda c: c.cast("string")}
    return F.to_json(F.struct(*[shown.get(t, lambda c: c)(F.col(c)).alias(c) for c, t in df.dtypes]))


def write_records(df: DataFrame, path: str, by: list[str]) -> None:
    """NDJSON of the rows, a folder for each value of the columns ``by``."""
    df.select(*by, serialized(df).alias("value")).write.mode("overwrite").partitionBy(*by).text(path)


def write_routed(records: DataFrame, path: str, body: str = "body") -> None:
    """Records as JSON lines under incident, artifact and other."""
    from ..sources.tables import route

    records.select(route(F.col(body)).alias("route"), F.to_json(body).alias("value")).write.mode("overwrite").partitionBy("route").text(path)


def write_incidents(incidents: DataFrame, path: str) -> int:
    """Incidents as they are, and how many."""
    incidents.write.mode("overwrite").parquet(path)
    return incidents.sparkSession.read.parquet(path).count()


def review_sample(messages: DataFrame, text: str, key: str, n: int = 100, width: int = 500) -> DataFrame:
    """At most n messages by a hash of their key, cut to ``width`` characters."""
    return messages.orderBy(F.xxhash64(key), key).limit(n).select(key, F.substring(text, 1, width).alias(text))
