"""Streams: every batch writes its own folder, named by its number, so a batch that runs again replaces what it wrote.

A query that dies between writing a batch and committing it runs the same batch again with the same number over the same
rows; it reads only the folders of earlier batches and overwrites its own. What the folders hold together equals what the
batch job makes of all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.labels import label_events
from ..operators.records import Sanitized
from ..operators.registry import SCHEMA, grow_registry


def by_batch(stream: DataFrame, path: str, checkpoint: str, make: Callable[[DataFrame, int], DataFrame], mode: str = "append") -> DataStreamWriter:
    """A writer that puts ``make(rows, batch)`` of every batch into ``path/batch=<number>``."""

    def one(rows: DataFrame, batch: int) -> None:
        make(rows, batch).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(one)


def written(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The rows of all batches, or of those before one, with the batch's number; none if nothing is written yet."""
    try:
        rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch long")
    return rows if before is None else rows.filter(F.col("batch") < before)


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream over a Parquet table, which is a folder that gets files or one file in its folder."""
    path = f"{folder}/{name}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    one = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at).isFile()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.option("pathGlobFilter", name).parquet(folder) if one else reader.parquet(path)


def label_stream(events: DataFrame, rules: DataFrame, sets: DataFrame, products: DataFrame, streams: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Labels of every event, batch by batch; they need nothing of other batches."""
    return by_batch(events, path, checkpoint, lambda rows, _: label_events(rows, rules, sets, products, streams))


def registry_stream(candidates: DataFrame, path: str, checkpoint: str, secret: bytes, order: tuple[str, ...] = ("record_id", "start")) -> DataStreamWriter:
    """The registry's growth: every batch writes the entries that no earlier batch has. ``written(spark, path, SCHEMA)`` is
    the registry; numbers go on from batch to batch, so entries that exist keep their tokens."""

    def grown(rows: DataFrame, batch: int) -> DataFrame:
        held = written(rows.sparkSession, path, SCHEMA, before=batch).drop("batch")
        return grow_registry(held, rows, secret, order).join(held.select("category", "norm"), ["category", "norm"], "left_anti")

    return by_batch(candidates, path, checkpoint, grown)


def sanitized_stream(records: DataFrame, body: str, path: str, checkpoint: str, secret: bytes, customer_domains: tuple[str, ...] = ()) -> DataStreamWriter:
    """Records published as they arrive: a batch first writes its new registry entries under ``path/registry``, then its
    records under ``path/records`` with all tokens known by then. What a later batch registers reaches earlier records
    when ``Sanitized.republished`` is run over them."""

    def one(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        raw = Sanitized.records(rows, body, customer_domains)
        held = written(spark, f"{path}/registry", SCHEMA, before=batch).drop("batch")
        grown = raw.grown(held, secret)
        grown.join(held.select("category", "norm"), ["category", "norm"], "left_anti").write.mode("overwrite").parquet(f"{path}/registry/batch={batch}")
        raw.published(grown).drop("__rid").write.mode("overwrite").parquet(f"{path}/records/batch={batch}")

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one)


def first_leads_stream(leads: DataFrame, path: str, checkpoint: str, key: str = "lead_id", order: tuple[str, ...] = ("incident_id", "pos")) -> DataStreamWriter:
    """The first lead of each id in order, whenever it arrives: the state keeps each id's first one so far, and a batch
    writes the ids whose first one changed. ``first_leads_written`` reads them."""
    others = [c for c in leads.columns if c != key]
    first = leads.filter("has_artifact").groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("x")).select(key, "x.*")
    return by_batch(first, path, checkpoint, lambda rows, _: rows, mode="update")


def first_leads_written(spark: SparkSession, path: str, schema: str, key: str = "lead_id") -> DataFrame:
    """Of each id the lead that its last batch wrote."""
    rows = written(spark, path, schema)
    others = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), "batch").alias("x")).select(key, "x.*")
