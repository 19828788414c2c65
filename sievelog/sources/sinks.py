"""Published folders: written aside, counted while written, put in place by one rename of a manifest.

``path/<version>/<part>`` holds the parts of a publication and ``path/manifest.json`` names the version that counts. A reader
sees the earlier version or the new one, never a mixture; a run that dies leaves a version that nothing names, and the next
one that succeeds removes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import route

MANIFEST = "manifest.json"


def _files(spark: SparkSession, path: str):
    """(file system, path) in Hadoop's terms."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


class Publication:
    """Parts written for one path. ``part`` writes and counts; ``commit`` makes them the path's content."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.version = spark, path.rstrip("/"), uuid.uuid4().hex
        self.parts: dict[str, dict[str, int]] = {}

    def part(self, name: str, df: DataFrame, write: Callable[[DataFrame, str], None], **metrics: Column) -> dict[str, int]:
        """Write ``df`` as a part; its rows and the named aggregates are observed by the job that writes it."""
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), f"{self.path}/{self.version}/{name}")
        self.parts[name] = {k: int(v) for k, v in seen.get.items()}
        return self.parts[name]

    def commit(self) -> dict:
        """Name this version in the manifest and remove all others. Returns the manifest."""
        manifest = {"version": self.version, "parts": self.parts}
        fs, waiting = _files(self.spark, f"{self.path}/{MANIFEST}.{self.version}")
        out = fs.create(waiting, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(waiting), fs.makeQualified(_files(self.spark, f"{self.path}/{MANIFEST}")[1]), options)
        for entry in fs.listStatus(_files(self.spark, self.path)[1]):
            if entry.getPath().getName() not in (self.version, MANIFEST):
                fs.delete(entry.getPath(), True)
        return manifest


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What is published under a path; None if nothing is."""
    fs, at = _files(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not fs.exists(at):
        return None
    return json.loads(spark.read.text(f"{path.rstrip('/')}/{MANIFEST}", wholetext=True).first()[0])


def part_path(spark: SparkSession, path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{manifest(spark, path)['version']}/{name}"


# ---- writers


def as_text(*by: str) -> Callable[[DataFrame, str], None]:
    """Lines of the column ``value``, a folder for each value of ``by``."""
    return lambda df, path: df.write.partitionBy(*by).text(path) if by else df.write.text(path)


def as_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def publish_records(lines: DataFrame, path: str, column: str = "value") -> dict[str, dict[str, int]]:
    """JSON lines under their route (artifact, incident, other), what isn't JSON under ``quarantine`` with its line; blank
    lines count only. Returns the run's statistics: rows of each kind, counted by the jobs that write."""
    from .tables import parse_lines

    out = Publication(lines.sparkSession, path)
    good, bad = parse_lines(lines, column)
    kind = F.col("route")
    routed = good.select(route(F.col("body")).alias("route"), F.to_json("body").alias("value"))
    out.part("records", routed, as_text("route"), **{r: F.count_if(kind == r) for r in ("artifact", "incident", "other")})
    out.part("quarantine", bad.select(F.col(column).alias("value")), as_text())
    return out.commit()["parts"]


def publish_graph(nodes: DataFrame, edges: DataFrame, labelled: DataFrame, order: list[str], path: str, node_attributes: list[str]) -> dict:
    """The graph's files: nodes and numbered edges as JSON lines, GraphML (lines in order; a range of them is one file),
    node-link JSON, a GraphML document for each incident, the incidents themselves, and the counts. Returns the manifest."""
    from ..operators import graph

    out = Publication(nodes.sparkSession, path)
    shown = lambda df: df.select(F.to_json(F.struct("*")).alias("value"))
    out.part("nodes", shown(nodes.select("node_id", "node_type", *node_attributes)), as_text())
    numbered = graph.numbered(edges, order)
    out.part("edges", shown(numbered), as_text())
    out.part("graphml", graph.graphml(nodes, edges, order).orderBy("section", "place").select(F.col("line").alias("value")), as_text())
    out.part("node_link", graph.node_link(nodes, edges, order[0], ["edge_type"]).select("section", F.col("line").alias("value")), as_text("section"))
    out.part("incident_graphml", graph.incident_graphml(labelled), as_parquet)
    out.part("incidents", labelled, as_parquet)
    kinds = graph.distributions(edges, ["label_binary", "edge_type"]).unionByName(graph.distributions(nodes, ["node_type"]))
    out.part("metadata", shown(kinds), as_text())
    return out.commit()
