"""Audits of published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detectors as D
from ..sources.scratch import saved
from .contains import contains_join
from .order import indexed


def string_cells(df: DataFrame, key: str) -> DataFrame:
    """(row_key, name, value) of every string column."""
    names = [c for c, t in df.dtypes if t == "string" and c != key]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in names]))
    return df.select(F.col(key).cast("string").alias("row_key"), cells.alias("x")).select("row_key", "x.*").filter("value <> ''")


def leaks(cells: DataFrame, registry: DataFrame, allowed: DataFrame, least: int = 5) -> DataFrame:
    """(row_key, name, word): original values (no own tokens, no allowed terms, at least ``least`` characters) that cells
    still hold. An address counts only as a whole: 10.1.1.1 is no leak in 10.1.1.12; so addresses are taken out of the cells
    and met by equality, and only other values are looked for within the text. Cells are read more than once: cells that are
    dear to make should be written before."""
    originals = registry.filter(~D.is_own_token(F.col("original")) & (F.length("norm") >= least)).select("norm").distinct()
    originals = saved(originals.join(allowed.select(F.lower("term").alias("norm")), "norm", "left_anti"), "originals")
    is_address = F.col("norm").rlike(f"^(?:{D.IPV4})$")
    keyed = cells.select(F.struct("row_key", "name").alias("record_id"), "value")
    plain = contains_join(keyed, "value", originals.filter(~is_address), "norm").select("record_id.*", "word")
    if originals.filter(is_address).isEmpty():
        return plain.distinct()
    whole = cells.select("row_key", "name", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(D.IPV4), F.lit(0)))).alias("norm"))
    addresses = whole.join(originals.filter(is_address), "norm").select("row_key", "name", F.col("norm").alias("word"))
    return plain.union(addresses).distinct()


def public_addresses(cells: DataFrame) -> DataFrame:
    """Addresses in cells that are neither private, documentation, loopback nor shared ones."""
    found = cells.select("row_key", "name", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(D.IPV4), F.lit(0)))).alias("ip"))
    ip = F.col("ip")
    return found.filter(~(D.is_private_ip(ip) | D.is_loopback_ip(ip) | D.is_sanitized_ip(ip) | ip.isin("0.0.0.0", "255.255.255.255")))


def pattern_hits(cells: DataFrame, patterns: list[str]) -> DataFrame:
    """Cells that match an organisation's or domain's pattern; the patterns are a configuration's, so one alternation."""
    if not patterns:
        return cells.filter("false")
    return cells.filter(F.col("value").rlike("|".join(f"(?:{p})" for p in patterns)))


def label_distribution(df: DataFrame, column: str = "label_binary") -> DataFrame:
    """(label, n, percent), percent with two decimals of all rows."""
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    total: Column = F.col("total")
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("label", "n", F.round(100.0 * F.col("n") / total, 2).alias("percent"))


def no_malicious(distribution: DataFrame) -> DataFrame:
    """One row with a warning if no row is malicious, else none."""
    return distribution.agg(F.count_if(F.col("label") == "malicious").alias("n")).filter("n = 0").select(F.lit("no malicious rows").alias("warning"))


def file_lines(spark, path: str) -> DataFrame:
    """(row_key, name, value): the lines of written text files, for the same checks as cells; the key is the file and the
    line's number in it, from 1. Metadata files are left out. Lines are numbered by ranges, so a large file is many tasks."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    placed = indexed(lines.filter(~F.col("file").rlike("metadata[^/]*$")), ["file", "block", "at"])
    first = placed.groupBy("file").agg(F.min("__index").alias("first"))
    numbered = placed.join(first, "file").withColumn("n", F.col("__index") - F.col("first") + 1)
    return numbered.select(F.concat_ws(":", "file", F.col("n").cast("string")).alias("row_key"), F.lit("line").alias("name"), "value")


def all_checks(cells: DataFrame, registry: DataFrame, patterns: list[str], allowed: DataFrame | None = None, leaks_too: bool = True) -> DataFrame:
    """(kind, severity, row_key, name, detail) of every check: registry values left behind, organisation patterns, public
    addresses, tokens that stand for several values."""
    from .registry import collisions

    row = lambda df, kind, severity, key, name, detail: df.select(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), key.alias("row_key"), name.alias("name"), detail.alias("detail"))
    c = F.col
    out = row(pattern_hits(cells, patterns), "pattern", "violation", c("row_key"), c("name"), F.substring("value", 1, 100))
    out = out.union(row(public_addresses(cells), "public_address", "warning", c("row_key"), c("name"), c("ip")))
    out = out.union(row(collisions(registry), "collision", "violation", c("sanitized"), F.lit("registry"), c("n_originals").cast("string")))
    if leaks_too:
        none = cells.sparkSession.createDataFrame([], "term string")
        out = out.union(row(leaks(cells, registry, allowed if allowed is not None else none), "registry_value", "violation", c("row_key"), c("name"), c("word")))
    return out


def report(checks: DataFrame, labels: DataFrame, most: int = 50) -> DataFrame:
    """(section, value, n): numbers of each severity, at most ``most`` details of each, and the label distribution."""
    counts = checks.groupBy(F.col("severity").alias("value")).agg(F.count("*").alias("n")).select(F.lit("count").alias("section"), "value", "n")
    out = counts
    for severity in ("violation", "warning"):
        detail = F.concat_ws(" ", "kind", "row_key", "name", "detail")
        out = out.union(checks.filter(F.col("severity") == severity).select(F.lit(f"{severity}_detail").alias("section"), detail.alias("value"), F.lit(1).cast("long").alias("n")).orderBy("value").limit(most))
    return out.union(labels.select(F.lit("label").alias("section"), F.col("label").alias("value"), "n"))
