"""Residual findings: scored patterns on a sample, a review queue, findings that come back, and the loop over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import allowlists as A
from ..functions import detectors as D
from ..sources.scratch import saved
from .labels import stratified
from .registry import grow_registry, norm
from .spans import best_score, places

#: (entity, pattern, score, words nearby that add to it): fixed values.
SCORED = (
    ("AWS_ACCOUNT_ID", D.ACCOUNT_ID, 0.4, ("aws", "account", "arn", "iam", "cloudtrail", "trustedadvisor")), ("MACHINE_ACCOUNT", D.MACHINE, 0.6, ()),
    ("EMAIL_ADDRESS", D.EMAIL, 0.9, ()), ("IP_ADDRESS", D.IPV4, 0.6, ()),
)
ENTITY_CATEGORY = {"PERSON": "username", "NER_PER": "username", "ORGANIZATION": "org", "NER_ORG": "org", "EMAIL_ADDRESS": "email", "IP_ADDRESS": "ipv4_pub", "AWS_ACCOUNT_ID": "aws_account", "MACHINE_ACCOUNT": "machine_account"}
REVIEW_CATEGORY = {"org": "org", "hostname": "hostname", "username": "username", "domain": "domain", "credential": "credential", "ip": "ipv4_pub"}


def mapped_category(kind: Column, value: Column, table: dict[str, str]) -> Column:
    """Registry category of a finding; null where none. Addresses are split into private and public ones."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), kind)
    return F.when((found == "ipv4_pub") & D.is_private_ip(value), "ipv4_priv").otherwise(found)


def sampled(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows by a hash of their key: the same rows in every run."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def residual_findings(df: DataFrame, text: str, key: str = "record_id", detectors=SCORED, least: float = 0.5, window: int = 40, bonus: float = 0.35, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(record_id, entity, start, len, value, score) that sanitized texts still hold, of at least the score, without
    overlaps: of two, the better one.

    A word of the detector's context within ``window`` characters adds ``bonus``. Allowed terms and own tokens are no
    findings. ``more``: a further detector (of a model, say) that returns the same columns.
    """
    whole = F.lower(F.coalesce(F.col(text), F.lit("")))

    def hits(entity: str, pattern: str, base: float, context: tuple[str, ...]) -> Column:
        def finding(v: Column) -> Column:
            near = F.substring(whole, F.greatest(F.lit(1), v["start"] - window), F.length(v["value"]) + 2 * window)
            gain = F.when(near.rlike("|".join(context)), bonus).otherwise(0.0) if context else F.lit(0.0)
            return F.struct(F.lit(entity).alias("entity"), v["start"].alias("start"), F.length(v["value"]).alias("len"), v["value"].alias("value"), (F.lit(base) + gain).alias("score"))

        return F.coalesce(F.transform(places(F.col(text), pattern), finding), F.array().cast("array<struct<entity:string,start:int,len:int,value:string,score:double>>"))

    found = df.select(F.col(key).alias("record_id"), F.explode(F.concat(*[hits(*d) for d in detectors])).alias("x")).select("record_id", "x.*")
    if more is not None:
        found = found.unionByName(more(df))
    found = found.filter((F.col("score") >= least) & (F.length("value") > 2) & ~A.is_allowed(F.col("value")) & ~D.is_own_token(F.col("value")))
    # Of findings that overlap, the better: they meet within a record, by place.
    item = F.struct("start", (-F.col("score")).alias("worse"), "entity", "len", "value", "score")
    best = found.groupBy("record_id").agg(best_score(F.array_sort(F.collect_set(item))).alias("items"))
    return best.select("record_id", F.explode("items").alias("x")).select("record_id", "x.entity", "x.start", "x.len", "x.value", "x.score")


def model_detector(predict: Callable[[list[str]], list[list[tuple[str, int, int, float]]]], text: str, key: str = "record_id", least: float = 0.75) -> Callable[[DataFrame], DataFrame]:
    """A detector for ``residual_findings`` from a model: ``predict`` gets a batch of texts and gives for each its findings
    (entity, start counted from 1, length, score). It is called in the tasks, on Arrow batches; findings below ``least``
    go."""

    def detect(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(key).alias("record_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [(k, e, s, n, t[s - 1 : s - 1 + n], p) for k, t, each in zip(batch["record_id"], batch["text"], predict(batch["text"].tolist()), strict=True) for e, s, n, p in each if p >= least]
                yield pd.DataFrame(found, columns=["record_id", "entity", "start", "len", "value", "score"])

        return rows.mapInPandas(run, f"record_id {rows.schema['record_id'].dataType.simpleString()}, entity string, start int, len int, value string, score double")

    return detect


def review_queue(records: DataFrame, strata: list[str], key: str, text: str, rate: float = 0.001, per_batch: int = 5, width: int = 2000) -> DataFrame:
    """(strata, batch, keys, text): a stratified sample in batches of texts cut to ``width`` characters."""
    picked = stratified(records, strata, rate, key, per_batch).withColumn("__item", F.struct("nth", F.col(key).alias("key"), F.substring(text, 1, width).alias("text")))
    items = picked.groupBy(*strata, "batch").agg(F.array_sort(F.collect_list("__item")).alias("x"))
    return items.select(*strata, "batch", F.transform("x", lambda i: i["key"]).alias("keys"), F.array_join(F.transform("x", lambda i: i["text"]), "\n---\n").alias("text"))


def json_array(text: Column) -> Column:
    """A JSON array in free text (VARIANT): the whole text, a fenced block, or from the first bracket to the last."""
    listed = lambda t: F.when(F.schema_of_variant(F.try_parse_json(t)).startswith("ARRAY"), F.try_parse_json(t))
    return F.coalesce(listed(text), listed(F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```", 1), F.lit(""))), listed(F.nullif(F.regexp_extract(text, r"(?s)(\[.*\])", 1), F.lit(""))))


def ingest_findings(answers: DataFrame, text: str, least: float = 0.5, key: str = "record_id") -> DataFrame:
    """Candidates (record_id, start, category, value) from reviewers' answers; unclear or short findings are left out."""
    rows = answers.select(F.col(key).alias("record_id"), F.posexplode(json_array(F.col(text)).try_cast("array<struct<span:string,category:string,confidence:double>>")).alias("start", "x"))
    rows = rows.filter((F.col("x.confidence") >= least) & (F.length("x.span") >= 3))
    return rows.select("record_id", "start", mapped_category(F.col("x.category"), F.col("x.span"), REVIEW_CATEGORY).alias("category"), F.col("x.span").alias("value")).filter("category IS NOT NULL")


def issue_rates(reviewed: DataFrame, findings: DataFrame, strata: list[str], key: str, threshold: float = 0.02) -> DataFrame:
    """(strata, reviewed, found, rate) of strata with more findings per reviewed record than the threshold."""
    counts = findings.groupBy(key).agg(F.count("*").alias("__n"))
    rates = reviewed.join(counts, key, "left").groupBy(*strata).agg(F.count("*").alias("reviewed"), F.coalesce(F.sum("__n"), F.lit(0)).alias("found"))
    return rates.withColumn("rate", F.col("found") / F.col("reviewed")).filter(F.col("rate") > threshold)


def converge(registry: DataFrame, detect: Callable[[DataFrame], DataFrame], secret: bytes, cycles: int = 5) -> tuple[DataFrame, list[int]]:
    """Grow the registry by what ``detect(registry)`` still finds until a cycle finds nothing new; returns it and the number
    of new entries of each cycle. Each cycle's registry is written, so no cycle computes those before it again."""
    grown = []
    for _ in range(cycles):
        found = detect(registry).withColumn("norm", norm(F.col("value"))).join(registry.select("category", "norm"), ["category", "norm"], "left_anti").drop("norm")
        before = registry.count()
        registry = saved(grow_registry(registry, found, secret), "registry")
        grown.append(registry.count() - before)
        if not grown[-1]:
            break
    return registry, grown
