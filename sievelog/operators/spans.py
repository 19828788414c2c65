"""Spans of sensitive values in text, found on the raw text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detectors as D

#: Two characters that Unicode keeps out of text; where a text holds them all the same, they become blanks.
OPEN, CLOSE = "\uFDD0", "\uFDD1"

#: (category, pattern, group, priority): of the general text format. An earlier step wins an overlap.
GENERAL = (("sid", D.SID, 0, 1), ("email", D.EMAIL, 0, 2), ("arn", D.ARN, 0, 3), ("aws_account", D.ACCOUNT_ID, 0, 4), ("machine_account", D.MACHINE, 0, 5), ("fqdn", D.FQDN, 0, 6), ("ipv4", D.IPV4, 0, 7))


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """(value, start) of each match, or of a group's part of it, in order; start counts from 1. One pass over the text."""
    whole = f"({pattern})" if group == 0 else pattern
    replaced = f"{OPEN}$1{CLOSE}" if group == 0 else f"{OPEN}${group}{CLOSE}"
    clean = F.translate(text, OPEN + CLOSE, "  ")
    pieces = F.split(F.regexp_replace(clean, F.lit(whole), F.lit(replaced)), f"[{OPEN}{CLOSE}]", -1)
    # Characters before each piece, as a running sum.
    ends = F.aggregate(pieces, F.array(F.lit(1)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))
    odd = F.sequence(F.lit(2), F.size(pieces) - 1, F.lit(2))
    return F.when(F.size(pieces) > 1, F.transform(odd, lambda k: F.struct(F.element_at(pieces, k).alias("value"), F.element_at(ends, k).alias("start"))))


def spans(df: DataFrame, text: str, detectors=GENERAL, key: str = "record_id", public_domains: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, start, len, category, value, priority) of all matches; start counts from 1.

    Addresses are split into private and public ones; loopback, sanitized addresses and names under public domains are no
    spans. Patterns are matched whole (group 0); the text travels no further than the detection.
    """
    def hits(category: str, pattern: str, priority: int) -> Column:
        named = F.transform(places(F.col(text), pattern), lambda v: F.struct(F.lit(category).alias("category"), v["value"].alias("value"), v["start"].alias("start"), F.lit(priority).alias("priority")))
        return F.coalesce(named, F.array().cast("array<struct<category:string,value:string,start:int,priority:int>>"))

    found = F.concat(*[hits(category, pattern, priority) for category, pattern, _, priority in detectors])
    values = df.select(F.col(key).alias("record_id"), F.explode(found).alias("x")).select("record_id", "x.*")
    value = F.col("value")
    category = F.when(F.col("category") == "ipv4", F.when(D.is_private_ip(value), "ipv4_priv").otherwise("ipv4_pub")).otherwise(F.col("category"))
    values = values.withColumn("category", category).filter(~(F.col("category").startswith("ipv4") & (D.is_loopback_ip(value) | D.is_sanitized_ip(value) | value.isin("0.0.0.0", "255.255.255.255"))))
    if public_domains:
        values = values.filter(~((F.col("category") == "fqdn") & D.public_domain(value, list(public_domains))))
    return values.select("record_id", "start", F.length("value").alias("len"), "category", "value", "priority")


def best_chain(found: list[tuple[int, int, float]]) -> list[int]:
    """Numbers of the (start, len, score) that stay, which come by start and then from the best score: of each that overlaps
    the last one, the better; the earlier of two that are as good."""
    kept: list[int] = []
    for i, (start, _, score) in enumerate(found):
        if kept and start < found[kept[-1]][0] + found[kept[-1]][1]:
            if score > found[kept[-1]][2]:
                kept[-1] = i
        else:
            kept.append(i)
    return kept


def best_score(items: Column) -> Column:
    """Of structs sorted by (start, -score), a chain without overlaps in which a better-scored one takes the last one's place.
    Every record's structs are read once."""

    @F.pandas_udf("array<int>")
    def chosen(starts: pd.Series, lengths: pd.Series, scores: pd.Series) -> pd.Series:
        return pd.Series([best_chain(list(zip(*row, strict=True))) for row in zip(starts, lengths, scores, strict=True)])

    of = lambda name: F.transform(items, lambda x: x[name])
    return F.transform(chosen(of("start"), of("len"), of("score")), lambda i: F.element_at(items, i + 1))
