"""The sweep: every place of a registered value in a text, whatever the text's format, gets its token."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import detectors as D
from ..sources.scratch import saved
from .contains import GRAM, contains_join, dictionary, far_places, lowered, parted
from .registry import PRECEDENCE

#: Beginnings and ends of tokens (fixed values); what begins or ends so is never looked for.
TOKEN_STARTS = ("host-", "user-", "org-", "cred-", "machine-", "agent-", "domain-", "redacted-", "192.0.2.", "198.51.100.", "203.0.113.", "100.64.", "s-1-5-21-1000000000", "arn:aws:iam::1000")
TOKEN_ENDS = ("@example.net", ".example.internal", ".example.net")


def patterns(registry: DataFrame) -> DataFrame:
    """(norm, token) of the registry's values of at least four characters that are no tokens; of a value in several
    categories the first by precedence."""
    norm: Column = F.col("norm")
    own = D.is_own_token(norm)
    for s in TOKEN_STARTS:
        own = own | norm.startswith(s)
    for e in TOKEN_ENDS:
        own = own | norm.endswith(e)
    rank = F.array_position(F.array(*[F.lit(c) for c in PRECEDENCE]), F.col("category"))
    kept = registry.filter((F.length("norm") >= GRAM) & ~own)
    return kept.groupBy("norm").agg(F.min_by("sanitized", F.struct(F.when(rank == 0, 99).otherwise(rank), "category")).alias("token"))


def sweep_spans(df: DataFrame, registry: DataFrame, text: str, key: str) -> DataFrame:
    """(record_id, start, len, priority, token) of every place of a registered value; places may overlap."""
    known = saved(patterns(registry), "patterns")
    hits = contains_join(df, text, known, "norm", key)
    return hits.join(known.withColumnRenamed("norm", "word"), "word").select("record_id", "start", F.length("word").alias("len"), F.lit(2).alias("priority"), "token")


def free_spans(spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Of (start, len, priority, token) those that are replaced, by place: each priority in turn takes what the earlier
    ones left, from the left, of two at one place the longer. Every list is sorted once and read once."""
    kept: list[tuple[int, int, str]] = []
    for level in sorted({s[2] for s in spans}):
        mine = sorted((s[0], -s[1], s[3]) for s in spans if s[2] == level)
        merged, end, i = [], 0, 0
        for start, less, token in mine:
            stop = start - less
            while i < len(kept) and kept[i][0] + kept[i][1] <= start:
                merged.append(kept[i])
                i += 1
            if start < end or (i < len(kept) and kept[i][0] < stop):
                continue
            merged.append((start, -less, token))
            end = stop
        kept = merged + kept[i:]
    return kept


def replace_spans(text: str, spans: list[tuple[int, int, int, str]]) -> tuple[str, int]:
    """The text with the tokens of the spans that stay, and their number; start counts from 1."""
    chosen = free_spans(spans)
    parts, end = [], 0
    for start, length, token in chosen:
        parts += [text[end : start - 1], token]
        end = start - 1 + length
    return "".join([*parts, text[end:]]), len(chosen)


def spliced(df: DataFrame, spans: DataFrame, text: str, key: str) -> DataFrame:
    """``df`` with the tokens of its spans (record_id, start, len, priority, token) in the text, and n_replaced.

    Spans of lower priority numbers win an overlap. Null tokens count for nothing, a null text stays null, rows of one
    key share its spans. Texts meet their spans in one join by key; places of one text are gathered, its length bounds
    them.
    """
    lists = spans.filter("token IS NOT NULL").groupBy(F.col("record_id").alias("__id")).agg(F.collect_set(F.struct("start", "len", "priority", "token")).alias("__spans"))
    joined = df.join(lists, F.col(key).eqNullSafe(F.col("__id")), "left")

    @F.pandas_udf("struct<text: string, n: int>")
    def rewrite(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = [(t, 0) if t is None or s is None or not len(s) else replace_spans(t, [(x["start"], x["len"], x["priority"], x["token"]) for x in s]) for t, s in zip(texts, found, strict=True)]
        return pd.DataFrame(rows, columns=["text", "n"])

    new = joined.withColumn("__new", F.when(F.col("__spans").isNotNull(), rewrite(F.col(text), F.col("__spans"))))
    value = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(F.col("__new.text"))
    return new.select(*[value.alias(c) if c == text else F.col(c) for c in df.columns], F.coalesce("__new.n", F.lit(0)).alias("n_replaced"))


def swept(df: DataFrame, registry: DataFrame, text: str, key: str) -> DataFrame:
    """``df`` with a token at every place of a registered value, leftmost first and of two at one place the longer, and
    n_replaced.

    Values that tasks hold (see ``contains``) are found and replaced within the text; only the places of others travel.
    """
    known = saved(patterns(registry), "patterns").withColumnRenamed("norm", "word")
    near, others = parted(dictionary(df, text, known, "word").join(known, "word"))
    sent = df.sparkSession.sparkContext.broadcast(near)
    far = far_places(df, text, key, others)
    spans = "array<struct<start: int, word: string, token: string>>"
    if far is None:
        met = df.withColumn("__spans", F.lit(None).cast(spans))
    else:
        places = far.join(known, "word").groupBy(F.col("record_id").alias("__id"))
        lists = places.agg(F.collect_set(F.struct("start", "word", "token")).cast(spans).alias("__spans"))
        met = df.join(lists, F.col(key).eqNullSafe(F.col("__id")), "left")

    @F.pandas_udf("struct<text: string, n: int>")
    def rewrite(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        entries, token = sent.value, sent.value.rows["token"].tolist()
        low, size, places = [lowered(t or "") for t in texts], entries.size.tolist(), [[] for _ in texts]
        for number, place, entry in entries.places(low):
            for n, at, e in zip(number.tolist(), place.tolist(), entry.tolist(), strict=True):
                places[n].append((at + 1, size[e], 2, token[e]))
        for mine, spans, t in zip(places, found, low, strict=True):
            if spans is not None:  # of all rows of the key, so each is looked up in this one
                mine += [(x["start"], len(x["word"]), 2, x["token"]) for x in spans if t.startswith(x["word"], x["start"] - 1)]
        return pd.DataFrame([replace_spans(t, mine) if mine else (t, 0) for t, mine in zip(texts, places, strict=True)], columns=["text", "n"])

    new = met.withColumn("__new", rewrite(F.col(text), F.col("__spans")))
    value = F.col("__new.text")
    return new.select(*[value.alias(c) if c == text else F.col(c) for c in df.columns], F.col("__new.n").alias("n_replaced"))
