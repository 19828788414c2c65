"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. For a radius r every bit position i gets a vector m(i) of r + 1 bits, and each of the
2^(r+1) - 1 nonzero vectors v gives a table that keeps the bits with <m(i), v> odd. Whatever r positions differ, some
v is orthogonal to their r vectors, so its table keeps none of them: each pair within the radius meets in some table.

A bucket of more than ``bucket`` different fingerprints isn't compared pairwise. There every fingerprint is keyed by
itself and by each of its changes in up to half the radius (rounded up) of the bits outside the table's mask; two
fingerprints within the radius share such a key. A key holds at most as many fingerprints as it has such changes, so
the work stays linear in the bucket and loses no pair.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, connected, fresh

BITS = 64


def fingerprint(text: str | None, ngram: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit integer; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(ngram)), strict=False)) if len(words) >= ngram else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, seed) for s in shingles), dtype=np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The 2^(radius+1) - 1 masks, as signed 64-bit integers."""
    draw, size = random.Random(seed), 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(BITS)]
    draw.shuffle(vectors)
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(prints: DataFrame, scratch: Scratch, radius: int = 2, bucket: int = 64) -> DataFrame:
    """Pairs (a < b) of different fingerprints within the radius. ``prints`` has one row per fingerprint ``fp``."""
    masks = covering_masks(radius)
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"), F.lit(m).alias("mask")) for i, m in enumerate(masks)]))
    keyed = prints.select("fp", table.alias("x")).select("fp", "x.t", "x.key", "x.mask")
    sizes = scratch.save(keyed.groupBy("t", "key").count().filter("count > 1"), "buckets")
    largest = sizes.agg(F.max("count")).first()[0]
    if largest is None:
        return sizes.select(F.col("key").alias("a"), F.col("key").alias("b"))
    members = scratch.save(keyed.join(sizes, ["t", "key"]), "members")
    near = lambda x, y: (F.col(f"{x}.fp") < F.col(f"{y}.fp")) & (F.bit_count(F.col(f"{x}.fp").bitwiseXOR(F.col(f"{y}.fp"))) <= radius)
    small = members.filter(F.col("count") <= bucket).select("t", "key", "fp")
    pairs = small.alias("x").join(small.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.key") == F.col("y.key")) & near("x", "y")).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    if largest <= bucket:
        return pairs.distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - ((1 << BITS) if i == BITS - 1 else 0)).cast("long") for i in range(BITS)])
    free = F.filter(bits, lambda b: b.bitwiseAND(F.col("mask")) == 0)
    changed = members.filter(F.col("count") > bucket).select("t", "key", "fp", "mask", F.col("fp").alias("turned"))
    for _ in range((radius + 1) // 2):
        changed = changed.select("t", "key", "fp", "mask", F.explode(F.transform(free, lambda b: F.col("turned").bitwiseXOR(b))).alias("turned")).distinct()
    large = changed.alias("x").join(changed.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.turned") == F.col("y.turned")) & near("x", "y"))
    return pairs.union(large.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))).distinct()


def simhash_components(docs: DataFrame, radius: int = 2, ngram: int = 3, bucket: int = 64, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: key, the columns in ``keep``, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest key reachable over links of at most ``radius`` differing bits, kept whether the row is
    its component's first. A null or empty text has fingerprint zero. Rows that repeat a key share the result; a null
    key is never a component's id unless the component has no other, and then component_id is null and such rows are
    kept. An empty table gives an empty table. Further columns are ignored unless named in ``keep``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, ngram) for t in texts], dtype="int64")

    rows = scratch.save(docs.select(F.col(key).alias("k"), prints(F.col(text)).alias("fp"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep or [])]), "prints")
    first = scratch.save(rows.groupBy("fp").agg(F.min("k").alias("first")), "first")
    links = scratch.save(near_links(first.select("fp"), scratch, radius, bucket), "links")
    roots = connected(links, scratch)
    tops = scratch.save(roots.join(first.withColumnRenamed("fp", "node"), "node").groupBy("root").agg(F.min("first").alias("top")), "tops")
    named = roots.join(tops, "root").select(F.col("node").alias("fp"), "top")
    first = scratch.save(first.join(named, "fp", "left").select("fp", F.coalesce("top", "first").alias("component_id")), "components")
    out = rows.join(first, "fp")
    kept = F.coalesce(F.col("k") == F.col("component_id"), F.lit(True))
    return out.select(F.col("k").alias(key), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep or [])], F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, radius: int = 2, ngram: int = 5, bucket: int = 64) -> DataFrame:
    """``documents`` with one document of each component: that with the smallest doc_id (see ``keep_first``)."""
    return keep_first(docs, simhash_components(docs, radius, ngram, bucket))


def keep_first(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``documents`` whose doc_id is kept in ``marked`` (doc_id, kept). Rows that repeat a kept doc_id become one row (the
    first by text); rows with a null doc_id stay if their component has no other doc_id."""
    scratch = Scratch(docs.sparkSession, "simhash-kept")
    gone = scratch.save(marked.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("NOT kept").select("doc_id"), "gone")
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    known, unknown = left.filter("doc_id IS NOT NULL"), left.filter("doc_id IS NULL")
    again = Window.partitionBy("doc_id").orderBy("text")
    nth = fresh(docs, "__nth")
    return known.withColumn(nth, F.row_number().over(again)).filter(F.col(nth) == 1).drop(nth).unionByName(unknown)
