"""Near copies by SimHash fingerprints and by the Jaccard similarity of word shingles.

Fingerprints within ``radius`` bits link their texts, as in operator 4 (its fingerprints, its covering masks). That reaches
the closest copies only, so texts of similar shingle sets are linked too, and both kinds of links make one set of components.

A similarity of 0.8 leaves some 10 of a SimHash's 64 bits different (up to 20 in unlucky pairs), where a covering has a
million masks and unrelated fingerprints meet too. Candidates therefore come from MinHash: ``bands`` keys of ``rows``
minima each. Two texts of similarity s share no key with probability (1 - s^rows)^bands, at 0.8 with 40 keys of 4 about
7 in 10^10. Candidates are compared by their exact sets of shingles.

Components are asked for, not pairs: members of a bucket are first compared with the bucket's smallest one and with its
most central one, so a bucket full of copies of one text stays linear. Members of different components are then joined by
the rarest shingles of their sets (prefix filter, exact), so a bucket full of texts that only share a passage does too.
Texts of equal shingle sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected
from .simhash import fingerprint, keep_first, near_links


def shingle_set(text: str | None, ngram: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted different XXH64 of all word shingles; a text of fewer words is one shingle, one of none the empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    shingles = map(b" ".join, zip(*(words[i:] for i in range(ngram)), strict=False)) if len(words) >= ngram else iter([b" ".join(words)])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, seed) for s in shingles), dtype="<u8"))


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


#: Bounds that are computed from the threshold give way by so much, so that rounding loses no pair.
SLACK = 1e-6


class Minima:
    """Keys of a shingle set: ``bands`` hashes of ``rows`` minima each, over the upper halves of the shingles' hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.bands = bands
        self.factors = draw.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = draw.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def keys(self, shingles: np.ndarray) -> list[int]:
        low = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        tops = (shingles >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(tops), 256):
            low = np.minimum(low, (tops[i : i + 256, None] * self.factors + self.shifts).min(0))
        return [xxhash.xxh3_64_intdigest(b.tobytes()) - (1 << 63) for b in low.astype("<u4").reshape(self.bands, -1)]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def prefixes(sets: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(node, size, h, before, onward): of each set, the shingles in its prefix that another set holds too, with the number
    of such shingles before each in the set's order, and of shingles from it onward.

    A set of n shingles, rarest first, has a prefix of n - ceil(threshold n) + 1. Two sets alike share a shingle that is in
    the prefix of both, so a passage that thousands share brings no two together unless it makes up most of them.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, packed in zip(batch["node"], batch["shingles"], strict=True):
                h = np.frombuffer(packed, "<i8")
                for i in range(0, len(h), 1 << 16):
                    yield pd.DataFrame({"node": node, "size": len(h), "h": h[i : i + (1 << 16)]})

    held = scratch.save(sets.select("node", "shingles").mapInPandas(spread, "node long, size long, h long"), "shingles")
    holders = held.groupBy("h").agg(F.count("*").alias("holders")).filter("holders > 1")
    order = held.join(holders, "h").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("holders", "h"))).alias("common"))
    length, lone = F.col("size") - F.ceil(F.col("size") * threshold - SLACK) + 1, F.col("size") - F.size("common")
    short = order.select("node", "size", "common", lone.alias("lone"), (length - lone).cast("int").alias("take")).filter("take > 0")
    return short.select("node", "size", "lone", F.posexplode(F.slice("common", 1, F.col("take")))).select("node", "size", F.col("col.h").alias("h"), F.col("pos").alias("before"), (F.col("size") - F.col("lone") - F.col("pos")).alias("onward"))


def fingerprint_links(signed: DataFrame, radius: int) -> DataFrame:
    """(a, b): nodes whose texts' fingerprints (node, fp) differ in at most ``radius`` bits, each fingerprint by one of its
    nodes, with which its other nodes are linked. They aren't saved: read them once."""
    scratch = Scratch(signed.sparkSession, "shingle-prints")
    first = scratch.save(signed.groupBy("fp").agg(F.min("node").alias("first")), "first")
    alike = signed.select("fp", "node").distinct().join(first, "fp").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    near = scratch.save(near_links(first.select("fp"), scratch, radius), "near")
    if near.isEmpty():
        return alike
    left, right = (first.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_node")) for c in "ab")
    return alike.union(near.join(left, "a").join(right, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def shingle_components(docs: DataFrame, threshold: float = 0.8, ngram: int = 5, bands: int = 40, rows: int = 4, key: str = "doc_id", text: str = "text", radius: int | None = None) -> DataFrame:
    """One row per input row: key, component_id (smallest key reachable over links of at least ``threshold`` and, with a
    ``radius``, over fingerprints within it), kept (whether the row is its component's first).

    Null, empty and blank texts are equal. Rows that repeat a key share no result unless their texts do; a null key is
    never a component's id unless the component has no other, and then component_id is null and such rows are kept. An
    empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "shingles")
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("body"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        minima = Minima(bands, rows)
        for batch in batches:
            sets = [shingle_set(t, ngram) for t in batch["body"]]
            prints = [0 if radius is None else fingerprint(t) for t in batch["body"]]
            yield pd.DataFrame({"k": batch["k"].astype("Int64"), "node": [node_of(s) for s in sets], "bands": [minima.keys(s) for s in sets], "fp": np.array(prints, np.int64)})

    signed = scratch.save(source.mapInPandas(sign, "k long, node long, bands array<long>, fp long"), "signed")
    nodes = scratch.save(signed.groupBy("node").agg(F.min("k").alias("first"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = keyed.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = scratch.save(keyed.join(shared, ["band", "bucket"]), "members")

    # Shingles of the nodes that share a bucket, from the texts: one text of each.
    asked = scratch.save(members.groupBy("node").agg(F.sum("n").alias("weight")).join(nodes.select("node", "first"), "node"), "asked")

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, ngram) for t in batch["body"]]
            yield pd.DataFrame({"node": [node_of(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    wanted = asked.select(F.col("first").alias("first_k")).distinct()
    texts = source.join(wanted, source["k"].eqNullSafe(wanted["first_k"]), "left_semi")
    sets = scratch.save(texts.mapInPandas(collect, "node long, shingles binary").join(asked.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) >= threshold for x, y in zip(a, b, strict=True)], dtype=bool)

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Of pairs (a, b), those that are alike."""
        left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
        pairs = scratch.save(pairs.distinct(), name + "-p")
        if pairs.isEmpty():
            return pairs
        held = pairs.distinct().join(left, "a").join(right, "b")
        return scratch.save(held.filter(alike("a_set", "b_set")).select("a", "b"), name)

    # The text that meets most others is nearest to the middle of its group.
    ends = members.join(asked.select("node", "weight"), "node").groupBy("band", "bucket").agg(F.min("node").alias("low"), F.max(F.struct("weight", "node"))["node"].alias("central"))
    ends = members.join(ends, ["band", "bucket"]).select("node", F.explode(F.array("low", "central")).alias("end")).filter("node <> end")
    links = linked(ends.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")), "links-ends")
    if radius is not None:
        links = links.union(fingerprint_links(signed, radius))
    # What lies in different components still, though in one bucket, is joined by the shingles of its prefix.
    roots = connected(links, scratch, "cc-ends")
    named = members.join(roots, "node", "left").select("band", "bucket", "node", F.coalesce("root", "node").alias("root"))
    mixed = named.groupBy("band", "bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    open_ = scratch.save(named.join(mixed, ["band", "bucket"]).select("node", "root").distinct(), "open")
    first = scratch.save(prefixes(sets.join(open_, "node", "left_semi"), threshold, scratch).join(open_, "node"), "prefixes")
    counts = first.groupBy("h", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("h").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots")).filter("roots > 1").drop("roots")
    met = scratch.save(first.join(main, "h"), "met")
    x, y = met.filter("root <> main").alias("x"), met.alias("y")
    apart = (F.col("x.h") == F.col("y.h")) & (F.col("x.root") != F.col("y.root")) & ((F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    # All sets are in one order, so from the first shingle that two sets share, they share at most what stands onward. That
    # one is in both prefixes; a later one would bring the same pair again.
    most = F.least("x.onward", "y.onward")
    enough = most >= threshold / (1 + threshold) * (F.col("x.size") + F.col("y.size")) - SLACK
    rest = x.join(y, apart & enough).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    rest = linked(rest, "links-rest")
    if not rest.isEmpty():
        # A node and its root are linked already, so these stand for all links before.
        roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest), scratch, "cc")
    tops = roots.join(nodes.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("top"))
    named = nodes.select("node", "first").join(roots.join(tops, "root").select("node", "top"), "node", "left").select("node", F.coalesce("top", "first").alias("component_id"))
    kept = F.coalesce(F.col("k") == F.col("component_id"), F.col("component_id").isNull())
    return signed.select("k", "node").join(named, "node").select(F.col("k").alias(key), "component_id", kept.alias("kept"))


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, ngram: int = 5, radius: int | None = None) -> DataFrame:
    """``documents`` with one document of each component: that with the smallest doc_id (see ``keep_first``)."""
    return keep_first(docs, shingle_components(docs, threshold, ngram, radius=radius))
