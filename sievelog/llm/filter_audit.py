"""What each filter of a cascade removes, for every order of the filters.

Spark reduces the documents to counts by part and by the set of filters that they fail. A part's counts are a tensor with
one axis of length two a filter (passes, fails). Every figure of every order and step is a contraction of that tensor with
one selector an axis: (1, 0) takes what passes, (0, 1) what fails, (1, 1) all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, met

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def selectors(n: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[str, np.ndarray]]:
    """All (order, place of the step), and for each kind of figure the selectors, shaped (order and step, axis, 2)."""
    steps = [(order, k) for order in permutations(range(n)) for k in range(n)]

    def chosen(earlier, this, later) -> np.ndarray:
        out = np.empty((len(steps), n, 2), np.int64)
        for row, (order, k) in enumerate(steps):
            for place, axis in enumerate(order):
                out[row, axis] = earlier if place < k else this if place == k else later
        return out

    return steps, {"kept": chosen(PASS, PASS, ALL), "removed": chosen(PASS, FAIL, ALL), "failing": chosen(ALL, FAIL, ALL), "unique": chosen(PASS, FAIL, PASS)}


def contract(tensors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Tensors (part, measure, 2, ..., 2) under every row of selectors: (part, measure, row)."""
    axes = ascii_lowercase[: chosen.shape[1]]
    spec = "yz" + axes + "," + ",".join("x" + a for a in axes) + "->yzx"
    return np.einsum(spec, tensors, *[chosen[:, i] for i in range(chosen.shape[1])])


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, figures): ``counts`` has, for each part and set of failed filters (``bits``, the first
    filter's bit highest), the numbers n, good and toxic. The figures of a part come from its own counts alone."""
    n = len(letters)
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))  # at most 2^n
    schema = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, chosen = selectors(n)
        orders = ["".join(letters[i] for i in order) for order, _ in steps]
        numbers = [k + 1 for _, k in steps]
        filters = np.array([order[k] for order, k in steps])
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo : lo + 256]
                flat = np.zeros((len(part), 3, 2**n), np.int64)
                for i, found in enumerate(part["cells"]):
                    for cell in found:
                        flat[i, :, cell["bits"]] += (cell["n"], cell["good"], cell["toxic"])
                tensors = flat.reshape(len(part), 3, *(2,) * n)
                removed = contract(tensors, chosen["removed"])
                docs = tensors[:, :1]
                shapley = np.stack([removed[:, 0, filters == f].sum(1) for f in range(n)], 1)[:, filters]
                figures = {
                    "kept": contract(docs, chosen["kept"])[:, 0], "removed": removed[:, 0], "redundant": contract(docs, chosen["failing"])[:, 0] - removed[:, 0],
                    "unique_fails": contract(docs, chosen["unique"])[:, 0], "good_lost": removed[:, 1], "toxic_lost": removed[:, 2], "shapley": shapley,
                }
                yield pd.DataFrame({"part": np.repeat(part["part"].to_numpy(), len(steps)), "filter_order": orders * len(part), "step": numbers * len(part), **{k: v.reshape(-1) for k, v in figures.items()}})

    return cells.mapInPandas(run, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: few words, repeated words, capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * n, "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text), "D": text.rlike(r"[#$%&*|]")}


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order of the filters ABCDE and step: documents kept after the step, removed by it, redundant (failing
    its filter, removed earlier), unique_fails (failing its filter only), good_lost and toxic_lost (removed by it, with
    quality or toxic 1 among the labels), shapley (removed by its filter over all orders at any step).

    A: under 200 words. B: under half of the words differ. C: over 3% capitals A-Z. D: one of #$%&*|. E: the same text has a
    smaller key, removed or not. A null text is empty; a null part counts with the empty one. Rows that repeat a key count
    each and are no copies of each other; a null key is no smaller key, has none, and has no labels. Of a key's repeated
    labels one with 1 is enough. An empty table gives no rows. Further columns are ignored.

    Texts are read once, for their failures and digest. Copies meet through digests with frequent ones broadcast; each that
    has a smaller key moves its count from passing to failing E. Counts are combined by key before they meet the labels.
    """
    scratch = Scratch(docs.sparkSession, "filter_audit")
    source = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    failed = text_failures(F.col("body"))
    bits = sum((F.when(c, 2 ** (4 - i)).otherwise(0) for i, c in enumerate(failed.values())), F.lit(0))
    rows = scratch.save(source.select("doc", "part", bits.cast("int").alias("bits"), F.sha2("body", 256).alias("h")), "rows")
    first = scratch.save(rows.groupBy("h").agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    copies = met(rows, first, "h", rows.count()).filter("doc > first")
    moved = copies.select("doc", "part", F.explode(F.array(F.struct("bits", F.lit(-1).alias("n")), F.struct((F.col("bits") + 1).alias("bits"), F.lit(1).alias("n")))).alias("x")).select("doc", "part", "x.*")
    counts = rows.select("doc", "part", "bits", F.lit(1).alias("n")).unionByName(moved).groupBy("doc", "part", "bits").agg(F.sum("n").alias("n")).filter("n <> 0")
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.groupBy(F.col("doc_id").alias("doc")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marked = counts.join(marks, "doc", "left").groupBy("part", "bits").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return interactions(marked, "ABCDE")
