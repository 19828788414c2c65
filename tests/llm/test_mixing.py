"""Exact quotas and disjoint blocks of the mix, against a plain count."""

import math
import re
from collections import Counter, defaultdict

import pytest

from sievelog.llm.mixing import hypergeometric, mix, mixed_documents, swap_or_not, taken_words


def wanted(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, [s for s in names], share * sum(sizes.values())
    while True:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > limit * sizes[s]] if free else []
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = limit * sizes[s]
            free.remove(s)
        left = share * sum(sizes.values()) - sum(out.values())


def test_swap_or_not_is_a_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 300):
        df = spark.range(n).select(swap_or_not(F.col("id"), F.lit(n).cast("long"), 3, F.lit("x")).alias("y"))
        assert sorted(r.y for r in df.collect()) == list(range(n))


def test_hypergeometric_law(spark):
    from pyspark.sql import functions as F

    big = lambda x: F.lit(x).cast("long")
    df = spark.range(4000).select(hypergeometric(big(30), big(12), big(9), (F.col("id") + 0.5) / 4000).alias("k"))
    seen = Counter(r.k for r in df.collect())
    for k in range(10):
        p = math.comb(12, k) * math.comb(18, 9 - k) / math.comb(30, 9)
        assert abs(seen[k] / 4000 - p) < 0.001
    edges = spark.range(1).select(*[hypergeometric(big(t), big(g), big(d), F.lit(0.7)).alias(f"{t}_{g}_{d}") for t, g, d in ((0, 0, 0), (5, 5, 3), (5, 0, 3), (5, 2, 5), (5, 2, 0))]).first()
    assert tuple(edges) == (0, 3, 0, 2, 0)


@pytest.mark.parametrize("block", [3, 64, 2048])
def test_taken_meets_targets(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    extra = [(9001, None, "src1"), (None, "a b c", None), (9002, "", None), (9003, "d " * 500, None), (9004, "e f", "src2"), (9004, "e f", "src2")]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = taken_words(docs, block_words=block).collect()
    given = [tuple(r) for r in docs.collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r.doc_id if r.doc_id is not None else -1, r.size, r.source or "") for r in rows)) == sorted((d if d is not None else -1, size(t), s or "") for d, t, s in given)
    totals, taken = Counter(), Counter()
    for _, t, s in given:
        totals[s] += size(t)
    goal = wanted(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, r.target) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in totals)
    assert sorted(map(str, rows)) == sorted(map(str, taken_words(docs, block_words=block).collect()))


def test_pieces_are_disjoint_and_spread(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    documents, pieces = mix(docs, shards=7, block_words=50)
    at = defaultdict(list)
    shards = Counter()
    for p in pieces.collect():
        at[p.doc, p["pass"]].append((p.first, p.first + p.words))
        shards[p.shard] += p.words
    for spans in at.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(shards) == 7 and max(shards.values()) < 1.2 * min(shards.values())


def test_mixed_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixed_documents(docs, block_words=50)
    assert out.columns == docs.columns
    sizes, texts = Counter(), dict(docs.select("doc_id", "text").collect())
    for r in out.collect():
        sizes[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text) and r.text.split("\n")[0] in texts[r.doc_id]
    goal = {r.source: r.target for r in taken_words(docs).collect()}
    assert all(abs(sizes[s] - goal[s]) <= 1 for s in goal)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert taken_words(empty).count() == 0 and mixed_documents(empty).count() == 0
