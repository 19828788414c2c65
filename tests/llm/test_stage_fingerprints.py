"""The pipeline's near-copy stage links texts by operator 4's fingerprints as well as by similar shingles."""

import random

from corpus_pipeline import simhash
from sievelog.llm.shingle_dedup import shingle_components, shingle_set, similarity
from sievelog.llm.simhash import fingerprint


def pairs_beyond_shingles(draw, n):
    """Pairs of texts within two bits whose shingle sets are less alike than 0.8: a passage often repeated, with ends of their own."""
    out = []
    while len(out) < n:
        passage = " ".join(f"p{draw.randrange(10**6)}" for _ in range(12))
        a, b = (" ".join([passage] * 12 + [f"e{draw.randrange(10**6)}" for _ in range(5)]) for _ in range(2))
        if (fingerprint(a) ^ fingerprint(b)).bit_count() <= 2 and similarity(shingle_set(a), shingle_set(b)) < 0.8:
            out.append((a, b))
    return out


def test_fingerprints_within_two_bits_link(spark):
    draw = random.Random(6)
    rows = [(2 * i + j, t) for i, pair in enumerate(pairs_beyond_shingles(draw, 6)) for j, t in enumerate(pair)]
    rows += [(100, "a text of its own"), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash(spark, docs, "").collect()) == [0, 2, 4, 6, 8, 10, 100, 101]


def test_both_links_make_one_component(spark):
    """Against all pairs: a and b by fingerprint, b and c by shingles."""
    draw = random.Random(7)
    rows = []
    for i, (a, b) in enumerate(pairs_beyond_shingles(draw, 4)):
        rows += [(3 * i, a), (3 * i + 1, b), (3 * i + 2, b + " tail")]
    top = {k: k for k, _ in rows}
    for k, s in rows:
        for m, t in rows:
            if m < k and ((fingerprint(s) ^ fingerprint(t)).bit_count() <= 2 or similarity(shingle_set(s), shingle_set(t)) >= 0.8):
                x, y = top[k], top[m]
                top = {n: min(x, y) if v in (x, y) else v for n, v in top.items()}
    got = {r.doc_id: r.component_id for r in shingle_components(spark.createDataFrame(rows, "doc_id long, text string"), radius=2).collect()}
    assert got == top
