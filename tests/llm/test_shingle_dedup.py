"""Components against all pairs of shingle sets."""

import random

import numpy as np
import pytest

from corpus_pipeline import simhash
from sievelog.llm.shingle_dedup import Minima, drop_near_copies, shingle_components, shingle_set, similarity


def varied(draw, words, changes):
    out = list(words)
    for at in draw.sample(range(len(out)), changes):
        out[at] = f"v{draw.randrange(10**9)}"
    return out


def brute(rows, threshold):
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= threshold:
                a, b = top[i], top[j]
                top = [min(a, b) if x in (a, b) else x for x in top]
    return {k: min(rows[j][0] for j in range(len(rows)) if top[j] == top[i]) for i, (k, _) in enumerate(rows)}


@pytest.mark.parametrize("group", [3, 90])
def test_components_against_all_pairs(spark, group):
    draw = random.Random(group)
    rows = []
    for g in range(180 // group):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([30, 100, 240]))]
        rows += [(len(rows) + i, " ".join(varied(draw, base, draw.randrange(1 + len(base) // 25)))) for i in range(group)]
    rows += [(1000, ""), (1001, None), (1002, " \n"), (1003, "one two"), (1004, "One  two")]
    want = brute(rows, 0.8)
    got = {r.doc_id: (r.component_id, r.kept) for r in shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: (top, k == top) for k, top in want.items()}


@pytest.mark.parametrize("own", [3, 8, 14])
def test_texts_that_share_a_passage(spark, own):
    """A passage in every text, with ``own`` words of each text's own behind it or taken from a few endings: near 0.8, on both sides."""
    draw = random.Random(own)
    passage = [f"p{i}" for i in range(60)]
    endings = [[f"e{g}_{i}" for i in range(own)] for g in range(6)]
    rows = []
    for i in range(120):
        end = varied(draw, draw.choice(endings), draw.randrange(2)) if i % 2 else [f"o{i}_{j}" for j in range(own + draw.randrange(6))]
        rows.append((i, " ".join(passage + end)))
    got = {r.doc_id: r.component_id for r in shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 0.8)


def test_stage_takes_one_changed_word(spark):
    draw, rows = random.Random(2), []
    for i in range(40):
        base = [f"w{draw.randrange(10**6)}" for _ in range(100)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(varied(draw, base, 1)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash(spark, docs, "").collect()) == list(range(0, 80, 2))


def test_bands_meet_at_the_threshold():
    draw, minima = random.Random(3), Minima(40, 4)
    for n in (10, 100, 1000):
        for _ in range(150):
            both = [draw.getrandbits(64) for _ in range(8 * n // 10)]
            a, b = (sorted(both + [draw.getrandbits(64) for _ in range(n // 10)]) for _ in range(2))
            keys = [minima.keys(np.array(x, "<u8")) for x in (a, b)]
            assert any(x == y for x, y in zip(*keys, strict=True))


def test_repeated_and_null_keys(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (7, "q"), (7, "q")]
    kept = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(3, "a b c d e f"), (7, "q")]
    assert drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
