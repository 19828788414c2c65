"""Components against all pairs of fingerprints."""

import itertools
import random

import pytest
import xxhash

from sievelog.llm.common import Scratch
from sievelog.llm.simhash import BITS, covering_masks, fingerprint, keep_one, near_links, simhash_components


def test_fingerprint_by_hand():
    text = "A b\tC d É"
    words = ["a", "b", "c", "d", "É"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 3)
    assert fingerprint(text) % (1 << 64) == want
    assert fingerprint("a b") % (1 << 64) == xxhash.xxh64_intdigest(b"a b", 42) and fingerprint(None) == fingerprint(" \n") == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    draw = random.Random(radius)
    for _ in range(3000):
        flipped = sum(1 << b for b in draw.sample(range(BITS), radius))
        assert any(m % (1 << 64) & flipped == 0 for m in masks)


@pytest.mark.parametrize("bucket", [2, 64])
@pytest.mark.parametrize("radius", [2, 3])
def test_links_against_all_pairs(spark, bucket, radius):
    draw = random.Random(bucket)
    base = [draw.getrandbits(64) for _ in range(12)]
    prints = {b for x in base for b in [x, *(x ^ sum(1 << i for i in draw.sample(range(64), draw.randrange(1, 5))) for _ in range(15))]} | {0, 1, (1 << 64) - 1}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {tuple(r) for r in near_links(df, Scratch(spark, "test"), radius, bucket).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % (1 << 64)).bit_count() <= radius}


def test_table(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long), (3, long), (9, long + " tail"), (7, ""), (8, None), (None, long), (10, "one two"), (3, long)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fp string")
    got = {(r.doc_id, r.component_id, r.kept) for r in simhash_components(df).collect()}
    assert {(5, 3, False), (3, 3, True), (7, 7, True), (8, 7, False), (10, 10, True), (None, 3, True)} <= got
    kept = keep_one(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None)[:1] == [3] and 5 not in [r.doc_id for r in kept]
    assert simhash_components(df.limit(0)).count() == 0
