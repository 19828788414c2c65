"""Repeated byte strings against a brute-force version."""

import hashlib
import random

import numpy as np
import pytest

from sievelog.llm.suffix_dedup import COVER, PERIOD, classes, remove_repeats


def brute(rows, length):
    """Per row (n_bytes, n_removed, n_spans, sha256), rows in order of id with None last."""
    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        data = (rows[i][1] or "").encode()
        bad = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                bad[p : p + length] = True
            seen.add(w)
        keep = bytes(b for b, x in zip(data, bad) if not x)
        spans = int((np.diff(np.append(0, bad.astype(int))) == 1).sum())
        out[i] = (rows[i][0], len(data), len(data) - len(keep), spans, hashlib.sha256(keep).hexdigest())
    return sorted(out.values(), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cover_reaches_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcdefgh"])
def test_classes(alphabet):
    draw = random.Random(len(alphabet))
    data = bytes(draw.choice(alphabet) for _ in range(400)) * 2 + bytes(200)
    data = np.frombuffer(data, np.uint8)
    at = np.arange(0, 700, 3)
    number = classes(data, at, 100)
    window = [data[p : p + 100].tobytes() for p in at]
    assert all((number[i] == number[j]) == (window[i] == window[j]) for i in range(len(at)) for j in range(0, len(at), 7))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    draw = random.Random(seed)
    passages = ["".join(draw.choice("abcdé ñ") for _ in range(draw.choice([40, 90, 120, 300]))) for _ in range(12)]
    rows = [(i * 3 - 20, "".join(draw.choice([*passages, "".join(draw.choice("xyz€ ") for _ in range(60))]) for _ in range(draw.randrange(6)))) for i in range(60)]
    rows += [(None, passages[3] * 2), (1000, None), (1001, ""), (1002, "a" * 20000), (1003, "ab" * 3000 + "a" * 500), (5000, passages[2] * 3), (5000, passages[2] * 3)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, chunk string").coalesce(1)
    out = remove_repeats(df, with_text=False, chunk_bytes=3000)
    assert got(out) == brute(rows, 100)


def test_real_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert got(remove_repeats(df, with_text=False, chunk_bytes=50_000)) == brute(rows, 100)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df).count() == 0
