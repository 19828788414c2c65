"""The pipeline's stages, one after the other, against brute force on small tables."""

import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from corpus_pipeline import STAGES, run  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, stretches string, taken string, __n string, __doc string"


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def tables(spark, folder, rows, labels):
    spark.createDataFrame([(*r, len(r[1] or ""), "a", None, "b", "c") for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def shingles(text, n=5):
    w = text.split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_stages(spark, tmp_path):
    draw = random.Random(3)
    insults = ["gluvnarb", "sniptorg"]
    rows, labels = [], []
    for i in range(120):
        bad = i % 4 == 0
        text = words(draw, 40) + (" " + " ".join(draw.choice(insults) for _ in range(8)) if bad else "")
        rows.append((i, text, "en", draw.choice(["s1", "s2", None])))
        labels.append((i, 1, int(bad)))
    passage = words(draw, 30)
    rows += [(200, words(draw, 12) + "\n" + passage, "en", "s1"), (201, words(draw, 12) + "\n" + passage + "\n" + words(draw, 9), "en", "s2")]
    near = words(draw, 60)
    rows += [(210, near, "en", "s1"), (211, near + " tail", "en", "s1"), (212, near, None, "s3"), (212, near, None, "s3")]
    rows += [(220, None, None, None), (221, "", "en", "s1"), (222, " \n ", "en", "s1"), (None, words(draw, 25), "en", "s2"), (223, words(draw, 20000), "en", "s2")]
    folder = tables(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    toxic = {i for i in range(0, 120, 4)}
    assert not toxic & {k for k, _ in kept["toxicity"]} and len(kept["toxicity"]) >= len(rows) - len(toxic) - 3
    texts = dict(kept["line_dedup"])
    assert passage in texts[200] and passage not in texts[201] and texts[201].split("\n")[0] == rows[121][1].split("\n")[0] and texts[220] is None
    left = kept["simhash"]
    assert {k for k, _ in left if k in (210, 211, 212)} == {210}
    sets = [shingles(t or "") for _, t in left]
    assert all(len(a & b) / len(a | b) < 0.8 for i, a in enumerate(sets) for b in sets[:i])
    sizes = {k: len((t or "").split()) for k, t in left}
    taken = {}
    for k, t in kept["mixing"]:
        assert set((t or "").split()) <= set((dict(left)[k] or "").split())
        taken[k] = taken.get(k, 0) + len(t.split())
    assert all(n <= 2 * sizes[k] for k, n in taken.items()) and taken
    both = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in STAGES[-1][1](spark, docs, folder).collect())
    want = []
    for k, t in kept["mixing"]:
        ids = both.encode(t, add_special_tokens=False).ids
        want.append((str(k), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert got == sorted(want)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in run(spark, folder).collect()) == got


def test_empty_tables(spark, tmp_path):
    assert run(spark, tables(spark, tmp_path, [], [])).count() == 0
