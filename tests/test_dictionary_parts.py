"""Entries that tasks hold and entries whose windows travel: together the whole dictionary, each text by itself."""

import random

from sievelog.operators import contains, registry, sweep


def test_both_parts_are_found(spark, monkeypatch):
    monkeypatch.setattr(contains, "NEAR", 40)
    rng = random.Random(8)
    texts = [(i, "".join(rng.choices("abcA ", k=rng.randint(0, 80)))) for i in range(200)] + [(200, "x" * 150 + "yz")]
    words = {"".join(rng.choices("abc", k=rng.randint(4, 9))) for _ in range(150)} | {"x" * 70 + "y"}
    docs, entries = spark.createDataFrame(texts, "record_id long, text string"), spark.createDataFrame([(w,) for w in words], "w string")
    near, others = contains.parted(contains.dictionary(docs, "text", entries, "w"))
    assert len(near.words) == 40 and {r.word for r in others.collect()} == words - set(near.words) and "x" * 70 + "y" not in near.words
    want = {(k, i + 1, w) for k, t in texts for w in words for i in range(len(t)) if t.lower().startswith(w, i)}
    got = [tuple(r) for r in contains.contains_join(docs, "text", entries, "w").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_held_entries_in_long_texts(spark):
    """Entries over the edges of a long text's pieces, and short texts beside it in one block."""
    long = "".join(random.Random(5).choices("abcdefgh", k=2_300_000))
    words = {long[b - n : b + 9] for b in (1 << 20, 1 << 21) for n in (0, 1, 4, 8, 30)} | {long[-7:], long[:6], long[100:164]}
    texts = [(1, "a" + long[:5]), (2, long), (3, long[-300:] + "Z")]
    docs = spark.createDataFrame(texts, "record_id long, text string").coalesce(1)
    want = {(k, i + 1, w) for k, t in texts for w in words for i in [t.find(w)] if i >= 0}
    got = {tuple(r) for r in contains.contains_join(docs, "text", spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()}
    assert want <= got and all(texts[k - 1][1].startswith(w, i - 1) for k, i, w in got)


def swept(spark, texts):
    reg = spark.createDataFrame([("hostname", w, w, f"HOST-{i:04d}", i) for i, w in enumerate(("lamp", "lamplight", "lighter", "ghtercup"))], registry.SCHEMA)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return sorted((r.doc_id, r.text, r.n_replaced) for r in sweep.swept(docs, reg, "text", "doc_id").collect())


def test_rows_of_one_key_are_swept_each_by_itself(spark, monkeypatch):
    """Rows of one key took each other's places before."""
    texts = [(1, "a lamp and more"), (1, "one lamplighter"), (2, "LAMP ghtercup"), (3, "")]
    want = [(1, "a HOST-0000 and more", 1), (1, "one HOST-0001er", 1), (2, "HOST-0000 HOST-0003", 2), (3, "", 0)]
    for near in (50_000, 3, 2, 1):
        monkeypatch.setattr(contains, "NEAR", near)
        assert swept(spark, texts) == want


def test_places_of_held_values_do_not_travel(spark):
    """A sweep by a small dictionary has no join; before, each place of a word was a row of three joins."""
    reg = spark.createDataFrame([("hostname", "lamp", "lamp", "HOST-0001", 1)], registry.SCHEMA)
    docs = spark.createDataFrame([(1, "lamp lamp")], "doc_id long, text string")
    plan = sweep.swept(docs, reg, "text", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
