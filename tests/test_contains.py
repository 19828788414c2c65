"""The containment join and the sweep against plain search."""

import random

from sievelog.operators import contains, registry, sweep, verify


def found(texts, words, least=4):
    low = {k: contains.lowered(t) for k, t in texts if t}
    entries = {contains.lowered(w) for w in words if w and len(w) >= least}
    return {(k, i + 1, w) for k, t in low.items() for w in entries for i in range(len(t)) if t.startswith(w, i)}


def joined(spark, texts, words):
    docs = spark.createDataFrame(texts, "record_id long, text string")
    return [tuple(r) for r in contains.contains_join(docs, "text", spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()]


def test_random_texts(spark):
    rng = random.Random(4)
    texts = [(i, "".join(rng.choices("abcA ", k=rng.randint(0, 60)))) for i in range(300)] + [(300, None), (301, ""), (302, "ΣΊΣΥΦΟΣ and İstanbul, ISTANBUL"), (303, "x" * 3)]
    words = ["".join(rng.choices("abc", k=rng.randint(2, 9))) for _ in range(150)] + ["σίσυφοσ", "İSTANBUL", "istanbul", "aaaa", "AAAA", None, "", "abc"]
    got = joined(spark, texts, words)
    assert len(got) == len(set(got)) and set(got) == found(texts, words)


def test_long_texts_and_entries(spark, monkeypatch):
    """Texts beyond a block, entries beyond a block, places at its edge."""
    long = "".join(random.Random(5).choices("abcdefgh", k=2_300_000))
    edge = [long[b - n : b + 9] for b in (1 << 20, 1 << 21) for n in (0, 1, 2, 3, 4, 8)]
    words = [*edge, long[5:600], long[1_000_000:1_100_000], long[-7:], long[:6]]
    got = joined(spark, [(1, long), (2, "no"), (3, long[-300_000:] + "Z")], words)
    want = {(k, t.find(w, at) + 1, w) for k, t in ((1, long), (3, long[-300_000:] + "Z")) for w in words for at in [0] if w in t}
    assert want <= set(got) and {g[2] for g in got} == set(words)


def test_many_passes(spark, monkeypatch):
    monkeypatch.setattr(contains, "ANCHORS", 3)
    texts = [(i, f"entry{i:03d} and entry{i + 1:03d}") for i in range(40)]
    words = [f"entry{i:03d}" for i in range(0, 50, 2)]
    assert set(joined(spark, texts, words)) == found(texts, words)


def test_nothing(spark):
    assert joined(spark, [(1, "some text")], []) == [] and joined(spark, [(None, None)], ["word"]) == []
    assert joined(spark, [(None, "a word")], ["word"]) == [(None, 3, "word")]


def test_sweep_takes_the_longest_from_the_left(spark):
    reg = spark.createDataFrame([("hostname", "lamp", "Lamp", "HOST-0001", 1), ("hostname", "lamplight", "lamplight", "HOST-0002", 2), ("username", "lamp", "lamp", "USER-0001", 1), ("org", "dog", "dog", "ORG-0001", 1), ("hostname", "host-0007", "host-0007", "HOST-0003", 3)], registry.SCHEMA)
    docs = spark.createDataFrame([(1, "One LAMP, lamplight, a dog, HOST-0007"), (2, "the dog"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_replaced) for r in sweep.swept(docs, reg, "text", "doc_id").collect()}
    assert got == {1: ("One HOST-0001, HOST-0002, a dog, HOST-0007", 2), 2: ("the dog", 0), 3: (None, 0)}


def test_spans_of_one_text():
    """Earlier priorities first, then from the left; a hundred thousand spans in one text."""
    assert sweep.replace_spans("abcdefghij", [(3, 4, 2, "X"), (2, 2, 2, "Y"), (6, 3, 1, "P"), (9, 1, 3, "Q"), (2, 3, 2, "Z")]) == ("aZePQj", 3)
    n = 100_000
    text, count = sweep.replace_spans("ab" * n, [(2 * i + 1, 1, i % 3, "-") for i in range(n)] + [(2 * i + 2, 2, 5, "+") for i in range(n - 1)])
    assert count == n and text == "-b" * n


def test_leaks(spark):
    reg = spark.createDataFrame([("ipv4_priv", "10.1.1.1", "10.1.1.1", "10.9.9.9", 1), ("hostname", "server01", "Server01", "HOST-0001", 1), ("email", "http", "http", "user-0001@example.net", 1), ("hostname", "host-0005", "HOST-0005", "HOST-0002", 2)], registry.SCHEMA)
    cells = spark.createDataFrame([("1", "a", "from 10.1.1.12 to x"), ("2", "a", "from 10.1.1.1, 10.1.1.1"), ("3", "b", "MYSERVER01X http"), ("4", "b", "HOST-0005")], "row_key string, name string, value string")
    allowed = spark.createDataFrame([], "term string")
    assert {tuple(r) for r in verify.leaks(cells, reg, allowed).collect()} == {("2", "a", "10.1.1.1"), ("3", "b", "server01")}
    assert verify.leaks(cells, reg, spark.createDataFrame([("Server01",)], "term string")).count() == 1
