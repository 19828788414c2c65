"""How many different entries the texts of a key hold."""

import random

from sievelog.operators import contains


def test_entry_counts(spark, monkeypatch):
    """Repeated and null keys, entries in both parts of the dictionary."""
    rng = random.Random(9)
    texts = [(rng.choice([None, *range(60)]), "".join(rng.choices("abc ", k=rng.randint(0, 60)))) for _ in range(90)] + [(100, None), (101, "")]
    words = {"".join(rng.choices("abc", k=rng.randint(4, 6))) for _ in range(150)}
    want: dict = {}
    for key, text in texts:
        want.setdefault(key, set()).update(w for w in words if w in (text or ""))
    docs, entries = spark.createDataFrame(texts, "record_id long, text string"), spark.createDataFrame([(w,) for w in words], "w string")
    for near in (50_000, 20):
        monkeypatch.setattr(contains, "NEAR", near)
        got = [tuple(r) for r in contains.entry_counts(docs, "text", entries, "w").collect()]
        assert len(got) == len(dict(got)) and dict(got) == {k: len(v) for k, v in want.items() if v}
    assert contains.entry_counts(docs, "text", entries.filter("false"), "w").count() == 0
