"""Held-out accuracy on planted insults, misspelt ones too, and the edge cases."""

import random

from sievelog.llm.toxicity import Model, Scorer, reject_toxic


def corpus(n, seed, bad):
    draw = random.Random(seed)
    plain = ["".join(draw.choice("abcdefgh") + draw.choice("aeiou") for _ in range(draw.randrange(1, 5))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randrange(5, 120))]
        if i % 4 == 0:
            for _ in range(1 + len(words) // 40):
                words.insert(draw.randrange(len(words) + 1), draw.choice(bad))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_unseen_misspellings():
    model = Model().fit(*corpus(600, 1, ["wretchkin", "scumblor", "Vilethorn!"]))
    score = Scorer(*model.scalars()).score
    texts, labels = corpus(600, 1, ["wretchkins", "scumblorr", "vilethornn"])
    right = sum((s >= 0.3) == bool(y) for s, y in zip(score(texts), labels, strict=True))
    assert right / len(texts) > 0.9
    assert all(0 <= s <= 1 for s in score([None, "", " ", "x" * 100_000]))


def test_without_labels_everything_stays(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (None, None, "y")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert reject_toxic(docs, labels).count() == 2 and reject_toxic(docs.limit(0), labels).columns == docs.columns
