"""The pipeline's near-copy stage runs no jobs for links that aren't there: each job takes some MB of the driver's memory."""

import random

import pytest
from corpus_pipeline import simhash
from sievelog.llm.common import Scratch, connected
from sievelog.llm.shingle_dedup import shingle_components
from sievelog.llm.simhash import near_links


@pytest.fixture
def saves(monkeypatch):
    names = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: names.append(name) or save(self, df, name))
    return names


def text(draw, n=40):
    return " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))


def test_no_links_no_rounds(spark, saves):
    draw = random.Random(3)
    docs = spark.createDataFrame([(i, text(draw)) for i in range(30)], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash(spark, docs, "").collect()) == list(range(30))
    assert not {"links-rest", "cc-ends-0", "cc-edges", "cc-0"} & set(saves)
    assert len(saves) <= 18


def test_links_by_first_texts_need_one_search(spark, saves):
    draw = random.Random(4)
    rows = [(2 * i + j, t + end) for i, t in enumerate(text(draw) for _ in range(8)) for j, end in enumerate(("", " end"))]
    got = {r.doc_id: r.component_id for r in shingle_components(spark.createDataFrame(rows, "doc_id long, text string"), radius=2).collect()}
    assert got == {k: k - k % 2 for k, _ in rows}
    assert "cc-ends-0" in saves and "cc-edges" not in saves


def test_no_edges_no_nodes(spark):
    assert connected(spark.createDataFrame([(1, 1)], "a long, b long"), Scratch(spark, "test")).collect() == []


@pytest.mark.parametrize("bucket", [1, 64])
def test_near_links_without_and_with_buckets(spark, bucket):
    far = [0, 0x0F0F0F0F0F0F0F0F, 0x3333333333333333]
    for prints, links in ((far, set()), ([*far, 3], {(0, 3)})):
        df = spark.createDataFrame([(p,) for p in prints], "fp long")
        assert {tuple(r) for r in near_links(df, Scratch(spark, "test"), 2, bucket).collect()} == links
