"""The sweep looks for every dictionary word of four letters or more."""

from sievelog.plans.queries import QUERIES


def test_short_words_are_swept(spark, tmp_path):
    spark.createDataFrame([(1, "One Lamp, lamplight and a dog"), (2, "the dog")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "lamp lamplight dog")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.n_replaced for r in QUERIES["z14_dictionary_sweep"](spark, str(tmp_path)).collect()}
    assert got == {1: 2, 2: 0}
