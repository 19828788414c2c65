"""The leak scan makes its cells once and meets addresses only if there are any."""

from sievelog.operators import registry, verify
from sievelog.plans import queries as Q


def test_no_addresses_no_join(spark):
    reg = spark.createDataFrame([("email", "ann@corp.com", "Ann@corp.com", "user-0001@example.net", 1)], registry.SCHEMA)
    cells = spark.createDataFrame([("1", "a", "to ANN@corp.com, 10.1.1.1"), ("2", "a", "none")], "row_key string, name string, value string")
    found = verify.leaks(cells, reg, spark.createDataFrame([], "term string"))
    assert {tuple(r) for r in found.collect()} == {("1", "a", "ann@corp.com")}
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_sanitized_once(spark, tmp_path, monkeypatch):
    texts = [(i, f"mail bob{i % 3}@corp.com from 10.0.0.{i}") for i in range(1, 31)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, real = [], Q.verify.leaks
    monkeypatch.setattr(Q.verify, "leaks", lambda cells, *rest: seen.append(cells) or real(cells, *rest))
    got = {tuple(r) for r in Q.QUERIES["v1_registry_leaks"](spark, str(tmp_path)).collect()}
    assert got == {(str(k), f"bob{k % 3}@corp.com") for k in (10, 20, 30)}
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
