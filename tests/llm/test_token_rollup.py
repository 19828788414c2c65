"""Totals after inserts, revisions, deletes and repeated batches, against a plain dictionary."""

import base64
import random
import re

from sievelog.llm.common import Scratch
from sievelog.llm.queries import QUERIES, tokenizer_file
from sievelog.llm.token_rollup import CHANGE, TokenRollup


def test_against_dictionary(spark):
    draw = random.Random(4)
    rollup, state = TokenRollup(spark, Scratch(spark, "test").base), {}
    assert rollup.totals().count() == 0
    for b in range(4):
        changes = []
        for i in draw.sample(range(30), 15):
            gone = draw.random() < 0.3
            changes.append(("delete" if gone else "upsert", i if i else None, draw.choice(["v1", None]), *((None, None, None) if gone else (draw.choice(["a", None]), "en", draw.choice([None, 5, 9])))))
        df = spark.createDataFrame(changes if b != 2 else [], CHANGE)
        assert rollup.apply(f"b{b}", df) and not rollup.apply(f"b{b}", df)
        if b in (0, 2):
            rollup.compact()
            rollup.compact()
            assert not rollup.apply(f"b{b}", df) and len(rollup._base()[1]) == b + 1
        for op, i, v, s, lang, n in changes if b != 2 else []:
            state.pop((i, v), None) if op == "delete" else state.__setitem__((i, v), (s, lang, n or 0))
    want = {}
    for (_, v), (s, lang, n) in state.items():
        a, c = want.get((s, lang, v), (0, 0))
        want[s, lang, v] = (a + 1, c + n)
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == want
    kept = {(r.doc_id, r.version): (r.source, r.lang, r.n_tokens) for r in rollup.state().collect()}
    assert kept == state
    rollup.compact()
    assert {(r.doc_id, r.version): (r.source, r.lang, r.n_tokens) for r in rollup.state().collect()} == state
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == want


def test_a_small_batch_reads_its_buckets(spark):
    rollup = TokenRollup(spark, Scratch(spark, "test").base, buckets=16)
    rollup.apply("all", spark.range(2000).selectExpr("'upsert' AS op", "id AS doc_id", "'v' AS version", "'s' AS source", "'en' AS lang", "1L AS n_tokens"))
    rollup.compact()
    one = rollup._state([3])
    assert 0 < one.count() < 400 and re.search(r"PartitionFilters: \[[^\]]*bucket", one._jdf.queryExecution().executedPlan().toString())
    rollup.apply("one", spark.createDataFrame([("upsert", 7, "v", "t", "en", 5)], CHANGE))
    assert {(r.source, r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {("s", 1999, 1999), ("t", 1, 5)}


def by_hand(rows):
    """The query's three batches over plain rows: all counts, copies but the smallest id away, blanks squeezed."""
    import public_tokenizers
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_file("byte_bpe_50k.tiktoken"), "rb"))}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    state = {k: (s, lang, len(encode(t or ""))) for k, t, s, lang in rows}
    for k, t, _, _ in rows:
        if any(o is not None and k is not None and o < k and (u or "") == (t or "") for o, u, _, _ in rows):
            state.pop(k, None)
    for k, t, s, lang in rows:
        new = re.sub("[ \t]+", " ", t) if t else t
        if new != t and k in state and k is not None:
            state[k] = (s, lang, len(encode(new)))
    out = {}
    for s, lang, n in state.values():
        a, c = out.get((s, lang), (0, 0))
        out[s, lang] = (a + 1, c + n)
    return {(s, lang, "byte_bpe_50k", *v) for (s, lang), v in out.items()}


def test_the_query(spark, tmp_path):
    rows = [(1, "one  two", "a", "en"), (2, "copy text", "a", None), (3, "copy text", None, "en"), (4, None, "a", "en"), (5, "", "b", "en"), (6, "tab\t\tbed  and more", "b", "de"), (7, "copy text", "b", "de"), (None, "no key", "c", "en"), (8, "x " * 3000, "c", "en")]
    schema = "doc_id long, text string, source string, lang string"
    for name, data in (("full", rows), ("none", [])):
        spark.createDataFrame(data, schema).selectExpr("*", "1 AS op", "2 AS version", "3 AS bucket").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = {(r.source, r.lang, r.version, r.n_docs, r.n_tokens) for r in QUERIES["op2_token_rollup"](spark, f"{tmp_path}/{name}").collect()}
        assert got == by_hand(data)
