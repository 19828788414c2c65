"""Every figure of the audit against a run of the filters over single documents."""

from itertools import permutations

from sievelog.llm.filter_audit import audit_filters
from sievelog.llm.queries import QUERIES


def failed(rows):
    out = []
    for key, text, lang in rows:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        f = ("A" if len(words) < 200 else "") + ("B" if 100 * len(set(words)) < 50 * len(words) else "") + ("C" if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else "") + ("D" if set("#$%&*|") & set(t) else "")
        if key is not None and any(k is not None and k < key and (u or "") == t for k, u, _ in rows):
            f += "E"
        out.append((key, lang or "", f))
    return out


def by_hand(rows, labels):
    good, toxic = ({k for k, q, t in labels if (q, t)[i] == 1 and k is not None} for i in (0, 1))
    docs, out, shapley = failed(rows), {}, {}
    for part in {p for _, p, _ in docs}:
        mine = [(k, f) for k, p, f in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone, left, before = [d for d in left if x in d[1]], [d for d in left if x not in d[1]], left
                redundant = sum(x in f for _, f in mine) - sum(x in f for _, f in before)
                out[part, order, step] = [len(left), len(gone), redundant, sum(f == x for _, f in mine), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone)]
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def rows_for_test():
    many = " ".join(f"w{i}" for i in range(220))
    texts = [many, many, many + " W", "a " * 250, "A B " * 210, "some # thing", "", None, "x\x0by\x1cz", many.upper(), many + " 50%", "ü" * 40_000, many, "Same text", "Same text"]
    rows = [(i * 3 % 17, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[5], (None, "Same text", "en"), (None, None, None), (16, many, "fr")]


def test_against_single_documents(spark, tmp_path):
    rows = rows_for_test()
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(17)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1), (99, 1, 1), (4, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS bits", "'x' AS part", "2 AS h").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op12_filter_audit"](spark, str(tmp_path))
    assert tuple(got.columns) == COLUMNS
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) == 600 * 4
    assert set(found) == by_hand(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "One two", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(docs.filter("false"), labels).collect() == []
    assert {tuple(r) for r in audit_filters(docs, labels).collect()} == by_hand([(1, "One two", "en")], [])
