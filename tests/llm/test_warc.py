"""Archives written and read back, with pushed predicates."""

import hashlib

from sievelog.llm.common import Scratch
from sievelog.llm.warc import archive_round_trip, page_records, register


def test_round_trip(spark):
    big = "<p>é</p>" * 40
    rows = [(3, "http://a\r\nb", big), (1, None, big), (9, "u", big), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", big), (7, "u", "WARC/1.1\r\n" * 30)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)
    got = {r.page_id: r for r in archive_round_trip(df).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == big and i != 1
        assert tuple(got[i]) == (i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None)
    assert archive_round_trip(df.limit(0)).count() == 0


def test_pushdown_and_splits(spark):
    register(spark)
    rows = [(i, f"u{i % 3}", f"page {i} " * 30) for i in range(40)]
    folder = Scratch(spark, "test").base
    page_records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").option("splitBytes", "1000").load(folder)
    assert read.count() == 40
    assert sorted(int(r.page_id) for r in read.filter("target_uri = 'u1' AND record_type IN ('response', 'revisit')").select("page_id").collect()) == [i for i in range(40) if i % 3 == 1]
