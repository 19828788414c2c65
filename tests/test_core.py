"""Numbering at size, tokens, values that look like patterns, and the review loop."""

from pyspark.sql import functions as F

from sievelog.functions import allowlists, detectors
from sievelog.operators import graph, records, registry, review, spans


def test_numbers_are_places(spark):
    rows = spark.range(400_000).select((F.col("id") * 7919 % 400_009).alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    for _ in range(2):
        bad = graph.numbered(rows, ["event_id"]).select("more", F.substring("edge_id", 3, 20).cast("long").alias("n"), "event_id")
        assert bad.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (400_000, 0, 399_999)
        low = bad.filter("n < 1000").orderBy("n").collect()
        assert [r.event_id for r in low] == sorted(r.event_id for r in low)


def test_values_are_not_patterns(spark):
    df = spark.createDataFrame([(1, r"from CORP\Edward and \Q.*"), (2, None), (3, "")], "record_id int, text string")
    raw = records.Sanitized.messages(df.selectExpr("record_id", "text", "'' AS s", "'' AS k", "CAST(NULL AS STRING) AS p"), "text", "s", "k", "p")
    reg = raw.grown(spark.createDataFrame([], registry.SCHEMA), b"s")
    got = {r.record_id: r.text for r in raw.published(reg, sweep=False).collect()}
    assert got == {1: r"from ORG-0001\USER-0001 and \Q.*", 2: None, 3: ""}
    assert spans.spans(df, "text").count() == 0


def addresses(spark, n, form):
    return spark.range(n).select(F.col("id").alias("record_id"), F.lit(0).alias("start"), F.lit("ipv4_priv").alias("category"), F.expr(form).alias("value"))


def test_every_address_of_a_block_gets_its_own_token(spark):
    """A whole block and parts of the others, in one pass: all tokens differ, stay in the block, and none is its own address."""
    for n, form, block in ((65_536, "concat('192.168.', id div 256, '.', id % 256)", r"^192\.168\.\d+\.\d+$"), (30_000, "concat('172.', 16 + id % 16, '.', id div 16 % 256, '.', id div 4096)", r"^172\.(1[6-9]|2\d|3[01])\.\d+\.\d+$"), (30_000, "concat('10.', id % 251, '.', id div 251, '.', id % 7)", r"^10\.\d+\.\d+\.\d+$")):
        reg = registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), addresses(spark, n, form), b"s")
        got = reg.agg(F.count_distinct("norm"), F.count_distinct("sanitized"), F.count_if(F.col("sanitized").rlike(block) & F.col("sanitized").rlike(detectors.IPV4)), F.count_if(F.col("sanitized") == F.col("norm"))).first()[:]
        assert got == (n, n, n, 0)


def test_networks_are_kept_on_demand(spark):
    found = addresses(spark, 4000, "concat('10.', id % 5, '.', id div 5 % 8, '.', id div 40)").union(addresses(spark, 512, "concat('172.', 16 + id % 16, '.3.', id div 16)")).union(addresses(spark, 300, "concat('192.168.', id % 3, '.', id div 3)"))
    reg = registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), found, b"s", networks=True).collect()
    for k in (1, 2, 3, 4):
        pairs = {(".".join(r.norm.split(".")[:k]), ".".join(r.sanitized.split(".")[:k])) for r in reg}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert len(reg) == 4812 and all(r.sanitized.startswith("192.168.") or r.sanitized.startswith("10.") or 16 <= int(r.sanitized.split(".")[1]) < 32 for r in reg)


def test_odd_private_values_and_known_tokens(spark):
    old = spark.createDataFrame([("ipv4_priv", "10.1.1.1", "10.1.1.1", "10.200.0.9", 1)], registry.SCHEMA)
    new = spark.createDataFrame([("ipv4_priv", "10.1.1.1", 1, 0), ("ipv4_priv", " 10.1.1.2 ", 2, 0), ("ipv4_priv", "10.999.1.1", 3, 0), ("ipv4_priv", None, 4, 0), ("ipv4_priv", " ", 5, 0)], "category string, value string, record_id int, start int")
    got = {r.norm: r.sanitized for r in registry.grow_registry(old, new, b"s").collect()}
    assert got["10.1.1.1"] == "10.200.0.9" and set(got) == {"10.1.1.1", "10.1.1.2", "10.999.1.1"} and all(got.values())


def test_predicates(spark):
    row = spark.range(1).select(
        detectors.is_own_token(F.lit("100.65.1.2")).alias("a"), detectors.is_own_token(F.lit("100.63.1.2")).alias("b"), allowlists.is_allowed(F.lit("CDN.GitHub.com")).alias("c"), allowlists.is_allowed(F.lit("t1server")).alias("d"), allowlists.is_allowed(F.lit("T1059.001")).alias("e"),
        F.to_json(review.json_array(F.lit('so: ```json\n[{"span":"x"}]\n```'))).alias("f"),
    ).first()
    assert row[:] == (True, False, True, False, True, '[{"span":"x"}]')
