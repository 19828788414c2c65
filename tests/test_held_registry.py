"""Records meet the registry in their tasks; entries beyond what a task holds come by joins, with the same result."""

import json
import random

import pyarrow as pa
from pyspark.sql import functions as F

from sievelog.operators import contains, formats, held, records, registry
from sievelog.plans import queries

BODIES = [
    '{"userName":"Marvin.K","orgId":7,"peers":["10.2.2.2","db01.corp.lan"],"note":"marvin.k, MARVIN.K and 10.2.2.2 on db01.corp.lan"}',
    '{"message":"WinLogBeat ::: {\\"user\\": \\"zoe\\", \\"n\\": [1, 2.50]}","x":"MARVIN.K was here"}', '{"message":"WinLogBeat ::: {\\"text\\": \\"plain\\", \\"n\\": [1, 2.50]}","userName":"Érin ÅNGSTRÖM"}',
    '{ "a" : "nothing in this one" }', '{"note":"see érin ångström, \\"quoted\\" on host IP-0A020202","serverHostname":"IP-0A020202","tags":{"user":"marvin.k"}}', "not json", None, '{"orgId":7,"n":{"orgid":12},"list":[],"o":{},"e":"\\u00e9\\n"}',
]


def raw_and_registry(spark):
    raw = records.Sanitized.records(spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "id long, body string"), "body")
    return raw, raw.grown(spark.createDataFrame([], registry.SCHEMA), b"s")


def test_no_place_of_a_held_entry_travels(spark):
    """Before, each place was a row of a join by value and of one by record."""
    raw, reg = raw_and_registry(spark)
    for df in (raw.published(reg), raw.holders(reg)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan


def test_held_or_not_the_records_are_the_same(spark, monkeypatch):
    raw, reg = raw_and_registry(spark)
    want = {r.id: (r.body, r.n_replaced) for r in raw.published(reg).collect()}
    known = {(r.category, r.norm): r.sanitized for r in reg.collect()}
    user, other, ip, host = known["username", "marvin.k"], known["username", "érin ångström"], known["ipv4_priv", "10.2.2.2"], known["fqdn", "db01.corp.lan"]
    hexed = "IP-" + "".join(f"{int(b):02X}" for b in ip.split("."))
    assert want[0] == (f'{{"userName":"{user}","orgId":{known["org_id", "7"]},"peers":["{ip}","{host}"],"note":"{user}, {user} and {ip} on {host}"}}', 8)
    assert want[1] == ('{"message":' + json.dumps("WinLogBeat ::: " + json.dumps({"user": known["username", "zoe"], "n": [1, 2.5]}, separators=(",", ":"))) + f',"x":"{user} was here"}}', 2)
    assert want[2] == ('{"message":"WinLogBeat ::: {\\"text\\": \\"plain\\", \\"n\\": [1, 2.50]}","userName":"' + other + '"}', 1)  # the message is laid out as it was
    assert want[3] == (BODIES[3], 0) and want[5] == (BODIES[5], 0) and want[6] == (None, 0)
    assert want[4] == (f'{{"note":"see {other}, \\"quoted\\" on host IP-0A020202","serverHostname":"{hexed}","tags":{{"user":"marvin.k"}}}}', 2)
    assert want[7] == (f'{{"orgId":{known["org_id", "7"]},"n":{{"orgid":{known["org_id", "12"]}}},"list":[],"o":{{}},"e":"é\\n"}}', 2)
    some = reg.filter("category <> 'username'")
    for characters, longest in ((24_000_000, 1_000), (100, 1_000), (0, 1_000), (24_000_000, 8)):
        monkeypatch.setattr(held, "CHARACTERS", characters)
        monkeypatch.setattr(held, "LONGEST", longest)
        assert {r.id: (r.body, r.n_replaced) for r in raw.published(reg).collect()} == want
        earlier = raw.published(some)
        assert {r.id: (r.body, r.n_replaced) for r in raw.republished(earlier, some, reg).collect()} == want


def test_words_in_texts():
    """Words with one anchor and words over the edges of a long text's pieces, against all places."""
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh", k=2_200_000))
    words = sorted({"".join(rng.choices("abc", k=rng.randint(4, 9))) for _ in range(300)} | {f"user{i}" for i in range(200)} | {long[b - n : b + 9] for b in (1 << 20, 1 << 21) for n in (0, 1, 4, 8, 30)} | {"é" * 4, "ée" * 5})
    rows = [(w, int(contains.gram_hashes(w)[at].astype("int64")), at) for w in words for at in [rng.randrange(len(w) - 3)]]
    held_words = held.Words(pa.table([pa.array(c) for c in zip(*rows, strict=True)], ["word", "gram", "off"]).append_column("token", pa.array(words)))
    texts = ["".join(rng.choices("abc ", k=rng.randint(0, 90))) for _ in range(80)] + ["", "user1user12, user199x", "é" * 7, long[:4]]
    want = {(n, i, w) for n, t in enumerate(texts) for w in words for i in range(len(t)) if t.startswith(w, i)}
    got = [(n, at, held_words.tokens[w].as_py()) for a, b, c in held_words.places(texts) for n, at, w in zip(a.tolist(), b.tolist(), c.tolist(), strict=True)]
    assert len(got) == len(set(got)) and set(got) == want
    want = {(i, w) for w in words for i in [long.find(w)] if i >= 0}
    got = [(at, held_words.tokens[w].as_py()) for _, b, c in held_words.places(["x", long]) for at, w in zip(b.tolist(), c.tolist(), strict=True)]
    assert len(got) == len(set(got)) and want <= set(got) and all(long.startswith(w, at) for at, w in got)


def test_format_of_a_text_is_that_of_the_column(spark):
    texts = ["", "x", "WinLogBeat ::: {}", " a-WinLogBeat ::: x", "b WinLogBeat :::", "\x85WinLogBeat :::", "<Event>", "z" * 195 + "<Event>", "%ASA-4", "CloudTrail", "é" * 199 + "%ASA-"]
    names = [("", "", ""), ("CISCO_asa", "", ""), ("Windows_Security_Audit", "", ""), ("x", "", "in_CloudTrail_1"), ("dnsmasq", "", ""), ("", "DNS_event", ""), ("vmware", "", ""), ("Meraki", "", ""), ("", "traffic_drop", ""), ("palo_alto", "", ""), ("aws_cloud_trail", "", "")]
    rows = [(t, *n) for t in texts for n in names]
    df = spark.createDataFrame(rows, "m string, s string, t string, p string")
    got = df.select("m", "s", "t", "p", formats.message_format(*(F.col(c) for c in "mstp")).alias("form")).collect()
    assert len(got) == len(rows) and all(r.form == formats.text_format(*r[:4]) for r in got)


def test_first_spelling_in_order_of_record():
    rows = [("username", "Bob", "r2", 0, 1), ("username", "Bob", "r1", 3, 1), ("username", "bob", "r1", 0, 1), ("username", "Bob", "r1", 3, 9), ("org", "Bob", "r9", 1, 1)]
    names = ["category", "value", "record_id", "at", "start"]
    got = records.firsts(pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows])).to_pylist()
    assert sorted(tuple(r.values()) for r in got) == [("org", "Bob", "r9", 1, 1), ("username", "Bob", "r1", 3, 1), ("username", "bob", "r1", 0, 1)]


def test_events_are_dealt_out_before_their_records_are_made(spark):
    """In more parts than cores; before, whole records were dealt out, one part a core."""
    df = queries._raw_records(spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    dealt = df._jdf.queryExecution().optimizedPlan().toString().partition("Repartition")[2]
    assert dealt and "clientIP" not in dealt


def test_anchors_are_the_first_rarest_grams(spark):
    rng = random.Random(4)
    counts = contains.np.array(rng.choices(range(5), k=1 << contains.COUNT_BITS))
    words = {"".join(rng.choices("abcdé", k=rng.randint(2, 30))) for _ in range(500)} | {"x" * 100, ""}
    want = set()
    for w in words:
        hashes = contains.gram_hashes(w)
        held_by = counts[contains._top(hashes, contains.COUNT_BITS)].tolist()
        want |= {(w, int(hashes[at].astype("int64")), at, len(w) - at, min(held_by)) for at in [held_by.index(min(held_by))]} if held_by else set()
    got = contains.anchored(spark.createDataFrame([(w,) for w in [*words, None]], "w string"), "w", counts).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
