"""Whole records: leaves by path, values in lists, kept subtrees, inner JSON, the sweep, and records made anew."""

import json

import pytest
from pyspark.sql import functions as F

from sievelog.operators import json_text, marks, records, registry

EMPTY: list = []


def published(spark, bodies, known=(), sweep=True, domains=()):
    raw = records.Sanitized.records(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id long, body string"), "body", domains)
    reg = raw.grown(spark.createDataFrame(list(known), registry.SCHEMA), b"s")
    return {r.id: r.body for r in raw.published(reg, sweep).collect()}, {(r.category, r.norm): r.sanitized for r in reg.collect()}


def test_lists_kept_subtrees_and_escapes(spark):
    body = {
        "hosts": ["10.1.2.3", "bob@corp.com"], "userName": ["carol", ["dave"]], "clientIP": ["10.4.4.4"], "tags": {"user": "alice"}, "q\"k": {"owner": "erin\"x"}, "n": [1, 1.5, True, None], "empty": {}, "list": [],
        "Frameworks": {"deep": [{"user": "mallory"}]}, "orgId": 7, "org_id": "z", "nested": {"orgid": 9, "port": 443}, "serverHostname": "IP-0A010203", "organization": "Acme Ltd (acme.corp.lan)", "credential": "TrustedAdvisor_123456789012_" + "a" * 8 + "-bbbb-cccc-dddd-" + "e" * 12,
    }
    out, reg = published(spark, [json.dumps(body)], sweep=False)
    new = json.loads(out[0])
    assert new["hosts"] == [reg["ipv4_priv", "10.1.2.3"], reg["email", "bob@corp.com"]]
    assert new["userName"] == [reg["username", "carol"], [reg["username", "dave"]]] and new["clientIP"] == [reg["ipv4_priv", "10.4.4.4"]]
    assert new["tags"] == {"user": "alice"} and new["Frameworks"] == body["Frameworks"] and new["n"] == body["n"] and new["empty"] == {} and new["list"] == []
    assert new["q\"k"]["owner"] == reg["username", 'erin"x']
    assert (new["orgId"], new["nested"]) == (int(reg["org_id", "7"]), {"orgid": int(reg["org_id", "9"]), "port": 443})
    assert new["serverHostname"] == "IP-" + "".join(f"{int(b):02X}" for b in reg["ipv4_priv", "10.1.2.3"].split("."))
    assert new["organization"] == f"{reg['org', 'acme ltd']} ({reg['domain', 'acme.corp.lan']})"
    assert new["credential"].startswith(f"TrustedAdvisor_{reg['aws_account', '123456789012']}_CRED-")


def test_inner_json_by_path(spark):
    inner = {"agent": {"id": {"a": 1}, "name": "web01"}, "host": {"x": [{"y": 2}], "name": "db01.corp.lan"}, "user": ["alice", {"name": "kept"}], "event": {"name": "kept too"}, "text": "CORP\\bob at 10.7.7.7"}
    out, reg = published(spark, [json.dumps({"streamName": "windows_security_audit", "message": "WinLogBeat ::: " + json.dumps(inner)})], sweep=False)
    message = json.loads(out[0])["message"]
    assert message.startswith("WinLogBeat ::: ")
    new = json.loads(message[15:])
    assert new["agent"] == {"id": {"a": 1}, "name": reg["hostname", "web01"]} and new["host"]["name"] == reg["fqdn", "db01.corp.lan"]
    assert new["user"] == [reg["username", "alice"], {"name": "kept"}] and new["event"]["name"] == "kept too"
    assert new["text"] == f"{reg['org', 'corp']}\\{reg['username', 'bob']} at {reg['ipv4_priv', '10.7.7.7']}"
    audit = {"userName": "zoe", "resources": [{"arn": "arn:aws:s3:::bucket/key1"}, {"accountId": "500000000001"}], "detail": "arn:aws:iam::500000000002:role/r/x", "sourceIPAddress": "ec2.amazonaws.com"}
    out, reg = published(spark, [json.dumps({"pipelineName": "in_cloudtrail", "message": json.dumps(audit)}), json.dumps({"pipelineName": "in_cloudtrail", "message": "acct 500000000001 from 10.1.1.1"})], sweep=False)
    new = json.loads(json.loads(out[0])["message"])
    assert new["resources"] == [{"arn": f"{reg['arn', 'arn:aws:s3:::bucket']}/{reg['credential', 'key1']}"}, {"accountId": reg["aws_account", "500000000001"]}]
    assert new["detail"] == f"arn:aws:iam::{reg['aws_account', '500000000002']}:role/r/{reg['credential', 'x']}" and new["sourceIPAddress"] == "ec2.amazonaws.com"
    assert json.loads(out[1])["message"] == f"acct {reg['aws_account', '500000000001']} from {reg['ipv4_priv', '10.1.1.1']}"


def test_what_one_field_shows_is_replaced_in_all(spark):
    """The sweep reaches free text, kept fields and other records, but neither guarded fields nor short texts."""
    bodies = [
        '{"userName":"Marvin.K"}', '{"note":"call MARVIN.K or marvin.kay","action":"login of marvin.k","status_name":"marvin.k was here","tags":{"a":"marvin.k","b":["see marvin.k!"]}}',
        '{"message":"user marvin.k from 10.2.2.2","streamName":"x"}', "not json marvin.k", None, '{"a":NaN,"userName":"eve"}', "[{\"userName\":\"marvin.k\"}]",
    ]
    out, reg = published(spark, bodies)
    token = reg["username", "marvin.k"]
    assert json.loads(out[1]) == {"note": f"call {token} or {token}ay", "action": f"login of {token}", "status_name": "marvin.k was here", "tags": {"a": "marvin.k", "b": [f"see {token}!"]}}
    assert json.loads(out[2])["message"] == f"user {token} from {reg['ipv4_priv', '10.2.2.2']}" and json.loads(out[6]) == [{"userName": token}]
    assert (out[3], out[4], out[5]) == (bodies[3], None, bodies[5]) and ("username", "eve") not in reg


def test_repeated_rows_seeds_and_empty_table(spark):
    body = '{"userName":"frank","x":"at shop.acme.test today"}'
    seed = ("username", "frank", "frank", "USER-0007", 7)
    out, reg = published(spark, [body, body, '{"userName":"gina"}'], [seed], domains=("acme.test",))
    assert out[0] == out[1] == '{"userName":"USER-0007","x":"at shop.acme.test today"}' and reg["username", "gina"] == "USER-0008"
    out, reg = published(spark, ['{"message":"at shop.acme.test today"}'], domains=("acme.test",))
    assert json.loads(out[0])["message"] == f"at {reg['fqdn', 'shop.acme.test']} today"
    assert published(spark, []) == ({}, {})


@pytest.fixture
def review(spark):
    """Finds the words that a reviewer would: names after 'aka', in what is published."""

    def detect(out):
        found = out.select(F.col("id").alias("record_id"), F.explode(F.regexp_extract_all("body", F.lit(r"aka ([a-z]{4,})"), F.lit(1))).alias("value"))
        return found.select("record_id", F.lit(0).alias("start"), F.lit("username").alias("category"), "value")

    return detect


def test_loop_ends_and_remakes_only_holders(spark, review, monkeypatch):
    rows = [(0, '{"note":"this is zorro aka elvis, twice elvis"}'), (1, '{"note":"elvis aka king has left"}'), (2, '{"note":"the king is here at last"}'), (3, '{"note":"nobody is in this one"}'), (4, '{"message":"10.3.3.3 aka elvis"}')]
    raw = records.Sanitized.records(spark.createDataFrame(rows, "id long, body string"), "body")
    made = []
    whole = records.Sanitized.published
    monkeypatch.setattr(records.Sanitized, "published", lambda self, reg, sweep=True, rids=None: (made.append(None if rids is None else rids.count()), whole(self, reg, sweep, rids))[1])
    out, reg, new = records.converged(raw, spark.createDataFrame([], registry.SCHEMA), review, b"s")
    assert new == [2, 0] and made == [None, 4]
    tokens = {r.norm: r.sanitized for r in reg.collect()}
    got = {r.id: r.body for r in out.collect()}
    assert got[0] == f'{{"note":"this is zorro aka {tokens["elvis"]}, twice {tokens["elvis"]}"}}' and got[2] == f'{{"note":"the {tokens["king"]} is here at last"}}' and got[3] == rows[3][1]
    again = {r.id: r.body for r in whole(raw, reg).collect()}
    assert again == got
    out, reg, new = records.converged(raw, reg, review, b"s")
    assert new == [0] and {r.id: r.body for r in out.collect()} == got


def test_depth_and_odd_texts():
    deep = "{" + '"a":{' * 25 + '"userName":"x"' + "}" * 26
    assert json_text.shown(json_text.parsed(deep)) == deep and not list(json_text.leaves(json_text.parsed(deep)))
    assert [json_text.parsed(t) for t in ("7", '"x"', "", None, "{", '{"a":Infinity}', "[1", "{" * 5000)] == [None] * 8
    assert json_text.shown(json_text.parsed('{"a": 1.50, "b": "é\\u0041\\n", "a": 2}')) == '{"a":2,"b":"éA\\n"}'


@pytest.mark.parametrize("name, value, category", [
    ("clientip", "10.1.1.1", "ipv4_priv"), ("clientip", "web01", "hostname"), ("senderhost", "-", ""), ("hostname", "a.b.corp", "fqdn"), ("organization", "BUILTIN", "org"), ("username", "SYSTEM", ""), ("username", "nobody2", "username"), ("credential", "WEB01$", "machine_account"),
    ("credential", "abc", "credential"), ("name", "Bitter Reindeer", None), ("name", "8.8.8.8", "ipv4_pub"), ("_org_id", "acme", "org"), ("peer_host", "web01", "hostname"), ("peer_host", "tcp", None), ("owner", "root", None), ("realm", "WORKGROUP", None), ("x", "S-1-5-21-1-2-3-500", "sid"),
    ("x", "cdn.github.com", None), ("x", "192.0.2.7", None), ("x", "127.0.0.1", ""), ("x", "HOST-0001", None), ("x", "ab", None), ("x", "y" * 501, None), ("x", "T1059.001", None), ("host", "t1server", "hostname"), ("x", "plain words", None),
])
def test_classes_of_fields(name, value, category):
    assert marks.mark_field(name, value) == [(value, category)]
