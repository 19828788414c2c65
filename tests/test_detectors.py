"""Patterns on hand-made values, and what each class of text becomes."""

import re

import pytest
from pyspark.sql import functions as F

from sievelog.functions import detectors as D
from sievelog.operators import marks

UID = "aaaaaaaa-bbbb-cccc-dddd-eeeeeeeeeeee"


@pytest.mark.parametrize("pattern, whole, parts", [
    (D.IPV4, ["192.168.1.1", "8.8.8.8", "255.255.255.255"], ["999.999.999.999", "1.2.3", "01.2.3.4", "x"]), (D.RFC1918, ["10.0.0.1", "172.16.0.1", "172.31.9.9", "192.168.0.9"], ["172.32.0.1", "172.15.0.1", "11.0.0.1", "192.169.1.1"]),
    (D.FQDN, ["host.corp.lan", "a.b.c.example.com"], ["localhost", "two.labels", "-a.b.com"]), (D.EMAIL, ["a.b+c@x-y.org"], ["a@b", "@x.org"]), (D.SID, ["S-1-5-21-1-2-3-1001", "S-1-5-32-544"], ["S-1-5-18", "S-1-4-1-2", "S-2-5-1-1"]),
    (D.MACHINE, ["DC-SERVER01$"], ["dc01$", "A$", "regular-user"]), (D.ACCOUNT_ID, ["123456789012"], ["12345678901", "1234567890123"]), (D.ARN, ["arn:aws:iam::123456789012:user/bob", "arn:aws-cn:s3:::bucket/key"], ["arn:gcp:iam::1:x", "arn:aws:iam"]),
    (D.ADVISOR, [f"TrustedAdvisor_123456789012_{UID}"], ["TrustedAdvisor_1_x"]), (D.HEX_IP, ["IP-0A01ff02"], ["IP-0A01FF", "ip-0A01FF02"]), (D.UUID, [UID, UID.upper()], [UID[:-1]]), (D.ORG_DOMAIN, ["Acme Ltd (acme.corp.lan)"], ["Acme (acme)", "(a.b.cc)"]),
])
def test_whole_values(spark, pattern, whole, parts):
    """The same verdict in Spark and in the tasks' Python."""
    rows = spark.createDataFrame([(v,) for v in whole + parts], "v string").select("v", F.col("v").rlike(f"^(?:{pattern})$").alias("hit")).collect()
    assert {r.v for r in rows if r.hit} == set(whole)
    assert {v for v in whole + parts if re.fullmatch(pattern, v, re.ASCII)} == set(whole)


def test_groups_of_patterns():
    assert re.findall(D.IPV4_PORT, "10.1.1.1:443 and 10.1.1.2/80") == [("10.1.1.1", ":443", "443"), ("10.1.1.2", "/80", "80")]
    assert re.search(D.AGENT_NAME, '{"agent":{"name" : "web01"}}').group(1) == "web01"
    assert re.findall(D.UNC_SERVER, r"\\files01\share \\x") == [("\\\\", "files01"), ("\\\\", "x")]


def test_customer_domains():
    assert not re.search(D.customer_domains([]), "a.b.c")
    both = re.compile(D.customer_domains(["acme.com", "in-ternal.net"]))
    assert [bool(both.search(t)) for t in ("HOST.acme.com", "at in-ternal.net now", "google.com", "acme.community")] == [True, True, False, False]


@pytest.mark.parametrize("text, found", [
    (r"\\files01\share\x and \\ab\y and \\dns\z", [("hostname", "files01")]), ("CN=Bob Smith,OU=Sales,DC=corp,dc=lan", [("username", "Bob"), ("org", "Sales"), ("org", "corp"), ("org", "lan")]), ("cn=x", []),
    ("IP-0A010203 IP-08080808", [("ipv4_priv/hex", "10.1.2.3"), ("ipv4_pub/hex", "8.8.8.8")]), (f"TrustedAdvisor_123456789012_{UID}", [("aws_account", "123456789012"), ("credential", UID)]), ("arn:aws:s3:::b/k done", [("arn", "arn:aws:s3:::b/k")]),
    ("WEB-01$ logged on, x$ not", [("machine_account", "WEB-01$")]), (r"CORP\bob, NT\x, WORKGROUP\eve", [("org", "CORP"), ("username", "bob"), ("org", "NT"), ("username", "x"), ("username", "eve")]),
    ("to 192.0.2.5, 100.64.1.1, 127.0.0.1", [("ipv4_pub", "127.0.0.1")]), ("<13>Apr  6 2023 02:53:39 web01 x", [("hostname", "web01")]), ("<13>Apr 16 02:53:39 10.1.1.1 x", [("ipv4_priv", "10.1.1.1")]), ("", []), ("nothing here", []),
])
def test_general_steps(text, found):
    segments = marks.mark(text, "generic")
    assert "".join(s for s, _ in segments) == text
    assert [(c, v) for _, _, c, v in marks.marked(segments)] == found
    assert all(text[s - 1 : s - 1 + n] == v or c.endswith("/hex") for s, n, c, v in marks.marked(segments))
