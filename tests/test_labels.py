"""A small data set end to end: one incident, three events, labels, the flat table, reports and written files."""

import json

import pytest
from pyspark.sql import functions as F

from sievelog.functions import detectors
from sievelog.operators import exports, incidents, labels, registry, reports, review, verify
from sievelog.plans import views as V
from sievelog.sources import tables

FRAMEWORKS = "map<string,array<string>>"
NODE = f"struct<type:string,ip_address:string,ip:string,hostname:string,credential:string,suspicion_score:double,internal:boolean,managed:boolean,sets:map<string,struct<id:int,name:string>>,products:map<string,struct<name:string,frameworks:{FRAMEWORKS}>>>"
LEAD = "struct<observed_at:double,description:string,details:string,set_id:int,product:struct<name:string>,artifact:struct<message_type:string,stream:string,client_ip:string,server_ip:string,action:string>>"
CASE = f"id string, name string, mo_name string, suspicion_score double, status_name string, status_id int, created_at double, first_observed_at double, last_observed_at double, sets string, nodes map<string,{NODE}>, edges map<string,struct<source:string,target:string,subtype:string,started:int,ended:int,count:int,bytes:long>>, leads map<string,{LEAD}>"


def case(spark, id="INC-1", status="Resolved", score=0.85, sets='{"1":{"name":"C2 Server"},"2":{"name":"Ransomware Target"}}', leads=None, mo="Ransomware", nodes=None):
    lead = (1.7e9, "rule", "details", 1, ("product",), ("firewall_action", "watch", "192.0.2.10", "203.0.113.20", "block"))
    row = (id, "Case", mo, score, status, 3, 1.7e9, 1.7e9, 1.7e9, sets, nodes or {}, {}, {"L-1": lead} if leads is None else leads)
    return spark.createDataFrame([row], CASE).withColumn("sets", F.try_parse_json("sets"))


@pytest.fixture
def catalogue(spark):
    return V.catalog(spark)


def labelled(spark, df, catalogue, products=None):
    return incidents.incident_labels(df, catalogue[1], products)


def test_three_labels(spark, catalogue):
    events = spark.createDataFrame([(1, "firewall_action", "watch", [1]), (2, "dns_event", "dns", []), (3, "firewall_action", "watch", [1, 1, 999])], "event_id long, message_type string, stream string, rule_ids array<int>")
    own = labels.label_events(events, *catalogue)
    every = labels.all_events(own, incidents.incident_leads(labelled(spark, case(spark), catalogue)))
    assert {r.label_binary: r["count"] for r in every.groupBy("label_binary").count().collect()} == {"suspicious": 2, "benign": 1, "malicious": 1}
    benign = every.filter("label_binary = 'benign'").first()
    assert (benign.attack_tactics, benign.attack_techniques, benign.label_confidence, benign.lifecycle_stage) == ([], [], 0.5, "none")
    assert all(r.label_confidence >= 0.5 for r in every.filter("label_binary = 'suspicious'").collect())


def test_malicious_events_carry_their_incident(spark, catalogue):
    lab = incidents.incident_leads(labelled(spark, case(spark), catalogue)).first()
    assert {"TA0040", "TA0011"} <= set(lab.attack_tactics) and "T1486" in lab.attack_techniques
    assert (lab.mo_name, lab.disposition, lab.is_false_positive, lab.label_confidence) == ("Ransomware", "Resolved", False, 0.85)
    low = incidents.incident_leads(labelled(spark, case(spark, status="False Positive", score=0.9), catalogue)).first()
    assert (low.label_confidence, low.is_false_positive, low.disposition) == (0.3, True, "False Positive")


@pytest.mark.parametrize("changes", [{"score": None}, {"status": None}, {"sets": None}, {"sets": "[]"}, {"mo": None}, {"leads": {}}, {"sets": '[{"name":null},{"x":1}]'}])
def test_incomplete_incidents(spark, catalogue, changes):
    """Nulls raise nothing: a null score counts 0, a null status is unprocessed, no lead is no event."""
    r = labelled(spark, case(spark, **changes), catalogue).first()
    assert r.suspicion == (0.0 if changes.get("score", 0) is None else 0.85) and r.disposition == ("Unprocessed" if changes.get("status", 0) is None else "Resolved")
    assert incidents.incident_leads(labelled(spark, case(spark, **changes), catalogue)).count() == (0 if changes.get("leads") == {} else 1)
    report = reports.attack_reports(case(spark, **changes), catalogue[1]).first()
    assert report.report_text.startswith("Incident `INC-1`") and (report.mo_name == "Unknown") == ("mo" in changes)


def test_catalogue_frameworks_of_product_numbers(spark, catalogue):
    node = ("host", "10.1.1.1", None, "h", "", 0.1, True, None, {}, {"7": ("P", None), "x": ("Q", {"d3fend": ["D3-NI"]}), "99": ("R", {})})
    products = spark.createDataFrame([(7, {"attck": ["t1110", "bad"], "mitre": ["1003"]})], f"product_id int, frameworks {FRAMEWORKS}")
    df = case(spark, mo="", sets="[]", nodes={"n": node})
    assert labelled(spark, df, catalogue, products).first().attack_techniques == ["T1003", "T1110"]
    assert labelled(spark, df, catalogue).first().attack_techniques == [] and labelled(spark, df, catalogue).first().defense_techniques == ["D3-NI"]


def test_the_flat_table_and_its_files(spark, catalogue, tmp_path):
    signal = exports.to_signal(incidents.incident_leads(labelled(spark, case(spark), catalogue)).select("*", "artifact.*"))
    r = signal.first()
    assert len(signal.columns) == 33 and (r.timestamp, r.src_ip, r.dst_ip, r.action, r.label_binary, r.suspicion_score, json.loads(r.incident_ids)) == (1.7e9, "192.0.2.10", "203.0.113.20", "block", "malicious", 0.85, ["INC-1"])
    exports.write_signal(signal, f"{tmp_path}/out", rows_per_file=1)
    assert spark.read.parquet(f"{tmp_path}/out/signals.parquet").columns == signal.columns and spark.read.option("header", True).csv(f"{tmp_path}/out/signals.csv").first().src_ip == "192.0.2.10"
    assert exports.write_incidents(case(spark).drop("sets"), f"{tmp_path}/incidents") == 1


def test_records_as_text(spark, tmp_path):
    df = spark.createDataFrame([(1, bytearray(b"\x01\xff"), "a"), (2, None, "b")], "n int, raw binary, part string").withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    exports.write_records(df, f"{tmp_path}/out", ["part"])
    got = {r.part: json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()}
    assert got == {"a": {"n": 1, "raw": "01ff", "part": "a", "at": "2024-01-02T03:04:05.000"}, "b": {"n": 2, "part": "b", "at": "2024-01-02T03:04:05.000"}}
    good, bad = tables.parse_lines(spark.createDataFrame([('{"nodes":{},"edges":{}}',), ('{"clientip":null,"clientIP":"x"}',), ("",), ("{",)], "value string"))
    exports.write_routed(good, f"{tmp_path}/routed")
    assert {r.route for r in spark.read.text(f"{tmp_path}/routed").collect()} == {"incident", "other"} and bad.count() == 1
    assert {r[0] for r in good.select(tables.alias(F.col("body"), "clientIP")).collect()} == {None, "x"}
    sample = exports.review_sample(spark.range(300).select("id", F.lpad(F.col("id").cast("string"), 600, "x").alias("text")), "text", "id")
    assert sample.count() == 100 and sample.filter("length(text) = 500").count() == 100


def test_audits_of_written_files(spark, tmp_path):
    """Lines with their numbers in each file, leaks in them, and a report of all checks."""
    for name, lines in (("a.txt", ["one", "from 10.1.1.1 to 8.8.4.4", "", "x@acme.test"]), ("b.txt", ["Server01 up"]), ("metadata.json", ["server01"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    cells = verify.file_lines(spark, str(tmp_path))
    got = {tuple(r.row_key.rsplit("/", 1)[1].rsplit(":", 1)): r.value for r in cells.collect()}
    assert got == {("a.txt", "1"): "one", ("a.txt", "2"): "from 10.1.1.1 to 8.8.4.4", ("a.txt", "3"): "", ("a.txt", "4"): "x@acme.test", ("b.txt", "1"): "Server01 up"}
    reg = spark.createDataFrame([("ipv4_priv", "10.1.1.1", "10.1.1.1", "10.2.2.2", 1), ("hostname", "server01", "Server01", "HOST-0001", 1), ("org", "a1", "a1", "ORG-0001", 1), ("org", "b1", "b1", "ORG-0001", 2)], registry.SCHEMA)
    checks = verify.all_checks(cells, reg, [detectors.customer_domains(["acme.test"])])
    assert {(r.kind, r.severity, r.row_key.rsplit("/", 1)[-1], r.detail) for r in checks.collect()} == {
        ("pattern", "violation", "a.txt:4", "x@acme.test"), ("public_address", "warning", "a.txt:2", "8.8.4.4"), ("collision", "violation", "ORG-0001", "2"), ("registry_value", "violation", "a.txt:2", "10.1.1.1"), ("registry_value", "violation", "b.txt:1", "server01"),
    }
    share = verify.label_distribution(spark.createDataFrame([("benign",), ("benign",), ("suspicious",)], "label_binary string"))
    report = {(r.section, r.value.rsplit("/", 1)[-1], r.n) for r in verify.report(checks, share).collect()}
    assert {("count", "violation", 4), ("count", "warning", 1), ("label", "benign", 2)} <= report and sum(s == "violation_detail" for s, _, _ in report) == 4
    assert verify.no_malicious(share).count() == 1 and verify.no_malicious(spark.createDataFrame([("malicious", 1)], "label string, n long")).count() == 0


def test_samples_are_the_same_each_time(spark):
    one, two = (review.sampled(spark.range(1000).repartition(n), 50, "id") for n in (3, 7))
    assert {r.id for r in one.collect()} == {r.id for r in two.collect()} and one.count() == 50 and review.sampled(spark.range(3), 50, "id").count() == 3
