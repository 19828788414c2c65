"""The stores, published folders, findings of several detectors: read back, run twice, and odd rows."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sievelog.operators import registry, review, spans
from sievelog.sources import catalog, sinks, store

UID = "1d19dad6-ba7b-11da-9d73-000000000000"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_of_indexed_folders(spark, tmp_path):
    rows = [(o, p, UID if n else None, json.dumps({"n": n, "o": o})) for o in ("a", "b", "c") for p in ("p1", "p2") for n in range(3)] + [("a", "p1", UID, "{"), ("a", "p1", UID, None), ("a", "p1", UID, " ")]
    events = spark.createDataFrame(rows, "org_id string, partition string, created_at string, artifact_json string")
    store.write_events(events, f"{tmp_path}/events")
    index = store.partition_index(events)
    assert {(r.org_id, r.partition) for r in index.collect()} == {(o, p) for o in "abc" for p in ("p1", "p2")}
    good, bad = store.read_events(spark, f"{tmp_path}/events", index.filter("partition = 'p1' OR org_id = 'c'"), ["a", "c"])
    assert "dynamicpruning" in plan(good)
    got = sorted((r.org_id, r._partition, r.n, r._created_at > 0, r._created_at_uuid) for r in good.withColumn("n", F.try_variant_get("body", "$.n", "int")).collect())
    assert got == sorted((o, p, n, bool(n), UID if n else None) for o, p in (("a", "p1"), ("c", "p1"), ("c", "p2")) for n in range(3))
    assert [r.artifact_json for r in bad.collect()] == ["{"]
    store.write_extract(good, f"{tmp_path}/out")
    back = spark.read.json(f"{tmp_path}/out")
    assert back.count() == 9 and set(back.columns) == {"n", "o", "_partition", "_created_at", "_created_at_uuid", "org_id", "partition"}


def test_objects_of_all_kinds(spark, tmp_path):
    rows = [(kind, org, f"t{i}", UID, "p", '{"x":1}' if i else "[") for kind in store.KINDS for org in ("a", "b") for i in range(2)]
    store.write_objects(spark.createDataFrame(rows, "kind string, org_id string, id string, created_at string, partition string, object string"), f"{tmp_path}/objects")
    good, bad = store.read_objects(spark, f"{tmp_path}/objects", ["b"])
    assert "PartitionFilters: [" in plan(good) and bad.count() == 4
    lines = {r.kind: json.loads(r.line) for r in good.select("kind", store.with_metadata(good).alias("line")).collect()}
    assert set(lines) == set(store.KINDS.values())
    assert lines["threat_hits"] == {"x": 1, "_org_id": "b", "_threat_id": "t1"} and set(lines["nodes"]) == {"x", "_org_id", "_partition", "_created_at"}


def test_publications_replace_each_other(spark, tmp_path):
    path = f"{tmp_path}/published"
    assert sinks.manifest(spark, path) is None
    lines = ['{"edges":{},"nodes":{}}', '{"messageType":"a"}', '{"messagetype":"b"}', '{"x":1}', "{", "", None, "  "]
    frame = lambda x: spark.createDataFrame([(v,) for v in x], "value string")
    parts = sinks.publish_records(frame(lines), path)
    assert parts == {"records": {"rows": 4, "artifact": 2, "incident": 1, "other": 1}, "quarantine": {"rows": 1}}
    first = sinks.part_path(spark, path, "records")
    assert {(r.route, r.value) for r in spark.read.text(first).collect()} == {("incident", lines[0]), ("artifact", lines[1]), ("artifact", lines[2]), ("other", lines[3])}
    assert [r.value for r in spark.read.text(sinks.part_path(spark, path, "quarantine")).collect()] == ["{"]

    def broken(df, where):
        df.write.text(where)
        raise OSError("lost")

    half = sinks.Publication(spark, path)
    with pytest.raises(OSError):
        half.part("records", frame(["x"]), broken)
    assert sinks.part_path(spark, path, "records") == first
    assert sinks.publish_records(frame(['{"x":2}']), path)["records"]["rows"] == 1
    assert [r.value for r in spark.read.text(sinks.part_path(spark, path, "records")).collect()] == ['{"x":2}']
    import os

    assert sorted(f for f in os.listdir(path) if not f.startswith(".")) == sorted([sinks.manifest(spark, path)["version"], sinks.MANIFEST])


def test_graph_files(spark, tmp_path):
    from sievelog.operators import graph, labels
    from sievelog.plans import queries as Q
    from sievelog.plans import views as V

    sf = "/root/testdata/sf0.001"
    nodes, edges = graph.build_graph(labels.label_events(V.artifacts(spark, sf), *V.catalog(spark)), Q._labelled_cases(spark, sf))
    path = f"{tmp_path}/graph"
    made = sinks.publish_graph(nodes, edges, Q._labelled_cases(spark, sf), ["event_id", "incident_id", "pos"], path, ["ip", "hostname"])
    assert made["parts"]["nodes"]["rows"] == nodes.count() and made["parts"]["edges"]["rows"] == edges.count()
    read = lambda name: spark.read.text(sinks.part_path(spark, path, name))
    ids = sorted(json.loads(r.value)["edge_id"] for r in read("edges").collect())
    assert ids[0] == "e-00000000" and ids[-1] == f"e-{edges.count() - 1:08d}" and len(set(ids)) == len(ids)
    files = sorted(f for f in __import__("glob").glob(sinks.part_path(spark, path, "graphml") + "/part-*"))
    text = "".join(open(f).read() for f in files)
    import xml.etree.ElementTree as ET

    root = ET.fromstring(text)
    space = {"g": "http://graphml.graphdrawing.org/xmlns"}
    assert len(root.findall(".//g:node", space)) == nodes.count() and len(root.findall(".//g:edge", space)) == edges.filter("src <> '' AND dst <> ''").count()
    one = spark.read.parquet(sinks.part_path(spark, path, "incident_graphml")).first()
    assert ET.fromstring(one.graphml).find("g:graph", space).get("edgedefault") == "directed"
    links = read("node_link")
    assert links.filter("section = 'node'").count() == nodes.count()


def test_findings_of_several_detectors(spark):
    """A model's findings beside the patterns': the better of two that overlap stays; weak ones go."""
    def model(texts):
        return [[("PERSON", t.index("Ada") + 1, 3, 0.9), ("PERSON", 1, 4, 0.5), ("ORGANIZATION", max(1, t.find("ada@") + 1), 3, 0.8)] if "Ada" in t else [] for t in texts]

    df = spark.createDataFrame([(1, "seen Ada with ada@corp.lan today"), (2, "nothing"), (3, None), (4, "10.1.2.3")], "record_id long, text string")
    got = {(r.record_id, r.entity, r.start, r.value, round(r.score, 2)) for r in review.residual_findings(df, "text", more=review.model_detector(model, "text")).collect()}
    assert got == {(1, "PERSON", 6, "Ada", 0.9), (1, "EMAIL_ADDRESS", 15, "ada@corp.lan", 0.9), (4, "IP_ADDRESS", 1, "10.1.2.3", 0.6)}


def test_chains_of_findings():
    assert spans.best_chain([(1, 5, 0.5), (3, 4, 0.9), (6, 3, 0.9), (8, 2, 0.4), (12, 1, 0.1)]) == [1, 3, 4]
    begin = time.time()
    assert len(spans.best_chain([(i, 2, (i % 7) / 7) for i in range(100_000)])) > 1000 and time.time() - begin < 5


def test_categories_and_answers(spark):
    answers = ['[{"span":"Acme","category":"org","confidence":0.9},{"span":"ab","category":"org","confidence":0.9},{"span":"10.1.1.1","category":"ip","confidence":0.6}]', 'text ```json\n[{"span":"web01","category":"hostname","confidence":0.5}]\n``` more', "see [{\"span\":\"bob\",\"category\":\"person\",\"confidence\":1}]", "none", None, '[{"span":"eve","category":"username","confidence":0.4}]']
    df = spark.createDataFrame(list(enumerate(answers)), "record_id int, answer string")
    got = {(r.record_id, r.category, r.value) for r in review.ingest_findings(df, "answer").collect()}
    assert got == {(0, "org", "Acme"), (0, "ipv4_priv", "10.1.1.1"), (1, "hostname", "web01")}


def test_catalogue_and_configuration(spark, tmp_path):
    doc = {"lead_rules": [{"id": 1, "criteria": "x", "client_set_id": 2, "product_id": 9}, {"id": 2, "description": "named"}], "sets": {"2": "Bot"}, "products": {"9": {"name": "P", "vendor": "V", "streams": ["s"], "frameworks": {"attck": ["T1059"]}}}, "stream_to_product": {"s": {"product_name": "P", "vendor": "V"}}}
    (tmp_path / "catalogue.json").write_text(json.dumps(doc, indent=1))
    rules, sets, products, streams = catalog.read_catalogue(spark, f"{tmp_path}/catalogue.json")
    assert {(r.rule_id, r.description, r.client_set_id, r.server_set_id) for r in rules.collect()} == {(1, "Rule-1", 2, 0), (2, "named", 0, 0)}
    assert sets.first()[:] == (2, "Bot") and products.first().frameworks == {"attck": ["T1059"]} and streams.first()[:] == ("s", "P", "V")
    (tmp_path / "config.json").write_text(json.dumps({"organizations": {"acme": "Acme", "_note": "x"}, "customer_domains": ["acme.test", "_c"], "organization_ids": {"7": "1"}}))
    assert {tuple(r) for r in catalog.read_config(spark, f"{tmp_path}/config.json").collect()} == {("org", "acme", "Acme"), ("domain", "acme.test", None), ("org_id", "7", "1")}
    reg = registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), catalog.seeds(catalog.read_config(spark, f"{tmp_path}/config.json")), b"s")
    assert {(r.category, r.norm, r.sanitized) for r in reg.collect()} == {("org", "acme", "ORG-0001"), ("domain", "acme.test", "domain-0001.example.net")}
    reg.write.parquet(f"{tmp_path}/registry")
    assert catalog.read_registry(spark, f"{tmp_path}/registry", "org").count() == 1 and catalog.read_registry(spark, f"{tmp_path}/registry").count() == 2
    assert registry.resolve_any(spark.createDataFrame([(" ACME ",), ("x",)], "value string"), reg).filter("token = 'ORG-0001'").count() == 1
