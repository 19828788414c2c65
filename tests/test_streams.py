"""Streams that die and start again, against the batch job over all rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sievelog.operators import labels, registry
from sievelog.streaming import events as streaming


def drained(writer, batches=None):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def forget_last_commit(checkpoint):
    """As if the query had died after it wrote its last batch, before it committed it."""
    last = max((int(os.path.basename(f)), f) for f in glob.glob(f"{checkpoint}/commits/[0-9]*"))[1]
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(f):
            os.remove(f)


@pytest.fixture
def source(spark, tmp_path):
    """A folder to which files are added one by one, and a stream over it that takes one file a batch."""
    path = f"{tmp_path}/in"
    os.makedirs(path)
    names = []

    def add(rows, schema):
        names.append(f"{len(names):03d}")
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    return add


def test_first_leads_by_order_not_by_arrival(spark, tmp_path, source):
    schema = "lead_id long, incident_id string, pos long, has_artifact boolean, x string"
    parts = [
        [(1, "INC-5", 0, True, "late"), (2, "INC-1", 0, False, "no artifact"), (3, "INC-9", 1, True, "a")], [(1, "INC-2", 7, True, "better"), (2, "INC-4", 0, True, "b")],
        [(1, "INC-2", 3, True, "best"), (1, "INC-1", 0, False, "none"), (3, "INC-9", 1, True, "a"), (None, "INC-1", 0, True, "null")], [(1, "INC-8", 0, True, "worse"), (4, "INC-1", 1, True, "c")],
    ]
    out, checkpoint, seen = f"{tmp_path}/out", f"{tmp_path}/checkpoint", []
    for n, part in enumerate(parts):
        stream = source(part, schema)
        seen += part
        drained(streaming.first_leads_stream(stream, out, checkpoint))
        if n in (1, 3):
            forget_last_commit(checkpoint)
            drained(streaming.first_leads_stream(stream, out, checkpoint))
        got = streaming.first_leads_written(spark, out, schema)
        want = labels.first_leads(spark.createDataFrame(seen, schema))
        assert {tuple(r) for r in got.select(want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_registry_grows_once(spark, tmp_path, source):
    schema = "record_id long, start int, category string, value string"
    parts = [[(1, 0, "hostname", "Web01"), (2, 0, "hostname", "db01"), (2, 1, "ipv4_priv", "10.1.1.1")], [(3, 0, "hostname", "WEB01"), (4, 0, "hostname", "app01"), (5, 0, "username", None)], [(6, 0, "hostname", "aaa"), (7, 0, "username", "bob")]]
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    batch, states = spark.createDataFrame([], registry.SCHEMA), []
    for part in parts:
        stream = source(part, schema)
        drained(streaming.registry_stream(stream, out, checkpoint, b"s"))
        forget_last_commit(checkpoint)
        drained(streaming.registry_stream(stream, out, checkpoint, b"s"))
        batch = spark.createDataFrame(registry.grow_registry(batch, spark.createDataFrame(part, schema), b"s").collect(), registry.SCHEMA)
        got = {tuple(r) for r in streaming.written(spark, out, registry.SCHEMA).drop("batch").collect()}
        assert got == {tuple(r) for r in batch.collect()}
        states.append(got)
    assert states[0] < states[1] < states[2]


def test_records_are_published_as_they_come(spark, tmp_path, source):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    stream = source([(1, '{"userName":"marvin"}'), (2, "no json")], "id long, body string")
    drained(streaming.sanitized_stream(stream, "body", out, checkpoint, b"s"))
    stream = source([(3, '{"note":"it was marvin again"}')], "id long, body string")
    for _ in range(2):
        drained(streaming.sanitized_stream(stream, "body", out, checkpoint, b"s"))
        forget_last_commit(checkpoint)
    got = {r.id: (r.body, r.batch) for r in streaming.written(spark, f"{out}/records", "id long, body string, n_replaced int").collect()}
    assert got == {1: ('{"userName":"USER-0001"}', 0), 2: ("no json", 0), 3: ('{"note":"it was USER-0001 again"}', 1)}


def test_labels_of_a_stream(spark, tmp_path, source):
    schema = "event_id long, stream string, rule_ids array<int>"
    catalogue = (
        spark.createDataFrame([(1, "r1", 7001, 2, 1)], "rule_id int, description string, client_set_id int, server_set_id int, product_id int"), spark.createDataFrame([(1, "Bot"), (2, "C2 Server")], "set_id int, role string"),
        spark.createDataFrame([(1, "p", "v")], "product_id int, product_name string, vendor_name string"), spark.createDataFrame([("s", "sp", "sv")], "stream string, product_name string, vendor_name string"),
    )
    rows = [(i, "S" if i % 3 else None, [1] if i % 2 else []) for i in range(20)]
    for part in (rows[:9], rows[9:]):
        stream = source(part, schema)
        drained(streaming.label_stream(stream, *catalogue, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    want = labels.label_events(spark.createDataFrame(rows, schema), *catalogue)
    got = spark.read.parquet(f"{tmp_path}/out")
    shown = lambda df: sorted(map(str, df.select(*want.columns).withColumn("event_id", F.col("event_id").cast("long")).collect()))
    assert shown(got) == shown(want)


def test_nothing_written_yet(spark, tmp_path):
    assert streaming.written(spark, f"{tmp_path}/none", "a int").collect() == []
