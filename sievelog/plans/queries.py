"""The reference's operators as queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import allowlists
from ..functions import detectors as D
from ..functions import mappings as M
from ..operators import contains, exports, fields, formats, graph, incidents, labels, records, registry, reports, review, spans, sweep, verify
from ..sources import sinks, store, tables
from ..sources.scratch import saved, scratch_path, spread
from ..streaming import events as streaming
from . import views as V

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *uses: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            views = [f"{v} AS ({V.VIEW_SQL[v]})" if v in V.VIEW_SQL else CTES[v] for v in uses]
            ORACLES[f.__name__] = (f"WITH {', '.join(views)} " if views else "") + sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "pages", "conversations") else rows


_map = lambda name, t: V.values_sql(name, M.map_rows(t), "name, pos, val")
IPV4_SQL, EMAIL_SQL, FQDN_SQL = D.IPV4, D.EMAIL, D.FQDN


def _candidates_sql(shared: str) -> str:
    """E-mail and network addresses of documents that are neither loopback nor documentation nor ``shared`` ones."""
    return f"""candidates AS (
 SELECT doc_id, CASE WHEN regexp_matches(v, '^{D.RFC1918}$') THEN 'ipv4_priv' ELSE 'ipv4_pub' END AS category, v AS value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{D.IPV4}')) AS v FROM documents)
 WHERE NOT regexp_matches(v, '^(?:{D.LOOPBACK}|{D.TEST_NET}|{shared}|0\\.0\\.0\\.0|255\\.255\\.255\\.255)$')
 UNION ALL SELECT doc_id, 'email', unnest(regexp_extract_all(text, '{D.EMAIL}')) FROM documents)"""


CTES = {
    "role_tactics": _map("role_tactics", M.ROLE_TACTICS), "role_techniques": _map("role_techniques", M.ROLE_TECHNIQUES), "mo_tactics": _map("mo_tactics", M.MO_TACTICS), "mo_techniques": _map("mo_techniques", M.MO_TECHNIQUES),
    "mo_stage": _map("mo_stage", M.MO_LIFECYCLE), "role_stage": _map("role_stage", M.ROLE_LIFECYCLE), "status_map": _map("status_map", M.STATUS_DISPOSITION), "edge_map": _map("edge_map", M.MESSAGE_EDGE),
    "rules": V.values_sql("rules", V.RULES, "rule_id, description, client_set_id, server_set_id, product_id"), "sets": V.values_sql("sets", V.SETS, "set_id, role"), "products": V.values_sql("products", V.PRODUCTS, "product_id, product_name, vendor_name"), "streams": V.values_sql("streams", V.STREAMS, "stream, product_name, vendor_name"),
    "candidates": _candidates_sql(D.SHARED_NET),
    # v1_registry_leaks takes its e-mail addresses alone.
    "mail_candidates": _candidates_sql(r"100\.64\..*"),
    "hits": """hits AS (SELECT event_id, i AS pos, r.*, CASE WHEN client_set_id > 1000 THEN client_set_id % 1000 ELSE client_set_id END AS c, CASE WHEN server_set_id > 1000 THEN server_set_id % 1000 ELSE server_set_id END AS s
 FROM (SELECT event_id, k % 20 + 1 AS rid, 0 AS i FROM v_artifact WHERE k % 5 = 0 UNION ALL SELECT event_id, k % 7 + 1, 1 FROM v_artifact WHERE k % 5 = 0) x JOIN rules r ON r.rule_id = x.rid)""",
    "roles": """roles AS (SELECT event_id, role, min(pos * 2 + side) AS ord FROM (SELECT event_id, pos, 0 AS side, role FROM hits JOIN sets ON set_id = c UNION ALL SELECT event_id, pos, 1, role FROM hits JOIN sets ON set_id = s) GROUP BY 1, 2)""",
    "node_roles": "node_roles AS (SELECT incident_id, role, min(pos) AS ord FROM v_node GROUP BY 1, 2)",
}


# ---- sources, predicates, functions


@query("SELECT event_type, count_if(json_valid(props)) AS n_good, count_if(NOT json_valid(props)) AS n_bad, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY 1")
def s1_tolerant_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", F.try_parse_json("props").alias("body"))
    return rows.groupBy("event_type").agg(F.count_if(F.col("body").isNotNull()).alias("n_good"), F.count_if(F.col("body").isNull()).alias("n_bad"), F.sum(F.try_variant_get("body", "$.k", "bigint")).alias("sum_k"))


@query("SELECT event_id, CAST(event_id AS DOUBLE) / 2 AS seconds FROM events")
def s4_timeuuid(spark, sf_dir):
    hexed = F.lower(F.lpad(F.hex((F.lit(122192928000000000) + F.col("event_id") * 5000000).cast("long")), 15, "0"))
    uid = F.concat(F.substring(hexed, 8, 8), F.lit("-"), F.substring(hexed, 4, 4), F.lit("-1"), F.substring(hexed, 1, 3), F.lit("-8000-000000000000"))
    return table(spark, sf_dir, "events").select("event_id", tables.timeuuid_seconds(uid).alias("seconds"))


@query("SELECT org_id, count(*) AS n, count(DISTINCT day) AS n_days FROM (SELECT user_id % 10 AS org_id, CAST(ts AS DATE) AS day, dense_rank() OVER (PARTITION BY user_id % 10 ORDER BY CAST(ts AS DATE) DESC) AS r FROM events) WHERE r <= 3 GROUP BY 1")
def s8_newest_periods(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("org_id"), F.to_date("ts").alias("day"))
    return labels.newest_periods(rows, 3).groupBy("org_id").agg(F.count("*").alias("n"), F.count_distinct("day").alias("n_days"))


@query("SELECT event_id FROM events WHERE user_id % 10 IN (1, 3, 7) AND event_type IN (SELECT event_type FROM events GROUP BY 1 HAVING min(event_id) % 2 = 0)")
def j1_partition_index(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("org_id"), F.col("event_type").alias("partition"))
    index = rows.groupBy("org_id", "partition").agg(F.min("event_id").alias("first"))
    names = rows.groupBy("partition").agg(F.min("event_id").alias("low")).filter("low % 2 = 0")
    return tables.read_partitions(rows, index.join(names, "partition", "left_semi"), [1, 3, 7]).select("event_id")


def _stored_events(spark, sf_dir):
    """Events as the store has them; every seventh isn't JSON, every eleventh has no id."""
    rows = table(spark, sf_dir, "events")
    hexed = F.lower(F.lpad(F.hex((F.lit(122192928000000000) + F.col("event_id") * 5000000).cast("long")), 15, "0"))
    uid = F.concat(F.substring(hexed, 8, 8), F.lit("-"), F.substring(hexed, 4, 4), F.lit("-1"), F.substring(hexed, 1, 3), F.lit("-8000-000000000000"))
    body = F.when(F.col("event_id") % 7 == 3, "{").otherwise(F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit(',"list":[1,"x"]}')))
    return rows.select((F.col("user_id") % 10).cast("string").alias("org_id"), F.col("event_type").alias("partition"), F.when(F.col("event_id") % 11 != 5, uid).alias("created_at"), body.alias("artifact_json"))


@query("""SELECT CAST(user_id % 10 AS VARCHAR) AS org_id, event_id AS n, event_type AS _partition, CASE WHEN event_id % 11 = 5 THEN 0.0 ELSE event_id / 2.0 END AS _created_at, event_id % 11 <> 5 AS has_uuid FROM events WHERE user_id % 10 IN (1, 3, 7) AND event_id % 7 <> 3""")
def s2_event_store(spark, sf_dir):
    events, path = _stored_events(spark, sf_dir), scratch_path(spark, "store")
    store.write_events(events, path)
    good, _ = store.read_events(spark, path, store.partition_index(events), ["1", "3", "7"])
    return good.select("org_id", F.try_variant_get("body", "$.n", "bigint").alias("n"), "_partition", "_created_at", F.col("_created_at_uuid").isNotNull().alias("has_uuid"))


_KIND_SQL = "['incidents', 'nodes', 'threat_hits', 'incident_summaries'][event_id % 4 + 1]"


@query(f"""SELECT {_KIND_SQL} AS kind, CAST(user_id % 10 AS VARCHAR) AS _org_id, event_id AS n, CASE WHEN event_id % 4 <> 2 THEN event_type END AS _partition, CASE WHEN event_id % 4 <> 2 THEN CASE WHEN event_id % 11 = 5 THEN 0.0 ELSE event_id / 2.0 END END AS _created_at,
 CASE WHEN event_id % 4 = 2 THEN concat('t', event_id) END AS _threat_id FROM events WHERE user_id % 10 IN (0, 2) AND event_id % 7 <> 3""")
def s3_object_store(spark, sf_dir):
    n = F.try_variant_get(F.try_parse_json("artifact_json"), "$.n", "bigint")
    kinds = F.array(*[F.lit(k) for k in store.KINDS])
    objects = _stored_events(spark, sf_dir).withColumn("at", n).withColumns({"kind": F.element_at(kinds, (F.coalesce("at", F.lit(0)) % 4 + 1).cast("int")), "id": F.concat(F.lit("t"), F.col("at").cast("string"))}).withColumnRenamed("artifact_json", "object")
    path = scratch_path(spark, "store")
    store.write_objects(objects, path)
    good, _ = store.read_objects(spark, path, ["0", "2"])
    return good.select("kind", "_org_id", F.try_variant_get("body", "$.n", "bigint").alias("n"), "_partition", "_created_at", "_threat_id")


@query(f"""SELECT count_if(regexp_matches(client_ip, '^{D.RFC1918}$')) AS n_private, count_if(regexp_matches(server_ip, '^{D.RFC1918}$')) AS n_server_private, count_if(regexp_matches(server_ip, '^{D.TEST_NET}$')) AS n_test, count_if(regexp_matches(client_ip, '^{D.LOOPBACK}$')) AS n_loop, message_type FROM v_artifact GROUP BY message_type""", "v_artifact")
def p5_ip_predicates(spark, sf_dir):
    a = V.artifacts(spark, sf_dir)
    c, s = F.col("client_ip"), F.col("server_ip")
    return a.groupBy("message_type").agg(F.count_if(D.is_private_ip(c)).alias("n_private"), F.count_if(D.is_private_ip(s)).alias("n_server_private"), F.count_if(D.is_test_net_ip(s)).alias("n_test"), F.count_if(D.is_loopback_ip(c)).alias("n_loop"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_matches('.' || regexp_extract(url, '^https?://([^/]+)', 1), '\\.example\\.(org|net)$') AS is_public FROM pages")
def p9_public_domain(spark, sf_dir):
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), D.public_domain(host, ["example.org", "example.net"]).alias("is_public"))


def _matches(column: str, **patterns):
    return [F.array_join(F.regexp_extract_all(F.col(column), F.lit(p), F.lit(0)), "|").alias(n) for n, p in patterns.items()]


@query(f"SELECT doc_id, array_to_string(regexp_extract_all(text, '{IPV4_SQL}'), '|') AS ipv4, array_to_string(regexp_extract_all(text, '{EMAIL_SQL}'), '|') AS email, array_to_string(regexp_extract_all(text, '{FQDN_SQL}'), '|') AS fqdn, array_to_string(regexp_extract_all(text, '{D.SID}'), '|') AS sid, array_to_string(regexp_extract_all(text, '{D.UUID}'), '|') AS uuid FROM documents")
def r_detectors_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *_matches("text", ipv4=D.IPV4, email=D.EMAIL, fqdn=D.FQDN, sid=D.SID, uuid=D.UUID))


@query(f"SELECT page_id, array_to_string(regexp_extract_all(html, '{IPV4_SQL}'), '|') AS ipv4, array_to_string(regexp_extract_all(html, '{EMAIL_SQL}'), '|') AS email, array_to_string(regexp_extract_all(html, '{FQDN_SQL}'), '|') AS fqdn FROM pages")
def r_detectors_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", *_matches("html", ipv4=D.IPV4, email=D.EMAIL, fqdn=D.FQDN))


@query("SELECT DISTINCT client_ip, printf('%02X%02X%02X%02X', CAST(split_part(client_ip, '.', 1) AS INT), CAST(split_part(client_ip, '.', 2) AS INT), CAST(split_part(client_ip, '.', 3) AS INT), CAST(split_part(client_ip, '.', 4) AS INT)) AS hexed, client_ip AS back FROM v_artifact", "v_artifact")
def f6_hex_addresses(spark, sf_dir):
    ip = V.artifacts(spark, sf_dir).select("client_ip").distinct().withColumn("hexed", D.ip_to_hex(F.col("client_ip")))
    return ip.withColumn("back", D.hex_to_ip(F.col("hexed")))


@query("""SELECT incident_id, CASE WHEN status_name = 'False Positive' THEN 0.3 ELSE least(0.95, greatest(0.6, suspicion)) END AS malicious, least(1.0, greatest(0.7, suspicion)) AS edge FROM v_incident""", "v_incident")
def f12_confidence(spark, sf_dir):
    i = V.incidents(spark, sf_dir)
    return i.select("incident_id", labels.confidence(F.lit("malicious"), F.col("suspicion"), F.lit(0), F.lit(0), F.col("status_name") == "False Positive").alias("malicious"), labels.edge_confidence(F.col("suspicion")).alias("edge"))


# ---- registry


def _candidates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text")
    return spans.spans(docs, "text", (("email", D.EMAIL, 0, 2), ("ipv4", D.IPV4, 0, 7)))


def _registry(spark, sf_dir):
    return registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), _candidates(spark, sf_dir), V.SECRET)


def _mac(value: str) -> str:
    key = V.SECRET.ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in key).hex() for p in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


def _private_sql(source: str) -> str:
    """(norm, token) of the private addresses of a source: four rounds of a keyed network, the next number, and back."""
    mixed = lambda half, turn: "(('0x' || " + _mac(f"blk || ':{turn}:' || {half}") + "[1:8])::BIGINT % side)"
    octet = lambda i: f"split_part(norm, '.', {i})::BIGINT"
    first = f"""SELECT norm, split_part(norm, '.', 1) AS blk, CASE split_part(norm, '.', 1) WHEN '10' THEN 4096 WHEN '172' THEN 1024 ELSE 256 END AS side, CASE split_part(norm, '.', 1) WHEN '10' THEN 167772160 WHEN '172' THEN 2886729728 ELSE 3232235520 END AS base,
 {octet(1)} * 16777216 + {octet(2)} * 65536 + {octet(3)} * 256 + {octet(4)} AS n FROM (SELECT DISTINCT norm FROM {source} WHERE category = 'ipv4_priv')"""
    steps = [first, "SELECT norm, blk, side, base, (n - base) // side AS l, (n - base) % side AS r FROM pv0"]
    for turn in range(4):
        steps.append(f"SELECT norm, blk, side, base, r AS l, xor(l, {mixed('r', turn)}) AS r FROM pv{len(steps) - 1}")
    steps.append(f"SELECT norm, blk, side, base, (m // side) AS l, m % side AS r FROM (SELECT *, (l * side + r + 1) % (side * side) AS m FROM pv{len(steps) - 1})")
    for turn in (3, 2, 1, 0):
        steps.append(f"SELECT norm, blk, side, base, xor(r, {mixed('l', turn)}) AS l, l AS r FROM pv{len(steps) - 1}")
    steps.append(f"SELECT norm, (m // 16777216) || '.' || (m // 65536 % 256) || '.' || (m // 256 % 256) || '.' || (m % 256) AS token FROM (SELECT norm, l * side + r + base AS m FROM pv{len(steps) - 1})")
    return ", ".join(f"pv{i} AS MATERIALIZED ({x})" for i, x in enumerate(steps)) + f", priv AS (SELECT * FROM pv{len(steps) - 1})"


_FORMS = {"username": "USER-%04d", "hostname": "HOST-%04d", "fqdn": "host-%04d.example.internal", "org": "ORG-%04d", "email": "user-%04d@example.net", "credential": "CRED-%04d"}


def _token_sql(category: str) -> str:
    if category == "ipv4_priv":
        return "(SELECT token FROM priv WHERE priv.norm = x.norm)"
    if category == "ipv4_pub":
        return "CASE WHEN seq <= 254 THEN '192.0.2.' || seq WHEN seq <= 508 THEN '198.51.100.' || (seq - 254) WHEN seq <= 762 THEN '203.0.113.' || (seq - 508) ELSE '100.' || (64 + (seq - 762) // 65536) || '.' || ((seq - 762) // 256 % 256) || '.' || ((seq - 762) % 256) END"
    return "CAST(100000000000 + seq AS VARCHAR)" if category == "aws_account" else f"printf('{_FORMS[category]}', seq)"


CTES["numbered"] = "numbered AS (SELECT category, norm, row_number() OVER (PARTITION BY category ORDER BY norm) AS seq FROM (SELECT DISTINCT category, lower(trim(value)) AS norm FROM candidates))"
CTES["numbered_private"] = _private_sql("numbered")


@query(f"SELECT category, norm, seq, CASE category WHEN 'email' THEN {_token_sql('email')} WHEN 'ipv4_pub' THEN {_token_sql('ipv4_pub')} ELSE {_token_sql('ipv4_priv')} END AS sanitized FROM numbered x", "candidates", "numbered", "numbered_private")
def z2_registry(spark, sf_dir):
    return _registry(spark, sf_dir).select("category", "norm", "seq", "sanitized")


def _drained(query) -> None:
    """Run a stream over all that is there, and end it."""
    query.trigger(availableNow=True).start().awaitTermination()


@query("SELECT DISTINCT category, norm, true AS own_token FROM numbered", "candidates", "numbered")
def t1_registry_stream(spark, sf_dir):
    path = scratch_path(spark, "stream")
    docs = streaming.read_stream(spark, sf_dir, "documents.parquet").select(F.col("doc_id").alias("record_id"), "text")
    _drained(streaming.registry_stream(spans.spans(docs, "text", (("email", D.EMAIL, 0, 2), ("ipv4", D.IPV4, 0, 7))), f"{path}/out", f"{path}/checkpoint", V.SECRET))
    grown = streaming.written(spark, f"{path}/out", registry.SCHEMA)
    once = grown.groupBy("sanitized").agg(F.count("*").alias("n"))
    return grown.join(once, "sanitized").select("category", "norm", (F.col("n") == 1).alias("own_token"))


@query("SELECT category, count(*) AS n FROM (SELECT DISTINCT category, lower(trim(value)) FROM candidates) GROUP BY ROLLUP (category)", "candidates")
def a2_registry_stats(spark, sf_dir):
    return registry.stats(_registry(spark, sf_dir))


@query("SELECT '10.' || (seq % 7) || '.0.1' AS sanitized, count(DISTINCT norm) AS n_originals FROM numbered GROUP BY 1 HAVING count(DISTINCT norm) > 1", "candidates", "numbered")
def v4_token_collisions(spark, sf_dir):
    """Collisions of the registry (it has none) and of one in which seven tokens are dealt out among all entries."""
    reg = saved(_registry(spark, sf_dir), "registry")
    dealt = reg.withColumn("sanitized", F.concat(F.lit("10."), (F.col("seq") % 7).cast("string"), F.lit(".0.1")))
    return registry.collisions(dealt).unionByName(registry.collisions(reg))


@query(f"SELECT client_ip, '10.' || ('0x' || h[1:2])::INT || '.' || ('0x' || h[3:4])::INT || '.' || greatest(1, ('0x' || h[5:6])::INT % 255) AS mapped FROM (SELECT client_ip, {_mac('client_ip')} AS h FROM (SELECT DISTINCT client_ip FROM v_artifact))", "v_artifact")
def f3_private_address(spark, sf_dir):
    return V.artifacts(spark, sf_dir).select("client_ip").distinct().select("client_ip", registry.private_ip_token(F.col("client_ip"), V.SECRET).alias("mapped"))


@query("""SELECT event_id + 1 AS seq, CASE WHEN event_id < 254 THEN '192.0.2.' || (event_id + 1) WHEN event_id < 508 THEN '198.51.100.' || (event_id - 253) WHEN event_id < 762 THEN '203.0.113.' || (event_id - 507)
 ELSE '100.' || (64 + (event_id - 761) // 65536) || '.' || ((event_id - 761) // 256 % 256) || '.' || ((event_id - 761) % 256) END AS mapped FROM events""")
def f4_public_address(spark, sf_dir):
    return table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("seq")).withColumn("mapped", registry.public_ip_token(F.col("seq")))


# ---- text rewriting


def _sanitized(spark, sf_dir):
    """The documents with tokens in place of their values, and the registry; places and registry are written once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = saved(_candidates(spark, sf_dir), "found")
    reg = saved(registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), found, V.SECRET), "registry")
    return sweep.spliced(docs, registry.resolve(found, reg), "text", "doc_id"), reg


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{D.EMAIL}')) AS n_email, doc_id NOT IN (SELECT doc_id FROM candidates) AS same FROM documents", "candidates")
def z13_sanitize_documents(spark, sf_dir):
    out = _sanitized(spark, sf_dir)[0].join(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw")), "doc_id")
    return out.select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"user-\d{4,}@example\.net"), F.lit(0))).cast("long").alias("n_email"), (F.col("n_replaced") == 0).alias("same"))


def _words(spark, sf_dir):
    """Words of the benchmark of four letters or more."""
    return table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter(F.length("word") >= 4).distinct()


CTES["words"] = "words AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE length(w) >= 4)"


@query("""SELECT d.doc_id, count(*) AS n_words FROM (SELECT doc_id, lower(text) AS low FROM documents) d JOIN words ON contains(low, w) GROUP BY 1""", "words")
def j12_contains_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text")
    return contains.entry_counts(docs, "text", _words(spark, sf_dir), "word").withColumnRenamed("record_id", "doc_id")


@query("""SELECT doc_id, n_replaced, sha256(out) AS text_sha256 FROM (SELECT doc_id, len(found) AS n_replaced, array_to_string(list_transform(list_zip(parts, found), lambda p: concat(p[1], CASE WHEN p[2] IS NOT NULL THEN printf('HOST-%04d', list_position(names, lower(p[2]))) END)), '') AS out
 FROM (SELECT doc_id, regexp_extract_all(text, pattern) AS found, regexp_split_to_array(text, pattern) AS parts, names FROM documents CROSS JOIN (SELECT '(?i)' || string_agg(w, '|' ORDER BY length(w) DESC, w) AS pattern, list(w ORDER BY w) AS names FROM words)))""", "words")
def z14_dictionary_sweep(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = _words(spark, sf_dir).select(F.lit("hostname").alias("category"), F.col("word").alias("value"), F.lit(0).alias("record_id"), F.lit(0).alias("start"))
    reg = registry.grow_registry(spark.createDataFrame([], registry.SCHEMA), known, V.SECRET)
    return sweep.swept(docs, reg, "text", "doc_id").select("doc_id", "n_replaced", F.sha2("text", 256).alias("text_sha256"))


@query("SELECT event_id, format FROM v_logs", "v_logs")
def z4_message_format(spark, sf_dir):
    return V.logs(spark, sf_dir).select("event_id", formats.message_format(F.col("message"), F.col("stream"), F.col("message_type"), F.col("pipeline")).alias("format"))


def _sanitized_logs(spark, sf_dir, form: int | None = None):
    """Messages of one format, or of all, with tokens from a registry of their own values."""
    logs = V.logs(spark, sf_dir)
    logs = logs if form is None else logs.filter(F.col("format") == V.FORMATS[form])
    raw = records.Sanitized.messages(spread(logs.select("event_id", "message", "stream", "message_type", "pipeline")), "message", "stream", "message_type", "pipeline")
    return raw.published(raw.grown(spark.createDataFrame([], registry.SCHEMA), V.SECRET), sweep=False).select("event_id", "message")


def _uses(form: int) -> list[str]:
    return [name for name in V.VALUES if f"«{name}»" in V.TEMPLATES[form]]


def _tokens_sql(source: str, uses: dict[str, str]) -> str:
    """(category, norm, token) of the values that the condition of each use admits."""
    values = " UNION ".join(f"SELECT '{V.VALUES[v]}' AS category, lower({v}) AS norm FROM {source} WHERE {where}" for v, where in uses.items())
    token = "CASE category " + " ".join(f"WHEN '{c}' THEN {_token_sql(c)}" for c in sorted({V.VALUES[v] for v in uses})) + " END"
    private = _private_sql("vals") + ", " if any(V.VALUES[v] == "ipv4_priv" for v in uses) else ""
    return f"vals AS MATERIALIZED (SELECT category, norm, row_number() OVER (PARTITION BY category ORDER BY norm) AS seq FROM ({values})), {private}tok AS MATERIALIZED (SELECT category, norm, {token} AS token FROM vals x)"


def _rewritten_sql(template: str, source: str, where: str, key: str = "event_id") -> str:
    names = [v for v in V.VALUES if f"«{v}»" in template]
    joins = " ".join(f"LEFT JOIN tok t_{v} ON t_{v}.category = '{V.VALUES[v]}' AND t_{v}.norm = lower({v})" for v in names)
    return f"SELECT {key}, {V.text_sql(template, {v: f't_{v}.token' for v in names})} AS message FROM {source} {joins} WHERE {where}"


def _format_query(name: str, form: int | None) -> None:
    def run(spark, sf_dir):
        return _sanitized_logs(spark, sf_dir, form)

    run.__name__ = name
    forms = range(9) if form is None else [form]
    CTES[f"tok{name}"] = _tokens_sql("v_logs", {v: f"event_id % 9 IN ({', '.join(str(i) for i in forms if v in _uses(i))})" for v in V.VALUES if any(v in _uses(i) for i in forms)})
    query(" UNION ALL ".join(_rewritten_sql(V.TEMPLATES[i], "v_logs", f"event_id % 9 = {i}") for i in forms), "v_logs", f"tok{name}")(run)


for _name, _form in (("z5_firewall_spans", 0), ("z6_windows_xml_spans", 1), ("z7_agent_json_spans", 2), ("z8_cloud_audit_spans", 3), ("z9_dns_spans", 4), ("z10_hypervisor_spans", 5), ("z11_csv_firewall_spans", 6), ("z12_generic_spans", 8), ("z13_sanitize_messages", None)):
    _format_query(_name, _form)


_FIELD_USES = {v: "true" for v in ("cip", "usr", "org", "fqn", "hst", "mail")}
CTES["tokfields"] = _tokens_sql("v_logs", _FIELD_USES)
_KEPT = V.RECORD.replace("allow «usr»", "allow ¤").replace('"orgId":7', '"orgId":10001')
_FIELD_SQL = _rewritten_sql(_KEPT, "v_logs", "true").replace("'\",\"action\":\"allow ¤", "'\",\"action\":\"allow ' || usr || '")


@query(_FIELD_SQL, "v_logs", "tokfields")
def z3_sanitize_fields(spark, sf_dir):
    raw = records.Sanitized.records(spread(V.logs(spark, sf_dir).select("event_id", F.col("record").alias("message"))), "message")
    return raw.published(raw.grown(spark.createDataFrame([], registry.SCHEMA), V.SECRET), sweep=False).select("event_id", "message")


_RAW_USES = {v: "true" if v in ("cip", "usr", "org", "fqn", "hst", "mail") else f"event_id % 9 IN ({', '.join(str(i) for i in range(9) if v in _uses(i))})" for v in V.VALUES}
CTES["tokraw"] = _tokens_sql("v_raw", _RAW_USES)


def _raw_sql() -> str:
    """Every record with tokens at every place but those of kept short values and of guarded fields."""
    joins = " ".join(f"LEFT JOIN tok t_{v} ON t_{v}.category = '{V.VALUES[v]}' AND t_{v}.norm = lower({v})" for v in V.VALUES)
    new = {v: f"t_{v}.token" for v in V.VALUES}
    message = "CASE event_id % 9 " + " ".join(f"WHEN {i} THEN {V.text_sql(t, new)}" for i, t in enumerate(V.TEMPLATES)) + " END"
    body = V.text_sql(V.RAW.replace("«usr!»", "«old»").replace("«fqn!»", "«fqn_old»").replace('"orgId":7', '"orgId":10001'), {**new, "old": "usr", "fqn_old": "fqn", "stream": "stream", "kind": "message_type", "pipe": "pipeline", "msg": V.escaped_sql(message)})
    return f"SELECT event_id, {body} AS body FROM v_raw {joins}"


def _raw_records(spark, sf_dir):
    """Whole records. The events are dealt out before their records are made, which are thirty times as wide, in more parts
    than there are cores, so that none of these waits for one long part."""
    events = table(spark, sf_dir, "events")
    return V.raw_records(spark, sf_dir, events.repartition(4 * spark.sparkContext.defaultParallelism)).select("event_id", "body")


@query(_raw_sql(), "v_raw", "tokraw")
def z1_sanitize_records(spark, sf_dir):
    raw = records.Sanitized.records(_raw_records(spark, sf_dir), "body")
    return raw.published(raw.grown(spark.createDataFrame([], registry.SCHEMA), V.SECRET)).select("event_id", "body")


@query(_raw_sql(), "v_raw", "tokraw")
def z17_resanitize_records(spark, sf_dir):
    """Published under a registry without user names and private addresses, then brought to the whole registry by making
    the records anew that hold one of them."""
    raw = records.Sanitized.records(_raw_records(spark, sf_dir), "body")
    grown = raw.grown(spark.createDataFrame([], registry.SCHEMA), V.SECRET)
    some = grown.filter(~F.col("category").isin("username", "ipv4_priv"))
    earlier = saved(raw.published(some), "published")
    return raw.republished(earlier, some, grown).select("event_id", "body")


@query("SELECT count_if(m = 0) AS incident, count_if(m = 1 OR m = 4) AS artifact, count_if(m = 2) AS other, count_if(m = 3 AND event_id % 2 = 0) AS quarantine, count(*) - count_if(m = 3) AS records FROM (SELECT event_id, event_id % 5 AS m FROM events)")
def a15_run_statistics(spark, sf_dir):
    """Raw lines of three kinds, some of them malformed or blank: statistics of the run that writes them."""
    m = F.col("event_id") % 5
    line = F.when(m == 0, '{"nodes":{},"edges":{},"messageType":"x"}').when(m == 1, F.concat(F.lit('{"messageType":"'), "event_type", F.lit('"}'))).when(m == 2, '{"nodes":{}}').when(m == 4, '{"messagetype":"y","n":1}').when(F.col("event_id") % 2 == 0, '{"a":').otherwise("  ")
    parts = sinks.publish_records(table(spark, sf_dir, "events").select(line.alias("value")), scratch_path(spark, "published"))
    found = {**parts["records"], "quarantine": parts["quarantine"]["rows"]}
    return spark.createDataFrame([tuple(found[k] for k in ("incident", "artifact", "other", "quarantine", "rows"))], "incident long, artifact long, other long, quarantine long, records long")


@query("SELECT event_id, path, value FROM v_logs CROSS JOIN LATERAL (VALUES ('$.clientIP', cip), ('$.userName', usr), ('$.organization', org), ('$.serverHostname', fqn), ('$.action', 'allow ' || usr), ('$.nested.peer_host', hst), ('$.nested.note', 'plain text'), ('$.nested.contact', mail)) x(path, value)", "v_logs")
def p3_string_leaves(spark, sf_dir):
    rows = V.logs(spark, sf_dir).select("event_id", F.parse_json("record").alias("body"))
    return fields.string_leaves(rows, "body", "event_id").select(F.col("record_id").alias("event_id"), "path", "value")


_TERMS_SQL = ", ".join(f"'{t}'" for t in allowlists.TERMS)
_DOMAINS_SQL = "|".join(d.replace(".", "\\.") for d in allowlists.PUBLIC_DOMAINS)


@query(f"SELECT word, word IN ({_TERMS_SQL}) OR regexp_matches(word, '(^|\\.)(?:{_DOMAINS_SQL})$') AS allowed FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z0-9.]+')) AS word FROM documents) WHERE word <> '' AND length(word) <= 60")
def p8_allowed_terms(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z0-9.]+"))).alias("word")).filter("word <> '' AND length(word) <= 60").distinct()
    return words.select("word", allowlists.is_allowed(F.col("word")).alias("allowed"))


# ---- labels

_ROLE_LIST = lambda src, key: f"(SELECT {key}, list(role ORDER BY ord) AS set_roles, count(*) AS n_roles FROM {src} GROUP BY 1)"


@query(f"""SELECT a.event_id, CASE WHEN n_rules > 0 THEN 'suspicious' ELSE 'benign' END AS label_binary, CASE WHEN n_rules > 0 THEN least(0.85, greatest(0.5, (40 + 10 * n_rules + 5 * coalesce(n_roles, 0)) / 100.0)) ELSE 0.5 END AS label_confidence,
 coalesce(array_to_string(set_roles, '|'), '') AS set_roles, coalesce(tactics, '') AS attack_tactics, coalesce(nullif(st.product_name, ''), rp, '') AS product_name, CASE WHEN n_rules > 0 THEN coalesce(stage, 'unknown') ELSE 'none' END AS lifecycle_stage
 FROM v_artifact a LEFT JOIN (SELECT event_id, count(*) AS n_rules, arg_min(p.product_name, pos) AS rp FROM hits JOIN products p USING (product_id) GROUP BY 1) h USING (event_id)
 LEFT JOIN {_ROLE_LIST('roles', 'event_id')} r USING (event_id) LEFT JOIN (SELECT event_id, string_agg(DISTINCT val, '|' ORDER BY val) AS tactics FROM roles JOIN role_tactics ON name = role GROUP BY 1) t USING (event_id)
 LEFT JOIN (SELECT event_id, arg_min(val, ord) AS stage FROM roles JOIN role_stage ON name = role GROUP BY 1) g USING (event_id) LEFT JOIN streams st ON lower(st.stream) = lower(a.stream)""", "v_artifact", "rules", "sets", "products", "streams", "hits", "roles", "role_tactics", "role_stage")
def l3_label_events(spark, sf_dir):
    out = labels.label_events(V.artifacts(spark, sf_dir), *V.catalog(spark))
    return out.select("event_id", "label_binary", "label_confidence", F.array_join("set_roles", "|").alias("set_roles"), F.array_join("attack_tactics", "|").alias("attack_tactics"), "product_name", "lifecycle_stage")


@query(f"""SELECT i.incident_id, coalesce(array_to_string(set_roles, '|'), '') AS set_roles, coalesce(tac, '') AS attack_tactics, coalesce(tec, '') AS attack_techniques, coalesce(ms.val, stage, 'unknown') AS lifecycle_stage, coalesce(sm.val, 'unknown') AS disposition_category, i.status_name = 'False Positive' AS is_false_positive
 FROM v_incident i LEFT JOIN {_ROLE_LIST('node_roles', 'incident_id')} r USING (incident_id)
 LEFT JOIN (SELECT incident_id, string_agg(DISTINCT val, '|' ORDER BY val) AS tac FROM (SELECT incident_id, val FROM node_roles JOIN role_tactics ON name = role UNION ALL SELECT incident_id, val FROM v_incident JOIN mo_tactics ON name = mo_name) GROUP BY 1) t USING (incident_id)
 LEFT JOIN (SELECT incident_id, string_agg(DISTINCT val, '|' ORDER BY val) AS tec FROM (SELECT incident_id, val FROM node_roles JOIN role_techniques ON name = role UNION ALL SELECT incident_id, val FROM v_incident JOIN mo_techniques ON name = mo_name) GROUP BY 1) u USING (incident_id)
 LEFT JOIN mo_stage ms ON ms.name = i.mo_name LEFT JOIN (SELECT incident_id, arg_min(val, ord) AS stage FROM node_roles JOIN role_stage ON name = role GROUP BY 1) g USING (incident_id) LEFT JOIN status_map sm ON sm.name = i.status_name""",
 "v_incident", "v_node", "node_roles", "role_tactics", "role_techniques", "mo_tactics", "mo_techniques", "mo_stage", "role_stage", "status_map")
def l1_incident_labels(spark, sf_dir):
    out = labels.incident_labels(V.incidents(spark, sf_dir), V.nodes(spark, sf_dir))
    join = lambda c: F.array_join(c, "|").alias(c)
    return out.select("incident_id", join("set_roles"), join("attack_tactics"), join("attack_techniques"), "lifecycle_stage", "disposition_category", "is_false_positive")


@query(ORACLES["l3_label_events"])
def t1_label_stream(spark, sf_dir):
    path = scratch_path(spark, "stream")
    _drained(streaming.label_stream(V.artifacts(spark, sf_dir, streaming.read_stream(spark, sf_dir, "events.parquet")), *V.catalog(spark), f"{path}/out", f"{path}/checkpoint"))
    out = spark.read.parquet(f"{path}/out")
    return out.select("event_id", "label_binary", "label_confidence", F.array_join("set_roles", "|").alias("set_roles"), F.array_join("attack_tactics", "|").alias("attack_tactics"), "product_name", "lifecycle_stage")


_FIRST = "(SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY incident_id, pos) AS rn FROM v_lead WHERE has_artifact)"


@query(f"SELECT lead_id, incident_id, pos, product_name FROM {_FIRST} WHERE rn = 1", "v_lead")
def w2_first_leads(spark, sf_dir):
    return labels.first_leads(V.leads(spark, sf_dir)).select("lead_id", "incident_id", "pos", "product_name")


@query(f"SELECT lead_id, incident_id, pos, product_name FROM {_FIRST} WHERE rn = 1", "v_lead")
def t2_first_leads_stream(spark, sf_dir):
    path = scratch_path(spark, "stream")
    leads = V.leads(spark, sf_dir, streaming.read_stream(spark, sf_dir, "lineitem.parquet")).select("lead_id", "incident_id", "pos", "product_name", "has_artifact")
    _drained(streaming.first_leads_stream(leads, f"{path}/out", f"{path}/checkpoint"))
    return streaming.first_leads_written(spark, f"{path}/out", "lead_id long, incident_id string, pos long, product_name string")


@query(f"SELECT lead_id, l.incident_id, mo_name, CASE WHEN status_name = 'False Positive' THEN 0.3 ELSE least(0.95, greatest(0.6, suspicion)) END AS label_confidence, status_name AS disposition FROM {_FIRST} l JOIN v_incident i USING (incident_id) WHERE rn = 1", "v_lead", "v_incident")
def l2_lead_events(spark, sf_dir):
    own = labels.incident_labels(V.incidents(spark, sf_dir), V.nodes(spark, sf_dir))
    return labels.lead_events(V.leads(spark, sf_dir), own).select("lead_id", "incident_id", "mo_name", "label_confidence", "disposition")


def _all_events(spark, sf_dir):
    own = labels.incident_labels(V.incidents(spark, sf_dir), V.nodes(spark, sf_dir))
    return labels.all_events(labels.label_events(V.artifacts(spark, sf_dir), *V.catalog(spark)), labels.lead_events(V.leads(spark, sf_dir), own))


@query("""SELECT label, n, round(100.0 * n / sum(n) OVER (), 2) AS percent FROM (SELECT 'malicious' AS label, count(DISTINCT lead_id) AS n FROM v_lead WHERE has_artifact
 UNION ALL SELECT CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END, count(*) FROM v_artifact GROUP BY 1)""", "v_lead", "v_artifact")
def a4_label_distribution(spark, sf_dir):
    return verify.label_distribution(_all_events(spark, sf_dir))


@query("SELECT lang, source, nth, doc_id, CAST(floor((nth - 1) / 5) AS BIGINT) AS batch FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS nth, count(*) OVER (PARTITION BY lang, source) AS n FROM documents) WHERE nth <= greatest(1, floor(n * 0.1))")
def w4_stratified_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return labels.stratified(docs, ["lang", "source"], 0.1, "doc_id").withColumn("nth", F.col("nth").cast("long"))


# ---- graph, reports, audits


def _edges(spark, sf_dir):
    return graph.event_edges(labels.label_events(V.artifacts(spark, sf_dir), *V.catalog(spark)))


@query("""SELECT node_id, node_type, ip, host FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY event_id, place) AS rn FROM (
 SELECT event_id, 0 AS place, client_ip AS node_id, 'HOST' AS node_type, client_ip AS ip, client_host AS host FROM v_artifact UNION ALL SELECT event_id, 1, server_ip, 'HOST', server_ip, server_host FROM v_artifact
 UNION ALL SELECT event_id, 2, 'user:' || username, 'CREDENTIAL', '', '' FROM v_artifact)) WHERE rn = 1""", "v_artifact")
def g1_event_nodes(spark, sf_dir):
    return graph.event_nodes(V.artifacts(spark, sf_dir))


@query(f"""SELECT a.event_id, client_ip AS src, server_ip AS dst, coalesce(m.val, 'EVENT') AS edge_type, epoch, a.stream, CASE WHEN n_rules > 0 THEN 'suspicious' ELSE 'benign' END AS label_binary,
 CASE WHEN n_rules > 0 THEN least(0.85, greatest(0.5, (40 + 10 * n_rules + 5 * coalesce(n_roles, 0)) / 100.0)) ELSE 0.5 END AS label_confidence, coalesce(array_to_string(set_roles, '|'), '') AS set_roles, coalesce(tec, '') AS attack_techniques, coalesce(tac, '') AS attack_tactics,
 CASE WHEN n_rules > 0 THEN coalesce(stage, 'unknown') ELSE 'none' END AS lifecycle_stage FROM v_artifact a LEFT JOIN edge_map m ON m.name = message_type LEFT JOIN (SELECT event_id, count(*) AS n_rules FROM hits GROUP BY 1) h USING (event_id)
 LEFT JOIN {_ROLE_LIST('roles', 'event_id')} r USING (event_id) LEFT JOIN (SELECT event_id, string_agg(DISTINCT val, '|' ORDER BY val) AS tac FROM roles JOIN role_tactics ON name = role GROUP BY 1) t USING (event_id)
 LEFT JOIN (SELECT event_id, string_agg(val, '|' ORDER BY seen) AS tec FROM (SELECT event_id, val, min(ord * 100 + pos) AS seen FROM roles JOIN role_techniques ON name = role GROUP BY 1, 2) GROUP BY 1) u USING (event_id)
 LEFT JOIN (SELECT event_id, arg_min(val, ord) AS stage FROM roles JOIN role_stage ON name = role GROUP BY 1) g USING (event_id)""", "v_artifact", "rules", "sets", "hits", "roles", "role_tactics", "role_techniques", "role_stage", "edge_map")
def g3_event_edges(spark, sf_dir):
    edges = _edges(spark, sf_dir).drop("message_type")
    return edges.withColumns({c: F.array_join(c, "|") for c in ("set_roles", "attack_techniques", "attack_tactics")})


@query("SELECT event_id, printf('e-%08d', row_number() OVER (ORDER BY event_id) - 1) AS edge_id FROM v_artifact", "v_artifact")
def k6_edge_ids(spark, sf_dir):
    return graph.numbered(_edges(spark, sf_dir), ["event_id"]).select("event_id", "edge_id")


@query("SELECT client_ip AS src, server_ip AS dst, count(*) AS n_edges, arg_max(message_type, event_id) FILTER (message_type <> '') AS message_type, arg_max(CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END, event_id) AS label_binary FROM v_artifact GROUP BY 1, 2", "v_artifact")
def g8_simple_digraph(spark, sf_dir):
    return graph.simple_digraph(_edges(spark, sf_dir), ["message_type", "label_binary"], "event_id")


@query("SELECT 'label_binary' AS name, CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END AS value, count(*) AS n FROM v_artifact GROUP BY 2 UNION ALL SELECT 'edge_type', coalesce(m.val, 'EVENT'), count(*) FROM v_artifact LEFT JOIN edge_map m ON m.name = message_type GROUP BY 2", "v_artifact", "edge_map")
def k11_graph_distributions(spark, sf_dir):
    return graph.distributions(_edges(spark, sf_dir), ["label_binary", "edge_type"])


@query(f"""SELECT doc_id AS row_key, ip FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS doc_id, unnest(regexp_extract_all(text, '{D.IPV4}')) AS ip FROM documents) WHERE NOT regexp_matches(ip, '^(?:{D.RFC1918}|{D.LOOPBACK}|{D.TEST_NET}|{D.SHARED_NET}|0\\.0\\.0\\.0|255\\.255\\.255\\.255)$')""")
def v3_public_addresses(spark, sf_dir):
    cells = verify.string_cells(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return verify.public_addresses(cells).select("row_key", "ip")


@query("""SELECT CAST(doc_id AS VARCHAR) AS row_key, norm AS word FROM documents JOIN (SELECT DISTINCT lower(trim(value)) AS norm FROM candidates WHERE category = 'email') ON doc_id % 10 = 0 AND contains(lower(text), norm)""", "mail_candidates")
def v1_registry_leaks(spark, sf_dir):
    """Values of the registry that a table still holds of which every tenth document was left as it was: e-mail addresses
    there (addresses of the network are judged in v1_address_leaks)."""
    left = F.col("doc_id") % 10 == 0
    raw = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw")).filter(left)
    clean, reg = _sanitized(spark, sf_dir)
    mixed = clean.join(raw, "doc_id", "left").select("doc_id", F.when(left, F.col("raw")).otherwise(F.col("text")).alias("text"))
    cells = saved(verify.string_cells(mixed, "doc_id"), "cells")
    allowed = spark.createDataFrame([("localhost",)], "term string")
    found = verify.leaks(cells, reg.filter(F.col("norm").contains("@")), allowed)
    return found.filter(F.col("word").contains("@")).select("row_key", "word").distinct()


@query(f"""SELECT DISTINCT CAST(doc_id AS VARCHAR) AS row_key, ip AS word FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{D.IPV4}')) AS ip FROM documents) WHERE ip IN (SELECT value FROM candidates WHERE category LIKE 'ipv4%')""", "candidates")
def v1_address_leaks(spark, sf_dir):
    """Addresses of the registry in raw documents, each where it stands as a whole address."""
    cells = verify.string_cells(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    found = verify.leaks(cells, _registry(spark, sf_dir).filter("category LIKE 'ipv4%'"), spark.createDataFrame([], "term string"))
    return found.select("row_key", "word").distinct()


@query("SELECT CAST(doc_id AS VARCHAR) AS row_key FROM documents WHERE regexp_matches(text, '(?i)\\b[\\w.-]*(?:example\\.com)\\b')")
def v2_domain_pattern(spark, sf_dir):
    cells = verify.string_cells(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return verify.pattern_hits(cells, [D.customer_domains(["example.com"])]).select("row_key").distinct()


# ---- nested incidents, their graph and their reports

_SHAPES = "CASE k % 3 WHEN 0 THEN ['Bot'] WHEN 1 THEN ['" + V.ROLES[1] + "', '" + V.ROLES[2] + "'] ELSE ['C2 Server'] END"
CTES["case_roles"] = f"""case_roles AS (SELECT id, role, min(ord) AS ord FROM (SELECT id, unnest({_SHAPES}) AS role, unnest(range(3)) AS ord FROM v_case UNION ALL SELECT id, role, 10 + s FROM v_case JOIN v_part USING (k)) WHERE role IS NOT NULL GROUP BY 1, 2)"""
CTES["case_techs"] = """case_techs AS (SELECT DISTINCT id, unnest(CASE s % 4 WHEN 0 THEN ['T1059', 'T1071.001'] WHEN 1 THEN ['T1003'] ELSE [] END) AS val FROM v_case JOIN v_part USING (k))"""
_MAPS = ("role_tactics", "role_techniques", "mo_tactics", "mo_techniques", "mo_stage", "role_stage", "status_map")
_NESTED = ("v_case", "v_part", "case_roles", "case_techs", *_MAPS)
_STAGE = "LEFT JOIN mo_stage ms ON ms.name = i.mo_name LEFT JOIN (SELECT id, arg_min(val, ord) AS stage FROM case_roles JOIN role_stage ON name = role GROUP BY 1) g USING (id)"
_ROLES_OF = "LEFT JOIN (SELECT id, list(role ORDER BY ord) AS roles FROM case_roles GROUP BY 1) r USING (id)"
CTES["case_labels"] = f"""case_labels AS (SELECT i.*, array_to_string(roles, '|') AS set_roles, len(roles) AS n_roles, coalesce(tac, '') AS attack_tactics, coalesce(tec, '') AS attack_techniques, coalesce(def, '') AS defense_techniques, coalesce(nullif(ms.val, 'unknown'), stage, 'unknown') AS lifecycle_stage, coalesce(sm.val, 'automated') AS disposition_category
 FROM v_case i {_ROLES_OF}
 LEFT JOIN (SELECT id, string_agg(DISTINCT val, '|' ORDER BY val) AS tac FROM (SELECT id, val FROM case_roles JOIN role_tactics ON name = role UNION ALL SELECT id, val FROM v_case JOIN mo_tactics ON name = mo_name) GROUP BY 1) t USING (id)
 LEFT JOIN (SELECT id, string_agg(DISTINCT val, '|' ORDER BY val) AS tec FROM (SELECT id, val FROM case_roles JOIN role_techniques ON name = role UNION ALL SELECT id, val FROM v_case JOIN mo_techniques ON name = mo_name UNION ALL SELECT id, val FROM case_techs) GROUP BY 1) u USING (id)
 LEFT JOIN (SELECT id, max('D3-NI') AS def FROM v_case JOIN v_part USING (k) WHERE s % 4 = 2 GROUP BY 1) d USING (id) {_STAGE} LEFT JOIN status_map sm ON sm.name = i.status_name)"""
_bar = lambda c: F.array_join(c, "|").alias(c)


def _sets(spark):
    return V.catalog(spark)[1]


def _labelled_cases(spark, sf_dir):
    return incidents.incident_labels(V.cases(spark, sf_dir), _sets(spark))


@query("SELECT id, set_roles, attack_tactics, attack_techniques, defense_techniques, lifecycle_stage, disposition_category, status_name = 'False Positive' AS is_false_positive FROM case_labels", *_NESTED, "case_labels")
def l1_nested_incident_labels(spark, sf_dir):
    return _labelled_cases(spark, sf_dir).select("id", _bar("set_roles"), _bar("attack_tactics"), _bar("attack_techniques"), _bar("defense_techniques"), "lifecycle_stage", "disposition_category", "is_false_positive")


@query("""SELECT CAST(lead_id AS VARCHAR) AS lead_id, id AS incident_id, observed_at, CASE WHEN status_name = 'False Positive' THEN 0.3 ELSE least(0.95, greatest(0.6, suspicion_score)) END AS label_confidence FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY id, nth) AS rn FROM (
 SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY id, lead_id ORDER BY pos) AS copy FROM v_case JOIN v_part USING (k)) WHERE copy = 1) WHERE pos % 7 <> 3) WHERE rn = 1""", "v_case", "v_part")
def l2_nested_leads(spark, sf_dir):
    return incidents.incident_leads(_labelled_cases(spark, sf_dir)).select("lead_id", "incident_id", "observed_at", "label_confidence")


@query("""SELECT DISTINCT id AS incident_id, 'supp:' || s AS node_id, 'HOST' AS node_type, '10.9.' || (s % 250) || '.7' AS ip, 'supp' || s AS host, role AS set_roles, 'product ' || (s % 7) AS products, s % 10 / 10 AS suspicion_score, s % 2 = 0 AS internal, false AS managed FROM v_case JOIN v_part USING (k)""", "v_case", "v_part")
def g4_incident_nodes(spark, sf_dir):
    return incidents.incident_nodes(V.cases(spark, sf_dir)).select("incident_id", "node_id", "node_type", "ip", "host", _bar("set_roles"), _bar("products"), "suspicion_score", "internal", "managed")


_LINKS = "(SELECT c.*, p.pos, p.s, p.flag, p.bytes, CASE WHEN p.pos % 5 = 0 THEN 'cust:?' ELSE 'supp:' || min(p.s) OVER (PARTITION BY k) END AS src, 'supp:' || p.s AS dst, min(p.observed_at) OVER (PARTITION BY k) AS began FROM case_labels c JOIN v_part p USING (k))"


@query(f"SELECT id AS incident_id, CAST(pos AS VARCHAR) AS edge_key, src, dst, began AS timestamp, flag AS edge_subtype, bytes, least(1.0, greatest(0.7, suspicion_score)) AS label_confidence, set_roles, attack_tactics, lifecycle_stage FROM {_LINKS}", *_NESTED, "case_labels")
def g5_incident_edges(spark, sf_dir):
    return incidents.incident_edges(_labelled_cases(spark, sf_dir)).select("incident_id", "edge_key", "src", "dst", "timestamp", "edge_subtype", "bytes", "label_confidence", _bar("set_roles"), _bar("attack_tactics"), "lifecycle_stage")


def _graph(spark, sf_dir):
    return graph.build_graph(labels.label_events(V.artifacts(spark, sf_dir), *V.catalog(spark)), _labelled_cases(spark, sf_dir))


@query("""SELECT node_type, count(*) AS n, CAST(sum(CASE WHEN ip <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_ip FROM (SELECT DISTINCT client_ip AS id, 'HOST' AS node_type, client_ip AS ip FROM v_artifact UNION SELECT server_ip, 'HOST', server_ip FROM v_artifact UNION SELECT 'user:' || username, 'CREDENTIAL', '' FROM v_artifact UNION SELECT DISTINCT 'supp:' || s, 'HOST', '10.9.7' FROM v_part) GROUP BY 1""", "v_artifact", "v_part")
def g6_graph_nodes(spark, sf_dir):
    nodes, _ = _graph(spark, sf_dir)
    return nodes.groupBy("node_type").agg(F.count("*").alias("n"), F.count_if(F.col("ip") != "").alias("n_ip"))


@query(f"SELECT edge_type, n FROM (SELECT coalesce(m.val, 'EVENT') AS edge_type, count(*) AS n FROM v_artifact LEFT JOIN edge_map m ON m.name = message_type GROUP BY 1 UNION ALL SELECT 'INCIDENT_LINK', count(*) FROM {_LINKS} WHERE src <> 'cust:?')", "v_artifact", "edge_map", *_NESTED, "case_labels")
def j15_known_ends(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.known_ends(edges, nodes).groupBy("edge_type").agg(F.count("*").alias("n"))


_XML = lambda key, value: f"chr(10) || '      <data key=\"{key}\">' || {value} || '</data>'"


@query(f"""SELECT n + 1 AS place, '    <edge id="e' || (n + 1) || '" source="' || client_ip || '" target="' || server_ip || '">' || {_XML('e_type', 'kind')} || {_XML('e_message_type', 'message_type')} || {_XML('e_stream', 'stream')} || {_XML('e_label_binary', "CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END")} || chr(10) || '    </edge>' AS line
 FROM (SELECT a.*, coalesce(m.val, 'EVENT') AS kind, row_number() OVER (ORDER BY event_id) - 1 AS n FROM v_artifact a LEFT JOIN edge_map m ON m.name = message_type)""", "v_artifact", "edge_map")
def k7_graphml_edges(spark, sf_dir):
    edges = _edges(spark, sf_dir).select("event_id", "src", "dst", "edge_type", "message_type", "stream", "label_binary")
    return graph.graphml(graph.event_nodes(V.artifacts(spark, sf_dir)), edges, ["event_id"]).filter("section = 2").select("place", "line")


@query(f"""SELECT id AS incident_id, CAST((SELECT count(*) FROM (SELECT DISTINCT s FROM v_part p WHERE p.k = c.k)) AS BIGINT) AS n_nodes, CAST((SELECT count(*) FROM v_part p WHERE p.k = c.k) AS BIGINT) AS n_edges, (SELECT '    <node id="supp:' || min(s) || '">' || {_XML('n_type', "'HOST'")} || {_XML('n_ip', "'10.9.' || (min(s) % 250) || '.7'")} || {_XML('n_hostname', "'supp' || min(s)")} || {_XML('n_set_roles', "'[&quot;' || arg_min(role, s) || '&quot;]'")} FROM v_part p WHERE p.k = c.k) AS first_node FROM v_case c""", "v_case", "v_part")
def k8_incident_graphml(spark, sf_dir):
    docs = graph.incident_graphml(_labelled_cases(spark, sf_dir))
    times = lambda what: F.size(F.split("graphml", what)).cast("long") - 1
    first = F.nullif(F.regexp_extract("graphml", '(?s)(    <node id=.*?n_set_roles">[^<]*</data>)', 1), F.lit(""))
    return docs.select("incident_id", times("<node id=").alias("n_nodes"), times("<edge id=").alias("n_edges"), first.alias("first_node"))


@query("SELECT 'link' AS section, '{\"source\":\"' || client_ip || '\",\"target\":\"' || server_ip || '\",\"message_type\":\"' || arg_max(message_type, event_id) || '\"}' AS line FROM v_artifact GROUP BY client_ip, server_ip", "v_artifact")
def k9_node_link(spark, sf_dir):
    nodes = graph.event_nodes(V.artifacts(spark, sf_dir)).withColumnRenamed("host", "hostname")
    return graph.node_link(nodes, _edges(spark, sf_dir), "event_id", ["message_type"]).filter("section = 'link'")


_SHORT = lambda list_, most, more: f"array_to_string({list_}[:{most}], ', ') || CASE WHEN len({list_}) > {most} THEN {more.replace('#', f'(len({list_}) - {most})')} ELSE '' END"
_ISO = lambda e: f"strftime(make_timestamp(CAST({e} * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ')"


_COUNTED = "array_to_string(list_filter([CASE WHEN n_leads > 0 THEN n_leads || ' triggering signal' || CASE n_leads WHEN 1 THEN '' ELSE 's' END END, CASE WHEN n_nodes > 0 THEN n_nodes || ' node' || CASE n_nodes WHEN 1 THEN '' ELSE 's' END END, CASE WHEN n_edges > 0 THEN n_edges || ' edge' || CASE n_edges WHEN 1 THEN '' ELSE 's' END END], lambda x: x IS NOT NULL), ', ')"
_LASTED = "CASE WHEN b - a > 0 THEN ' (duration: ' || CASE WHEN b - a < 60 THEN CAST(b - a AS BIGINT) || 's' WHEN b - a < 3600 THEN CAST(b - a AS BIGINT) // 60 || 'm' WHEN b - a < 86400 THEN CAST(b - a AS BIGINT) // 3600 || 'h' ELSE CAST(b - a AS BIGINT) // 86400 || 'd' END || ')' ELSE '' END"
_QUOTED = "list_transform(rules, lambda r: '\"' || r || '\"')"


@query(f"""SELECT id AS incident_id, 'template' AS report_source, mo_name, CAST(suspicion_score AS DOUBLE) AS suspicion_score, status_name, status_name AS disposition, disposition_category, coalesce(array_to_string(tec, '|'), '') AS attack_techniques, coalesce(array_to_string(tac, '|'), '') AS attack_tactics,
 coalesce(n_leads, 0) AS lead_count, coalesce(n_nodes, 0) AS node_count, coalesce(n_edges, 0) AS edge_count, a AS first_observed_at, b AS last_observed_at, array_to_string(roles, '|') AS set_role_names, coalesce(array_to_string(rules, '|'), '') AS matched_rules, coalesce(array_to_string(prods, '|'), '') AS products_observed, lifecycle_stage,
 'Incident `' || id || '` (`' || c.case_name || '`) was classified by the correlation engine as **' || mo_name || '** with a suspicion score of ' || round(CAST(suspicion_score AS DECIMAL(18, 6)), 2) || ' and a final disposition of **' || status_name || '** (`disposition_category=' || disposition_category || '`). '
 || 'The attack chain began at `' || coalesce({_ISO('a')}, 'unknown time') || '` and was last observed at `' || coalesce({_ISO('b')}, 'unknown time') || '`' || {_LASTED} || '. '
 || CASE WHEN n_edges > 0 THEN 'The incident graph contains ' || {_COUNTED} || '. ' ELSE '' END
 || 'Classification roles assigned: ' || {_SHORT('roles', 6, "' (and ' || # || ' more)'")} || '. ' || CASE WHEN len(rules) > 0 THEN 'Detection rules triggered: ' || {_SHORT(_QUOTED, 8, "', and ' || # || ' more'")} || '. ' ELSE '' END || CASE WHEN len(prods) > 0 THEN 'Security products that observed activity: ' || {_SHORT('prods', 6, "' (and ' || # || ' more)'")} || '. ' ELSE '' END
 || CASE WHEN len(tac) > 0 THEN 'Mapped MITRE ATT&CK tactics: ' || array_to_string(tac, ', ') || '. ' ELSE '' END || CASE WHEN len(tec) > 0 THEN 'Mapped MITRE ATT&CK techniques: ' || {_SHORT('tec', 10, "', and ' || # || ' more'")} || '. ' ELSE '' END
 || CASE WHEN lifecycle_stage <> 'unknown' THEN 'Inferred kill-chain stage: `' || lifecycle_stage || '`. ' ELSE '' END || CASE WHEN first_part IS NULL THEN '' ELSE 'Sample triggering signal: `part ' || first_part || '`. ' END
 || 'This report was generated deterministically from structured incident metadata; it reflects the output of the correlation engine, not an independent threat-hunting investigation.' AS report_text
 FROM case_labels c {_ROLES_OF} LEFT JOIN (SELECT k, min(observed_at) AS a, max(observed_at) AS b, count(DISTINCT lead_id) AS n_leads, count(DISTINCT s) AS n_nodes, count(*) AS n_edges, arg_min(p, pos) AS first_part FROM v_part GROUP BY 1) USING (k)
 LEFT JOIN (SELECT k, list(DISTINCT 'rule ' || (p % 9) ORDER BY 'rule ' || (p % 9)) AS rules, list(DISTINCT 'product ' || (s % 7) ORDER BY 'product ' || (s % 7)) AS prods FROM (SELECT k, lead_id, arg_min(p, pos) AS p, arg_min(s, pos) AS s FROM v_part GROUP BY 1, 2) GROUP BY 1) USING (k)
 LEFT JOIN (SELECT id, list(val ORDER BY ord) AS tac FROM (SELECT id, val, min(ord) AS ord FROM (SELECT id, val, ord * 100 + pos AS ord FROM case_roles JOIN role_tactics ON name = role UNION ALL SELECT id, val, 1000000 + pos FROM v_case JOIN mo_tactics ON name = mo_name) GROUP BY 1, 2) GROUP BY 1) ta USING (id)
 LEFT JOIN (SELECT id, list(val ORDER BY ord, val) AS tec FROM (SELECT id, val, min(ord) AS ord FROM (SELECT id, val, -1 AS ord FROM case_techs UNION ALL SELECT id, val, ord * 100 + pos FROM case_roles JOIN role_techniques ON name = role UNION ALL SELECT id, val, 1000000 + pos FROM v_case JOIN mo_techniques ON name = mo_name) GROUP BY 1, 2) GROUP BY 1) te USING (id)""", *_NESTED, "case_labels")
def q3_attack_reports(spark, sf_dir):
    """All 19 fields of every incident; lists joined by bars."""
    return reports.attack_reports(V.cases(spark, sf_dir), _sets(spark)).withColumns({c: F.array_join(c, "|") for c in ("attack_techniques", "attack_tactics", "set_role_names", "matched_rules", "products_observed")})


_CATALOGUE = {1: {"attck": ["t1110"]}, 2: {"mitre": ["1003", "x"], "nist": ["AC-1"]}, 3: {"attack": ["T1021.002", "T1110"]}}
_CATALOGUE_SQL = "CASE s % 5 WHEN 1 THEN ['T1110'] WHEN 2 THEN ['T1003'] WHEN 3 THEN ['T1021.002', 'T1110'] ELSE [] END"


@query(f"""SELECT id, string_agg(DISTINCT val, '|' ORDER BY val) AS attack_techniques FROM (SELECT id, unnest(string_split(nullif(attack_techniques, ''), '|')) AS val FROM case_labels UNION ALL SELECT id, unnest({_CATALOGUE_SQL}) FROM v_case JOIN v_part USING (k)) GROUP BY 1 UNION ALL
 SELECT id, '' FROM case_labels c WHERE attack_techniques = '' AND NOT EXISTS (SELECT 1 FROM v_part p WHERE p.k = c.k AND s % 5 IN (1, 2, 3))""", *_NESTED, "case_labels")
def j8_catalogue_frameworks(spark, sf_dir):
    """Techniques of incidents, those that the catalogue has for their nodes' product numbers among them."""
    products = spark.createDataFrame([(k, v) for k, v in _CATALOGUE.items()], "product_id int, frameworks map<string,array<string>>")
    return incidents.incident_labels(V.cases(spark, sf_dir), _sets(spark), products).select("id", _bar("attack_techniques"))


# ---- published table, residual findings, review


def _signal(spark, sf_dir):
    return exports.to_signal(labels.label_events(V.artifacts(spark, sf_dir), *V.catalog(spark)))


_json = lambda bars: f"""CASE WHEN coalesce({bars}, '') = '' THEN '[]' ELSE '["' || replace({bars}, '|', '","') || '"]' END"""


@query(f"""SELECT epoch AS timestamp, message_type, a.stream AS stream_name, '' AS pipeline, client_ip AS src_ip, server_ip AS dst_ip, '' AS src_port, '' AS dst_port, '' AS protocol, client_host AS src_host, '' AS dst_host, username, '' AS action, '' AS severity, '' AS vendor_code, '' AS message_sanitized,
 CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END AS label_binary, CASE WHEN n_rules > 0 THEN least(0.85, greatest(0.5, (40 + 10 * n_rules + 5 * coalesce(n_roles, 0)) / 100.0)) ELSE 0.5 END AS label_confidence, {_json('tec')} AS attack_techniques, {_json('tac')} AS attack_tactics,
 '[]' AS defense_techniques, '' AS mo_name, CAST(0 AS DOUBLE) AS suspicion_score, CASE WHEN n_rules > 0 THEN coalesce(stage, 'unknown') ELSE 'none' END AS lifecycle_stage, 'Unprocessed' AS disposition, 'automated' AS disposition_category, false AS is_false_positive, '' AS status_name, '[]' AS incident_ids,
 CASE WHEN k % 5 <> 0 THEN '[]' WHEN k % 20 + 1 = k % 7 + 1 THEN '["rule ' || (k % 20 + 1) || '"]' ELSE '["rule ' || (k % 20 + 1) || '","rule ' || (k % 7 + 1) || '"]' END AS matched_rules, {_json("array_to_string(set_roles, '|')")} AS set_roles, coalesce(nullif(st.product_name, ''), rp, '') AS product_name, coalesce(nullif(st.vendor_name, ''), rv, '') AS vendor_name
 FROM v_artifact a LEFT JOIN (SELECT event_id, count(*) AS n_rules, arg_min(p.product_name, pos) AS rp, arg_min(p.vendor_name, pos) AS rv FROM hits JOIN products p USING (product_id) GROUP BY 1) h USING (event_id)
 LEFT JOIN {_ROLE_LIST('roles', 'event_id')} r USING (event_id) LEFT JOIN (SELECT event_id, string_agg(DISTINCT val, '|' ORDER BY val) AS tac FROM roles JOIN role_tactics ON name = role GROUP BY 1) t USING (event_id)
 LEFT JOIN (SELECT event_id, string_agg(val, '|' ORDER BY seen) AS tec FROM (SELECT event_id, val, min(ord * 100 + pos) AS seen FROM roles JOIN role_techniques ON name = role GROUP BY 1, 2) GROUP BY 1) u USING (event_id)
 LEFT JOIN (SELECT event_id, arg_min(val, ord) AS stage FROM roles JOIN role_stage ON name = role GROUP BY 1) g USING (event_id) LEFT JOIN streams st ON lower(st.stream) = lower(a.stream)""", "v_artifact", "rules", "sets", "products", "streams", "hits", "roles", "role_tactics", "role_techniques", "role_stage")
def p2_signal(spark, sf_dir):
    return _signal(spark, sf_dir)


@query(f"""SELECT CAST(observed_at AS DOUBLE) AS timestamp, 'flow' AS message_type, '' AS stream_name, '' AS pipeline, '10.9.' || (s % 250) || '.7' AS src_ip, '' AS dst_ip, '' AS src_port, '' AS dst_port, '' AS protocol, '' AS src_host, '' AS dst_host, '' AS username, '' AS action, '' AS severity, '' AS vendor_code, '' AS message_sanitized,
 'malicious' AS label_binary, CASE WHEN status_name = 'False Positive' THEN 0.3 ELSE least(0.95, greatest(0.6, suspicion_score)) END AS label_confidence, {_json('attack_techniques')} AS attack_techniques, {_json('attack_tactics')} AS attack_tactics, {_json('defense_techniques')} AS defense_techniques,
 mo_name, CAST(suspicion_score AS DOUBLE) AS suspicion_score, lifecycle_stage, status_name AS disposition, disposition_category, status_name = 'False Positive' AS is_false_positive, status_name, '["' || id || '"]' AS incident_ids, '[]' AS matched_rules, {_json('set_roles')} AS set_roles, '' AS product_name, '' AS vendor_name
 FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY id, nth) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY id, lead_id ORDER BY pos) AS copy FROM case_labels JOIN v_part USING (k)) WHERE copy = 1) WHERE pos % 7 <> 3) WHERE rn = 1""", *_NESTED, "case_labels")
def p2_lead_signal(spark, sf_dir):
    """The flat table of malicious events, with the labels of their incidents."""
    leads = incidents.incident_leads(_labelled_cases(spark, sf_dir))
    return exports.to_signal(leads.select("*", "artifact.*"))


@query("""SELECT 'total_records' AS name, '' AS value, count(*) AS n FROM events UNION ALL SELECT 'message_type_distribution', message_type, count(*) FROM v_artifact GROUP BY 2 UNION ALL SELECT 'stream_distribution', stream, count(*) FROM v_artifact GROUP BY 2
 UNION ALL SELECT 'label_distribution', CASE WHEN k % 5 = 0 THEN 'suspicious' ELSE 'benign' END, count(*) FROM v_artifact GROUP BY 2""", "v_artifact")
def k5_signal_metadata(spark, sf_dir):
    return exports.signal_metadata(_signal(spark, sf_dir)).filter("name <> 'column'")


@query("SELECT value, n FROM (SELECT stream AS value, count(*) AS n FROM v_artifact GROUP BY 1 ORDER BY n DESC, value LIMIT 5)", "v_artifact")
def w11_most_common_streams(spark, sf_dir):
    return exports.most_common(V.artifacts(spark, sf_dir).groupBy(F.col("stream").alias("value")).agg(F.count("*").alias("n")))


@query(f"SELECT doc_id AS record_id, 'EMAIL_ADDRESS' AS entity, v AS value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{D.EMAIL}')) AS v FROM documents) WHERE NOT regexp_matches(lower(v), '\\.(?:{_DOMAINS_SQL})$') UNION ALL SELECT doc_id, 'IP_ADDRESS', v FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{D.IPV4}')) AS v FROM documents) WHERE NOT regexp_matches(v, '^(?:{D.TEST_NET}|{D.SHARED_NET})$')")
def z15_residual_findings(spark, sf_dir):
    """E-mail and network addresses that raw documents hold, as the residual scan sees them; what ends in a public domain
    is allowed."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text")
    kinds = [d for d in review.SCORED if d[0] in ("EMAIL_ADDRESS", "IP_ADDRESS")]
    return review.residual_findings(docs, "text", detectors=kinds).select("record_id", "entity", "value")


@query("""SELECT lang, source, CAST(floor((nth - 1) / 5) AS BIGINT) AS batch, string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY nth) AS keys FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS nth, count(*) OVER (PARTITION BY lang, source) AS n FROM documents) WHERE nth <= greatest(1, floor(n * 0.1)) GROUP BY 1, 2, 3""")
def z16_review_queue(spark, sf_dir):
    queue = review.review_queue(table(spark, sf_dir, "documents"), ["lang", "source"], "doc_id", "text", rate=0.1)
    return queue.select("lang", "source", "batch", F.array_join(F.col("keys").cast("array<string>"), "|").alias("keys"))


@query("SELECT source, count(*) AS reviewed, CAST(sum(n) AS BIGINT) AS found, sum(n) / count(*) AS rate FROM (SELECT source, len(regexp_extract_all(text, '" + D.IPV4 + "')) AS n FROM documents) GROUP BY 1 HAVING sum(n) / count(*) > 0.02")
def a14_issue_rates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(D.IPV4), F.lit(0))).alias("value"))
    return review.issue_rates(docs.select("doc_id", "source"), found, ["source"], "doc_id")


@query(f"""SELECT 'public_address' AS kind, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{D.IPV4}')) AS ip FROM documents) WHERE NOT regexp_matches(ip, '^(?:{D.RFC1918}|{D.LOOPBACK}|{D.TEST_NET}|{D.SHARED_NET}|0\\.0\\.0\\.0|255\\.255\\.255\\.255)$')
 UNION ALL SELECT 'pattern', count(*) FROM documents WHERE regexp_matches(text, '(?i)\\b[\\w.-]*(?:example\\.com)\\b')""")
def v7_report(spark, sf_dir):
    cells = verify.string_cells(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    found = verify.all_checks(cells, _registry(spark, sf_dir), [D.customer_domains(["example.com"])], leaks_too=False)
    return found.groupBy("kind").agg(F.count("*").alias("n"))
