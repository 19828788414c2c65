"""Nested incidents: labels, leads, nodes and edges.

An incident is a row with maps of nodes, edges and leads. What concerns one incident is computed within its row by
higher-order functions, so no children are exploded and grouped again; only children that become rows are exploded.

Columns: id, name, mo_name, suspicion_score, status_name, status_id, created_at, first_observed_at, last_observed_at,
``sets`` VARIANT (objects by id, a list of objects, or a list of set ids), ``nodes`` map<string, struct<type, ip_address,
ip, hostname, credential, suspicion_score, internal, managed, sets map<string, struct<id, name>>, products map<string,
struct<name, frameworks map<string, array<string>>>>>>, ``edges`` map<string, struct<source, target, subtype, started,
ended, count, bytes>>, ``leads`` map<string, struct<observed_at, description, details, set_id, product struct<name>,
artifact struct<...>>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from .labels import confidence, edge_confidence, frameworks_defenses, frameworks_techniques, lifecycle, mapped, mapped_all, mapped_one, merge_unique

STRINGS = "array<string>"


def _values(column: Column | str) -> Column:
    return F.coalesce(F.map_values(column), F.array())


def set_names(sets: Column, names: Column) -> Column:
    """Names of an incident's sets, whichever of the three shapes they have; ``names``: map of set id to name."""
    objects = F.map_values(F.try_variant_get(sets, "$", "map<string,struct<name:string>>"))
    listed = F.try_variant_get(sets, "$", "array<struct<name:string>>")
    ids = F.try_variant_get(sets, "$", "array<int>")
    none = F.array().cast(STRINGS)
    shown = [F.coalesce(x, none) for x in (F.transform(ids, lambda i: F.try_element_at(names, i)), F.transform(listed, lambda x: x["name"]), F.transform(objects, lambda x: x["name"]))]
    return F.filter(F.concat(*shown), lambda x: x.isNotNull() & (x != ""))  # a value has one shape; the others give nothing


def node_names(node: Column, part: str) -> Column:
    """Names of a node's sets or products."""
    return F.filter(F.transform(_values(node[part]), lambda x: x["name"]), lambda x: x.isNotNull() & (x != ""))


def role_names(sets: Column, nodes: Column, names: Column) -> Column:
    """The incident's own roles, then those of its nodes, each once."""
    return merge_unique(set_names(sets, names), F.flatten(F.transform(_values(nodes), lambda n: node_names(n, "sets"))))


def _of_frameworks(nodes: Column, catalogue: Column, ids) -> Column:
    """Ids that ``ids`` finds in the frameworks of the nodes' products, and in the catalogue's for product numbers."""
    own = F.flatten(F.transform(_values(nodes), lambda n: F.flatten(F.transform(_values(n["products"]), lambda p: ids(p["frameworks"])))))
    if catalogue is None:
        return own
    listed = F.flatten(F.transform(_values(nodes), lambda n: F.flatten(F.transform(F.coalesce(F.map_keys(n["products"]), F.array().cast(STRINGS)), lambda k: ids(F.try_element_at(catalogue, k.try_cast("int")))))))
    return F.concat(own, listed)


def with_catalogue(incidents: DataFrame, sets: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Incidents beside the catalogue's maps ``__names`` and ``__frameworks`` (one row: a catalogue has some hundred entries)."""
    names = sets.agg(F.map_from_entries(F.collect_list(F.struct(F.col("set_id").cast("int"), F.col("role")))).alias("__names"))
    known = F.lit(None).cast("map<int,map<string,array<string>>>")
    if products is not None and "frameworks" in products.columns:
        held = products.filter("frameworks IS NOT NULL").agg(F.map_from_entries(F.collect_list(F.struct(F.col("product_id").cast("int"), F.col("frameworks")))).alias("__frameworks"))
        return incidents.crossJoin(F.broadcast(names)).crossJoin(F.broadcast(held))
    return incidents.crossJoin(F.broadcast(names.withColumn("__frameworks", known)))


def incident_labels(incidents: DataFrame, sets: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """``incidents`` with their labels: set_roles, attack_techniques, attack_tactics, defense_techniques (sorted),
    lifecycle_stage, disposition, disposition_category, is_false_positive. A null score counts as 0."""
    rows = with_catalogue(incidents, sets, products)
    rows = rows.withColumn("set_roles", role_names(F.col("sets"), F.col("nodes"), F.col("__names")))
    roles, mo = F.col("set_roles"), F.coalesce("mo_name", F.lit(""))
    found = _of_frameworks(F.col("nodes"), F.col("__frameworks"), frameworks_techniques)
    status = F.coalesce("status_name", F.lit("Unprocessed"))
    return rows.withColumns({
        "attack_techniques": F.array_sort(merge_unique(found, mapped_all(roles, M.ROLE_TECHNIQUES), mapped(mo, M.MO_TECHNIQUES))),
        "attack_tactics": F.array_sort(merge_unique(mapped_all(roles, M.ROLE_TACTICS), mapped(mo, M.MO_TACTICS))),
        "defense_techniques": F.array_sort(merge_unique(_of_frameworks(F.col("nodes"), None, frameworks_defenses))),
        "lifecycle_stage": lifecycle(mo, roles), "disposition": F.coalesce(F.nullif("status_name", F.lit("")), F.lit("Unprocessed")),
        "disposition_category": mapped_one(status, M.STATUS_DISPOSITION, "automated"), "is_false_positive": F.coalesce(F.col("status_name") == "False Positive", F.lit(False)),
        "suspicion": F.coalesce(F.col("suspicion_score").cast("double"), F.lit(0.0)),
    }).drop("__names", "__frameworks")


LABELS = ("mo_name", "suspicion", "set_roles", "attack_techniques", "attack_tactics", "defense_techniques", "lifecycle_stage", "disposition", "disposition_category", "status_name", "is_false_positive")


def incident_leads(labelled: DataFrame, order: tuple[str, ...] = ("incident_id", "pos")) -> DataFrame:
    """Malicious events: of each lead id the first lead that has an artifact, with the artifact's fields and its
    incident's labels. Leads are compared before the shuffle; only the winner's fields travel."""
    leads = labelled.select(F.col("id").alias("incident_id"), F.posexplode("leads").alias("pos", "lead_id", "lead"), *LABELS).filter("lead.artifact IS NOT NULL")
    held = leads.select("lead_id", F.struct(*order).alias("place"), F.struct("incident_id", "pos", "lead.observed_at", "lead.artifact", *LABELS).alias("x"))
    first = held.groupBy("lead_id").agg(F.min_by("x", "place").alias("x"))
    label = F.lit("malicious")
    out = first.select("lead_id", "x.*").withColumns({"_created_at": F.col("observed_at").cast("double"), "_source": F.lit("incident_lead"), "_incident_id": F.col("incident_id"), "incident_ids": F.array("incident_id"), "label_binary": label})
    return out.withColumn("label_confidence", confidence(label, F.col("suspicion"), F.lit(0), F.lit(0), F.col("is_false_positive")))


def node_values(node_id: Column, n: Column) -> dict[str, Column]:
    """A node's attributes by name."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return {
        "node_id": node_id, "node_type": F.upper(F.coalesce(F.nullif(n["type"], F.lit("")), F.lit("HOST"))), "ip": F.coalesce(n["ip_address"], n["ip"], F.lit("")), "host": blank(n["hostname"]), "credential": blank(n["credential"]),
        "set_roles": node_names(n, "sets"), "products": node_names(n, "products"), "suspicion_score": F.coalesce(n["suspicion_score"].cast("double"), F.lit(0.0)),
        "internal": F.coalesce(n["internal"], F.lit(False)), "managed": F.coalesce(n["managed"], F.lit(False)),
    }


def incident_nodes(incidents: DataFrame) -> DataFrame:
    """(node_id, node_type, ip, host, credential, set_roles, products, suspicion_score, internal, managed, incident_id, pos)
    of every incident's nodes."""
    each = incidents.select(F.col("id").alias("incident_id"), F.posexplode("nodes").alias("pos", "node_id", "n"))
    return each.select(*[v.alias(c) for c, v in node_values(F.col("node_id"), F.col("n")).items()], "incident_id", "pos")


def edge_labels() -> dict[str, Column]:
    """What an incident's row says of all its edges, by name."""
    return {"edge_type": F.lit("INCIDENT_LINK"), "timestamp": F.coalesce(F.col("created_at").cast("double"), F.lit(0.0)), "label_binary": F.lit("malicious"), "label_confidence": edge_confidence(F.col("suspicion")), **{c: F.col(c) for c in LABELS}, "incident_id": F.col("id")}


def incident_edges(labelled: DataFrame) -> DataFrame:
    """INCIDENT_LINK edges with their attributes and the labels of their incident, which stand in the same row."""
    said = edge_labels()
    each = labelled.select(*[v.alias(c) for c, v in said.items()], F.posexplode("edges").alias("pos", "edge_key", "e"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c.split(".")[1])
    return each.select(
        F.coalesce("e.source", F.lit("")).alias("src"), F.coalesce("e.target", F.lit("")).alias("dst"), "edge_type", "timestamp", F.coalesce("e.subtype", F.lit("")).alias("edge_subtype"),
        zero("e.started"), zero("e.ended"), zero("e.count"), zero("e.bytes"), "label_binary", "label_confidence", *LABELS, "incident_id", "pos", "edge_key",
    )


def incident_summary(incidents: DataFrame, sets: DataFrame) -> DataFrame:
    """What a report says of an incident; tactics and techniques in order of their sources, techniques of products first."""
    rows = with_catalogue(incidents, sets).withColumn("set_role_names", role_names(F.col("sets"), F.col("nodes"), F.col("__names")))
    roles, mo = F.col("set_role_names"), F.coalesce("mo_name", F.lit("Unknown"))
    status = F.coalesce("status_name", F.lit("Unprocessed"))
    leads = _values("leads")
    some = lambda x: x.isNotNull() & (x != "")
    count = lambda c: F.coalesce(F.size(F.map_keys(c)), F.lit(0)).cast("long")
    return rows.select(
        F.coalesce("id", F.lit("unknown")).alias("incident_id"), F.coalesce("name", F.lit("")).alias("name"), mo.alias("mo_name"), F.coalesce(F.col("suspicion_score").cast("double"), F.lit(0.0)).alias("suspicion_score"), status.alias("status_name"),
        F.coalesce(F.nullif(status, F.lit("")), F.lit("Unprocessed")).alias("disposition"), mapped_one(status, M.STATUS_DISPOSITION, "automated").alias("disposition_category"), "first_observed_at", "last_observed_at", "set_role_names",
        merge_unique(mapped_all(roles, M.ROLE_TACTICS), mapped(mo, M.MO_TACTICS)).alias("attack_tactics"),
        merge_unique(F.array_sort(F.array_distinct(_of_frameworks(F.col("nodes"), None, frameworks_techniques))), mapped_all(roles, M.ROLE_TECHNIQUES), mapped(mo, M.MO_TECHNIQUES)).alias("attack_techniques"),
        count("nodes").alias("node_count"), count("edges").alias("edge_count"), count("leads").alias("lead_count"),
        F.array_sort(F.array_distinct(F.filter(F.transform(leads, lambda x: F.trim(x["description"])), some))).alias("matched_rules"),
        F.array_sort(F.array_distinct(F.filter(F.transform(leads, lambda x: x["product"]["name"]), some))).alias("products_observed"),
        lifecycle(mo, roles).alias("lifecycle_stage"), F.trim(F.try_element_at(leads, F.lit(1))["details"]).alias("first_details"),
    )
