"""Labels of events and incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mappings as M
from .order import indexed


def merge_unique(*arrays: Column) -> Column:
    """The arrays' items in order of first appearance, without empty ones."""
    lists = [F.coalesce(a, F.array().cast("array<string>")) for a in arrays]
    return F.array_distinct(F.filter(F.flatten(F.array(*lists)), lambda x: x.isNotNull() & (x != "")))


def confidence(label: Column, suspicion: Column, n_rules: Column, n_roles: Column, false_positive: Column) -> Column:
    bad = F.when(false_positive, 0.3).otherwise(F.least(F.lit(0.95), F.greatest(F.lit(0.6), F.coalesce(suspicion, F.lit(0.0)))))
    odd = F.least(F.lit(0.85), F.greatest(F.lit(0.5), (40 + 10 * n_rules + 5 * n_roles) / 100.0))
    return F.when(F.lower(label) == "malicious", bad).when(F.lower(label) == "suspicious", odd).otherwise(0.5).cast("double")


def edge_confidence(suspicion: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.7), F.coalesce(suspicion, F.lit(0.0))))


def mapped(column: Column, table: dict[str, list[str]]) -> Column:
    """Values of a lookup table for a name; unknown: empty. The tables are literals of a few dozen entries."""
    literal = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    return F.coalesce(F.try_element_at(literal, F.trim(column)), F.array().cast("array<string>"))


def mapped_one(column: Column, table: dict[str, list[str]], default: str) -> Column:
    return F.coalesce(F.try_element_at(mapped(column, table), F.lit(1)), F.lit(default))


def mapped_all(roles: Column, table: dict[str, list[str]]) -> Column:
    return merge_unique(F.flatten(F.transform(roles, lambda r: mapped(r, table))))


def lifecycle(mo: Column, roles: Column) -> Column:
    """The stage of the modus operandi, else of the first role that has one."""
    own = mapped(mo, M.MO_LIFECYCLE)
    first = F.try_element_at(F.filter(F.transform(roles, lambda r: mapped_one(r, M.ROLE_LIFECYCLE, "")), lambda x: x != ""), F.lit(1))
    return F.coalesce(F.nullif(F.try_element_at(own, F.lit(1)), F.lit("unknown")), first, F.lit("unknown"))


def frameworks_techniques(frameworks: Column) -> Column:
    """Technique ids of a map of framework to ids: T-ids in upper case, numbers as T%04d."""
    lists = [F.coalesce(F.try_element_at(frameworks, F.lit(k)), F.array().cast("array<string>")) for k in ("attck", "attack", "mitre_attack", "mitre")]
    shaped = F.transform(F.flatten(F.array(*lists)), lambda t: F.when(t.rlike(r"^[Tt]\d+(\..*)?$"), F.upper(t)).when(t.rlike(r"^\d+$"), F.format_string("T%04d", t.cast("int"))))
    return F.filter(shaped, lambda t: t.isNotNull())


def frameworks_defenses(frameworks: Column) -> Column:
    """Defense ids of a map of framework to ids."""
    lists = [F.coalesce(F.try_element_at(frameworks, F.lit(k)), F.array().cast("array<string>")) for k in ("d3fend", "defense", "mitigation")]
    return F.filter(F.flatten(F.array(*lists)), lambda d: d.isNotNull())


def label_events(events: DataFrame, rules: DataFrame, sets: DataFrame, products: DataFrame, streams: DataFrame, key: str = "event_id") -> DataFrame:
    """Suspicious or benign labels of every event from the rules that matched it.

    ``events`` has ``rule_ids`` array and ``stream``. Unknown rule ids are ignored; set ids over 1000 stand for their
    remainder by 1000; roles come in the order of the rules, client before server, each once, and count once.
    """
    hits = events.select(key, F.posexplode("rule_ids").alias("pos", "rule_id")).join(rules, "rule_id")
    plain = lambda c: F.when(F.col(c) > 1000, F.col(c) % 1000).otherwise(F.col(c))
    for side in ("client", "server"):
        names = sets.select(F.col("set_id").alias(f"{side}_id"), F.col("role").alias(f"{side}_role"))
        hits = hits.withColumn(f"{side}_id", plain(f"{side}_set_id")).join(names, f"{side}_id", "left")
    hits = hits.join(products, "product_id", "left")
    item = F.struct("pos", "description", "client_role", "server_role", "product_name", "vendor_name")
    rolled = hits.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    both = F.flatten(F.transform("items", lambda x: F.array(x["client_role"], x["server_role"])))
    rolled = rolled.select(key, F.size("items").alias("n_rules"), merge_unique(F.transform("items", lambda x: x["description"])).alias("matched_rules"), merge_unique(both).alias("set_roles"), F.try_element_at(merge_unique(F.transform("items", lambda x: x["product_name"])), F.lit(1)).alias("rule_product"), F.try_element_at(merge_unique(F.transform("items", lambda x: x["vendor_name"])), F.lit(1)).alias("rule_vendor"))
    out = events.join(rolled, key, "left").join(streams.select(F.lower("stream").alias("__s"), F.col("product_name").alias("stream_product"), F.col("vendor_name").alias("stream_vendor")), F.lower("stream") == F.col("__s"), "left")
    empty = F.array().cast("array<string>")
    roles = F.coalesce("set_roles", empty)
    odd = F.col("n_rules").isNotNull()
    label = F.when(odd, "suspicious").otherwise("benign")
    return out.select(
        *events.columns, label.alias("label_binary"), confidence(label, F.lit(0.0), F.coalesce("n_rules", F.lit(0)), F.size(roles), F.lit(False)).alias("label_confidence"),
        F.coalesce("matched_rules", empty).alias("matched_rules"), roles.alias("set_roles"), mapped_all(roles, M.ROLE_TECHNIQUES).alias("attack_techniques"), F.array_sort(mapped_all(roles, M.ROLE_TACTICS)).alias("attack_tactics"),
        F.when(odd, lifecycle(F.lit(""), roles)).otherwise("none").alias("lifecycle_stage"), F.coalesce(F.nullif("stream_product", F.lit("")), "rule_product", F.lit("")).alias("product_name"), F.coalesce(F.nullif("stream_vendor", F.lit("")), "rule_vendor", F.lit("")).alias("vendor_name"),
    )


def incident_labels(incidents: DataFrame, nodes: DataFrame, key: str = "incident_id") -> DataFrame:
    """Labels of each incident from its campaign, status and the roles and frameworks of its nodes (pos orders them)."""
    roles = nodes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "role"))).alias("x")).select(key, merge_unique(F.transform("x", lambda r: r["role"])).alias("set_roles"))
    out = incidents.join(roles, key, "left").withColumn("set_roles", F.coalesce("set_roles", F.array().cast("array<string>")))
    techniques = merge_unique(mapped(F.col("mo_name"), M.MO_TECHNIQUES), mapped_all(F.col("set_roles"), M.ROLE_TECHNIQUES))
    tactics = merge_unique(mapped(F.col("mo_name"), M.MO_TACTICS), mapped_all(F.col("set_roles"), M.ROLE_TACTICS))
    return out.withColumns({
        "attack_techniques": F.array_sort(techniques), "attack_tactics": F.array_sort(tactics), "lifecycle_stage": lifecycle(F.col("mo_name"), F.col("set_roles")), "disposition": F.col("status_name"),
        "disposition_category": mapped_one(F.col("status_name"), M.STATUS_DISPOSITION, "unknown"), "is_false_positive": F.coalesce(F.col("status_name") == "False Positive", F.lit(False)),
    })


def first_leads(leads: DataFrame, key: str = "lead_id", order: tuple[str, ...] = ("incident_id", "pos")) -> DataFrame:
    """The first lead of each id among those that have an artifact. Leads are compared as pairs of order and place before
    the shuffle, so no id's copies are gathered."""
    others = [c for c in leads.columns if c != key]
    first = leads.filter("has_artifact").groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("x"))
    return first.select(key, "x.*").select(leads.columns)


def lead_events(leads: DataFrame, labels: DataFrame, key: str = "incident_id") -> DataFrame:
    """Malicious events: each first lead with its incident's labels."""
    own = labels.select(key, "mo_name", "suspicion", "set_roles", "attack_techniques", "attack_tactics", "lifecycle_stage", "disposition", "disposition_category", "is_false_positive")
    label = F.lit("malicious")
    return first_leads(leads).join(own, key).withColumns({"label_binary": label, "label_confidence": confidence(label, F.col("suspicion"), F.lit(0), F.lit(0), F.col("is_false_positive"))})


def all_events(labelled: DataFrame, malicious: DataFrame) -> DataFrame:
    return labelled.unionByName(malicious, allowMissingColumns=True)


def newest_periods(events: DataFrame, n: int, org: str = "org_id", day: str = "day") -> DataFrame:
    """Events of each organisation's newest n days (0: all)."""
    if not n:
        return events
    days = events.select(org, day).distinct().withColumn("__nth", F.row_number().over(Window.partitionBy(org).orderBy(F.col(day).desc()))).filter(F.col("__nth") <= n)
    return events.join(days.select(org, day), [org, day], "left_semi")


def stratified(df: DataFrame, strata: list[str], rate: float, key: str, per_batch: int = 5) -> DataFrame:
    """Of each stratum max(1, floor(n * rate)) rows by key, with the batch of ``per_batch`` they fall into.

    Places within a stratum come from ranges of (stratum, key), so a stratum that holds a third of all rows is many tasks.
    """
    placed = indexed(df, [*strata, key])
    bounds = placed.groupBy(*strata).agg(F.min("__index").alias("__low"), F.greatest(F.lit(1), F.floor(F.count("*") * rate)).alias("__want"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in strata]
    ranked = placed.alias("a").join(bounds.alias("b"), same).select("a.*", "__low", "__want").withColumn("nth", F.col("__index") - F.col("__low") + 1)
    return ranked.filter("nth <= __want").withColumn("batch", F.floor((F.col("nth") - 1) / per_batch)).drop("__index", "__low", "__want")
