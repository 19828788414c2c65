"""The provenance graph: nodes and edges of events and incidents, and its text forms."""

from __future__ import annotations

from collections.abc import Container

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from .incidents import edge_labels, incident_edges, incident_nodes, node_values
from .labels import mapped_one
from .order import indexed


def node_id(ip: Column, host: Column) -> Column:
    return F.coalesce(F.nullif(ip, F.lit("")), host)


def real(column: Column) -> Column:
    """Not a placeholder."""
    return column.isNotNull() & ~column.isin("", "-", "None")


def event_nodes(events: DataFrame) -> DataFrame:
    """(node_id, node_type, ip, host) of both ends and of users; the first event that names a node gives its values."""
    side = lambda s: F.struct(node_id(F.col(f"{s}_ip"), F.col(f"{s}_host")).alias("node_id"), F.lit("HOST").alias("node_type"), F.col(f"{s}_ip").alias("ip"), F.col(f"{s}_host").alias("host"))
    user = F.struct(F.when(real(F.col("username")), F.concat(F.lit("user:"), "username")).alias("node_id"), F.lit("CREDENTIAL").alias("node_type"), F.lit("").alias("ip"), F.lit("").alias("host"))
    every = events.select("event_id", F.posexplode(F.array(side("client"), side("server"), user)).alias("place", "x")).select("event_id", "place", "x.*").filter(real(F.col("node_id")))
    first = every.groupBy("node_id").agg(F.min_by(F.struct("node_type", "ip", "host"), F.struct("event_id", "place")).alias("x"))
    return first.select("node_id", "x.*")


def event_edges(events: DataFrame) -> DataFrame:
    """One typed edge for each event whose two ends are known, with those of its attributes and labels that it has."""
    src, dst = node_id(F.col("client_ip"), F.col("client_host")), node_id(F.col("server_ip"), F.col("server_host"))
    kind = mapped_one(F.col("message_type"), M.MESSAGE_EDGE, "EVENT")
    more = [c for c in ("action", "protocol", "src_port", "dst_port", "stream", "label_confidence", "suspicion", "mo_name", "attack_techniques", "attack_tactics", "set_roles", "lifecycle_stage", "disposition") if c in events.columns]
    return events.select("event_id", src.alias("src"), dst.alias("dst"), kind.alias("edge_type"), "epoch", "message_type", "label_binary", *more).filter(real(F.col("src")) & real(F.col("dst")))


def build_graph(events: DataFrame, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of labelled events and of labelled incidents.

    A node of an event is the first that names it; a node of an incident takes its place, the last incident's winning.
    """
    blank, none = F.lit(""), F.array().cast("array<string>")
    seen = event_nodes(events).select("node_id", F.struct(F.lit(0).alias("rank"), F.lit("").alias("incident_id"), F.lit(0).alias("pos")).alias("place"), "node_type", "ip", F.col("host").alias("hostname"), F.when(F.col("node_type") == "CREDENTIAL", F.substring("node_id", 6, 1 << 20)).otherwise("").alias("credential"), none.alias("set_roles"), none.alias("products"), F.lit(0.0).alias("suspicion_score"))
    own = incident_nodes(labelled).select("node_id", F.struct(F.lit(1).alias("rank"), "incident_id", "pos").alias("place"), "node_type", "ip", F.col("host").alias("hostname"), "credential", "set_roles", "products", "suspicion_score")
    values = [c for c in seen.columns if c not in ("node_id", "place")]
    nodes = seen.unionByName(own).groupBy("node_id").agg(F.max_by(F.struct(*values), "place").alias("x")).select("node_id", "x.*")
    edges = event_edges(events).withColumnRenamed("epoch", "timestamp").unionByName(incident_edges(labelled), allowMissingColumns=True)
    return nodes, edges.withColumn("edge_type", F.coalesce("edge_type", blank))


def known_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends are nodes."""
    ids = nodes.select("node_id")
    return edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")


def numbered(edges: DataFrame, order: list[str], parts: int | None = None, form: str = "e-%08d") -> DataFrame:
    """edge_id by place in the whole order of the columns."""
    return indexed(edges, order, "__index", parts).withColumn("edge_id", F.format_string(form, "__index")).drop("__index")


def simple_digraph(edges: DataFrame, attributes: list[str], order: str) -> DataFrame:
    """One edge for each pair: of every attribute the last value that isn't empty."""
    last = [F.max_by(F.when(F.col(a).cast("string") != "", F.col(a)), F.when(F.col(a).cast("string") != "", F.col(order))).alias(a) for a in attributes]
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n_edges"), *last)


def distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, n) of all columns in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns]))
    return df.select(pairs.alias("x")).groupBy("x.name", "x.value").agg(F.count("*").alias("n"))


def xml_text(column: Column) -> Column:
    out = column.cast("string")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


#: Attributes of the published documents and their types (fixed values of the format).
NODE_ATTRIBUTES = {"type": "string", "ip": "string", "hostname": "string", "credential": "string", "set_roles": "string", "suspicion_score": "double", "products": "string", "report_text": "string"}
EDGE_ATTRIBUTES = {
    "type": "string", "timestamp": "double", "message_type": "string", "action": "string", "protocol": "string", "src_port": "string", "dst_port": "string", "stream": "string", "label_binary": "string", "label_confidence": "double", "suspicion_score": "double", "mo_name": "string",
    "attack_techniques": "string", "attack_tactics": "string", "set_roles": "string", "lifecycle_stage": "string", "disposition": "string", "incident_id": "string",
}
RENAMED = {"type": ("node_type", "edge_type"), "hostname": ("hostname", "host"), "suspicion_score": ("suspicion_score", "suspicion")}


def _data(values: dict[str, Column], attributes: dict[str, str], prefix: str, lists: Container[str]) -> list[Column]:
    """Lines of the attributes that have a value, where that is neither null nor empty; those of ``lists`` as JSON."""
    out = []
    for name in attributes:
        held = next((c for c in (*RENAMED.get(name, ()), name) if c in values), None)
        if held is None:
            continue
        text = F.to_json(values[held]) if held in lists else values[held].cast("string")
        out.append(F.when(text != "", F.concat(F.lit(f'\n      <data key="{prefix}_{name}">'), xml_text(text), F.lit("</data>"))))
    return out


def _columns(df: DataFrame) -> tuple[dict[str, Column], list[str]]:
    """A table's columns by name, and the names of those that are lists."""
    return {c: F.col(c) for c in df.columns}, [f.name for f in df.schema if f.dataType.typeName() == "array"]


def _node_text(node_id: Column, data: list[Column]) -> Column:
    return F.concat(F.lit('    <node id="'), xml_text(node_id), F.lit('">'), F.concat_ws("", *data), F.lit("\n    </node>"))


def _edge_text(number: Column, src: Column, dst: Column, data: list[Column]) -> Column:
    ends = F.concat(F.lit('" source="'), xml_text(src), F.lit('" target="'), xml_text(dst), F.lit('">'))
    return F.concat(F.lit('    <edge id="e'), number.cast("string"), ends, F.concat_ws("", *data), F.lit("\n    </edge>"))


def node_xml(nodes: DataFrame, attributes: dict[str, str] = NODE_ATTRIBUTES) -> Column:
    values, lists = _columns(nodes)
    return _node_text(F.col("node_id"), _data(values, attributes, "n", lists))


def edge_xml(edges: DataFrame, number: Column, attributes: dict[str, str] = EDGE_ATTRIBUTES) -> Column:
    values, lists = _columns(edges)
    return _edge_text(number, F.col("src"), F.col("dst"), _data(values, attributes, "e", lists))


def graphml_head(nodes: dict[str, str] = NODE_ATTRIBUTES, edges: dict[str, str] = EDGE_ATTRIBUTES) -> str:
    keys = [f'  <key id="{k[0]}_{a}" for="{k}" attr.name="{a}" attr.type="{t}"/>' for k, names in (("node", nodes), ("edge", edges)) for a, t in names.items()]
    space = "http://graphml.graphdrawing.org/xmlns"
    first = ['<?xml version="1.0" encoding="UTF-8"?>', f'<graphml xmlns="{space}"', '  xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"', f'  xsi:schemaLocation="{space} {space}/1.0/graphml.xsd">']
    return "\n".join([*first, *keys, '  <graph id="G" edgedefault="directed">'])


GRAPHML_FOOT = "  </graph>\n</graphml>"


def graphml(nodes: DataFrame, edges: DataFrame, order: list[str]) -> DataFrame:
    """(section, place, line) of one GraphML document, to be read in order of section and place; edges are numbered from 1
    in ``order``. Edges without an end are left out."""
    whole = edges.filter((F.col("src") != "") & (F.col("dst") != ""))
    placed = indexed(whole, order, "__at")
    inner = placed.select(F.lit(2).alias("section"), (F.col("__at") + 1).alias("place"), edge_xml(placed.drop("__at"), F.col("__at") + 1).alias("line"))
    ranked = indexed(nodes, ["node_id"], "__at")
    outer = ranked.select(F.lit(1).alias("section"), F.col("__at").alias("place"), node_xml(ranked).alias("line"))
    frame = nodes.sparkSession.createDataFrame([(0, 0, graphml_head()), (3, 0, GRAPHML_FOOT)], "section int, place long, line string")
    return frame.unionByName(outer).unionByName(inner)


def incident_graphml(labelled: DataFrame) -> DataFrame:
    """(incident_id, graphml): a document of each incident that has an id, written within its row. What an incident says of
    all its edges is written once and repeated with each."""
    said = labelled.filter("id <> ''").select(*[v.alias(c) for c, v in edge_labels().items()], "nodes", "edges")
    values, lists = _columns(said)
    said = said.select("incident_id", "nodes", "edges", F.concat_ws("", *_data(values, EDGE_ATTRIBUTES, "e", lists)).alias("said"))

    def node(x: Column) -> Column:
        values = node_values(x["key"], x["value"])
        return _node_text(x["key"], _data(values, NODE_ATTRIBUTES, "n", ("set_roles", "products")))

    def edge(x: Column, i: Column) -> Column:
        return _edge_text(i + 1, F.coalesce(x["source"], F.lit("")), F.coalesce(x["target"], F.lit("")), [F.col("said")])

    return said.select("incident_id", F.concat_ws("\n", F.lit(graphml_head()), F.transform(F.map_entries("nodes"), node), F.transform(F.map_values("edges"), edge), F.lit(GRAPHML_FOOT)).alias("graphml"))


def node_link(nodes: DataFrame, edges: DataFrame, order: str, attributes: list[str]) -> DataFrame:
    """(section, line): the nodes and the simple digraph's links as JSON objects; links only between nodes."""
    links = simple_digraph(known_ends(edges, nodes), attributes, order)
    node = F.to_json(F.struct(F.col("node_id").alias("id"), F.col("node_type").alias("type"), F.nullif("ip", F.lit("")).alias("ip"), F.nullif("hostname", F.lit("")).alias("hostname")))
    link = F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), *attributes))
    return nodes.select(F.lit("node").alias("section"), node.alias("line")).unionByName(links.select(F.lit("link").alias("section"), link.alias("line")))
