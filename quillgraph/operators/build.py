"""Building the property graph from entities, sections, requirements and test cases: node and edge tables, layer by layer.

Every layer is a select; a bundle keeps the first node of an id and each (src, dst, edge_type) once, by layer and place.
Input tables (see each function); nulls count as empty, and empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from . import entities as E
from . import linking as L
from . import rules as R

_PROPS = "map<string,string>"


@dataclass
class Layer:
    """nodes (node_id, node_type, label, cluster, doc_type, props) and edges (src, dst, edge_type, origin)."""

    nodes: DataFrame | None
    edges: DataFrame | None


def _props(**cols: Column) -> Column:
    pairs = [x for k, v in cols.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]
    return F.create_map(*pairs).cast(_PROPS) if pairs else F.create_map().cast(_PROPS)


def _node(df: DataFrame, node_id: Column, node_type: Column, label: Column, cluster: Column, doc: str, **props: Column) -> DataFrame:
    return df.select(node_id.alias("node_id"), node_type.alias("node_type"), F.coalesce(label, F.lit("")).alias("label"), F.coalesce(cluster, F.lit("")).alias("cluster"), F.lit(doc).alias("doc_type"), _props(**props).alias("props"))


def _edge(df: DataFrame, src: Column, dst: Column, kind: Column, origin: str) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"), kind.alias("edge_type"), F.lit(origin).alias("origin")).filter("src != '' and dst != ''")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def cluster_id(name: Column) -> Column:
    return F.when(F.coalesce(name, F.lit("")) == "", "").otherwise(F.concat(F.lit("CLUSTER::"), name))


def schema_layer(clusters: DataFrame, entities: DataFrame) -> Layer:
    """clusters (name, code, revision, hierarchy, base_cluster) and entities (entity_id, entity_type, name, cluster, ...).

    A cluster has its entities; an alias points to its base; a feature whose summary names a dependency with another
    cluster makes its cluster depend on it: by the whole name, else by the longest name that begins with the hint.
    """
    c, e = F.col, entities
    nodes = _node(clusters, cluster_id(c("name")), F.lit("cluster"), c("name"), c("name"), "data_model", code=c("code"), revision=c("revision"), hierarchy=c("hierarchy"), base_cluster=c("base_cluster"))
    cols = [x for x in ("code", "conformance", "datatype", "access", "default", "direction", "response", "priority", "bit", "code_short", "summary") if x in e.columns]
    nodes = nodes.unionByName(_node(e, c("entity_id"), c("entity_type"), c("name"), c("cluster"), "data_model", **{x: c(x) for x in cols}))
    edges = _edge(e, cluster_id(c("cluster")), c("entity_id"), F.concat(F.lit("HAS_"), F.upper("entity_type")), "schema")
    alias = clusters.filter("hierarchy = 'alias'")
    edges = edges.unionByName(_edge(alias, cluster_id(c("name")), cluster_id(c("base_cluster")), F.lit("alias_of"), "schema"))
    if "summary" in e.columns:
        hint = F.lower(F.trim(F.regexp_extract(_text("summary"), r"(?i)dependency\s+(?:with|on)\s+(?:the\s+)?(.+?)(?:\s+cluster)?\s*$", 1)))
        wants = e.filter("entity_type = 'feature'").select("cluster", hint.alias("hint")).filter("hint != ''")
        own = clusters.select(F.col("name").alias("other"), F.lower("name").alias("low"))
        # every beginning of a name by whole words, so that the prefix match is an equi-join
        words = F.split("low", " ")
        starts = own.select("other", "low", F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, 1, k), " "))).alias("hint"))
        hit = wants.join(starts, "hint").filter("cluster != other").groupBy("cluster", "hint").agg(F.min(F.struct((F.col("low") != F.col("hint")).alias("part"), (-F.length("low")).alias("l"), "other")).alias("m"))
        edges = edges.unionByName(_edge(hit, cluster_id(c("cluster")), cluster_id(c("m.other")), F.lit("depends_on"), "schema"))
    return Layer(nodes, edges)


def section_layer(sections: DataFrame) -> Layer:
    """sections (section_id, title, cluster, section_path, full_text, source_doc): nodes, and references to their cluster."""
    c = F.col
    nodes = _node(sections, c("section_id"), F.lit("section"), F.coalesce(F.nullif(c("title"), F.lit("")), c("section_id")), c("cluster"), "spec", title=c("title"), section_path=c("section_path"), source_doc=c("source_doc"), full_text=F.left("full_text", F.lit(V.SECTION_TEXT)))
    return Layer(nodes, _edge(sections, c("section_id"), cluster_id(c("cluster")), F.lit("references"), "section"))


def references(sections: DataFrame) -> DataFrame:
    """(src, dst, edge_type, origin): sections that a text refers to by number, the first MOST_REFERENCES different ones.

    A number belongs to the first section, by id, whose path has it; a section doesn't refer to itself.
    """
    number = F.transform(F.split(_text("section_path"), ">"), lambda s: F.regexp_extract(F.trim(s), r"^(\d+(?:\.\d+)*)", 1))
    owner = sections.select("section_id", F.explode(F.array_distinct(number)).alias("number")).filter("number != ''").groupBy("number").agg(F.min("section_id").alias("dst"))
    text = F.left(_text("full_text"), F.lit(V.SECTION_TEXT))
    refs = sections.select(F.col("section_id").alias("src"), F.posexplode(F.regexp_extract_all(text, F.lit(V.SECTION_REFERENCE), F.lit(1))).alias("pos", "number"))
    hits = refs.join(owner, "number").filter("src != dst").groupBy("src", "dst").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy("src").orderBy("pos", "dst")
    hits = hits.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= V.MOST_REFERENCES)
    return _edge(hits, F.col("src"), F.col("dst"), F.lit("references"), "text")


def requirement_layer(requirements: DataFrame) -> Layer:
    """requirements (req_id, requirement_type, cluster, section_id, section_path, normative_text, entity_refs, confidence):
    rules and other requirements, their section, what they implement (their cluster where they name no entity), areas and
    behaviours."""
    c, r = F.col, requirements
    kind = F.when(c("requirement_type") == "conditional_behavior_rule", "behavior_rule").otherwise("requirement")
    nodes = _node(r, c("req_id"), kind, F.left("normative_text", F.lit(80)), c("cluster"), "spec", requirement_type=c("requirement_type"), normative_text=c("normative_text"), section_path=c("section_path"), confidence=c("confidence"))
    edges = _edge(r.filter(_text("section_id") != ""), c("req_id"), c("section_id"), F.lit("belongs_to"), "requirement")
    targets = F.when(F.size(_list("entity_refs")) > 0, _list("entity_refs")).otherwise(F.array(cluster_id(c("cluster"))))
    each = r.select("req_id", F.explode(F.array_distinct(targets)).alias("t"))
    edges = edges.unionByName(_edge(each, c("req_id"), c("t"), F.lit("implements"), "requirement"))
    found = r.select("req_id", F.explode(R.behaviours(_text("normative_text"))).alias("b"))
    edges = edges.unionByName(_edge(found, c("b"), c("req_id"), F.lit("HAS_BEHAVIOR_RULE"), "requirement"))
    label = F.translate(F.split_part("b", F.lit("::"), F.lit(2)), "_", " ")
    nodes = nodes.unionByName(_node(found.select("b").distinct(), c("b"), F.lit("behavior"), label, F.lit(""), "spec"))
    return Layer(nodes, edges)


def area_layer(sections: DataFrame, requirements: DataFrame, clusters: DataFrame) -> Layer:
    """Protocol areas of breadcrumbs, what belongs to them, and each cluster in the first section's path that names it."""
    c = F.col
    paths = sections.select(F.col("section_id").alias("id"), "section_path").unionByName(requirements.select(F.col("req_id").alias("id"), "section_path"))
    each = paths.select("id", F.posexplode(E.areas(_text("section_path"))).alias("pos", "area"))
    edges = _edge(each, c("id"), c("area"), F.lit("BELONGS_TO_PROTOCOL_AREA"), "area")
    label = F.initcap(F.translate(F.split_part("area", F.lit("::"), F.lit(2)), "_", " "))
    nodes = _node(each.select("area").distinct(), c("area"), F.lit("protocol_area"), label, F.lit(""), "spec")
    # a cluster is found by the areas that hold its name as whole words, so by an equi-join on runs of words
    words = F.split(F.translate(F.lower(F.split_part("area", F.lit("::"), F.lit(2))), "_", " "), " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(F.lit(1), F.size(words) - i + 1), lambda k: F.array_join(F.slice(words, i, k), " "))))
    named = clusters.select("name", F.array_join(F.filter(F.split(F.lower("name"), "[^a-z0-9]+"), lambda w: w != ""), " ").alias("run"))
    hit = each.join(sections.select(F.col("section_id").alias("id")), "id").select("id", "pos", "area", F.explode(F.array_distinct(runs)).alias("run")).join(named, "run")
    # the outermost area of the first section that names the cluster
    outer = each.filter("pos = 0").select("id", F.col("area").alias("first"))
    first = hit.join(outer, "id").groupBy("name").agg(F.min_by("first", "id").alias("area"))
    return Layer(nodes, edges.unionByName(_edge(first, cluster_id(c("name")), c("area"), F.lit("BELONGS_TO_PROTOCOL_AREA"), "area")))


def case_edges(test_cases: DataFrame, entities: DataFrame, requirements: DataFrame | None = None) -> DataFrame:
    """(src, dst, edge_type, origin) of test cases (tc_id, cluster, intents, entity_refs, spec_refs, purpose, setup,
    prerequisites, procedure_steps): typed edges to entities, to requirements, to the cluster and to codes that gate them.

    An entity's edge follows the first intent that suits its type, else its type; a checked response is refined to the
    property that is checked.  A reference to a rule is 'verifies_rule', other references that aren't requirements are context.
    """
    c = F.col
    t = test_cases.withColumn("_steps", F.array_join(_list("procedure_steps"), " "))
    refs = t.select("tc_id", _list("intents").alias("intents"), F.concat_ws(" ", "_steps", _text("purpose"), _text("setup")).alias("text"), F.explode(F.array_distinct(_list("entity_refs"))).alias("ref"))
    known = entities.select(F.col("entity_id").alias("ref"), "entity_type", F.col("name").alias("entity_name"))
    j = refs.join(known, "ref", "left")
    suits = lambda i: F.coalesce(F.array_contains(F.try_element_at(F.create_map(*[x for k, v in V.INTENT_SUITS.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))]), i), c("entity_type")), F.lit(True))
    edge_of = F.create_map(*[F.lit(x) for kv in V.INTENT_EDGES.items() for x in kv])
    by_intent = F.try_element_at(F.transform(F.filter("intents", lambda i: F.try_element_at(edge_of, i).isNotNull() & suits(i)), lambda i: F.try_element_at(edge_of, i)), F.lit(1))
    by_type = F.try_element_at(F.create_map(*[F.lit(x) for kv in V.TYPE_EDGES.items() for x in kv]), c("entity_type"))
    edge = F.coalesce(by_intent, by_type, F.lit("tests"))
    edge = F.when((edge == "verifies_attribute") & (c("entity_type") == "command"), "tests_command").otherwise(edge)
    refined = (edge == "verifies_attribute") & (c("entity_type") == "attribute") & F.array_contains("intents", "validate_response")
    edge = F.when(refined, R.validation_edge(c("text"), c("entity_name"))).otherwise(edge)
    unknown = F.when(c("ref").startswith("CLUSTER::"), "tests").otherwise("in_context")
    out = _edge(j, c("tc_id"), c("ref"), F.when(c("entity_type").isNull(), unknown).otherwise(edge), "test_case")
    spec = t.select("tc_id", F.explode(F.array_distinct(_list("spec_refs"))).alias("req_id"))
    kind = F.when(c("req_id").rlike("^(REQ|REQUIREMENT)::"), "verifies_requirement").otherwise("in_context")
    if requirements is not None:
        spec = spec.join(requirements.select("req_id", "requirement_type"), "req_id", "left")
        kind = F.when(c("requirement_type") == "conditional_behavior_rule", "verifies_rule").otherwise(kind)
    out = out.unionByName(_edge(spec, c("tc_id"), c("req_id"), kind, "test_case"))
    out = out.unionByName(_edge(t, c("tc_id"), cluster_id(c("cluster")), F.lit("tests"), "test_case"))
    gated = t.select("tc_id", F.explode(R.gates(F.concat_ws(" ", _text("purpose"), _text("prerequisites"), _text("setup"), "_steps"))).alias("g"))
    return out.unionByName(_edge(gated, c("tc_id"), c("g"), F.lit("gated_by_pics"), "test_case")).distinct()


def case_layer(test_cases: DataFrame, entities: DataFrame, requirements: DataFrame | None = None) -> Layer:
    """Nodes of test cases, with title, role and texts as properties, their edges, and nodes of the codes that gate them.

    Protocol families without a cluster belong to a virtual cluster of their prefix.
    """
    c = F.col
    p = L.prefix(c("tc_id"))
    virtual = (F.coalesce(c("cluster"), F.lit("")) == "") & (p != "")
    t = test_cases.withColumn("cluster", F.when(virtual, F.concat(F.lit("VirtualCluster-"), p)).otherwise(c("cluster")))
    more = {x: c(x) for x in ("title", "purpose", "mode", "dut_type", "source_doc") if x in t.columns}
    nodes = _node(t, c("tc_id"), F.lit("test_case"), _text("title"), c("cluster"), "test_plan", intents=F.array_join(_list("intents"), "|"), steps=F.left(F.array_join(F.slice(_list("procedure_steps"), 1, 20), "\n"), F.lit(2500)), **more)
    edges = case_edges(t, entities, requirements)
    gates = edges.filter("edge_type = 'gated_by_pics'").select(c("dst").alias("g")).distinct()
    nodes = nodes.unionByName(_node(gates, c("g"), F.lit("pics_item"), F.split_part("g", F.lit("::"), F.lit(2)), F.lit(""), "test_plan"))
    own = t.filter(c("cluster").startswith("VirtualCluster-")).select("cluster").distinct()
    area = F.try_element_at(F.create_map(*[F.lit(x) for kv in V.AREA_OF_PREFIX.items() for x in kv]), F.substring_index("cluster", "-", -1))
    nodes = nodes.unionByName(_node(own, cluster_id(c("cluster")), F.lit("cluster"), c("cluster"), c("cluster"), "virtual", area=area))
    return Layer(nodes, edges)


def graph(*layers: Layer) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of layers in their order: the first node of an id; each (src, dst, edge_type) once, the first origin;
    and a virtual node for each cluster that an edge points to and no layer has."""
    nodes = reduce(DataFrame.unionByName, [x.nodes.withColumn("seq", F.lit(i)) for i, x in enumerate(layers) if x.nodes is not None])
    edges = reduce(DataFrame.unionByName, [x.edges.withColumn("seq", F.lit(i)) for i, x in enumerate(layers) if x.edges is not None])
    rest = [x for x in nodes.columns if x not in ("node_id", "seq")]
    # maps can't be compared, so a row's other columns go as JSON to settle ties of one layer
    nodes = nodes.groupBy("node_id").agg(F.min_by(F.struct(*rest), F.struct("seq", "node_type", "label", "cluster", F.to_json("props"))).alias("x")).select("node_id", "x.*")
    edges = edges.groupBy("src", "dst", "edge_type").agg(F.min_by("origin", F.struct("seq", "origin")).alias("origin"))
    lost = edges.filter(F.col("dst").startswith("CLUSTER::")).select(F.col("dst").alias("node_id")).distinct().join(nodes.select("node_id"), "node_id", "left_anti")
    name = F.expr("substring(node_id, 10)")
    return nodes.unionByName(_node(lost, F.col("node_id"), F.lit("cluster"), name, name, "virtual")), edges


_LINKS = ("tests", "covers", "validates", "verifies_attribute", "tests_command", "observes_event", "verifies_requirement", "verifies_rule")
_SPEC_LINKS = ("covers", "validates", "verifies_requirement", "verifies_rule")


def problems(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(problem, node_id, detail): orphan requirements and test cases, dangling ends, requirements without an area and test
    cases without a requirement.  Each check is an anti-join."""
    out = lambda df, kind: df.select(F.lit(kind).alias("problem"), "node_id", F.lit("").alias("detail"))
    src = lambda *kinds: edges.filter(F.col("edge_type").isin(*kinds)).select(F.col("src").alias("node_id")).distinct()
    reqs, cases = nodes.filter("node_type in ('requirement', 'behavior_rule')"), nodes.filter("node_type = 'test_case'")
    found = [
        out(reqs.join(src("implements", "belongs_to", "BELONGS_TO_PROTOCOL_AREA"), "node_id", "left_anti"), "orphan_requirement"),
        out(cases.join(src(*_LINKS), "node_id", "left_anti"), "orphan_test_case"),
        out(reqs.join(src("BELONGS_TO_PROTOCOL_AREA"), "node_id", "left_anti"), "requirement_without_area"),
        out(cases.join(src(*_SPEC_LINKS), "node_id", "left_anti"), "test_case_without_requirement"),
    ]
    ids = nodes.select("node_id")
    for end in ("src", "dst"):
        lost = edges.withColumn("node_id", F.col(end)).join(ids, "node_id", "left_anti")
        found.append(lost.select(F.lit(f"dangling_{end}").alias("problem"), "node_id", F.concat_ws(" ", "src", "edge_type", "dst").alias("detail")))
    return reduce(DataFrame.unionByName, found)
