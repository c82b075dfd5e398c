"""The domain's operators on fixtures: rules, re-ranking, linking, graphs, diffs, plans, codes, stores, sinks, settings."""

import pytest
from pyspark.sql import functions as F

from quillgraph import config
from quillgraph.functions import text as T
from quillgraph.operators import audits, batching, build, changes, chunks, codes, extract, graph, linking, prompts, rerank, rules, store
from quillgraph.sources import adoc, datamodel, diff, files, sinks

LIST = "array<string>"


def rows(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


SENTENCES = [
    ("The server shall respond within 900 seconds over BLE.", "timing_requirement"),
    ("The device shall enter the On state.", "state_transition_rule"),
    ("The attribute indicates the current level.", "entity_definition_changed"),
    ("The value shall be in the range 0 to 254.", "value_constraint"),
    ("If Occupancy is false, it shall not be sent.", "conditional_behavior_rule"),
    ("The feature depends on another entity.", "cross_entity_dependency"),
    ("The node must be kept.", "general_normative"),
]


def test_requirement_types(spark):
    d = spark.createDataFrame([(i, s, []) for i, (s, _) in enumerate(SENTENCES)] + [(99, "The node must be kept.", ["ATTRIBUTE::A::x", "COMMAND::B::y"])], f"id int, s string, refs {LIST}")
    got = {r.id: r for r in rules.typed(d, "s", "refs").collect()}
    assert [got[i].requirement_type for i in range(len(SENTENCES))] == [t for _, t in SENTENCES]
    assert got[99].requirement_type == "cross_entity_dependency" and got[99].signals == ["cross_entity_dep"]
    # 4 for timing, 0.5 for the protocol's word, 1 for the baseline
    assert got[0].score_breakdown["timing_requirement"] == 4.5 and got[0].confidence == pytest.approx(4.5 / 5.5) and not got[0].ambiguous
    assert got[6].confidence == 1.0 and got[6].alternatives == []


REJECTED = [
    ("It is.", "too_short"),
    ("SHALL | A key word that indicates a rule of the text", "glossary_row"),
    ("one | two | three and nothing else that says something", "table_fragment"),
    ("desc, that is the conformance of a feature in the table", "conformance_table_cell"),
    ("12 | Device Manufacturer shall have it in its table", "numeric_table_row"),
    ("element in the list, the new value shall be taken", "lowercase_fragment"),
    ("Shall be set to the value that was written before it", "modal_fragment_no_subject"),
    ("The server shall send the report to the client with the", "incomplete_tail_fragment"),
    ("This field SHALL indicate the state that the lamp has", "entity_definition"),
]


def test_rejections_and_rescues(spark):
    d = spark.createDataFrame([(s, None) for s, _ in REJECTED], "sentence string, title string")
    got = {r.sentence: r.verdict for r in rules.filtered(d, "sentence", "title").collect()}
    assert got == dict(REJECTED)
    rescued = [
        ("It shall be kept.", "1. A", "It shall be kept."),
        ("SHALL be kept here.", "1.2. Effect", "Effect: SHALL be kept here."),
        ("Shall be set to the value that was written before it", "4.1. Reset", "Reset: Shall be set to the value that was written before it"),
        ("a | b | The commissioner is required to show a message", "", "The commissioner is required to show a message"),
    ]
    d = spark.createDataFrame([r[:2] for r in rescued], "sentence string, title string")
    assert rows(rules.filtered(d, "sentence", "title"), "verdict", "requirement") == {("valid", r[2]) for r in rescued}


def test_intents_clauses_and_edges(spark):
    d = spark.createDataFrame([("TH reads the attribute, verifies the response and waits for a timeout.",), ("If the lamp is on, the server shall send it at most twice.",)], "t string")
    got = d.select(rules.test_intents(F.col("t")).alias("i"), *[c.alias(k) for k, c in rules.clause_texts(F.col("t")).items()]).collect()
    assert got[0].i == ["read_attribute", "validate_timing"]
    assert got[1].conditions == ["the lamp is on"] and got[1].effects == ["send it at most twice"] and got[1].constraints == ["at most twice"]
    e = spark.createDataFrame([("OnTime has a range. Level has a default.", "OnTime"), ("Level has a default", "Level"), ("nothing", "x")], "t string, n string")
    assert [r[0] for r in e.select(rules.validation_edge(F.col("t"), F.col("n"))).collect()] == ["validates_range", "validates_default", "verifies_attribute"]
    names = spark.createDataFrame([("ATTRIBUTE::A::OccupancyState", "OccupancyState", "A")], "entity_id string, name string, cluster string")
    texts = spark.createDataFrame([("p", "The advertisement shall terminate after 900 seconds. The OccupancyState must be true. No rule here.")], "id string, t string")
    found = rules.change_requirements(texts, "t", "id", names).orderBy("pos").collect()
    assert [(r.requirement_type, r.inferred_cluster, r.entity_refs) for r in found] == [("timing_requirement", None, ["PROTO::Discovery"]), ("general_normative", "A", ["ATTRIBUTE::A::OccupancyState"])]
    assert found[0].keywords == ["advertisement", "900", "seconds"]


CHANGES = f"change_id string, change_kind string, cluster string, entities {LIST}, conditions {LIST}, effects {LIST}, query_text string"
CANDIDATES = f"change_id string, candidate_id string, test_case_id string, chunk_type string, title string, text string, score double, cluster string, entities {LIST}, intents {LIST}"


def test_rerank(spark):
    ch = spark.createDataFrame([("c", "MODIFY_BEHAVIOR", "On/Off", ["OnTime", "GlobalScene"], ["when OnTime is zero"], ["the OffWait event"], "the OnTime timer stops")], CHANGES)
    ca = spark.createDataFrame(
        [
            ("c", "1", "TC-A", "intent_summary", "A", "ontime timer", 0.9, "OnOff", ["OnTime"], ["validate_behavior_rule"]),
            ("c", "2", "tc-a", "setup", "A", "nothing", 0.1, "Other", [], []),
            ("c", "3", "TC-B", "full", "B", "Global Scene recall", 2.0, "Level", None, None),
            ("c", "4", "TC-C", None, None, None, None, None, None, None),
        ],
        CANDIDATES,
    )
    hits = spark.createDataFrame([("c", "tc-a", False), ("c", "TC-A", True), ("c", "TC-B", False)], "change_id string, test_case_id string, direct boolean")
    got = {r.test_case_id: r for r in rerank.rerank(ch, ca, hits).collect()}
    a, b = got["TC-A"], got["TC-B"]
    assert set(got) == {"TC-A", "TC-B", "TC-C"} and [got[x]["rank"] for x in ("TC-A", "TC-B", "TC-C")] == [1, 2, 3]
    # one of two entities is declared
    assert (a.w_entity, a.w_cluster, a.w_direct, a.w_indirect, a.w_chunk, a.w_retrieval) == (0.125, 0.15, 0.2, 0.0, 0.05, 0.036)
    # OnTime, of OnTime and OffWait, is declared; and an intent checks behaviour
    assert a.w_condition == pytest.approx(0.15 * 0.6) and a.w_intent == pytest.approx(0.15 / 5)
    assert a.w_lexical == pytest.approx(0.08 * 4 / 5, abs=1e-4) and "direct link" in a.reason
    # both parts of one of two names are words of the text; the score is cut at 1; the link is indirect
    assert b.w_entity == pytest.approx(0.25 * 0.15) and (b.w_indirect, b.w_retrieval, b.w_chunk) == (0.08, 0.04, 0.025)
    assert got["TC-C"].w_chunk == 0.025 and got["TC-C"].final_score == 0.025
    assert a.final_score == pytest.approx(sum(a[x] for x in a.asDict() if x.startswith("w_")))
    assert rerank.rerank(ch, ca.filter("false"), hits).count() == 0
    tests = spark.createDataFrame([("TC-A", "X"), ("TC-Z", "Y"), ("TC-B", "Q")], "test_case_id string, cluster string")
    alias = spark.createDataFrame([("CLUSTER::Y", "CLUSTER::X", "alias_of")], "src string, dst string, edge_type string")
    assert rows(rerank.siblings(rerank.rerank(ch, ca, hits), tests, alias), "test_case_id", "of") == {("TC-Z", "TC-A")}


REQS = f"req_id string, requirement_type string, cluster string, section_id string, section_path string, normative_text string, entity_refs {LIST}, confidence double"
TESTS = f"tc_id string, title string, cluster string, purpose string, setup string, prerequisites string, procedure_steps {LIST}, entity_refs {LIST}, spec_refs {LIST}, intents {LIST}, pics_codes {LIST}, dut_type string"


def case(tc, title="", cluster="", purpose="", setup="", pre="", steps=None, refs=None, spec=None, intents=None, pics=None, dut=""):
    return (tc, title, cluster, purpose, setup, pre, steps or [], refs or [], spec or [], intents or [], pics or [], dut)


@pytest.fixture(scope="module")
def reqs(spark):
    return spark.createDataFrame(
        [
            ("REQ::On/Off::0", "timing_requirement", "On/Off", "S1", "1. On/Off Cluster > 1.1. OnTime Attribute", "It shall stop after a factory reset.", ["ATTRIBUTE::On/Off::OnTime"], 0.9),
            ("REQ::On/Off::1", "conditional_behavior_rule", "On/Off", "S2", "1. On/Off Cluster > 1.2. Toggle Command", "If so, it shall toggle.", [], 0.5),
            ("REQ::Level::0", "general_normative", "Level", "S3", "2. Level > 2.1. OnTime Attribute", "It shall.", ["ATTRIBUTE::Level::OnTime"], 0.5),
            ("REQ::0", "general_normative", "", "S4", "3. Secure Channel > 3.1. Session Establishment", "It shall.", None, 0.5),
        ],
        REQS,
    )


def test_linking(spark, reqs):
    t = spark.createDataFrame(
        [
            case("TC-OO-1.1", cluster="On/Off", refs=["ATTRIBUTE::On/Off::OnTime"]),
            case("TC-OO-1.2", cluster="on/off cluster", steps=["TH sends Toggle to DUT"]),
            case("TC-OO-1.3", title="About the toggle thing", cluster="On/Off"),
            case("TC-OO-1.4", title="zzz", cluster="On/Off"),
            # tier 1 finds a requirement of another cluster only, so 1.5 isn't tried and the whole cluster is left
            case("TC-OO-1.5", cluster="On/Off", refs=["ATTRIBUTE::Level::Gone"]),
            case("TC-SC-1.1", title="Session establishment"),
            case("TC-SC-1.2", title="zzz"),
        ],
        TESTS,
    )
    got = rows(linking.linked(t, reqs), "tc_id", "req_id", "tier")
    both = ["REQ::On/Off::0", "REQ::On/Off::1"]
    assert got == {("TC-OO-1.1", both[0], 1.0), ("TC-OO-1.2", both[1], 1.5), ("TC-OO-1.3", both[1], 2.0)} | {(x, r, 3.0) for x in ("TC-OO-1.4", "TC-OO-1.5") for r in both}
    assert rows(linking.linked_protocol(t, reqs), "tc_id", "req_id", "tier") == {("TC-SC-1.1", "REQ::0", 2.0), ("TC-SC-1.2", "REQ::0", 3.0)}
    m = spark.createDataFrame([("TC-SC-1.2", None, "session est")], "tc_id string, word string, section string")
    assert ("TC-SC-1.2", "REQ::0", 1.0) in rows(linking.linked_protocol(t, reqs, m), "tc_id", "req_id", "tier")
    prefixes = spark.createDataFrame([("OO", "On/Off")], "prefix string, cluster string")
    names = spark.createDataFrame([("Level Control", "Level"), ("abc", "Z")], "name string, cluster string")
    t = spark.createDataFrame([case("TC-OO-1.1"), case("TC-XX-1.1", refs=["ATTRIBUTE::B::x", "ATTRIBUTE::A::y", "COMMAND::A::z"]), case("TC-YY-1.1", title="The Level Control of abc"), case("TC-SC-1.1", refs=["ATTRIBUTE::B::x"]), case("odd")], TESTS)
    assert rows(linking.inferred_clusters(t, prefixes, names), "tc_id", "cluster") == {("TC-OO-1.1", "On/Off"), ("TC-XX-1.1", "A"), ("TC-YY-1.1", "Level"), ("TC-SC-1.1", ""), ("odd", "")}
    s = spark.createDataFrame([("a", "d", 0, "On/Off Cluster", "1"), ("b", "d", 1, "Other", "1"), ("c", "d", 2, "X", "2 > Level Control"), ("e", "f", 0, "Y", None)], "section_id string, doc string, position int, title string, section_path string")
    cl = spark.createDataFrame([("On/Off",), ("Level Control",), ("Level",)], "name string")
    assert rows(linking.section_clusters(s, cl), "section_id", "cluster") == {("a", "On/Off"), ("b", "On/Off"), ("c", "Level Control"), ("e", None)}
    a = spark.createDataFrame([("Door Lock Cluster",), ("On/Off",), ("Nothing",)], "name string")
    b = spark.createDataFrame([("DoorLock",), ("On/Off",), ("On Off",)], "match string")
    assert rows(linking.schema_of_cluster(a, b), "name", "match", "tier") == {("Door Lock Cluster", "DoorLock", 3), ("On/Off", "On/Off", 1)}


ENTITIES = "entity_id string, entity_type string, name string, cluster string, code string, conformance string, summary string, direction string"


@pytest.fixture(scope="module")
def graph_of(spark, reqs):
    ents = spark.createDataFrame(
        [
            ("ATTRIBUTE::On/Off::OnTime", "attribute", "OnTime", "On/Off", "0x4001", "M", "", ""),
            ("COMMAND::On/Off::Toggle", "command", "Toggle", "On/Off", "0x02", "O", "", "commandToServer"),
            ("FEATURE::On/Off::LT", "feature", "LT", "On/Off", "0", "O", "Dependency with the Level cluster", ""),
            ("ATTRIBUTE::Level::OnTime", "attribute", "OnTime", "Level", "0x0001", "X", "", ""),
        ],
        ENTITIES,
    )
    clusters = spark.createDataFrame([("On/Off", "6", "1", "base", "", "OO"), ("Level", "8", "1", "base", "", "LVL"), ("Pump", "9", "1", "alias", "On/Off", "PMP")], "name string, code string, revision string, hierarchy string, base_cluster string, pics_code string")
    secs = spark.createDataFrame([("S1", "OnTime Attribute", "On/Off", "1. On/Off Cluster > 1.1. OnTime Attribute", "See section 1.2 and section 1.2, not section 1.1 or clause 9.9.", "d"), ("S2", "Toggle Command", "On/Off", "1. On/Off Cluster > 1.2. Toggle Command", "", "d")], "section_id string, title string, cluster string, section_path string, full_text string, source_doc string")
    tests = spark.createDataFrame(
        [
            case("TC-OO-1.1", "On", "On/Off", "PICS: OO.S.A4001", steps=["Reads OnTime in its range"], refs=["ATTRIBUTE::On/Off::OnTime", "COMMAND::On/Off::Toggle", "CLUSTER::Level"], spec=["REQ::On/Off::1"], intents=["validate_response"]),
            case("TC-SC-1.1", "Session", refs=["PROTO::Fabric"], spec=["REQ::0", "S1"], intents=["read_attribute"]),
            case("TC-OO-1.2", "Lone", "Gone"),
        ],
        TESTS,
    )
    layers = [build.schema_layer(clusters, ents), build.section_layer(secs), build.Layer(None, build.references(secs)), build.requirement_layer(reqs), build.area_layer(secs, reqs, clusters), build.case_layer(tests, ents, reqs)]
    nodes, edges = build.graph(*layers)
    return nodes.cache(), edges.cache(), ents, clusters, tests


def test_graph_build(graph_of):
    nodes, edges, *_ = graph_of
    kinds = dict(rows(nodes, "node_id", "node_type"))
    assert len(kinds) == nodes.count()
    assert kinds["REQ::On/Off::1"] == "behavior_rule" and kinds["BEHAVIOR::Device_Reset"] == "behavior" and kinds["PICS::OO.S.A4001"] == "pics_item"
    assert kinds["CLUSTER::VirtualCluster-SC"] == "cluster" and kinds["CLUSTER::Gone"] == "cluster"
    e = rows(edges, "src", "edge_type", "dst")
    assert {
        ("CLUSTER::On/Off", "HAS_ATTRIBUTE", "ATTRIBUTE::On/Off::OnTime"),
        ("CLUSTER::Pump", "alias_of", "CLUSTER::On/Off"),
        ("CLUSTER::On/Off", "depends_on", "CLUSTER::Level"),
        ("S1", "references", "S2"),
        ("S1", "references", "CLUSTER::On/Off"),
        ("REQ::On/Off::0", "implements", "ATTRIBUTE::On/Off::OnTime"),
        ("REQ::On/Off::1", "implements", "CLUSTER::On/Off"),
        ("REQ::On/Off::0", "BELONGS_TO_PROTOCOL_AREA", "PROTOCOL_AREA::On_Off_Cluster"),
        ("CLUSTER::On/Off", "BELONGS_TO_PROTOCOL_AREA", "PROTOCOL_AREA::On_Off_Cluster"),
        ("TC-OO-1.1", "validates_range", "ATTRIBUTE::On/Off::OnTime"),
        ("TC-OO-1.1", "tests_command", "COMMAND::On/Off::Toggle"),
        ("TC-OO-1.1", "tests", "CLUSTER::Level"),
        ("TC-OO-1.1", "verifies_rule", "REQ::On/Off::1"),
        ("TC-OO-1.1", "gated_by_pics", "PICS::OO.S.A4001"),
        ("TC-SC-1.1", "in_context", "PROTO::Fabric"),
        ("TC-SC-1.1", "verifies_requirement", "REQ::0"),
        ("TC-SC-1.1", "in_context", "S1"),
        ("TC-SC-1.1", "tests", "CLUSTER::VirtualCluster-SC"),
        ("BEHAVIOR::Device_Reset", "HAS_BEHAVIOR_RULE", "REQ::On/Off::0"),
    } <= e
    assert ("S1", "references", "S1") not in e
    p = rows(build.problems(nodes, edges), "problem", "node_id")
    assert ("dangling_dst", "PROTO::Fabric") in p and ("test_case_without_requirement", "TC-OO-1.2") in p
    assert not any(k == "orphan_requirement" for k, _ in p)


def test_graph_queries(spark, graph_of):
    nodes, edges, _, _, tests = graph_of
    cover = {r.req_id: (r.covered, r.covering) for r in graph.coverage(nodes, edges).collect()}
    # by the shared attribute, by an edge, not at all, by an edge
    assert cover == {"REQ::On/Off::0": (True, ["TC-OO-1.1"]), "REQ::On/Off::1": (True, ["TC-OO-1.1"]), "REQ::Level::0": (False, []), "REQ::0": (True, ["TC-SC-1.1"])}
    assert {r.req_id for r in graph.coverage(nodes, edges, reading=False).filter("covered").collect()} == {"REQ::On/Off::1", "REQ::0"}
    ch = spark.createDataFrame([("a", "ATTRIBUTE::On/Off::OnTime", "constraint_changed"), ("b", "ATTRIBUTE::On/Off::OnTime", "access_changed"), ("c", "CLUSTER::Level", "access_changed"), ("d", "FEATURE::On/Off::LT", "access_changed"), ("e", "none", "access_changed")], "change_id string, target string, kind string")
    assert {r.change_id: (r.verdict, r.direct, r.possible) for r in graph.typed_impact(ch, nodes, edges).collect()} == {"a": ("direct", ["TC-OO-1.1"], []), "b": ("none", [], []), "c": ("possible", [], ["TC-OO-1.1"]), "d": ("gap", [], []), "e": ("unknown", [], [])}
    assert ("CLUSTER::Pump", "CLUSTER::On/Off") in rows(graph.bases(nodes, edges), "node_id", "base")
    hits = graph.keyword_search(nodes, ["toggle", "stop"], F.concat_ws(" ", "label", F.col("props").getItem("normative_text")), kinds=("timing_requirement",))
    assert rows(hits, "node_id", "score") == {("REQ::On/Off::0", 2)}
    asked = spark.createDataFrame([("cluster::on/off",), ("On Time",), ("nowhere",)], "name string")
    found = {r.name: (r.node_id, r.tier) for r in graph.resolved(asked, nodes).collect()}
    assert found == {"cluster::on/off": ("CLUSTER::On/Off", 2), "On Time": ("ATTRIBUTE::Level::OnTime", 3), "nowhere": (None, None)}
    seeds = spark.createDataFrame([("ATTRIBUTE::On/Off::OnTime",)], "node_id string")
    near = rows(graph.around(seeds, nodes, edges), "node_id", "hop")
    assert ("TC-OO-1.1", 1) in near and ("REQ::On/Off::0", 1) in near and not any(x == "REQ::Level::0" for x, _ in near)
    assert ("CLUSTER::Level", "CLUSTER::On/Off", "in", 1, True) in rows(graph.dependencies(edges), "cluster", "other", "direction", "n", "strong")
    assert graph.bleed(nodes, edges).filter("cluster = 'CLUSTER::Level'").first().foreign == 1
    items = spark.createDataFrame([("a", "X", ["p", "q"]), ("b", "Y", ["q", "p", "p"]), ("c", "Y", ["p"]), ("d", "X", ["p", "q"])], f"item_id string, cluster string, keywords {LIST}")
    assert rows(graph.topics(items), "item_id", "topic") == {("a", "a"), ("b", "a"), ("d", "a")}
    prefixes = spark.createDataFrame([("OO", "On/Off")], "prefix string, cluster string")
    m = {(r.tc_id, r.check): r.status for r in audits.mapping(tests, nodes, edges, prefixes).collect()}
    assert m["TC-OO-1.1", "cluster"] == "PASS" and m["TC-OO-1.2", "cluster"] == "FAIL" and m["TC-SC-1.1", "dangling"] == "FAIL" and m["TC-OO-1.1", "overall"] == "WARN"
    assert rows(audits.assignments(tests, prefixes), "tc_id", "finding") == {("TC-OO-1.2", "wrong_cluster")}
    table = {r.node_id: r for r in sinks.node_table(nodes, edges).collect()}
    assert table["TC-OO-1.1"].cluster_tests == 1 and not table["TC-OO-1.1"].orphan
    assert ("PROTO::Fabric", True) in rows(sinks.edge_table(nodes, edges), "dst", "dangling")
    assert sinks.node_link(nodes, edges).count() == nodes.count() + edges.count() == sinks.dot(nodes, edges).count()
    _, kept = sinks.subgraph(nodes, edges, seeds)
    assert kept.count() == 0


def test_codes(spark, graph_of):
    *_, ents, clusters, _ = graph_of
    schema = codes.code_schema(clusters, ents).cache()
    assert ("PMP", "S", "A", 0x4001, "OnTime", True, False) in rows(schema, "prefix", "side", "kind", "entity_id", "name", "mandatory", "disallowed")
    asked = [("OO.S.A4001(OnTime)", True, ""), ("OO.S.C02.Rsp", True, ""), ("OO.S.A9999", False, "unknown_id"), ("BLE.S.A0000", True, "unknown_cluster"), ("oo", False, "invalid_format"), ("LVL.S.F05", False, "unknown_id")]
    d = spark.createDataFrame([(a,) for a, *_ in asked], "code string")
    assert rows(codes.validated(d, schema), "code", "valid", "error_type") == set(asked)
    t = spark.createDataFrame([case("a", pics=["OO.S", "OO.C.A4001", "OO.S.A9999"], dut="server"), case("b", purpose="uses OO.S.C02", dut="client"), case("c", pics=["LVL.S.A0001", "XX.S.A0001"])], TESTS)
    assert rows(codes.findings(t, schema), "tc_id", "code", "finding") == {("a", "OO.C.A4001", "wrong_side"), ("a", "OO.S.A9999", "non_existent"), ("b", "OO.S.C02", "dut_type_mismatch")}
    assert "S.A: 4001 OnTime (M)" in codes.schema_text(schema).filter("prefix = 'OO'").first().text


DIFF = """<div class='sect1'><h2>1. Clusters</h2><div class='sectionbody'><div class='sect2'><h3>1.5. On/Off Cluster</h3>
<div class='sect3'><h4>1.5.1. Text</h4><p>a <del class='diff-old'>x</del> <ins class='diff-chg'>y</ins> b <del class='diff-old'>same</del><ins class='diff-chg'>same</ins><del class='diff-old'>z</del></p></div>
<div class='sect3'><h4>1.5.2. <ins class='diff-new'>Fresh</ins></h4><p>plain words</p></div>
<div class='sect3'><h4>1.5.3. Refs</h4><p><del class='diff-old'>[1.247]</del><ins class='diff-chg'>[1.253]</ins></p></div>
<div class='sect3'><h4>Revision History</h4><p><ins class='diff-new'>n</ins></p></div>
<div class='sect3'><h4>1.5.4. Attributes</h4><table><tr><th>ID</th><th>Name</th><th>Type</th></tr><tr><td>0x0</td><td>OnOff</td><td>bool</td></tr>
<tr><td><ins class='diff-new'>0x1</ins></td><td><ins class='diff-new'>OnTime</ins></td><td><ins class='diff-new'>uint16</ins></td></tr>
<tr><td>0x2</td><td>Wait</td><td><del class='diff-old'>uint8</del><ins class='diff-chg'>uint16</ins></td></tr></table></div></div></div></div>"""


def test_diff_html(spark):
    pages = spark.createDataFrame([("p", DIFF), ("q", None), ("r", "<div class='sect2'><h3>T<p>open")], "path string, content string")
    got = {r.title: r for r in diff.changed_sections(pages).collect()}
    assert set(got) == {"1.5.1. Text", "1.5.2. Fresh", "1.5.4. Attributes"}
    assert got["1.5.1. Text"].text == "1.5.1. Text a [CHANGED: x → y] b [REMOVED: z]" and got["1.5.1. Text"].cluster == "On/Off Cluster"
    assert got["1.5.2. Fresh"].is_new and "[ADDED: plain words]" in got["1.5.2. Fresh"].text
    assert diff.only_renumbered("see [CHANGED: [1.247] → [1.253]]") and not diff.only_renumbered("no marks")
    assert diff.changed_sections(pages, section="fresh").count() == 1 and diff.changed_sections(pages, cluster="level").count() == 0
    found = {r.cells["name"]: (r.entity_type, r.status, r.old_cells) for r in diff.changed_rows(pages).collect()}
    assert found == {"OnTime": ("attribute", "added", {}), "Wait": ("attribute", "changed", {"type": "uint8"})}
    assert diff.changed_rows(pages, diff_only=False).count() == 3


def test_structured_changes(spark):
    cases_ = [
        ("+== Door Lock Cluster", "", "", ("ADD_CLUSTER", [], 0.9, False)),
        ("This attribute specifies it. [ADDED: Q]", "OnOff", "OnTime Attribute", ("QUIETER_REPORTING_CHANGED", ["OnTime"], 1.0, False)),
        ("x [CHANGED: M → O]", "", "OnTime Attribute", ("CONFORMANCE_CHANGED", ["OnTime"], 0.9, False)),
        ("x [CHANGED: uint16 → int32]", "A", "Attributes", ("DATATYPE_CHANGED", [], 0.85, False)),
        ("+| 0x0001 | OnTime | uint16 |", "A", "Attributes", ("ADD_ATTRIBUTE", ["OnTime"], 0.75, False)),
        ("[ADDED: a new command Toggle]", "A", "Commands", ("ADD_COMMAND", ["Toggle"], 0.9, False)),
        ("[REMOVED: gone]", "", "Events", ("REMOVE_EVENT", [], 0.65, False)),
        ("[CHANGED: Foo now → Bar later]", "", "", ("MODIFY_BEHAVIOR", ["Foo"], 0.9, False)),
        ("nothing", "A", "", ("UNKNOWN", [], 0.2, True)),
        (None, None, None, ("UNKNOWN", [], 0.2, True)),
    ]
    d = spark.createDataFrame([(i, t, c, s, []) for i, (t, c, s, _) in enumerate(cases_)], f"i int, text string, c string, s string, h {LIST}")
    got = {r.i: r for r in changes.structured(d, "text", "c", "s", "h").collect()}
    for i, (_, _, _, want) in enumerate(cases_):
        assert (got[i].change_kind, got[i].entities, got[i].confidence, got[i].ambiguous) == want, cases_[i]
    assert (got[2].old_value, got[2].new_value, got[2].conditions) == ("M", "O", ["conformance: M → O"])
    assert got[1].new_value == "Q" and got[1].conditions == ["quality: Quieter Reporting (Q) added"]
    reply = F.struct(F.lit("MODIFY_EVENT").alias("change_kind"), F.lit("Z").alias("cluster"), F.array(F.lit("E")).alias("entities"), F.lit(None).cast(LIST).alias("conditions"), F.lit(None).cast("string").alias("old_value"), F.lit("v").alias("new_value"), F.lit(0.8).alias("confidence"), F.lit(None).cast("boolean").alias("ambiguous"))
    m = {r.i: r for r in changes.merged(changes.structured(d, "text", "c", "s", "h").withColumn("reply", reply)).collect()}
    assert (m[8].change_kind, m[8].entities, m[8].confidence, m[8].ambiguous) == ("MODIFY_EVENT", ["E"], 0.8, False) and m[2].entities == ["OnTime", "E"]
    parts = changes.change_chunks(spark.createDataFrame([("a", "@@ -1 +1 @@\n-old\n+new"), ("b", None), ("c", "p " * 60)], "path string, content string")).collect()
    assert [(p.id, p.change_types) for p in parts] == [("a", ["ADDED", "REMOVED"]), ("c", [])]


PLAN = """= Plan
== TC-OO-1.1 On and off
=== Description
Checks it.
NOTE: beware
=== PICS
* OO.S.A0000
=== Test Environment
* A lamp
  that is on
* A switch
=== Required Device
* Lamp (the DUT)
=== Topology
One hop
=== Steps
|===
| Step # | Test Step | Expected Outcome | PICS

| 1
| Read OnOff
  again
| Value is TRUE
| OO.S.A0000

| 2
| Toggle
|
|
|===
== TC-OO-1.2 Other
=== Procedure
1. First
   more
* Expected: Done
2. Second
=== Odd
x
"""


def test_plans(spark):
    f = spark.createDataFrame([("a", PLAN), ("b", None), ("c", "no cases")], "path string, content string")
    r = {x.tc_id: x for x in adoc.test_cases(f).collect()}
    a, b = r["TC-OO-1.1"], r["TC-OO-1.2"]
    assert (a.purpose, a.pics, a.preconditions, a.device_topology, a.notes) == ("Checks it.\nNOTE: beware", ["OO.S.A0000"], ["A lamp that is on", "A switch"], "One hop", ["beware"])
    assert [(s.step_no, s.text, s.expected, s.pics) for s in a.test_steps] == [(1, "Read OnOff again", "Value is TRUE", ["OO.S.A0000"]), (2, "Toggle", "", [])]
    assert [(s.step_no, s.text, s.expected) for s in b.test_steps] == [(1, "First more", "Done"), (2, "Second", "")]
    assert [tuple(d) for d in a.required_devices] == [("Lamp", "the DUT")]
    c = {(x.tc_id, x.chunk_type): x.text for x in adoc.case_chunks(adoc.test_cases(f)).collect()}
    assert set(k for t, k in c if t == "TC-OO-1.2") == {"primary", "test_steps"} and len(c) == 10
    assert c["TC-OO-1.1", "test_steps"].startswith("1. Read OnOff again\n   Expected: Value is TRUE")
    assert ("tc", "TC-OO-1.1", "a") in rows(adoc.index(adoc.test_cases(f)), "kind", "key", "path")
    u = spark.createDataFrame([("a", "TC-OO-1.2", "== TC-OO-1.2 New", 1), ("a", "TC-OO-1.2", "late", 2), ("c", "TC-Z-1.1", "== TC-Z-1.1", 3)], "path string, tc_id string, text string, seq int")
    new = {x.path: x.content for x in adoc.updated(f, u).collect()}
    assert "First" not in new["a"] and "New" in new["a"] and "late" not in new["a"] and new["c"].endswith("== TC-Z-1.1\n")
    assert adoc.sections(f).filter("path = 'a'").count() == 11


def test_chunks(spark):
    t = spark.createDataFrame([case("TC-1", "Title", "C", "Why", steps=["1. Commission DUT over BLE", "Perform Factory Reset"], refs=["A::b::OnTime"], pre="p"), case("TC-2", "T2", steps=["Sentence one. " * 150])], TESTS)
    got = {r.chunk_id: r for r in chunks.vector_chunks(t, cap=500).collect()}
    assert got["TC-1::full"].text == "Test Case: TC-1\n\nTitle: Title\n\nCluster: C\n\nPurpose: Why\n\nPrerequisites: p\n\nProcedure:\n  1. 1. Commission DUT over BLE\n  2. Perform Factory Reset"
    assert got["TC-1::setup"].text == "[TC-1] Title — Setup\n\nPrerequisites: p" and "TC-2::setup" not in got
    assert "Entities: OnTime" in got["TC-1::intent_summary"].text and "factory reset" in got["TC-1::intent_summary"].text and "commission dut" not in got["TC-1::intent_summary"].text
    parts = [r for r in got.values() if r.tc_id == "TC-2" and r.chunk_type == "procedure"]
    assert len(parts) == parts[0].parts > 3 and all(r.text.startswith(f"[TC-2] T2 —  (part {r.part}/{r.parts})") for r in parts)
    assert sum(r.text.count("Sentence one") for r in parts) == 150
    empty = spark.createDataFrame([("a\n\nb",), ("",)], "t string")
    assert [r[0] for r in empty.select(chunks.split_text(F.col("t"), 3)).collect()] == [["a", "b"], [""]]


def test_extraction(spark):
    secs = spark.createDataFrame([("S1", "1. Lamp", "A", "1. Lamp", "The OccupancyState shall be true within 5 seconds. Shall be kept for as long as it is on. It is."), ("S2", "2. X", None, "2. X", "The node must not reject what is required.")], "section_id string, title string, cluster string, section_path string, full_text string")
    names = spark.createDataFrame([("ATTRIBUTE::A::OccupancyState", "OccupancyState", "A")], "entity_id string, name string, cluster string")
    ok, bad = extract.requirements(secs, names)
    got = {r.req_id: r for r in ok.collect()}
    assert set(got) == {"REQ::A::0", "REQ::A::1", "REQ::0"} and bad.count() == 0
    assert got["REQ::A::0"].entity_refs == ["ATTRIBUTE::A::OccupancyState"] and got["REQ::A::1"].normative_text.startswith("Lamp: Shall")
    recs = spark.createDataFrame([("TC-OO-1.1", "Title", "Reads the OccupancyState", "", "", ["TH reads the attribute"], [], ["OO.S.A0000"])], f"tc_id string, title string, purpose string, setup string, prerequisites string, procedure_steps {LIST}, expected_outcomes {LIST}, pics_codes {LIST}")
    t = extract.test_cases(recs, names, spark.createDataFrame([("OO", "A")], "prefix string, cluster string")).first()
    assert (t.cluster, t.entity_refs, t.intents, t.dut_type) == ("A", ["ATTRIBUTE::A::OccupancyState"], ["read_attribute"], "server")


def test_store(spark, tmp_path):
    s = store.VectorStore(spark)
    with pytest.raises(ValueError):
        s.add_lists(["a"], [])
    s = s.add_lists(["a", "b", "c"], [[3.0, 0.0], [0.0, 2.0], [1.0, 1.0]], [{"tc_id": "T"}, {"tc_id": "U"}, {"tc_id": "T"}])
    q = spark.createDataFrame([(1, [1.0, 0.1])], "query_id int, embedding array<double>")
    hits = s.search(q, 2).orderBy("rank").collect()
    assert [(h["rank"], h.doc_id, h.text) for h in hits] == [(0, "doc_000000", "a"), (1, "doc_000002", "c")] and s.size() == 3
    assert s.search(q, 9).count() == 3 and s.search(q, 9, 0.9).count() == 1
    s.save(f"file://{tmp_path}/s")
    t = store.create(spark, {"type": "parquet", "path": f"file://{tmp_path}/s", "score": "half_distance"})
    assert t.search(q, 1).first().score == pytest.approx(1 - (1 - hits[0].score) / 2)
    assert rows(store.by_case(s.search(q)), "tc_id") == {("T",), ("U",)}
    assert store.VectorStore(spark).search(q).count() == 0
    with pytest.raises(ValueError):
        store.create(spark, {"type": "abacus"})
    docs = store.embedded(spark.createDataFrame([("x y",), ("z",), (None,)], "text string"), F.col("text"))
    own = store.VectorStore(spark).add(docs)
    asked = spark.createDataFrame([(7, "x y")], "query_id int, text string")
    assert own.search_texts(asked, 1).first().text == "x y"


def test_files_and_model(spark, tmp_path):
    (tmp_path / "a.md").write_text("keep\n# drop me\n\n\n\nend")
    (tmp_path / "b.adoc").write_text("pre\n== Head\nbody")
    (tmp_path / "draft.md").write_text("x")
    (tmp_path / "c.html").write_text("<h1>T</h1><p>text")
    (tmp_path / "d.xyz").write_text("plain")
    f = files.folder(spark, str(tmp_path), ("*",), "draft*")
    assert f.count() == 4
    out, errors = files.processed(f, [{"type": "strip_regex", "pattern": "drop", "apply_to": [".md"]}, {"type": "normalize_whitespace"}, {"type": "what"}, {"type": "replace_regex"}])
    by = {r.ext: r for r in out.collect()}
    assert by["md"].content == "keep\n\nend" and by["md"].rules_applied == 2 and by["xyz"].rules_applied == 1 and len(errors) == 2
    assert rows(files.loaded(f), "title", "level") >= {("Head", 2), ("T", 1), ("", 0)}
    d = spark.createDataFrame([(i, "v" * 40, None) for i in range(5)], "i int, a string, b string")
    assert rows(files.packed_rows(d, ["i"], ["a", "b"], 80), "chunk", "n_rows") == {(0, 2), (1, 2), (2, 1)}
    p = spark.createDataFrame([("x", "intro\n# One\na\n2.1 Two\nb"), ("y", None)], "path string, content string")
    assert rows(files.plain_sections(p), "path", "title", "text") == {("x", "", "intro"), ("x", "One", "a"), ("x", "2.1 Two", "b"), ("y", "", "")}
    xml = "<cluster name='A'><attribute name='x' id='0x1' type='int8'/><feature name='F'/></cluster>"
    alt = "<configurator><cluster><name>Z</name><define>Z</define><attribute code='0x2' type='int16u' writable='true' optional='true'>y</attribute></cluster></configurator>"
    m = datamodel.entity_rows(spark.createDataFrame([("p", xml), ("q", alt), ("r", "<no")], "path string, content string"))
    assert rows(m, "cluster", "name", "datatype", "conformance", "access") == {("A", "x", "int8", "", ""), ("A", "F", "", "", ""), ("Z", "y", "uint16", "O", "RW")}
    c = datamodel.canonical(m, spark.createDataFrame([("B", "A")], "name string, base string"))
    assert {r[0] for r in rows(c, "entity_id")} == {"ATTRIBUTE::A::x", "FEATURE::A::F", "ATTRIBUTE::Z::y", "ATTRIBUTE::B::x", "FEATURE::B::F"}
    assert datamodel.feature_conditions("<a><feature name='X'/><b><condition name='Y'/></b></a>") == ["Y", "X"]
    assert "attribute x (0x1)" in datamodel.cluster_texts(m).filter("cluster = 'A'").first().text


def test_settings_and_runs(tmp_path):
    (tmp_path / "c.yaml").write_text("search: {top_k: 5}\nname: ${WHO}")
    (tmp_path / "o.yaml").write_text("search: {threshold: 0.5}")
    s = config.settings(str(tmp_path / "c.yaml"), "o.yaml", {"WHO": "me", "QUILLGRAPH_SEARCH__TOP_K": "7", "QUILLGRAPH_SPEC_REPO__URL": "u"}, {"rerank": {"top_n": 3}})
    assert s["search"] == {"top_k": 7, "threshold": 0.5} and s["name"] == "me" and s["rerank"]["top_n"] == 3 and s["spec_repo"] == {"url": "u"}
    assert config.settings(str(tmp_path / "no.yaml"), env={})["search"]["top_k"] == 10

    def bad(_):
        raise config.Fatal("stop")

    r = config.run([("a", lambda s: {"x": 1}), ("b", lambda s: 1 / 0), ("c", bad), ("d", lambda s: {"y": 2})])
    assert r.state == {"x": 1} and [s["status"] for s in r.steps] == ["ok", "error", "fatal", "skipped"] and len(r.errors) == 2


def test_prompts_and_text(spark):
    s = spark.createDataFrame([("a", "4. X > 4.2. Y", "parent"), ("b", "4. X > 4.2. Y > 4.2.1. Z", "exact"), ("c", "9. Q", "far")], "section_id string, section_path string, full_text string")
    w = spark.createDataFrame([("1", "4.2.1"), ("2", "4.2.9"), ("3", "7")], "change_id string, number string")
    assert rows(prompts.sections_by_number(w, s), "change_id", "text") == {("1", "exact"), ("2", "parent")}
    p = spark.createDataFrame([("L", "4. X")], "label string, prefix string")
    assert rows(prompts.consolidated(s, p), "label", "n", "chars") == {("L", 2, 11)}
    d = spark.createDataFrame([("x" * 30, "y" * 30)], "a string, b string")
    text = d.select(prompts.assembled({"A": F.col("a"), "B": F.col("b"), "C": F.lit("")}, "A", 60)).first()[0]
    assert len(text) == 60 and text.count("y") == 30 and text.startswith("## A\nxx")
    r = prompts.routed(spark.createDataFrame([("11. Service > x",), ("q",)], "b string"), F.col("b"), [("11 service", "svc"), ("11", "any")])
    assert rows(r, "summary") == {("svc",), (None,)} and prompts.per_page(0) == 228 and prompts.per_page(60_000) == 10
    b = spark.createDataFrame([("g", i, "z" * 300) for i in range(4)], "g string, i int, t string")
    assert sorted(len(x.t) for x in batching.within_budget(b, "g", ["i"], "t", 800).collect()) == [300, 300]
    assert sorted(len(x.t) for x in batching.within_budget(b, "g", ["i"], "t", 850).collect()) == [250, 300, 300]
    sec = spark.createDataFrame([("d", 0, "A"), ("d", 1, "A > Revision history"), ("d", 2, "A > Revision history > z"), ("e", 0, "A > B")], "doc string, i int, path string")
    assert rows(batching.suppressed(sec, "doc", "i", "path", "(?i)revision history$"), "doc", "path") == {("d", "A"), ("e", "A > B")}
    n = spark.createDataFrame([("On/Off Cluster", "DoorLock")], "a string, b string")
    got = n.select(T.without_word(F.col("a")), T.without_suffix(F.col("a")), T.camel_key(F.col("a")), T.initials(F.col("a")), T.initials(F.col("b"), {"doorlock": "DRLK"})).first()
    assert tuple(got) == ("On/Off", "On/Off", "OnOffCluster", "OOC", "DRLK")
    text = "a\n[x\nb\ny]\nc\n[one]\nd\n[open\ne"
    assert [r[0] for r in spark.createDataFrame([(text,), ("[only\nx",), ("",)], "t string").select(T.drop_block(F.col("t"), "[", "]")).collect()] == ["a\nc\nd", "", ""]
