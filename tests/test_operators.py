import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import batching, changes, entities, graph, model, rerank, rules, vectors
from quillgraph.sources import adoc, datamodel, files, html
from quillgraph.streaming import ingest


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column).first()[0]


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, T.tokens(t), "OnOff cluster, on/off") == ["on", "off", "cluster", "on", "off"]
    assert one(spark, T.flat_name(t), "On/Off Cluster") == "onoffcluster"
    assert one(spark, T.section_depth(t), "4.2.1 Title") == 3
    assert one(spark, T.section_depth(t), "Title") == 0
    assert one(spark, T.drop_block(t, "BEGIN", "END"), "a\nBEGIN\nb\nEND\nc\nBEGIN\nd") == "a\nc"
    assert one(spark, T.sentences(t), "One thing. Two 1.5 things.\nthree") == ["One thing.", "Two 1.5 things.", "three"]
    assert one(spark, T.char_windows(t), "") == []
    assert [c.start for c in one(spark, T.char_windows(t), "x" * 900)] == [0, 800]
    assert one(spark, T.ignore(t, "note", "startswith", "line", False), "Note: a\nb") == "b"
    assert one(spark, T.ignore(t, "x", "contains", "paragraph"), "ax\n\nb") == "b"
    with pytest.raises(ValueError):
        T.ignore(t, "a", "sounds like")
    with pytest.raises(ValueError):
        T.ignore(t, "a", scope="page")


def test_domain_rules(spark):
    d = spark.createDataFrame([("The server SHALL respond within 5 seconds if the command succeeds.",), ("Hello there.",)], "text string")
    rows = rules.classify(d, "text", rules.DOMAIN).collect()
    # timing 4, raised by the condition
    assert rows[0].requirement_type == "timing_requirement" and rows[0].score == 4.0
    assert rows[1].requirement_type == "general_normative" and rows[1].confidence == 1.0


def test_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8])], "vec_id int, v array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id int, q array<double>")
    assert [(r.vec_id, r["rank"]) for r in vectors.search(q, v, 2).orderBy("rank").collect()] == [(1, 1), (3, 2)]
    assert vectors.search(q, v, 2, 0.9).count() == 1
    assert one(spark, vectors.inner(vectors.normalised(F.array(F.lit(3), F.lit(4))), F.array(F.lit(1), F.lit(0))), "") == pytest.approx(0.6)


def test_graph(spark):
    e = spark.createDataFrame([("a", "b", "in_context", 0), ("a", "b", "tests", 1), ("b", "c", "reads", 2), ("x", "y", "other", 3)], "src string, dst string, edge_type string, seq int")
    n = spark.createDataFrame([(x, "t", 0) for x in "abcxy"], "node_id string, node_type string, seq int")
    assert {(r.src, r.edge_type) for r in graph.collapsed(e).collect()} == {("a", "tests"), ("b", "reads"), ("x", "other")}
    assert {(r.node_id, r.comp) for r in graph.components(n, e).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    seeds = spark.createDataFrame([("a", "a")], "seed string, node string")
    assert {(r.node, r.hop) for r in graph.reachable(seeds, e.select("src", "dst"), 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert graph.dangling(n.filter("node_id <> 'y'"), e).count() == 1


def test_components_of_long_chains(spark):
    """A chain 1-n-(n-1)-...-2, on which least labels move one edge a round; ends that are no nodes join nothing."""
    n = 60
    chain = ["a001", *[f"a{i:03}" for i in range(n, 1, -1)]]
    e = spark.createDataFrame([*zip(chain, chain[1:]), ("b1", "lost"), ("lost", "b2"), ("c1", "c1")], "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in [*chain, "b1", "b2", "c1"]], "node_id string")
    want = {x: "a001" for x in chain} | {x: x for x in ("b1", "b2", "c1")}
    assert sorted(map(tuple, graph.components(nodes, e).collect())) == sorted(want.items())


def test_rerank_and_batches(spark):
    d = spark.createDataFrame([(1.0, 0.5)], "entity double, lexical double")
    r = d.select(*[c.alias(k) for k, c in rerank.combined({"entity": F.col("entity"), "lexical": F.col("lexical")}).items()]).first()
    assert r.final_score == 0.29
    items = spark.createDataFrame([("g", 7, 1), ("g", 5, 2), ("g", 20, 3), ("g", 1, 4), ("h", None, 5), ("h", 10, 6)], "g string, size long, id long")
    got = {(r.g, r.id, r.bin) for r in batching.packed(items, "g", ["id"], "size", 10, "id").collect()}
    assert got == {("g", 1, 0), ("g", 2, 1), ("g", 3, 2), ("g", 4, 3), ("h", 5, 0), ("h", 6, 0)}


def test_entities(spark):
    docs = spark.createDataFrame([(1, "Reads the OnTime Attribute twice"), (2, "nothing")], "id int, text string")
    names = spark.createDataFrame([("E1", "OnTime Attribute", "OnOff"), ("E2", "twice", "OnOff"), ("E3", "Description", "OnOff")], "entity_id string, name string, cluster string")
    assert [(r.key, r.entity_id) for r in entities.matched(docs, "id", "text", names).collect()] == [(1, "E1")]
    t = spark.createDataFrame([("t", "e", "attribute", ["read", "write"]), ("t", "c", "command", [])], "tc_id string, entity_id string, entity_type string, intents array<string>")
    got = entities.typed_edges(t, {"write": {"attribute": "writes"}, "read": {"attribute": "reads"}}, {"command": "tests_command"}).collect()
    assert {(r.entity_id, r.edge_type) for r in got} == {("e", "reads"), ("c", "tests_command")}


@pytest.mark.parametrize("small", [entities.SMALL, -1])
def test_entities_of_any_length(spark, small, monkeypatch):
    """A whole dictionary of several hundred names of 1 to 9 tokens against brute force, with and without clusters, with
    the dictionary broadcast and shuffled."""
    monkeypatch.setattr(entities, "SMALL", small)
    r = random.Random(3)
    vocabulary = "on off level minimum temperature setpoint week day schedules supported per user mode".split()
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = [(i, say(400), r.choice(["A", "b", "", None])) for i in range(12)]
    texts.append((12, "the number of week day schedules supported per user".split(), ""))
    names = [(f"E{i}", say(1 + i % 9) if i % 2 else (t := texts[i % 12][1])[(j := r.randrange(380)) : j + 1 + i % 9], "aBC"[i % 3]) for i in range(400)]
    names = [(e, "".join(x.title() for x in w) if i % 3 else " ".join(w), c) for i, (e, w, c) in enumerate(names)]
    names.append(("W", "NumberOfWeekDaySchedulesSupportedPerUser", "D"))
    split = lambda x: " ".join(re.findall("[a-z0-9]+", re.sub("([a-z])([A-Z])", r"\1 \2", x).lower()))
    clusters = {}
    for _, n, c in names:
        clusters.setdefault(n.lower(), set()).add(c)
    d = spark.createDataFrame([(i, " ".join(w), c) for i, w, c in texts], "id int, text string, cluster string")
    n = spark.createDataFrame(names, "entity_id string, name string, cluster string")

    def allowed(name, cluster, own, never):
        low = name.lower()
        if low in never:
            return False
        if own and cluster.lower() == own.lower():
            return True
        return low not in entities.V.NEEDS_CLUSTER and len(clusters[low]) == 1 and len(name) >= 7

    want = lambda ctx, never=entities.BLOCKED: {(i, e, c) for i, w, own in texts for e, name, c in names if f" {split(name)} " in f" {' '.join(w)} " and allowed(name, c, own if ctx else "", never)}
    assert {tuple(x) for x in entities.matched(d, "id", "text", n).collect()} == want(False)
    assert {tuple(x) for x in entities.matched(d, "id", "text", n, "cluster").collect()} == want(True) > want(False)
    assert (12, "W", "D") in want(False)
    free = entities.matched(d, "id", "text", n, "cluster", ()).collect()
    assert {tuple(x) for x in free} == want(True, ()) > want(True)


def test_html():
    page = "<style>x</style><p>intro<h1>A</h1><p>one<p>two<h2>B</h2><table><tr><td>1<td>2</table><ul><li>i<li>j</ul><h1>C</h1><p>x <del>old</del><ins class='diff-chg'>new</ins>"
    s = html.sections(page)
    assert [(x.level, x.title, x.path) for x in s] == [(0, "", []), (1, "A", ["A"]), (2, "B", ["A", "B"]), (1, "C", ["C"])]
    assert s[1].blocks == [("paragraph", "one"), ("paragraph", "two")] and s[2].rows == [["1", "2"]]
    assert s[3].blocks == [("paragraph", "x [CHANGED: old → new]")]
    assert html.sections(None) == [] and html.clean("") == ""


PLAN = """= Plan
:ver: 2
== TC-OO-1.1 On and off {ver}
=== Purpose
Checks it.
=== PICS
* OO.S
* OO.S.A0000
=== Test Procedure
|===
| # | Action | Expected
| 1 | Read OnOff | Value
| 2 | Toggle | Done
|===
== TC-OO-1.2 Other
=== Procedure
1. First
2. Second
== Appendix
x
"""


def test_adoc():
    a, b = adoc.cases(PLAN)
    assert (a.tc_id, a.prefix, a.steps, a.codes) == ("TC-OO-1.1", "OO", ["Read OnOff", "Toggle"], ["OO.S", "OO.S.A0000"])
    assert [r["expected"] for r in a.records] == ["Value", "Done"]
    assert b.steps == ["First", "Second"] and a.parts["purpose"] == "Checks it."
    new = adoc.replaced(PLAN, "TC-OO-1.2", "== TC-OO-1.2 New")
    assert "First" not in new and "Appendix" in new and adoc.replaced("x", "TC-A-1.1", "y").endswith("y\n")
    assert "On and off 2" in adoc.attributes(PLAN) and adoc.attributes("{no}") == "{no}"


XML = """<configurator><cluster name="Base"><attributes><attribute id="0x0" name="A" type="int8"><mandatoryConform/></attribute>
<attribute id="0x1" name="B" type="bool"/></attributes></cluster><cluster name="Derived"><classification baseCluster="Base"/>
<attribute name="A"><access read="true"/></attribute></cluster></configurator>"""


def test_datamodel(spark):
    rows = datamodel.entities(XML)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} string" for k in rows[0]))
    got = {(r.cluster, r.name): r for r in datamodel.inherited(df).collect()}
    assert got["Derived", "A"].datatype == "int8" and got["Derived", "A"].conformance == "M"
    assert got["Derived", "B"].datatype == "bool" and len(got) == 4
    assert datamodel.entities("<broken") == []


def test_changes():
    parts = changes.hunks("--- a\n+++ b\n@@ -1 +1 @@\n-old\n+new\n@@ -9 +9 @@\n+== Head\n+more")
    assert [p.changes for p in parts] == [["ADDED", "REMOVED"], ["ADDED"]]
    kept, rejected = changes.paragraphs("short\n\n" + "long " * 30)
    assert len(kept) == 1 and rejected == ["short"]


def test_model(spark):
    assert model.json_object('x ```json\n{"a": [1,]}\n``` y') == {"a": [1]}
    assert model.json_object('{"a": {"b": 1') == {"a": {"b": 1}} and model.json_object("none") is None
    d = spark.createDataFrame([("A test. More",), (None,)], "t string")
    assert [r.reply.verdict for r in model.complete(d, F.col("t"), "verdict string").collect()] == ["covered", "gap"]


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text("hé", encoding="utf-8")
    (tmp_path / "a" / "y.txt").write_bytes("hé".encode("latin-1"))
    (tmp_path / "z.bin").write_text("no")
    rows = files.read(spark, {"type": "local_folder", "path": str(tmp_path)}).collect()
    assert {(r.ext, r.content) for r in rows} == {("md", "hé"), ("txt", "hé")}
    (tmp_path / "t.csv").write_text("id,title\n1,a\n2,\n")
    assert [r.content for r in files.read(spark, {"type": "csv", "path": str(tmp_path / "t.csv")}).collect()] == ["id: 1 | title: a", "id: 2"]
    with pytest.raises(ValueError):
        files.read(spark, {"type": "carrier pigeon"})
    assert files.resolved({"a": ["${X}", "${Y}"]}, {"X": "1"}) == {"a": ["1", "${Y}"]}
    (tmp_path / "s.json").write_text(json.dumps([{"type": "csv"}]))
    assert files.source_list(str(tmp_path / "s.json")) == [{"type": "csv"}] and files.source_list("/nowhere") == []


def test_incremental(spark, tmp_path):
    schema, target = "doc_id long, text string", str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema).write.parquet(str(tmp_path / "in"))
    ingest.ingest(spark, str(tmp_path / "in"), schema, target, str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(4, "b"), (5, "c")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.ingest(spark, str(tmp_path / "in"), schema, target, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(target).collect()) == [1, 3, 5]
