"""Steps whose rows or tasks have to grow no faster than the input, by their plans."""

from quillgraph.operators import graph as G
from quillgraph.operators import search as S
from quillgraph.operators.lineage import shares
from quillgraph.plans import graph_queries
from quillgraph.sources.revised import revised_clusters


def plan(df):
    return df._jdf.queryExecution().toString()


def test_coverage_keeps_the_first_tests_of_each_entity(spark):
    nodes = [(f"R{i:02d}", "requirement", "Door") for i in range(20)] + [(f"T{i:02d}", "test_case", "door cluster") for i in range(30)] + [("A", "attribute", "")]
    edges = [(f"R{i:02d}", "A", "implements") for i in range(20)] + [(f"T{i:02d}", "A", "reads") for i in range(30)] + [(f"T{i:02d}", "R03", "covers") for i in (29, 1)]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, cluster string"), spark.createDataFrame(edges, "src string, dst string, edge_type string")
    some, every = G.coverage(n, e), G.coverage(n, e, most=None)
    assert plan(some).count("WindowGroupLimit") > 0
    assert {r.req_id: r.covering for r in some.collect()} == {r.req_id: r.covering[:3] for r in every.collect()} == {f"R{i:02d}": ["T00", "T01", "T02"] for i in range(20)}


def test_changed_clusters_match_each_pattern_once(spark):
    pages = spark.createDataFrame([(1, "<h2 id=\"ref_A\">A Cluster</h2><ins class='x'>a</ins>")], "id long, html string")
    df = revised_clusters(pages, "id", "html")
    best = df._jdf.queryExecution().optimizedPlan().toString()
    assert best.count("20\\d{2}") == 1 and best.count("(.*?)</(?:ins|del)>") == 1
    assert [tuple(r) for r in df.collect()] == [(1, "A Cluster", 1)]


def test_dangling_edges_meet_only_lost_ends(spark):
    n = spark.createDataFrame([("a",), ("b",)], "node_id string")
    rows = [("a", "b", "t"), ("a", "x", "t"), ("a", "x", "t"), ("y", "b", "t"), ("y", "x", "u"), (None, "a", "t"), ("b", None, "t")]
    e = spark.createDataFrame(rows, "src string, dst string, edge_type string")
    lost = G.dangling(n, e)
    assert "LeftAnti" not in plan(lost) and sorted(map(str, map(tuple, lost.collect()))) == sorted(map(str, set(rows[1:])))
    whole = G.dangling(n, e.limit(1))
    assert whole.columns == e.columns and whole.isEmpty()


def shuffled(spark, df):
    """(rows of ``df``, rows that its stages shuffled)."""
    sc, gw = spark.sparkContext, spark.sparkContext._gateway
    stages = lambda: {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in list(gw.jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().statusStore().stageList(None, False, False, gw.new_array(gw.jvm.double, 0), None)))}
    before = stages()
    rows = df.collect()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return rows, sum(n for k, n in stages().items() if k not in before)


def test_pairs_by_a_hub_are_not_shuffled(spark):
    ends = [("hub", f"n{i}") for i in range(400)] + [(f"n{i}", f"n{i + 7}") for i in range(0, 90, 3)] + [("a", "n1"), ("a", "b"), ("b", "hub"), ("a", "a")]
    ends += [("busy", f"n{i}") for i in range(100)] + [("busy", "x")]
    e = G.undirected(spark.createDataFrame(ends, "src string, dst string"))
    near = {}
    for s, t in ends:
        near.setdefault(s, set()).add(t)
        near.setdefault(t, set()).add(s)
    want = []
    for i in range(100):
        front = seen = {f"n{i}"}
        want.append((f"n{i}", f"n{i}", 0))
        for h in (1, 2, 3):
            front = {t for s in front for t in near.get(s, ())} - seen
            seen = seen | front
            want += [(f"n{i}", t, h) for t in front]
    seeds = spark.createDataFrame([(f"n{i}", f"n{i}") for i in range(100)], "seed string, node string")
    for hops in (1, 2, 3):
        assert sorted(tuple(r) for r in G.reachable(seeds, e, hops).collect()) == sorted(r for r in want if r[2] <= hops)
    plain = G.undirected(spark.createDataFrame(ends[:400], "src string, dst string"))
    rows, n = shuffled(spark, G.reachable(seeds, plain, 2))
    assert len(rows) == 100 * 401 and n < len(rows) / 4


def test_tiers_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    df = spark.range(1000)
    assert [shares(df, 100), shares(df, 99), shares(df)] == [10, 11, 4]
    monkeypatch.setattr(graph_queries, "shares", lambda df: 9, raising=False)
    tiers = graph_queries.tiered_link(spark, "/root/testdata/sf0.001")
    assert tiers.rdd.getNumPartitions() == 9


def test_an_ego_graph_writes_edges_once_and_not_its_last_hop(spark, monkeypatch):
    nodes = [("R", "requirement", "Door"), ("C", "cluster", ""), *[(f"A{i}", "attribute", "door" if i % 2 else "Pump") for i in range(6)], *[(f"T{i:02d}", "test_case", "") for i in range(40)]]
    edges = [("R", f"A{i}") for i in range(6)] + [("R", "A1")] + [(f"A{i}", "C") for i in range(6)] + [(f"T{i:02d}", "A1") for i in range(40)] + [("T01", "A3"), ("R", None)]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, cluster string"), spark.createDataFrame(edges, "src string, dst string")
    written, cut = [], S.cut
    monkeypatch.setattr(S, "cut", lambda df, *x: written.append(df.columns) or cut(df, *x))
    got = sorted(tuple(r) for r in S.ego(n.filter("node_id = 'R'"), n, e, hops=2, fan=3).collect())
    # A1's neighbours of least degree: T00 and T02 have one edge, T01 and R's own have more
    assert got == sorted([("R", "R", 0), ("R", "A1", 1), ("R", "A3", 1), ("R", "A5", 1), ("R", "T00", 2), ("R", "T02", 2), ("R", "T03", 2), ("R", "T01", 2), ("R", "C", 2)])
    assert len(written) == 2


def test_a_change_search_deals_edges_once_by_the_end_walked_to(spark):
    nodes = [("CLUSTER::Door", "cluster", "Door", ""), *[(f"ATTRIBUTE::Door::Lock{i}", "attribute", f"Lock{i}", "Door") for i in range(4)], *[(f"TC::{i:03d}", "test_case", "x", "Door" if i % 2 else "Pump") for i in range(400)]]
    edges = [(f"TC::{i:03d}", f"ATTRIBUTE::Door::Lock{i % 4}", "tests") for i in range(400)] * 2 + [(f"ATTRIBUTE::Door::Lock{i}", "CLUSTER::Door", "belongs_to") for i in range(4)]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, label string, cluster string"), spark.createDataFrame(edges, "src string, dst string, edge_type string")
    ch = spark.createDataFrame([(1, "Door", "attribute", "Lock1"), (2, "Door", "attribute", "nothing")], "change_id int, cluster string, entity_type string, entity_name string")
    found = S.structured_search(ch, n, e)
    # of both changes the cluster is a seed, from which every test of its own cluster is two edges away
    assert sorted((r.change_id, r.node_id) for r in found.collect()) == sorted((c, f"TC::{i:03d}") for c in (1, 2) for i in range(1, 20, 2))
    limits = [x for x in plan(found).split("\n") if "WindowGroupLimit" in x and "dense_rank" in x]
    assert limits and all("seed" in x for x in limits)


def test_impact_counts_repeated_edges_once_and_deals_them_by_their_number(spark, monkeypatch):
    nodes = spark.createDataFrame([("T1", "test_case"), ("T2", "test_case"), ("R", "requirement"), ("A", "attribute"), ("B", "attribute")], "node_id string, node_type string")
    rows = [("T1", "A", "reads"), ("T1", "A", "reads"), ("T1", "A", "tests"), ("T2", "A", "tests"), ("R", "A", "reads"), ("R", "B", "reads")]
    edges = spark.createDataFrame(rows, "src string, dst string, edge_type string")
    changes = spark.createDataFrame([(1, "A", "datatype_changed"), (2, "B", "datatype_changed"), (3, "C", "access_changed"), (4, "A", "access_changed")], "change_id int, target string, kind string")
    monkeypatch.setattr(G, "shares", lambda df: 7)
    out = G.typed_impact(changes, nodes, edges)
    assert "hashpartitioning(src" in plan(out) and plan(out).count(", 7), REPARTITION_BY_NUM") >= 4
    assert {r.change_id: (r.verdict, r.direct, r.possible) for r in out.collect()} == {1: ("direct", ["T1"], ["T2"]), 2: ("gap", [], []), 3: ("unknown", [], []), 4: ("possible", [], ["T1", "T2"])}
