"""Substring tables, structured changes, node ids and ego graphs against plain loops."""

import random

import pytest

from quillgraph.operators import search as S
from quillgraph.operators import trigrams as G


def test_contained(spark):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("abé ") for _ in range(n))
    needles = [word(r.randint(1, 6)) for _ in range(150)] + ["", None, "a", "zzz", "b", "b"]
    texts = [word(r.randint(0, 25)) for _ in range(150)] + ["", None, "a", "a"]
    n, t = spark.createDataFrame([(x,) for x in needles], "needle string"), spark.createDataFrame([(x,) for x in texts], "text string")
    got = [tuple(x) for x in G.contained(n, t).collect()]
    want = {(a, b) for a in needles if a for b in texts if b is not None and a in b}
    assert len(got) == len(set(got)) and set(got) == want
    ways = {(x.a, x.b, x.inside) for x in G.either_way(n.withColumnRenamed("needle", "a"), t.withColumnRenamed("text", "b")).collect()}
    assert ways == {(a, b, a in b) for a in needles if a for b in texts if b and (a in b or b in a)}
    assert G.contained(n.filter("false"), t).isEmpty() and G.contained(n, t.filter("false")).isEmpty()
    plan = G.contained(n, t)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


NODES = [
    ("CLUSTER::Air", "cluster", "Air", None),
    ("CLUSTER::Air Quality", "cluster", "Air Quality", ""),
    ("CLUSTER::Dust", "cluster", "Dust", ""),
    ("ATTRIBUTE::Air::Level", "attribute", "Level", "Air"),
    ("ATTRIBUTE::Air Quality::LevelMax", "attribute", "LevelMax", "Air Quality"),
    ("ATTRIBUTE::X::Lone", "attribute", "Lone level", ""),
    ("REQ::1", "requirement", "keeps the level", "Air"),
    ("REQ::2", "requirement", "other cluster", "Water"),
    ("REQ::3", "requirement", "no cluster", ""),
    ("TC::1", "test_case", "reads level", "Air Quality"),
    ("TC::2", "test_case", "reads water", "Water"),
    ("TC::3", "test_case", "part of the name", "ir"),
    ("SECTION::1", "section", "on air", "Air"),
    *[(f"SECTION::{i}", "section", "more", "Air Quality") for i in range(2, 9)],
]
EDGES = [
    ("TC::1", "ATTRIBUTE::Air::Level", "tests"),
    ("TC::2", "ATTRIBUTE::Air::Level", "tests"),
    ("TC::3", "ATTRIBUTE::Air::Level", "tests"),
    ("REQ::1", "TC::1", "tests"),
    ("REQ::2", "TC::1", "tests"),
    ("REQ::3", "ATTRIBUTE::Air Quality::LevelMax", "implements"),
    ("ATTRIBUTE::Air::Level", "CLUSTER::Air", "belongs_to"),
    ("CLUSTER::Dust", "CLUSTER::Air", "alias_of"),
]


@pytest.fixture(scope="module")
def graph(spark):
    return spark.createDataFrame(NODES, "node_id string, node_type string, label string, cluster string"), spark.createDataFrame(EDGES, "src string, dst string, edge_type string")


def plain_search(change, most=10):
    """One change with loops over all nodes."""
    _, cluster, kind, name = change
    cluster, kind, name = (cluster or "").lower(), (kind or "").lower(), name or ""
    node = {n[0]: n for n in NODES}
    for s, d, t in EDGES:
        if t == "alias_of" and node[s][2].lower() == cluster:
            cluster = node[d][2].lower()
    seeds = set()
    if len(name) >= 3 and name.lower() not in S.V.GENERIC_NAMES:
        matched = sorted(i for i, t, label, _ in NODES if t == "cluster" and cluster and cluster in label.lower())
        if matched and f"{kind.upper()}::{node[matched[0]][2]}::{name}" in node:
            seeds.add(f"{kind.upper()}::{node[matched[0]][2]}::{name}")
        else:
            seeds |= set(sorted(i for i, t, label, c in NODES if t == kind and name.lower() in label.lower() and (not cluster or not c or cluster in c.lower()))[:20])
        seeds |= set(matched)
    if not seeds:
        wanted = {w for w in S_words(" ".join(x or "" for x in change[1:]))}
        hits = [(-len(wanted & S_words(label)), i) for i, t, label, _ in NODES if t in ("test_case", "requirement") and wanted & S_words(label)]
        return {(i, "text") for _, i in sorted(hits)[:most]}
    near = {}
    for s, d, _ in EDGES:
        near.setdefault(s, set()).add(d)
        near.setdefault(d, set()).add(s)
    found = set()
    for s in seeds:
        for i in {s} | near.get(s, set()) | {y for x in near.get(s, set()) for y in near[x]}:
            _, t, _, c = node[i]
            c = (c or "").lower()
            if t == "requirement" and (not cluster or not c or cluster in c) or t == "test_case" and (not cluster or not c or cluster in c or c in cluster):
                found.add(i)
    found |= set(sorted(i for i, t, _, c in NODES if t == "section" and cluster and c and cluster in c.lower())[: max(3, most // 3)])
    return {(i, "graph") for i in sorted(found)[:most]}


def S_words(text):
    import re

    spaced = re.sub("([a-z])([A-Z])", r"\1 \2", text or "").lower()
    return {w for w in re.split("[^a-z0-9]+", spaced) if len(w) >= 3 and w not in S.V.GENERIC_NAMES}


def test_structured_search(spark, graph):
    changes = [(1, "Air", "attribute", "Level"), (2, "", "attribute", "level"), (3, "Dust", "Attribute", "Level"), (4, "Air Quality", "attribute", "Max"), (5, "Fire", "attribute", "Water"), (6, None, None, None), (7, "Air", "event", "mode"), (8, "Nowhere", "command", "level reads"), (9, "Air", "attribute", "ab")]
    df = spark.createDataFrame(changes, "change_id long, cluster string, entity_type string, entity_name string")
    for most in (10, 4):
        found = S.structured_search(df, *graph, most=most).collect()
        got = {c[0]: {(x.node_id, x.source) for x in found if x.change_id == c[0]} for c in changes}
        assert got == {c[0]: plain_search(c, most) for c in changes}
        assert len(found) == sum(map(len, got.values()))
    tiers = {(x.change_id, x.node_id, x.tier) for x in S.seeds(df, *graph).collect()}
    assert (1, "ATTRIBUTE::Air::Level", 1) in tiers and (3, "ATTRIBUTE::Air::Level", 1) in tiers
    assert (2, "ATTRIBUTE::X::Lone", 2) in tiers and (4, "ATTRIBUTE::Air Quality::LevelMax", 2) in tiers
    assert S.structured_search(df.filter("false"), *graph).isEmpty()
    plan = S.structured_search(df, *graph)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_resolved_ids(spark, graph):
    names = ["TC::1", "tc::1", "cluster::air", "CLUSTER::Air Q", "level", "nothing", "", None, "TC::1"]
    got = {x.name: (x.node_id, x.tier) for x in S.resolved_ids(spark.createDataFrame([(n,) for n in names], "name string"), graph[0]).collect()}
    assert got == {
        "TC::1": ("TC::1", 1),
        "tc::1": ("TC::1", 2),
        "cluster::air": ("CLUSTER::Air", 2),
        "CLUSTER::Air Q": ("CLUSTER::Air Quality", 3),
        "level": ("ATTRIBUTE::Air::Level", 4),
        "nothing": (None, None),
    }


def plain_ego(seed, nodes, edges, hops, fan, hub):
    near = {}
    for s, d, _ in edges:
        near.setdefault(s, set()).add(d)
        near.setdefault(d, set()).add(s)
    info = {n[0]: (n[1], (n[3] or "").lower()) for n in nodes}
    of, found, front = info[seed][1], {seed: 0}, {seed}
    for h in range(1, hops + 1):
        reached = set()
        for x in front:
            if h > 1 and len(near.get(x, ())) > hub:
                continue
            fits = [y for y in near.get(x, ()) if not of or not info[y][1] or info[y][1] == of or info[y][0] == "cluster"]
            fits.sort(key=lambda y: (len(near.get(y, ())), y))
            reached |= set(fits if h == 1 else fits[:fan])
        front = reached - set(found)
        found |= dict.fromkeys(front, h)
    return {(seed, n, h) for n, h in found.items()}


def test_ego_with_a_hub(spark):
    """Most edges are one node's."""
    r = random.Random(4)
    nodes = [(f"n{i}", r.choice(["test_case", "cluster", "section"]), "x", r.choice(["", "A", "B"])) for i in range(120)] + [("hub", "section", "x", "")]
    edges = [("hub", f"n{i}", "e") for i in range(120)] + [(f"n{r.randrange(120)}", f"n{r.randrange(120)}", "e") for _ in range(90)]
    edges = [e for e in edges if e[0] != e[1]]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, label string, cluster string"), spark.createDataFrame(edges, "src string, dst string, edge_type string")
    seeds = [f"n{i}" for i in range(0, 120, 9)] + ["hub"]
    for hops, fan, hub in ((2, 20, 50), (4, 2, 500)):
        got = {tuple(x) for x in S.ego(spark.createDataFrame([(s,) for s in seeds], "node_id string"), n, e, hops, fan, hub).collect()}
        assert got == {t for s in seeds for t in plain_ego(s, nodes, edges, hops, fan, hub)}


def test_long_needles_meet_few_texts(spark):
    from pyspark.sql import functions as F

    from quillgraph.operators import trigrams

    texts = spark.range(2000).select("id", F.concat(F.lit("order tc::"), 10**11 + F.col("id") * 7919).alias("text"))
    asked = texts.select(F.lit(12).alias("size"), F.xxhash64(F.right("text", F.lit(12))).alias("gram"))
    assert trigrams._postings(texts, asked).groupBy("gram").count().agg(F.max("count")).first()[0] == 1
    pairs = trigrams.contained(texts.select(F.right("text", F.lit(14)).alias("needle")), texts.select("text"))
    assert pairs.count() == 2000 and pairs.filter("not contains(text, needle)").isEmpty()
