"""Requests on the graph against plain loops."""

import random

from quillgraph.operators import requests as Q

COLUMNS = "request_id long, kind string, cluster string, entity_type string, entity_name string, keywords array<string>, direction string, most int"
SPECS = {"requirement", "behavior_rule"}


def norm(c):
    return (c or "").lower().replace(" cluster", "").strip()


def by_loop(request, nodes, edges):
    """(status, of, node_id) in order."""
    _, kind, cluster, etype, name, given, direction, most = request
    cluster, name, etype = (cluster or "").strip().lower(), (name or "").strip(), (etype or "").strip().lower() or "attribute"
    words = [w.strip().lower() for w in given or [] if w and w.strip()]
    kinds = {n[0]: n[1] for n in nodes}
    test = lambda i: kinds.get(i) == "test_case"
    own = [w for w in words if w not in Q.PLAIN_WORDS]
    phrase = " ".join(own[:3]) if own else words[0] if words else ""
    if kind not in Q.NEEDS:
        return [("unknown", None, None)]
    if not {"cluster": cluster, "phrase": phrase, "entity_name": name, "words": words}[Q.NEEDS[kind][0]]:
        return [("invalid", None, None)]

    def scored(types):
        rows = []
        for i, t, _, c, text in nodes:
            n = sum(w in (text or "").lower() for w in set(words))
            if t in types and n and (not cluster or cluster in (c or "").lower()):
                rows.append((-n, i))
        return [i for _, i in sorted(rows)]

    out = []
    if kind == "cluster_tests":
        k = norm(cluster)
        near = lambda n: n and k and (n in k or k in n)
        found = {i for i, t, _, c, _ in nodes if t == "test_case" and near(norm(c))}
        of = {i for i, t, label, _, _ in nodes if t == "cluster" and near(norm(label))}
        out = [("found", None, i) for i in sorted(found | {s for s, d, e in edges if d in of and e in Q.OF_CLUSTER and test(s)})]
    elif kind == "phrase_tests":
        out = [("found", None, i) for i, t, _, _, text in sorted(nodes) if t == "test_case" and phrase in (text or "").lower()]
    elif kind == "entity_coverage":
        label = {i: n for i, t, n, _, _ in nodes if t == "cluster"}
        base = sorted(label[d].lower() for s, d, e in edges if e == "alias_of" and s in label and d in label and label[s].lower() == cluster)
        c = base[0] if base else cluster
        probes = [(n.lower() != c, i, f"{etype.upper()}::{n}::{name}") for i, n in label.items() if c and c in n.lower()]
        probes = [p for p in sorted(probes) if p[2] in kinds]
        any_ = sorted(i for i, t, n, _, _ in nodes if t == etype and n.lower() == name.lower())
        of = probes[0][2] if probes else any_[0] if any_ else None
        tests = sorted({s for s, d, e in edges if d == of and e in Q.OF_ENTITY and test(s)})
        out = [("covered", of, i) for i in tests] or [("gap" if of else "missing", of, None)]
    elif kind == "requirements":
        for of in scored(SPECS)[:20]:
            tests = sorted({s for s, d, e in edges if d == of and e == "verifies_requirement" and test(s)})[:5]
            out += [("covered", of, i) for i in tests] or [("uncovered", of, None)]
    elif kind == "dependencies":
        targets = {i for i, t, label, _, _ in nodes if t == "cluster" and cluster in label.lower()}
        ends = [(s, d) if direction == "outgoing_depends_on" else (d, s) for s, d, e in edges if e in Q.DEPENDS]
        out = [("found", None, i) for i in sorted({b for a, b in ends if a in targets and b not in targets and kinds.get(b) == "cluster"})]
    else:
        out = [("found", None, i) for i in scored({*SPECS, "test_case"})[: min(30, 10 if most is None else max(0, most))]]
    return out or [("none", None, None)]


def graph(rng):
    names = ["On/Off", "Door Lock Cluster", "Door", "Level Control Cluster", "Fan Cluster", "Level"]
    word = lambda: rng.choice("reset time lock level fan open value a".split())
    nodes = [(f"CLUSTER::{n}", "cluster", n, "", n) for n in names]
    nodes += [(f"ATTRIBUTE::{n}::A{i}", "attribute", f"A{i}", n, "x") for n in names for i in range(3) if rng.random() < 0.7]
    text = lambda: " ".join(word() for _ in range(6)).title()
    nodes += [(f"TC::{i}", "test_case", f"t{i}", rng.choice([*names, "", None]), rng.choice([text(), text(), None])) for i in range(40)]
    nodes += [(f"REQ::{i}", rng.choice(["requirement", "behavior_rule"]), f"r{i}", rng.choice([*names, ""]), text()) for i in range(60)]
    ids = [n[0] for n in nodes]
    kinds = [*Q.OF_ENTITY, *Q.DEPENDS, "in_context", "verifies_requirement", "verifies_requirement", "other"]
    edges = [(rng.choice(ids), rng.choice(ids), rng.choice(kinds)) for _ in range(600)] + [("CLUSTER::Door", "CLUSTER::Level", "alias_of"), ("TC::1", "gone", "tests")]
    c = [i for i in ids if i.startswith("CLUSTER")]
    nodes.append(("COMMAND::Fan Cluster::B", "command", "B", "Fan Cluster", "x"))
    return nodes, edges + [(rng.choice(c), rng.choice(c), rng.choice(Q.DEPENDS)) for _ in range(12)]


def test_answers_by_loop(spark):
    rng = random.Random(11)
    nodes, edges = graph(rng)
    some = lambda *x: rng.choice(x)
    requests = []
    for i in range(150):
        words = some(None, [], ["Reset", "time"], ["test", "lock"], ["level", None, " ", "fan", "value", "a"], ["tc"], ["nowhere"])
        cluster = some(None, "", "door", "Door Lock", "On/Off Cluster", "level", "no such", "fan cluster", "cluster")
        kind = some(*Q.NEEDS, *Q.NEEDS, "other", None)
        requests.append((i, kind, cluster, some("attribute", "Attribute", None, "command"), some("A0", "a1", "A2", "", None, "B"), words, some(None, "outgoing_depends_on", "incoming_depends_on"), some(None, 3, 100, -1)))
    requests.append(requests[0])
    n = spark.createDataFrame([(*x, 0) for x in nodes], "node_id string, node_type string, label string, cluster string, text string, of int")
    e = spark.createDataFrame(edges, "src string, dst string, edge_type string")
    rows = Q.answered(spark.createDataFrame(requests, COLUMNS), n.drop("of"), e.union(e)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.request_id, r["at"] or 0)):
        got.setdefault(r.request_id, []).append((r.status, r.of, r.node_id))
    want = {r[0]: by_loop(r, nodes, edges) for r in requests}
    assert [x for x in got[0] if got[0].count(x) != 2] == []
    got[0] = got[0][::2]
    assert got == want
    assert {s for a in want.values() for s, _, _ in a} == {"unknown", "invalid", "none", "found", "covered", "uncovered", "gap", "missing"}


def test_plans_become_requests_and_empty_tables(spark):
    rows = [("list_test_cases", "Door", None), ("list_test_cases", "", None), ("entity_coverage", "Door", "A0"), ("entity_coverage", "Door", None), ("requirement_lookup", None, None), ("graph_traversal", "Door", None), ("graph_traversal", None, None), ("general_qa", "Door", None), ("odd", None, None), (None, None, None)]
    plans = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "request_id long, intent string, cluster string, entity_name string")
    kinds = [r.kind for r in Q.planned(plans).orderBy("request_id").collect()]
    assert kinds == ["cluster_tests", "phrase_tests", "entity_coverage", "keywords", "requirements", "dependencies", "keywords", "keywords", "keywords", "keywords"]
    n, e = spark.createDataFrame([], "node_id string, node_type string, label string, cluster string, text string"), spark.createDataFrame([], "src string, dst string, edge_type string")
    one = spark.createDataFrame([(1, "keywords", None, None, None, ["x"], None, None)], COLUMNS)
    assert [tuple(r) for r in Q.answered(one, n, e).collect()] == [(1, "none", None, None, None)]
    assert Q.answered(one.limit(0), n, e).collect() == []


def test_requests_that_ask_the_same_are_one_question(spark):
    row = lambda i, kind, name, words: (i, kind, "Door", "attribute", name, words, "outgoing_depends_on", i)
    rows = [row(i, k, f"n{i}", ["a", f"w{i}"]) for i, k in enumerate(["cluster_tests", "dependencies"] * 3)] + [row(9, "keywords", "x", ["b", "a"]), row(9, "keywords", "y", ["a", "b", "a"]), row(8, "keywords", "y", ["a", "b"])]
    r = spark.createDataFrame(rows, "request_id long, kind string, cluster string, entity_type string, entity_name string, keywords array<string>, direction string, most int")
    bodies = {}
    for x in Q._bodies(r).collect():
        bodies.setdefault(x.kind, set()).add(x.body)
    assert {k: len(v) for k, v in bodies.items()} == {"cluster_tests": 1, "dependencies": 1, "keywords": 2}


def test_requests_of_an_answer_come_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 8, raising=False)
    monkeypatch.setattr(Q, "SHARE", 16, raising=False)
    nodes = [(f"TC::{i:03}", "test_case", f"t{i}", "Door", "x") for i in range(130)]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, label string, cluster string, text string"), spark.createDataFrame([], "src string, dst string, edge_type string")
    r = spark.createDataFrame([(i, "cluster_tests", "door", None, None, None, None, None) for i in range(40)] + [(None, "cluster_tests", "door", None, None, None, None, None)], COLUMNS)
    parts = Q.answered(r, n, e).rdd.map(lambda x: (x.request_id, x["at"], x.node_id)).glom().collect()
    assert sorted(((a, c, b) for p in parts for b, a, c in p), key=str) == sorted(((i + 1, x[0], k) for i, x in enumerate(nodes) for k in [None, *range(40)]), key=str)
    assert sum(a[2] != b[2] for p in parts for a, b in zip([(0, 0, ""), *p], p, strict=False)) == 130
    assert max(map(len, parts)) < 41 * 65


def test_edges_that_no_question_asks_for_are_not_written(spark, monkeypatch):
    kept, real = [], Q._pointing
    monkeypatch.setattr(Q, "_pointing", lambda *x: kept.append(real(*x)) or kept[-1])
    nodes = [("CLUSTER::Door", "cluster", "Door", "", "x"), ("CLUSTER::Fan", "cluster", "Fan", "", "x"), ("TC::1", "test_case", "t1", "", "x")]
    edges = [("TC::1", "CLUSTER::Door", "tests"), ("TC::1", "CLUSTER::Fan", "tests"), ("TC::1", "CLUSTER::Door", "covers"), ("CLUSTER::Fan", "CLUSTER::Door", "requires"), ("TC::1", None, "tests"), ("TC::1", "CLUSTER::Door", None)]
    n, e = spark.createDataFrame(nodes, "node_id string, node_type string, label string, cluster string, text string"), spark.createDataFrame(edges, "src string, dst string, edge_type string")
    r = spark.createDataFrame([(1, "cluster_tests", "door", None, None, None, None, None)], COLUMNS)
    assert [tuple(x) for x in Q.answered(r, n, e).collect()] == [(1, "found", 1, None, "TC::1")]
    assert sorted(map(tuple, kept[0].collect())) == [("CLUSTER::Fan", "CLUSTER::Door", "requires"), ("TC::1", "CLUSTER::Door", "tests")]
