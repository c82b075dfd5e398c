"""Merging of proposals, against a merge one by one."""

import random

from quillgraph.operators import merge as M


def one_by_one(proposals, scopes):
    """Survivors by merging each proposal into the groups before it."""
    family = {k: f for k, f, _ in proposals}
    held = {k: {(e, s) for kk, _, e, s in scopes if kk == k and e is not None and s is not None} for k in family}
    groups = []
    for k in sorted(family):
        touched = [g for g in groups if any(family[m] == family[k] and held[m] & held[k] for m in g)]
        groups = [g for g in groups if g not in touched] + [sorted([k, *[m for g in touched for m in g]])]
    prefer = {k: (p is None, p or 0) for k, _, p in proposals}
    return {k: (min(g, key=lambda m: (prefer[m], -len(held[m]), m)), len(held[k])) for g in groups for k in g}


def told(scopes, survivors):
    out = {}
    for survivor in {s for s, _ in survivors.values()}:
        group = sorted(k for k, (s, _) in survivors.items() if s == survivor)
        rows = [(k != survivor, k, at, e, s) for k, at, e, s in scopes if k in group and e is not None and s is not None]
        seen = []
        for _, k, _, e, s in sorted(rows):
            if (e, s) not in [x[:2] for x in seen]:
                seen.append((e, s, k))
        out |= {(survivor, i): x for i, x in enumerate(seen)}
    return out


def run(spark, proposals, scopes):
    p = spark.createDataFrame(proposals, "key long, family string, prefer int")
    s = spark.createDataFrame(scopes, "key long, at int, entity string, step string")
    groups = M.overlap_groups(p, s)
    want = one_by_one(proposals, scopes)
    assert {r.key: (r.survivor, r.n_scopes) for r in groups.collect()} == want
    known = [x for x in scopes if x[0] in want]
    assert {(r.survivor, r["at"]): (r.entity, r.step, r.key) for r in M.merged_scopes(groups, s).collect()} == told(known, want)


def test_chains_ties_nulls_and_repeats(spark):
    proposals = [(1, "A", 2), (2, "A", 2), (3, "A", 1), (4, "A", None), (5, "B", 2), (6, None, 2), (7, None, 2), (8, "A", 2), (9, "A", 2), (10, "A", 2)]
    scopes = [(1, 0, "on", "read"), (2, 0, "on", "read"), (2, 1, "off", "read"), (3, 0, "off", "read"), (3, 0, "off", "read"), (4, 0, "off", "write"), (5, 0, "on", "read")]
    scopes += [(6, 0, "x", "y"), (7, 0, "x", "y"), (8, 0, None, "read"), (9, 0, None, "read"), (10, 5, "level", "move"), (9, 1, "level", "move"), (99, 0, "on", "read")]
    run(spark, proposals, scopes)


def test_random_groups(spark):
    rnd = random.Random(3)
    proposals = [(k, rnd.choice("AB"), rnd.randint(1, 2)) for k in range(60)]
    run(spark, proposals, [(rnd.randrange(60), i % 5, rnd.choice("abcdefghij"), rnd.choice("rstuvw")) for i in range(90)])


def test_one_scope_shared_by_all_and_none_at_all(spark):
    run(spark, [(k, "A", 1) for k in range(300)], [(k, 0, "e", "s") for k in range(300)])
    p = spark.createDataFrame([(1, "A", 1)], "key long, family string, prefer int")
    none = spark.createDataFrame([], "key long, at int, entity string, step string")
    assert [tuple(r) for r in M.overlap_groups(p, none).collect()] == [(1, 1, 0)]
    assert M.overlap_groups(p.filter("false"), none).count() == M.merged_scopes(M.overlap_groups(p, none), none).count() == 0


def test_no_table_is_built_in_the_driver(spark):
    many = spark.createDataFrame([(k % 3, k) for k in range(30)], "key long, at long")
    one = spark.createDataFrame([(k, f"f{k}") for k in range(3)], "key long, family string")
    joined = M.spread(many, one, ["key"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 30 and "Broadcast" not in plan and "Generate" not in plan
    p = spark.createDataFrame([(k, "A", 1) for k in range(9)], "key long, family string, prefer int")
    s = spark.createDataFrame([(k, 0, "e", "s") for k in range(9)], "key long, at int, entity string, step string")
    assert "Broadcast" not in M.overlap_groups(p, s)._jdf.queryExecution().executedPlan().toString()
