"""Audits of a graph against its test cases: mappings, cluster assignments, tallies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linking as L


def missing_and_phantom(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(tc_id, target, verdict): expected targets that aren't there, and targets that weren't expected."""
    cols = ["tc_id", "target"]
    e, a = expected.select(*cols).distinct(), actual.select(*cols).distinct()
    gone = e.join(a, cols, "left_anti").withColumn("verdict", F.lit("missing"))
    return gone.unionByName(a.join(e, cols, "left_anti").withColumn("verdict", F.lit("phantom")))


def mapping(test_cases: DataFrame, nodes: DataFrame, edges: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(tc_id, check, status) and each test case's worst as check 'overall'.

    node: it is in the graph; cluster: its edge to the cluster of its prefix; requirement: any; entity: any; dangling: no
    edge to what isn't there.  FAIL for the first two and the last, WARN for the others; protocol families need no cluster.
    """
    t = test_cases.select("tc_id", L.prefix(F.col("tc_id")).alias("prefix"))
    by = prefixes.groupBy(F.upper("prefix").alias("prefix")).agg(F.min("cluster").alias("want"))
    t = t.join(by, "prefix", "left").join(nodes.select(F.col("node_id").alias("tc_id"), F.lit(True).alias("there")), "tc_id", "left")
    known = nodes.select(F.col("node_id").alias("dst"), F.lit(True).alias("known"))
    e = edges.withColumnRenamed("src", "tc_id").join(known, "dst", "left")
    entity = ("reads", "writes", "verifies_attribute", "tests_command", "observes_event", "negative_tests", "verifies_rule")
    n = e.groupBy("tc_id").agg(
        F.count_if(F.col("edge_type") == "verifies_requirement").alias("reqs"),
        F.count_if(F.col("edge_type").isin(*entity) | F.col("edge_type").startswith("validates_")).alias("entities"),
        F.count_if(F.col("known").isNull()).alias("lost"),
        F.collect_set(F.when(F.col("edge_type") == "tests", F.col("dst"))).alias("tested"),
    )
    t = t.join(n, "tc_id", "left").fillna(0, ["reqs", "entities", "lost"])
    tested = F.coalesce("tested", F.array().cast("array<string>"))
    free = L.is_protocol(F.col("prefix")) | F.col("want").isNull()
    checks: dict[str, tuple[Column, int]] = {
        "node": (F.col("there").isNotNull(), 2),
        "cluster": (F.coalesce(free | F.array_contains(tested, F.concat(F.lit("CLUSTER::"), "want")), F.lit(False)), 2),
        "requirement": (F.col("reqs") > 0, 1),
        "entity": (F.col("entities") > 0, 1),
        "dangling": (F.col("lost") == 0, 2),
    }
    levels = {k: F.when(ok, 0).otherwise(bad) for k, (ok, bad) in checks.items()}
    worst = F.greatest(*levels.values())
    name = lambda v: F.when(v == 0, "PASS").when(v == 1, "WARN").otherwise("FAIL")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("check"), name(v).alias("status")) for k, v in [*levels.items(), ("overall", worst)]]))
    return t.select("tc_id", each.alias("x")).select("tc_id", "x.check", "x.status")


def assignments(test_cases: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(tc_id, cluster, want, finding): missing_cluster, wrong_cluster, protocol_has_cluster; only what is wrong."""
    by = prefixes.groupBy(F.upper("prefix").alias("p")).agg(F.min("cluster").alias("want"))
    t = test_cases.select("tc_id", F.coalesce("cluster", F.lit("")).alias("cluster"), L.prefix(F.col("tc_id")).alias("p")).join(by, "p", "left")
    real = (F.col("cluster") != "") & ~F.col("cluster").startswith("VirtualCluster-")
    finding = (
        F.when(L.is_protocol(F.col("p")) & real, "protocol_has_cluster")
        .when(F.col("want").isNotNull() & ~real & ~L.is_protocol(F.col("p")), "missing_cluster")
        .when(F.col("want").isNotNull() & real & (L.cluster_key(F.col("want")) != L.cluster_key(F.col("cluster"))), "wrong_cluster")
    )
    return t.select("tc_id", "cluster", "want", finding.alias("finding")).filter("finding is not null")


def per_case(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(tc_id, requirements, entities): how many requirements and entities each test case has edges to."""
    t = nodes.filter("node_type = 'test_case'").select(F.col("node_id").alias("tc_id"))
    kinds = nodes.select(F.col("node_id").alias("dst"), "node_type")
    e = edges.withColumnRenamed("src", "tc_id").join(kinds, "dst")
    n = e.groupBy("tc_id").agg(F.count_if(F.col("node_type").isin("requirement", "behavior_rule")).alias("requirements"), F.count_if(F.col("node_type").isin("attribute", "command", "event", "feature")).alias("entities"))
    return t.join(n, "tc_id", "left").fillna(0)


def by_cluster(nodes: DataFrame) -> DataFrame:
    """(cluster, tests, requirements): sorted ids of each cluster's test cases and requirements."""
    ids = lambda *kinds: F.array_sort(F.collect_list(F.when(F.col("node_type").isin(*kinds), F.col("node_id"))))
    return nodes.filter("cluster != ''").groupBy("cluster").agg(ids("test_case").alias("tests"), ids("requirement", "behavior_rule").alias("requirements")).filter("size(tests) > 0 or size(requirements) > 0")


def tallies(findings: DataFrame, group: str, status: str) -> DataFrame:
    """(group, status, n) with a total for each group and one for all."""
    return findings.cube(group, status).agg(F.count("*").alias("n"))


def new_issues(found: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Issues that the known ones don't have, by key in any case."""
    low = [F.lower(F.coalesce(F.col(k), F.lit(""))).alias(f"_{k}") for k in key]
    have = known.select(*low).distinct()
    return found.select("*", *low).join(have, [f"_{k}" for k in key], "left_anti").drop(*[f"_{k}" for k in key])


def missing_per_cluster(coverage: DataFrame, chapters: DataFrame | None = None) -> DataFrame:
    """(cluster, missing, total): requirements without a test; ``chapters`` (cluster, chapter) counts a chapter's too."""
    c = coverage
    if chapters is not None:
        more = c.join(chapters, "cluster").withColumn("cluster", F.col("chapter")).select(*c.columns)
        c = reduce(DataFrame.unionByName, [c, more])
    return c.groupBy("cluster").agg(F.count_if(~F.col("covered")).alias("missing"), F.count("*").alias("total"))
