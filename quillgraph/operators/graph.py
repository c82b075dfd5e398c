"""Property graphs as node and edge tables: building, collapsing, checking and bounded traversal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import flat_name
from .lineage import cut, shares

#: How strongly an edge type represents its node pair.
PRIORITY = {"tests": 10, "tests_command": 9, "verifies_attribute": 8, "reads": 8, "writes": 8, "observes_event": 7, "verifies_requirement": 6, "verifies_rule": 5, "in_context": 1}
#: Seeds that a node was found from, up to which they are a list beside it; beyond, its pairs are compared with those found.
FOUND = 64


def priority(kind: Column, table: dict[str, int] = PRIORITY) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(0))


def collapsed(edges: DataFrame, table: dict[str, int] = PRIORITY, seq: str = "seq") -> DataFrame:
    """One edge for each (src, dst): the highest priority, then the first."""
    w = Window.partitionBy("src", "dst").orderBy(priority(F.col("edge_type"), table).desc(), seq, "edge_type")
    return edges.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_nodes(nodes: DataFrame, seq: str = "seq") -> DataFrame:
    w = Window.partitionBy("node_id").orderBy(seq)
    return nodes.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dangling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with an end that is no node, each once.

    Only distinct ends, null among them, meet the nodes, and only where some are lost do they meet the edges again, so whole
    edges are not shuffled by each end.
    """
    ends = edges.select(F.explode(F.array_distinct(F.array("src", "dst"))).alias("end")).distinct()
    lost = cut(ends.join(nodes.select(F.col("node_id").alias("end")), "end", "left_anti"))
    if lost.isEmpty():
        return edges.filter("false")
    lost_dst = edges.join(lost.withColumnRenamed("end", "dst"), "dst", "left_semi")
    lost_src = edges.join(lost.withColumnRenamed("end", "src"), "src", "left_semi")
    none = edges.filter("src is null or dst is null")
    return lost_dst.select(*edges.columns).union(lost_src.select(*edges.columns)).union(none).distinct()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """In and out degree and the sorted edge types of each node."""
    ends = edges.select(F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i"), "edge_type").unionAll(edges.select("dst", F.lit(0), F.lit(1), "edge_type"))
    sums = ends.groupBy("node_id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.array_join(F.array_sort(F.collect_set("edge_type")), "|").alias("edge_types"))
    return nodes.select("node_id").join(sums, "node_id", "left").fillna({"out_degree": 0, "in_degree": 0, "edge_types": ""})


def undirected(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def reachable(seeds: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """(seed, node, hop): the least number of hops, up to a bound, from (seed, node); joins unrolled hop by hop."""
    found = seeds.select("seed", "node", F.lit(0).alias("hop"))
    front = found
    for h in range(1, hops + 1):
        front = _next(front.select("seed", "node").distinct(), found.select("seed", "node"), edges).withColumn("hop", F.lit(h))
        front = front if h == hops else cut(front)
        found = found.unionByName(front)
    return found


def _next(front: DataFrame, found: DataFrame, edges: DataFrame) -> DataFrame:
    """(seed, node): what is one edge from the front (seed, node) and not found, each once.

    A node's main neighbour is the one at the front of the most seeds.  Pairs by it differ from each other, and those found
    before come along as a list where they are at most FOUND, so they are given out as they are joined; only pairs by other
    neighbours are shuffled to drop equals, and dropped where the seed has the main one too.  So a hub's pairs, seeds times
    neighbours, are never shuffled.
    """
    many = front.groupBy(F.col("node").alias("src")).agg(F.count("*").alias("n"))
    near = edges.join(many.select("src"), "src", "left_semi").select("src", "dst").distinct().join(many, "src")
    main = F.max(F.struct("n", "src")).over(Window.partitionBy("dst"))["src"]
    near = cut(near.select("src", "dst", main.alias("main")))
    known = found.select("seed", F.col("node").alias("dst")).join(near.select("dst").distinct(), "dst", "left_semi")
    known = known.withColumn("_n", F.row_number().over(Window.partitionBy("dst").orderBy("seed"))).filter(F.col("_n") <= FOUND + 1)
    known = known.groupBy("dst").agg(F.collect_list("seed").alias("known"))
    by_main = near.filter("src = main").join(known, "dst", "left").join(front, F.col("src") == F.col("node")).select("seed", F.col("dst").alias("node"), "known")
    few = by_main.filter((F.coalesce(F.size("known"), F.lit(0)) <= FOUND) & ~F.coalesce(F.array_contains("known", F.col("seed")), F.lit(False))).select("seed", "node")
    rest = by_main.filter(F.size("known") > FOUND).select("seed", "node").join(found, ["seed", "node"], "left_anti")
    others = near.filter("src != main").join(front, F.col("src") == F.col("node")).select("seed", "dst", "main").distinct()
    others = others.join(front.withColumnRenamed("node", "main"), ["seed", "main"], "left_anti").select("seed", F.col("dst").alias("node"))
    return few.unionByName(rest).unionByName(others.join(found, ["seed", "node"], "left_anti"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_id, comp): the least id reachable, by large and small stars in turn until only stars are left; lineage is cut each round.

    Joins are by merge: tables of ids are small on disk for what they would take as broadcasts in the driver."""
    ids = nodes.select("node_id").distinct()
    now = edges.filter("src != dst").select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
    for end in ("u", "v"):
        now = now.join(ids.withColumnRenamed("node_id", end).hint("merge"), end, "left_semi")
    now = cut(now)
    while not _stars(now):
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cut(both.join(low.hint("merge"), "u").filter("v > u").select(F.col("m").alias("u"), "v").distinct(), now)
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        now = cut(large.join(low.hint("merge"), "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).filter("u != v").distinct(), large)
    return nodes.select("node_id").join(now.hint("merge"), F.col("node_id") == F.col("v"), "left").select("node_id", F.coalesce("u", "node_id").alias("comp"))


def _stars(edges: DataFrame) -> bool:
    """Whether each v of the edges (u, v) has one u only, which is no edge's v."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionAll(edges.select("u", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or (below = 1 and above = 1)").isEmpty()


def impact(changes: DataFrame, edges: DataFrame, kinds: dict[str, list[str]]) -> DataFrame:
    """Each change's tests over the edge types its kind maps to: (change_id, verdict, n)."""
    spark = edges.sparkSession
    rows = [(k, t) for k, ts in kinds.items() for t in ts]
    table = F.broadcast(spark.createDataFrame(rows, "kind string, edge_type string"))  # a literal of a few rows
    wanted = changes.join(table, "kind", "left")
    hits = edges.select("src", F.col("dst").alias("target"), "edge_type")
    counted = wanted.join(hits, ["target", "edge_type"], "left").groupBy("change_id").agg(F.count("src").alias("n"))
    return counted.withColumn("verdict", F.when(F.col("n") > 0, "direct").otherwise("gap"))


def typed_impact(changes: DataFrame, nodes: DataFrame, edges: DataFrame, kinds: dict[str, tuple[str, ...]] = V.CHANGE_EDGES) -> DataFrame:
    """(change_id, verdict, direct, possible): tests that a change of an entity touches.

    ``changes``: change_id, target, kind.  Direct: over the edge types of the kind; possible: over broad ones only.  The
    verdict is direct, possible, gap (the entity is there and no test points to it at all), none or unknown (not there).
    Repeated edges count once.  Rows are dealt to as many partitions as there are million edges, so a task's memory doesn't
    grow with the graph; a count of the edges runs first.
    """
    n = shares(edges)
    rows = [(k, t) for k, ts in kinds.items() for t in ts]
    table = F.broadcast(edges.sparkSession.createDataFrame(rows, "kind string, edge_type string"))  # a literal of a few rows
    tests = nodes.filter("node_type = 'test_case'").select(F.col("node_id").alias("src"))
    e = edges.repartition(n, "src").join(tests.repartition(n, "src"), "src", "left_semi").select("src", F.col("dst").alias("target"), "edge_type")
    asked = changes.repartition(n, "target")
    j = asked.join(e.repartition(n, "target"), "target").join(table.withColumn("precise", F.lit(True)), ["kind", "edge_type"], "left")
    j = j.select("change_id", "src", F.coalesce("precise", F.lit(False)).alias("d"), F.coalesce(F.col("edge_type").isin(*V.BROAD_EDGES), F.lit(False)).alias("p"))
    per = j.repartition(n, "change_id").groupBy("change_id", "src").agg(F.bool_or("d").alias("d"), F.bool_or("p").alias("p"))
    some = per.groupBy("change_id").agg(F.sort_array(F.collect_list(F.when(F.col("d"), F.col("src")))).alias("direct"), F.sort_array(F.collect_list(F.when(~F.col("d") & F.col("p"), F.col("src")))).alias("possible"))
    there = nodes.select(F.col("node_id").alias("target"), F.lit(True).alias("there"))
    out = asked.join(there.repartition(n, "target"), "target", "left").join(some, "change_id", "left")
    verdict = F.when(F.col("there").isNull(), "unknown").when(F.size("direct") > 0, "direct").when(F.size("possible") > 0, "possible").when(F.col("direct").isNull(), "gap").otherwise("none")
    none = F.array().cast("array<string>")
    return out.select("change_id", verdict.alias("verdict"), F.coalesce("direct", none).alias("direct"), F.coalesce("possible", none).alias("possible"))


def coverage(nodes: DataFrame, edges: DataFrame, most: int | None = 3, reading: bool = True) -> DataFrame:
    """(req_id, cluster, covered, covering): requirements with the tests that cover them, the first ``most`` by id.

    A test covers a requirement that it points to, or an entity, but no cluster, that the requirement implements or
    refers to, where both are of one cluster.  ``reading`` counts edges that read, write or check a property too.
    """
    kinds = (*V.COVER_EDGES, *(V.READING_EDGES if reading else ()))
    key = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s*cluster\s*$", ""))
    reqs = nodes.filter("node_type in ('requirement', 'behavior_rule')").select(F.col("node_id").alias("req_id"), "cluster")
    tests = nodes.filter("node_type = 'test_case'").select(F.col("node_id").alias("tc_id"), key(F.col("cluster")).alias("k"))
    points = edges.filter(F.col("edge_type").isin(*kinds)).select(F.col("src").alias("tc_id"), F.col("dst").alias("to")).join(tests, "tc_id").distinct()
    # no later test can be among a requirement's first, so each entity and cluster, and each requirement, keeps so many
    first = lambda df, by: df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("tc_id"))).filter(F.col("_n") <= most).drop("_n") if most else df
    direct = reqs.join(first(points, ["to"]), F.col("req_id") == F.col("to")).select("req_id", "tc_id")
    entity = nodes.filter("node_type != 'cluster'").select(F.col("node_id").alias("to"))
    about = edges.filter("edge_type in ('implements', 'references')").select(F.col("src").alias("req_id"), F.col("dst").alias("to")).join(entity, "to")
    shared = reqs.withColumn("k", key(F.col("cluster"))).join(about, "req_id").join(first(points, ["to", "k"]), ["to", "k"]).select("req_id", "tc_id")
    found = direct.unionByName(shared).distinct().groupBy("req_id").agg(F.array_sort(F.collect_list("tc_id")).alias("all"))
    some = F.slice("all", 1, most) if most else F.col("all")
    return reqs.join(found, "req_id", "left").select("req_id", "cluster", F.col("all").isNotNull().alias("covered"), F.coalesce(some, F.array().cast("array<string>")).alias("covering"))


def bases(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_id, base): each cluster with the one that it is an alias of, else itself."""
    alias = edges.filter("edge_type = 'alias_of'").groupBy(F.col("src").alias("node_id")).agg(F.min("dst").alias("base"))
    return nodes.filter("node_type = 'cluster'").select("node_id").join(alias, "node_id", "left").select("node_id", F.coalesce("base", "node_id").alias("base"))


def keyword_search(nodes: DataFrame, keywords: list[str], fields: Column, node_types: tuple[str, ...] = ("requirement", "behavior_rule", "test_case"), kinds: tuple[str, ...] = (), cluster: str = "", most: int | None = 10) -> DataFrame:
    """(node_id, score, rank): nodes by how many keywords their ``fields`` hold, twice that for requirements of ``kinds``,
    which exclude others; ``cluster`` is part of the node's cluster's name."""
    n = nodes.filter(F.col("node_type").isin(*node_types)).withColumn("_text", F.lower(fields))
    kind = F.col("props").getItem("requirement_type")
    wanted = kind.isin(*kinds) if kinds else F.lit(False)
    if kinds:
        n = n.filter(~F.col("node_type").isin("requirement", "behavior_rule") | F.coalesce(wanted, F.lit(False)))
    if cluster:
        n = n.filter(F.lower("cluster").contains(cluster.lower()))
    hits = sum((F.col("_text").contains(k.lower()).cast("int") for k in dict.fromkeys(keywords)), F.lit(0))
    scored = n.select("node_id", (hits * F.when(F.coalesce(wanted, F.lit(False)), 2).otherwise(1)).alias("score")).filter("score > 0")
    if most:
        scored = scored.orderBy(F.desc("score"), "node_id").limit(most)
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "node_id"))) if most else scored.withColumn("rank", F.lit(None).cast("int"))


def resolved(names: DataFrame, nodes: DataFrame) -> DataFrame:
    """(name, node_id, tier): the node that a name means: its id, its id in any case, the letters of its last part; the
    shortest of equals."""
    last = F.element_at(F.split("node_id", "::"), -1)
    ids = nodes.select("node_id", F.array(F.struct(F.lit(1).alias("tier"), F.col("node_id").alias("k")), F.struct(F.lit(2).alias("tier"), F.lower("node_id").alias("k")), F.struct(F.lit(3).alias("tier"), flat_name(last).alias("k"))).alias("ks"))
    keys = ids.select("node_id", F.inline("ks"))
    asked = names.select("name", F.inline(F.array(F.struct(F.lit(1).alias("tier"), F.col("name").alias("k")), F.struct(F.lit(2).alias("tier"), F.lower("name").alias("k")), F.struct(F.lit(3).alias("tier"), flat_name(F.col("name")).alias("k")))))
    best = asked.join(keys, ["tier", "k"]).groupBy("name").agg(F.min(F.struct("tier", F.length("node_id").alias("l"), "node_id")).alias("m"))
    return names.select("name").distinct().join(best, "name", "left").select("name", "m.node_id", "m.tier")


def around(seeds: DataFrame, nodes: DataFrame, edges: DataFrame, radius: int = 2, kinds: tuple[str, ...] = ("test_case", "requirement", "behavior_rule", "section")) -> DataFrame:
    """(seed, node_id, node_type, hop): nodes of ``kinds`` within a radius of seeds, edges taken both ways; tests and
    requirements of another cluster than the seed's don't count."""
    known = nodes.select(F.col("node_id").alias("node"), "node_type", "cluster")
    own = known.select(F.col("node").alias("seed"), F.lower("cluster").alias("of"))
    found = reachable(seeds.select(F.col("node_id").alias("seed"), F.col("node_id").alias("node")), undirected(edges), radius)
    j = found.join(known, "node").join(own, "seed")
    same = (F.col("of") == "") | (F.lower("cluster") == F.col("of")) | (F.col("node_type") == "section")
    return j.filter(F.col("node_type").isin(*kinds) & same).select("seed", F.col("node").alias("node_id"), "node_type", "hop")


def dependencies(edges: DataFrame, kinds: tuple[str, ...] = ("depends_on", "references", "alias_of", "in_context"), most: int = 5) -> DataFrame:
    """(cluster, other, direction, n, strong): clusters that edges of ``kinds`` tie; strong are the ``most`` dependents
    with the most ties."""
    e = edges.filter(F.col("edge_type").isin(*kinds) & F.col("src").startswith("CLUSTER::") & F.col("dst").startswith("CLUSTER::") & (F.col("src") != F.col("dst")))
    both = e.select(F.col("src").alias("cluster"), F.col("dst").alias("other"), F.lit("out").alias("direction")).unionAll(e.select("dst", "src", F.lit("in")))
    n = both.groupBy("cluster", "other", "direction").agg(F.count("*").alias("n"))
    w = Window.partitionBy("cluster", "direction").orderBy(F.desc("n"), "other")
    return n.withColumn("strong", (F.col("direction") == "in") & (F.row_number().over(w) <= most))


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, node_type, side): nodes of two graphs by the letters of their labels and their type: both, left or right."""
    one = lambda df, name: df.select(flat_name(F.col("label")).alias("key"), "node_type").filter("key != ''").distinct().withColumn(name, F.lit(True))
    j = one(left, "l").join(one(right, "r"), ["key", "node_type"], "full")
    return j.select("key", "node_type", F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left").otherwise("right").alias("side"))


def topics(items: DataFrame, shared: int = 2) -> DataFrame:
    """(item_id, topic): items of different clusters with ``shared`` keywords in common, joined into groups that span two
    clusters or more.  ``items``: item_id, cluster, keywords."""
    words = items.select("item_id", "cluster", F.explode(F.array_distinct("keywords")).alias("w"))
    a, b = words.alias("a"), words.alias("b")
    pairs = a.join(b, (F.col("a.w") == F.col("b.w")) & (F.col("a.item_id") < F.col("b.item_id")) & (F.col("a.cluster") != F.col("b.cluster")))
    ties = pairs.groupBy(F.col("a.item_id").alias("src"), F.col("b.item_id").alias("dst")).agg(F.count("*").alias("n")).filter(F.col("n") >= shared)
    ends = ties.select(F.col("src").alias("node_id")).union(ties.select("dst")).distinct()
    return components(ends, ties.select("src", "dst")).select(F.col("node_id").alias("item_id"), F.col("comp").alias("topic"))


def bleed(nodes: DataFrame, edges: DataFrame, threshold: float = 10.0) -> DataFrame:
    """(cluster, before, after, foreign, foreign_pct, flagged): tests within two hops of each cluster, those that remain
    when other clusters' tests are pruned, and the share of foreign ones."""
    seeds = nodes.filter("node_type = 'cluster'").select("node_id")
    found = reachable(seeds.select(F.col("node_id").alias("seed"), F.col("node_id").alias("node")), undirected(edges), 2)
    tests = nodes.filter("node_type = 'test_case'").select(F.col("node_id").alias("node"), F.concat(F.lit("CLUSTER::"), "cluster").alias("of"))
    j = found.join(tests, "node")
    n = j.groupBy(F.col("seed").alias("cluster")).agg(F.count("*").alias("before"), F.count_if(F.col("of") == F.col("seed")).alias("after"))
    share = F.round(100.0 * (F.col("before") - F.col("after")) / F.col("before"), 2)
    return n.select("cluster", "before", "after", (F.col("before") - F.col("after")).alias("foreign"), share.alias("foreign_pct"), (share > threshold).alias("flagged"))
