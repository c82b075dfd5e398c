"""Searching the property graph for what a structured change touches, and names for nodes.

Nodes: node_id, node_type, label, cluster (a cluster's label is its name).  Edges: src, dst, edge_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import tokens
from . import trigrams
from .lineage import cut

_TARGETS = ("test_case", "requirement", "behavior_rule")


def _first(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` of each group; the limit is applied before the shuffle as well."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def seeds(changes: DataFrame, nodes: DataFrame, edges: DataFrame, most: int = 20) -> DataFrame:
    """(change_id, of, node_id, tier): the nodes that a change's search starts from.

    ``changes``: change_id, cluster, entity_type, entity_name.  ``of`` is the change's cluster in lower case, an alias
    resolved to its base.  Tier 1: the node TYPE::cluster::name, of the first cluster by id whose name holds ``of``.  Tier 2,
    where tier 1 finds nothing: nodes of the type whose label holds the name and whose cluster, if any, holds ``of``, the
    first ``most`` by id.  Tier 0: all clusters whose name holds ``of``.  Generic names and those under three characters
    have no seeds.
    """
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    ch = changes.select("change_id", low("cluster").alias("given"), low("entity_type").alias("type"), F.coalesce("entity_name", F.lit("")).alias("name"))
    ch = ch.filter((F.length("name") >= 3) & ~F.lower("name").isin(*V.GENERIC_NAMES))
    clusters = nodes.filter("node_type = 'cluster'").select(F.col("node_id").alias("c_id"), F.col("label").alias("c_label"), F.lower("label").alias("text"))
    alias = edges.filter("edge_type = 'alias_of'").select(F.col("src").alias("c_id"), F.col("dst").alias("b_id"))
    base = clusters.join(alias, "c_id").join(clusters.select(F.col("c_id").alias("b_id"), F.col("text").alias("base")), "b_id").groupBy(F.col("text").alias("given")).agg(F.min("base").alias("base"))
    ch = cut(ch.join(base, "given", "left").select("change_id", F.coalesce("base", "given").alias("of"), "type", "name"))
    named = cut(trigrams.contained(ch.select(F.col("of").alias("needle")), clusters.select("text")).join(clusters, "text").select(F.col("needle").alias("of"), "c_id", "c_label"))
    canonical = named.groupBy("of").agg(F.min_by("c_label", "c_id").alias("c_label"))
    probe = ch.join(canonical, "of").withColumn("node_id", F.concat_ws("::", F.upper("type"), "c_label", "name"))
    one = cut(probe.join(nodes.select("node_id"), "node_id", "left_semi").select("change_id", "of", "node_id", F.lit(1).alias("tier")))
    rest = ch.join(one.select("change_id"), "change_id", "left_anti").withColumn("needle", F.lower("name"))
    there = nodes.select("node_id", F.col("node_type").alias("type"), F.lower("label").alias("text"), F.lower(F.coalesce("cluster", F.lit(""))).alias("in"))
    fits = trigrams.contained(rest.select("needle"), there.select("text"))
    hits = rest.join(fits, "needle").join(there, ["text", "type"]).filter((F.col("of") == "") | (F.col("in") == "") | F.col("in").contains(F.col("of")))
    two = _first(hits.select("change_id", "of", "node_id"), ["change_id"], ["node_id"], most).withColumn("tier", F.lit(2))
    zero = ch.join(named, "of").select("change_id", "of", F.col("c_id").alias("node_id"), F.lit(0).alias("tier"))
    return one.unionByName(two).unionByName(zero)


def _ways(edges: DataFrame) -> DataFrame:
    """(src, dst): edges both ways, each once, dealt by ``dst``."""
    both = edges.select("src", "dst").unionAll(edges.select("dst", "src")).toDF("src", "dst")
    return both.filter("src is not null and dst is not null").repartition("dst").distinct()


def structured_search(changes: DataFrame, nodes: DataFrame, edges: DataFrame, most: int = 10) -> DataFrame:
    """(change_id, node_id, node_type, source): test cases and requirements that each change touches, the first ``most`` by id.

    ``source`` graph: within two undirected edges of the change's :func:`seeds`, and sections of its cluster, ``most`` // 3
    but three at least.  A requirement counts if it has no cluster or one whose name holds the change's; a test case also
    where the change's holds its.  ``source`` text, for changes without seeds: nodes whose label shares words of three
    letters or more with cluster, type and name, by their number, then id.

    The neighbourhood of a seed is walked once however many changes start there, and cut to ``most`` by id for each cluster
    asked for, as no later one can be among a change's first.
    """
    # small tables that several joins read are written once
    start = cut(seeds(changes, nodes, edges))
    about = nodes.select("node_id", "node_type", F.lower(F.coalesce("cluster", F.lit(""))).alias("in"))
    around = start.select("of", F.col("node_id").alias("seed")).distinct()
    near = around.select("seed").distinct()
    # edges are dealt once by the end that is walked to, which tells equals and what that end is
    steps = cut(_ways(edges).join(about.withColumnRenamed("node_id", "dst").repartition("dst").hint("merge"), "dst", "left"))
    target = F.col("node_type").isin(*_TARGETS)
    reach = lambda df, at: df.join(steps.filter(target) if at == "mid" else steps, F.col(at) == F.col("src")).select("seed", F.col("dst").alias("node_id"), "node_type", "in")
    hop1 = reach(near, "seed")
    hop2 = reach(hop1.select("seed", F.col("node_id").alias("mid")), "mid")
    own = near.join(about, F.col("seed") == F.col("node_id")).select("seed", "node_id", "node_type", "in")
    # what counts depends on a node's cluster and kind only, so the first of each are kept before they are shuffled; equals
    # have one rank
    found = hop1.unionByName(hop2).unionByName(own).filter(target)
    found = found.withColumn("_n", F.dense_rank().over(Window.partitionBy("seed", "in", "node_type").orderBy("node_id"))).filter(F.col("_n") <= most).drop("_n").distinct()
    asked = start.select("of").distinct()
    pairs = cut(trigrams.either_way(asked, cut(about.select(F.col("in").alias("b")).distinct()), "of", "b").withColumnRenamed("b", "in"))
    hits = around.join(found, "seed").join(pairs.select("of", "in", "inside"), ["of", "in"], "left")
    hits = hits.filter((F.col("of") == "") | (F.col("in") == "") | F.col("inside") | (F.col("inside").isNotNull() & (F.col("node_type") == "test_case")))
    hits = _first(hits.select("of", "seed", "node_id", "node_type"), ["of", "seed"], ["node_id"], most)
    each = start.select("change_id", "of", F.col("node_id").alias("seed")).join(hits, ["of", "seed"]).select("change_id", "node_id", "node_type")
    sections = about.filter("node_type = 'section'").join(pairs.filter("inside").select("of", "in"), "in")
    sections = _first(sections.select("of", "node_id", "node_type"), ["of"], ["node_id"], max(3, most // 3))
    each = each.unionByName(start.select("change_id", "of").distinct().join(sections, "of").select("change_id", "node_id", "node_type")).distinct()
    graph = _first(each, ["change_id"], ["node_id"], most).withColumn("source", F.lit("graph"))
    words = lambda c: F.array_distinct(F.filter(tokens(c), lambda w: (F.length(w) >= 3) & ~w.isin(*V.GENERIC_NAMES)))
    lost = changes.join(start.select("change_id").distinct(), "change_id", "left_anti")
    lost = lost.select("change_id", F.explode(words(F.concat_ws(" ", "cluster", "entity_type", "entity_name"))).alias("w"))
    spoken = nodes.filter(F.col("node_type").isin(*_TARGETS)).select("node_id", "node_type", F.explode(words(F.coalesce("label", F.lit("")))).alias("w"))
    spoken = lost.join(spoken, "w").groupBy("change_id", "node_id", "node_type").agg(F.count("*").alias("n"))
    text = _first(spoken, ["change_id"], [F.desc("n"), "node_id"], most).drop("n").withColumn("source", F.lit("text"))
    return graph.unionByName(text)


def resolved_ids(names: DataFrame, nodes: DataFrame) -> DataFrame:
    """(name, node_id, tier): the node that a name stands for: 1 its id, 2 its id in any case, 3 the shortest id that begins
    with it, 4 the shortest id that holds it, both in any case; null without any.  Equals go by id."""
    n = names.select("name").filter("name is not null and name != ''").distinct().withColumn("needle", F.lower("name"))
    n, ids = cut(n), cut(nodes.select("node_id").distinct().withColumn("text", F.lower("node_id")))
    one = n.join(ids.select(F.col("node_id").alias("name")), "name").select("name", F.struct(F.lit(1).alias("tier"), F.length("name").alias("l"), F.col("name").alias("node_id")).alias("one"))
    # beginnings of ids, of lengths that names have, with the best id of each: no name meets more than one row
    sizes = n.agg(F.sort_array(F.collect_set(F.length("needle"))).alias("s")).first()["s"]  # as many as there are lengths of names
    starts = ids.select("node_id", "text", F.explode(F.filter(F.array(*[F.lit(s) for s in sizes]).cast("array<int>"), lambda s: s <= F.length("text"))).alias("s"))
    tier = F.when(F.length("text") == F.col("s"), 2).otherwise(3)
    starts = starts.groupBy(F.substring("text", F.lit(1), F.col("s")).alias("needle")).agg(F.min(F.struct(tier.alias("tier"), F.length("node_id").alias("l"), "node_id")).alias("two"))
    begun = cut(n.join(one, "name", "left").join(starts, "needle", "left").select("name", "needle", F.coalesce("one", "two").alias("m")))
    rest = begun.filter("m is null").select("name", "needle")
    hits = trigrams.contained(rest.select("needle"), ids.select("text")).join(ids, "text")
    held = hits.groupBy("needle").agg(F.min(F.struct(F.lit(4).alias("tier"), F.length("node_id").alias("l"), "node_id")).alias("m"))
    best = begun.filter("m is not null").select("name", "m").unionByName(rest.join(held, "needle", "left").select("name", "m"))
    return best.select("name", "m.node_id", "m.tier")


def prefix_of(names: DataFrame, texts: DataFrame) -> DataFrame:
    """(name, text): texts that begin with a name."""
    return trigrams.contained(names.select(F.col("name").alias("needle")), texts.select("text")).filter(F.col("text").startswith(F.col("needle"))).select(F.col("needle").alias("name"), "text")


def ego(seeds_: DataFrame, nodes: DataFrame, edges: DataFrame, hops: int = 3, fan: int = 20, hub: int = 50) -> DataFrame:
    """(seed, node_id, hop): a bounded picture of the graph around each seed, for drawing.

    Walked outwards hop by hop over undirected edges, a frontier for each seed.  From a node that isn't the seed at most
    ``fan`` neighbours are taken: those of the lowest degree, then by id.  Nodes with more than ``hub`` neighbours are shown
    but not walked on, and a node of another cluster than the seed's (both given) is left out unless it is a cluster.
    """
    own = nodes.select(F.col("node_id").alias("seed"), F.lower(F.coalesce("cluster", F.lit(""))).alias("of"))
    found = seeds_.select(F.col("node_id").alias("seed")).distinct().join(own, "seed").select("seed", "of", F.col("seed").alias("node_id"), F.lit(0).alias("hop"), F.lit(0).cast("long").alias("d"))
    # edges are dealt once by the end that is walked to: that tells equals, its degree and its cluster, which are written; a
    # cluster counts as one without cluster, as both are never left out
    open_ = F.when(F.col("node_type") == "cluster", "").otherwise(F.lower(F.coalesce("cluster", F.lit(""))))
    ways = _ways(edges).withColumn("d", F.count("*").over(Window.partitionBy("dst")))
    steps = cut(ways.join(nodes.select(F.col("node_id").alias("dst"), open_.alias("in")).repartition("dst").hint("merge"), "dst"))
    front = found
    for h in range(1, hops + 1):
        # each node's list is cut to its fan once for each cluster asked for, so a hub's many edges are met once, not once a seed
        walk = front.filter(F.col("d") <= hub)
        here = walk.select("of", F.col("node_id").alias("src")).distinct()
        fits = (F.col("of") == "") | (F.col("in") == "") | (F.col("in") == F.col("of"))
        next_ = here.join(steps, "src").filter(fits).select("of", "src", "dst", "d")
        if h > 1:
            next_ = _first(next_, ["of", "src"], ["d", "dst"], fan)
        reached = walk.select("seed", "of", F.col("node_id").alias("src")).join(next_, ["of", "src"])
        # a seed has one cluster and a node one degree, so seed and node alone say where equals meet, and those found before
        reached = reached.groupBy("seed", F.col("dst").alias("node_id")).agg(F.first("of").alias("of"), F.first("d").alias("d"))
        front = reached.join(found.select("seed", "node_id"), ["seed", "node_id"], "left_anti").withColumn("hop", F.lit(h)).select("seed", "of", "node_id", "hop", "d")
        front = front if h == hops else cut(front)
        found = found.unionByName(front)
    return found.select("seed", "node_id", "hop")
