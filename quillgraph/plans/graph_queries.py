"""Queries over the property graph that the star schema stands for, linking and coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators.lineage import shares
from .catalog import query
from .text_queries import table

_TABLES = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name"), "customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name"), "orders": ("o_orderkey", "o_orderstatus")}
_EDGES = [
    ("nation", "n_nationkey", "region", "n_regionkey", "belongs_to"),
    ("customer", "c_custkey", "nation", "c_nationkey", "in_context"),
    ("supplier", "s_suppkey", "nation", "s_nationkey", "in_context"),
    ("orders", "o_orderkey", "customer", "o_custkey", "tests"),
]
_N = "(" + " union all ".join(f"select '{t}::' || {k} as node_id, '{t}' as node_type, {n} as label from {t}" for t, (k, n) in _TABLES.items()) + ")"
_E = "(" + " union all ".join(f"select '{t}::' || {k} as src, '{u}::' || {f} as dst, '{e}' as edge_type from {t}" for t, k, u, f, e in _EDGES) + (
    " union all select distinct 'orders::' || l_orderkey, 'part::' || l_partkey, case l_returnflag when 'R' then 'verifies_rule' when 'A' then 'observes_event' else 'reads' end from lineitem"
    " union all select distinct 'orders::' || l_orderkey, 'supplier::' || l_suppkey, 'observes_event' from lineitem)"
)


def nodes(spark, sf_dir):
    out = None
    for t, (k, n) in _TABLES.items():
        one = table(spark, sf_dir, t).select(F.concat_ws("::", F.lit(t), F.col(k)).alias("node_id"), F.lit(t).alias("node_type"), F.col(n).alias("label"))
        out = one if out is None else out.unionByName(one)
    return out


def edges(spark, sf_dir):
    out = None
    for t, k, u, f, e in _EDGES:
        one = table(spark, sf_dir, t).select(F.concat_ws("::", F.lit(t), F.col(k)).alias("src"), F.concat_ws("::", F.lit(u), F.col(f)).alias("dst"), F.lit(e).alias("edge_type"))
        out = one if out is None else out.unionByName(one)
    li = table(spark, sf_dir, "lineitem")
    src = F.concat_ws("::", F.lit("orders"), "l_orderkey").alias("src")
    kind = F.when(F.col("l_returnflag") == "R", "verifies_rule").when(F.col("l_returnflag") == "A", "observes_event").otherwise("reads")
    parts = li.select(src, F.concat_ws("::", F.lit("part"), "l_partkey").alias("dst"), kind.alias("edge_type")).distinct()
    sups = li.select(src, F.concat_ws("::", F.lit("supplier"), "l_suppkey").alias("dst"), F.lit("observes_event").alias("edge_type")).distinct()
    return out.unionByName(parts).unionByName(sups)


@query("graph_nodes", f"select * from {_N}")
def graph_nodes(spark, sf_dir):
    return nodes(spark, sf_dir)


@query("graph_edges_typed", f"select * from {_E}")
def graph_edges_typed(spark, sf_dir):
    return edges(spark, sf_dir)


_P = "case edge_type when 'tests' then 10 when 'reads' then 8 when 'observes_event' then 7 when 'verifies_rule' then 5 when 'in_context' then 1 else 0 end"


@query("graph_edges_collapsed", f"select src, dst, edge_type from (select *, row_number() over (partition by src, dst order by {_P} desc, edge_type) as n from {_E}) where n = 1")
def graph_edges_collapsed(spark, sf_dir):
    return G.collapsed(edges(spark, sf_dir), seq="edge_type").select("src", "dst", "edge_type")


@query("graph_degree_stats", f"with e as {_E}, x as (select src as node_id, 1 as o, 0 as i, edge_type from e union all select dst, 0, 1, edge_type from e), s as (select node_id, sum(o)::bigint as od, sum(i)::bigint as id, string_agg(distinct edge_type, '|' order by edge_type) as t from x group by 1) select n.node_id, coalesce(od, 0)::bigint as out_degree, coalesce(id, 0)::bigint as in_degree, coalesce(t, '') as edge_types from {_N} n left join s using (node_id)")
def graph_degree_stats(spark, sf_dir):
    return G.degrees(nodes(spark, sf_dir), edges(spark, sf_dir))


@query("graph_dangling_edges", f"with n as (select node_id from {_N}), e as {_E} select distinct src, dst, edge_type from e where src not in (select node_id from n) or dst not in (select node_id from n)")
def graph_dangling_edges(spark, sf_dir):
    return G.dangling(nodes(spark, sf_dir), edges(spark, sf_dir))


@query("graph_orphans", f"with e as {_E} select node_id, node_type from {_N} n where not exists (select 1 from e where e.src = n.node_id and edge_type = 'reads') and not exists (select 1 from e where e.dst = n.node_id and edge_type = 'reads')")
def graph_orphans(spark, sf_dir):
    n, e = nodes(spark, sf_dir), edges(spark, sf_dir).filter("edge_type = 'reads'")
    ends = e.select(F.col("src").alias("end")).union(e.select("dst")).distinct()
    return n.join(ends, n.node_id == ends.end, "left_anti").select("node_id", "node_type")


@query("graph_type_histogram", f"select 'node' as what, node_type as kind, count(*) as n from {_N} group by 2 union all select 'edge', edge_type, count(*) from {_E} group by 2")
def graph_type_histogram(spark, sf_dir):
    n = nodes(spark, sf_dir).groupBy(F.lit("node").alias("what"), F.col("node_type").alias("kind")).agg(F.count("*").alias("n"))
    return n.unionAll(edges(spark, sf_dir).groupBy(F.lit("edge").alias("what"), F.col("edge_type").alias("kind")).agg(F.count("*").alias("n")))


_U = f"u as (select src, dst from {_E} union select dst, src from {_E})"


@query("graph_two_hop", f"with {_U}, s as (select 'customer::' || c_custkey as seed from customer where c_custkey % 100 = 0), h1 as (select distinct seed, dst as node from s join u on src = seed), h2 as (select distinct seed, dst as node from h1 join u on src = node), f as (select seed, seed as node, 0 as hop from s union all select seed, node, 1 from h1 union all select seed, node, 2 from h2) select seed, node, min(hop)::int as hop from f group by 1, 2")
def graph_two_hop(spark, sf_dir):
    seeds = table(spark, sf_dir, "customer").filter("c_custkey % 100 = 0").select(F.concat_ws("::", F.lit("customer"), "c_custkey").alias("seed"))
    return G.reachable(seeds.withColumn("node", F.col("seed")), G.undirected(edges(spark, sf_dir)), 2)


@query("graph_keyword_search", f"select node_id, score from (select node_id, (case when contains(lower(label), 'a') then 1 else 0 end + case when contains(lower(label), 'o') then 2 else 0 end)::int as score from {_N}) where score > 0 order by score desc, node_id limit 50")
def graph_keyword_search(spark, sf_dir):
    label = F.lower("label")
    score = F.when(label.contains("a"), 1).otherwise(0) + F.when(label.contains("o"), 2).otherwise(0)
    n = nodes(spark, sf_dir).select("node_id", score.alias("score"))
    return n.filter("score > 0").orderBy(F.desc("score"), "node_id").limit(50)


@query("graph_entity_coverage", f"with e as (select dst, count(distinct src) as n from {_E} where edge_type in ('reads', 'observes_event', 'verifies_rule') group by 1) select node_id, coalesce(n, 0)::bigint as n_tests, n is not null as covered from {_N} left join e on dst = node_id where node_type in ('part', 'supplier')")
def graph_entity_coverage(spark, sf_dir):
    n = edges(spark, sf_dir).filter(F.col("edge_type").isin("reads", "observes_event", "verifies_rule")).groupBy("dst").agg(F.countDistinct("src").alias("n"))
    out = nodes(spark, sf_dir).filter(F.col("node_type").isin("part", "supplier")).join(n, F.col("node_id") == F.col("dst"), "left")
    return out.select("node_id", F.coalesce("n", F.lit(0)).alias("n_tests"), F.col("n").isNotNull().alias("covered"))


@query("uncovered_anti_join", "select c_custkey, c_name from customer c where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def uncovered_anti_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select("o_custkey")
    return table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


_KINDS = {"attribute": ["reads", "observes_event"], "rule": ["verifies_rule"], "command": ["tests"]}
_CH = "(select 'part::' || p_partkey as target, p_partkey as change_id, case p_size % 3 when 0 then 'attribute' when 1 then 'rule' else 'command' end as kind from part)"


@query("graph_impact", f"with k as (select * from (values ('attribute', 'reads'), ('attribute', 'observes_event'), ('rule', 'verifies_rule'), ('command', 'tests')) t(kind, edge_type)) select change_id, count(src) as n, case when count(src) > 0 then 'direct' else 'gap' end as verdict from {_CH} c left join k using (kind) left join {_E} e on e.dst = c.target and e.edge_type = k.edge_type group by 1")
def graph_impact(spark, sf_dir):
    kind = F.when(F.col("p_size") % 3 == 0, "attribute").when(F.col("p_size") % 3 == 1, "rule").otherwise("command")
    changes = table(spark, sf_dir, "part").select(F.concat_ws("::", F.lit("part"), "p_partkey").alias("target"), F.col("p_partkey").alias("change_id"), kind.alias("kind"))
    return G.impact(changes, edges(spark, sf_dir), _KINDS)


@query("graph_dependencies", f"select split_part(src, '::', 1) as from_type, split_part(dst, '::', 1) as to_type, count(*) as n, count(distinct dst) as n_targets from {_E} group by 1, 2")
def graph_dependencies(spark, sf_dir):
    kind = lambda c: F.split_part(c, F.lit("::"), F.lit(1))
    return edges(spark, sf_dir).groupBy(kind("src").alias("from_type"), kind("dst").alias("to_type")).agg(F.count("*").alias("n"), F.countDistinct("dst").alias("n_targets"))


@query("graph_top_degree", f"with e as {_E}, x as (select src as node_id from e union all select dst from e) select node_id, count(*) as degree from x group by 1 order by 2 desc, 1 limit 25")
def graph_top_degree(spark, sf_dir):
    e = edges(spark, sf_dir)
    return e.select(F.col("src").alias("node_id")).unionAll(e.select("dst")).groupBy("node_id").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node_id").limit(25)


_CE = "(select 'user::' || user_id as src, 'type::' || event_type || (user_id % 7) as dst from events)"


@query("graph_components", f"with recursive e as (select distinct src, dst from {_CE} union select distinct dst, src from {_CE}), r as (select src as node_id, src as comp from e union select e.dst, r.comp from r join e on e.src = r.node_id) select node_id, min(comp) as comp from r group by 1")
def graph_components(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat_ws("::", F.lit("user"), "user_id").alias("src"), F.concat(F.lit("type::"), "event_type", (F.col("user_id") % 7).cast("string")).alias("dst")).distinct()
    n = e.select(F.col("src").alias("node_id")).union(e.select("dst")).distinct()
    return G.components(n, e)


@query("set_missing_phantom", "with x as (select distinct l_orderkey as k from lineitem where l_returnflag = 'R'), a as (select distinct o_orderkey as k from orders where o_orderstatus = 'F') select k, 'missing' as verdict from (select k from x except select k from a) union all select k, 'phantom' from (select k from a except select k from x)")
def set_missing_phantom(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")).distinct()
    a = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k")).distinct()
    return x.subtract(a).withColumn("verdict", F.lit("missing")).unionAll(a.subtract(x).withColumn("verdict", F.lit("phantom")))


@query("tiered_link", "with t as (select o_orderkey, p_partkey, 1 as tier from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where l_returnflag = 'R' union select o_orderkey, p_partkey, 2 from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey where p_size > 25 union select o_orderkey, p_partkey, 3 from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey), m as (select *, min(tier) over (partition by o_orderkey) as low from t) select o_orderkey, p_partkey, tier::int as tier from m where tier = low")
def tiered_link(spark, sf_dir):
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    n = shares(li)
    li = li.select("l_orderkey", "l_partkey", "l_returnflag").repartition(n, "l_partkey").join(p.select("p_partkey", "p_size").repartition(n, "p_partkey").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    tier = F.when(F.col("l_returnflag") == "R", 1).when(F.col("p_size") > 25, 2).otherwise(3)
    # every tier holds what a better one holds, so the rows of an order's best tier are enough; one deal by order serves all
    rows = li.select(F.col("l_orderkey").alias("o_orderkey"), "p_partkey", tier.alias("tier")).repartition(n, "o_orderkey").join(o.select("o_orderkey").repartition(n, "o_orderkey").hint("merge"), "o_orderkey", "left_semi")
    low = F.min("tier").over(Window.partitionBy("o_orderkey"))
    return rows.withColumn("low", low).filter("tier = low").select("o_orderkey", "p_partkey", "tier").distinct()


@query("modal_cluster", "select o_custkey, p_brand, n from (select o_custkey, p_brand, count(*) as n, row_number() over (partition by o_custkey order by count(*) desc, p_brand) as r from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey group by 1, 2) where r = 1")
def modal_cluster(spark, sf_dir):
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    c = j.groupBy("o_custkey", "p_brand").agg(F.count("*").alias("n"))
    return c.groupBy("o_custkey").agg(F.min(F.struct((-F.col("n")).alias("m"), "p_brand")).alias("b")).select("o_custkey", "b.p_brand", (-F.col("b.m")).alias("n"))


@query("longest_prefix_match", "select doc_id, name from (select doc_id, s.name, row_number() over (partition by doc_id order by length(s.name) desc, s.name) as r from documents d join (select distinct left(source, k) as name from documents, (values (4), (5)) t(k)) s on starts_with(d.source, s.name)) where r = 1")
def longest_prefix_match(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    names = d.select(F.explode(F.array(F.left("source", F.lit(4)), F.left("source", F.lit(5)))).alias("name")).distinct()
    # an equi-join on each prefix length instead of a scan of all names
    each = d.select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.length("source")), lambda k: F.left("source", k))).alias("name"))
    return each.join(names, "name").groupBy("doc_id").agg(F.max_by("name", F.struct(F.length("name"), "name")).alias("name"))


@query("coverage_map_counts", "select n_name, count(distinct c_custkey) as customers, count(distinct o_custkey) as covered from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1")
def coverage_map_counts(spark, sf_dir):
    c = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    o = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("n_name").agg(F.countDistinct("c_custkey").alias("customers"), F.countDistinct("o_custkey").alias("covered"))


@query("code_validation", "select l_orderkey, l_linenumber, case when p.p_partkey is null then 'non_existent' when p_size > 45 then 'disallowed' when l_shipdate < o_orderdate then 'wrong_side' else 'ok' end as verdict from lineitem left join part p on p_partkey = l_partkey left join orders on o_orderkey = l_orderkey")
def code_validation(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = table(spark, sf_dir, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey"), "left").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    v = F.when(F.col("p_partkey").isNull(), "non_existent").when(F.col("p_size") > 45, "disallowed").when(F.col("l_shipdate") < F.col("o_orderdate"), "wrong_side").otherwise("ok")
    return j.select("l_orderkey", "l_linenumber", v.alias("verdict"))


@query("multi_cluster_names", "select event_type, count(distinct user_id % 5) as n from events group by 1 having count(distinct user_id % 5) > 1")
def multi_cluster_names(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct(F.col("user_id") % 5).alias("n")).filter("n > 1")


@query("first_path_resolution", "select s_suppkey, coalesce(a.c_custkey, b.c_custkey, -1)::bigint as found, case when a.c_custkey is not null then 1 when b.c_custkey is not null then 2 else 3 end::int as tier from supplier left join (select c_nationkey, s0, min(c_custkey) as c_custkey from (select c_nationkey, c_custkey % 100 as s0, c_custkey from customer) group by 1, 2) a on a.c_nationkey = s_nationkey and s0 = s_suppkey % 100 left join (select c_nationkey, min(c_custkey) as c_custkey from customer group by 1) b on b.c_nationkey = s_nationkey")
def first_path_resolution(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    a = c.groupBy("c_nationkey", (F.col("c_custkey") % 100).alias("s0")).agg(F.min("c_custkey").alias("a")).withColumnRenamed("c_nationkey", "n1")
    b = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("b")).withColumnRenamed("c_nationkey", "n2")
    s = table(spark, sf_dir, "supplier")
    j = s.join(a, (F.col("s_nationkey") == F.col("n1")) & (F.col("s0") == F.col("s_suppkey") % 100), "left").join(b, F.col("s_nationkey") == F.col("n2"), "left")
    return j.select("s_suppkey", F.coalesce("a", "b", F.lit(-1)).cast("long").alias("found"), F.when(F.col("a").isNotNull(), 1).when(F.col("b").isNotNull(), 2).otherwise(3).alias("tier"))
