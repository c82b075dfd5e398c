"""Queries over names and the graph around them: substring tables, structured changes, node ids, ego graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import lists as L
from ..operators import search as S
from ..operators import trigrams as G
from ..operators import vectors as V
from ..operators.lineage import shared_dir
from .catalog import query
from .text_queries import table

#: The star schema as a graph of clusters (brands), attributes (parts), test cases (orders), requirements (suppliers) and
#: sections (nations); orders and suppliers have a cluster by their number.
_NODES = """(select 'CLUSTER::' || b as node_id, 'cluster' as node_type, b as label, '' as cluster from (select distinct p_brand as b from part)
  union all select 'ATTRIBUTE::' || p_brand || '::' || p_name || ' ' || p_partkey, 'attribute', p_name || ' ' || p_partkey, p_brand from part
  union all select 'TC::' || o_orderkey, 'test_case', 'order of ' || o_orderpriority, case when o_orderkey % 11 = 0 then '' else 'Brand#' || (1 + o_custkey % 25) end from orders
  union all select 'REQ::' || s_suppkey, 'requirement', s_name, case when s_suppkey % 7 = 0 then '' else 'Brand#' || (1 + s_suppkey % 25) end from supplier
  union all select 'SECTION::' || n_nationkey, 'section', n_name, 'Brand#' || (1 + n_nationkey) from nation)"""
_EDGES = """(select distinct 'TC::' || l_orderkey as src, a.node_id as dst from lineitem join (select p_partkey, 'ATTRIBUTE::' || p_brand || '::' || p_name || ' ' || p_partkey as node_id from part) a on p_partkey = l_partkey
  union all select distinct 'REQ::' || l_suppkey, a.node_id from lineitem join (select p_partkey, 'ATTRIBUTE::' || p_brand || '::' || p_name || ' ' || p_partkey as node_id from part) a on p_partkey = l_partkey where l_linenumber = 1
  union all select 'ATTRIBUTE::' || p_brand || '::' || p_name || ' ' || p_partkey, 'CLUSTER::' || p_brand from part)"""
_CHANGES = """(select p_partkey as change_id, case p_partkey % 5 when 0 then '' else p_brand end as cluster, 'attribute' as type,
  case p_partkey % 4 when 0 then p_name || ' ' || p_partkey when 1 then p_partkey || '' when 2 then 'no such ' || p_partkey else 'mode' end as name from part)"""


def graph(spark, sf_dir):
    """(nodes, edges) of the tables."""
    part, orders, supplier, nation, li = (table(spark, sf_dir, t) for t in ("part", "orders", "supplier", "nation", "lineitem"))
    label = F.concat_ws(" ", "p_name", "p_partkey")
    attribute = F.concat_ws("::", F.lit("ATTRIBUTE"), "p_brand", label)
    brand = lambda c: F.concat(F.lit("Brand#"), (1 + c % 25).cast("string"))
    rows = [
        part.select(F.concat(F.lit("CLUSTER::"), "p_brand"), F.lit("cluster"), F.col("p_brand"), F.lit("")).distinct(),
        part.select(attribute, F.lit("attribute"), label, F.col("p_brand")),
        orders.select(F.concat(F.lit("TC::"), "o_orderkey"), F.lit("test_case"), F.concat(F.lit("order of "), "o_orderpriority"), F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(brand(F.col("o_custkey")))),
        supplier.select(F.concat(F.lit("REQ::"), "s_suppkey"), F.lit("requirement"), F.col("s_name"), F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(brand(F.col("s_suppkey")))),
        nation.select(F.concat(F.lit("SECTION::"), "n_nationkey"), F.lit("section"), F.col("n_name"), F.concat(F.lit("Brand#"), (1 + F.col("n_nationkey")).cast("string"))),
    ]
    nodes = rows[0]
    for r in rows[1:]:
        nodes = nodes.union(r)
    a = part.select(F.col("p_partkey").alias("l_partkey"), attribute.alias("dst"))
    tests = li.select(F.concat(F.lit("TC::"), "l_orderkey").alias("src"), "l_partkey").distinct().join(a, "l_partkey").select("src", "dst", F.lit("tests").alias("edge_type"))
    made = li.filter("l_linenumber = 1").select(F.concat(F.lit("REQ::"), "l_suppkey").alias("src"), "l_partkey").distinct().join(a, "l_partkey").select("src", "dst", F.lit("implements").alias("edge_type"))
    belongs = part.select(attribute.alias("src"), F.concat(F.lit("CLUSTER::"), "p_brand").alias("dst"), F.lit("belongs_to").alias("edge_type"))
    return nodes.toDF("node_id", "node_type", "label", "cluster"), tests.unionByName(made).unionByName(belongs)


def changes(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat_ws(" ", "p_name", "p_partkey")).when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.concat(F.lit("no such "), k.cast("string"))).otherwise("mode")
    return p.select(k.alias("change_id"), F.when(k % 5 == 0, "").otherwise(F.col("p_brand")).alias("cluster"), F.lit("attribute").alias("entity_type"), name.alias("entity_name"))


@query(
    "structured_change_search",
    f"""with n as materialized (select *, lower(cluster) as low from {_NODES}), e as materialized {_EDGES}, c as (select *, lower(cluster) as k from {_CHANGES}),
    ok as (select * from c where length(name) >= 3 and lower(name) not in ('end', 'new', 'old', 'mode', 'value', 'state')),
    named as (select distinct k, node_id, label from (select distinct k from ok where k <> '') join n on node_type = 'cluster' and contains(lower(label), k)),
    canon as (select k, min_by(label, node_id) as label from named group by k),
    one as (select change_id, k, node_id from ok join canon using (k) join n on node_id = upper(type) || '::' || canon.label || '::' || name),
    two as (select change_id, k, node_id, row_number() over (partition by change_id order by node_id) as r from ok
      join n on node_type = type and contains(lower(label), lower(name)) and (k = '' or low = '' or contains(low, k)) where change_id not in (select change_id from one)),
    seeds as materialized (select change_id, k, node_id from one union select change_id, k, node_id from two where r <= 20 union select change_id, k, node_id from ok join named using (k)),
    u as materialized (select src, dst from e union select dst, src from e), s as (select distinct node_id as seed from seeds),
    h as materialized (select seed, dst as node_id from s join u on src = seed), reach as (select seed, node_id from h union select seed, dst from h join u on src = node_id),
    hits as (select distinct change_id, n.node_id, node_type from seeds join reach on seed = seeds.node_id join n on n.node_id = reach.node_id
      where node_type = 'test_case' and (k = '' or low = '' or contains(low, k) or contains(k, low)) or node_type = 'requirement' and (k = '' or low = '' or contains(low, k))),
    sec as (select k, node_id, row_number() over (partition by k order by node_id) as r from (select distinct k from seeds where k <> '') join n on node_type = 'section' and contains(low, k)),
    every as (select * from hits union select change_id, node_id, 'section' from (select distinct change_id, k from seeds) join sec using (k) where r <= 3),
    graph as (select change_id, node_id, node_type, row_number() over (partition by change_id order by node_id) as r from every),
    lost as (select change_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(cluster || ' ' || type || ' ' || name), '[^a-z0-9]+'), lambda w: length(w) >= 3 and w not in ('mode', 'type', 'new', 'the')))) as w
      from c where change_id not in (select change_id from seeds)),
    words as (select node_id, node_type, unnest(list_distinct(list_filter(regexp_split_to_array(lower(label), '[^a-z0-9]+'), lambda w: length(w) >= 3))) as w from n where node_type in ('test_case', 'requirement')),
    spoken as (select change_id, node_id, node_type, row_number() over (partition by change_id order by count(*) desc, node_id) as r from lost join words using (w) group by change_id, node_id, node_type)
    select change_id, node_id, node_type, 'graph' as source from graph where r <= 10 union all select change_id, node_id, node_type, 'text' from spoken where r <= 10""",
)
def structured_change_search(spark, sf_dir):
    return S.structured_search(changes(spark, sf_dir), *graph(spark, sf_dir))


_NAMES = "(select distinct name from (select p_name || ' ' || (p_partkey // 7) as name from part union all select 'attribute::' || p_brand from part union all select 'TC::' || o_orderkey from orders where o_orderstatus = 'P' union all select 'tc::' || (o_orderkey // 10) from orders union all select '#' || p_size || '::' from part))"


@query(
    "node_id_resolution",
    f"""with n as (select node_id, lower(node_id) as low from {_NODES}), a as (select name, lower(name) as q from {_NAMES}),
    h as (select name, node_id, case when node_id = name then 1 when low = q then 2 when starts_with(low, q) then 3 else 4 end as tier from a join n on contains(low, q)),
    r as (select *, row_number() over (partition by name order by tier, length(node_id), node_id) as i from h)
    select a.name, node_id, tier::int as tier from a left join (select * from r where i = 1) r on r.name = a.name""",
)
def node_id_resolution(spark, sf_dir):
    p, o = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    whole = lambda c, n: F.floor(F.col(c) / n).cast("string")
    names = p.select(F.concat_ws(" ", "p_name", whole("p_partkey", 7)).alias("name")).union(p.select(F.concat(F.lit("attribute::"), "p_brand"))).union(o.filter("o_orderstatus = 'P'").select(F.concat(F.lit("TC::"), "o_orderkey")))
    names = names.union(o.select(F.concat(F.lit("tc::"), whole("o_orderkey", 10)))).union(p.select(F.concat(F.lit("#"), F.col("p_size").cast("string"), F.lit("::"))))
    return S.resolved_ids(names, graph(spark, sf_dir)[0])


@query(
    "names_in_texts",
    """with w as (select distinct unnest(regexp_extract_all(text, '[A-Za-z]{2,}')) as needle from benchmark), t as (select distinct left(text, 200) as text from documents where text is not null)
    select needle, count(*) as n from w join t on contains(t.text, needle) group by needle""",
)
def names_in_texts(spark, sf_dir):
    """Words of the benchmark, long and short, and how many openings of documents hold them as a substring."""
    needles = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0))).alias("needle"))
    texts = table(spark, sf_dir, "documents").select(F.left("text", F.lit(200)).alias("text"))
    return G.contained(needles, texts).groupBy("needle").agg(F.count("*").alias("n"))


_EGO_STEP = """h{0}r as (select f.seed, f.k, t.dst, t.d from h{1} f join lateral_{0} t on t.k = f.k and t.src = f.node_id where f.d <= 50),
    h{0} as (select seed, k, dst as node_id, min(d) as d from h{0}r where not exists (select 1 from {2} p where p.seed = h{0}r.seed and p.node_id = h{0}r.dst) group by 1, 2, 3)"""


@query(
    "graph_ego_pruned",
    f"""with n as materialized (select *, lower(cluster) as low from {_NODES}), e as {_EDGES}, u as materialized (select src, dst from e union select dst, src from e),
    g as (select src, count(*) as d from u group by 1), a as materialized (select node_id, node_type, low, coalesce(d, 0) as d from n left join g on src = node_id),
    h0 as (select node_id as seed, low as k, node_id, 0::bigint as d from a where node_type = 'requirement'),
    fit as materialized (select o.k, src, dst, a.d, row_number() over (partition by o.k, src order by a.d, dst) as r from u join a on a.node_id = dst join (select distinct k from h0) o on o.k = '' or a.low = '' or a.low = o.k or a.node_type = 'cluster'),
    lateral_1 as (select * from fit), lateral_2 as (select * from fit where r <= 20),
    {_EGO_STEP.format(1, 0, "h0")}, s1 as (select seed, node_id from h0 union all select seed, node_id from h1), {_EGO_STEP.format(2, 1, "s1")}
    select seed, node_id, 0 as hop from h0 where true union all select seed, node_id, 1 from h1 union all select seed, node_id, 2 from h2""",
)
def graph_ego_pruned(spark, sf_dir):
    n, e = graph(spark, sf_dir)
    return S.ego(n.filter("node_type = 'requirement'"), n, e, hops=2, hub=50)


_DOT = "round(list_dot_product(q.embedding::double[], c.embedding::double[]), 6)"


def _vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.when(F.col("vec_id") % 300 != 0, F.concat(F.lit("Group "), F.col("label") % 10)).alias("cluster"))
    return q, e.select("vec_id", F.col("embedding").alias("v"), F.concat(F.lit("group "), "label").alias("label"))


@query(
    "vec_filtered_topk",
    f"""select query_id, vec_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from
    (select q.vec_id as query_id, c.vec_id, {_DOT} as score from embeddings q join embeddings c
      on q.vec_id % 300 = 0 or contains('group ' || c.label, 'group ' || (q.label % 10)) or contains('group ' || (q.label % 10), 'group ' || c.label) where q.vec_id % 100 = 0)) where rank <= 10""",
)
def vec_filtered_topk(spark, sf_dir):
    q, v = _vectors(spark, sf_dir)
    return V.search(V.with_filter(q, v), v).select("query_id", "vec_id", "score", "rank")


@query(
    "vec_lists_exact",
    f"""select query_id, vec_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from
    (select q.vec_id as query_id, c.vec_id, {_DOT} as score from embeddings q, embeddings c where q.vec_id % 100 = 0)) where rank <= 10""",
)
def vec_lists_exact(spark, sf_dir):
    """The inverted lists in their exact mode: every vector is in one list, and all are searched."""
    return _index(spark, sf_dir).search(_vectors(spark, sf_dir)[0], probes=None).select("query_id", "vec_id", "score", "rank")


@query("vec_lists_probed")
def vec_lists_probed(spark, sf_dir):
    """Ten lists of each query; recall is measured in the tests."""
    return _index(spark, sf_dir).search(_vectors(spark, sf_dir)[0], probes=10)


def _index(spark, sf_dir):
    return L.Lists.build(_vectors(spark, sf_dir)[1].select("vec_id", "v"), f"{shared_dir(spark)}/lists-{uuid.uuid4().hex}")
