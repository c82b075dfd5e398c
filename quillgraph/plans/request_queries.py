"""Requests on the graph that the star schema stands for, one for each supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import requests as Q
from .catalog import query
from .search_queries import _NODES, graph
from .text_queries import table

_KINDS = ("cluster_tests", "phrase_tests", "entity_coverage", "requirements", "dependencies", "keywords", "other")
_EDGES = """(select distinct 'TC::' || l_orderkey as src, 'ATTRIBUTE::' || p_brand || '::' || p_name || ' ' || p_partkey as dst, 'tests' as edge_type from lineitem join part on p_partkey = l_partkey
  union all select distinct 'TC::' || l_orderkey, 'REQ::' || l_suppkey, 'verifies_requirement' from lineitem
  union all select 'TC::' || o_orderkey, 'CLUSTER::Brand#' || (1 + o_custkey % 25), 'in_context' from orders
  union all select distinct 'CLUSTER::' || a.p_brand, 'CLUSTER::' || b.p_brand, 'depends_on' from part a join part b on b.p_partkey = a.p_partkey + 1 and a.p_size = b.p_size)"""
_REQUESTS = f"""(select s_suppkey as request_id, ['{"', '".join(_KINDS)}'][1 + s_suppkey % 7] as kind, case when s_suppkey % 5 = 0 then '' else 'brand#' || (1 + s_suppkey % 25) end as k,
  coalesce(p_name || ' ' || p_partkey, 'none') as name, ['supplier', lower(right(s_name, 2)), 'order'] as words, 'order of ' || left(lower(s_name), 1) as phrase, s_suppkey % 2 = 0 as outward from supplier left join part on p_partkey = s_suppkey)"""


def _edges(spark, sf_dir):
    """Orders' edges come once for each line item: answers don't count repeated edges, so they are not made distinct."""
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), "p_size", F.concat(F.lit("CLUSTER::"), "p_brand").alias("dst"))
    of = o.select(F.concat(F.lit("TC::"), "o_orderkey"), F.concat(F.lit("CLUSTER::Brand#"), (1 + F.col("o_custkey") % 25).cast("string")), F.lit("in_context"))
    verifies = li.select(F.concat(F.lit("TC::"), "l_orderkey"), F.concat(F.lit("REQ::"), "l_suppkey"), F.lit("verifies_requirement"))
    attribute = p.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("::", F.lit("ATTRIBUTE"), "p_brand", F.concat_ws(" ", "p_name", "p_partkey")).alias("dst"))
    tests = li.select("l_orderkey", "l_partkey").join(attribute, "l_partkey").select(F.concat(F.lit("TC::"), "l_orderkey").alias("src"), "dst", F.lit("tests").alias("edge_type"))
    depends = p.join(b, ["p_partkey", "p_size"]).select(F.concat(F.lit("CLUSTER::"), "p_brand"), "dst", F.lit("depends_on")).distinct()
    return tests.union(verifies).union(of).union(depends)


def _requests(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    name = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("s_suppkey"), F.concat_ws(" ", "p_name", "p_partkey").alias("name"))
    kind = F.get(F.array(*[F.lit(x) for x in _KINDS]), (k % 7).cast("int"))
    phrase = F.array(F.lit("Test"), F.lit("order"), F.lit("of"), F.left("s_name", F.lit(1)))
    words = F.when(kind == "phrase_tests", phrase).otherwise(F.array(F.lit("supplier"), F.right("s_name", F.lit(2)), F.lit("order")))
    return s.join(name, "s_suppkey", "left").select(
        k.alias("request_id"), kind.alias("kind"), F.when(k % 5 != 0, F.concat(F.lit("Brand#"), (1 + k % 25).cast("string"))).alias("cluster"), F.lit("Attribute").alias("entity_type"),
        F.coalesce("name", F.lit("none")).alias("entity_name"), words.alias("keywords"), F.when(k % 2 == 0, "outgoing_depends_on").alias("direction"), F.lit(None).cast("int").alias("most"),
    )


@query(
    "requests_answered",
    f"""with n as materialized (select *, lower(cluster) as low, lower(label) as name, lower(label || ' ' || cluster) as t from {_NODES}), e as materialized {_EDGES}, r as materialized {_REQUESTS},
    clusters as (select * from n where node_type = 'cluster'), tests as (select * from n where node_type = 'test_case'),
    ct as (select request_id, 'found' as status, null::varchar as "of", node_id from r join tests on kind = 'cluster_tests' and k <> '' and low <> '' and (contains(low, k) or contains(k, low))
      union select request_id, 'found', null, src from r join clusters c on kind = 'cluster_tests' and k <> '' and (contains(c.name, k) or contains(k, c.name)) join e on dst = c.node_id and edge_type in ('tests', 'in_context')),
    pt as (select request_id, 'found' as status, null::varchar as "of", node_id from r join tests on kind = 'phrase_tests' and contains(t, phrase)),
    probe as (select request_id, min({{'p': c.name <> k, 'i': c.node_id, 'of': a.node_id}}) as m from r join clusters c on kind = 'entity_coverage' and k <> '' and contains(c.name, k) join n a on a.node_id = 'ATTRIBUTE::' || c.label || '::' || r.name group by 1),
    same as (select request_id, min(node_id) as o from r join n on kind = 'entity_coverage' and node_type = 'attribute' and n.name = lower(r.name) group by 1),
    entity as (select request_id, coalesce(m['of'], o) as "of" from r left join probe using (request_id) left join same using (request_id) where kind = 'entity_coverage'),
    ec as (select distinct request_id, case when "of" is null then 'missing' when src is null then 'gap' else 'covered' end as status, "of", src as node_id from entity left join e on dst = "of" and edge_type = 'tests'),
    hits as (select request_id, kind, node_type, node_id, len(list_filter(list_distinct(words), lambda w: contains(t, w))) as score from r join n on kind in ('requirements', 'keywords') and node_type in ('requirement', 'test_case') and (k = '' or contains(low, k))),
    req as (select *, row_number() over (partition by request_id order by score desc, node_id) as i from hits where kind = 'requirements' and node_type = 'requirement' and score > 0),
    verified as (select *, row_number() over (partition by dst order by src) as j from e where edge_type = 'verifies_requirement'),
    rc as (select request_id, case when src is null then 'uncovered' else 'covered' end as status, node_id as "of", src as node_id, i as f from req left join verified on dst = node_id and j <= 5 where i <= 20),
    kw as (select request_id, 'found' as status, null::varchar as "of", node_id, row_number() over (partition by request_id order by score desc, node_id) as f from hits where kind = 'keywords' and score > 0),
    target as (select request_id, outward, node_id from r join clusters c on kind = 'dependencies' and k <> '' and contains(c.name, k)),
    dep as (select distinct t.request_id, 'found' as status, null::varchar as "of", case when outward then dst else src end as node_id from target t join e on edge_type = 'depends_on' and t.node_id = case when outward then src else dst end),
    d as (select * from dep where not exists (select 1 from target t where t.request_id = dep.request_id and t.node_id = dep.node_id)),
    every as (select *, 0 as f from ct union all select *, 0 from pt union all select *, 0 from ec union all select *, 0 from d union all select * from rc union all select * from kw where f <= 10),
    a as (select request_id, status, "of", node_id, row_number() over (partition by request_id order by f, "of", node_id) as "at" from every)
    select r.request_id, coalesce(case when kind = 'other' then 'unknown' when k = '' and kind in ('cluster_tests', 'dependencies') then 'invalid' end, status, 'none') as status, a."at"::int as "at", "of", node_id from r left join a on a.request_id = r.request_id""",
)
def requests_answered(spark, sf_dir):
    """Each kind of request, one that is unknown, and some that lack a cluster."""
    nodes, _ = graph(spark, sf_dir)
    return Q.answered(_requests(spark, sf_dir), nodes.withColumn("text", F.concat_ws(" ", "label", "cluster")), _edges(spark, sf_dir))
