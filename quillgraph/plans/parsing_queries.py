"""Queries whose parsers run in Python, and those that use the model column."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import tokens
from ..operators import entities as E
from ..operators import model as M
from ..sources import html as H
from ..streaming import ingest as I
from .catalog import query
from .text_queries import docs, table


@query("html_section_tree")
def html_section_tree(spark, sf_dir):
    return H.heading_sections(table(spark, sf_dir, "pages"), "page_id", "html")


@query("html_clean_text")
def html_clean_text(spark, sf_dir):
    return H.clean_text(table(spark, sf_dir, "pages"), "page_id", "html")


_TOKENS = "regexp_split_to_array(lower(regexp_replace({t}, '([a-z])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+')"
_NAMES = "select distinct token as name from (select unnest(list_filter(" + _TOKENS.format(t="text") + ", lambda x: length(x) >= 7)) as token from benchmark) union select name from (select array_to_string(w[i:i + k - 1], ' ') as name from (select list_filter(" + _TOKENS.format(t="text") + ", lambda x: x <> '') as w from benchmark), (select unnest(range(2, 9)) as k), (select unnest([1, 5, 9]) as i) where i + k - 1 <= len(w)) where length(name) >= 7"


@query(
    "entity_dictionary_join",
    f"""with n as ({_NAMES}), d as (select row, doc_id, unnest(w) as x0, generate_subscripts(w, 1) as i
      from (select row_number() over () as row, doc_id, list_filter({_TOKENS.format(t="coalesce(text, '')")}, lambda x: x <> '') as w from documents)),
    l as (select doc_id, x0, {", ".join(f"lead(x0, {j}) over o as x{j}" for j in range(1, 8))} from d window o as (partition by row order by i)),
    r as (select doc_id, unnest([{", ".join(" || ' ' || ".join(f"x{i}" for i in range(k)) for k in range(1, 9))}]) as name from l)
    select distinct doc_id as key, name as entity_id from r join n using (name) where name not in ({", ".join(repr(x) for x in (*E.BLOCKED, *V.NEEDS_CLUSTER))})""",
)
def entity_dictionary_join(spark, sf_dir):
    """Names of one to eight tokens from the benchmark items, met in all documents."""
    t = F.col("t")
    b = table(spark, sf_dir, "benchmark").select(tokens(F.col("text")).alias("t"))
    one = b.select(F.explode("t").alias("name"))
    runs = F.flatten(F.array(*[F.array(*[F.when(F.size(t) >= i + k - 1, F.array_join(F.slice(t, i, k), " ")) for i in (1, 5, 9)]) for k in range(2, 9)]))
    names = one.union(b.select(F.explode(runs))).filter("length(name) >= 7").distinct()
    names = names.select(F.col("name").alias("entity_id"), "name", F.lit("x").alias("cluster"))
    return E.matched(docs(spark, sf_dir), "doc_id", "text", names).select("key", "entity_id")


@query("model_column")
def model_column(spark, sf_dir):
    out = M.complete(docs(spark, sf_dir), F.col("text"), "summary string, n_chars int, verdict string")
    return out.select("doc_id", "reply.summary", "reply.n_chars", "reply.verdict")


@query("event_windows", "select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def event_windows(spark, sf_dir):
    return I.event_windows(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("incremental_changes", "select doc_id from documents where doc_id % 2 = 1 and coalesce(text, '') not in (select coalesce(text, '') from documents where doc_id % 2 = 0) qualify row_number() over (partition by text order by doc_id) = 1")
def incremental_changes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = d.filter("doc_id % 2 = 0").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    return I.changed(d.filter("doc_id % 2 = 1"), store, "doc_id", "text").select("doc_id")
