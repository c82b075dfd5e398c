"""Queries over results kept by content, and over source directories that the given tables stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cached as C
from ..operators import directories as D
from ..operators.lineage import scratch
from .catalog import query
from .text_queries import _D, _SENT, docs, table


def _with_digits(texts):
    each = texts.select("_digest", F.posexplode(T.sentences(F.col("text"))).alias("at", "sentence"))
    return each.filter(F.col("sentence").rlike("[0-9]"))


@query(
    "extraction_cached",
    f"""with s as (select doc_id, text, unnest(list_transform(range(len(l)), lambda i: {{'at': i, 's': l[i + 1]}})) as r from (select doc_id, text, {_SENT} as l from {_D})),
    known as (select distinct text from {_D} where doc_id in (select doc_id from labels))
    select doc_id, r['at']::int as at, r['s'] as sentence, text not in (select text from known) as computed from s where regexp_matches(r['s'], '[0-9]')""",
)
def extraction_cached(spark, sf_dir):
    """Sentences with digits, where the texts of labelled documents were done in an earlier pass."""
    d, path = docs(spark, sf_dir).select("doc_id", "text", C.digest(["text"]).alias("_digest")), scratch(spark, "extracted")
    labelled = d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    C.through(labelled, ["text"], _with_digits, path, "1", ["doc_id"])
    now = C.through(d, ["text"], _with_digits, path, "1", ["doc_id"])
    return now.records.select("doc_id", "at", "sentence", F.col("batch").eqNullSafe(F.lit(now.batch)).alias("computed"))


_SLUG = r"regexp_replace(regexp_replace(regexp_replace(lower({x}), '\s+cluster\s*$', ''), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_PARTS = "(select *, p_type || ' ' || p_name || '/' || p_brand || ' Cluster' as name from part)"
_DIRS = f"""(select case p_partkey % 7 when 0 then k when 1 then replace(k, '-', '') || '-Server' when 2 then {_SLUG.format(x="p_type || ' ' || p_name")} when 3 then {_SLUG.format(x="p_name || ' ' || p_brand")}
      when 4 then replace({_SLUG.format(x="p_name || ' ' || p_brand")}, '-', '') || '-client' when 5 then 'X-' || k || '-more' else 'p-' || p_partkey end as name, '/src/' || p_partkey as path
    from (select *, {_SLUG.format(x="name")} as k from {_PARTS}))"""


@query(
    "directory_match",
    f"""with c as materialized (select distinct name as cluster, {_SLUG.format(x="name")} as slug, replace({_SLUG.format(x="name")}, '-', '') as flat from {_PARTS}),
    d as materialized (select dir, path, regexp_replace(replace(dir, '-', ''), '(server|client)$', '') as plain from (select lower(name) as dir, min(path) as path from {_DIRS} group by 1)),
    p as (select cluster, path, dir, case when slug = dir then 1 when flat = plain then 2 when length(plain) > 0 and (contains(flat, plain) or contains(plain, flat)) and least(length(flat), length(plain)) >= 6
        then case when least(length(flat), length(plain)) > 0.7 * length(slug) then 3 else 6 end end as a, least(length(flat), length(plain)) as n from c join d on contains(flat, plain) or contains(plain, flat)),
    q as (select cluster, path, dir, least(length(slug), length(dir)) as n, starts_with(slug, dir) or starts_with(dir, slug) as begins from c join d on contains(slug, dir) or contains(dir, slug) where least(length(slug), length(dir)) >= 4),
    best as (select cluster, first(struct_pack(path, a) order by a in (1) desc, a = 2 desc, n desc, dir) as m from p where a is not null group by cluster),
    every as (select cluster, m.path as path, m.a as tier, 0 as n, '' as dir from best union all select cluster, path, 4, 0, dir from q where begins union all select cluster, path, 5, -n, dir from q)
    select cluster, path, case tier when 3 then 2 when 4 then 3 when 5 then 4 when 6 then 5 else tier end::int as tier from (select *, row_number() over (partition by cluster order by tier, n, dir) as r from every) where r = 1""",
)
def directory_match(spark, sf_dir):
    """Parts stand for clusters, and give names of directories that each of the five tiers has to find."""
    p = table(spark, sf_dir, "part").withColumn("name", F.concat("p_type", F.lit(" "), "p_name", F.lit("/"), "p_brand", F.lit(" Cluster")))
    both = lambda a, b: D.slug(F.concat(a, F.lit(" "), b))
    flat = lambda x: F.replace(x, F.lit("-"), F.lit(""))
    k, way = D.slug(F.col("name")), F.col("p_partkey") % 7
    names = [k, F.concat(flat(k), F.lit("-Server")), both("p_type", "p_name"), both("p_name", "p_brand"), F.concat(flat(both("p_name", "p_brand")), F.lit("-client")), F.concat(F.lit("X-"), k, F.lit("-more"))]
    name = F.concat(F.lit("p-"), F.col("p_partkey").cast("string"))
    for i, x in enumerate(names):
        name = F.when(way == i, x).otherwise(name)
    return D.matched(p.select("name"), p.select(name.alias("name"), F.concat(F.lit("/src/"), F.col("p_partkey").cast("string")).alias("path")))


@query(
    "source_texts",
    f"""with f as (select doc_id, text, lpad(doc_id::varchar, 12, '0') || case lang when 'en' then '.cpp' when 'fr' then '.H' when 'de' then '.md' else '.hpp' end as name, coalesce(source, '') as s from {_D}),
    g as (select '/' || s as path, name, text from f union all select '/block/' || doc_id // 8, name, text from f),
    h as (select path, name, '// ===== ' || name || ' =====' || chr(10) || text as part from g where not ends_with(name, '.md')),
    b as (select *, coalesce(sum(length(part)) over (partition by path order by name rows between unbounded preceding and 1 preceding), 0) as before from h),
    k as (select path, count(*)::int as n_files, string_agg(part, chr(10) || chr(10) order by name) as w from b where before < 10000 group by path)
    select path, n_files, md5(case when length(w) <= 10000 then w else left(w, 8000) || chr(10) || chr(10) || '// ... (truncated) ...' || chr(10) || chr(10) || right(w, 2000) end) as source_md5 from k""",
)
def source_texts(spark, sf_dir):
    """Documents stand for files, each in the directory of its source and in one of a block of eight."""
    ending = F.when(F.col("lang") == "en", ".cpp").when(F.col("lang") == "fr", ".H").when(F.col("lang") == "de", ".md").otherwise(".hpp")
    d = docs(spark, sf_dir).withColumn("name", F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), ending))
    paths = F.array(F.concat(F.lit("/"), F.coalesce("source", F.lit(""))), F.concat(F.lit("/block/"), F.floor(F.col("doc_id") / 8).cast("string")))
    out = D.source_text(d.select(F.explode(paths).alias("path"), "name", "text"))
    return out.select("path", "n_files", F.md5("source").alias("source_md5"))
