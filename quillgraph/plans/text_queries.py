"""Queries over texts: windows, tokens, cleaning, rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import rules as R
from ..sources.files import processed
from .catalog import query

_SPLIT = "regexp_split_to_array(lower(regexp_replace({t}, '([a-z])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+')"
_TOK = "list_filter(" + _SPLIT + ", lambda x: x <> '')"
STOP = ["the", "and", "der", "die", "los", "les", "que", "for", "with", "that"]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


_D = "(select doc_id, coalesce(text, '') as text, lang, source from documents)"
_SENT = "list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])[ \\t\\n]+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), '[\\x01\\n]'), lambda s: trim(s)), lambda s: s <> '')"


@query(
    "char_window_chunks",
    f"""select doc_id, st::int as start, substr(t, st::int + 1, 1000) as chunk from
    (select doc_id, trim(text) as t, unnest(generate_series(0, greatest(length(trim(text)) - 1, 0), 800)) as st from {_D}) where length(t) > 0""",
)
def char_window_chunks(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("c", F.explode(T.char_windows(F.col("text"))))
    return d.select("doc_id", "c.start", "c.chunk")


@query("token_stats", f"select doc_id, len({_TOK.format(t='text')})::int as n_tokens, len(list_distinct({_TOK.format(t='text')}))::int as n_distinct from {_D}")
def token_stats(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("t", T.tokens(F.col("text")))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"))


@query("normalized_names", "select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') as flat, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') as flat_brand from part")
def normalized_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.flat_name(F.col("p_name")).alias("flat"), T.flat_name(F.col("p_brand")).alias("flat_brand"))


@query(
    "keyword_extract",
    f"""with k as (select doc_id, list_filter({_TOK.format(t="text")}, lambda x: length(x) >= 2 and not list_contains({STOP}, x)) as t from {_D}),
    u as (select doc_id, t, unnest(range(1, len(t) + 1)) as i from k), f as (select doc_id, t[i] as w, min(i) as i from u group by 1, 2),
    r as (select *, row_number() over (partition by doc_id order by i) as n from f),
    a as (select doc_id, string_agg(w, ' ' order by n) as keywords from r where n <= 24 group by doc_id)
    select doc_id, coalesce(keywords, '') as keywords from k left join a using (doc_id)""",
)
def keyword_extract(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.array_join(T.keywords(F.col("text"), STOP), " ").alias("keywords"))


@query("strip_lines_regex", f"select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda l: not regexp_matches(l, '[0-9]')), chr(10)) as text from {_D}")
def strip_lines_regex(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.drop_lines(F.col("text"), "[0-9]").alias("text"))


@query("strip_first_last_lines", f"select doc_id, array_to_string(string_split(text, chr(10))[2:greatest(len(string_split(text, chr(10))) - 1, 1)], chr(10)) as text from {_D}")
def strip_first_last_lines(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.drop_ends(F.col("text"), 1, 1).alias("text"))


@query("squeeze_and_replace", f"select doc_id, regexp_replace(regexp_replace(text, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[0-9]+', '#', 'g') as text from {_D}")
def squeeze_and_replace(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.regexp_replace(T.squeeze(F.col("text")), "[0-9]+", "#").alias("text"))


@query("strip_block_between", f"select doc_id, substr(regexp_replace(chr(10) || text, '\\n(?:[^\\n]*\\.[^\\n]*\\|[^\\n]*|[^\\n]*\\|[^\\n]*\\.[^\\n]*|[^\\n]*\\|(?s:.*?)(?:\\.[^\\n]*|\\z))', '', 'g'), 2) as text from {_D}")
def strip_block_between(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.drop_block(F.col("text"), "|", ".").alias("text"))


@query("ignore_rules_line", f"select doc_id, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda l: not contains(l, 'and')), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g') as text from {_D}")
def ignore_rules_line(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.ignore(F.col("text"), "and").alias("text"))


@query("sentence_split", f"select doc_id, len(s)::int as n_sentences, coalesce(list_max(list_transform(s, lambda x: length(x))), 0)::int as longest from (select doc_id, {_SENT} as s from {_D})")
def sentence_split(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("s", T.sentences(F.col("text")))
    return d.select("doc_id", F.size("s").alias("n_sentences"), F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0)).alias("longest"))


@query("csv_row_prose", "select n_nationkey, 'n_name: ' || n_name || ' | n_regionkey: ' || n_regionkey as prose from nation")
def csv_row_prose(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", T.prose(["n_name", "n_regionkey"]).alias("prose"))


@query("sha2_doc_keys", f"select doc_id, left(sha256(text), 16) as key from {_D}")
def sha2_doc_keys(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.left(F.sha2("text", 256), F.lit(16)).alias("key"))


@query("noise_detector", f"select doc_id, (length(text) >= 20 and len(regexp_extract_all(text, '[{{}}#;:]')) / length(text) > 0.1) as noisy from {_D}")
def noise_detector(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.noisy(F.col("text")).alias("noisy"))


@query("language_word_match", f"select lang, count(*) as n from {_D} where regexp_matches(lower(text), '(^|[^a-z])der([^a-z]|$)') group by lang")
def language_word_match(spark, sf_dir):
    return docs(spark, sf_dir).filter(F.lower("text").rlike("(^|[^a-z])der([^a-z]|$)")).groupBy("lang").agg(F.count("*").alias("n"))


def _sentences(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "text"))
    return d


_S = f"(select doc_id, i - 1 as pos, s[i] as text from (select doc_id, s, unnest(range(1, len(s) + 1)) as i from (select doc_id, {_SENT} as s from {_D})))"


def _m(p):
    return f"regexp_matches(text, '{p}')"


_G = R.GENERIC.signals
_SCORES = {
    "timing": f"case when {_m(_G['digit'])} then 4.0 else 0 end + case when {_m(_G['digit'])} and {_m(_G['comma'])} then 0.5 else 0 end + case when {_m(_G['digit'])} and {_m(_G['of'])} then 1.0 else 0 end",
    "state": f"case when {_m(_G['of'])} then 3.5 else 0 end + case when {_m(_G['mail'])} then 1.0 else 0 end",
    "definition": f"case when {_m(_G['and'])} then 3.5 else 0 end + case when {_m(_G['and'])} and {_m(_G['comma'])} then 0.5 else 0 end",
    "conditional": f"case when {_m(_G['der'])} then 3.0 else 0 end",
    "cross": f"case when {_m(_G['comma'])} then 2.0 else 0 end",
    "general": "1.0",
}
_LONG = " union all ".join(f"select doc_id, pos, '{k}' as kind, {i} as prio, ({e})::double as score from {_S}" for i, (k, e) in enumerate(_SCORES.items()))


@query(
    "rule_winner_confidence",
    f"""with l as ({_LONG}), r as (select *, row_number() over (partition by doc_id, pos order by score desc, prio) as n,
      sum(score) over (partition by doc_id, pos) as total from l),
    t as (select doc_id, max(pos) as pos0, pos, max(case when n = 1 then kind end) as requirement_type, max(case when n = 1 then score end) as score,
      max(case when n = 2 then score end) as second, max(total) as total, count(case when score > 1 then 1 end) as c from r group by doc_id, pos)
    select doc_id, pos::int as pos, requirement_type, score, round(greatest(0.3, least(1.0, score / total)), 3) as confidence, score / (score + second) < 0.7 as ambiguous,
      (c - case when score > 1 then 1 else 0 end)::int as n_alternatives from t""",
)
def rule_winner_confidence(spark, sf_dir):
    out = R.classify(_sentences(spark, sf_dir), "text", R.GENERIC)
    return out.select("doc_id", "pos", "requirement_type", "score", "confidence", "ambiguous", "n_alternatives")


_REASON = "case when length(text) < 30 then 'too_short' when contains(text, '|') then 'table_fragment' when regexp_matches(text, '^[0-9]') then 'numeric_row' when regexp_matches(text, '^[a-z]') then 'lowercase_fragment' when not regexp_matches(text, '[.!?]$') then 'open_end' else 'valid' end"


@query("rule_filter_reasons", f"select doc_id, pos::int as pos, {_REASON} as verdict from {_S}")
def rule_filter_reasons(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "pos", R.verdict(R.GENERIC).alias("verdict"))


@query("rule_reason_histogram", f"select {_REASON} as verdict, count(*) as n from {_S} group by 1")
def rule_reason_histogram(spark, sf_dir):
    return _sentences(spark, sf_dir).groupBy(R.verdict(R.GENERIC).alias("verdict")).agg(F.count("*").alias("n"))


_INTENTS = {"mail": "[a-z]@[a-z]", "number": "[0-9]{3}", "question": "[?]", "table": "[|]"}


@query("intent_flags", "select doc_id, concat_ws('|', " + ", ".join(f"case when regexp_matches(text, '{p}') then '{n}' end" for n, p in _INTENTS.items()) + f") as intents from {_D}")
def intent_flags(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.array_join(R.intents(F.col("text"), _INTENTS), "|").alias("intents"))


@query("clause_extract", f"select doc_id, array_to_string(regexp_extract_all(text, '(^|[^A-Za-z])of ([^,.!?\\n]+)', 2), '|') as clauses from {_D}")
def clause_extract(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.array_join(R.clauses(F.col("text"), "of"), "|").alias("clauses"))


@query("near_dup_160", f"select count(*) as n, min(doc_id) as first_id, key from (select doc_id, left(regexp_replace(lower(text), '[ \\t\\n]+', ' ', 'g'), 160) as key from {_D}) group by key")
def near_dup_160(spark, sf_dir):
    key = F.left(F.regexp_replace(F.lower("text"), "[ \t\n]+", " "), F.lit(160))
    return docs(spark, sf_dir).groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("html_heading_sections", "select page_id, list_sum(list_transform(h, lambda x: 1))::int as n_headings, coalesce(h[1], '') as first_heading from (select page_id, regexp_extract_all(html, '<h[1-6][^>]*>([^<]*)</h[1-6]>', 1) as h from pages) where len(h) > 0")
def html_heading_sections(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("h", F.regexp_extract_all("html", F.lit("<h[1-6][^>]*>([^<]*)</h[1-6]>"), F.lit(1)))
    return p.filter(F.size("h") > 0).select("page_id", F.size("h").alias("n_headings"), F.col("h")[0].alias("first_heading"))


_RULED = "regexp_replace(list_aggregate(list_filter(string_split(regexp_replace(text, '[0-9]+', '#', 'g'), chr(10)), lambda l: not regexp_matches(l, '[#@]{2}|http')), 'string_agg', chr(10)), '\\n{3,}', chr(10) || chr(10), 'g')"


@query(
    "cleaned_by_rules",
    f"""with d as (select doc_id, source, lang, coalesce({_RULED}, '') as t from {_D}), l as (select *, string_split(t, chr(10)) as l from d),
    r as (select doc_id, case when source = 'src1' then l[:len(l) - 1] when source = 'src2' and lang in ('en', 'de') then l[2:] else l end as l,
      3 + (source = 'src1')::int + coalesce(source = 'src2' and lang in ('en', 'de'), false)::int as n from l)
    select doc_id, sha256(array_to_string(l, chr(10))) as content_sha256, n as rules_applied from r""",
)
def cleaned_by_rules(spark, sf_dir):
    """Shared rules, then those of two sources, one of them for some kinds of file only."""
    shared = [{"type": "replace_regex", "pattern": "[0-9]+", "replacement": "#"}, {"type": "strip_regex", "pattern": "[#@]{2}|http"}, {"type": "normalize_whitespace"}]
    own = {"src1": [{"type": "strip_last_lines", "count": 1}], "src2": [{"type": "strip_first_lines", "count": 1, "apply_to": ["en", ".de"]}]}
    files = docs(spark, sf_dir).select("doc_id", F.col("text").alias("content"), F.col("source").alias("source_id"), F.col("lang").alias("ext"))
    return processed(files, shared, own)[0].select("doc_id", F.sha2("content", 256).alias("content_sha256"), "rules_applied")
