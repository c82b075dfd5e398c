"""Queries over specification and test-plan HTML, changed clusters and ids in texts.

Pages are written by Spark from the given tables: two for each document, a test plan and a specification, whose rows and
paragraphs are the document's lines, a third of them with unclosed tags; and a change-marked page for each part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ids as I
from ..operators import merge as M
from ..operators.lineage import shares
from ..operators.rerank import dealt
from ..sources import plan_html as P
from ..sources import revised as R
from .catalog import query
from .text_queries import table

_CSS = "(?:[a-zA-Z-]+:[^;{}\\n]{2,80}[;{}]|%7C[A-Za-z+]|family=[A-Za-z+%:]|data:[a-z]+/[a-z]+;base64,)"
_TIDY = "trim(regexp_replace({x}, '[ \\t]+', ' ', 'g'))"
_LINES = f"""(select doc_id, s, g, i - 1 as i, {_TIDY.format(x="l[i]")} as line from (select doc_id, coalesce(source, '') as s, coalesce(lang, '') as g,
  string_split(coalesce(text, ''), chr(10)) as l, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i from documents))"""
_STEPS = f"""(select doc_id, s, g, i, i::varchar as step, case when i % 4 = 3 then '' else s end as ref, case when i % 4 = 3 then '' else g end as pics, line as action,
  case when i % 4 = 3 then '' else length(line) || ' characters' end as expected from {_LINES})"""


def _pages(spark, sf_dir):
    """(page_id, html): a specification (2 * doc_id) and a test plan (2 * doc_id + 1) for each document."""
    escaped = F.col("text")
    for c, e in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(c), F.lit(e))
    # reading a page takes far longer than its document's bytes tell, so documents are dealt; a file's parts are too much for a task
    d = table(spark, sf_dir, "documents")
    d = d.repartition(shares(d, 1 << 13), "doc_id").select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    d = d.withColumns({"raw": F.split("text", "\n", -1), "lines": F.split(escaped, "\n", -1)})
    end = lambda *tags: F.when(F.col("doc_id") % 3 == 0, "").otherwise("".join(f"</{t}>" for t in tags))
    size = lambda i: F.length(F.trim(F.regexp_replace(F.get("raw", i), r"[ \t]+", " "))).cast("string")
    i_ = lambda i: i.cast("string")
    cell = lambda x: F.concat(F.lit("<td><p class='tableblock'>"), x, end("p", "td"))
    long = lambda x, i: F.concat(F.lit("<tr>"), cell(i_(i)), cell(F.col("source")), cell(F.col("lang")), cell(x), cell(F.concat(size(i), F.lit(" characters"))), end("tr"))
    short = lambda x, i: F.concat(F.lit("<tr>"), cell(i_(i)), cell(x), end("tr"))
    steps = F.array_join(F.transform("lines", lambda x, i: F.when(i % 4 == 3, short(x, i)).otherwise(long(x, i))), "\n")
    head = F.lit("<html><head><title>x</title><style>p{margin:0}</style></head><body><div id='toc'><ul><li>contents</li></ul></div><div id='content'>")
    sub = lambda title, *inside: F.concat(F.lit(f"<div class='sect3'><h4>{title}</h4>"), *inside, F.lit("</div>"))
    item = lambda *x: F.concat(F.lit("<li>"), *x, end("li"))
    plan = F.concat(
        head, F.lit("<div class='sect1'><h2>1. Plans of "), F.col("source"), F.lit("</h2><div class='sectionbody'><div class='sect2'><h3>Definitions</h3><p>none</p></div><div class='sect2'><h3 id='c'>[TC-DOC-"),
        (F.col("doc_id") % 9).cast("string"), F.lit("."), F.col("doc_id").cast("string"), F.lit("] in "), F.col("lang"), F.lit("</h3>"),
        sub("Purpose", F.lit("<div class='paragraph'><p>"), F.get("lines", F.lit(0)), F.lit("</p></div>")),
        sub("PICS", F.lit("<ul>"), item(F.lit("DOC.S")), item(F.lit("DOC.A"), (F.col("doc_id") % 7).cast("string")), F.lit("</ul>")),
        sub("Preconditions", F.lit("<p>.\none line\n two lines</p>")),
        sub("Required Devices", F.lit("<table><tbody><tr><td>1</td><td>DUT</td><td>under test</td></tr></tbody></table>")),
        sub("Test Procedure", F.lit("<table><thead><tr><th>Step</th><th>Ref</th><th>PICS</th><th>Action</th><th>Expected</th></tr></thead><tbody>"), steps, F.lit("</tbody></table>")),
        F.lit("</div></div></div></div><div id='footer'>end</div></body></html>"),
    )
    spec = F.concat(
        head, F.lit("<div class='sect1'><h2 id='a'><a class='anchor' href='#a'>#</a>1. Notes of "), F.col("source"), F.lit("</h2><div class='sectionbody'>"),
        F.array_join(F.transform("lines", lambda x: F.concat(F.lit("<p>"), x, end("p"))), "\n"),
        F.lit("<div class='sect2'><h3>1.1. License</h3><p>none</p></div><div class='sect2'><h3>1.2. Table</h3><div class='admonitionblock note'><p>in "), F.col("lang"),
        F.lit("</p></div><table><thead><tr><th>key</th><th>value</th></tr></thead><tbody><tr><td>id</td><td>"), F.col("doc_id").cast("string"), F.lit("</td></tr><tr><td></td><td></td></tr></tbody></table></div></div></div></div></body></html>"),
    )
    two = F.inline(F.array(F.struct((2 * F.col("doc_id")).alias("page_id"), spec.alias("html")), F.struct((2 * F.col("doc_id") + 1).alias("page_id"), plan.alias("html"))))
    return d.select(two)


@query("test_plan_steps", f"select doc_id * 2 + 1 as page_id, 'TC-DOC-' || doc_id % 9 || '.' || doc_id as test_case_id, i::int as at, step, ref, pics, action, expected from {_STEPS}")
def test_plan_steps(spark, sf_dir):
    """The rows of every test case's procedure."""
    steps = P.procedure_steps(P.test_cases(_pages(spark, sf_dir), "page_id", "html", auto=True))
    return steps.withColumnRenamed("id", "page_id").drop("position")


@query(
    "test_plan_cases",
    f"""select doc_id * 2 + 1 as page_id, 'TC-DOC-' || doc_id % 9 || '.' || doc_id as test_case_id, trim('[TC-DOC-' || doc_id % 9 || '.' || doc_id || '] in ' || g) as title,
      trim('1. Plans of ' || s) as path, max(case when i = 0 then action end) as purpose, 'DOC.S|DOC.A' || doc_id % 7 as pics, 'one line|two lines' as preconditions,
      'DUT=under test' as devices, count(*)::int as n_steps,
      md5(trim('[TC-DOC-' || doc_id % 9 || '.' || doc_id || '] in ' || g) || chr(10) || chr(10) || case when max(case when i = 0 then action end) = '' then '' else max(case when i = 0 then action end) || chr(10) || chr(10) end
        || 'DOC.S' || chr(10) || chr(10) || 'DOC.A' || doc_id % 7 || chr(10) || chr(10) || 'one line' || chr(10) || chr(10) || 'two lines' || chr(10) || chr(10) || 'DUT under test' || chr(10) || chr(10)
        || string_agg(array_to_string(list_filter([step, ref, pics, action, expected], lambda x: x <> ''), ' '), chr(10) || chr(10) order by i)) as all_md5
    from {_STEPS} group by doc_id, s, g""",
)
def test_plan_cases(spark, sf_dir):
    """Every test case with its fields; the pages that are no test plans are told by their content."""
    c = P.test_cases(_pages(spark, sf_dir), "page_id", "html", auto=True)
    devices = F.array_join(F.transform("required_devices", lambda x: F.concat(x["name"], F.lit("="), x["description"])), "|")
    return c.select(F.col("id").alias("page_id"), "test_case_id", "title", F.array_join("path", " > ").alias("path"), "purpose", F.array_join("pics", "|").alias("pics"), F.array_join("preconditions", "|").alias("preconditions"), devices.alias("devices"), F.size("test_procedure").alias("n_steps"), F.md5("all_text").alias("all_md5"))


@query(
    "spec_html_sections",
    f"""with p as (select *, line <> '' and not (length(line) >= 20 and 10 * coalesce(list_sum(list_transform(regexp_extract_all(line, '{_CSS}'), lambda x: length(x))), 0) > length(line)) as said from {_LINES})
    select doc_id * 2 as page_id, 0 as position, 'a' as section_id, 2 as level, trim('1. Notes of ' || s) as title, trim('1. Notes of ' || s) as path, repeat('p', count(*)::int) as kinds, '' as headers, md5(string_agg(line, chr(10) || chr(10) order by i)) as text_md5
      from p where said group by doc_id, s
    union all select doc_id * 2, max(case when said then 1 else 0 end)::int, '', 3, '1.2. Table', trim('1. Notes of ' || s) || ' > 1.2. Table', 'nt', 'key,value', md5(trim('in ' || g) || chr(10) || chr(10) || 'key | value' || chr(10) || '--------------' || chr(10) || 'id | ' || doc_id) from p group by doc_id, s, g""",
)
def spec_html_sections(spark, sf_dir):
    """Every section of the specifications with the kinds of its blocks (their first letters) and its text."""
    s = P.spec_sections(_pages(spark, sf_dir), "page_id", "html", auto=True)
    kinds = F.array_join(F.transform("blocks", lambda b: F.left(b["kind"], F.lit(1))), "")
    headers = F.array_join(F.flatten(F.transform("blocks", lambda b: b["headers"])), ",")
    return s.select(F.col("id").alias("page_id"), "position", "section_id", "level", "title", F.array_join("path", " > ").alias("path"), kinds.alias("kinds"), headers.alias("headers"), F.md5("full_text").alias("text_md5"))


@query(
    "revised_clusters",
    """select k as page_id, (case i when 0 then 'Door' when 1 then 'Window' when 2 then 'Pump' else 'Valve' end) || ' Cluster' as cluster, (case (k + i) % 8 when 4 then 1 when 6 then 10 else 2 end)::bigint as n_diffs
    from (select p_partkey as k, unnest(range(4)) as i from part) where (k + i) % 8 in (4, 6, 7)""",
)
def revised_clusters(spark, sf_dir):
    """Of four clusters on each part's page those with changes of their own: every class of noise and both sides of the limit
    of marks occur."""
    names, k = ["Door", "Window", "Pump", "Valve"], F.col("p_partkey")
    page = [F.lit("<body><h1>diff</h1>")]
    for i, name in enumerate(names):
        other = names[(i + 1) % 4]
        kinds = [
            "<p>no change</p>",
            '<p><ins class="diff-new">[11.712]</ins> text</p>',
            '<a href="#x"><del class="diff-old">10.1.</del><span>text</span></a>',
            '<p><ins class="diff-new">2024-05-06 07:08:09</ins><del class="diff-old">0a1b2c3d4e</del></p>',
            f'<p>the <ins class="diff-new">{name} opens</ins></p>',
            f'<td><ins class="diff-new">{other} cluster id</ins></td>' * 9,
            f'<td><ins class="diff-new">{other} cluster id</ins></td>' * 10,
            f'<p><ins class="diff-new">{other} and</ins> <del class="diff-old"><b>{name.lower()}</b></del></p>',
        ]
        body = F.element_at(F.array(*[F.lit(x) for x in kinds]), ((k + i) % 8 + 1).cast("int"))
        page += [F.lit(f'<ins class="diff-new"><h2 id="ref_{name}Cluster">{i + 1}.2. {name} <b>Cluster</b></h2></ins><h3 id="ref_{name}Other">Data of it</h3>'), body]
    html = F.concat(*page, F.lit('<div id="footer"><ins class="diff-new">Valve revision</ins></div></body>'))
    # keys are few bytes for the work on their pages, so they are dealt to all cores before these are written
    out = R.revised_clusters(dealt(table(spark, sf_dir, "part").select("p_partkey")).select(k.alias("page_id"), html.alias("html")), "page_id", "html")
    return out.withColumnRenamed("id", "page_id")


_PAIR = "case when {k} % 5 = 4 then {k} when {k} % 2 = 0 then {k} + 1 else {k} - 1 end"


@query(
    "ids_rewritten",
    f"""with n as (select s_suppkey as k, 'TC-S-1.' || ({_PAIR.format(k="s_suppkey")}) as new from supplier where s_suppkey % 5 <> 4)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'run [' || coalesce(a.new, 'TC-S-1.' || l_suppkey) || '] first' as title,
      coalesce(a.new, 'TC-S-1.' || l_suppkey) || coalesce(', ' || b.new, ', TC-S-1.' || (l_suppkey + 1)) || ' then TC-S-2.' || l_suppkey || ' and XTC-S-1.' || l_suppkey || ' or TC-S-1.' || l_suppkey || 'a, again ' || coalesce(a.new, 'TC-S-1.' || l_suppkey) || '.' as body
    from lineitem left join n a on a.k = l_suppkey left join n b on b.k = l_suppkey + 1""",
)
def ids_rewritten(spark, sf_dir):
    """Ids that change places in the titles and bodies of all line items; some stay, some only look like one."""
    s, k = table(spark, sf_dir, "supplier").filter("s_suppkey % 5 <> 4"), F.col("s_suppkey")
    ids = s.select(F.concat(F.lit("TC-S-1."), k).alias("old"), F.concat(F.lit("TC-S-1."), F.when(k % 2 == 0, k + 1).otherwise(k - 1)).alias("new"))
    own, nxt = F.concat(F.lit("TC-S-1."), "l_suppkey"), F.concat(F.lit("TC-S-1."), F.col("l_suppkey") + 1)
    title = F.concat(F.lit("run ["), own, F.lit("] first"))
    body = F.concat(own, F.lit(", "), nxt, F.lit(" then TC-S-2."), "l_suppkey", F.lit(" and XTC-S-1."), "l_suppkey", F.lit(" or "), own, F.lit("a, again "), own, F.lit("."))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", title.alias("title"), body.alias("body"))
    return I.rewritten(items, ["title", "body"], ids)


@query(
    "cases_renumbered",
    """with e as (select 1 + s_suppkey % 25 as b, s_nationkey as z, max(s_suppkey) as top from supplier group by 1, 2),
    i as (select *, replace(p_brand, 'Brand#', '')::int as b from part),
    n as (select *, row_number() over (partition by b, p_size order by lower('[] ' || p_name), p_partkey) as n from i where p_partkey % 10 <> 0)
    select p_partkey, 'TC-B' || n.b || '-' || p_size || '.' || (coalesce(top, 0) + n) as tc_id, '[TC-B' || n.b || '-' || p_size || '.' || (coalesce(top, 0) + n) || '] ' || p_name as title,
      'TC-B' || n.b || '-' || p_size || '.' || (coalesce(top, 0) + n) || ' after TC-B' || n.b || '-' || p_size || '.' || p_partkey || '0' as body
    from n left join e on e.b = n.b and z = p_size
    union all select p_partkey, null, p_name, 'TC-B1-1.1' from i where p_partkey % 10 = 0""",
)
def cases_renumbered(spark, sf_dir):
    """Parts as proposed cases, numbered on from the suppliers' ids; every tenth has no id."""
    p, own = table(spark, sf_dir, "part"), F.concat(F.lit("TC-B"), F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.lit("-"), "p_size", F.lit("."), "p_partkey")
    none = F.col("p_partkey") % 10 == 0
    items = p.select("p_partkey", F.when(none, F.col("p_name")).otherwise(F.concat(F.lit("["), own, F.lit("] "), "p_name")).alias("title"), F.when(none, "TC-B1-1.1").otherwise(F.concat(own, F.lit(" after "), own, F.lit("0"))).alias("body"))
    existing = table(spark, sf_dir, "supplier").select(F.concat(F.lit("TC-B"), 1 + F.col("s_suppkey") % 25, F.lit("-"), "s_nationkey", F.lit("."), "s_suppkey").alias("tc_id"))
    return I.renumbered_cases(items, existing, "p_partkey", "title", "body")


_GROUPS = """s as (select distinct o_custkey as f, l_orderkey as key, l_partkey % 25 as entity, l_returnflag || l_linenumber as step from lineitem join orders on o_orderkey = l_orderkey),
    links as (select distinct a.key as x, b.key as y from s a join s b using (f, entity, step)),
    r as (select o_orderkey as key, o_orderkey as c from orders union select r.key, y from r join links on x = c),
    g as (select key, min(c) as comp from r group by key),
    z as (select g.key, comp, length(o_orderpriority) as prefer, (select count(*) from s where s.key = g.key) as n_scopes from g join orders on o_orderkey = g.key),
    m as (select key, first_value(key) over (partition by comp order by prefer, n_scopes desc, key) as survivor, n_scopes from z)"""


def _proposals(spark, sf_dir):
    """(proposals, scopes): an order proposes for its customer what its line items do."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    proposals = o.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("family"), F.length("o_orderpriority").alias("prefer"))
    return proposals, li.select(F.col("l_orderkey").alias("key"), (1000 * F.col("l_linenumber") + F.col("l_partkey") % 25).alias("at"), (F.col("l_partkey") % 25).alias("entity"), F.concat("l_returnflag", "l_linenumber").alias("step"))


@query("proposals_merged", f"with recursive {_GROUPS} select key, survivor, n_scopes::bigint as n_scopes from m")
def proposals_merged(spark, sf_dir):
    """Which order of its customer each order is merged into."""
    return M.overlap_groups(*_proposals(spark, sf_dir))


@query(
    "merged_scopes",
    f"""with recursive {_GROUPS},
    p as (select survivor, l_partkey % 25 as entity, l_returnflag || l_linenumber as step, min((l_orderkey <> survivor, l_orderkey, 1000 * l_linenumber + l_partkey % 25)) as w from lineitem join m on key = l_orderkey group by 1, 2, 3)
    select survivor, row_number() over (partition by survivor order by w, entity, step) - 1 as at, entity, step, w[2] as key from p""",
)
def merged_scopes(spark, sf_dir):
    """What the orders that are left do."""
    proposals, scopes = _proposals(spark, sf_dir)
    return M.merged_scopes(M.overlap_groups(proposals, scopes), scopes)
