"""Queries of the domain's operators over sentences, test cases and graphs that the star schema stands for."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..operators import audits as A
from ..operators import batching as B
from ..operators import build as U
from ..operators import codes as C
from ..operators import graph as G
from ..operators import rerank as K
from ..operators import rules as R
from .catalog import query
from .text_queries import table


def _case(column: str, templates: list[str]) -> str:
    """One of the templates for each row, in SQL that both engines run; {n} is the part's name, {s} its size."""
    arms = " ".join(f"when {i} then " + " || ".join(f"'{p}'" if j % 2 == 0 else {"n": "p_name", "s": "cast(p_size as varchar(9))"}[p] for j, p in enumerate(_cut(t))) for i, t in enumerate(templates))
    return f"case cast({column} % {len(templates)} as int) {arms} end"


def _cut(template: str) -> list[str]:
    out, rest = [], template
    while "{" in rest:
        a, _, rest = rest.partition("{")
        k, _, rest = rest.partition("}")
        out += [a, k]
    return [*out, rest]


def _sentences(spark, sf_dir, templates):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.expr(_case("p_partkey", templates)).alias("text"))


def _from(templates):
    return f"(select p_partkey, {_case('p_partkey', templates)} as text from part)"


#: Sentences with each signal, alone and together.
STATED = [
    "The {n} server shall respond within {s} seconds.",
    "BLE advertisement of {n} shall stop after {s} ms.",
    "If {n} is set, then the node shall complete within {s} seconds.",
    "The {n} device shall enter the On state.",
    "After a factory reset {n} shall go to its default state.",
    "The {n} attribute indicates the current level.",
    "The value of {n} shall be in the range 0 to {s}.",
    "The {n} attribute stores the level in the range 0 to {s}.",
    "When {n} is true the server shall send it.",
    "The {n} feature depends on the other cluster.",
    "Nothing is said of {n}.",
    "On startup {n} is joining fabric {s}.",
    "The subscription of {n} is made upon receipt of a request.",
]


def _hit(pattern: str, column: str = "text") -> str:
    return f"regexp_matches({column}, '{pattern}')"


def _scores() -> dict[str, str]:
    out = {}
    for kind, (signal, weight) in V.TYPES.items():
        e = f"case when {_hit(V.SIGNALS[signal])} then {weight}::double else 0 end"
        for needs, own, amount in V.BOOSTS:
            if own == kind:
                e += " + case when " + " and ".join(_hit(V.SIGNALS[n]) for n in needs) + f" then {amount}::double else 0 end"
        out[kind] = e
    return out | {V.BASELINE[0]: f"{V.BASELINE[1]}::double"}


_LONG = " union all ".join(f"select p_partkey, '{k}' as kind, {i} as prio, {e} as score from x" for i, (k, e) in enumerate(_scores().items()))


@query(
    "requirement_types",
    f"""with x as {_from(STATED)}, l as ({_LONG}), r as (select *, row_number() over (partition by p_partkey order by score desc, prio) as n, sum(score) over (partition by p_partkey) as total from l),
    t as (select p_partkey, max(case when n = 1 then kind end) as requirement_type, max(case when n = 1 then score end) as a, max(case when n = 2 then score end) as b, max(total) as total,
      string_agg(case when n > 1 and score > 1 and kind <> 'general_normative' then kind end, '|' order by n) as alternatives from r group by p_partkey)
    select p_partkey, requirement_type, round(greatest(0.3, least(1.0, a / greatest(total, 1))), 6) as confidence, b > 0 and a / (a + b) < 0.7 as ambiguous, coalesce(alternatives, '') as alternatives,
      concat_ws('|', {", ".join(f"case when {_hit(p)} then '{k}' end" for k, p in V.SIGNALS.items())}) as signals from t join x using (p_partkey)""",
)
def requirement_types(spark, sf_dir):
    out = R.typed(_sentences(spark, sf_dir, STATED), "text")
    return out.select("p_partkey", "requirement_type", F.round("confidence", 6).alias("confidence"), "ambiguous", F.array_join("alternatives", "|").alias("alternatives"), F.array_join("signals", "|").alias("signals"))


#: Sentences for each reason to reject, and for each rescue.
JUDGED = [
    "It is {s}.",
    "It shall be {s}.",
    "SHALL be kept {s}.",
    "SHALL | A key word that indicates a rule of {n}",
    "one | two | three and {n} that says something",
    "a | {s} | The commissioner is required to show {n} to all",
    "desc, that is the conformance of {n} in the table",
    "{s} | Device Manufacturer shall have {n} in its table",
    "element in the list, the new value of {n} shall be",
    "Shall be set to the value that {n} had before it",
    "The server shall send the report of {n} to the",
    "This field SHALL indicate the state that {n} has had",
    "The server shall send the whole report of {n}.",
]
_T = "trim(text)"
_WORDS = f"(not contains({_T}, '|') and len(regexp_split_to_array({_T}, '\\s+')) >= 4)"
_TAIL = f"trim(regexp_extract({_T}, '[^|]*$'))"
_TITLE = "'Part ' || cast(p_partkey % 3 as varchar(9))"
_LADDER = [
    (f"length({_T}) < 30 and {_hit(V.MODAL, _T)} and not {_hit(V.STARTS_MODAL, _T)} and {_WORDS}", "valid", "text"),
    (f"length({_T}) < 30 and {_hit(V.STARTS_MODAL, _T)} and {_WORDS} and title <> ''", "valid", f"title || ': ' || {_T}"),
    (f"length({_T}) < 30", "too_short", _T),
    (_hit(V.GLOSSARY_ROW, _T), "glossary_row", _T),
    (f"{_hit(V.TABLE_ROW, _T)} and length({_TAIL}) >= 30 and {_hit(V.NORMATIVE_WORD, _TAIL)}", "valid", _TAIL),
    (_hit(V.TABLE_ROW, _T), "table_fragment", _T),
    (_hit(V.CONFORMANCE_CELL, _T), "conformance_table_cell", _T),
    (_hit(V.NUMERIC_ROW, _T), "numeric_table_row", _T),
    (_hit(V.STARTS_LOWER, _T), "lowercase_fragment", _T),
    (f"{_hit(V.STARTS_MODAL, _T)} and title <> ''", "valid", f"title || ': ' || {_T}"),
    (_hit(V.STARTS_MODAL, _T), "modal_fragment_no_subject", _T),
    (_hit(V.OPEN_END, _T), "incomplete_tail_fragment", _T),
    (_hit(V.FIELD_DEFINITION, _T), "entity_definition", _T),
]
_TITLED = f"(select p_partkey, text, case when p_partkey % 3 = 0 then '' else '4.' || (p_partkey % 3) || '. ' || {_TITLE} end as raw, case when p_partkey % 3 = 0 then '' else {_TITLE} end as title from {_from(JUDGED)})"


@query(
    "requirement_filter",
    f"select p_partkey, case {' '.join(f'when {c} then {v!r}' for c, v, _ in _LADDER)} else 'valid' end as verdict, case {' '.join(f'when {c} then {u}' for c, _, u in _LADDER)} else text end as requirement from {_TITLED}",
)
def requirement_filter(spark, sf_dir):
    title = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("4."), (F.col("p_partkey") % 3).cast("string"), F.lit(". Part "), (F.col("p_partkey") % 3).cast("string")))
    out = R.filtered(_sentences(spark, sf_dir, JUDGED).withColumn("title", title), "text", "title")
    return out.select("p_partkey", "verdict", "requirement")


#: Texts with each test intent, behaviour and protocol word.
TESTED = [
    "TH reads the attribute of {n}.",
    "DUT writes the attribute, then verify that attribute {n}.",
    "TH sends a command to {n} and checks the response.",
    "Verify the response: response contains {n} with status code FAILURE.",
    "Verify the event of {n} within {s} seconds.",
    "Check the new state: state transition of {n}.",
    "Another cluster and multiple attributes of {n}.",
    "Commissioning of {n} with attestation over mDNS discovery.",
    "QR code with discriminator and passcode for {n}.",
    "Conformance: {n} shall not support unsupported values, rejected.",
    "Factory reset, then power cycle {n}; the lamp blinks over IPv4.",
    "{n} enters commissioning mode, joins fabric, BLE advertising.",
    "The operational credentials of {n} after a subscription, max interval {s}.",
]


def _named(patterns: dict[str, str]) -> str:
    return "concat_ws('|', " + ", ".join(f"case when {_hit(p)} then '{k}' end" for k, p in patterns.items()) + ")"


@query("domain_intents", f"select p_partkey, {_named(V.INTENTS)} as intents, {_named(V.BEHAVIOURS)} as behaviours, {_named(V.ANCHORS)} as anchors from {_from(TESTED)}")
def domain_intents(spark, sf_dir):
    t, text = _sentences(spark, sf_dir, TESTED), F.col("text")
    named = F.transform(R.behaviours(text), lambda b: F.split_part(b, F.lit("::"), F.lit(2)))
    return t.select("p_partkey", F.array_join(R.test_intents(text), "|").alias("intents"), F.array_join(named, "|").alias("behaviours"), F.array_join(R.anchors(text), "|").alias("anchors"))


def _each(pattern: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(text, '{pattern}', 1), lambda x: trim(x)), '|')"


@query("requirement_clauses", f"select p_partkey, {_each(V.CONDITION_CLAUSE)} as conditions, {_each(V.EFFECT_CLAUSE)} as effects, {_each(V.CONSTRAINT_CLAUSE)} as constraints from {_from(STATED)}")
def requirement_clauses(spark, sf_dir):
    t = _sentences(spark, sf_dir, STATED)
    return t.select("p_partkey", *[F.array_join(c, "|").alias(k) for k, c in R.clause_texts(F.col("text")).items()])


_W = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '' and not list_contains(" + repr(list(V.STOP_WORDS)) + ", x)))"


@query(
    "lexical_pairs",
    f"""with t as (select conv_id, turn, role, {_W.format(c="coalesce(text, '')")} as w from conversations), p as (select a.conv_id, a.turn, b.turn as next, a.w as x, b.w as y from t a join t b on a.conv_id = b.conv_id and b.turn = a.turn + 1)
    select conv_id, turn, next, round(case when len(x) > 0 and len(y) > 0 then 2.0::double * len(list_intersect(x, y)) / (len(x) + len(y)) else 0 end, 6) as dice from p""",
)
def lexical_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    n = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("next"), F.col("text").alias("other"))
    return c.join(n, ["conv_id", "turn"]).select("conv_id", "turn", "next", F.round(K.lexical(F.col("text"), F.col("other")), 6).alias("dice"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SEG = "[" + ", ".join(repr(x) for x in _SEGMENTS) + "][(s_suppkey % 5)::int + 1]"


def _cover_graph(spark, sf_dir):
    """Customers as requirements of their segment, suppliers as test cases, nations as the attributes that they share."""
    c, s, n = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))
    seg = F.element_at(F.array(*[F.lit(x) for x in _SEGMENTS]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    nodes = c.select(F.concat(F.lit("REQ::"), "c_custkey").alias("node_id"), F.lit("requirement").alias("node_type"), F.col("c_mktsegment").alias("cluster"))
    nodes = nodes.unionAll(s.select(F.concat(F.lit("TC-"), "s_suppkey"), F.lit("test_case"), F.concat(F.lower(seg), F.lit(" cluster")))).unionAll(n.select(F.concat(F.lit("ATTRIBUTE::"), "n_nationkey"), F.lit("attribute"), F.lit("")))
    edges = c.select(F.concat(F.lit("REQ::"), "c_custkey").alias("src"), F.concat(F.lit("ATTRIBUTE::"), "c_nationkey").alias("dst"), F.lit("implements").alias("edge_type"))
    kind = F.when(F.col("s_suppkey") % 2 == 0, "verifies_attribute").otherwise("reads")
    edges = edges.unionAll(s.select(F.concat(F.lit("TC-"), "s_suppkey"), F.concat(F.lit("ATTRIBUTE::"), "s_nationkey"), kind)).unionAll(s.select(F.concat(F.lit("TC-"), "s_suppkey"), F.concat(F.lit("REQ::"), "s_suppkey"), F.lit("covers")))
    return nodes, edges


@query(
    "requirement_coverage",
    f"""with p as (select distinct c_custkey, s_suppkey from customer join supplier on (s_suppkey = c_custkey) or (s_nationkey = c_nationkey and {_SEG} = c_mktsegment)),
    f as (select c_custkey, list_sort(list('TC-' || s_suppkey)) as l from p group by 1)
    select 'REQ::' || c_custkey as req_id, c_mktsegment as cluster, l is not null as covered, coalesce(array_to_string(l[1:3], '|'), '') as covering from customer left join f using (c_custkey)""",
)
def requirement_coverage(spark, sf_dir):
    out = G.coverage(*_cover_graph(spark, sf_dir))
    return out.select("req_id", "cluster", "covered", F.array_join("covering", "|").alias("covering"))


_EDGE = "case l_returnflag when 'R' then 'reads' when 'A' then 'verifies_rule' else 'tests' end"
_KINDS = ["datatype_changed", "conformance_changed", "access_changed"]


@query(
    "change_impact",
    f"""with e as (select distinct 'TC-' || l_orderkey as src, l_partkey, {_EDGE} as t from lineitem), c as (select p_partkey, {_KINDS}[(p_partkey % 3)::int + 1] as kind from part),
    p as (select p_partkey, src, bool_or((kind = 'datatype_changed' and t = 'reads') or (kind = 'conformance_changed' and t = 'verifies_rule')) as d, bool_or(t = 'tests') as b from c join e on l_partkey = p_partkey group by 1, 2),
    s as (select p_partkey, count(*) filter (where d) as direct, count(*) filter (where b and not d) as possible from p group by 1)
    select c.p_partkey as change_id, case when s.p_partkey is null then 'gap' when direct > 0 then 'direct' when possible > 0 then 'possible' else 'none' end as verdict, coalesce(direct, 0)::int as direct, coalesce(possible, 0)::int as possible from c left join s using (p_partkey)""",
)
def change_impact(spark, sf_dir):
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    kind = F.when(F.col("l_returnflag") == "R", "reads").when(F.col("l_returnflag") == "A", "verifies_rule").otherwise("tests")
    edges = li.select(F.concat(F.lit("TC-"), "l_orderkey").alias("src"), F.concat(F.lit("P::"), "l_partkey").alias("dst"), kind.alias("edge_type"))
    nodes = edges.select(F.col("src").alias("node_id")).distinct().withColumn("node_type", F.lit("test_case")).unionAll(p.select(F.concat(F.lit("P::"), "p_partkey"), F.lit("attribute")))
    changes = p.select(F.col("p_partkey").alias("change_id"), F.concat(F.lit("P::"), "p_partkey").alias("target"), F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("p_partkey") % 3 + 1).cast("int")).alias("kind"))
    return G.typed_impact(changes, nodes, edges).select("change_id", "verdict", F.size("direct").alias("direct"), F.size("possible").alias("possible"))


@query(
    "graph_problems",
    """with r as (select 'REQ::' || c_custkey as id, c_custkey as k, c_nationkey as n from customer), t as (select 'TC-' || s_suppkey as id, s_suppkey as k from supplier)
    select 'requirement_without_area' as problem, id as node_id from r union all
    select 'orphan_test_case', id from t where k % 2 = 1 and k not in (select k from r) and false union all
    select 'test_case_without_requirement', id from t where false union all
    select 'dangling_dst', 'REQ::' || k from t where k not in (select k from r)""",
)
def graph_problems(spark, sf_dir):
    return U.problems(*_cover_graph(spark, sf_dir)).select("problem", "node_id")


_NUM = "(p_partkey // 50) || '.' || (p_partkey % 50 + 1)"


@query(
    "section_references",
    f"""with s as (select 'S' || p_partkey as id, {_NUM} as number, 'See section ' || (p_partkey // 50) || '.' || (p_size % 50 + 1) || ', clause ' || (p_partkey // 50) || '.' || (p_partkey % 50 + 1) || ' or refer to 99999.1.' as t from part),
    r as (select id, unnest(regexp_extract_all(t, '{V.SECTION_REFERENCE}', 1)) as number from s)
    select distinct r.id as src, s.id as dst from r join s using (number) where r.id <> s.id""",
)
def section_references(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = lambda x: F.expr(x).cast("string")
    number = F.concat(c("p_partkey div 50"), F.lit("."), c("p_partkey % 50 + 1"))
    text = F.concat(F.lit("See section "), c("p_partkey div 50"), F.lit("."), c("p_size % 50 + 1"), F.lit(", clause "), number, F.lit(" or refer to 99999.1."))
    s = p.select(F.concat(F.lit("S"), "p_partkey").alias("section_id"), F.concat(F.lit("0 All > "), number, F.lit(" Part")).alias("section_path"), text.alias("full_text"))
    return U.references(s.filter("section_path is not null")).select("src", "dst")


_CODE = "'P' || chr(65 + (l_suppkey % 7)::int) || '.' || case when l_linenumber % 3 = 0 then 'C' else 'S' end || '.' || case l_linenumber % 4 when 0 then 'A' when 1 then 'C' when 2 then 'F' else 'Q' end || printf('%04X', (l_partkey % 300)::int)"


@query(
    "code_checks",
    f"""with s as (select distinct 'P' || chr(65 + (p_partkey % 5)::int) as prefix, case p_partkey % 4 when 0 then 'A' when 1 then 'C' else 'F' end as kind, p_partkey % 200 as id, case when p_partkey % 8 = 1 then 'C' else 'S' end as side from part),
    i as (select prefix, kind, id, list(side) as sides from s group by all),
    c as (select l_orderkey, l_linenumber, {_CODE} as code, 'P' || chr(65 + (l_suppkey % 7)::int) as prefix, case when l_linenumber % 3 = 0 then 'C' else 'S' end as side, case l_linenumber % 4 when 0 then 'A' when 1 then 'C' when 2 then 'F' else 'Q' end as kind, l_partkey % 300 as id from lineitem)
    select l_orderkey, l_linenumber, code, case when c.kind = 'Q' then 'invalid_format' when c.prefix not in (select prefix from s) then 'unknown_cluster'
      when c.kind in ('A', 'C') and not (list_contains(coalesce(sides, []), c.side) or list_contains(coalesce(sides, []), 'S')) then 'unknown_id' when c.kind = 'F' and sides is null then 'unknown_id' else '' end as error_type
    from c left join i on i.prefix = c.prefix and i.kind = c.kind and i.id = c.id""",
)
def code_checks(spark, sf_dir):
    pre = lambda c: F.concat(F.lit("P"), F.char(65 + F.col(c) % (5 if c == "p_partkey" else 7)))
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    k = F.col("p_partkey") % 4
    schema = p.select(pre("p_partkey").alias("prefix"), F.when(F.col("p_partkey") % 8 == 1, "C").otherwise("S").alias("side"), F.when(k == 0, "A").when(k == 1, "C").otherwise("F").alias("kind"), (F.col("p_partkey") % 200).alias("entity_id")).distinct()
    n = F.col("l_linenumber") % 4
    code = F.concat_ws(".", pre("l_suppkey"), F.when(F.col("l_linenumber") % 3 == 0, "C").otherwise("S"), F.concat(F.when(n == 0, "A").when(n == 1, "C").when(n == 2, "F").otherwise("Q"), F.lpad(F.hex(F.col("l_partkey") % 300), 4, "0")))
    out = C.validated(li.select("l_orderkey", "l_linenumber", code.alias("code")), schema)
    return out.select("l_orderkey", "l_linenumber", "code", "error_type")


@query("global_numbers", "select p_partkey, p_brand, (row_number() over (partition by p_brand order by p_name, p_partkey) - 1)::int as number from part")
def global_numbers(spark, sf_dir):
    return B.global_numbers(table(spark, sf_dir, "part"), "p_brand", ["p_name", "p_partkey"]).select("p_partkey", "p_brand", "number")


@query("modal_prefix", "select o_custkey, o_orderpriority from (select o_custkey, o_orderpriority, row_number() over (partition by o_custkey order by count(*) desc, min(o_orderkey)) as n from orders group by 1, 2) where n = 1")
def modal_prefix(spark, sf_dir):
    return B.modal(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "cluster_assignments",
    """with t as (select 'TC-' || (case when s_suppkey % 11 = 0 then 'SC' else 'N' || s_nationkey end) || '-' || s_suppkey || '.1' as tc_id, s_suppkey % 11 = 0 as protocol, s_nationkey as n,
      case when s_suppkey % 5 = 0 then '' when s_suppkey % 7 = 0 then 'Other' else 'Nation ' || s_nationkey || ' Cluster' end as cluster from supplier)
    select tc_id, cluster, case when not protocol and n < 20 then 'nation ' || n end as want, case when protocol then 'protocol_has_cluster' when cluster = '' then 'missing_cluster' else 'wrong_cluster' end as finding
    from t where (protocol and cluster <> '') or (not protocol and n < 20 and cluster in ('', 'Other'))""",
)
def cluster_assignments(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), F.col("s_nationkey").cast("string")
    tc = F.concat(F.lit("TC-"), F.when(F.col("s_suppkey") % 11 == 0, "SC").otherwise(F.concat(F.lit("N"), n)), F.lit("-"), F.col("s_suppkey").cast("string"), F.lit(".1"))
    cluster = F.when(F.col("s_suppkey") % 5 == 0, "").when(F.col("s_suppkey") % 7 == 0, "Other").otherwise(F.concat(F.lit("Nation "), n, F.lit(" Cluster")))
    prefixes = table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(F.concat(F.lit("N"), "n_nationkey").alias("prefix"), F.concat(F.lit("nation "), "n_nationkey").alias("cluster"))
    return A.assignments(s.select(tc.alias("tc_id"), cluster.alias("cluster")), prefixes)


@query("finding_tallies", "select l_returnflag as g, l_linestatus as status, count(*) as n from lineitem group by cube (l_returnflag, l_linestatus)")
def finding_tallies(spark, sf_dir):
    return A.tallies(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_linestatus").alias("status")), "g", "status")


@query(
    "sections_within_budget",
    """with w as (select source, doc_id, coalesce(text, '') as text, 30000 - coalesce(sum(length(coalesce(text, ''))) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as room from documents)
    select source, doc_id, least(length(text), room)::int as n from w where length(text) <= room or room > 200""",
)
def sections_within_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return B.within_budget(d, "source", ["doc_id"], "text", 30000).select("source", "doc_id", F.length("text").alias("n"))
