"""Sections, test cases, changed clusters and ids on fixtures written by hand."""

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import ids as I
from quillgraph.plans import spec_queries
from quillgraph.sources import plan_html as P
from quillgraph.sources import revised as R

PLAN = """<html><head><style>p{margin:0}</style><body>
<div id="toc"><h2>[TC-TOC-1.1] not here</h2></div>
<div class="sect1"><h2 id="a">1. Door Plan</h2><div class="sectionbody">
 <div class="sect2"><h3>1.1. Definitions</h3><p>no content</p></div>
 <div class="sect2"><h3 id="c1"><a class="anchor" href="#c1">x</a>[TC-DR-2.1] Opening &amp; closing</h3>
  <div class="sect3"><h4>Purpose</h4><div class="paragraph"><p>Opens   a&nbsp;door.</p></div></div>
  <div class="sect3"><h4>PICS</h4><div class="paragraph"><p>DR.S DR.S.A0000
   DR.S.C00</p></div></div>
  <div class="sect3"><h4>PIXIT</h4><ul><li>PIXIT.ONE</li><li></li></ul></div>
  <div class="sect3"><h4>Precondition</h4><p>.
first
 second</p></div>
  <div class="sect3"><h4>Required Devices</h4><table><tr><td>1</td><td>DUT</td><td>under test</td></tr><tr><td>2</td><td>TH</td></tr><tr><td>3</td></tr></table></div>
  <div class="sect3"><h4>Device Topology</h4><p>star</p></div>
  <div class="sect3"><h4>Setup</h4><p>join</p><p>wait</p></div>
  <div class="sect3"><h4>Test Procedure</h4><table><thead><tr><th>#</th><th>Ref</th></tr></thead><tbody>
    <tr><td>1</td><td>2.1</td><td>DR.S</td><td>TH opens</td><td>It <em>opens</em></td></tr>
    <tr><td>2</td><td>2.2</td><td></td><td>TH waits</td></tr>
    <tr><td>3</td><td>alone</td><td>here</td></tr><tr><td>left out</td></tr><tr><td></td><td></td></tr></tbody></table></div>
  <div class="sect3"><h4>Testing Considerations</h4><ol><li>one</li><li>two</li></ol></div>
  <div class="sect3"><h4>History</h4><p>no role</p></div>
 </div>
 <div class="sect2"><h3>tc-like [tc-dr-2.2 lower</h3><div class="sect3"><h4>Procedure</h4><ol><li>do</li><li>look</li></ol></div>
  <div class="sect3"><h4>[TC-DR-2.3] inner</h4><div class="sect4"><h5>Purpose</h5><p>inner one</p></div></div></div>
</div></div><div id="footer"><p>end</p></div></body></html>"""


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def test_test_cases_have_their_subsections_in_fields(spark):
    a, b, c = P.test_cases(pages(spark, PLAN), "page_id", "html").orderBy("position").collect()
    assert (a.test_case_id, a.title, a.path) == ("TC-DR-2.1", "[TC-DR-2.1] Opening & closing", ["1. Door Plan"])
    assert (a.purpose, a.device_topology, a.test_setup) == ("Opens a door.", "star", "join wait")
    assert (a.pics, a.pixit, a.preconditions, a.notes) == (["DR.S", "DR.S.A0000", "DR.S.C00"], ["PIXIT.ONE"], ["first", "second"], ["one", "two"])
    assert [tuple(d) for d in a.required_devices] == [("DUT", "under test"), ("TH", "")]
    assert [tuple(s) for s in a.test_procedure] == [("1", "2.1", "DR.S", "TH opens", "It opens"), ("2", "2.2", "", "TH waits", ""), ("3", "", "", "alone | here", "")]
    assert a.all_text.split("\n\n")[:3] == ["[TC-DR-2.1] Opening & closing", "Opens a door.", "DR.S"] and a.all_text.endswith("1 2.1 DR.S TH opens It opens\n\n2 2.2 TH waits\n\n3 alone | here\n\none\n\ntwo")
    assert (b.test_case_id, [s.action for s in b.test_procedure], b.purpose) == ("TC-DR-2.2", ["do", "look"], "")
    assert (c.test_case_id, c.purpose, c.path) == ("TC-DR-2.3", "inner one", ["1. Door Plan", "tc-like [tc-dr-2.2 lower"])


def test_steps_are_rows_and_pages_are_told_by_content(spark):
    p = pages(spark, PLAN, "<h2>About TC-DR-2.1</h2><p>text</p>", None, "")
    assert [r.m for r in p.select(P.mode(F.col("html")).alias("m")).collect()] == ["test_plan", "spec", "spec", "spec"]
    steps = P.procedure_steps(P.test_cases(p, "page_id", "html", auto=True)).collect()
    assert sorted((r.id, r.test_case_id, r["at"], r.step) for r in steps) == [(0, "TC-DR-2.1", 0, "1"), (0, "TC-DR-2.1", 1, "2"), (0, "TC-DR-2.1", 2, "3"), (0, "TC-DR-2.2", 0, ""), (0, "TC-DR-2.2", 1, "")]
    assert [(r.id, r.title) for r in P.spec_sections(p, "page_id", "html", auto=True).collect()] == [(1, "About TC-DR-2.1")]


def test_containers_keep_their_own_blocks_only(spark):
    html = """<div class="sect1 wide"><h2 id="x">1. Top</h2><p>above<p>next
      <div class="admonitionblock note"><table><tr><td>Note</td><td>mind</td></tr></table></div><dl><dt>term<dd>said</dl>
      <div class="sect2"><div class="inner"><h3>1.1. Sub</h3></div><blockquote><p>quoted</p></blockquote>
        <table><thead><tr><th>k<th>v</thead><tbody><tr><td>a<td>1<tr><td>b<td>2</tbody></table><ul><li>one<ul><li>deep</ul><li>two</ul></div>
      <p>after the sub-section</p><p>color:red; margin:0px; padding:1px;</p></div>
      <div class="sect1"><h2>2. Revision History</h2><p>gone</p></div><div class="sect1"><h2></h2><p>no title</p></div><div class="sect1"><h2>3. Empty</h2></div>"""
    a, b = P.spec_sections(pages(spark, html), "page_id", "html").orderBy("position").collect()
    assert (a.section_id, a.level, a.path) == ("x", 2, ["1. Top"])
    assert [(k.kind, k.text) for k in a.blocks] == [("paragraph", "above"), ("paragraph", "next"), ("note", "Note mind"), ("list_item", "term: said"), ("paragraph", "after the sub-section")]
    assert b.path == ["1. Top", "1.1. Sub"]
    assert [(k.kind, k.text) for k in b.blocks] == [("note", "quoted"), ("table", "k | v\n--------\na | 1\nb | 2"), ("list_item", "one deep"), ("list_item", "two")]
    assert b.blocks[1].headers == ["k", "v"] and b.blocks[1].cells == [["a", "1"], ["b", "2"]]
    assert b.full_text == "\n\n".join(k.text for k in b.blocks)


def test_headings_without_containers_take_what_follows(spark):
    html = "<div id='content'><h2>A</h2><p>a</p><h3>B</h3><p>b</p><h2>C</h2><p>c</p></div><h2>outside</h2><p>d</p>"
    got = P.spec_sections(pages(spark, html), "page_id", "html").orderBy("position").collect()
    assert [(r.path, r.full_text) for r in got] == [(["A"], "a\n\nb"), (["A", "B"], "b"), (["C"], "c")]


@pytest.mark.parametrize("html", ["</div></p>", "<div class=sect1><h2>[TC-A-1.1", "<table><tr><td>" * 300, "<" * 50, "<p>&#xFFFFFFFF;</p>", "<div class='sect2'><h3>[TC-A-1.1]</h3><div class='sect3'><h4>Test Procedure</h4><table><tr><td>1<td>a<td>b<td>c<p></table>", "<script>never closed", "<div>" * 3000 + "deep"])
def test_malformed_pages_fail_no_task(spark, html):
    p = pages(spark, html, html)
    assert P.spec_sections(p, "page_id", "html").count() % 2 == 0
    assert P.test_cases(p, "page_id", "html").count() % 2 == 0


def test_plain_pages_are_read_by_one_pattern_as_the_parser_reads_them(monkeypatch):
    def shown(n):
        return n.tag, n.attrs, n.noise, [x if isinstance(x, str) else shown(x) for x in n.inside]

    def parsed(html):
        p = P._Tree()
        p.feed(html)
        p.close()
        return p

    bits = "<p>|</p>|<TR>|<td class='a b'>|</td >|<br/>|<br />|<p/>|<img src=x/>|<a class=\"anchor\" href='#x'>|</a>|<style>|</style>|<script >|</SCRIPT>|<title>|</title>|<plaintext>|<div id=toc>|<div class='sect2' hidden>|</div>|<h2 id=''>|<p a=1 A=2>|<p a='&lt;'>|</p b>|<!-- c -->|<3|<|&amp;|&|\n|é|text".split("|")
    r, plain = random.Random(1), 0
    for _ in range(5000):
        html = "".join(r.choices(bits, k=r.randrange(1, 9)))
        got = P._plain(html)
        if got:
            plain += 1
            want = parsed(html)
            assert (shown(got.root), [shown(b) for b in got.boxes]) == (shown(want.root), [shown(b) for b in want.boxes]), html
    assert plain > 500
    want = P.case_rows(PLAN)
    monkeypatch.setattr(P._Tree, "feed", lambda self, html: pytest.fail("read by the parser"))
    assert P.case_rows(PLAN) == want and len(want) == 3


def test_documents_of_one_file_are_dealt_before_their_pages_are_parsed(spark):
    pages = spec_queries._pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in pages


def test_no_pages_give_no_rows(spark):
    p = pages(spark, "x").filter("false")
    assert P.spec_sections(p, "page_id", "html").count() == P.test_cases(p, "page_id", "html").count() == 0
    assert R.revised_clusters(p, "page_id", "html").count() == 0


def section(name, body, tag="h2"):
    return f'<{tag} id="ref_{name}Cluster" class="x">1.{len(name)}. {name} Cluster</{tag}>{body}'


def ins(text):
    return f'<ins class="diff-new">{text}</ins>'


@pytest.mark.parametrize(
    ("body", "n"),
    [
        ("plain", None),
        (ins("[11.712]"), None),
        ('<a href="#t">' + ins("10.1.") + "</a>", None),
        (ins("10.1."), 1),
        (ins("2024-05-06 10:11:12 +0200") + "<del class='d'>0a1b2c3d</del>", None),
        ("<ins>without attributes</ins>", None),
        (ins("real") + ins("more"), 2),
        (ins("Window Cluster") * 9, None),
        (ins("Window Cluster") * 10, 10),
        (ins("Window and") + ins("<b>door</b>"), 2),
        (ins("Fan spins"), 1),
        (ins("first\nline of windows"), None),
    ],
)
def test_changes_that_are_a_clusters_own(spark, body, n):
    html = section("Door", body) + section("Window", "") + section("Fan", "") + '<div id="footer">' + ins("abc") + "</div>"
    got = R.revised_clusters(pages(spark, html), "page_id", "html").collect()
    assert [(r.cluster, r.n_diffs) for r in got] == ([("Door Cluster", n)] if n else [])


def test_wrapped_headings_other_references_and_repeats(spark):
    html = ins(section("Door", "", "h3")) + '<h3 id="ref_DoorData">Data</h3>' + ins("in door") + section("Door", ins("again") * 3) + "<h2>Window Cluster without id</h2>" + section("Window", "")
    got = R.revised_clusters(pages(spark, html, html, None, "", '<h2 id="ref_x">never closed ' + "y" * 20000), "page_id", "html").collect()
    assert sorted((r.id, r.cluster, r.n_diffs) for r in got) == [(0, "Door Cluster", 1), (1, "Door Cluster", 1)]


def test_ids_change_places_at_once(spark, monkeypatch):
    rows = [(1, "TC-A-1.1 and TC-A-1.10", "TC-A-1.2, TC-A-1.1"), (1, "TC-A-1.1 and TC-A-1.10", "TC-A-1.2, TC-A-1.1"), (2, None, "XTC-A-1.1 TC-A-1.1x TC-B-1.1 TC-A-9.9"), (3, "", None), (4, "TC-A-1.10/TC-A-1.2", "TC-A-1.10TC-A-1.2")]
    df = spark.createDataFrame(rows, "k int, title string, old string")
    ids = spark.createDataFrame([("TC-A-1.1", "TC-A-1.2"), ("TC-A-1.2", "TC-A-1.1"), ("TC-A-1.10", "TC-A-1.1"), ("TC-B-1.1", "TC-C-2.2"), ("TC-B-1.1", "TC-C-2.1"), (None, "x"), ("TC-A-9.9", None)], "old string, new string")
    want = [(1, "TC-A-1.2 and TC-A-1.1", "TC-A-1.1, TC-A-1.2")] * 2 + [(2, None, "XTC-A-1.1 TC-A-1.1x TC-C-2.1 TC-A-9.9"), (3, "", None), (4, "TC-A-1.1/TC-A-1.1", "TC-A-1.10TC-A-1.2")]
    for small in (I.SMALL, -1):
        monkeypatch.setattr(I, "SMALL", small)
        out = I.rewritten(df, ["title", "old"], ids)
        assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert I.rewritten(df.filter("false"), ["title"], ids).count() == 0
    assert sorted(map(tuple, I.rewritten(df, ["title"], ids.filter("false")).collect()), key=repr) == sorted(rows, key=repr)


def test_few_ids_are_looked_up_without_a_shuffle_and_many_are_joined(spark):
    text = lambda *ks: " ".join(f"TC-A-1.{k}" for k in ks)
    ids = spark.createDataFrame([(f"TC-A-1.{k}", f"TC-A-1.{k + 1}") for k in range(100)], "old string, new string")
    few = spark.createDataFrame([(1, text(1, 2, 1, 200)), (2, None), (3, "none"), (3, "none")], "k int, title string")
    out = I.rewritten(few, ["title"], ids)
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    want = [(1, text(2, 3, 2, 200)), (2, None), (3, "none"), (3, "none")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    many = few.union(spark.createDataFrame([(4, text(*range(20), 5)), (5, text(*range(I.LOOKUPS)))], "k int, title string"))
    want += [(4, text(*range(1, 21), 6)), (5, text(*range(1, I.LOOKUPS + 1)))]
    assert sorted(map(tuple, I.rewritten(many, ["title"], ids).collect()), key=repr) == sorted(want, key=repr)


def test_new_cases_are_numbered_on(spark):
    rows = [(1, "[TC-A-2.7] zeta", "TC-A-2.7 TC-A-2.70"), (2, "[TC-A-2.7] Alpha", None), (3, "[TC-A-02.1] alpha", "TC-A-02.1"), (4, "no id", "TC-A-2.7"), (5, None, "x"), (6, "TC-B-1.1", ""), (7, "TC-A-3." + "9" * 30, "y")]
    items = spark.createDataFrame([(*r, 0) for r in rows], "k int, title string, body string, number int")
    old = spark.createDataFrame([("TC-A-2.4",), ("TC-A-2.10",), ("TC-A-3.1",), (None,), ("junk",)], "tc_id string")
    got = {r.k: (r.tc_id, r.title, r.body) for r in I.renumbered_cases(items, old, "k", "title", "body").collect()}
    assert got == {
        1: ("TC-A-2.13", "[TC-A-2.13] zeta", "TC-A-2.13 TC-A-2.70"),
        2: ("TC-A-2.11", "[TC-A-2.11] Alpha", None),
        3: ("TC-A-2.12", "[TC-A-2.12] alpha", "TC-A-2.12"),
        4: (None, "no id", "TC-A-2.7"),
        5: (None, None, "x"),
        6: ("TC-B-1.1", "TC-B-1.1", ""),
        7: (None, "TC-A-3." + "9" * 30, "y"),
    }
    assert I.renumbered_cases(items.filter("false"), old, "k", "title", "body").count() == 0
