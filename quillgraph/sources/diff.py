"""Diff HTML to changed sections and changed table rows, one row each.

The page is read into a tree that tolerates unclosed tags; a section is a ``div`` of class sect1 to sect6, and its text
ends where a section within it begins.  ``ins`` and ``del`` become marks: a deletion with the insertion that replaces it
is [CHANGED: old → new], gone where both say the same, others are [REMOVED: ...] and [ADDED: ...].
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SECTION, _HEADING = re.compile(r"sect([1-6])$"), re.compile(r"h[1-6]$")
_SPACE = re.compile(r"\s+")
MARKED = r"\[(ADDED|REMOVED|CHANGED):"


def _plain(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


@dataclass(eq=False)
class Node:
    tag: str
    classes: tuple[str, ...] = ()
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text for c in self.children)

    def below(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.below()

    def above(self):
        n = self.parent
        while n is not None:
            yield n
            n = n.parent

    @property
    def level(self) -> int:
        """1 to 6 for a section, else 0."""
        found = [int(m[1]) for c in self.classes if (m := _SECTION.match(c))] if self.tag == "div" else []
        return found[0] if found else 0

    @property
    def heading(self) -> Node | None:
        # an insertion may wrap the heading
        for c in self.children:
            if isinstance(c, Node):
                if _HEADING.match(c.tag):
                    return c
                if c.tag == "ins":
                    inner = next((x for x in c.children if isinstance(x, Node) and _HEADING.match(x.tag)), None)
                    if inner:
                        return inner
        return None

    @property
    def title(self) -> str:
        return _plain(self.heading.text) if self.heading else ""


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, tuple((dict(attrs).get("class") or "").split()), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:  # an end without a start is passed over
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    p = _Tree()
    p.feed(html or "")
    p.close()
    return p.root


def is_new(section: Node) -> bool:
    """Whether the heading is inserted as a whole, its number set aside."""
    h = section.heading
    if h is None:
        return False
    if any(a.tag == "ins" and "diff-new" in a.classes for a in (h.parent,) if a is not None):
        return True
    new = _plain("".join(n.text for n in h.below() if n.tag == "ins" and "diff-new" in n.classes))
    whole = _plain(h.text)
    return bool(new) and new in (whole, re.sub(V.SECTION_NUMBER, "", whole).strip())


def marked_text(section: Node, within: bool = False) -> str:
    """A section's text with marks, up to the sections within it; plain text of a new section is marked as added."""
    new, out = is_new(section), []

    def put(mark: str, text: str) -> None:
        if text:
            out.append(f"[{mark}: {text}]")

    def walk(nodes: list[Node | str]) -> None:
        done = None
        for i, n in enumerate(nodes):
            if isinstance(n, str):
                text = _plain(n)
                if text:
                    out.append(f"[ADDED: {text}]" if new else text)
            elif n.level and not within:
                continue
            elif n.tag == "del" and "diff-old" in n.classes:
                after = next((x for x in nodes[i + 1 :] if not (isinstance(x, str) and not x.strip())), None)
                old = _plain(n.text)
                if isinstance(after, Node) and after.tag == "ins" and "diff-chg" in after.classes:
                    done, now = after, _plain(after.text)
                    if old and now and old != now:
                        out.append(f"[CHANGED: {old} → {now}]")
                else:
                    put("REMOVED", old)
            elif n.tag == "ins" and ("diff-chg" in n.classes or "diff-new" in n.classes):
                if n is not done:
                    put("ADDED", _plain(n.text))
            else:
                walk(n.children)

    walk(section.children)
    return " ".join(out)


def only_renumbered(text: str) -> bool:
    """Whether all marks are references that got another number."""
    return bool(re.search(MARKED, text)) and not re.search(r"\[(ADDED|REMOVED):", text) and "[CHANGED:" not in re.sub(V.RENUMBERED, "", text)


@dataclass
class Changed:
    cluster: str
    title: str
    level: int
    text: str
    is_new: bool


def _own_diff(section: Node) -> bool:
    for n in section.below():
        if n.tag in ("ins", "del") and any(c.startswith("diff-") for c in n.classes):
            holder = next((a for a in n.above() if a.level or a is section), None)
            if holder is section:
                return True
    return False


def changed(html: str | None, cluster: str = "", section: str = "") -> list[Changed]:
    """The sections from level 2 with marks of their own, those of boilerplate and mere renumbering left out.

    A section's cluster is the nearest section of level 1 or 2 around it, without its number; ``cluster`` and ``section``
    keep what lies in a level that an h3 heads with that name, and titles that hold it.
    """
    root = tree(html)
    found = [n for n in root.below() if n.level]
    tops = [n for n in found if n.heading is not None and n.heading.tag == "h3" and cluster.lower() in n.title.lower()] if cluster else []
    out = []
    for n in found:
        if n.level < 2 or not n.title or re.search(V.SKIPPED_TITLES, n.title) or not _own_diff(n):
            continue
        if cluster and n not in tops and not any(a in tops for a in n.above()):
            continue
        if section and section.lower() not in n.title.lower():
            continue
        holder = next((a for a in n.above() if a.level in (1, 2)), None)
        text = marked_text(n)
        if re.search(MARKED, text) and not only_renumbered(text):
            out.append(Changed(re.sub(V.TITLE_NUMBER, "", holder.title).strip() if holder else "", n.title, n.level, text, is_new(n)))
    return out


_OUT = "path string, position int, cluster string, title string, level int, text string, is_new boolean"


def changed_sections(pages: DataFrame, path_col: str = "path", html_col: str = "content", cluster: str = "", section: str = "") -> DataFrame:
    """A row for each changed section of each page: (path, position, cluster, title, level, text, is_new).

    Null and empty pages have none; a page that isn't well formed is read as far as its tags go.
    """

    def run(batches):
        for b in batches:
            rows = [(p, i, c.cluster, c.title, c.level, c.text, c.is_new) for p, h in zip(b.column("path").to_pylist(), b.column("html").to_pylist(), strict=True) for i, c in enumerate(changed(h, cluster, section))]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.bool_()]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _OUT.split(", ")])

    return pages.select(F.col(path_col).cast("string").alias("path"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, _OUT)


#: Kinds of tables by a word of the heading, else by words of the header row.
_BY_TITLE = {"attribute": "attribute", "command": "command", "event": "event", "feature": "feature"}
_BY_HEADER = {"command": {"direction", "response"}, "event": {"priority"}, "feature": {"bit", "code"}, "attribute": {"quality", "default", "fallback", "type"}}


def _cell(node: Node) -> tuple[str, str, str]:
    """A cell's new text, old text and mark."""
    old, new, mark = [], [], ""

    def walk(n: Node, state: str) -> None:
        nonlocal mark
        for c in n.children:
            if isinstance(c, str):
                (old if state != "ins" else []).append(c)
                (new if state != "del" else []).append(c)
            else:
                inner = {"del": "del", "ins": "ins"}.get(c.tag, state)
                if inner != state:
                    mark = "changed" if mark and mark != {"del": "removed", "ins": "added"}[inner] else {"del": "removed", "ins": "added"}[inner]
                walk(c, inner)

    walk(node, "")
    return _plain("".join(new)), _plain("".join(old)), mark


@dataclass
class Row:
    cluster: str
    section: str
    entity_type: str
    status: str
    cells: dict[str, str]
    old: dict[str, str]


def entity_rows(html: str | None, diff_only: bool = True) -> list[Row]:
    """The rows of entity tables with their status: unchanged, added, removed or changed, and old values of cells.

    A table's kind follows from the title of its section, else from its header row; in a new cluster every row is added.
    """
    out = []
    for t in (n for n in tree(html).below() if n.tag == "table"):
        around = [a for a in t.above() if a.level]
        section = around[0].title if around else ""
        top = next((a for a in around if a.level in (1, 2)), None)
        lines = [[c for c in r.below() if c.tag in ("td", "th")] for r in t.below() if r.tag == "tr"]
        lines = [r for r in lines if r]
        if len(lines) < 2:
            continue
        header = [_cell(c)[0].lower() for c in lines[0]]
        kind = next((v for k, v in _BY_TITLE.items() if k in section.lower()), None) or next((k for k, words in _BY_HEADER.items() if words & set(header)), None)
        if kind is None or "name" not in header:
            continue
        fresh = top is not None and is_new(top)
        for line in lines[1:]:
            cells = [_cell(c) for c in line]
            marks = {m for _, _, m in cells}
            wrapped = {"ins": "added", "del": "removed"}.get(line[0].parent.parent.tag if line[0].parent and line[0].parent.parent else "")
            status = "added" if fresh or wrapped == "added" or marks == {"added"} else "removed" if wrapped == "removed" or marks == {"removed"} else "changed" if marks - {""} else "unchanged"
            if diff_only and status == "unchanged":
                continue
            pairs = list(zip(header, cells, strict=False))
            out.append(Row(re.sub(V.TITLE_NUMBER, "", top.title).strip() if top else "", section, kind, status, {h: o if status == "removed" else n for h, (n, o, _) in pairs}, {h: o for h, (n, o, _) in pairs if status == "changed" and o != n}))
    return out


_ROWS = "path string, cluster string, section string, entity_type string, status string, cells map<string,string>, old_cells map<string,string>"


def changed_rows(pages: DataFrame, path_col: str = "path", html_col: str = "content", diff_only: bool = True) -> DataFrame:
    """A row for each row of an entity table, changed ones only unless ``diff_only`` is off."""

    def run(batches):
        for b in batches:
            rows = [(p, r.cluster, r.section, r.entity_type, r.status, list(r.cells.items()), list(r.old.items())) for p, h in zip(b.column("path").to_pylist(), b.column("html").to_pylist(), strict=True) for r in entity_rows(h, diff_only)]
            m = pa.map_(pa.string(), pa.string())
            kinds = [pa.string()] * 5 + [m, m]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _ROWS.split(", ")])

    return pages.select(F.col(path_col).cast("string").alias("path"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, _ROWS)
