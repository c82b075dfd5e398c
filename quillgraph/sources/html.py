"""HTML to heading sections, blocks, tables and change marks, by an event parser that tolerates unclosed tags."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

SKIP = {"style", "script", "noscript", "svg", "template", "head", "link", "meta"}
_VOID = {"link", "meta", "br", "hr", "img", "input"}
_HEADING = re.compile(r"h[1-6]$")
_BLOCK = {"p": "paragraph", "li": "list_item", "td": "cell", "th": "cell", "dd": "paragraph", "pre": "paragraph"}


#: A deletion and what replaces it.
_PAIR = re.compile(r"\[REMOVED: ([^\[\]]*)\]\s*\[CHANGED: ([^\[\]]*)\]")


def paired(text: str) -> str:
    """Deletions with their replacements as one change, gone where both say the same."""
    return tidy(_PAIR.sub(lambda m: "" if m[1].strip() == m[2].strip() else f"[CHANGED: {m[1].strip()} → {m[2].strip()}]", text))


def tidy(text: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text)).strip()


@dataclass
class Section:
    level: int
    title: str
    path: list[str]
    blocks: list[tuple[str, str]] = field(default_factory=list)
    rows: list[list[str]] = field(default_factory=list)


class Sections(HTMLParser):
    """A section for each heading, with the headings above it; text before the first has level 0."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.sections = [Section(0, "", [])]
        self.stack: list[tuple[int, str]] = []
        self.skip: list[str] = []
        self.kind, self.text = "paragraph", ""
        self.level = 0
        self.mark = ""

    def close_block(self) -> None:
        text, self.text = paired(tidy(self.text)), ""
        if self.level:
            while self.stack and self.stack[-1][0] >= self.level:
                self.stack.pop()
            self.stack.append((self.level, text))
            self.sections.append(Section(self.level, text, [t for _, t in self.stack]))
            self.level = 0
        elif text:
            if self.kind == "cell":
                (self.sections[-1].rows or self.sections[-1].rows.append([]) or self.sections[-1].rows)[-1].append(text)
            else:
                self.sections[-1].blocks.append((self.kind, text))
        self.kind = "paragraph"

    def handle_starttag(self, tag, attrs):
        if self.skip or tag in SKIP:
            if tag not in _VOID:
                self.skip.append(tag)
            return
        classes = dict(attrs).get("class") or ""
        if tag in ("ins", "del"):
            self.mark = {"ins": "ADDED", "del": "REMOVED"}[tag]
            if "diff-chg" in classes:
                self.mark = "CHANGED"
            self.text += f" [{self.mark}: "
        elif _HEADING.match(tag):
            self.close_block()
            self.level = int(tag[1])
        elif tag == "tr":
            self.close_block()
            self.sections[-1].rows.append([])
        elif tag in _BLOCK:
            self.close_block()
            self.kind = _BLOCK[tag]
        elif tag == "br":
            self.text += " "

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if tag in ("ins", "del"):
            self.text += "] "
        elif _HEADING.match(tag) or tag in _BLOCK or tag in ("div", "table", "ul", "ol", "section"):
            self.close_block()

    def handle_data(self, data):
        if not self.skip:
            self.text += data


def sections(html: str | None) -> list[Section]:
    parser = Sections()
    parser.feed(html or "")
    parser.close()
    parser.close_block()
    return [s for s in parser.sections if s.level or s.blocks or s.rows]


def clean(html: str | None) -> str:
    return "\n".join(x for s in sections(html) for x in [s.title, *[t for _, t in s.blocks], *[" | ".join(r) for r in s.rows]] if x)


_OUT = "id long, position int, level int, title string, path string, text string, n_blocks int, n_rows int"


#: Pages whose parsed rows are held until they go out.
SLICE = 64


def sliced(batches, rows: int = SLICE):
    """Batches of at most ``rows`` rows; an empty one stays."""
    for b in batches:
        for i in range(0, max(1, b.num_rows), rows):
            yield b.slice(i, rows)


def _sections(batches):
    for b in sliced(batches):
        rows = [(i, p, s.level, s.title, " > ".join(s.path), "\n".join([t for _, t in s.blocks] + [" | ".join(r) for r in s.rows]), len(s.blocks), len(s.rows)) for i, h in zip(b.column("id").to_pylist(), b.column("html").to_pylist(), strict=True) for p, s in enumerate(sections(h))]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()]
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _OUT.split(", ")])


def heading_sections(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """A row for each section of each page."""
    return pages.selectExpr(f"cast({id_col} as long) as id", f"{html_col} as html").mapInArrow(_sections, _OUT)


def clean_text(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, text): the text of each page without noise; null and empty pages have an empty one."""

    def run(batches):
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([clean(h) for h in b.column("html").to_pylist()], pa.string())], ["id", "text"])

    return pages.selectExpr(f"cast({id_col} as long) as id", f"{html_col} as html").mapInArrow(run, "id long, text string")
