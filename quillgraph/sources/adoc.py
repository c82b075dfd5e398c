"""AsciiDoc test plans to sections, test-case records, chunks and updated texts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

PARTS = V.PARTS
_HEAD = re.compile(r"^(=+|#+)\s+(.*?)\s*$")
_CASE = re.compile(r"\b(TC-([A-Z][A-Z0-9]*)-(\d+)\.(\d+))\b")
_CODE = re.compile(r"\b[A-Z][A-Z0-9]{0,15}\.[SC](?:\.[ACEF][0-9a-fA-F]{2,4}(?:\.\w+)?)?(?![0-9A-Za-z])")
_ITEM = re.compile(r"^\s*(?:[*\-•]+|\.+|\d+\.)\s+(.*)$")
_NOTE = re.compile(r"^(?:NOTE|TIP|WARNING|IMPORTANT|CAUTION):\s*(.*)$", re.I)
_STEP = re.compile(r"^(?:(\d+)\.|[Ss]tep\s+(\d+)[:.]?|\.(?!\.)\.?)\s+(.+)$")
_EXPECTED = re.compile(r"^[*\-•]?\s*(?:[Ee]xpected|[Vv]erif(?:y|ication)):?\s+(.+)$")


def headings(text: str) -> list[tuple[int, str, str]]:
    """(level, title, body); what stands before the first heading has level 0."""
    out: list[tuple[int, str, list[str]]] = [(0, "", [])]
    for line in text.split("\n"):
        m = _HEAD.match(line)
        if m:
            out.append((len(m[1]), m[2], []))
        else:
            out[-1][2].append(line)
    return [(lv, t, "\n".join(b).strip()) for lv, t, b in out if t or "".join(b).strip()]


def table(text: str) -> list[list[str]]:
    """Rows of the first ``|===`` table: compact rows, or a cell a line with blank lines between rows."""
    m = re.search(r"\|===[^\n]*\n(.*?)\n?\|===", text, re.S)
    if not m:
        return []
    rows, now = [], []
    for line in m[1].split("\n"):
        if not line.strip():
            if now:
                rows.append(now)
                now = []
        elif line.lstrip().startswith("|"):
            cells = [c.strip() for c in line.lstrip()[1:].split("|")]
            if len(cells) > 1 and now:
                rows.append(now)
                now = []
            now += cells
            if len(cells) > 1:
                rows.append(now)
                now = []
        elif now:
            now[-1] = f"{now[-1]} {line.strip()}".strip()
        elif rows:
            rows[-1][-1] = f"{rows[-1][-1]} {line.strip()}".strip()
    return rows + ([now] if now else [])


def bullets(text: str) -> list[str]:
    """List items with their continuation lines; without any item, the lines themselves."""
    out: list[str] = []
    for line in text.split("\n"):
        m = _ITEM.match(line)
        if m:
            out.append(m[1].strip())
        elif out and line.strip() and line.strip() not in ("+", "--"):
            out[-1] = f"{out[-1]} {line.strip()}"
    return out or [x.strip() for x in text.split("\n") if x.strip()]


def role(header: str) -> str:
    """What a column of a table of steps holds."""
    low = header.lower()
    for name, words in (("pics", ("pics",)), ("expected", ("expected", "outcome", "result", "verification")), ("text", ("step", "action", "procedure", "description", "test")), ("step", ("#", "no", "number"))):
        if any(w in low for w in words) and not (name == "text" and low.strip() in ("step", "steps", "step #", "test step #")):
            return name
    return "step" if "step" in low or not low.strip() else ""


def steps(text: str) -> list[dict]:
    """(step_no, text, expected, pics) from the table of a section, else from its list."""
    rows = table(text)
    if len(rows) > 1:
        roles = [role(h) for h in rows[0]]
        if "text" not in roles and len(roles) >= 2:
            roles = (["step", "text"] + ["expected"] * len(roles))[: len(roles)]
        out = []
        for row in rows[1:]:
            of = {k: " ".join(c for c, r in zip(row, roles, strict=False) if r == k).strip() for k in ("step", "text", "expected", "pics")}
            number = re.sub(r"\D", "", of["step"])
            if of["text"] or of["expected"]:
                out.append({"step_no": int(number[:9]) if number else len(out) + 1, "text": of["text"], "expected": of["expected"], "pics": _CODE.findall(of["pics"])})
        if out:
            return out
    out = []
    for line in (x.strip() for x in text.split("\n")):
        m = _STEP.match(line)
        if m:
            out.append({"step_no": int((m[1] or m[2] or str(len(out) + 1))[:9]), "text": m[3], "expected": "", "pics": []})
        elif out and line and line not in ("+", "--"):
            e = _EXPECTED.match(line)
            key, more = ("expected", e[1]) if e else ("text", line)
            out[-1][key] = f"{out[-1][key]} {more}".strip()
    return out


@dataclass
class Case:
    tc_id: str
    prefix: str
    title: str
    parts: dict[str, str] = field(default_factory=dict)
    steps: list[str] = field(default_factory=list)
    codes: list[str] = field(default_factory=list)
    records: list[dict] = field(default_factory=list)
    notes: list[str] = field(default_factory=list)
    devices: list[dict] = field(default_factory=list)


def devices(text: str) -> list[dict]:
    """(name, description): "Name (what it is)", "Name: what it is" or "Name - what it is"."""
    out = []
    for x in bullets(text):
        m = re.match(r"^(.*?)\s*(?:\((.*)\)|[:\-–]\s+(.*))$", x)
        out.append({"name": (m[1] if m else x).strip(), "description": (m[2] or m[3] or "").strip() if m else ""})
    return out


def cases(text: str) -> list[Case]:
    """The test cases of a plan: a heading with an id, up to the next heading as high."""
    out: list[Case] = []
    level = 0
    for lv, title, body in headings(text):
        m = _CASE.search(title)
        if m:
            level = lv
            out.append(Case(m[1], m[2], title.replace(m[1], "").strip(" []-:"), {"other": body} if body else {}))
        elif out and lv > level:
            key = PARTS.get(title.lower().strip(), f"other:{title}")
            out[-1].parts[key] = "\n".join(x for x in (out[-1].parts.get(key), body) if x)
        elif out:
            level = 99
    for c in out:
        c.records = steps(c.parts.get("test_steps", ""))
        c.steps = [r["text"] for r in c.records]
        c.codes = list(dict.fromkeys(_CODE.findall(c.parts.get("pics") or " ".join(c.parts.values()))))
        own = [re.sub(_NOTE, r"\1", re.sub(r"^[-*•]\s+", "", x.strip())).strip() for x in c.parts.get("notes", "").split("\n") if x.strip()]
        inline = [m[1].strip() for k, v in c.parts.items() if k != "notes" for x in v.split("\n") if (m := _NOTE.match(x.strip()))]
        c.notes = list(dict.fromkeys(x for x in own + inline if x))
        c.devices = devices(c.parts.get("required_devices", ""))
    return out


_STEPS = pa.list_(pa.struct([("step_no", pa.int32()), ("text", pa.string()), ("expected", pa.string()), ("pics", pa.list_(pa.string()))]))
_DEVICES = pa.list_(pa.struct([("name", pa.string()), ("description", pa.string())]))
_RECORD = "path string, position int, tc_id string, prefix string, title string, purpose string, pics array<string>, preconditions array<string>, required_devices array<struct<name:string,description:string>>, device_topology string, test_setup string, test_steps array<struct<step_no:int,text:string,expected:string,pics:array<string>>>, expected_results string, notes array<string>"


def test_cases(files: DataFrame, path_col: str = "path", text_col: str = "content") -> DataFrame:
    """A row for each test case of each plan: (path, position, tc_id, prefix, title, purpose, pics, preconditions,
    required_devices, device_topology, test_setup, test_steps, expected_results, notes).  Null texts have none."""

    def run(batches):
        for b in batches:
            rows = []
            for p, t in zip(b.column("path").to_pylist(), b.column("text").to_pylist(), strict=True):
                for i, c in enumerate(cases(attributes(t or ""))):
                    g = c.parts.get
                    rows.append((p, i, c.tc_id, c.prefix, c.title, g("purpose", g("other", "")), c.codes, bullets(g("preconditions", "")), c.devices, g("device_topology", ""), g("test_setup", ""), c.records, g("expected_results", ""), c.notes))
            s, l = pa.string(), pa.list_(pa.string())
            kinds = [s, pa.int32(), s, s, s, s, l, l, _DEVICES, s, s, _STEPS, s, l]
            cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            names = ["path", "position", "tc_id", "prefix", "title", "purpose", "pics", "preconditions", "required_devices", "device_topology", "test_setup", "test_steps", "expected_results", "notes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _RECORD)


def _lines(items: Column, before: str) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit(before), x)), "\n")


def case_chunks(records: DataFrame) -> DataFrame:
    """(path, tc_id, chunk_type, text) of test-case records: one primary text with all that is searched for, and one for
    each part that isn't empty."""
    c = F.col
    step = lambda s: F.concat(s.step_no.cast("string"), F.lit(". "), s.text, F.when(s.expected != "", F.concat(F.lit("\n   Expected: "), s.expected)).otherwise(""))
    said = F.array_join(F.transform("test_steps", step), "\n")
    part = lambda label, value: F.when(value != "", F.concat(F.lit(label), value)).otherwise("")
    primary = F.concat(
        F.when(c("title") != "", F.concat_ws(": ", "tc_id", "title")).otherwise(c("tc_id")),
        part("\nPurpose: ", c("purpose")),
        part("\nPICS: ", F.array_join("pics", ", ")),
        part("\nPreconditions:\n", _lines(c("preconditions"), "- ")),
        part("\nTopology: ", c("device_topology")),
        part("\nTest Steps:\n", said),
        part("\nNotes: ", F.array_join("notes", "; ")),
    )
    texts = {
        "primary": primary,
        "purpose": c("purpose"),
        "pics": F.array_join(F.transform("pics", lambda x: F.concat(F.lit("[PICS."), x, F.lit("]"))), "\n"),
        "preconditions": _lines(c("preconditions"), "* "),
        "required_devices": F.array_join(F.transform("required_devices", lambda d: F.concat(F.lit("* "), d["name"], F.lit(" ("), d["description"], F.lit(")"))), "\n"),
        "device_topology": c("device_topology"),
        "test_setup": c("test_setup"),
        "test_steps": said,
        "notes": _lines(c("notes"), "NOTE: "),
    }
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("chunk_type"), F.trim(v).alias("text")) for k, v in texts.items()]))
    return records.select("path", "tc_id", each.alias("x")).select("path", "tc_id", "x.chunk_type", "x.text").filter("text != ''")


_SECTIONS = "path string, position int, level int, title string, text string"


def sections(files: DataFrame, path_col: str = "path", text_col: str = "content") -> DataFrame:
    """A row for each section of each file; what comes before the first heading has level 0."""

    def run(batches):
        for b in batches:
            rows = [(p, i, lv, t, x) for p, s in zip(b.column("path").to_pylist(), b.column("text").to_pylist(), strict=True) for i, (lv, t, x) in enumerate(headings(s or ""))]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 5, kinds, strict=True)], ["path", "position", "level", "title", "text"])

    return files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _SECTIONS)


def index(records: DataFrame) -> DataFrame:
    """(kind, key, path): where a test case, a prefix and a title's letters are first met; the smallest path of equals."""
    stem = F.regexp_replace(F.lower("title"), "[^a-z0-9]", "")
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in (("tc", F.upper("tc_id")), ("prefix", F.upper("prefix")), ("stem", stem))])
    return records.select("path", F.explode(rows).alias("x")).filter("x.key != ''").groupBy("x.kind", "x.key").agg(F.min("path").alias("path"))


def replaced(text: str, tc_id: str, new: str) -> str:
    """The section whose heading names ``tc_id`` replaced by ``new`` up to the next heading as high; appended if absent."""
    lines, start, end, level = text.split("\n"), None, None, 0
    for i, line in enumerate(lines):
        m = _HEAD.match(line)
        if m and start is None and re.search(rf"\b{re.escape(tc_id)}\b", m[2]):
            start, level = i, len(m[1])
        elif m and start is not None and end is None and len(m[1]) <= level:
            end = i
    if start is None:
        return text.rstrip("\n") + "\n\n" + new + "\n"
    return "\n".join(lines[:start] + [new] + lines[end if end is not None else len(lines) :])


def updated(files: DataFrame, updates: DataFrame) -> DataFrame:
    """(path, content, n_updates): texts with their sections replaced or appended, in the order of ``seq``; the first
    update of a test case counts.  ``updates``: path, tc_id, text, seq."""
    first = updates.groupBy("path", "tc_id").agg(F.min(F.struct("seq", "text")).alias("u"))
    lists = first.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("u.seq", "tc_id", "u.text"))).alias("us"))
    j = files.select("path", "content").join(lists, "path")

    def run(batches):
        for b in batches:
            out = []
            for text, us in zip(b.column("content").to_pylist(), b.column("us").to_pylist(), strict=True):
                for u in us:
                    text = replaced(text or "", u["tc_id"], u["text"] or "")
                out.append(text)
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(out, pa.string()), pa.array([len(u) for u in b.column("us").to_pylist()], pa.int32())], ["path", "content", "n_updates"])

    return j.mapInArrow(run, "path string, content string, n_updates int")


def attributes(text: str) -> str:
    """``{x}`` from ``:x: value`` lines; unknown ones stay."""
    known = dict(re.findall(r"^:([\w-]+):\s*(.*?)\s*$", text, re.M))
    return re.sub(r"\{([\w-]+)\}", lambda m: known.get(m[1], m[0]), text)
