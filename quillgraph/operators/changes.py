"""Changed passages: chunks of a diff, and the structured change in each."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

LEAST, MOST, FLUSH = 80, 6000, 50
_MARK = re.compile(r"\[(ADDED|REMOVED|CHANGED): ([^\[\]]*)\]")
@dataclass
class Chunk:
    text: str
    kind: str
    changes: list[str] = field(default_factory=list)


def paragraphs(text: str, least: int = LEAST, most: int = MOST) -> tuple[list[Chunk], list[str]]:
    """Packed paragraphs and the rejected short ones."""
    chunks, rejected, now = [], [], ""
    for p in re.split(r"\n{2,}", text):
        p = p.strip()
        if not p:
            continue
        if len(now) + len(p) + 2 > most and now:
            chunks.append(Chunk(now, "paragraph"))
            now = ""
        if len(p) < least and not now:
            rejected.append(p)
            continue
        now = f"{now}\n\n{p}" if now else p
        while len(now) > most:
            chunks.append(Chunk(now[:most], "paragraph"))
            now = now[most:]
    return chunks + ([Chunk(now, "paragraph")] if now else []), rejected


def hunks(diff: str) -> list[Chunk]:
    """Chunks of a unified diff: at ``@@``, at headings, and at a table row once FLUSH lines have gathered."""
    out, lines = [], []

    def flush():
        body = "\n".join(x[1:] if x[:1] in "+- " else x for x in lines).strip()
        if body:
            kinds = [k for s, k in (("+", "ADDED"), ("-", "REMOVED")) if any(x.startswith(s) for x in lines)]
            out.append(Chunk(body, "hunk", kinds))
        lines.clear()

    for line in diff.split("\n"):
        if line.startswith(("+++", "---", "diff ", "index ")):
            continue
        if line.startswith("@@"):
            flush()
            continue
        if re.match(r"[+\- ]?(=+|#+)\s", line) or len(lines) > FLUSH and line[1:2] == "|":
            flush()
        lines.append(line)
    flush()
    return out


def rows(text: str) -> list[Chunk]:
    """One chunk for each marked table row where a section has two or more."""
    marked = [x for x in text.split("\n") if "|" in x and _MARK.search(x)]
    if len(marked) < 2:
        return [Chunk(text, "section", kinds(text))]
    intro = text.split("\n", 1)[0]
    return [Chunk(f"{intro}\n{x}" if x != intro else x, "row", kinds(x)) for x in marked]


def kinds(text: str) -> list[str]:
    return list(dict.fromkeys(m[1] for m in _MARK.finditer(text)))


def row_change(text: Column) -> Column:
    """What a changed table row's annotation says: a row that is new or gone by how it begins, else the first kind of cell
    that changed, of conformance, access and type."""
    start = F.upper(F.left(text, F.lit(9)))
    return (
        F.when(start.startswith("[ADDED"), "entity_added")
        .when(start.startswith("[REMOVED"), "entity_removed")
        .when(text.rlike(V.CELL_CHANGES["conformance"]), "conformance_changed")
        .when(text.rlike(V.CELL_CHANGES["access"]), "access_changed")
        .when(text.rlike(V.CELL_CHANGES["type"]), "type_changed")
        .otherwise("row_changed")
    )


def chunked(text: str) -> list[Chunk]:
    """Chunks of a change by its form: marked sections, unified diffs (@@ near the start), AsciiDoc headings, paragraphs."""
    if _MARK.search(text):
        return rows(text)
    if "@@" in text[:2000]:
        return hunks(text)
    if re.search(r"^=+\s+\S", text, re.M):
        out = []
        for part in re.split(r"(?m)^(?==+\s+\S)", text):
            out += [Chunk(c.text, "section") for c in paragraphs(part)[0]]
        return out
    return paragraphs(text)[0]


_CHUNKS = "id string, position int, text string, kind string, change_types array<string>"


def change_chunks(df: DataFrame, id_col: str = "path", text_col: str = "content") -> DataFrame:
    """A row for each chunk of each text: (id, position, text, kind, change_types).  Null texts have none."""

    def run(batches):
        for b in batches:
            found = [(i, p, c.text, c.kind, c.changes) for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True) for p, c in enumerate(chunked(t or ""))]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string())]
            cols = list(zip(*found, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _CHUNKS.split(", ")])

    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _CHUNKS)


#: Kinds of cell changes, the most telling first; letters of a quality and the kinds that two of them stand for.
_CELL_KINDS = ("QUIETER_REPORTING_CHANGED", "NON_VOLATILE_CHANGED", "CONFORMANCE_CHANGED", "ACCESS_CHANGED", "DATATYPE_CHANGED", "FALLBACK_CHANGED")
_ENTITY = r"\b([A-Z][a-zA-Z0-9]+)\s+(?:Attribute|Command|Event|Feature)\b"
_ROW = r"(?m)^[+-]\|\s*(?:0x[0-9a-fA-F]{2,}|\d+)\s*\|\s*([A-Z][A-Za-z0-9]+)"
_ID_ROW = r"(?:0x[0-9a-fA-F]{2,})\s*\|?\s*([A-Z][A-Za-z0-9]+)"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first(*arrays: Column) -> Column:
    """The first array that isn't empty."""
    none = F.array().cast("array<string>")
    return F.coalesce(*[F.when(F.size(a) > 0, a) for a in arrays], none)


def structured(df: DataFrame, text: str = "text", cluster: str | None = None, section: str | None = None, hints: str | None = None) -> DataFrame:
    """Add ``change_kind, change_cluster, entities, conditions, old_value, new_value, confidence, ambiguous``.

    A cluster that is added or removed as a heading decides at once.  Else the section's title tells the type of entity,
    the marks (or ``hints``, an array of ADDED, REMOVED, CHANGED) whether it was added, removed or modified; an attribute
    is only added or removed with its whole row.  Names come from the title, else from the text by type, from diff rows,
    from rows with an id, and for requirements and untyped changes from the marks.  A modified attribute's changed cells
    give conditions, old and new values and, by their order, the kind.  Nulls count as empty.
    """
    c, none = F.col, F.array().cast("array<string>")
    t = F.coalesce(c(text), F.lit(""))
    title = F.coalesce(c(section), F.lit("")) if section else F.lit("")
    hint = F.coalesce(c(hints), none) if hints else none
    df = df.withColumns({"_t": t, "_title": title, "_h": hint, "_own": F.coalesce(c(cluster), F.lit("")) if cluster else F.lit("")})
    t, title, low = c("_t"), c("_title"), F.lower("_title")
    named = F.trim(F.regexp_extract(t, r"\b([A-Z][A-Za-z\s/]{2,30})\s+[Cc]luster\b", 1))
    kind = F.lit("")
    for k, words in reversed([(k, k) for k in ("attribute", "command", "event", "feature")] + [("requirement", "requirement|shall|must|behaviou?r")]):
        kind = F.when(low.rlike(words), k).otherwise(kind)
    has = {m: F.array_contains("_h", m) | t.rlike(rf"\[{m}[:\]]") for m in ("ADDED", "REMOVED", "CHANGED")}
    quality = lambda m: _all(t, rf"\[{m}:\s*([A-Z](?:\s+[A-Z])*)\s*\]")
    df = df.withColumns({"_type": kind, "_a": has["ADDED"], "_r": has["REMOVED"], "_c": has["CHANGED"], "change_cluster": F.when(c("_own") != "", c("_own")).otherwise(named), "_qa": quality("ADDED"), "_qr": quality("REMOVED")})
    cells = (F.size("_qa") > 0) | (F.size("_qr") > 0) | t.rlike(V.CELL_CHANGES["conformance"]) | t.rlike(V.CELL_CHANGES["type"]) | t.rlike(V.CELL_CHANGES["default/fallback"])
    whole = lambda sign: t.rlike(rf"(?m)^{sign}\|.*\|\s*(0x[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9_]+)\s*\|")
    is_attribute = c("_type") == "attribute"
    verb = (
        F.when(is_attribute & whole(r"\+") & ~c("_r") & ~cells, "ADD")
        .when(is_attribute & whole("-") & ~c("_a") & ~cells, "REMOVE")
        .when(is_attribute, "MODIFY")
        .when(c("_a") & ~c("_r"), "ADD")
        .when(c("_r") & ~c("_a"), "REMOVE")
        .otherwise("MODIFY")
    )
    marked = c("_a") | c("_r") | c("_c")
    of_cluster = F.when(t.rlike(r"(?m)^\+\s*=+\s*(.+?)\s*[Cc]luster"), "ADD_CLUSTER").when(t.rlike(r"(?m)^-\s*=+\s*(.+?)\s*[Cc]luster"), "REMOVE_CLUSTER")
    df = df.withColumn("_k", F.when(of_cluster.isNotNull(), of_cluster).when(c("_type") != "", F.concat_ws("_", verb, F.upper("_type"))).when(marked, "MODIFY_BEHAVIOR").otherwise("UNKNOWN"))
    by_type = (
        F.when(is_attribute, F.filter(_all(t, r"(?i)\battribute\s+([A-Za-z][A-Za-z0-9]+)\b"), lambda n: ~F.lower(n).isin(*V.NO_ATTRIBUTES)))
        .when(c("_type") == "command", _all(t, r"\bcommand\s+([A-Z][A-Za-z0-9]+)\b"))
        .when(c("_type") == "event", _all(t, r"\bevent\s+([A-Z][A-Za-z0-9]+)\b"))
        .otherwise(none)
    )
    by_mark = F.when(c("_type").isin("requirement", ""), F.concat(F.filter(_all(t, r"\[(?:ADDED|REMOVED|CHANGED):\s*([A-Z][A-Za-z0-9]+)"), lambda n: F.length(n) > 2), _all(t, r"\b([A-Z]{2,6})\.S\b"))).otherwise(none)
    names = _first(_all(title, _ENTITY), by_type, _all(t, _ROW), _all(t, _ID_ROW), by_mark)
    names = F.filter(F.array_distinct(names), lambda n: ~n.isin(*V.NO_NAMES))
    settled = c("_k").isin("ADD_CLUSTER", "REMOVE_CLUSTER")
    df = df.withColumn("entities", F.when(settled | (c("_k") == "UNKNOWN"), none).otherwise(names))
    letters = lambda col: F.filter(F.flatten(F.transform(col, lambda x: F.split(x, r"\s+"))), lambda x: x.isin(*V.QUALITIES))
    table = F.create_map(*[F.lit(x) for kv in V.QUALITIES.items() for x in kv])
    told = lambda col, word: F.transform(letters(col), lambda q: F.concat(F.lit("quality: "), F.element_at(table, q), F.lit(" ("), q, F.lit(f") {word}")))
    modified = c("_k") == "MODIFY_ATTRIBUTE"
    pairs, olds, news, seen = [], [], [], [F.array_contains(F.concat(letters("_qa"), letters("_qr")), "Q"), F.array_contains(F.concat(letters("_qa"), letters("_qr")), "N")]
    for name, pattern in V.CELL_CHANGES.items():
        both = F.arrays_zip(_all(t, pattern, 1).alias("o"), _all(t, pattern, 2).alias("n"))
        if name == "access":
            both = F.filter(both, lambda x: (F.length(x.o) <= 10) & (F.length(x.n) <= 10))
        said = F.transform(both, lambda x: F.concat(F.trim(x.o), F.lit(" → "), F.trim(x.n)))
        pairs.append(F.filter(F.split(F.concat(F.lit(f"{name}: "), F.array_join(said, f"\n{name}: ")), "\n"), lambda x: x.contains("→")))
        olds.append(F.transform(both, lambda x: F.trim(x.o)))
        news.append(F.transform(both, lambda x: F.trim(x.n)))
        seen.append(F.size(both) > 0)
    prose_c = F.arrays_zip(_all(t, r"(?i)conformance[:\s]+(\w+)\s*(?:→|->)\s*(\w+)", 1).alias("o"), _all(t, r"(?i)conformance[:\s]+(\w+)\s*(?:→|->)\s*(\w+)", 2).alias("n"))
    access = r"(?i)access[:\s]+([A-Z\s]+)\s*(?:→|->)\s*([A-Z\s]+)"
    prose_a = F.arrays_zip(_all(t, access, 1).alias("o"), _all(t, access, 2).alias("n"))
    spoken = F.concat(F.transform(prose_c, lambda x: F.concat(F.lit("conformance: "), x.o, F.lit(" → "), x.n)), F.transform(prose_a, lambda x: F.concat(F.lit("access: "), F.trim(x.o), F.lit(" → "), F.trim(x.n))))
    cell = F.when(modified, F.concat(told("_qa", "added"), told("_qr", "removed"), *pairs)).otherwise(none)
    decided = settled | (c("_k") == "UNKNOWN")
    plain = r"\[CHANGED:\s*(.+?)\s*→\s*(.+?)\]"
    old = F.concat(F.when(modified, F.concat(letters("_qr"), *olds)).otherwise(none), F.transform(prose_c, lambda x: x.o), F.transform(_all(t, plain, 1), lambda x: F.left(F.trim(x), F.lit(100))))
    new = F.concat(F.when(modified, F.concat(letters("_qa"), *news)).otherwise(none), F.transform(prose_c, lambda x: x.n), F.transform(_all(t, plain, 2), lambda x: F.left(F.trim(x), F.lit(100))))
    exact = F.lit(None).cast("string")
    for name, hit in reversed(list(zip(_CELL_KINDS, seen, strict=True))):
        exact = F.when(modified & hit, name).otherwise(exact)
    df = df.withColumns({"conditions": F.when(decided, none).otherwise(F.concat(cell, spoken)), "old_value": F.when(decided, "").otherwise(F.coalesce(F.try_element_at(old, F.lit(1)), F.lit(""))), "new_value": F.when(decided, "").otherwise(F.coalesce(F.try_element_at(new, F.lit(1)), F.lit(""))), "_x": exact})
    w = V.CONFIDENCE
    add = lambda cond, k: F.when(cond, w[k]).otherwise(0.0)
    score = F.lit(w["base"]) + add(c("change_cluster") != "", "cluster") + add(F.size("entities") > 0, "entities") + add((F.size("conditions") > 0) | (c("old_value") != ""), "conditions") + add(marked, "marks")
    score = F.round(F.least(F.lit(1.0), score), 2)
    df = df.withColumn("confidence", F.when(settled, 0.9).when(c("_k") == "UNKNOWN", 0.2).when(c("_x").isNotNull(), F.greatest(score, F.lit(V.CELL_CONFIDENCE))).otherwise(score))
    df = df.withColumns({"change_kind": F.coalesce("_x", "_k"), "ambiguous": F.when(settled | c("_x").isNotNull(), F.lit(False)).otherwise((c("_k") == "UNKNOWN") | (c("confidence") < V.SETTLED))})
    return df.drop("_t", "_title", "_h", "_own", "_type", "_a", "_r", "_c", "_qa", "_qr", "_k", "_x")


def merged(df: DataFrame, reply: str = "reply") -> DataFrame:
    """A model's reply, a struct of the same fields, merged in: entities and conditions are only added; the kind, cluster
    and values fill what is empty or unknown; its confidence counts where it has one."""
    c, none = F.col, F.array().cast("array<string>")
    r = lambda f: F.col(f"{reply}.{f}")
    lists = {k: F.array_union(c(k), F.coalesce(r(k), none)) for k in ("entities", "conditions")}
    kind = F.when(c("change_kind") == "UNKNOWN", F.coalesce(r("change_kind"), c("change_kind"))).otherwise(c("change_kind"))
    fill = {k: F.coalesce(F.nullif(c(k), F.lit("")), r(k), F.lit("")) for k in ("old_value", "new_value")}
    confidence = F.coalesce(r("confidence"), c("confidence"))
    return df.withColumns(lists | fill | {"change_kind": kind, "change_cluster": F.coalesce(F.nullif(c("change_cluster"), F.lit("")), r("cluster"), F.lit("")), "confidence": confidence, "ambiguous": F.coalesce(r("ambiguous"), confidence < V.SETTLED)})
