"""Folders and tables as documents: (path, content, ext, source_id, role)."""

from __future__ import annotations

import fnmatch
import json
import os
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import prose
from . import adoc, html

EXTENSIONS = ("adoc", "md", "txt", "html", "htm", "xml", "csv")


def resolved(value, env: dict[str, str] | None = None):
    """``${VAR}`` replaced in strings of nested settings; unknown ones stay."""
    env = os.environ if env is None else env
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], m[0]), value)
    if isinstance(value, dict):
        return {k: resolved(v, env) for k, v in value.items()}
    return [resolved(v, env) for v in value] if isinstance(value, list) else value


def source_list(path: str) -> list[dict]:
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8") as f:
        return resolved(json.load(f))


def folder(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS, exclude: str | list[str] | None = None, source_id: str = "", role: str = "spec") -> DataFrame:
    """Files below a folder by extension ("*": all); ``exclude`` holds file-name globs such as ``draft*.md``.  Bytes that
    aren't UTF-8 are Latin-1."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    raw = raw.withColumn("ext", ext)
    if extensions != ("*",):
        raw = raw.filter(F.col("ext").isin(*extensions))
    for glob in [exclude] if isinstance(exclude, str) else exclude or []:
        pattern = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob) if "[" not in glob else fnmatch.translate(glob).removeprefix("(?s:").removesuffix(r")\Z")
        raw = raw.filter(~F.regexp_extract("path", r"([^/]+)$", 1).rlike(f"^{pattern}$"))
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1"))
    return raw.select("path", text.alias("content"), "ext", F.lit(source_id).alias("source_id"), F.lit(role).alias("role"))


def csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A document for each row, as prose of its cells; empty rows go."""
    df = spark.read.option("header", True).option("multiLine", True).csv(path)
    return df.select(prose(columns or df.columns).alias("content")).filter("content <> ''")


def read(spark: SparkSession, config: dict) -> DataFrame:
    """By ``type``: local_folder, csv, json, parquet, xml.  Kinds that need a network aren't offered."""
    kind = config.get("type")
    if kind == "local_folder":
        return folder(spark, config["path"], tuple(config.get("extensions", EXTENSIONS)), config.get("exclude"), config.get("id", ""), config.get("role", "spec"))
    if kind == "csv":
        return csv_rows(spark, config["path"], config.get("columns"))
    if kind == "xml":
        return folder(spark, config["path"], ("xml",), config.get("exclude"), config.get("id", ""), "data_model")
    if kind in ("json", "parquet"):
        return spark.read.format(kind).load(config["path"])
    raise ValueError(f"unknown source type {kind!r}")


def packed_rows(rows: DataFrame, order: list[str], columns: list[str], size: int = 1000) -> DataFrame:
    """(chunk, text, n_rows): consecutive rows as prose, joined until a chunk has ``size`` characters.

    A chunk depends on the rows before it, so a file's rows pass one task as a sorted stream.
    """
    line = rows.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], prose(columns).alias("line")).filter("line != ''")
    line = line.repartition(1).sortWithinPartitions(*[f"_o{i}" for i in range(len(order))]).select("line")

    def run(batches):
        now, n, used = [], 0, 0
        for b in batches:
            out = []
            for x in b.column("line").to_pylist():
                now.append(x)
                used += len(x) + 1
                if used - 1 >= size:
                    out.append((n, "\n".join(now), len(now)))
                    now, n, used = [], n + 1, 0
            if out:
                yield _chunks(out)
        if now:
            yield _chunks([(n, "\n".join(now), len(now))])

    return line.mapInArrow(run, "chunk int, text string, n_rows int")


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.int32()), strict=True)], ["chunk", "text", "n_rows"])


def _windows(files: DataFrame) -> DataFrame:
    each = files.select("path", F.posexplode(T.char_windows(F.col("content"))).alias("position", "c"))
    return each.select("path", "position", F.lit("").alias("title"), F.lit(0).alias("level"), F.col("c.chunk").alias("text"))


def _adoc(files: DataFrame) -> DataFrame:
    return adoc.sections(files).select("path", "position", "title", "level", F.concat_ws("\n", F.nullif("title", F.lit("")), "text").alias("text"))


def _html(files: DataFrame) -> DataFrame:
    s = html.heading_sections(files.withColumn("_id", F.xxhash64("path")), "_id", "content").drop("path")
    s = s.join(files.select(F.xxhash64("path").alias("id"), "path"), "id")
    return s.select("path", "position", "title", "level", F.concat_ws("\n", F.nullif("title", F.lit("")), "text").alias("text"))


#: Which loader takes which extension; others are taken as plain text.
LOADERS: dict[str, Callable[[DataFrame], DataFrame]] = {"adoc": _adoc, "html": _html, "htm": _html, "md": _windows, "txt": _windows}


def loaded(files: DataFrame, loaders: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """(path, position, title, level, text): the chunks of files by extension.  Empty chunks are left out."""
    loaders = LOADERS if loaders is None else loaders
    parts = [f(files.filter(F.col("ext") == ext)) for ext, f in loaders.items()]
    parts.append(_windows(files.filter(~F.col("ext").isin(*loaders))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("trim(text) != ''")


#: Cleaning rules by type: what each does to a text, from its settings.
RULES: dict[str, Callable[[Column, dict], Column]] = {
    "strip_regex": lambda t, r: T.drop_lines(t, r["pattern"]) if r.get("scope", "line") == "line" else F.regexp_replace(t, "(?m)" + r["pattern"], ""),
    "strip_block_between": lambda t, r: T.drop_block(t, r["start"], r["end"]),
    "strip_first_lines": lambda t, r: T.drop_ends(t, int(r.get("count", 1)), 0),
    "strip_last_lines": lambda t, r: T.drop_ends(t, 0, int(r.get("count", 1))),
    "normalize_whitespace": lambda t, r: T.squeeze(t),
    "replace_regex": lambda t, r: F.regexp_replace(t, r["pattern"], r.get("replacement", "")),
    "ignore": lambda t, r: T.ignore(t, r["pattern"], r.get("match", "contains"), r.get("scope", "line"), r.get("case_sensitive", True)),
}


def processed(files: DataFrame, shared: list[dict], own: dict[str, list[dict]] | None = None) -> tuple[DataFrame, list[str]]:
    """Files with their content cleaned by rules, shared ones first, then those of their source; and what went wrong.

    A rule's ``apply_to`` lists extensions.  A rule of an unknown type or without its settings is skipped and reported; the
    column ``rules_applied`` counts the others.

    Each rule is a projection of its own over the one before, so the plan grows with the number of rules: the content
    stands in a rule's result and in its other case, and spelt out in both it would double with each rule.
    """
    errors: list[str] = []
    out, applied = files.withColumn("content", F.coalesce("content", F.lit(""))), F.lit(0)
    for rules, source in [(shared, None), *[(v, k) for k, v in (own or {}).items()]]:
        for r in rules:
            try:
                changed = RULES[r["type"]](F.col("content"), r)
            except (KeyError, ValueError, TypeError) as e:
                errors.append(f"rule {r}: {type(e).__name__} {e}")
                continue
            when = F.lit(True) if source is None else F.col("source_id") == source
            if r.get("apply_to"):
                when = when & F.col("ext").isin(*[x.lstrip(".") for x in r["apply_to"]])
            out, applied = out.withColumn("content", F.when(when, changed).otherwise(F.col("content"))), applied + when.cast("int")
    return out.withColumn("rules_applied", applied), errors


#: The role that a source's documents play.
ROLES = ("pr", "test_plan", "spec", "data_model", "adoc_folder")


def by_role(documents: DataFrame) -> dict[str, DataFrame]:
    return {r: documents.filter(F.col("role") == r) for r in ROLES}


def plain_sections(files: DataFrame, path_col: str = "path", text_col: str = "content") -> DataFrame:
    """(path, position, title, text): sections of plain texts, headed by # or = marks or by a number and a capital."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    each = files.select(F.col(path_col).alias("path"), F.posexplode(lines).alias("line", "s"))
    head = F.col("s").rlike(r"^(#+|=+)\s+\S|^\d+(\.\d+)+\.?\s+[A-Z]")
    from pyspark.sql import Window

    w = Window.partitionBy("path").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("position", F.sum(head.cast("int")).over(w))
    title = F.max(F.when(head, F.trim(F.regexp_replace("s", r"^(#+|=+)\s+", ""))))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("line", "s")))), lambda x: x.s), "\n")
    return each.groupBy("path", "position").agg(F.coalesce(title, F.lit("")).alias("title"), F.trim(body).alias("text"))
