"""Extraction as whole pipelines: requirements from sections, test cases with references, intents and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from . import entities as E
from . import linking as L
from . import rules as R

_NONE = "array<string>"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def requirements(sections: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requirements, rejected) of sections (section_id, title, cluster, section_path, full_text): normative sentences,
    judged, with references, type, clauses and a number in their prefix; and the sentences that were rejected, with reasons.

    ``names``: entity_id, name, cluster.  Ids are REQ::cluster::n, REQ::n without a cluster, in the order of section and
    place.
    """
    base = sections.select("section_id", "title", F.coalesce("cluster", F.lit("")).alias("cluster"), "section_path", _text("full_text").alias("full_text"))
    c = R.filtered(R.candidates(base, "full_text"), "sentence", "title")
    rejected = c.filter("verdict != 'valid'").select("section_id", "pos", "sentence", F.col("verdict").alias("reason"))
    ok = c.filter("verdict = 'valid'").withColumn("key", F.struct("section_id", "pos"))
    refs = E.matched(ok, "key", "requirement", names, "cluster").groupBy("key").agg(F.array_sort(F.collect_set("entity_id")).alias("found"))
    ok = ok.join(refs, "key", "left").withColumn("entity_refs", F.concat(F.coalesce("found", F.array().cast(_NONE)), R.anchors(F.col("requirement"))))
    ok = R.typed(ok, "requirement", "entity_refs").withColumns(R.clause_texts(F.col("requirement")))
    w = Window.partitionBy("cluster").orderBy("section_id", "pos")
    ok = ok.withColumn("n", (F.row_number().over(w) - 1).cast("string"))
    req_id = F.when(F.col("cluster") != "", F.concat_ws("::", F.lit("REQ"), "cluster", "n")).otherwise(F.concat_ws("::", F.lit("REQ"), "n"))
    cols = ["requirement_type", "cluster", "section_id", "section_path", F.col("requirement").alias("normative_text"), "entity_refs", "confidence", "ambiguous", "signals", "alternatives", "score_breakdown", "conditions", "effects", "constraints"]
    return ok.select(req_id.alias("req_id"), *cols), rejected


def table_requirements(tables: DataFrame) -> DataFrame:
    """(section_id, sentence) from table rows (section_id, cells: a map): normative cells of 30 characters or more, columns
    of ids set aside."""
    each = tables.select("section_id", F.explode("cells").alias("column", "sentence"))
    keep = ~F.lower("column").rlike(r"^(#|id|no\.?|number|code|bit|value)$") & (F.length("sentence") >= V.LEAST_LENGTH)
    return each.filter(keep & F.col("sentence").rlike(V.NORMATIVE)).select("section_id", "sentence")


def test_cases(records: DataFrame, names: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Test cases (tc_id, title, purpose, setup, prerequisites, procedure_steps, expected_outcomes, pics_codes) with
    cluster, mode, intents, entity_refs and dut_type.

    Entities are matched twice: first without a cluster, which with the prefix gives the test case one, then within it.
    """
    steps = F.coalesce("procedure_steps", F.array().cast(_NONE))
    t = records.withColumn("_all", F.concat_ws(" ", "title", "purpose", "prerequisites", "setup", F.array_join(steps, " ")))
    found = lambda df, ctx: E.matched(df, "tc_id", "_all", names, ctx).groupBy(F.col("key").alias("tc_id")).agg(F.array_sort(F.collect_set("entity_id")).alias("entity_refs"))
    first = t.join(found(t, None), "tc_id", "left")
    t = t.join(L.inferred_clusters(first, prefixes, names), "tc_id", "left").withColumn("cluster", F.coalesce("cluster", F.lit("")))
    t = t.join(found(t, "cluster"), "tc_id", "left").withColumn("entity_refs", F.concat(F.coalesce("entity_refs", F.array().cast(_NONE)), R.anchors(F.col("_all"))))
    body = F.concat_ws(" ", "title", "purpose", F.array_join(steps, " "))
    codes = F.coalesce("pics_codes", F.array().cast(_NONE))
    return t.withColumns({"intents": R.test_intents(body), "mode": E.test_mode(F.col("tc_id"), F.concat_ws(" ", "tc_id", body), F.col("entity_refs")), "dut_type": L.dut_role(_text("title"), _text("purpose"), F.col("tc_id"), codes)}).drop("_all")


def summaries(test_cases_: DataFrame, most: int = 5) -> DataFrame:
    """(cluster, text): the test cases of each cluster in a line each, for prompts."""
    line = F.concat(F.lit("- "), F.col("tc_id"), F.lit(": "), _text("title"), F.lit(" ["), F.array_join(F.slice("intents", 1, most), ", "), F.lit("]"))
    return test_cases_.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
