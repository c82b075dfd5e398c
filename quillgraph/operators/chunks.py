"""Chunks of test cases for retrieval: four texts each, long ones split, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def _part(label: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(label), value))


def _numbered(items: Column, before: str = "") -> Column:
    return F.array_join(F.transform(items, lambda s, i: F.concat(F.lit(before), (i + 1).cast("string"), F.lit(". "), s)), "\n")


def _glued(parts: list[Column], glue: str) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), glue)


def step_actions(steps: Column, cap: int = 20) -> Column:
    """Distinct lower-case phrases of more than three letters: acronyms and terms, runs of capitalised words, and the
    first two words of each step that aren't trivial; terms in their listed order."""
    low = F.lower(F.array_join(steps, "\n"))
    per_step = F.flatten(
        F.transform(
            steps,
            lambda s: F.concat(
                F.transform(F.filter(F.regexp_extract_all(s, F.lit(r"\b([A-Z]{3,})\b"), F.lit(1)), lambda w: ~w.isin(*V.NO_ACRONYMS)), F.lower),
                F.filter(F.array(*[F.when(F.lower(s).contains(t), F.lit(t)) for t in V.STEP_TERMS]), lambda x: x.isNotNull()),
            ),
        )
    )
    titles = F.flatten(F.transform(steps, lambda s: F.transform(F.regexp_extract_all(s, F.lit(r"((?:[A-Z][a-z]+\s+)+[A-Z][a-z]+)"), F.lit(1)), F.lower)))

    def first_two(s: Column) -> Column:
        words = F.split(F.trim(F.regexp_replace(s, r"^\s*(?:\d+[.)]\s*|[a-zA-Z][.)]\s*)", "")), r"\s+")
        plain = F.transform(F.filter(words, lambda w: F.length(w) > 2), lambda w: F.lower(F.btrim(w, F.lit(".,();:"))))
        return F.array_join(F.slice(F.filter(plain, lambda w: w.rlike(r"^[a-z]+$") & ~w.isin(*V.TRIVIAL)), 1, 2), " ")

    every = F.concat(per_step, titles, F.transform(steps, first_two))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.slice(F.array_distinct(F.filter(F.transform(every, lambda x: F.trim(x)), lambda p: F.length(p) > 3)), 1, cap))


def texts(df: DataFrame) -> dict[str, Column]:
    """The four texts of a test case; empty where it has nothing to say.

    Columns: tc_id, title, cluster, purpose, prerequisites, setup, procedure_steps, expected_outcomes, intents,
    entity_refs, dut_type; those that aren't there count as empty.
    """
    text = lambda n: _text(n) if n in df.columns else F.lit("")
    items = lambda n: _list(n) if n in df.columns else F.array().cast("array<string>")
    steps, outcomes, refs, wants = items("procedure_steps"), items("expected_outcomes"), items("entity_refs"), items("intents")
    name = F.concat(F.lit("["), text("tc_id"), F.lit("] "), text("title"))
    full = [_part(f"{k}: ", text(c)) for k, c in (("Test Case", "tc_id"), ("Title", "title"), ("Cluster", "cluster"), ("Purpose", "purpose"), ("Prerequisites", "prerequisites"), ("Setup", "setup"))]
    full += [_part("Procedure:\n", _numbered(steps, "  ")), _part("Expected Outcomes:\n", F.array_join(F.transform(outcomes, lambda o: F.concat(F.lit("  - "), o)), "\n"))]
    names = F.array_join(F.transform(F.slice(refs, 1, 5), lambda r: F.element_at(F.split(r, "::"), -1)), ", ")
    summary = [
        name,
        _part("Cluster: ", text("cluster")),
        F.concat(F.lit("Intents: "), F.when(F.size(wants) > 0, F.array_join(wants, ", ")).otherwise("unknown")),
        _part("Entities: ", names),
        _part("Purpose: ", text("purpose")),
        _part("Step actions: ", F.array_join(step_actions(steps), ", ")),
    ]
    setup = [_part("Prerequisites: ", text("prerequisites")), _part("Test Environment: ", text("setup")), _part("DUT Type: ", text("dut_type"))]
    said = _glued(setup, "\n\n")
    return {
        "full": _glued(full, "\n\n"),
        "intent_summary": _glued(summary, "\n"),
        "procedure": F.when(F.size(steps) > 0, F.concat(name, F.lit(" — Procedure\n"), _numbered(steps))).otherwise(""),
        "setup": F.when(said != "", F.concat(name, F.lit(" — Setup\n\n"), said)).otherwise(""),
    }


def _packed(parts: Column, glue: str, cap: int) -> Column:
    """Neighbouring parts joined as long as they fit; a longer one stands alone.  What is joined so far is the array's
    last element, so a step costs the parts of one text only."""

    def step(acc: Column, p: Column) -> Column:
        last = F.element_at(acc, -1)
        fits = (F.size(acc) > 0) & (F.length(last) + F.length(p) + len(glue) <= cap)
        return F.when(fits, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(last, F.lit(glue), p)))).otherwise(F.concat(acc, F.array(p)))

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def split_text(text: Column, cap: int = V.CHUNK_CHARS) -> Column:
    """Pieces of a text over ``cap``: packed paragraphs, and of a paragraph over it packed sentences."""
    paragraphs = F.split(text, "\n\n", -1)
    short = F.flatten(F.transform(paragraphs, lambda p: F.when(F.length(p) > cap, _packed(F.split(p, r"\. ", -1), ". ", cap)).otherwise(F.array(p))))
    return F.when(F.length(text) > cap, _packed(short, "\n\n", cap)).otherwise(F.array(text))


def vector_chunks(test_cases: DataFrame, cap: int = V.CHUNK_CHARS) -> DataFrame:
    """(chunk_id, tc_id, chunk_type, part, parts, text): the texts that aren't empty; full and procedure ones over ``cap``
    in parts, each headed by the test case and its place."""
    found = texts(test_cases)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("chunk_type"), v.alias("text")) for k, v in found.items()]))
    name = F.concat(F.lit("["), _text("tc_id"), F.lit("] "), _text("title"), F.lit(" — "), _text("cluster")).alias("head")
    df = test_cases.select("tc_id", name, each.alias("c")).select("tc_id", "head", "c.*").filter(F.trim("text") != "")
    pieces = F.when(F.col("chunk_type").isin("full", "procedure"), split_text(F.col("text"), cap)).otherwise(F.array("text"))
    df = df.withColumn("pieces", pieces).withColumn("parts", F.size("pieces")).select("tc_id", "head", "chunk_type", "parts", F.posexplode("pieces").alias("i", "text"))
    one, n = F.col("parts") == 1, (F.col("i") + 1).cast("string")
    base = F.concat_ws("::", "tc_id", "chunk_type")
    text = F.concat(F.col("head"), F.lit(" (part "), n, F.lit("/"), F.col("parts").cast("string"), F.lit(")\n\n"), F.col("text"))
    return df.select(F.when(one, base).otherwise(F.concat(base, F.lit("::part"), n)).alias("chunk_id"), "tc_id", "chunk_type", (F.col("i") + 1).alias("part"), "parts", F.when(one, F.col("text")).otherwise(text).alias("text"))
