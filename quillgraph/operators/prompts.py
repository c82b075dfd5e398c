"""Assembling the context of a model's prompt: each section is a query, the whole a text within a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .trigrams import either_way


def sections_by_number(wanted: DataFrame, sections: DataFrame, budget: int = 6000) -> DataFrame:
    """(change_id, text): specification sections for a number (change_id, number): the section itself counts 3, its parent
    2, its grandparent 1; only the best that were found, in order, within a budget of characters."""
    number = F.regexp_extract(F.element_at(F.split("section_path", " > "), -1), r"^(\d+(?:\.\d+)*)", 1)
    s = sections.select("section_id", number.alias("number"), "full_text").filter("number != ''")
    parts = F.split("number", r"\.")
    up = F.inline(F.array(*[F.struct(F.when(F.size(parts) > i, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - i, F.lit(1))), ".")).alias("k"), F.lit(3 - i).alias("score")) for i in range(3)]))
    asked = wanted.select("change_id", up).filter("k is not null")
    hits = asked.join(s, F.col("k") == F.col("number"))
    best = hits.groupBy("change_id").agg(F.max("score").alias("best"))
    hits = hits.join(best, "change_id").filter("score = best")
    from .batching import within_budget

    kept = within_budget(hits, "change_id", ["number", "section_id"], "full_text", budget)
    return kept.groupBy("change_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "section_id", "full_text"))), lambda x: x.full_text), "\n\n").alias("text"))


def entity_lines(refs: DataFrame, nodes: DataFrame, edges: DataFrame, most: int = 5) -> DataFrame:
    """(change_id, text): the first entities of a change (change_id, entity_id, pos) with their facts and how many
    requirements implement them."""
    n = edges.filter("edge_type = 'implements'").groupBy(F.col("dst").alias("entity_id")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("change_id").orderBy("pos", "entity_id")
    e = refs.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most)
    j = e.join(nodes.select(F.col("node_id").alias("entity_id"), "node_type", "label", "props"), "entity_id").join(n, "entity_id", "left")
    facts = F.array_join(F.transform(F.array_sort(F.filter(F.map_entries("props"), lambda x: x.value != "")), lambda x: F.concat(x.key, F.lit("="), x.value)), ", ")
    line = F.concat(F.col("node_type"), F.lit(" "), F.col("label"), F.lit(" ("), facts, F.lit("), requirements: "), F.coalesce("n", F.lit(0)).cast("string"))
    return j.groupBy("change_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", line.alias("l")))), lambda x: x.l), "\n").alias("text"))


def candidate_lines(ranked: DataFrame, most: int = 10) -> DataFrame:
    """(change_id, text): ranked test cases with score and reason."""
    line = F.concat(F.lit("- "), F.col("test_case_id"), F.lit(" ("), F.format_number("final_score", 2), F.lit("): "), F.coalesce("title", F.lit("")), F.lit(" — "), F.col("reason"))
    r = ranked.filter(F.col("rank") <= most)
    return r.groupBy("change_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda x: x.l), "\n").alias("text"))


def case_bodies(changes: DataFrame, cases: DataFrame, hits: DataFrame, most: int = 25, least: float = 0.40, cap: int = 3000) -> DataFrame:
    """(change_id, tc_id, rank, body): test cases of the change's cluster first, by id, then hits from ``least`` on, by
    score; ``most`` in all, bodies cut to ``cap``."""
    own = changes.join(cases.withColumnRenamed("cluster", "of"), F.lower("cluster") == F.lower("of")).select("change_id", "tc_id", F.lit(0).alias("tier"), F.lit(0.0).alias("score"))
    far = hits.filter(F.col("score") >= least).select("change_id", "tc_id", F.lit(1).alias("tier"), "score")
    every = own.unionByName(far).groupBy("change_id", "tc_id").agg(F.min("tier").alias("tier"), F.max("score").alias("score"))
    w = Window.partitionBy("change_id").orderBy("tier", F.desc("score"), "tc_id")
    top = every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
    return top.join(cases.select("tc_id", "body"), "tc_id").select("change_id", "tc_id", "rank", F.left("body", F.lit(cap)).alias("body"))


def existing_ids(changes: DataFrame, cases: DataFrame) -> DataFrame:
    """(change_id, text): ids of test cases whose cluster's name holds the change's or is held by it, in any case; each
    different name meets others once, by its grams."""
    names = cases.select(F.col("cluster").alias("of"), F.lower("cluster").alias("b")).distinct().filter("of != ''")
    want = changes.select("cluster", F.lower("cluster").alias("a")).distinct().filter("cluster != ''")
    pairs = either_way(want.select("a"), names.select("b")).join(want, "a").join(names, "b").select("cluster", "of")
    ids = cases.groupBy(F.col("cluster").alias("of")).agg(F.array_sort(F.collect_set("tc_id")).alias("ids"))
    j = changes.select("change_id", "cluster").join(pairs, "cluster").join(ids, "of")
    return j.groupBy("change_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), ", ").alias("text"))


def routed(df: DataFrame, breadcrumb: Column, routes: list[tuple[str, str]], name: str = "summary") -> DataFrame:
    """Add the summary of the first route (prefix, summary) that a breadcrumb begins with, letters and digits compared."""
    plain = F.regexp_replace(F.lower(breadcrumb), "[^a-z0-9]", "")
    out = F.lit(None).cast("string")
    for prefix, summary in reversed(routes):
        key = "".join(c for c in prefix.lower() if c.isalnum())
        out = F.when(plain.startswith(key), summary).otherwise(out)
    return df.withColumn(name, out)


def assembled(parts: dict[str, Column], shrink: str, budget: int = 60_000) -> Column:
    """The sections that aren't empty under their titles; over the budget the section ``shrink`` gives way first, then the
    end is cut."""
    block = lambda k, v: F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"## {k}\n"), v))
    whole = lambda p: F.array_join(F.filter(F.array(*[block(k, v) for k, v in p.items()]), lambda x: x.isNotNull()), "\n\n")
    text = whole(parts)
    over = F.greatest(F.length(text) - budget, F.lit(0))
    own = F.coalesce(parts[shrink], F.lit(""))
    less = parts | {shrink: F.left(own, F.greatest(F.length(own) - over, F.lit(0)))}
    return F.left(F.when(over > 0, whole(less)).otherwise(text), F.lit(budget))


def consolidated(sections: DataFrame, prefixes: DataFrame, budget: int = 20_000) -> DataFrame:
    """(label, text, n, chars): the sections under each prefix (label, prefix), in order, as one text within a budget."""
    parts = F.split("section_path", " > ")
    above = sections.select("section_id", "section_path", "full_text", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), " > "))).alias("prefix"))
    hit = above.join(prefixes, "prefix").select("label", "section_path", "section_id", "full_text").distinct()
    from .batching import within_budget

    kept = within_budget(hit, "label", ["section_path", "section_id"], "full_text", budget)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_path", "section_id", "full_text"))), lambda x: x.full_text), "\n\n")
    return kept.groupBy("label").agg(text.alias("text"), F.count("*").alias("n"), F.sum(F.length("full_text")).alias("chars"))


def per_page(summary_chars: int, budget: int = 60_000, overhead: int = 3000, each: int = 250, least: int = 10) -> int:
    """How many items a prompt's page holds beside its summary."""
    return max(least, (budget - summary_chars - overhead) // each)


