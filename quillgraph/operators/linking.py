"""Linking test cases to requirements, clusters, files and directories: equi-joins in tiers, of which the first with a hit counts.

Tables: test_cases (tc_id, title, cluster, purpose, procedure_steps, entity_refs, ...), requirements (req_id, cluster,
section_path, entity_refs, ...), entities (entity_id, entity_type, name, cluster).  Nulls count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import flat_name
from .trigrams import contained

_NONE = "array<string>"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(_NONE))


def _runs(tokens: Column, lengths: list[int]) -> Column:
    """All runs of as many tokens as one of ``lengths``, joined by blanks."""

    def of(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, k), " "))

    return F.flatten(F.array(*[of(k) for k in lengths])) if lengths else F.array().cast(_NONE)


def cluster_key(name: Column) -> Column:
    """A cluster's name for comparison: lower-case, without a closing 'cluster'."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\s*cluster\s*$", ""))


def prefix(tc_id: Column) -> Column:
    """The prefix of TC-PREFIX-1.2 in capitals; empty without one."""
    return F.upper(F.regexp_extract(tc_id, r"(?i)^\[?TC-([A-Z0-9_]+)-\d", 1))


def is_protocol(prefix_: Column, known: Column | None = None) -> Column:
    """Whether a prefix stands for a protocol family: listed ones, and those outside ``known`` where that isn't empty."""
    out = prefix_.isin(*V.PROTOCOL_PREFIXES)
    return out if known is None else out | ((F.size(known) > 0) & ~F.array_contains(known, prefix_))


def _leaf(path: Column) -> Column:
    """Words of a section path's last segment, its number taken off."""
    last = F.substring_index(path, " > ", -1)
    return F.filter(F.split(F.trim(F.lower(F.regexp_replace(last, r"^\d+(?:\.\d+)*\.?\s*", ""))), r"\s+"), lambda w: w != "")


def requirement_index(requirements: DataFrame) -> DataFrame:
    """(kind, word, req_id, cluster_key): by which words a requirement is found: 'entity' for names that it refers to or
    that its section is headed by, 'section' for the words of its section's heading."""
    r = requirements.select("req_id", cluster_key(F.col("cluster")).alias("cluster_key"), _leaf(_text("section_path")).alias("leaf"), _list("entity_refs").alias("refs"))
    names = F.transform(F.filter("refs", lambda x: F.size(F.split(x, "::")) >= 3), lambda x: F.lower(F.split_part(x, F.lit("::"), F.lit(3))))
    section = F.filter("leaf", lambda w: (F.length(w) > 3) & ~w.isin(*V.SECTION_STOP))
    kinds = F.array(*[F.lit(k) for k in V.KIND_WORDS])
    headed = F.filter(
        F.transform("leaf", lambda w, i: F.when((F.length(w) > 3) & ~w.isin(*V.SECTION_STOP, *V.KIND_WORDS) & ((F.size("leaf") == 1) | F.coalesce(F.array_contains(kinds, F.try_element_at("leaf", i + 2)), F.lit(False))), w)),
        lambda w: w.isNotNull(),
    )
    long = F.length(F.array_join("leaf", " ")) > 3
    entity = F.concat(names, F.when(long, headed).otherwise(F.array().cast(_NONE)))
    one = lambda kind, words: r.select(F.lit(kind).alias("kind"), F.explode(F.array_distinct(words)).alias("word"), "req_id", "cluster_key")
    return one("entity", entity).unionByName(one("section", F.when(long, section).otherwise(F.array().cast(_NONE))))


def linked(test_cases: DataFrame, requirements: DataFrame) -> DataFrame:
    """(tc_id, req_id, tier): the requirements of each test case with a cluster, by the first tier with any in its cluster.

    1: names of its references; 1.5, only where tier 1 finds nothing in any cluster: names in its steps and their codes;
    2: words of its texts in section headings; 3: all of the cluster.  Protocol test cases: see :func:`linked_protocol`.
    """
    t = test_cases.select("tc_id", cluster_key(F.col("cluster")).alias("cluster_key"), _text("title").alias("title"), _text("purpose").alias("purpose"), _list("procedure_steps").alias("steps"), _list("entity_refs").alias("refs")).filter("cluster_key != ''")
    index = requirement_index(requirements)
    entity = index.filter("kind = 'entity'").select("word", "req_id", F.col("cluster_key").alias("of"))
    section = index.filter("kind = 'section'").select("word", "req_id", F.col("cluster_key").alias("of"))
    ref_names = F.transform(F.filter("refs", lambda x: F.size(F.split(x, "::")) >= 3), lambda x: F.lower(F.split_part(x, F.lit("::"), F.lit(3))))
    words = lambda df, expr: df.select("tc_id", "cluster_key", F.explode(F.array_distinct(expr)).alias("word"))
    own = words(t, ref_names)
    one = own.join(entity, "word").unionByName(own.join(section, "word")).distinct()
    joined = F.array_join("steps", "\n")
    in_steps = F.transform(F.concat(F.regexp_extract_all(joined, F.lit(V.STEP_NAME), F.lit(1)), F.regexp_extract_all(joined, F.lit(V.CODE_NAME), F.lit(1))), F.lower)
    in_steps = F.filter(in_steps, lambda w: (F.length(w) > 3) & ~w.isin(*V.TEXT_STOP))
    mined = words(t.join(one.select("tc_id").distinct(), "tc_id", "left_anti"), in_steps)
    half = mined.join(entity, "word").unionByName(mined.join(section, "word")).distinct()
    text = F.lower(F.concat_ws(" ", "title", "purpose", F.array_join("steps", " ")))
    spoken = words(t, F.filter(F.regexp_extract_all(text, F.lit("([a-z]{4,})"), F.lit(1)), lambda w: ~w.isin(*V.TEXT_STOP)))
    two = spoken.join(section, "word")
    tag = lambda df, tier: df.filter("of = cluster_key").select("tc_id", "req_id", F.lit(tier).alias("tier"))
    hits = tag(one, 1.0).unionByName(tag(half, 1.5)).unionByName(tag(two, 2.0))
    best = hits.groupBy("tc_id", "req_id").agg(F.min("tier").alias("tier"))
    low = best.groupBy("tc_id").agg(F.min("tier").alias("low"))
    found = best.join(low, "tc_id").filter("tier = low").drop("low")
    rest = t.join(low, "tc_id", "left_anti").select("tc_id", "cluster_key")
    every = requirements.select("req_id", cluster_key(F.col("cluster")).alias("cluster_key"))
    return found.unionByName(rest.join(every, "cluster_key").select("tc_id", "req_id", F.lit(3.0).alias("tier")))


def linked_protocol(test_cases: DataFrame, requirements: DataFrame, section_map: DataFrame | None = None, areas: dict[str, str] = V.AREA_OF_PREFIX) -> DataFrame:
    """(tc_id, req_id, tier) for test cases of protocol families: 1, sections that ``section_map`` (tc_id or title word,
    section) names, as part of a requirement's cleaned path; 2, words of the texts in headings; 3, a chapter that shares
    a word with the family's area.  Only requirements without a cluster count in 1 and 3.

    Title words and sections meet titles and paths by their grams, each different one once.
    """
    pairs = [F.lit(x) for kv in areas.items() for x in (kv[0], kv[1].replace("_", " ").lower())]
    t = test_cases.select("tc_id", _text("title").alias("title"), _text("purpose").alias("purpose"), _list("procedure_steps").alias("steps"), F.try_element_at(F.create_map(*pairs), prefix(F.col("tc_id"))).alias("area"))
    t = t.filter("area is not null")
    path = F.array_join(F.filter(F.transform(F.split(F.lower(_text("section_path")), ">"), lambda s: F.trim(F.regexp_replace(F.trim(s), r"^\d[\d.]*\s*", ""))), lambda s: s != ""), " > ")
    free = requirements.filter((cluster_key(F.col("cluster")) == "") & (_text("section_path") != "")).select("req_id", path.alias("path"))
    hits = None
    if section_map is not None:
        m = section_map.select(F.col("tc_id").alias("m_id"), F.col("word").alias("m_word"), F.lower("section").alias("m_section"))
        by_id = t.join(m, F.col("tc_id") == F.col("m_id")).select("tc_id", "m_section")
        titles, spoken = t.select("tc_id", F.lower("title").alias("text")), m.select(F.lower("m_word").alias("needle"), "m_section")
        by_word = contained(spoken.select("needle"), titles.select("text")).join(titles, "text").join(spoken, "needle").select("tc_id", "m_section")
        sections = by_id.unionByName(by_word).distinct()
        named = contained(m.select(F.col("m_section").alias("needle")), free.select(F.col("path").alias("text"))).select(F.col("needle").alias("m_section"), F.col("text").alias("path"))
        hits = sections.join(named, "m_section").join(free, "path").select("tc_id", "req_id", F.lit(1.0).alias("tier"))
    index = requirement_index(requirements).select("word", "req_id").distinct()
    text = F.lower(F.concat_ws(" ", "title", "purpose", F.array_join("steps", " ")))
    words = t.select("tc_id", F.explode(F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit("([a-z]{4,})"), F.lit(1)), lambda w: ~w.isin(*V.TEXT_STOP)))).alias("word"))
    two = words.join(index, "word").select("tc_id", "req_id", F.lit(2.0).alias("tier"))
    chapter = free.select("req_id", F.explode(F.array_distinct(F.slice(F.split(F.split_part("path", F.lit(" > "), F.lit(1)), r"\s+"), 1, 5))).alias("word"))
    three = t.select("tc_id", F.explode(F.split("area", " ")).alias("word")).join(chapter, "word").select("tc_id", "req_id", F.lit(3.0).alias("tier"))
    hits = two.unionByName(three) if hits is None else hits.unionByName(two).unionByName(three)
    best = hits.groupBy("tc_id", "req_id").agg(F.min("tier").alias("tier"))
    low = best.groupBy("tc_id").agg(F.min("tier").alias("low"))
    return best.join(low, "tc_id").filter("tier = low").drop("low")


def inferred_clusters(test_cases: DataFrame, prefixes: DataFrame, names: DataFrame) -> DataFrame:
    """(tc_id, cluster): by the prefix, else the commonest cluster of the references (the first of equals), else the
    cluster of the first name of four letters or more in the title, by length and name; empty for protocol families.

    ``prefixes``: prefix, cluster.  ``names``: name, cluster.
    """
    t = test_cases.select("tc_id", prefix(F.col("tc_id")).alias("prefix"), F.lower(_text("title")).alias("title"), _list("entity_refs").alias("refs"))
    by_prefix = prefixes.groupBy(F.upper("prefix").alias("prefix")).agg(F.min("cluster").alias("by_prefix"))
    ref = t.select("tc_id", F.posexplode("refs").alias("pos", "ref")).withColumn("c", F.split_part("ref", F.lit("::"), F.lit(2))).filter("c != ''")
    modal = ref.groupBy("tc_id", "c").agg(F.count("*").alias("n"), F.min("pos").alias("pos")).groupBy("tc_id").agg(F.max_by("c", F.struct("n", -F.col("pos"))).alias("by_refs"))
    n = names.filter(F.length("name") >= 4).select(F.lower("name").alias("name"), F.col("cluster").alias("c"), F.size(F.split(F.lower("name"), r"\s+")).alias("k"))
    lengths = [r.k for r in n.select("k").distinct().collect()]  # a few lengths in words
    toks = F.split("title", r"\s+")
    runs = _runs(toks, lengths)
    by_title = t.select("tc_id", F.explode(F.array_distinct(runs)).alias("name")).join(n, "name").groupBy("tc_id").agg(F.min_by("c", F.struct(-F.length("name"), "name")).alias("by_title"))
    out = t.join(by_prefix, "prefix", "left").join(modal, "tc_id", "left").join(by_title, "tc_id", "left")
    return out.select("tc_id", F.when(is_protocol(F.col("prefix")), "").otherwise(F.coalesce("by_prefix", "by_refs", "by_title", F.lit(""))).alias("cluster"))


def section_clusters(sections: DataFrame, clusters: DataFrame) -> DataFrame:
    """(section_id, cluster): the longest cluster name in a section's title, else in its path, by an equi-join on runs of
    words, else the last cluster met before it in the document (doc, position)."""
    names = clusters.select(F.col("name").alias("cluster"), F.array_join(F.filter(F.split(F.lower("name"), "[^a-z0-9]+"), lambda w: w != ""), " ").alias("phrase"))
    names = names.filter("phrase != ''").withColumn("k", F.size(F.split("phrase", " ")))
    lengths = sorted(r.k for r in names.select("k").distinct().collect())  # a few lengths in words

    def best(column: str) -> DataFrame:
        toks = F.filter(F.split(F.lower(_text(column)), "[^a-z0-9]+"), lambda w: w != "")
        runs = _runs(toks, lengths)
        hit = sections.select("section_id", F.explode(F.array_distinct(runs)).alias("phrase")).join(names, "phrase")
        return hit.groupBy("section_id").agg(F.max_by("cluster", F.struct(F.length("phrase"), "cluster")).alias(f"by_{column}"))

    s = sections.join(best("title"), "section_id", "left").join(best("section_path"), "section_id", "left")
    own = F.coalesce("by_title", "by_section_path")
    w = Window.partitionBy("doc").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return s.select("section_id", F.last(own, ignorenulls=True).over(w).alias("cluster"))


def nearest_names(left: DataFrame, right: DataFrame, tiers: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(name, match, tier): for each ``name`` of ``left`` the ``match`` of ``right`` by the first key pair that agrees, the
    shortest match of equals.  The way fuzzy lookups are put: each tier is an equi-join on a normalised key."""
    hits = None
    for n, (a, b) in enumerate(tiers.values(), 1):
        one = left.select("name", a.alias("k")).filter("k != ''").join(right.select("match", b.alias("k")), "k").select("name", "match", F.lit(n).alias("tier"))
        hits = one if hits is None else hits.unionByName(one)
    return hits.groupBy("name").agg(F.min(F.struct("tier", F.length("match").alias("l"), "match")).alias("m")).select("name", "m.match", "m.tier")


def schema_of_cluster(clusters: DataFrame, schemas: DataFrame) -> DataFrame:
    """(name, match, tier): the schema of a cluster: same name, same letters, same without 'cluster', same first word."""
    stem = lambda c: flat_name(F.regexp_replace(F.lower(c), r"\bcluster\b", ""))
    first = lambda c: F.lower(F.regexp_extract(c, r"^\s*(\w+)", 1))
    n, m = F.col("name"), F.col("match")
    return nearest_names(clusters, schemas, {"exact": (n, m), "letters": (flat_name(n), flat_name(m)), "stem": (stem(n), stem(m)), "first": (first(n), first(m))})


def file_of_case(test_cases: DataFrame, ids: DataFrame, prefixes: DataFrame, stems: DataFrame) -> DataFrame:
    """(tc_id, path, tier): by id, by prefix, by the letters of the title; null without any.  Each table has a key and a
    path; of several paths the first in ``seq`` counts."""
    first = lambda df, name: df.groupBy("key").agg(F.min_by("path", "seq").alias(name))
    t = test_cases.select("tc_id", F.upper("tc_id").alias("k1"), prefix(F.col("tc_id")).alias("k2"), flat_name(_text("title")).alias("k3"))
    out = t
    for n, df in enumerate((ids, prefixes, stems), 1):
        out = out.join(first(df, f"p{n}").withColumnRenamed("key", f"k{n}"), f"k{n}", "left")
    tier = F.when(F.col("p1").isNotNull(), 1).when(F.col("p2").isNotNull(), 2).when(F.col("p3").isNotNull(), 3)
    return out.select("tc_id", F.coalesce("p1", "p2", "p3").alias("path"), tier.alias("tier"))


def dut_role(title: Column, purpose: Column, tc_id: Column, codes: Column) -> Column:
    """server, client or unknown: by a role that the texts name, by the id's number 3.x, by the sides of the codes."""
    text = F.lower(F.concat_ws(" ", title, purpose))
    sides = lambda s: F.size(F.filter(codes, lambda c: c.rlike(rf"\.{s}(\.|$)")))
    return (
        F.when(text.rlike(r"dut[ _-]?(as[ _-]?)?(a[ _-]?)?(server|s\b)|\bserver as dut\b|\[dut[ _-]?server\]"), "server")
        .when(text.rlike(r"dut[ _-]?(as[ _-]?)?(a[ _-]?)?(client|c\b)|\bclient as dut\b|\[dut[ _-]?client\]"), "client")
        .when(tc_id.rlike(r"(?i)^TC-[A-Z0-9]+-3\.\d"), "client")
        .when(sides("S") > sides("C"), "server")
        .when(sides("C") > sides("S"), "client")
        .otherwise("unknown")
    )
