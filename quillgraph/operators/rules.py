"""Parameterised requirement rules: signals, scores, the winner with its confidence, and ordered rejection reasons."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import keywords, sentences


@dataclass(frozen=True)
class RuleCatalog:
    """``signals``: name to pattern.  ``types``: type to its signal and weight, in the order that settles ties.
    ``boosts``: (signals that must all hold, type, amount).  ``reject``: reason to a condition on the column ``text``."""

    signals: dict[str, str]
    types: dict[str, tuple[str, float]]
    boosts: tuple[tuple[tuple[str, ...], str, float], ...] = ()
    baseline: tuple[str, float] = ("general", 1.0)
    certain: float = 0.70
    reject: dict[str, str] = field(default_factory=dict)

    def flags(self, text: Column) -> dict[str, Column]:
        return {name: text.rlike(p) for name, p in self.signals.items()}

    def scores(self, text: Column, flags: dict[str, Column] | None = None) -> dict[str, Column]:
        flags = flags or self.flags(text)
        out = {}
        for kind, (signal, weight) in self.types.items():
            score = F.when(flags[signal], weight).otherwise(0.0)
            for needs, own, amount in self.boosts:
                if own == kind:
                    every = flags[needs[0]]
                    for n in needs[1:]:
                        every = every & flags[n]
                    score = score + F.when(every, amount).otherwise(0.0)
            out[kind] = score
        out[self.baseline[0]] = F.lit(self.baseline[1])
        return out


#: The specification domain.
DOMAIN = RuleCatalog(signals=V.SIGNALS, types=V.TYPES, boosts=V.BOOSTS, baseline=V.BASELINE, certain=V.CERTAIN)

#: A catalogue whose patterns use ASCII classes only and occur in the test tables.
GENERIC = RuleCatalog(
    signals={"of": "(^|[^a-z])of([^a-z]|$)", "and": "(^|[^a-z])and([^a-z]|$)", "der": "(^|[^a-z])der([^a-z]|$)", "digit": "[0-9]", "comma": ",", "mail": "@"},
    types={"timing": ("digit", 4.0), "state": ("of", 3.5), "definition": ("and", 3.5), "conditional": ("der", 3.0), "cross": ("comma", 2.0)},
    boosts=((("digit", "comma"), "timing", 0.5), (("digit", "of"), "timing", 1.0), (("mail",), "state", 1.0), (("and", "comma"), "definition", 0.5)),
    reject={"too_short": "length(text) < 30", "table_fragment": "text like '%|%'", "numeric_row": "text rlike '^[0-9]'", "lowercase_fragment": "text rlike '^[a-z]'", "open_end": "not text rlike '[.!?]$'"},
)


def classify(df: DataFrame, text: str, rules: RuleCatalog) -> DataFrame:
    """Add type, confidence, ambiguous, and n_alternatives (other types scoring over 1)."""
    scores = rules.scores(F.col(text))
    names = list(scores)
    df = df.withColumns({f"_s_{k}": v for k, v in scores.items()})
    ranked = F.sort_array(F.array(*[F.struct(F.col(f"_s_{k}").alias("score"), F.lit(-i).alias("prio"), F.lit(k).alias("kind")) for i, k in enumerate(names)]), asc=False)
    df = df.withColumn("_r", ranked).drop(*[f"_s_{k}" for k in names])
    top, second = F.col("_r")[0], F.col("_r")[1]
    total = F.aggregate("_r", F.lit(0.0), lambda n, x: n + x.score)
    return df.withColumns(
        {
            "requirement_type": top.kind,
            "score": top.score,
            "confidence": F.round(F.greatest(F.lit(0.3), F.least(F.lit(1.0), top.score / total)), 3),
            "ambiguous": top.score / (top.score + second.score) < rules.certain,
            "n_alternatives": F.size(F.filter("_r", lambda x: x.score > 1.0)) - F.when(top.score > 1.0, 1).otherwise(0),
        }
    ).drop("_r")


def verdict(rules: RuleCatalog) -> Column:
    """The first reason to reject the column ``text``, or 'valid'."""
    out = F.lit("valid")
    for reason, condition in reversed(rules.reject.items()):
        out = F.when(F.expr(condition), reason).otherwise(out)
    return out


def intents(text: Column, patterns: dict[str, str]) -> Column:
    """The names of the patterns that match, in order."""
    return F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in patterns.items()]), lambda x: x.isNotNull())


def clauses(text: Column, opener: str) -> Column:
    """What follows ``opener`` up to a comma or sentence end, each time."""
    return F.regexp_extract_all(text, F.lit(f"(^|[^A-Za-z]){opener} ([^,.!?\n]+)"), F.lit(2))


def clause_texts(text: Column) -> dict[str, Column]:
    """Conditions, effects and constraints of a requirement, trimmed."""
    found = {"conditions": V.CONDITION_CLAUSE, "effects": V.EFFECT_CLAUSE, "constraints": V.CONSTRAINT_CLAUSE}
    return {k: F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), lambda x: F.trim(x)) for k, p in found.items()}


def test_intents(text: Column) -> Column:
    return intents(text, V.INTENTS)


def behaviours(text: Column) -> Column:
    """Nodes of the behaviours that a text names."""
    return F.transform(intents(text, V.BEHAVIOURS), lambda n: F.concat(F.lit("BEHAVIOR::"), n))


def anchors(text: Column) -> Column:
    """Protocol anchors that a text names."""
    return intents(text, V.ANCHORS)


def candidates(df: DataFrame, text: str) -> DataFrame:
    """A row for each sentence with a normative trigger: (other columns, pos, sentence)."""
    each = df.select("*", F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))
    return each.filter(F.col("sentence").rlike(V.NORMATIVE))


def filtered(df: DataFrame, sentence: str = "sentence", section: str | None = None) -> DataFrame:
    """Add ``verdict``, 'valid' or the first of nine reasons to reject, and ``requirement``, the sentence as it is used.

    A short sentence with a modal verb and four words is rescued; one that starts with the modal verb, short or long, is
    completed with the section's title, its number taken off; and of a table row whose last cell is a requirement that
    cell is used.
    """
    s = F.trim(F.col(sentence))
    title = F.trim(F.regexp_replace(F.coalesce(F.col(section), F.lit("")), V.SECTION_NUMBER, "")) if section else F.lit("")
    short = F.length(s) < V.LEAST_LENGTH
    enough = ~s.contains("|") & (F.size(F.split(s, r"\s+")) >= V.LEAST_WORDS)
    modal = s.rlike(V.STARTS_MODAL)
    tail = F.trim(F.substring_index(s, "|", -1))
    row, rescued = s.rlike(V.TABLE_ROW), (F.length(tail) >= V.LEAST_LENGTH) & tail.rlike(V.NORMATIVE_WORD)
    completed = F.concat(title, F.lit(": "), s)
    ladder = [
        (short & s.rlike(V.MODAL) & ~modal & enough, "valid", F.col(sentence)),
        (short & modal & enough & (title != ""), "valid", completed),
        (short, "too_short", s),
        (s.rlike(V.GLOSSARY_ROW), "glossary_row", s),
        (row & rescued, "valid", tail),
        (row, "table_fragment", s),
        (s.rlike(V.CONFORMANCE_CELL), "conformance_table_cell", s),
        (s.rlike(V.NUMERIC_ROW), "numeric_table_row", s),
        (s.rlike(V.STARTS_LOWER), "lowercase_fragment", s),
        (modal & (title != ""), "valid", completed),
        (modal, "modal_fragment_no_subject", s),
        (s.rlike(V.OPEN_END), "incomplete_tail_fragment", s),
        (s.rlike(V.FIELD_DEFINITION), "entity_definition", s),
    ]
    verdict_, used = F.lit("valid"), F.col(sentence)
    for cond, name, text in reversed(ladder):
        verdict_, used = F.when(cond, name).otherwise(verdict_), F.when(cond, text).otherwise(used)
    return df.withColumns({"verdict": verdict_, "requirement": used})


def clusters_of(refs: Column) -> Column:
    """The distinct clusters that entity ids TYPE::cluster::name point to."""
    return F.array_distinct(F.transform(F.filter(refs, lambda r: r.contains("::")), lambda r: F.split_part(r, F.lit("::"), F.lit(2))))


def typed(df: DataFrame, text: str, refs: str | None = None, rules: RuleCatalog = DOMAIN) -> DataFrame:
    """:func:`classify` with ``score_breakdown``, ``signals`` and ``alternatives``; references to two clusters or more are
    a signal of the dependency type too."""
    flags = rules.flags(F.col(text))
    if refs:
        flags["cross_entity_dep"] = flags["cross_entity_dep"] | (F.size(clusters_of(F.col(refs))) >= 2)
    df = df.withColumns({f"_f_{k}": v for k, v in flags.items()})
    scores = rules.scores(F.col(text), {k: F.col(f"_f_{k}") for k in flags})
    df = df.withColumns({f"_s_{k}": v for k, v in scores.items()})
    names = list(scores)
    ranked = F.sort_array(F.array(*[F.struct(F.col(f"_s_{k}").alias("score"), F.lit(-i).alias("prio"), F.lit(k).alias("kind")) for i, k in enumerate(names)]), asc=False)
    df = df.withColumn("_r", ranked)
    top, second = F.col("_r")[0], F.col("_r")[1]
    total = F.aggregate("_r", F.lit(0.0), lambda n, x: n + x.score)
    base = rules.baseline
    others = F.filter(F.slice("_r", 2, len(names)), lambda x: (x.score > base[1]) & (x.kind != base[0]))
    out = df.withColumns(
        {
            "requirement_type": top.kind,
            "confidence": F.greatest(F.lit(V.LEAST_CONFIDENCE), F.least(F.lit(1.0), top.score / F.greatest(total, F.lit(1.0)))),
            "ambiguous": (second.score > 0) & (top.score / (top.score + second.score) < rules.certain),
            "score_breakdown": F.create_map(*[x for k in names for x in (F.lit(k), F.round(F.col(f"_s_{k}"), 3))]),
            "signals": F.filter(F.array(*[F.when(F.col(f"_f_{k}"), F.lit(k)) for k in flags]), lambda x: x.isNotNull()),
            "alternatives": F.transform(others, lambda x: x.kind),
        }
    )
    return out.drop("_r", *[f"_s_{k}" for k in names], *[f"_f_{k}" for k in flags])


def change_requirements(df: DataFrame, text: str, key: str, names: DataFrame | None = None) -> DataFrame:
    """Requirements that a changed text states: (key, pos, sentence, entity_refs, inferred_cluster, requirement_type,
    confidence, ambiguous, signals, alternatives, keywords).

    ``names``: entity_id, name, cluster, as for :func:`entities.matched`; without them only protocol anchors are found.
    The cluster is that of the first entity id with one.
    """
    from .entities import matched

    c = candidates(df.select(key, text), text).drop(text)
    c = c.withColumn("_id", F.struct(key, "pos"))
    found = c.select("_id", F.lit(None).cast("array<struct<entity_id:string,cluster:string>>").alias("own"))
    if names is not None:
        m = matched(c, "_id", "sentence", names)
        found = m.groupBy(F.col("key").alias("_id")).agg(F.array_sort(F.collect_set(F.struct("entity_id", "cluster"))).alias("own"))
    c = c.join(found, "_id", "left")
    own = F.coalesce("own", F.array().cast("array<struct<entity_id:string,cluster:string>>"))
    c = c.withColumn("entity_refs", F.concat(F.transform(own, lambda x: x.entity_id), anchors(F.col("sentence"))))
    c = c.withColumn("inferred_cluster", F.try_element_at(F.transform(F.filter(own, lambda x: x.cluster != ""), lambda x: x.cluster), F.lit(1)))
    c = typed(c, "sentence", "entity_refs").withColumn("keywords", keywords(F.col("sentence"), list(V.KEYWORD_STOP)))
    return c.select(key, "pos", "sentence", "entity_refs", "inferred_cluster", "requirement_type", "confidence", "ambiguous", "signals", "alternatives", "keywords")


def validation_edge(text: Column, name: Column) -> Column:
    """Which property of an attribute a test checks, by the sentences that name it, or by the whole text without any."""
    parts = F.filter(F.split(text, r"\."), lambda s: F.lower(s).contains(F.lower(name)))
    where = F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(text)
    out = F.lit("verifies_attribute")
    for edge, pattern in reversed(V.VALIDATION_EDGES.items()):
        out = F.when(where.rlike(pattern), edge).otherwise(out)
    return out


def gates(text: Column) -> Column:
    """Codes that gate a test, as node ids."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(V.GATE), F.lit(1)), lambda c: F.concat(F.lit("PICS::"), c)))
