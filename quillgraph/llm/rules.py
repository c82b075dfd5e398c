"""Quality rules as a ledger of bits: DataFrame and SQL functions only.

Every rule is evaluated once for a document and leaves a bit (set: failed) and the measurements it used.  A policy is a
named mask of rules; verdicts and ablations come from the stored bits, without the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE

#: Rules in the order of their bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)",
    "no_letters": "5 * n_plain < 2 * n_words",
}
BASE = ("few_words", "repeated_words")
#: Versions of the policy; the last is the one in use.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": (*BASE, "symbols", "duplicate_lines", "word_length", "no_letters"),
}
CURRENT = "v3"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_plain")
_TRIM = " \t\n\x0b\x0c\r"


def mask(policy: str | tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def measured(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add MEASURES of the column ``text``, which holds no null.

    Words repeat where a window of ``window`` words occurs twice or more: windows are hashed, and only a text with equal
    hashes sorts them with their places.
    """
    t = F.col(text)
    plain = F.btrim(t, F.lit(_TRIM))
    df = df.withColumn("_w", F.when(F.length(plain) == 0, F.array().cast("array<string>")).otherwise(F.split(plain, SPACE + "+")))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("_l", F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(_TRIM))) > 0))
    df = df.withColumns(
        {
            "word_chars": (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_plain": F.regexp_count(t, F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long"),
        }
    ).drop("_l")
    hashed = f"case when n_words >= {window} then transform(sequence(1, cast(n_words as int) - {window - 1}), i -> xxhash64(slice(_w, i, {window}))) else cast(array() as array<bigint>) end"
    df = df.withColumn("_h", F.expr(hashed)).drop("_w")
    df = df.withColumn("_s", F.expr("case when size(_h) > size(array_distinct(_h)) then sort_array(transform(_h, (h, i) -> struct(h, i))) end")).drop("_h")
    # neighbours alike in the sorted windows give the places of windows met twice
    twice = "zip_with(slice(_s, 1, size(_s) - 1), slice(_s, 2, size(_s) - 1), (a, b) -> if(a.h = b.h, array(a.i, b.i), cast(array() as array<int>)))"
    df = df.withColumn("_p", F.expr(f"case when _s is not null then sort_array(array_distinct(flatten({twice}))) end")).drop("_s")
    covered = f"aggregate(zip_with(_p, slice(_p, 2, size(_p)), (a, b) -> least({window}, coalesce(b - a, {window}))), 0L, (n, x) -> n + x)"
    return df.withColumn("n_repeat_words", F.expr(f"case when _p is null then 0L else {covered} end")).drop("_p")


def bits() -> Column:
    """The failure bits from MEASURES."""
    return sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())), F.lit(0)).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, MEASURES, failed): each input row as a struct, its measurements and its failure bits.

    A null text has no words.  Ids are only carried along: null and repeated ones keep a row each.  Other columns, clashing
    names too, are in ``row``.  Empty input gives no rows.
    """
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = measured(base).drop("text")
    return out.withColumn("failed", bits()).select("row", *MEASURES, "failed")


def verdict(policy: str | tuple[str, ...] = CURRENT, failed: str = "failed") -> Column:
    """Whether a policy keeps a ledger's row."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def kept_by(entries: DataFrame, policy: str | tuple[str, ...] = CURRENT) -> DataFrame:
    """A ledger's rows that a policy keeps.

    The bits pass a generator, through which no filter moves: beneath it, a verdict would spell out every measurement
    wherever its expressions name it, and texts would be split hundreds of times.
    """
    return entries.withColumn("failed", F.explode(F.array("failed"))).filter(verdict(policy))


def ablations(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only, overlaps): for each rule of a policy, the documents that fail it, those that fail no other
    of the policy (dropping the rule would keep them), and the bits of other rules that fail together with it.

    Documents are first counted by their bits, of which there are at most 2**rules; the rest is bitwise aggregation.
    """
    m = mask(policy)
    sets = entries.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    names = [r for r in RULES if r in POLICIES[policy]]
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in names]))
    each = sets.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.coalesce(F.bit_or(F.when(hit, F.col("bits").bitwiseXOR(F.col("bit")))), F.lit(0)).alias("overlaps"),
    )


def op10(docs: DataFrame) -> DataFrame:
    """The contract's columns of the ledger under the current policy."""
    base = ~verdict(BASE)
    return ledger(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), verdict().alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy keeps."""
    return kept_by(ledger(docs)).select("row.*")
