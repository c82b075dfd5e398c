"""Audit of how filters interact: Walsh-Hadamard sums of failure masks, inverted to cells, evaluated for every order.

A document's mask has a bit for each filter that it fails.  For each part and label one aggregation keeps, for every set of
filters, the sum of +1 or -1 by the parity of the mask within the set.  These sums tell the number of documents of each
mask exactly, and the cells tell every order of the filters and Shapley values without another look at documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HOT, NULL_ID, SPACE, spread_join, written

#: Conditions of failure in the order of their bits.  The last is judged over the whole table.
FILTERS: dict[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_upper > 2 * n_chars",
    "D": "n_symbols > 0",
    "E": "did > first_did",
}
#: What the sums are weighed with: all documents, and those of a label.
LABELS = ("every", "good", "toxic")
_TRIM = " \t\n\x0b\x0c\r"


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, n_distinct, n_upper, n_chars, n_symbols and the text's digest; ``text`` holds no null."""
    t = F.col(text)
    plain = F.btrim(t, F.lit(_TRIM))
    df = df.withColumn("_w", F.when(F.length(plain) == 0, F.array().cast("array<string>")).otherwise(F.split(plain, SPACE + "+")))
    return df.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "n_distinct": F.size(F.array_distinct("_w")).cast("long"),
            "n_upper": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
            "n_chars": F.length(t).cast("long"),
            "n_symbols": F.when(t.rlike(r"[#$%&*|]"), 1).otherwise(0),
            "digest": F.unhex(F.sha2(t, 256)),
        }
    ).drop("_w")


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask, good, toxic), a row for each input row.

    Null texts count as empty, null parts as ''.  A null id comes before all others, so of documents with one text those
    with the smallest id pass E, all rows of that id alike.  A document is good (toxic) if any of its rows in ``labels``
    has quality (toxic) 1; without a row it is neither, and so are null ids.  Empty input gives no rows.

    Texts are read once; what follows has the digest of a text for it.  Digests and ids that hold more than a thousandth
    of the rows are dealt to many tasks in both joins.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    own = [n for n, c in FILTERS.items() if "first_did" not in c]
    bit = {n: 1 << i for i, n in enumerate(FILTERS)}
    base = measured(base).select("doc_id", "did", "part", "digest", F.expr(" + ".join(f"if({FILTERS[n]}, {bit[n]}, 0)" for n in own)).alias("mask"))
    base = written(base, "filter-masks")
    least = HOT * base.count()
    firsts = base.groupBy("digest").agg(F.min("did").alias("first_did"), F.count("*").alias("n"))
    out = spread_join(base, firsts.drop("n"), ["digest"], firsts.filter(F.col("n") > max(1, least)), ["did", "part"])
    out = out.withColumn("mask", F.col("mask") + F.expr(" + ".join(f"if({FILTERS[n]}, {bit[n]}, 0)" for n in FILTERS if n not in own)))
    flags = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("did"))
    flags = flags.agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    hot = base.groupBy("did").agg(F.count("*").alias("n")).filter(F.col("n") > max(1, least))
    out = spread_join(out.select("doc_id", "did", "part", "mask", "digest"), flags, ["did"], hot, ["digest", "part"], "left")
    return out.select("doc_id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def parity_sums(rows: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """(part, every, good, toxic): for each part and label an array of 2**n sums, one for each set of filters.

    The sum of a set adds 1 for a document that fails an even number of its filters, and -1 for one that fails an odd
    number.  Partial sums are made before the shuffle, so a part may hold most rows.
    """

    def sums(weight: str):
        return F.expr("array(" + ", ".join(f"sum((1 - 2 * (bit_count(mask & {s}) & 1)) * {weight})" for s in range(1 << n)) + ")")

    return rows.groupBy("part").agg(sums("1L").alias("every"), sums("cast(good as long)").alias("good"), sums("cast(toxic as long)").alias("toxic"))


def cells(sums: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """The sums turned back: arrays of the number of documents with each mask, exactly."""
    full = (1 << n) - 1
    back = "transform(sequence(0, {0}), m -> aggregate(sequence(0, {0}), 0L, (x, s) -> x + (1 - 2 * (bit_count(m & s) & 1)) * {1}[s]) div {2})"
    return sums.select("part", *[F.expr(back.format(full, x, 1 << n)).alias(x) for x in LABELS])


def orders(counts: DataFrame, names: str = "".join(FILTERS)) -> DataFrame:
    """A row for each part, order of all filters and step in it, from the counts of :func:`cells`.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).  ``shapley`` is the
    sum over all orders of what the step's filter removes: a document that fails k filters meets each of them first in
    n! / k orders.
    """
    n = len(names)
    full = (1 << n) - 1
    # one row a part up to here; the generators keep the cells from being worked out once for each of their uses
    rows = counts.withColumn("filter_order", F.explode(F.split(F.lit(" ".join("".join(p) for p in permutations(names))), " ")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    rows = rows.withColumn("bit", F.expr(f"shiftleft(1, instr('{names}', substr(filter_order, step, 1)) - 1)"))
    rows = rows.withColumn("before", F.expr(f"aggregate(filter(sequence(1, {n}), i -> i < step), 0, (x, i) -> x | shiftleft(1, instr('{names}', substr(filter_order, i, 1)) - 1))"))

    def total(condition: str, of: str = "every", times: str = "1"):
        return F.expr(f"aggregate(sequence(0, {full}), 0L, (x, m) -> x + if({condition}, {times} * {of}[m], 0L))")

    here = "m & bit != 0 and m & before = 0"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("m & (bit | before) = 0").alias("kept"),
        total(here).alias("removed"),
        total("m & bit != 0 and m & before != 0").alias("redundant"),
        F.expr("every[bit]").alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        total("m & bit != 0", times=f"({factorial(n)}L div bit_count(m))").alias("shapley"),
    )


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's rows: the five filters in all 120 orders, for every source."""
    return orders(cells(parity_sums(masks(docs, labels))))
