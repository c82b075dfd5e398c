"""Mixing sources to target weights by weighted fair queueing.

Each source serves its shuffled documents, again from the start once they are through.  A copy of a document finishes at
the virtual time (words its source has served by then) / (the source's target), so sources reach their targets together,
at time 1.  All copies are range-sorted by finish time, running sums over the ranges find where the total budget is
spent, and the queue is cut there.

A copy that its source is serving at time 1, one a source, is queued in packets of PACKET words with finish times of
their own, as long messages are in packet networks; so the cut leaves each source within a packet of its target, however
long its documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WORD, discard, running, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, REPEATS, SEED = 1.5, 2, 17
PACKET = 16
_KEY = ["id", "key", "twin"]


def _targets(sizes: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> tuple[DataFrame, int]:
    """Water filling: a row for each source with its target and the words of the sources before it; and the budget.

    Sources, in the order of limit / weight, reach their limits one after another as the common level rises; the level
    at which the budget is spent follows from running sums.
    """
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    last = F.col("source").isNull()
    s = running(sizes.withColumns({"last": last, "one": F.lit(1)}), ["last", "source"], ["one", "source_size"], n, "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(repeats)))
    s = s.select("last", "source", "source_size", F.col("before_source_size").alias("ahead"), "weight", "limit", (F.col("limit") / F.col("weight")).alias("level"))
    s = running(s, ["level", "last", "source"], ["limit", "weight"], n, "levels")
    every = s.agg(F.sum("weight")).first()[0] or 0.0
    s = s.withColumn("at", (F.lit(total * float(share)) - F.col("before_limit")) / (F.lit(every) - F.col("before_weight")))
    # the first source whose limit lies above the level that the rest would share
    final = s.filter("at <= level").agg(F.min(F.struct("level", "last", "source", "at"))).first()[0]
    target = F.col("limit") if final is None else F.least("limit", F.col("weight") * F.lit(final["at"]))
    # the targets' sum, but for rounding: the budget is shared out unless every source is at its limit
    return written(s.select("source", "source_size", "ahead", target.cast("double").alias("target")), "targets"), int(total * min(share, repeats))


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, key, twin, more): a row for each input row, and key and twin tell rows apart whose ids repeat or are null.

    Rows alike in all that is asked for are counted, not ordered, and numbered by unfolding the count.
    """
    i = F.col(id_col).cast("long")
    repeats = not docs.groupBy(i.alias("i")).count().filter("i is null or count > 1").isEmpty()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(i.alias("id"), (F.xxhash64(text) if repeats else F.lit(0).cast("long")).alias("key"), *more)
    if not repeats:
        return out.withColumn("twin", F.lit(0).cast("long"))
    counted = out.groupBy(*out.columns).agg(F.count("*").alias("n"))
    return counted.withColumn("twin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")


def queue(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", more: tuple[Column, ...] = ()) -> DataFrame:
    """(id, key, twin, source, size, source_size, target, copy, packet, words, finish, taken): the sorted queue, and of
    each of its entries the words before the cut.

    The shuffle is by md5 of seed and id, then by the key.  Null texts and texts without words have size 0 and one entry
    without words.  Each input row is a document, those alike too; the null source comes last in the order of weights.
    Empty input gives no rows.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    thin = written(_keyed(docs, id_col, text_col, F.col(source_col).alias("source"), size.alias("size"), *more), "queue")
    place = F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))), F.lit(15)), 16, 10).cast("long")
    n = thin.count()
    ordered = thin.withColumns({"last": F.col("source").isNull(), "place": place})
    ordered = running(ordered, ["last", "source", "place", *_KEY], ["size"], n, "shuffled").drop("last", "place", "range")
    targets, budget = _targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    side = targets.withColumnRenamed("source", "s")
    q = ordered.join(side, F.col("source").eqNullSafe(F.col("s"))).withColumn("before", F.col("before_size") - F.col("ahead")).drop("s", "ahead", "before_size")
    q = q.withColumn("copy", F.explode(F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(repeats - 1))).otherwise(F.array(F.lit(0)))))
    start = F.col("before") + F.col("copy") * F.col("source_size")
    q = q.withColumn("start", start).drop("before")
    open_ = (F.col("start") < F.col("target")) & (F.col("start") + F.col("size") > F.col("target"))
    cuts = F.when(open_, F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(PACKET).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    q = q.select("*", open_.alias("open"), F.explode(cuts).alias("packet"))
    words = F.when(F.col("open"), F.least(F.lit(PACKET), F.col("size") - F.col("packet"))).otherwise(F.col("size"))
    q = q.withColumn("words", words).drop("open")
    finish = F.when(F.col("target") > 0, (F.col("start") + F.col("packet") + F.col("words")) / F.col("target")).otherwise(0.0)
    q = q.withColumn("finish", finish).drop("start")
    q = running(q, ["finish", *_KEY, "copy", "packet"], ["words"], repeats * n, "finished")
    discard(thin, targets, ordered)
    return q.withColumn("taken", F.greatest(F.lit(0), F.least("words", F.lit(budget) - F.col("before_words")))).drop("before_words", "range")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, copy, words, finish): the mix itself, a row for each copy before the cut (words: those of it that are
    before the cut), range-sorted by finish time.

    Cases are those of :func:`queue`; documents without words are not in it.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # rows that share id and text are told apart by the rest of the row
    mark = F.xxhash64(F.to_json(row)).alias("mark")
    served = queue(docs, weights, share, repeats, seed, id_col, text_col, source_col, (mark,)).filter("taken > 0")
    key = [*_KEY, "mark"]
    served = served.groupBy(*key, "copy").agg(F.sum("taken").alias("words"), F.max("finish").alias("finish"))
    base = _keyed(docs, id_col, text_col, row.alias("row"), mark)
    left = base.select("row", *[F.col(c).alias(f"_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & (F.col(f"_{c}").eqNullSafe(F.col(c)) if c == "id" else F.col(f"_{c}") == F.col(c))
    out = left.join(served, same)
    return out.repartitionByRange("finish", *key, "copy").sortWithinPartitions("finish", *key, "copy").select("row", "copy", "words", "finish")


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns: each document's words before the cut, over all its entries in the queue."""
    out = queue(docs).groupBy(*_KEY, "source", "size", "source_size", "target").agg(F.sum("taken").cast("long").alias("taken"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: a row for each copy; one that the cut goes through keeps its first words only,
    joined by blanks.  Cases are those of :func:`mix`."""
    out = mix(docs)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD))
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), 1, F.col("words").cast("int")), " ")
    out = out.withColumn("mixed", F.when(F.col("words") < size, cut).otherwise(text))
    return out.select(*[F.col("mixed").alias(c) if c == "text" else F.length("mixed").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns])
