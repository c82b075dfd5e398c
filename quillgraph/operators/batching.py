"""Sequential operators: renumbering, packing under a budget, paging and filling."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import before, numbered


def renumbered(new: DataFrame, existing: DataFrame, group: list[str], order: list[str], number: str) -> DataFrame:
    """New items numbered on from the group's highest existing number."""
    top = existing.groupBy(*group).agg(F.max(number).alias("_top"))
    out = numbered(new, group, order, "_at").join(top, group, "left")
    return out.withColumn(number, (F.coalesce("_top", F.lit(0)) + F.col("_at") + 1).cast("int")).drop("_top", "_at")


def packed(df: DataFrame, group: str, order: list[str], size: str, budget: int, key: str) -> DataFrame:
    """(group, key, bin): greedy bins in each group, in order.  A bin closes when the next item would take it over the
    budget; an item over the budget has a bin of its own.  Null sizes are 0.

    A bin depends on all before it, so a group is one sorted run in one task, which keeps only the open bin's size.
    """
    dealt = df.select(F.col(group).alias("g"), F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    dealt = dealt.repartition("g").sortWithinPartitions("g", *[f"o{i}" for i in range(len(order))]).select("g", "k", "size")

    def run(batches):
        now, used, bin_ = object(), 0, 0
        for b in batches:
            out = []
            for g, n in zip(b.column("g").to_pylist(), b.column("size").to_pylist(), strict=True):
                if g != now:
                    now, used, bin_ = g, n, 0
                elif used + n > budget:
                    used, bin_ = n, bin_ + 1
                else:
                    used += n
                out.append(bin_)
            yield pa.RecordBatch.from_arrays([b.column("g"), b.column("k"), pa.array(out, pa.int32())], ["g", "k", "bin"])

    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    return dealt.mapInArrow(run, f"g {types['g']}, k {types['k']}, bin int").select(F.col("g").alias(group), F.col("k").alias(key), "bin")


def paged(df: DataFrame, group: list[str], order: list[str], per_page: int) -> DataFrame:
    return numbered(df, group, order, "page").withColumn("page", F.floor(F.col("page") / per_page))


def last_turns(df: DataFrame, group: str, turn: str, n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.desc(turn))
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def round_robin(df: DataFrame, group: str, order: list[str], each: int, total: int) -> DataFrame:
    """Up to ``each`` of a group, taken in turns over groups, ``total`` in all."""
    w = Window.partitionBy(group).orderBy(*order)
    first = df.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= each)
    return first.orderBy("turn", group).limit(total)


def relevant_first(df: DataFrame, group: str, order: list[str], relevant: str, each: int = 10, total: int = 50) -> DataFrame:
    """Relevant groups (a boolean column) one after another, up to ``each`` of a group, then the others, ``total`` in all."""
    w = Window.partitionBy(group).orderBy(*order)
    first = df.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= each)
    return first.orderBy(F.desc(relevant), group, "turn").limit(total)


def global_numbers(df: DataFrame, prefix: str, order: list[str], name: str = "number") -> DataFrame:
    """Items of each prefix numbered from 0 in document order."""
    return numbered(df, [prefix], order, name).withColumn(name, F.col(name).cast("int"))


def modal(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """(group, value): the commonest value of each group, of equals the one met first."""
    n = df.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    return n.groupBy(group).agg(F.min_by(value, F.struct(-F.col("n"), "at")).alias(value))


def suppressed(df: DataFrame, doc: str, order: str, path: str, pattern: str) -> DataFrame:
    """Sections without those whose path matches ``pattern`` and all below them: a path that goes on from one."""
    hit = df.filter(F.col(path).rlike(pattern)).select(F.col(doc).alias("_d"), F.col(path).alias("_p")).distinct()
    parts = F.split(path, " > ")
    above = df.select(doc, path, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), " > "))).alias("_p"))
    gone = above.join(hit, (F.col(doc) == F.col("_d")) & (above["_p"] == hit["_p"])).select(doc, path).distinct()
    return df.join(gone, [doc, path], "left_anti")


def within_budget(df: DataFrame, group: str, order: list[str], text: str, budget: int, least: int = 200) -> DataFrame:
    """Texts in order up to a budget of characters; the last one is cut, and left out with ``least`` left or less."""
    df = before(df, [group], order, {"_left": F.length(text)}).withColumn("_left", F.lit(budget) - F.col("_left"))
    fits = F.length(text) <= F.col("_left")
    return df.filter(fits | (F.col("_left") > least)).withColumn(text, F.when(fits, F.col(text)).otherwise(F.expr(f"left({text}, cast(_left as int))"))).drop("_left")
