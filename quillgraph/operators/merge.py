"""Proposed test cases that overlap, merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .lineage import cut
from .ranges import numbered


def spread(many: DataFrame, one: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, which has a row for each key, by a merge in shuffled partitions.

    Never by broadcast: a Parquet table's size on disk says little of the memory that its rows take in the driver.  A
    partition that a frequent key makes large is split by adaptive execution.
    """
    return many.join(one.hint("merge"), on, how)


def overlap_groups(proposals: DataFrame, scopes: DataFrame) -> DataFrame:
    """(key, survivor, n_scopes): the proposal that each proposal is merged into, itself where it overlaps with none before it.

    ``proposals``: key (unique), family, prefer.  ``scopes``: key, entity, step, a row for each step that a proposal does on an
    entity.  Two proposals of a family overlap where both do the same step on the same entity; what overlaps, over any number
    of others, is one group.  Of a group the proposal with the smallest ``prefer`` survives (nulls last), of these the one with
    most different scopes, of these the smallest key.  Scopes with a null part, or of keys that are no proposals, don't count;
    null families are one family.  Links go through each scope's smallest key, so no pairs of proposals are built.
    """
    held = scopes.select("key", "entity", "step").dropna().distinct()
    held = cut(spread(held, proposals.select("key", "family"), ["key"]))
    shared = held.groupBy("family", "entity", "step").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    shared = shared.withColumn("family", F.struct("family"))
    links = spread(held.withColumn("family", F.struct("family")), shared.drop("high"), ["family", "entity", "step"])
    edges = links.filter("key <> low").select(F.col("key").alias("src"), F.col("low").alias("dst")).distinct()
    group = components(proposals.select(F.col("key").alias("node_id")), edges).toDF("key", "comp")
    sizes = held.groupBy("key").agg(F.count("*").alias("n_scopes"))
    of = proposals.select("key", "prefer").join(group.hint("merge"), "key").join(sizes.hint("merge"), "key", "left").fillna(0, ["n_scopes"])
    of = cut(of)
    best = of.groupBy("comp").agg(F.min_by("key", F.struct(F.col("prefer").isNull(), "prefer", -F.col("n_scopes"), "key")).alias("survivor"))
    return spread(of, best, ["comp"]).select("key", "survivor", "n_scopes")


def merged_scopes(groups: DataFrame, scopes: DataFrame) -> DataFrame:
    """(survivor, at, entity, step, key): what a survivor does after the merge, each scope once, numbered from 0.

    ``scopes`` has ``at`` too, a scope's place in its proposal.  The survivor's own come first, then those that others of its
    group, by key, add; ``key`` says whose it is.  A row for each scope, numbered by ranges: no task holds a group.
    """
    own = scopes.dropna(subset=["key", "entity", "step"]).groupBy("key", "entity", "step").agg(F.min("at").alias("at"))
    rows = spread(own, groups.select("key", "survivor"), ["key"])
    first = rows.groupBy("survivor", "entity", "step").agg(F.min(F.struct((F.col("key") != F.col("survivor")).alias("other"), "key", "at")).alias("first"))
    first = first.select("survivor", "entity", "step", "first.*").withColumnRenamed("at", "_place")
    return numbered(first, ["survivor"], ["other", "key", "_place", "entity", "step"], "at").select("survivor", "at", "entity", "step", "key")
