"""Running sums and numbers within groups by ranges, so that no task holds a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def before(df: DataFrame, group: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Add for each name in ``values`` the sum of its column over the rows of the same group that come before in ``order``.

    Rows are dealt to ranges of group and order, as many as a shuffle has partitions, and written; sums of whole ranges, a
    row for each range and group, give each range its start, and within a range a window adds the rest.  A task's share
    doesn't depend on the size of a group.  Rows alike in group and order are in one range, in any order.  Null values count
    0; null groups are a group; nulls come first.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumns({f"_v{i}": F.coalesce(v.cast("long"), F.lit(0).cast("long")) for i, v in enumerate(values.values())})
    ranged = cut(ranged.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()))
    own = [f"_v{i}" for i in range(len(values))]
    sums = ranged.groupBy(*group, "_range").agg(*[F.sum(v).alias(v) for v in own])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"), *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_h{v}") for v in own])
    within = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumns({f"_i{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in own})
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)], F.col("_range") == F.col("_r"))
    out = inner.join(heads, same)
    return out.select(*df.columns, *[(F.col(f"_i{v}") + F.col(f"_h{v}")).alias(name) for v, name in zip(own, values, strict=True)])


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "number") -> DataFrame:
    """Rows of each group numbered from 0 in order."""
    return before(df, group, order, {name: F.lit(1)})
