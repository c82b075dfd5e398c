"""Running sums by ranges against loops, with a group that has nearly all rows."""

import random

from pyspark.sql import functions as F

from quillgraph.operators import batching as B
from quillgraph.operators import ranges as R


def test_before(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a"] * 18 + ["b", None]), r.choice([None, 1, 5, 100])) for i in range(2000)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, g string, n long")
    got = {x.id: (x.s, x.k) for x in R.before(df, ["g"], ["id"], {"s": F.col("n"), "k": F.lit(1)}).collect()}
    want, seen = {}, {}
    for i, g, n in sorted(rows):
        s, k = seen.get(g, (0, 0))
        want[i], seen[g] = (s, k), (s + (n or 0), k + 1)
    assert got == want
    assert R.before(df.filter("false"), ["g"], ["id"], {"s": F.col("n")}).isEmpty()


def test_no_task_has_a_hot_group(spark):
    """One source has nearly all rows; its rows are in all ranges."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("source"))
    sizes = [r["count"] for r in df.repartitionByRange(4, "source", "doc_id").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000
    pages = B.paged(df, ["source"], ["doc_id"], 10).groupBy("source").agg(F.max("page").alias("p"), F.countDistinct("page").alias("n")).collect()
    assert {(x.source, x.p, x.n) for x in pages} == {("a", 1979, 1980), ("b", 19, 20)}
