"""Inverted lists of vectors: trained centroids, a table partitioned by list, probing with an exact fall-back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors as V
from .lineage import cut

#: Vectors that centroids are learnt from at most, whatever their number; each list is learnt from 39 or more, where there are.
SAMPLE, ROUNDS, SEED = 20_000, 12, 7
LEAST_LISTS, MOST_LISTS, EACH = 4, 256, 40


def n_lists(n: int) -> int:
    """A list for each 40 vectors, 4 at least and 256 at most."""
    return max(LEAST_LISTS, min(MOST_LISTS, n // EACH))


def centroids(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit centroids that each vector has its highest product with one of; empty ones are put on the
    vectors that are worst off."""
    r = np.random.default_rng(SEED)
    c = x[r.permutation(len(x))[:k]]
    for _ in range(rounds):
        product = x @ c.T
        own = product.argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        empty = np.flatnonzero(np.bincount(own, minlength=len(c)) == 0)
        sums[empty] = x[np.argsort(product.max(1), kind="stable")[: len(empty)]]
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


class Lists:
    """An index in a folder: ``vectors`` partitioned by list, and ``centroids``.

    Centroids are learnt from at most ``sample`` vectors, by a hash of their ids; every vector is put into the list whose
    centroid it has the highest product with, the first of equals.  Vectors take part as :func:`vectors.search` has it; all
    of an index have one length, others raise ValueError.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        rows = spark.read.parquet(f"{self.path}/centroids").orderBy("list").collect()  # MOST_LISTS at most
        self.centroids = np.array([r.c for r in rows], np.float64)
        self.vectors = spark.read.schema(f"vec_id {id_type}, v array<double>, list int").parquet(f"{self.path}/vectors")

    @classmethod
    def build(cls, vectors: DataFrame, path: str, sample: int = SAMPLE, lists: int | None = None) -> Lists:
        """From (vec_id, v)."""
        spark = vectors.sparkSession
        v = vectors.filter(V.fine(F.col("v"))).select("vec_id", F.col("v").cast("array<double>").alias("v"))
        n, low, high = v.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
        if low != high:
            raise ValueError(f"vectors of {low} and of {high} components in one index")
        rows = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()  # ``sample`` at most
        x = np.array([r.v for r in rows], np.float64).reshape(len(rows), high or 0)
        size = np.linalg.norm(x, axis=1, keepdims=True)
        c = centroids(x / np.where(size > 0, size, 1), min(lists or n_lists(n), len(x))) if len(x) else x
        nearest = F.pandas_udf(lambda s: pd.Series((np.stack(s.to_numpy()) @ c.T).argmax(1).astype(np.int32)), "int")
        v.withColumn("list", nearest("v") if len(x) else F.lit(0)).repartition("list", F.pmod(F.xxhash64("vec_id"), F.lit(8))).write.partitionBy("list").parquet(f"{path}/vectors")
        spark.createDataFrame([(i, [float(a) for a in row]) for i, row in enumerate(c)], "list int, c array<double>").coalesce(1).write.parquet(f"{path}/centroids")
        return cls(spark, path, v.schema["vec_id"].dataType.simpleString())

    def probed(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query_id, q, list): the ``probes`` lists whose centroids each query has the highest product with."""
        c, n = self.centroids, min(probes, len(self.centroids))
        near = F.pandas_udf(lambda s: pd.Series(list(np.argsort(-(np.stack(s.to_numpy()) @ c.T), axis=1, kind="stable")[:, :n].astype(np.int32))), "array<int>")
        q = queries.filter(V.fine(F.col("q")) & (F.size("q") == c.shape[1])).select("query_id", F.col("q").cast("array<double>").alias("q"))
        return q.withColumn("list", F.explode(near("q")))

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = 8, digits: int = 6) -> DataFrame:
        """(query_id, vec_id, score, rank) as :func:`vectors.search` gives it, from the lists probed.

        ``probes`` None: exact, over all lists.  A query whose lists hold fewer than ``k`` vectors is searched exactly.  Only
        lists that some query probes are read; their numbers, MOST_LISTS at most, come to the driver for that.
        """
        q = queries.select("query_id", "q")
        if not len(self.centroids):
            return V.search(q, self.vectors.select("vec_id", "v"), k, digits=digits)
        if probes is None or probes >= len(self.centroids):
            return V.search(q, self.vectors.select("vec_id", "v"), k, digits=digits)
        asked = cut(self.probed(q, probes))
        read = sorted(r.list for r in asked.select("list").distinct().collect())
        v = self.vectors.filter(F.col("list").isin(*read)) if read else self.vectors.filter("false")
        # a list is one key on both sides; large ones are cut to parts that a list's queries all meet
        sizes = v.groupBy("list").agg(F.ceil(F.count("*") / V.ROWS).cast("int").alias("parts"))
        a = asked.join(sizes, "list").select("query_id", "q", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("s"), F.lit(None).cast("array<string>").alias("allow"))
        a = a.withColumn("turn", F.floor(F.row_number().over(V.Window.partitionBy("list", "s").orderBy("query_id")) / V.QUERIES).cast("int"))
        turns = a.groupBy("list").agg(F.max("turn").alias("turns"))
        b = v.join(sizes, "list").join(turns, "list").select("vec_id", "v", "list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("s"), F.lit("").alias("label"), F.explode(F.sequence(F.lit(0), F.col("turns"))).alias("turn"))
        found = a.groupBy("list", "s", "turn").cogroup(b.groupBy("list", "s", "turn")).applyInArrow(V._best(k, digits, *V._types(a, b)), V._shape(a, b))
        got = cut(V.top(found, k).drop("s"))
        short = q.join(got.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k), "query_id", "left_anti")
        rest = V.search(short, self.vectors.select("vec_id", "v"), k, digits=digits)
        return got.join(short.select("query_id"), "query_id", "left_anti").select("query_id", "vec_id", "score", "rank").unionByName(rest.select("query_id", "vec_id", "score", "rank"))
