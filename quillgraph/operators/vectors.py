"""Exact vector retrieval by inner product, a whole batch of queries in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as C
from . import trigrams

#: Rows of a block of vectors and of queries at most, bytes of a block's vectors, and bytes of a matrix of scores, of which
#: some copies are made.
ROWS, QUERIES, BYTES, SCORES = 8192, 2048, 64 << 20, 8 << 20
#: Blocks whose best lists are merged at a time.
MERGE = 64


def inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda n, x: n + x)


def normalised(v: Column) -> Column:
    size = F.sqrt(inner(v, v))
    return F.when(size > 0, F.transform(v, lambda x: x.cast("double") / size)).otherwise(F.transform(v, lambda x: x.cast("double")))


def fine(vector: Column) -> Column:
    """Whether a vector is there and holds no null and no component that isn't finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _best(k: int, digits: int, id_type: pa.DataType, q_type: pa.DataType):
    def matrix(t: pa.Table, name: str) -> np.ndarray:
        flat = t.column(name).combine_chunks().flatten().to_numpy(False)
        return flat.reshape(t.num_rows, len(flat) // t.num_rows)

    def allowed(queries: pa.Table, rows: pa.Table) -> np.ndarray | None:
        """Which rows of the block each query may have, by their labels; None where no query has a filter."""
        wanted = queries.column("allow").to_pylist()
        if all(w is None for w in wanted):
            return None
        code = {x: i for i, x in enumerate(rows.column("label").unique().to_pylist())}
        labels = np.array([code[x] for x in rows.column("label").to_pylist()])
        table = np.array([[w is None or x in w for x in code] for w in (w if w is None else set(w) for w in wanted)])
        return table[:, labels]

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score", "s"]
        if not queries.num_rows or not rows.num_rows:
            return pa.table([pa.array([], x) for x in (q_type, id_type, pa.float64(), pa.int32())], names)
        rows = rows.sort_by("vec_id")  # so that equals come by id
        ids, v, s = rows.column("vec_id"), matrix(rows, "v"), rows.column("s")[0].as_py()
        step, out = max(1, SCORES // (8 * rows.num_rows)), []
        for low in range(0, queries.num_rows, step):
            part = queries.slice(low, step)
            score = np.round(matrix(part, "q") @ v.T, digits) + 0.0
            may = allowed(part, rows)
            if may is not None:
                score = np.where(may, score, -np.inf)
            n = min(k, rows.num_rows)
            floor = np.partition(score, rows.num_rows - n, axis=1)[:, rows.num_rows - n]
            i, j = np.nonzero((score >= floor[:, None]) & (score > -np.inf))
            order = np.lexsort((j, -score[i, j], i))
            i, j = i[order], j[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < k
            i, j = i[keep], j[keep]
            out.append(pa.table([part.column("query_id").take(pa.array(i)), ids.take(pa.array(j)), pa.array(score[i, j]), pa.array(np.full(len(i), s, np.int32))], names))
        return pa.concat_tables(out)

    return run


def top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query's partial lists (query_id, vec_id, score), with their rank."""
    order = [F.desc("score"), F.asc("vec_id")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, threshold: float | None = None, digits: int = 6) -> DataFrame:
    """(query_id, vec_id, score, rank) from (query_id, q) and (vec_id, v): k best each, ties to the smaller id; the
    threshold applies after ranking, as ranks are those before it.

    A filter applies before ranking, so that k are found where there are as many: with ``allow`` in ``queries``, an array of
    labels, a query's candidates are the vectors whose ``label`` is among them; null: all.

    Both sides are dealt to blocks by a hash, each block pair gives k rows a query, and these are merged; no task holds
    more than two blocks of BYTES each and a few times SCORES.  Null vectors, those with a null component or one that isn't
    finite, and vectors of another length than the query's take no part.
    """
    allow = F.col("allow").cast("array<string>") if "allow" in queries.columns else F.lit(None).cast("array<string>")
    label = F.coalesce(F.col("label").cast("string"), F.lit("")) if "label" in vectors.columns and "allow" in queries.columns else F.lit("")
    q = queries.filter(fine(F.col("q"))).select("query_id", F.col("q").cast("array<double>").alias("q"), F.size("q").alias("qn"), allow.alias("allow"))
    v = vectors.filter(fine(F.col("v"))).select("vec_id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("n"), label.alias("label"))
    n_rows, width = v.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    most = max(1, BYTES // (8 * max(1, width)))
    spread, turns = max(1, -(-n_rows // min(ROWS, most))), max(1, -(-q.count() // min(QUERIES, most)))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    q = q.withColumns({"qt": part("query_id", turns), "qs": F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))})
    v = v.withColumns({"s": part("vec_id", spread), "t": F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))})
    found = q.groupBy("qn", "qt", "qs").cogroup(v.groupBy("n", "t", "s")).applyInArrow(_best(k, digits, *_types(q, v)), _shape(q, v))
    order = [F.desc("score"), F.asc("vec_id")]
    while spread > 1:
        spread = -(-spread // MERGE)
        found = found.withColumn("s", F.floor(F.col("s") / MERGE).cast("int"))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "s").orderBy(*order))).filter(F.col("rank") <= k).drop("rank")
    ranked = top(found, k).drop("s")
    return ranked.filter(F.col("score") >= threshold) if threshold is not None else ranked


def _types(q: DataFrame, v: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(df.schema[c].dataType) for df, c in ((v, "vec_id"), (q, "query_id"))]


def _shape(q: DataFrame, v: DataFrame) -> str:
    return f"query_id {q.schema['query_id'].dataType.simpleString()}, vec_id {v.schema['vec_id'].dataType.simpleString()}, score double, s int"


def with_filter(queries: DataFrame, vectors: DataFrame, chapters: dict[str, tuple[str, ...]] = C.CHAPTER_WORDS) -> DataFrame:
    """``queries`` (query_id, q, cluster) with ``allow``: the labels of ``vectors`` that a query's cluster admits.

    A label fits if it holds the cluster's name or is held by it, in any case; a name that stands for a protocol chapter is
    replaced by the chapter's words.  No cluster, null or empty: no filter.  Names meet labels by their grams, each
    different one once.
    """
    pairs = [x for k, words in chapters.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in words]))]
    low = F.lower("cluster")
    needs = queries.select("cluster").filter("cluster != ''").distinct().select("cluster", F.explode(F.coalesce(F.try_element_at(F.create_map(*pairs), low), F.array(low))).alias("a"))
    labels = vectors.select("label").filter("label != ''").distinct().withColumn("b", F.lower("label"))
    fits = trigrams.either_way(needs.select("a"), labels.select("b")).join(needs, "a").join(labels, "b")
    lists = fits.groupBy("cluster").agg(F.collect_set("label").alias("_fits"))
    none = F.array().cast("array<string>")
    return queries.join(lists, "cluster", "left").withColumn("allow", F.when(F.coalesce("cluster", F.lit("")) != "", F.coalesce("_fits", none))).drop("_fits")


def merged(hits: DataFrame, by: list[str]) -> DataFrame:
    """Hits of several queries: the best of each key."""
    return hits.groupBy(*by).agg(F.max("score").alias("score"))
