"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into 1, 4, 16, ... segments; of each segment its mean and the length of what deviates from the mean are
kept.  From them follows a lower bound of a distance: squared, at least the sum over segments of
size * (mean - mean)^2 + (deviation - deviation)^2.  With both lengths known, a lower bound of the distance is an upper
bound of the inner product, namely the inner product of the statistics.  Candidates are dropped from coarse to fine
where that lies under the k-th best so far; survivors get their exact product in integers.

Queries are a set of rows and meet all rows in blocks: both sides are dealt to keyed blocks of bounded size, each block
pair gives k rows a query, and these are merged.  Vectors travel as they are stored; a block scales them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

SCALE, TOP, EVERY = 256, 5, 50
#: Rows in a block of candidates and of queries at most, and bytes of a block's scaled vectors.
ROWS, QUERIES, BYTES = 8192, 2048, 64 << 20
#: Queries of a block judged together, and pairs whose products are worked out together.
SLICE, PAIRS = 256, 1 << 16
#: Partial lists of a query merged at a time.
MERGE = 64
#: Room for rounding in the bounds, relative to the product of the vectors' lengths.  Means, deviations and the products of
#: the statistics are each off by d roundings of 1e-16 at most, so this holds to lengths of a million.
SLACK = 1e-9
_LIMIT = (1 << 63) - 1


def fine(vector: Column, scale: float = 1.0) -> Column:
    """Whether a vector is there and holds no null and no component that is not finite, as it is and scaled."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * F.lit(float(scale))) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """For each row, each segment's mean and deviation scaled by the root of its size, so that distances add up."""
    parts = np.array_split(x, segments, axis=1)
    root = [np.sqrt(p.shape[1]) for p in parts]
    mean = np.stack([p.mean(1) * r for p, r in zip(parts, root, strict=True)], 1)
    # from the differences: of squares' sums that nearly cancel, the deviation of a nearly constant segment would be lost
    rest = np.stack([np.sqrt(((p - p.mean(1, keepdims=True)) ** 2).sum(1)) for p in parts], 1)
    return np.hstack([mean, rest])


def levels(d: int) -> list[int]:
    """Numbers of segments, coarse to fine; none for vectors without components."""
    out = [1] if d else []
    while out and out[-1] * 4 <= d // 2:
        out.append(out[-1] * 4)
    return out


def _products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        parts = [(q[i[a : a + PAIRS]] * x[j[a : a + PAIRS]]).sum(1) for a in range(0, len(i), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0)
    return np.array([sum(int(a) * int(b) for a, b in zip(q[u].tolist(), x[v].tolist(), strict=True)) for u, v in zip(i, j, strict=True)], object)


def best(q_uid: np.ndarray, q: np.ndarray, uid: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query places, candidate places, scores) of each query's k highest integer products, ties to the smaller id.

    ``q`` and ``x`` hold whole numbers as float64; where their products may pass 2**53, Python integers take over.  A
    candidate with the query's uid is the query itself.
    """
    most = max(float(np.abs(q).max(initial=0)), float(np.abs(x).max(initial=0)))
    exact = most * most * x.shape[1] < 2**53
    # of vectors whose products float64 can't hold, no bound is told
    tables = [(statistics(q, s), statistics(x, s)) for s in levels(x.shape[1])] if most < 1e140 else []
    qn, xn = (np.sqrt((v * v).sum(1)) if tables else np.zeros(len(v)) for v in (q, x))
    found = []
    for low in range(0, len(q), SLICE):
        part = slice(low, low + SLICE)
        room = SLACK * (np.outer(qn[part], xn) + 1)
        live = uid[None, :] != q_uid[part, None]
        if tables:
            # a floor: the k-th best exact product among the candidates that a coarse level puts first
            a, b = tables[min(1, len(tables) - 1)]
            n = min(4 * k + 1, len(x))
            first = np.argpartition(-(a[part] @ b.T), n - 1, axis=1)[:, :n]
            i = np.repeat(np.arange(len(first)), n)
            sample = _products(q[part], x, i, first.ravel(), exact).astype(float).reshape(len(first), n)
            sample[~np.take_along_axis(live, first, 1)] = -np.inf
            floor = -np.sort(-sample, axis=1)[:, k - 1] if n >= k else np.full(len(first), -np.inf)
            own = live
            for a, b in tables:
                live = live & (a[part] @ b.T + room >= floor[:, None])
            # k candidates reach the floor, so fewer can't be left; should a bound fail, it rules nothing out
            lost = live.sum(1) < np.minimum(k, own.sum(1))
            live[lost] = own[lost]
        i, j = np.nonzero(live)
        score = _products(q[part], x, i, j, exact)
        order = np.lexsort((ids[j], -score, i)) if exact else np.array(sorted(range(len(i)), key=lambda t: (i[t], -score[t], ids[j[t]])), np.int64)
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        found.append((i[keep] + low, j[keep], score[keep]))
    return (np.concatenate([f[n] for f in found]) for n in range(3))


def _blocks(k: int, scale: float):
    names = ["query_uid", "query_id", "vec_id", "score", "s"]

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        flat = t.column(name).combine_chunks().flatten().to_numpy(False).astype(np.float64)
        return np.floor(scale * flat).reshape(t.num_rows, len(flat) // t.num_rows)

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, names)
        ids, q_uid = rows.column("vec_id").to_numpy(), queries.column("quid").to_numpy()
        i, j, score = best(q_uid, matrix(queries, "qv"), rows.column("uid").to_numpy(), ids, matrix(rows, "v"), k)
        score = [max(-_LIMIT - 1, min(_LIMIT, int(v))) for v in score.tolist()]
        cols = [q_uid[i], queries.column("qid").to_numpy()[i], ids[j], score, np.full(len(i), rows.column("s")[0].as_py())]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names)

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest products, ties to the smaller id; all if there are fewer.

    ``queries`` is a condition on the rows of ``vectors``.  Each row is a vector of its own, rows alike too: a query's
    candidates are all rows but its own, and rows that share a query's id are queries apart, each with its list.  Rows
    with a null id, and vectors null or with a null component or one that is not finite or not once scaled, take no part.  Only vectors of the query's
    length are its candidates; without components every score is 0.  A score beyond 64 bits stays at the limit.  Other
    columns are left out.  Empty input gives no rows.
    """
    v = F.col(vector_col)
    v = v if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else v.cast("array<double>")
    thin = vectors.filter(fine(F.col(vector_col), scale) & F.col(id_col).isNotNull())
    thin = thin.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    thin = written(thin.withColumn("n", F.size("v")), "vectors")
    n_rows, n_queries, width = thin.agg(F.count("*"), F.count_if(F.col("asks")), F.coalesce(F.max("n"), F.lit(0))).first()
    most = max(1, BYTES // (8 * max(1, width)))
    spread, turns = max(1, -(-n_rows // min(ROWS, most))), max(1, -(-n_queries // min(QUERIES, most)))
    part = lambda n: F.pmod(F.xxhash64("uid", F.lit(7)), F.lit(n))
    # each side's rows go to every block of the other side, whose number follows the other side's size
    rows = thin.select("uid", "vec_id", "v", "n", part(spread).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("q"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    asks = thin.filter("asks").select(F.col("uid").alias("quid"), F.col("vec_id").alias("qid"), F.col("v").alias("qv"), F.col("n").alias("qn"), part(turns).cast("int").alias("qq"), every.alias("qs"))
    found = asks.groupBy("qn", "qq", "qs").cogroup(rows.groupBy("n", "q", "s")).applyInArrow(_blocks(k, float(scale)), "query_uid long, query_id long, vec_id long, score long, s long")
    order = [F.desc("score"), F.asc("vec_id")]
    while spread > 1:
        spread = -(-spread // MERGE)
        found = found.withColumn("s", F.floor(F.col("s") / MERGE))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_uid", "s").orderBy(*order))).filter(F.col("rank") <= k)
    if "rank" not in found.columns:
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_uid").orderBy(*order)))
    return found.select("query_id", "rank", "vec_id", "score")


def op6(vectors: DataFrame) -> DataFrame:
    """The contract's search: every 50th id asks."""
    return top_k(vectors, F.col("vec_id") % EVERY == 0)
