"""Filtered search and inverted lists against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.operators import lists as L
from quillgraph.operators import vectors as V


def unit(n, d, seed, groups=12):
    r = np.random.default_rng(seed)
    x = r.normal(size=(groups, d))[r.integers(0, groups, n)] * 1.2 + r.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).round(5)


def plain(q, x, k, may=None):
    out = {}
    for i, a in enumerate(q):
        s = sorted((-round(float(a @ b), 6) + 0.0, j) for j, b in enumerate(x) if may is None or may(i, j))
        out[i] = [j for _, j in s[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def frame(spark, x, name, id_name, extra=None, schema=""):
    rows = [(i, [float(a) for a in v], *((extra[i],) if extra else ())) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"{id_name} long, {name} array<double>{schema}")


def test_filtered(spark, monkeypatch):
    """Filters that admit none, one, k - 1 and all; names either way and of chapters; several blocks."""
    monkeypatch.setattr(V, "ROWS", 40)
    x, q = unit(200, 8, 1), unit(6, 8, 2)
    labels = ["Secure Channel basics" if i == 3 else "On/Off" if i < 9 else "Dust sensor" if i < 13 else "" if i < 20 else "Level" for i in range(200)]
    names = [None, "", "no such", "virtualcluster-sc", "dust", "The On/Off Cluster"]
    may = lambda i, j: (
        i < 2 or i == 3 and j == 3 or i == 4 and 9 <= j < 13 or i == 5 and j < 9 and j != 3
    )
    v = frame(spark, x, "v", "vec_id", labels, ", label string")
    asked = V.with_filter(frame(spark, q, "q", "query_id", names, ", cluster string"), v)
    assert got(V.search(asked, v, 5)) == {i: w for i, w in plain(q, x, 5, may).items() if w}
    assert len(got(V.search(asked, v, 5))[4]) == 4


def test_odd_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0]), (6, [1.0]), (7, [1.0, 0.0])], "vec_id long, v array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, [float("nan"), 0.0]), (3, None)], "query_id long, q array<double>")
    assert got(V.search(q, v, 5)) == {1: [1, 7]}
    assert V.search(q, v.filter("false"), 5).isEmpty()


def test_ties_at_the_edge(spark):
    v = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(50)], "vec_id long, v array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id long, q array<double>")
    assert got(V.search(q, v, 3)) == {0: [0, 1, 2], 1: [1, 3, 5]}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    x = unit(3000, 16, 3)
    return x, L.Lists.build(frame(spark, x, "v", "vec_id"), f"file://{tmp_path_factory.mktemp('lists')}/a", sample=1000)


def test_lists(spark, index):
    x, lists = index
    assert len(lists.centroids) == 75 and lists.vectors.count() == 3000
    # each vector is where its product is the highest
    rows = lists.vectors.select("vec_id", "list").collect()
    assert all((x[r.vec_id] @ lists.centroids.T).argmax() == r.list for r in rows)
    q = x[::30]
    queries = frame(spark, q, "q", "query_id")
    want = plain(q, x, 10)
    assert got(lists.search(queries, 10, probes=None)) == want
    found = got(lists.search(queries, 10, probes=12))
    recall = np.mean([len(set(found[i]) & set(want[i])) / 10 for i in want])
    assert all(len(f) == 10 for f in found.values()) and recall >= 0.9
    assert got(L.Lists(spark, lists.path).search(queries, 10, probes=12)) == found


def test_lists_fall_back_and_prune(spark, index, monkeypatch):
    x, lists = index
    queries = frame(spark, x[:3], "q", "query_id")
    # one list holds fewer than 200
    assert got(lists.search(queries, 200, probes=1)) == plain(x[:3], x, 200)
    plan = lists.vectors.filter(F.col("list").isin(1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan
    monkeypatch.setattr(V, "ROWS", 16)
    monkeypatch.setattr(V, "QUERIES", 2)
    few = got(lists.search(queries, 5, probes=3))
    monkeypatch.undo()
    assert few == got(lists.search(queries, 5, probes=3))


def test_lists_of_odd_tables(spark, tmp_path):
    empty = L.Lists.build(spark.createDataFrame([], "vec_id long, v array<double>"), f"file://{tmp_path}/e")
    assert empty.search(spark.createDataFrame([(1, [1.0])], "query_id long, q array<double>")).isEmpty()
    with pytest.raises(ValueError):
        L.Lists.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, v array<double>"), f"file://{tmp_path}/f")
