"""What a Python worker holds at once doesn't depend on how many rows a batch has."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from quillgraph.operators import rerank as K
from quillgraph.operators import vectors as V
from quillgraph.sources import html as H


def test_scores_are_made_in_slices(monkeypatch):
    sizes, partition = [], np.partition
    monkeypatch.setattr(V.np, "partition", lambda a, *x, **y: sizes.append(a.size) or partition(a, *x, **y))
    n = 8192
    v = np.linspace(0, 1, n)
    rows = pa.table({"vec_id": np.arange(n), "v": pa.array([[x] for x in v]), "s": pa.array(np.zeros(n, np.int32)), "label": [""] * n})
    queries = pa.table({"query_id": np.arange(300), "q": pa.array([[1.0]] * 300), "allow": pa.nulls(300, pa.list_(pa.string()))})
    out = V._best(3, 6, pa.int64(), pa.int64())(queries, rows)
    assert out.column("vec_id").to_pylist() == [8191, 8190, 8189] * 300
    assert len(sizes) > 1 and max(sizes) * 8 <= 8 << 20


def test_pages_go_out_in_slices():
    b = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([f"<h1>t{i}</h1><p>x</p>" for i in range(200)])], ["id", "html"])
    out = list(H._sections([b, b.slice(0, 0)]))
    assert [x.num_rows for x in out] == [64, 64, 64, 8, 0]
    assert [t for x in out for t in x.column("title").to_pylist()] == [f"t{i}" for i in range(200)]


def test_pairs_of_chunks_and_items_go_out_in_slices():
    n = 2500
    b = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([[0]] * n, pa.list_(pa.int32())), pa.array([[["a", "b"]]] * n, pa.list_(pa.list_(pa.string())))], ["doc_id", "pos", "t"])
    shared = SimpleNamespace(value=(["a"], np.array([0, 1]), np.array([0]), np.array([1])))
    out = list(K._matched(shared, None)([b, b.slice(0, 0)]))
    assert [x.num_rows for x in out] == [1024, 1024, 452]
    assert [d for x in out for d in x.column("doc_id").to_pylist()] == list(range(n)) and set(out[0].column("dice").to_pylist()) == {0.666667}
