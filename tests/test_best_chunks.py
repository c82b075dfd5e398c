"""The best chunk of each document for each item against loops, by postings in tasks and by joined tokens."""

import random
import re
from fractions import Fraction

import pytest

from quillgraph.operators import rerank as K


def words(t):
    spaced = re.sub("([a-z])([A-Z])", r"\1 \2", t or "").lower()
    return {w for w in re.split("[^a-z0-9]+", spaced) if w} - set(K.V.STOP_WORDS)


def plain(docs, items, size, overlap):
    out = {}
    for d, t in docs:
        t = (t or "").strip(" ")
        for i, q in items:
            for at in range(0, len(t), size - overlap):
                a, b = words(t[at : at + size]), words(q)
                if a & b:
                    x = Fraction(2 * len(a & b), len(a) + len(b))
                    dice = int(x * 10**6 + Fraction(1, 2)) / 10**6
                    if (i, d) not in out or dice > out[i, d][1]:
                        out[i, d] = (at, dice)
    return out


def tables(spark, kind):
    r = random.Random(2)
    say = lambda n: " ".join(r.choice(["the", "Level", "onOff", "dust", "é", "x1", "mode", "air", "Zq"]) for _ in range(n))
    docs = [(i, say(r.randint(0, 60))) for i in range(40)] + [(40, None), (41, ""), (42, "the the of"), (43, say(900))]
    items = [(i, say(r.randint(1, 8))) for i in range(9)] + [(9, None), (10, "the"), (11, "nothing shared")]
    if kind == "string":
        docs, items = [(f"d{i:03d}", t) for i, t in docs], [(f"i{i}", t) for i, t in items]
    return docs, items, spark.createDataFrame(docs, f"doc_id {kind}, text string").repartition(3), spark.createDataFrame(items, f"item_id {kind}, text string")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_best_chunks(spark, kind, monkeypatch):
    docs, items, d, i = tables(spark, kind)
    want = plain(docs, items, 60, 20)
    rows = lambda df: {(x.item_id, x.doc_id): (x.pos, x.dice) for x in df.collect()}
    assert rows(K.best_chunks(d, i, 60, 20)) == want
    assert rows(K.best_chunks(d, i, 60, 20, small=0)) == want
    monkeypatch.setattr(K, "CELLS", 20)
    top = lambda df: {(x.item_id, x["rank"], x.doc_id) for x in K.top(df, ["item_id"], "dice", "doc_id", 3).collect()}
    assert rows(K.best_chunks(d, i, 60, 20)) == want
    assert top(K.best_chunks(d, i, 60, 20, top_n=3)) == top(K.best_chunks(d, i, 60, 20, small=0))
    assert K.best_chunks(d.filter("false"), i).isEmpty() and K.best_chunks(d, i.filter("false")).isEmpty()
