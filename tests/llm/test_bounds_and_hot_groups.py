"""What earlier rounds left open: safe bounds of top-k, the whole of the toxicity fit against a plain one, hot groups of copies."""

import hashlib
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import substring, tokens, topk, toxicity


@pytest.mark.parametrize("seed", range(6))
def test_top_k_of_vectors_far_from_zero(seed):
    """Constant and nearly constant vectors, large and small, against integers."""
    r = np.random.default_rng(seed)
    for d in (1, 2, 5, 16, 64):
        for offset in (0, 7, 43_460_849, -3_000_000_001, 2**45):
            spread = int(r.integers(0, 3))
            x = (offset + r.integers(-spread, spread + 1, (40, d))).astype(np.float64)
            q, uid, ids = x[:6], np.arange(40), r.permutation(40)
            i, j, score = topk.best(uid[:6], q, uid, ids, x, 5)
            got = [(int(a), int(ids[b]), int(s)) for a, b, s in zip(i, j, score, strict=True)]
            want = []
            for a in range(6):
                every = sorted((-sum(int(u) * int(v) for u, v in zip(q[a], x[b], strict=True)), int(ids[b])) for b in range(40) if b != a)
                want += [(a, c, -s) for s, c in every[:5]]
            assert got == want


def test_top_k_beyond_float64(spark):
    big = [(i, [1e300 * (i % 7), 1e300, -1.0]) for i in range(60)] + [(100, [1e308, 0.0, 0.0])]
    got = topk.op6(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    # 256 * 1e308 isn't a number that float64 has, so that row takes no part
    assert len(got) == 10 and {x.query_id for x in got} == {0, 50} and all(x.vec_id != 100 for x in got)


def test_top_k_with_clashing_columns(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0], 1, 2, 3, 4) for i in range(60)], "vec_id long, embedding array<float>, uid long, v int, n int, asks int")
    assert topk.op6(v).count() == 10


def plain_features(text):
    seen, out = {}, set()
    for w in (text or "").encode().lower().split():
        w = w.strip(string.punctuation.encode())
        for f in [("w", w)] + ([("s", w[: toxicity.STEM])] if len(w) > toxicity.STEM else []):
            seen[f] = seen.get(f, 0) + 1
    for f, n in seen.items():
        out |= {(f, k) for k in range(1, min(n, 3) + 1)}
    return out


def plain_fit(sample, prior, sigmas):
    """(vocabulary, weights, offset, slope, shift) with dense matrices; sample: (features, positive, label, fold)."""
    p, u = [s[0] for s in sample if s[1]], [s[0] for s in sample if not s[1]]
    z = {}
    for f in set().union(*p, *u):
        a, b = sum(f in s for s in p), sum(f in s for s in u)
        if a + b >= toxicity.LEAST:
            rate = (a + b) / (len(p) + len(u))
            z[f] = abs(a / len(p) - b / len(u)) / np.sqrt(rate * (1 - rate) * (1 / len(p) + 1 / len(u)) + 1e-12)
    vocabulary = sorted(f for f in z if z[f] >= sigmas)
    dense = lambda sets: np.array([[f in s for f in vocabulary] for s in sets], float).reshape(len(sets), len(vocabulary))
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    negative = lambda s: -np.log1p(-np.minimum(s, 1 - 1e-12)).mean()
    xp, xu, rng = dense(p), dense(u), np.random.default_rng(toxicity.SEED)
    w, b = np.zeros(len(vocabulary)), 0.0
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    for _ in range(toxicity.EPOCHS):
        a, c = rng.permutation(len(p)), rng.permutation(len(u))
        for i, j in zip(np.array_split(a, toxicity.BATCHES), np.array_split(c, toxicity.BATCHES), strict=True):
            if not len(i) or not len(j):
                continue
            sp, su = sig(xp[i] @ w + b), sig(xu[j] @ w + b)
            gu, gp = su / len(j), -prior * sp / len(i)
            if negative(su) - prior * negative(sp) < 0:
                gu, gp = -gu, -gp
            else:
                gp = gp + prior * (sp - 1) / len(i)
            g = np.append(xp[i].T @ gp + xu[j].T @ gu, gp.sum() + gu.sum()) + toxicity.DECAY * np.append(w, b)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = toxicity.STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    known = [(s[0], s[2]) for s in sample if s[2] is not None and not s[1]]
    slope, shift = toxicity._probability(dense([k[0] for k in known]) @ w + b, np.array([k[1] for k in known], float))
    return lambda texts: sig(slope * (dense(texts) @ w + b) + shift)


def test_toxicity_against_a_plain_fit(spark):
    """Folds, choice of sigma, weights, calibration and scores."""
    r = random.Random(5)
    rows, marks = [], []
    for i in range(420):
        w = [f"word{r.randrange(60)}" for _ in range(25)]
        if i % 5 == 0:
            w[r.randrange(25)] = r.choice(["Vileness!", "vilest", "fools,", "fool fool"])
            w[r.randrange(25)] = r.choice(["vilest", "nasty", "(nasty)"])
        rows.append((i, " ".join(w)))
        if i % 7:
            marks.append((i, 1, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.op4(docs, labels).collect()}
    order = docs.select("doc_id", F.xxhash64(F.lit(toxicity.SEED), "doc_id").alias("x"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("c")).collect()
    label = {m[0]: m[2] for m in marks}
    learn = sorted(((o.x, o.doc_id, o.c % 4) for o in order if o.c % 4 != 2))
    assert {i for i, x in got.items() if x.held_out} == {o.doc_id for o in order if o.c % 4 == 2}
    features = {i: plain_features(t) for i, t in rows}
    sample = [(features[i], False, label.get(i), fold) for _, i, fold in learn] + [(features[i], True, 1, fold) for _, i, fold in learn if label.get(i) == 1]
    ones = sum(label.get(i) == 1 for _, i, _ in learn)
    prior = ones / sum(i in label for _, i, _ in learn)
    loss = {}
    for sigmas in toxicity.SIGMAS:
        loss[sigmas] = 0.0
        for fold in (0, 1, 3):
            model = plain_fit([s for s in sample if s[3] != fold], prior, sigmas)
            known = [(s[0], s[2]) for s in sample if s[3] == fold and s[2] is not None]
            s = np.clip(model([k[0] for k in known]), 1e-6, 1 - 1e-6)
            loss[sigmas] -= sum(np.log(a) if y else np.log(1 - a) for a, (_, y) in zip(s, known, strict=True))
        loss[sigmas] = round(float(loss[sigmas]), 6)
    model = plain_fit(sample, prior, min(toxicity.SIGMAS, key=lambda c: loss[c]))
    want = model([features[i] for i, _ in rows])
    assert [got[i].score for i, _ in rows] == pytest.approx(want.tolist(), abs=1e-6)
    assert max(want) - min(want) > 0.5


def test_toxicity_of_many_rows_of_one_id(spark):
    """What reaches the driver is bounded by ids and features, not by rows."""
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["a", "b", "c", "vile"]) for _ in range(20))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionAll(spark.range(50_000).select(F.lit(3).cast("long"), F.concat(F.lit("copy "), F.col("id") % 5)))
    labels = spark.createDataFrame([(i, 1, int("vile" in t)) for i, t in rows], "doc_id long, quality int, toxic int")
    assert toxicity.op4(docs, labels).filter("score between 0 and 1").count() == 50_060


def test_features_are_bounded(spark):
    sets = spark.createDataFrame([((i % 2 == 0, 1, (0, 1, 3)[i % 3], i), [j for j in range(300) if (i % 2 == 0) or j % 7 == i % 7]) for i in range(60)], "mark struct<p:boolean,t:int,fold:int,x:long>, f array<long>")
    assert 10 <= len(toxicity.usable(sets, 10, 8)) <= 40


def test_substring_of_many_copies_of_a_row(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.range(50_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text")).unionAll(spark.createDataFrame([(9, "x " + text), (None, "short")], "doc_id long, text string"))
    got = {tuple(x) for x in substring.op1(docs).groupBy("doc_id", "n_words", "n_removed", "kept_sha256").count().collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(5, 40, 0, sha(text), 50_000), (9, 41, 40, sha("x"), 1), (None, 1, 0, sha("short"), 1)}


def test_tokens_of_a_hot_text(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text of "), F.col("id") % 100)).alias("text"))
    got = tokens.token_counts(docs).groupBy("n_bytes").count().collect()
    assert sum(x["count"] for x in got) == 30_000
