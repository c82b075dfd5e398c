"""Toxicity by non-negative positive-unlabelled learning, in numpy.

Confirmed toxic texts are the positives; all other texts, labelled or not, are unlabelled and hold toxic ones in the
share of the class prior.  The risk is prior * R+(P) + max(0, R-(U) - prior * R-(P)); where the bracket turns negative,
the step goes against it, which keeps a flexible model from explaining the positives among the unlabelled away.  The
model is linear in the presence of words; a last fit of slope and offset on labelled rows makes its score a probability.

A feature is a word without the punctuation around it, or its first bytes, as stems have many endings; met twice or three
times in a text, it leaves further features.  How clearly a feature must tell is chosen among SIGMAS by the log loss on inner folds of the rows that aren't
held out, so the held-out rows have no part in any choice.

The sample is bounded (POSITIVES and UNLABELLED ids by a hash of the id, one text of each); scoring goes over every whole
text.  Features are counted on the executors; the driver gets those that may be used, and of each sampled text only these.
"""

from __future__ import annotations

import string
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, written
from .words import U, hashes, mix, sliced, words

#: Bounds of the training sample, in texts; features kept at most, texts a feature must be in, and how clearly it tells.
POSITIVES, UNLABELLED = 2000, 6000
FEATURES, LEAST = 2000, 8
#: What to choose from, in standard errors, and bytes of a stem.
SIGMAS, STEM = (4.0, 5.0, 6.0, 8.0, 12.0), 5
EPOCHS, STEP, DECAY, BATCHES, SEED = 60, 0.05, 1e-3, 10, 11
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in string.punctuation]] = True


def held_out(id_: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2.  A null id is not held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of each distinct feature of each text, in the order of the texts.

    Features are hashes: of a lower-cased word without the punctuation around it, of its first STEM bytes where it is
    longer, and of either once more where the text holds it at least twice, and at least three times.
    """
    w = words(texts, lower=True)
    raw = np.frombuffer(w.data, np.uint8)
    start, end = w.start.copy(), w.end.copy()
    while (cut := (start < end) & _PUNCTUATION[raw[np.minimum(start, len(raw) - 1)]]).any():
        start[cut] += 1
    while (cut := (start < end) & _PUNCTUATION[raw[end - 1]]).any():
        end[cut] -= 1
    long = np.flatnonzero(end - start > STEM)
    row = w.text_of()
    row = np.concatenate([row, row[long]])
    value = np.concatenate([hashes(w.data, start, end), mix(hashes(w.data, start[long], start[long] + STEM) ^ U(1))])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    lead = np.flatnonzero(new)
    n = np.diff(np.append(lead, len(row)))
    row, value = row[lead], value[lead]
    row, value = (np.concatenate([x, y[n > 1], z[n > 2]]) for x, y, z in ((row, row, row), (value, mix(value ^ U(77)), mix(value ^ U(78)))))
    order = np.argsort(row, kind="stable")
    return row[order], value[order]


def feature_sets(texts: list[str]) -> list[np.ndarray]:
    row, value = features(texts)
    at = np.searchsorted(row, np.arange(len(texts) + 1))
    return [np.sort(value[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _distinct(batches):
    for b in sliced(batches, "text"):
        sets = [s.view(np.int64) for s in feature_sets(b.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("mark"), pa.array(sets, pa.list_(pa.int64()))], ["mark", "f"])


def _only(vocabulary: np.ndarray):
    """Of each text the features of a sorted vocabulary, as bytes."""

    def run(batches):
        for b in batches:
            sets = [np.asarray(s.values, np.int64).view(U) for s in b.column("f")]
            sets = [s[np.isin(s, vocabulary)].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("mark"), pa.array(sets, pa.binary())], ["mark", "f"])

    return run


def usable(sets: DataFrame, most: int, least: int) -> np.ndarray:
    """The features of (mark, f) that a fit on all folds, or on all but one, may use: for each of these fits the ``most``
    clearest that are in ``least`` texts and tell by the least of SIGMAS.  At most (FOLDS + 1) * most, sorted."""
    of = lambda p, x: F.count_if(F.col("p") == F.lit(p) if x is None else (F.col("p") == F.lit(p)) & (F.col("fold") != x))
    fits = [None, *(x for x in range(FOLDS) if x != HELD)]
    total = sets.select("mark.p", "mark.fold").agg(*[of(p, x) for x in fits for p in (True, False)]).first()
    each = sets.select("mark.p", "mark.fold", F.explode("f").alias("v"))
    counts = each.groupBy("v").agg(*[of(p, x).alias(f"{'pu'[not p]}{i}") for i, x in enumerate(fits) for p in (True, False)]).filter(F.col("p0") + F.col("u0") >= least)
    counts = written(counts, "feature-counts")
    found = np.zeros(0, np.int64)
    for i in range(len(fits)):
        n_p, n_u = total[2 * i], total[2 * i + 1]
        if not n_p or not n_u:
            continue
        a, b = F.col(f"p{i}"), F.col(f"u{i}")
        rate = (a + b) / F.lit(float(n_p + n_u))
        z = F.abs(a / n_p - b / n_u) / F.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u) + 1e-12)
        # a little below the bound: it is drawn again, in numpy, where the fit chooses
        rows = counts.filter(a + b >= least).select("v", z.alias("z")).filter(F.col("z") >= min(SIGMAS) - 1e-6).orderBy(F.desc("z"), "v").limit(most + most // 100).collect()
        found = np.union1d(found, np.array([r.v for r in rows], np.int64))
    discard(counts)
    return np.sort(found.view(U))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sparse:
    """Rows of feature numbers, all with value 1."""

    def __init__(self, sets: list[np.ndarray], vocabulary: np.ndarray):
        found = []
        for s in sets:
            i = np.minimum(np.searchsorted(vocabulary, s), max(0, len(vocabulary) - 1))
            found.append(i[vocabulary[i] == s] if len(vocabulary) else i[:0])
        self.rows = len(found)
        self.size = np.array([len(x) for x in found], np.int64)
        self.feature = np.concatenate(found) if found else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.rows), self.size)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature], self.rows)

    def gradient(self, by_row: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.feature, by_row[self.row], n)

    def part(self, rows: np.ndarray) -> Sparse:
        out = object.__new__(Sparse)
        place = np.full(self.rows, -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.row] >= 0
        out.rows, out.feature, out.row = len(rows), self.feature[keep], place[self.row[keep]]
        return out


class Model:
    """Sorted feature hashes with their weights, an offset, and the slope and offset that make scores probabilities."""

    def __init__(self, vocabulary: np.ndarray, weights: np.ndarray, offset: float, slope: float, shift: float):
        self.vocabulary, self.weights, self.offset, self.slope, self.shift = vocabulary, weights, offset, slope, shift

    def scores(self, texts: list[str]) -> np.ndarray:
        row, value = features(texts)
        margin = np.full(len(texts), self.offset)
        if len(self.vocabulary) and len(value):
            i = np.minimum(np.searchsorted(self.vocabulary, value), len(self.vocabulary) - 1)
            hit = np.flatnonzero(self.vocabulary[i] == value)
            margin += np.bincount(row[hit], self.weights[i[hit]], len(texts))
        return _sigmoid(self.slope * margin + self.shift)


def _as_negative(s: np.ndarray) -> float:
    """The mean loss -log(1 - s) of scores taken as the negative class's."""
    return float(-np.log1p(-np.minimum(s, 1 - 1e-12)).mean())


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The non-negative risk of scores of positives and of unlabelled texts."""
    as_positive = float(-np.log(np.maximum(positive, 1e-12)).mean())
    return prior * as_positive + max(0.0, _as_negative(unlabelled) - prior * _as_negative(positive))


def _gradient(p: Sparse, u: Sparse, w: np.ndarray, n: int, prior: float) -> np.ndarray:
    """The risk's gradient by weights and offset; where the bracket is negative, the step that undoes the overfit."""
    sp, su = _sigmoid(p.times(w[:n]) + w[n]), _sigmoid(u.times(w[:n]) + w[n])
    gu, gp = su / u.rows, -prior * sp / p.rows
    if _as_negative(su) - prior * _as_negative(sp) < 0:
        gu, gp = -gu, -gp
    else:
        gp = gp + prior * (sp - 1) / p.rows
    return np.concatenate([p.gradient(gp, n) + u.gradient(gu, n), [gp.sum() + gu.sum()]])


def nn_pu(positive: Sparse, unlabelled: Sparse, n: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and offset by Adam on the non-negative risk with logistic losses."""
    rng = np.random.default_rng(SEED)
    w = np.zeros(n + 1)
    m, v, t = np.zeros(n + 1), np.zeros(n + 1), 0
    for _ in range(EPOCHS):
        p_order, u_order = rng.permutation(positive.rows), rng.permutation(unlabelled.rows)
        for ps, us in zip(np.array_split(p_order, BATCHES), np.array_split(u_order, BATCHES), strict=True):
            if not len(ps) or not len(us):
                continue
            g = _gradient(positive.part(ps), unlabelled.part(us), w, n, prior) + DECAY * w
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], float(w[n])


def _probability(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit to smoothed targets, by damped Newton steps on the standardised margin."""
    mean, spread = margin.mean(), margin.std() or 1.0
    z = (margin - mean) / spread
    ones = toxic.sum()
    y = np.where(toxic > 0, (ones + 1) / (ones + 2), 1 / (len(toxic) - ones + 2))
    x = np.stack([z, np.ones_like(z)], 1)
    loss = lambda c: (np.logaddexp(0, x @ c) - y * (x @ c)).sum() + 0.05 * (c @ c)
    c = np.zeros(2)
    for _ in range(60):
        s = _sigmoid(x @ c)
        g = x.T @ (s - y) + 0.1 * c
        step = np.linalg.solve((x * (s * (1 - s))[:, None]).T @ x + 0.1 * np.eye(2), g)
        rate = 1.0
        while rate > 1e-4 and loss(c - rate * step) > loss(c):
            rate /= 2
        c = c - rate * step
        if np.abs(rate * step).max() < 1e-7:
            break
    return (float(c[0] / spread), float(c[1] - c[0] * mean / spread)) if c[0] > 0 else (1.0, 0.0)


def _telling(p: list[np.ndarray], u: list[np.ndarray], sigmas: float, most: int = FEATURES, least: int = LEAST) -> np.ndarray:
    """Features of ``least`` texts in which positives and unlabelled texts differ by ``sigmas`` standard errors, the
    ``most`` clearest, sorted."""
    value, n = np.unique(np.concatenate([*p, *u]), return_counts=True)
    value, n = value[n >= least], n[n >= least]
    own, m = np.unique(np.concatenate(p), return_counts=True)
    i = np.minimum(np.searchsorted(own, value), max(0, len(own) - 1))
    inside = np.where(own[i] == value, m[i], 0) if len(own) else np.zeros(len(value), np.int64)
    a, b = inside / len(p), (n - inside) / len(u)
    rate = n / (len(p) + len(u))
    z = np.abs(a - b) / np.sqrt(rate * (1 - rate) * (1 / len(p) + 1 / len(u)) + 1e-12)
    order = np.lexsort((value.view(np.int64), -z))[:most]
    return np.sort(value[order[z[order] >= sigmas]])


#: A sampled text: its features, whether it is there as a positive, its label or None, its fold.
Text = tuple[np.ndarray, bool, int | None, int]


def learnt(texts: list[Text], prior: float, sigmas: float, most: int = FEATURES, least: int = LEAST) -> Model:
    """A model from sampled texts; without positives or unlabelled ones every score is the prior."""
    p, u = [f for f, pos, *_ in texts if pos], [f for f, pos, *_ in texts if not pos]
    if not p or not u:
        return Model(np.zeros(0, U), np.zeros(0), float(np.log(prior / (1 - prior))), 1.0, 0.0)
    vocabulary = _telling(p, u, sigmas, most, least)
    w, b = nn_pu(Sparse(p, vocabulary), Sparse(u, vocabulary), len(vocabulary), prior)
    known = [(f, label) for f, pos, label, _ in texts if label is not None and not pos]
    slope, shift = 1.0, 0.0
    if len({label for _, label in known}) == 2:
        margin = Sparse([f for f, _ in known], vocabulary).times(w) + b
        slope, shift = _probability(margin, np.array([label for _, label in known], float))
    return Model(vocabulary, w, b, float(slope), float(shift))


def chosen_sigmas(texts: list[Text], prior: float, choices: tuple[float, ...] = SIGMAS, most: int = FEATURES, least: int = LEAST) -> float:
    """The choice with the least log loss on labelled texts of inner folds, each scored by a model of the other folds;
    the first of equals."""
    folds = sorted({fold for *_, fold in texts})
    loss = {}
    for sigmas in choices:
        total = 0.0
        for fold in folds:
            model = learnt([t for t in texts if t[3] != fold], prior, sigmas, most, least)
            known = [(f, label) for f, _, label, x in texts if x == fold and label is not None]
            if known:
                s = Sparse([f for f, _ in known], model.vocabulary).times(model.weights) + model.offset
                s, y = np.clip(_sigmoid(model.slope * s + model.shift), 1e-6, 1 - 1e-6), np.array([label for _, label in known])
                total -= float((y * np.log(s) + (1 - y) * np.log(1 - s)).sum())
        loss[sigmas] = round(total, 6)
    return min(choices, key=lambda c: loss[c])


def fitted(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, most: int = FEATURES, least: int = LEAST) -> Model:
    """Fit on rows that aren't held out, with the ``most`` clearest features that are in ``least`` texts of the sample.

    Labels that are null are none; of several for an id the highest counts.  Rows without an id are never learnt from; of
    an id with several rows the text with the least hash is.  The driver holds positives + unlabelled texts at most, of
    each 8 bytes for each of its usable features, of which there are (FOLDS + 1) * most at most.
    """
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    i = F.col("doc_id").cast("long").alias("doc_id")
    ids = docs.select(i).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    ids = ids.join(marks, "doc_id", "left").withColumn("x", F.xxhash64(F.lit(SEED), "doc_id"))
    counts = ids.agg(F.count_if(F.col("toxic") == 1), F.count("toxic")).first()
    prior = min(0.5, max(1e-3, counts[0] / counts[1])) if counts[1] else 0.5
    take = lambda cond, n: ids.filter(cond).orderBy("x", "doc_id").limit(n)
    # at most positives + unlabelled ids: a proven bound, so they are broadcast
    chosen = take(F.col("toxic") == 1, positives).withColumn("p", F.lit(True)).unionAll(take(F.lit(True), unlabelled).withColumn("p", F.lit(False)))
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS).cast("int")
    chosen = chosen.select("doc_id", F.struct("p", F.col("toxic").cast("int").alias("t"), fold.alias("fold"), "x").alias("mark"))
    texts = docs.select(i, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "mark").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    mark = "mark struct<p:boolean,t:int,fold:int,x:long>"
    sets = written(one.select("text", "mark").mapInArrow(_distinct, f"{mark}, f array<long>"), "feature-sets")
    rows = sets.mapInArrow(_only(usable(sets, most, least)), f"{mark}, f binary").collect()
    discard(sets)
    rows.sort(key=lambda r: (r.mark.p, r.mark.x))
    sample = [(np.frombuffer(r.f, U), r.mark.p, r.mark.t, r.mark.fold) for r in rows]
    return learnt(sample, prior, chosen_sigmas(sample, prior, most=most, least=least), most, least)


def _scored(model):
    def run(batches):
        m = model.value
        for b in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(m.scores(b.column("text").to_pylist()), pa.float64())], ["doc_id", "held_out", "score"])

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, threshold: float = THRESHOLD, most: int = FEATURES, least: int = LEAST
) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each input row.

    Null and empty texts get the score of a text without known words.  Ids only choose folds: null ids are never
    learnt from, repeated ones keep a row each.  Labels: see :func:`fitted`; without any, every score is the prior's.
    Other columns are left out.  Empty input gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, positives, unlabelled, most, least))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = thin.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    return toxicity(docs, labels)


