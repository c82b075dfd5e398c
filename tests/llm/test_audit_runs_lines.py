"""Filter interactions, periodic runs and line dedup against plain Python, on odd tables and hot groups."""

import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import interactions, lines, periods
from quillgraph.llm.shared import NULL_ID

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n_lines long, did long, mask long, runs string"
SPACES = " \t\n\x0b\x0c\r"


def words(t):
    return [w.decode() for w in (t or "").encode().split()]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def corpus():
    r = random.Random(8)
    vocabulary = [f"v{i}" for i in range(40)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    lines_ = ["A common line here", "  a COMMON line here\t", "short", "Éine Zeile mit Umlaut", "éine zeile mit umlaut", "", say(12), say(9)]
    out = [None, "", " \t\n", "one", "\n\n", "x" * 4000, "a b c " * 90, "HELLO THERE " * 4, "# symbols"]
    out += ["\n".join(r.choice(lines_) for _ in range(r.randint(1, 12))) for _ in range(25)]
    out += [say(250), say(250) + " $", say(30) + " " + "u v w " * 7 + say(20) + " u v w u v w u v w u v w u", out[-1], out[-1], None, "\r\n".join([say(4)] * 3)]
    out += [say(700), " ".join([say(5)] * 9 + ["z"] * 8 + [say(3)] * 5), "q " * 3000, "the line that all have\n" + say(210)] + ["the line that all have"] * 6
    return [(i * 3 + 1, t, "en", [None, "a", "b", ""][i % 4], 0, "r", 5, 6, 7, "x") for i, t in enumerate(out)]


def messy_rows():
    rows = corpus()
    return rows + [(None, *rows[12][1:]), (None, *rows[12][1:]), (None, "another text of an id that is null", *rows[1][2:]), (rows[9][0], "A common line here\nnot the same text", *rows[9][2:]), rows[20], rows[20]]


def labelled(spark, rows):
    r = random.Random(2)
    flags = [(x[0], r.randint(0, 1), r.randint(0, 1)) for x in rows if r.random() < 0.6] + [(None, 1, 1), (rows[0][0], None, None), (rows[20][0], 1, 0), (rows[20][0], 0, 1), (999999, 1, 1)]
    return spark.createDataFrame(flags, "doc_id long, quality int, toxic int"), flags


def planned_audit(rows, flags):
    def did(i):
        return NULL_ID if i is None else i

    first = {}
    for i, t, *_ in rows:
        first[t or ""] = min(did(i), first.get(t or "", did(i)))
    docs = []
    for i, t, _, part, *_ in rows:
        t = t or ""
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": did(i) > first[t],
        }
        mine = [f for f in flags if f[0] is not None and f[0] == i]
        docs.append((part or "", {k for k, v in fails.items() if v}, any(f[1] == 1 for f in mine), any(f[2] == 1 for f in mine)))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in here) - len(gone)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, sum(d[1] == {f} for d in here), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("rows", [corpus(), messy_rows()], ids=["plain", "messy"])
def test_interactions(spark, rows):
    labels, flags = labelled(spark, rows)
    got = interactions.op11(spark.createDataFrame(rows, SCHEMA).repartition(3), labels).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == planned_audit(rows, flags)
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_parity_sums_turn_back(spark):
    rows = [("p", m, m % 2, m % 3 == 0) for m in range(32) for _ in range(m * m % 7)]
    df = spark.createDataFrame([(p, m, g, int(t)) for p, m, g, t in rows], "part string, mask int, good int, toxic int")
    (r,) = interactions.cells(interactions.parity_sums(df)).collect()
    assert r.every == [m * m % 7 for m in range(32)]
    assert r.good == [m * m % 7 * (m % 2) for m in range(32)] and r.toxic == [m * m % 7 * (m % 3 == 0) for m in range(32)]


def test_interactions_of_hot_copies(spark):
    docs = spark.range(30000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"))
    r = interactions.masks(docs, spark.createDataFrame([(4, 1, 1)], "doc_id long, quality int, toxic int")).groupBy("mask", "good").count().collect()
    assert {(x["mask"], x["good"]): x["count"] for x in r} == {(1, 0): 10000, (17, 0): 19999, (17, 1): 1}


def plain_runs(s, least=6, times=4):
    out = {}
    for p in range(1, len(s) // times + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, p, e) for (a, e), p in out.items())


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not w:
        return w
    a, p = h // 10 % len(w), None
    p = 1 + (len(w) - a) // (3 + h // 10 % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]


def test_periodic_runs_of_numbers():
    r = random.Random(6)
    for _ in range(1500):
        n, s = r.randint(0, 70), []
        while len(s) < n:
            c = r.random()
            if s and c < 0.4:
                a = r.randrange(len(s))
                s += s[a : a + r.randint(1, 25)]
            elif c < 0.7:
                s += [r.randrange(3) for _ in range(r.randint(1, 4))] * r.randint(2, 6)
            else:
                s.append(r.randrange(4))
        for least, times in ((2, 2), (6, 3), (6, 4)):
            assert [(a, p, e) for a, e, p in periods.runs_of(np.array(s, np.int64), least, times)] == plain_runs(s, least, times), s


def test_longest_previous_factors():
    r = random.Random(3)
    for _ in range(200):
        s = [r.randrange(3) for _ in range(r.randint(2, 40))]
        f = periods.Factors(np.array(s))
        if not f.levels:
            continue
        length, source = periods.previous_factors(f)
        for i in range(len(s)):
            best = max((next((k for k in range(len(s) - i) if s[j + k] != s[i + k]), len(s) - i) for j in range(i)), default=0)
            assert length[i] == best
            assert not best or (source[i] < i and s[source[i] : source[i] + best] == s[i : i + best])


def test_pieces_of_borders(monkeypatch):
    monkeypatch.setattr(periods, "PAIRS", 7)
    test_periodic_runs_of_numbers()


@pytest.mark.parametrize("rows", [corpus(), messy_rows()], ids=["plain", "messy"])
def test_periodic(spark, rows):
    got = periods.op12(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    want, some = [], 0
    for i, t, *_ in rows:
        w = planted(i, words(t))
        runs = plain_runs(w)
        gone = {k for a, p, e in runs for k in range(a + p, e)}
        best = min(((a - e, a, p) for a, p, e in runs), default=None)
        some += bool(runs)
        text = "".join(f"{a},{e - a},{p}\n" for a, p, e in runs)
        want.append((i, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4), sha(text), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    assert some > 6
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_lines(spark):
    rows = corpus()

    def key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(SPACES))

    first = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)] = min(i, first.get(key(x), i))
    want = {}
    for i, t, *_ in rows:
        every = (t or "").split("\n")
        stay = [x for x in every if first.get(key(x), i) == i]
        want[i] = (len(every), len(every) - len(stay), sha("\n".join(stay)))
    assert sum(x[1] for x in want.values()) > 20
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.op13(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == want
    one = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA), batches=1).select("row.doc_id", F.sha2("text", 256)).collect()
    assert {r[0]: r[1] for r in one} == {i: x[2] for i, x in want.items()}


def test_lines_of_messy_tables(spark):
    rows = messy_rows()
    got = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).select("row.doc_id", "row.text", "row.row", F.col("text").alias("kept"), "n_dropped").collect()
    assert len(got) == len(rows) and {r.row for r in got} == {"r"}
    # null ids come first, so their lines stay
    assert all(r.kept == r.text and not r.n_dropped for r in got if r.doc_id is None)
    # a row listed thrice is one document
    assert len({(r.kept, r.n_dropped) for r in got if r.doc_id == rows[20][0]}) == 1
    # a line stays in one document, as often as it is there
    holders = {}
    for r in got:
        for x in r.kept.split("\n"):
            if len(x.strip(SPACES)) >= 10:
                holders.setdefault(x.strip(SPACES).lower() if x.isascii() else x.strip(SPACES), set()).add((r.doc_id, r.text))
    assert all(len(h) == 1 for h in holders.values())


def test_lines_of_hot_copies(spark):
    """Most rows are one row, and one line is in all documents."""
    same = spark.range(20000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a line of the copies\nthe common line").alias("text"))
    rest = spark.range(100, 3100).select(F.col("id").alias("doc_id"), F.concat(F.lit("the common line\na line of number "), F.col("id")).alias("text"))
    got = lines.op13(same.union(rest)).groupBy("n_lines", "n_dropped").count().collect()
    assert sorted(map(tuple, got)) == [(2, 0, 20000), (2, 1, 3000)]


def test_runs_are_kept_and_merged(spark, tmp_path):
    folder = f"file://{tmp_path}/runs"
    docs = [spark.createDataFrame([(10 * b + i, f"line number {b} {i}\nthe line of all batches\nshort") for i in range(3)], "doc_id long, text string") for b in range(5)]
    seen = [lines.dedup_lines(d, batches=1, runs=folder).select("n_dropped", "text").collect() for d in docs]
    assert [sum(r.n_dropped for r in s) for s in seen] == [2, 3, 3, 3, 3]
    again = lines.dedup_lines(docs[2], batches=1, runs=folder).select("n_dropped", "text").collect()
    assert [r.text for r in again] == ["short"] * 3
    store = lines.Runs(spark, folder)
    # six batches in levels of two: 110 in binary
    assert sorted(level for level, _ in store.runs) == [1, 2]
    store.close(delete=True)


def test_a_batch_meets_runs_without_shuffling_them(spark, tmp_path):
    store = lines.Runs(spark, f"file://{tmp_path}/merge")
    table = spark.range(1000).select(F.col("id").alias("did"), F.lit(0).cast("long").alias("ver"), F.concat(F.lit("line number "), F.col("id") % 700).alias("text"))
    hashed = lines.hashed_lines(table)
    store.add(hashed.filter("did < 500"))
    known = store.add(hashed.filter("did >= 500"))
    assert known.filter("known").count() == 300 and known.filter("not known").count() == 200
    joined = hashed.groupBy("h1", "h2").count().join(store.hashes(store.runs[0]).hint("merge"), ["h1", "h2"], "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    store.close(delete=True)


@pytest.mark.parametrize("query", [lambda d, e: interactions.op11(d, e), lambda d, e: periods.op12(d), lambda d, e: lines.op13(d)])
def test_empty(spark, query):
    docs = spark.createDataFrame([], SCHEMA)
    assert query(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []
