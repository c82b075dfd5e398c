"""Results kept by content, and source directories, against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import cached as C
from quillgraph.operators import directories as D


def words(fresh):
    return fresh.select("_digest", F.explode(F.split(F.coalesce("text", F.lit("none")), " ")).alias("word")).filter("word != ''")


def told(records):
    return sorted((r.id, r.word) for r in records.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def test_passes_compute_each_content_once(spark, tmp_path):
    path, rows = f"file://{tmp_path}/kept", [(1, "a b"), (2, "a b"), (3, ""), (4, None), (5, "c"), (1, "a b")]
    want = sorted([(1, "a"), (1, "b")] * 2 + [(2, "a"), (2, "b"), (4, "none"), (5, "c")])
    go = lambda version="1", rows=rows, **more: C.through(frame(spark, rows), ["text"], words, path, version, ["id"], **more)
    first = go(rows=rows[:3])
    assert (first.known, first.computed, first.left) == (0, 2, 0)
    second = go()
    assert (second.known, second.computed) == (2, 2) and told(second.records) == want
    third = go()
    assert (third.known, third.computed, third.batch) == (4, 0, None) and told(third.records) == want
    assert {r.batch for r in third.records.collect()} == {first.batch, second.batch}
    other = go("2")
    assert (other.known, other.computed) == (0, 4) and told(other.records) == want
    assert go(rows=[]).records.collect() == []


def test_nothing_is_computed_where_all_is_known(spark, tmp_path):
    path, d = f"file://{tmp_path}/kept", frame(spark, [(1, "a"), (2, "b")])
    C.through(d, ["text"], words, path, "1", ["id"])

    def never(fresh):
        raise AssertionError("called")

    assert told(C.through(d, ["text"], never, path, "1", ["id"]).records) == [(1, "a"), (2, "b")]


def test_budget_and_empty_table(spark, tmp_path):
    path, rows = f"file://{tmp_path}/kept", [(i, f"w{i}") for i in range(10)]
    empty = C.through(frame(spark, []), ["text"], words, path, "1", ["id"])
    assert (empty.known, empty.computed, empty.left) == (0, 0, 0) and empty.records.collect() == []
    assert set(empty.records.columns) == {"id", "text", "word", "batch"}
    none = C.through(frame(spark, rows), ["text"], words, path, "1", ["id"], most=0)
    assert (none.computed, none.left) == (0, 10) and none.records.collect() == []
    for done in (4, 8, 10):
        p = C.through(frame(spark, rows), ["text"], words, path, "1", ["id"], most=4)
        assert (p.known + p.computed, p.left) == (done, 10 - done) and len(told(p.records)) == done
    assert told(p.records) == rows


def test_a_lost_or_doubled_pass_counts_once(spark, tmp_path):
    path, d = f"file://{tmp_path}/kept", frame(spark, [(1, "a b"), (2, "c")])
    C.through(d, ["text"], words, path, "1", ["id"])
    folder = next(str(p) for p in tmp_path.glob("kept/*"))
    records, keys = (spark.read.parquet(f"file://{folder}/{x}") for x in ("records", "keys"))
    lost = records.withColumn("_batch", F.lit("lost"))
    lost.write.parquet(f"file://{folder}/records2")
    spark.read.parquet(f"file://{folder}/records2").write.mode("append").parquet(f"file://{folder}/records")
    assert told(C.through(d, ["text"], words, path, "1", ["id"]).records) == [(1, "a"), (1, "b"), (2, "c")]
    keys.withColumn("_batch", F.lit("lost")).write.parquet(f"file://{folder}/keys2")
    spark.read.parquet(f"file://{folder}/keys2").write.mode("append").parquet(f"file://{folder}/keys")
    again = C.through(d, ["text"], words, path, "1", ["id"])
    assert again.computed == 0 and told(again.records) == [(1, "a"), (1, "b"), (2, "c")]


def test_a_hot_content_is_dealt_and_clashes_are_told(spark, tmp_path):
    d = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 < 2, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    p = C.through(d, ["text"], words, f"file://{tmp_path}/kept", "1", ["id"])
    n = d.filter("text = 'same text'").count()
    assert p.computed == 1 + 20_000 - n and p.records.count() == 20_000 + n
    assert p.records.filter("text = 'same text'").select("id").distinct().count() == n
    with pytest.raises(ValueError, match="word"):
        C.through(d.withColumn("word", F.lit(1)), ["text"], words, f"file://{tmp_path}/kept", "1", ["id"])


def test_contents_and_versions_differ(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", None), (None, ""), (None, None), ("1:a", "")], "x string, y string")
    assert rows.select(C.digest(["x", "y"]).alias("d")).distinct().count() == 6
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    assert C.version_with("1", names("a", "b")) == C.version_with("1", names("b", "a", "a", None))
    assert len({C.version_with("1", names("a", "b")), C.version_with("1", names("a")), C.version_with("2", names("a")), C.version_with("1", names())}) == 4


def slug(name):
    return re.sub("[^a-z0-9]+", "-", re.sub(r"\s+cluster\s*$", "", name.lower())).strip("-")


def by_loop(names, dirs):
    """The tiers one after the other over all directories."""
    known = {}
    for name, path in dirs:
        if name:
            known[name.lower()] = min(path, known.get(name.lower(), path))
    out = {}
    for name in {n for n in names if n is not None}:
        s = slug(name)
        f, found = s.replace("-", ""), {}
        for d in sorted(known) if s else []:
            p = re.sub("(server|client)$", "", d.replace("-", ""))
            n, m = min(len(f), len(p)), min(len(s), len(d))
            if d == s:
                found[(1, 0, 0, d)] = 1
            if p == f:
                found[(2, 0, 0, d)] = 2
            elif p and n >= 6 and (p in f or f in p):
                found[(2, 1, -n, d) if n > 0.7 * len(s) else (5, 0, -n, d)] = 2 if n > 0.7 * len(s) else 5
            if m >= 4 and (d.startswith(s) or s.startswith(d)):
                found[(3, 0, 0, d)] = 3
            if m >= 4 and (d in s or s in d):
                found[(4, 0, -m, d)] = 4
        if found:
            best = min(found)
            out[name] = (known[best[3]], found[best])
    return out


def matched(spark, names, dirs):
    c = spark.createDataFrame([(n, 1) for n in names], "name string, tier int")
    d = spark.createDataFrame(dirs, "name string, path string")
    rows = D.matched(c, d).collect()
    assert len(rows) == len({r.cluster for r in rows})
    return {r.cluster: (r.path, r.tier) for r in rows}


def test_directories_of_each_tier(spark):
    dirs = [("on-off", "/1"), ("DoorLock-Server", "/2"), ("level", "/3"), ("my-fan-unit", "/4"), ("tempmeasureclient", "/5"), ("server", "/6"), ("on-off", "/0"), (None, "/7"), ("", "/8"), ("x", "/9")]
    names = ["On/Off Cluster", "Door Lock", "Level Control", "Fan Unit", "A Very Long Temp Measure Name Indeed", "Nothing", "(?)", "", None, "On/Off Cluster", "X"]
    got = matched(spark, names, dirs)
    assert got == by_loop(names, dirs)
    assert {k: v for k, (_, v) in got.items()} == {"On/Off Cluster": 1, "Door Lock": 2, "Level Control": 3, "Fan Unit": 2, "A Very Long Temp Measure Name Indeed": 5, "X": 1}
    assert got["On/Off Cluster"][0] == "/0" and matched(spark, [], dirs) == {} and matched(spark, names, []) == {}


def test_directories_by_loop(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
    name = lambda glue: glue.join(word() for _ in range(rng.randint(1, 4)))
    names = [name(" ") + rng.choice(["", " Cluster", " cluster "]) for _ in range(150)]
    dirs = [(name(rng.choice(["-", ""])) + rng.choice(["", "", "-server", "client"]), f"/{i}") for i in range(60)]
    got = matched(spark, names, dirs)
    assert got == by_loop(names, dirs) and {t for _, t in got.values()} == {1, 2, 3, 4, 5}


def concatenated(files, most, head, tail):
    """Files one after the other until there is enough, then cut in the middle."""
    out = {}
    for path in {p for p, _, _ in files}:
        parts, n = [], 0
        for _, name, text in sorted((f for f in files if f[0] == path and f[1] is not None), key=lambda f: f[1]):
            if not re.search(r"(?s).\.(cpp|h|hpp|cc)$", name, re.I) or n >= most:
                continue
            parts.append(f"// ===== {name} =====\n{text or ''}")
            n += len(parts[-1])
        whole = "\n\n".join(parts)
        if parts:
            out[path] = (len(parts), whole if len(whole) <= most else whole[:head] + "\n\n// ... (truncated) ...\n\n" + whole[-tail:])
    return out


def test_source_text_by_loop(spark):
    rng = random.Random(5)
    files = [(f"/{rng.randint(0, 12)}", f"f{i}{rng.choice(['.cpp', '.H', '.cc', '.md', '', '.hpp'])}", rng.choice([None, "", "é😀" * rng.randint(1, 40), "x" * rng.randint(0, 90)])) for i in range(120)]
    files += [("/e", ".cpp", "hidden"), ("/n", None, "no name"), ("/m", "a.md", "other"), ("/one", "a.h", "y" * 500), ("/edge", "a.h", "z" * 83), ("/edge2", "a.h", "z" * 84)]
    files += [("/hot", f"{i:05}.cpp", f"text {i}") for i in range(3000)]
    for most, head, tail in ((100, 80, 20), (300, 200, 100)):
        df = spark.createDataFrame([(*f, 0) for f in files], "path string, name string, text string, n_files int")
        got = {r.path: (r.n_files, r.source) for r in D.source_text(df, most, head, tail).collect()}
        assert got == concatenated(files, most, head, tail)
    assert D.source_text(df.limit(0)).collect() == []
