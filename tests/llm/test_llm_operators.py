"""Each training-data operator on small tables with nulls, empty and very long texts, ties, repeats and clashing columns."""

import hashlib
import os
import random
import zlib
from itertools import combinations
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import binary, chat, mixing, neardup, packing, queries, rules, shared, substring, tokens, topk, toxicity
from quillgraph.llm.tokenize import located

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n_words long, did long"


def words(t):
    return (t or "").encode().split()


def corpus():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared, base = say(60), say(200)
    near = base.split()
    near[100] = "other"
    out = [None, "", " \t\n", "one", "x" * 5000, base, base, " ".join(near), "  " + base.upper() + "\n", say(4000), "é ü\x0bñ z"]
    out += [f"{say(30)}\n{shared} {say(20)}" for _ in range(8)] + [f"{shared} {shared}", "spam " * 120, "# $ % " * 30]
    return [(i, t, "en", [None, "a", "b", "c"][i % 4], len(t or ""), "r", 5, 6) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def messy(spark):
    """Repeated ids and rows, and null ids."""
    rows = corpus()
    extra = [(None, *rows[5][1:]), (None, "a b c", *rows[5][2:]), (5, "another text", *rows[5][2:]), rows[7], rows[7]]
    return spark.createDataFrame(rows + extra, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring(docs):
    seen, want = set(), {}
    for i, t, *_ in corpus():
        w, gone = words(t), set()
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            gone |= set(range(s, s + 20)) if k in seen else set()
            seen.add(k)
        want[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest())
    assert {r[0]: tuple(r[1:]) for r in substring.op1(docs).collect()} == want
    small = substring.substring_dedup(docs, bucket_bytes=500)
    assert {r.row.doc_id: r.n_removed for r in small.collect()} == {i: v[1] for i, v in want.items()}


def test_substring_of_hot_phrases(docs, monkeypatch):
    """The same result where every anchor counts as hot, so that its phrases are salted."""
    want = sorted(substring.op1(docs).collect())
    monkeypatch.setattr(substring, "PROBE", 1)
    monkeypatch.setattr(substring, "max", lambda *_: 1, raising=False)
    assert sorted(substring.op1(docs).collect()) == want


def test_substring_keeps_the_layout(spark):
    r = random.Random(9)
    passage = " ".join(f"p{r.randrange(10**6)}" for _ in range(30))
    rows = [(1, passage), (2, f"HEAD\n\n- item\n\n{passage}\n\ntail\tend"), (3, f" a\n{passage}"), (4, None), (5, passage), (6, "x \n y")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring.stage(spark, d, "").collect()}
    assert got == {1: passage, 2: "HEAD\n\n- item\n\ntail\tend", 3: " a\n", 4: None, 6: "x \n y"}


def test_tokens(spark, docs, tmp_path):
    import sentencepiece
    from tokenizers import Tokenizer

    model = sentencepiece.SentencePieceProcessor(model_file=located(tokens.MODEL))
    want = {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t, *_ in corpus()}
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):  # the second time from the cache
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.token_counts(docs, cache=cache).collect()} == want
    texts = [t for _, t, *_ in corpus()]
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    other = Tokenizer.from_file(located(packing.MODEL))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, packing.MODEL).collect()}
    assert got == {i: len(other.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_mixing(docs):
    got = {r.doc_id: r for r in mixing.op3(docs).collect()}
    sizes = {i: len(words(t)) for i, t, *_ in corpus()}
    assert {i: r["size"] for i, r in got.items()} == sizes
    by = {s: [r for i, r in got.items() if corpus()[i][3] == s] for s in ("a", "b", "c", None)}
    weight, total = {"a": 5, "b": 2, "c": 1, None: 5}, 1.5 * sum(sizes.values())
    limit = {s: 2 * rs[0].source_size for s, rs in by.items()}
    target, open_ = {}, set(by)
    while open_:  # share what is left by weight; who is above its limit stays there
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > limit[s]}
        target |= {s: limit[s] for s in over} if over else share
        open_ = open_ - over if over else set()
    for s, rs in by.items():
        assert rs[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in rs) - target[s]) <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in got.values())
    assert sorted(mixing.op3(docs).collect()) == sorted(mixing.op3(docs.repartition(5)).collect())
    mixed = mixing.mix(docs).collect()
    assert [r.finish for r in mixed] == sorted(r.finish for r in mixed)
    assert sum(r.words for r in mixed) == sum(r.taken for r in got.values())


def test_mixing_queue(spark):
    """Taken words against a queue built plainly: finish times, one sorted list, a cut at the budget."""
    r = random.Random(3)
    rows = [(i, "w " * r.randrange(0, 90), f"s{i % 7 if i % 3 else 0}") for i in range(120)]
    rows += [(7, "a b c", "s1"), (7, "a b c", "s1"), (None, "d e", None), (None, "d e", None), (8, rows[8][1], rows[8][2])]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.op3(d).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0, x["size"]) for x in got) == sorted((i is None, i or 0, len(t.split())) for i, t, _ in rows)
    entries = mixing.queue(d).collect()
    budget = int(1.5 * sum(len(t.split()) for _, t, _ in rows))
    past = 0
    for e in sorted(entries, key=lambda e: (e.finish, e.id is not None, e.id or 0, e.key, e.twin, e.copy, e.packet)):
        assert e.taken == max(0, min(e.words, budget - past))
        past += e.words
    # finish times are those of each source serving its documents in one order, twice
    for s in {e.source for e in entries}:
        at = 0
        for e in sorted((e for e in entries if e.source == s and e.words), key=lambda e: (e.finish, e.packet)):
            at += e.words
            assert e.finish == pytest.approx(at / e.target)
    for s in {x[2] for x in rows}:
        own = [e for e in entries if e.source == s]
        assert abs(sum(e.taken for e in own) - own[0].target) <= 2 * mixing.PACKET
    # repeated rows are documents of their own, and other columns tell them apart in the mix
    assert sum(x.doc_id == 7 and x["size"] == 3 for x in got) == 2
    mixed = mixing.mix(d).collect()
    assert sum(x.words for x in mixed) == sum(x.taken for x in got)
    assert [x.finish for x in mixed] == sorted(x.finish for x in mixed)


def test_risk_and_its_gradient():
    """The learner's step against the plain risk, by differences, with the bracket positive and negative."""
    r = np.random.default_rng(1)
    vocabulary = np.arange(6, dtype=np.uint64)
    pick = lambda n, p: [np.flatnonzero(r.random(6) < p).astype(np.uint64) for _ in range(n)]
    p, u = toxicity.Sparse(pick(20, 0.6), vocabulary), toxicity.Sparse(pick(50, 0.3), vocabulary)
    for prior, w in ((0.1, r.normal(size=7)), (0.5, r.normal(size=7)), (0.9, np.full(7, 3.0) * [1, 1, 1, 1, 1, 1, -3])):
        scores = lambda x, w: 1 / (1 + np.exp(-(x.times(w[:6]) + w[6])))
        plain = lambda w: prior * -np.log(scores(p, w)).mean() + max(0, -np.log(1 - scores(u, w)).mean() + prior * np.log(1 - scores(p, w)).mean())
        assert toxicity.risk(scores(p, w), scores(u, w), prior) == pytest.approx(plain(w))
        bracket = lambda w: -np.log(1 - scores(u, w)).mean() + prior * np.log(1 - scores(p, w)).mean()
        f = plain if bracket(w) >= 0 else (lambda w: -bracket(w))
        near = [(f(w + d) - f(w - d)) / 2e-6 for d in np.eye(7) * 1e-6]
        assert toxicity._gradient(p, u, w, 6, prior) == pytest.approx(near, abs=1e-6)
    w, b = toxicity.nn_pu(p, u, 6, 0.3)
    learnt = toxicity.risk(toxicity._sigmoid(p.times(w) + b), toxicity._sigmoid(u.times(w) + b), 0.3)
    assert learnt < toxicity.risk(np.full(20, 0.5), np.full(50, 0.5), 0.3)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (None, None, 6), (2, "x" * 300_000, 7)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.op4(docs, labels).collect()
    assert len(got) == 4 and {x.score for x in got} == {0.5}
    assert toxicity.op4(docs.filter("false"), labels).count() == 0


def test_toxicity(spark):
    r = random.Random(8)
    bad, rows, marks = ["vile", "fool", "nasty"], [], []
    for i in range(900):
        w = [f"w{r.randrange(150)}" for _ in range(30)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w[r.randrange(30)] = r.choice(bad) + r.choice(["", ",", "!"])
        rows.append((i, " ".join(w)))
        marks += [(i, 1, int(toxic))] if i % 3 else [(i, 1, int(toxic)), (i, None, None)]
    rows += [(9001, None), (9002, ""), (None, "vile fool nasty")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.op4(docs, labels).collect()
    assert len(got) == len(rows)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 900 and x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got if x.doc_id is not None)
    assert sum(x.predicted == (x.doc_id % 6 == 0) for x in held) / len(held) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got)
    assert {x.predicted for x in got if x.doc_id in (9001, 9002)} == {0}
    assert toxicity.op4(docs, labels.filter("false")).count() == len(rows)


def test_packing(docs):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(located(packing.MODEL))
    ids = {i: [*other.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in corpus()}
    pieces = packing.op5(docs).collect()
    for i, want in ids.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert sum(p.length for p in own) == len(want) == own[0].doc_tokens
        at = 0
        for p in own:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(want[at : at + p.length], "<u4").tobytes())
            at += p.length
    for s in {p.sequence_id for p in pieces}:
        own, at = sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset), 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at & (at - 1) == 0 and at <= 2048


def test_capacities():
    r = random.Random(2)
    for _ in range(30):
        tree, open_ = packing.Capacities(50), []
        for _ in range(200):
            if r.random() < 0.5:
                c = r.randint(0, 50)
                tree.put(c, c)
                open_.append(c)
            else:
                need = r.randint(0, 50)
                want = min((c for c in open_ if c >= need), default=None)
                got = tree.take(need)
                assert (got and got[0]) == want
                if got:
                    open_.remove(want)


def test_matrices(docs):
    rows = binary.id_matrices(docs, window=64).collect()
    ids, positions = binary.read_matrix(rows)
    found = {}
    for r, line, pos in zip(rows, ids, positions, strict=True):
        assert (pos[r.position_resets] == 0).all()
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            found.setdefault(d, {})[s] = line[a:b]
    for p in packing.packed_pieces(docs, window=1 << 20).collect():
        assert b"".join(x.astype("<u4").tobytes() for _, x in sorted(found[p.doc_id].items()))[4 * p.start : 4 * (p.start + p.length)] == p.ids


def test_written_matrices(docs, messy, empty):
    """op9's rows against the tokenizer: each document's ids, joined from its segments, and windows without overlap."""
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(located(packing.MODEL))
    for table in (docs, messy):
        want = sorted([*other.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table.select("text").collect())
        full = binary.id_matrices(table).collect()
        crc = {r.sequence_id: r.ids_crc32 for r in binary.op9(table).collect()}
        pieces = {}
        for r in full:
            ids = np.frombuffer(r.input_ids, "<u4")
            assert len(ids) == binary.WINDOW and (ids[r.n_tokens :] == 0).all() and r.cu_seqlens[-1] == r.n_tokens
            assert crc[r.sequence_id] == zlib.crc32(r.input_ids[: 4 * r.n_tokens]) and r.position_resets == r.cu_seqlens[:-1]
            for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
                pieces.setdefault(d, []).append((s, ids[a:b].tolist()))
        assert sum(map(len, want)) == sum(r.n_tokens for r in full)
        for own in pieces.values():
            own.sort(key=lambda x: x[0])
            if [s for s, _ in own].count(0) == 1:  # the id's only document
                assert [i for _, x in own for i in x] in want
            else:
                assert sorted(i for _, x in own for i in x) in [sorted(i for x in c for i in x) for n in range(2, 5) for c in combinations(want, n) if sum(map(len, c)) == sum(len(x) for _, x in own)]
    assert binary.op9(empty).count() == 0


def test_top_k_of_repeated_rows(spark):
    """Rows that share an id are rows of their own, as queries and as candidates."""
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (100, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(x) for x in topk.op6(v).collect())
    want = []
    for n, (q, x) in enumerate(rows):
        if q % 50 == 0:
            found = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(x, y)), c) for m, (c, y) in enumerate(rows) if m != n and len(x) == len(y))
            want += [(q, i, c, -s) for i, (s, c) in enumerate(found[:5], 1)]
    assert got == sorted(want)
    huge = spark.createDataFrame([(0, [3e9, 1.0]), (1, [2e9, 1.0]), (2, [-3e9, 5.0])], "vec_id long, embedding array<double>")
    assert [(x["rank"], x.vec_id) for x in topk.op6(huge).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_top_k(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=16)]) for i in range(300)]
    rows += [(300, None), (301, [None] * 16), (302, [float("nan")] * 16), (350, [float("inf")] * 16), (None, rows[0][1]), (400, rows[0][1]), (401, rows[0][1]), (450, [1.0, 2.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in topk.op6(v).collect()}
    fine = {i: np.floor(256 * np.array(x, np.float32).astype(float)).astype(int) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all()}
    want = {}
    for q in fine:
        if q % 50 == 0:
            best = sorted((-int(fine[q] @ x), i) for i, x in fine.items() if i != q and len(x) == len(fine[q]))[:5]
            want |= {(q, n): (i, -s) for n, (s, i) in enumerate(best, 1)}
    assert got == want
    assert topk.op6(v.filter("false")).count() == 0


def test_near_duplicates(docs):
    rows = corpus()
    for k in (2, 5):
        sets = {}
        for i, t, *_ in rows:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        comp = {i: i for i in sets}
        for _ in sets:
            for a in sets:
                for b in sets:
                    if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        comp[a] = comp[b] = min(comp[a], comp[b])
        got = {r.row.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, k).collect()}
        assert got == {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


def test_near_dedup_of_repeated_rows(spark, messy):
    """Rows alike in id, null ids too, and text are one document, and one of them stays."""
    extra = [(None, "a b c", "en", "a", 5, "r", 5, 6)] * 2
    out = neardup.stage(spark, messy.unionAll(spark.createDataFrame(extra, SCHEMA)), "").select("doc_id", "text").collect()
    got = [tuple(x) for x in out]
    assert len(got) == len(set(got))
    assert got.count((None, "a b c")) == 1 and [t for _, t in got].count(corpus()[5][1]) == 1
    alone = [(70, "one two three"), (70, "one two three"), (70, "one two three"), (71, "one two three"), (72, None), (72, None)]
    plain = spark.createDataFrame(alone, "doc_id long, text string")
    assert sorted(map(str, neardup.stage(spark, plain, "").collect())) == ["Row(doc_id=70, text='one two three')", "Row(doc_id=72, text=None)"]


def test_chat(spark):
    rows = [(1, 1, "assistant", "a <|im_end|> <\\| b"), (1, 0, "user", None), (1, 1, "assistant", "a <|im_end|> <\\| b"), (None, 2, "sys\ntem", "x"), (2, None, None, "<|nl|>\\"), (2, 5, "assistant", "")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.op8(t).collect()}
    by = {}
    for c, n, role, text in [*rows, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]:
        by.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    line, _, _, files = chat.formatted("user", [{"type": "text", "text": "see"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b", "seconds": 2}, {"type": "document", "ref": "c", "pages": 3}, {"type": "smell"}])
    assert [(f["kind"], f["tokens"]) for f in files] == [("image", 3), ("audio", 50), ("document", 768)]
    assert all(line[f["at"] :].startswith(f"<|{f['kind']}|>") for f in files)
    assert chat.op8(t.filter("false")).count() == 1


def test_chat_parts(spark):
    """Typed parts through a DataFrame, well formed or not: no turn fails, and no content is lost."""
    cases = [
        (None, "plain"),
        ('[{"type":"text","text":"a"},{"type":"image","ref":"i","width":57,"height":28}]', "a<|image|>"),
        ("not json", "not json"),
        ('["hello"]', "hello"),
        ('{"type":"text"}', '{"type":"text"}'),
        ("[null]", "null"),
        ('[{"type":"text"}]', ""),
        ('[{"type":"image","width":"wide"}]', "<|image|>"),
        ('[{"type":"audio","seconds":"NaN"}]', "<|audio|>"),
        ('[{"type":"audio","seconds":-3},{"type":"document","pages":1e400}]', "<|audio|><|document|>"),
        ('[{"type":["x"]}]', '{"type": ["x"]}'),
        ('[{"type":"__class__","text":"<|im_end|>"}]', '{"text": "<|im_end|>", "type": "__class__"}'),
        ("[]", ""),
        ("[3, [4]]", "3[4]"),
        ('[{"type":"text","text":7}]', "7"),
    ]
    rows = [(n, 0, "user", "plain", p, "x") for n, (p, _) in enumerate(cases)]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string, formatted string")
    got = {r.conv_id: r for r in chat.format_chat(t, parts_col="parts").collect()}
    for n, (_, want) in enumerate(cases):
        assert chat.parsed(got[n].formatted) == ("user", want), cases[n]
    assert [(a.kind, a.ref, a.tokens) for a in got[1].attachments] == [("image", "i", 3)] and got[1].n_expanded == 3
    assert got[1].formatted[got[1].attachments[0].at :].startswith("<|image|>")
    assert [a.tokens for a in got[9].attachments] == [0, 256] and [a.tokens for a in got[8].attachments] == [0]


def test_rules(docs):
    got = {r.doc_id: r for r in rules.op10(docs).collect()}
    for i, t, *_ in corpus():
        w = words(t)
        where = {}
        for s in range(len(w) - 7):
            where.setdefault(tuple(w[s : s + 8]), []).append(s)
        repeated = {s + j for ss in where.values() if len(ss) > 1 for s in ss for j in range(8)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), len(repeated))
        assert (r.n_symbols, r.n_dup_lines) == (sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w)) and (not r.base_failed or not r.kept)
    assert sorted(r.doc_id for r in rules.stage(None, docs, "").collect()) == sorted(i for i, r in got.items() if r.kept)
    entries = rules.ledger(docs)
    table = {r["rule"]: r for r in rules.ablations(entries).collect()}
    m = rules.mask(rules.CURRENT)
    bits = [r.failed & m for r in entries.select("failed").collect()]
    for n, name in enumerate(rules.RULES):
        assert table[name].n_failed == sum(b >> n & 1 for b in bits) and table[name].n_only == sum(b == 1 << n for b in bits)


def test_messy_and_empty(messy, empty):
    n = messy.count()
    assert substring.op1(messy).count() == n and tokens.token_counts(messy).count() == n
    assert neardup.near_duplicates(messy).count() == n and rules.op10(messy).count() == n
    assert len({r.sequence_id for r in packing.op5(messy).collect()}) > 1 and binary.op9(messy).count() > 0
    assert mixing.op3(messy).count() == n
    for f in (substring.op1, tokens.token_counts, neardup.op7, rules.op10, packing.op5, binary.op9, mixing.op3):
        assert f(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_shared_folder_has_to_be_named():
    conf = SimpleNamespace(get=lambda k, d=None: d)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="x"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(session)
    session.sparkContext.master = "local[2]"
    assert shared.shared_dir(session) == shared.shared_dir(session)


def test_running_sums(spark):
    r = random.Random(6)
    rows = [(r.randrange(5), i, r.randrange(100)) for i in range(3000)]
    d = spark.createDataFrame(rows, "k int, i int, v long")
    past, want = 0, {}
    for k, i, v in sorted(rows):
        want[i] = past
        past += v
    got = shared.running(d, ["k", "i"], ["v"], len(rows), "t", rows=100)
    assert {x.i: x.before_v for x in got.collect()} == want


def test_near_dedup_of_large_bands(spark, monkeypatch):
    """Blocks of few documents, and every key hot: the same components as by brute force."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "max", lambda *_: 2, raising=False)
    r = random.Random(12)
    base = [f"w{r.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in r.sample(range(60), r.randrange(0, 16)):
            w[j] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[j : j + 2]) for j in range(59)} for i, t in rows}
    comp = dict(zip(sets, sets, strict=True))
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert 1 < len(set(comp.values())) < 60
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.row.doc_id: x.component_id for x in neardup.near_duplicates(d, 2, rounds=1).collect()}
    assert got == comp


def test_stages(spark, docs, messy, empty):
    """Each stage against brute force on its own input, with null, empty, long, tied and repeated rows."""
    table = messy.select("doc_id", "text", "lang", "source", "n_chars")
    rows = table.collect()
    # near-dedup: of each component by five words one row stays
    found = neardup.stage(spark, table, "")
    assert found.columns == mixing.stage(spark, table, "").columns == substring.stage(spark, table, "").columns == table.columns
    found = found.collect()
    sets = []
    for x in sorted({(x.doc_id if x.doc_id is not None else -1, x.text or "") for x in rows}):
        w = [y.lower() for y in words(x[1])]
        sets.append((x, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    left = []
    comp = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                s, u = sets[a][1], sets[b][1]
                if s and u and 100 * len(s & u) >= 80 * len(s | u):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert len(found) == len(set(comp))
    for c in set(comp):
        least = min(sets[i][0][0] for i in range(len(sets)) if comp[i] == c)
        assert any((x.doc_id if x.doc_id is not None else -1) == least and any(sets[i][0] == (least, x.text or "") for i in range(len(sets)) if comp[i] == c) for x in found)
    # substring dedup: the words left in each row, on unique ids
    seen = set()
    for x in sorted(docs.collect()):
        w, gone = words(x.text), set()
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            gone |= set(range(s, s + 20)) if k in seen else set()
            seen.add(k)
        if not w or len(gone) < len(w):
            left.append((x.doc_id, [y for j, y in enumerate(w) if j not in gone]))
    assert sorted((x.doc_id, words(x.text)) for x in substring.stage(spark, docs, "").collect()) == left
    assert substring.stage(spark, table, "").count() > 0
    # mixing: each copy is a document or, at the cut, its first words
    mixed = mixing.stage(spark, table, "").collect()
    sizes = sum(len(words(x.text)) for x in rows)
    assert sum(len(words(x.text)) for x in mixed) == int(1.5 * sizes)
    texts = {}
    for x in rows:
        texts.setdefault(x.doc_id, []).append(words(x.text))
    assert all(any(words(x.text) == w[: len(words(x.text))] for w in texts[x.doc_id]) and x.n_chars == len(x.text) for x in mixed)
    # packing: every id once
    packed = packing.stage(spark, table, "").collect()
    assert sum(x.length for x in packed) == sum(x.doc_tokens for x in packed if x.start == 0)
    for stage in (rules.stage, neardup.stage, substring.stage, mixing.stage, packing.stage):
        assert stage(spark, empty.select(*table.columns), "").count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = c.sql(queries.oracle_sql()[name])
    names = want.columns
    assert sorted(names) == cols
    plain = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert plain([r[x] for x in cols] for r in df.collect()) == plain([dict(zip(names, r, strict=True))[x] for x in cols] for r in want.fetchall())


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    os.makedirs(tmp_path / "sf")
    plain.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    out = corpus_pipeline.run(spark, f"file://{tmp_path}/sf")
    # the packed tokens are those of the mix
    assert sum(r.doc_tokens for r in out.filter("start = 0").collect()) == sum(r.length for r in out.collect()) > 0
    os.makedirs(tmp_path / "none")
    plain.filter("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").count() == 0
