"""Re-ranking of candidates by nine weighted signals, and what leads up to it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import char_windows, flat_name, token_set, tokens

WEIGHTS = V.WEIGHTS
#: Names of a change or a rule, as they are and for comparison.
_CAMEL = r"\b([A-Z][a-z][A-Za-z0-9]{2,})\b"


def combined(signals: dict[str, Column], weights: dict[str, float] = WEIGHTS) -> dict[str, Column]:
    """Each weighted signal to four digits and their sum up to 1."""
    parts = {f"w_{k}": F.round(signals[k] * F.lit(weights[k]), 4) for k in signals}
    total = None
    for p in parts.values():
        total = p if total is None else total + p
    return parts | {"final_score": F.round(F.least(F.lit(1.0), total), 4)}


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _words(text: Column) -> Column:
    """Distinct tokens of a text that is put in lower case first."""
    return F.array_distinct(tokens(F.lower(text)))


def _names(items: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(items, flat_name), lambda x: x != ""))


def _credit(names: Column, declared: Column, words: Column, raw: Column) -> Column:
    """Sum over names: 1 where declared, 0.5 where a word of the text, 0.3 where all parts of the name as written are."""
    found = F.transform(
        names,
        lambda n: F.when(F.array_contains(declared, n), 1.0)
        .when(F.array_contains(words, n), 0.5)
        .when(F.exists(raw, lambda r: (flat_name(r) == n) & (F.size(_parts(r)) > 0) & (F.size(F.array_except(_parts(r), words)) == 0)), 0.3)
        .otherwise(0.0),
    )
    return F.aggregate(found, F.lit(0.0), lambda a, x: a + x)


def _parts(name: Column, least: int = 2) -> Column:
    return F.array_distinct(F.filter(tokens(name), lambda t: F.length(t) >= least))


def entity_overlap(entities: Column, declared: Column, text: Column) -> Column:
    """Share of a change's entities that a candidate declares (1) or its text has (0.5, by parts of the name 0.3)."""
    names = _names(entities)
    score = _credit(names, _names(declared), _words(text), entities)
    return F.when(F.size(names) > 0, F.least(F.lit(1.0), score / F.size(names))).otherwise(0.0)


def cluster_match(cluster: Column, other: Column, text: Column) -> Column:
    """1 for the same name, 0.7 where all its tokens are the other's, half of their share from 0.5, else by the text."""
    own, theirs = _parts(cluster, 3), _parts(other, 3)
    share = F.size(F.array_intersect(own, theirs)) / F.size(own)
    in_text = F.size(F.array_intersect(own, _words(text))) / F.size(own)
    some = F.size(own) > 0
    both = some & (F.size(theirs) > 0)
    return (
        F.when(F.coalesce(cluster, F.lit("")) == "", 0.0)
        .when(flat_name(cluster) == flat_name(other), 1.0)
        .when(both & (share >= 1), 0.7)
        .when(both & (share >= 0.5), 0.5 * share)
        .when(some & (in_text >= 1), 0.4)
        .when(some & (in_text >= 0.5), 0.25)
        .otherwise(0.0)
    )


def condition_overlap(kind: Column, conditions: Column, effects: Column, declared: Column, intents: Column, text: Column) -> Column:
    """How much of a rule's condition and effect entities a candidate covers; 0.2 more for both sides, 0.1 more for a
    declared intent that checks behaviour."""
    found = lambda items: F.array_distinct(F.flatten(F.transform(items, lambda x: F.regexp_extract_all(x, F.lit(_CAMEL), F.lit(1)))))
    raw_c, raw_e = found(conditions), found(effects)
    names_c, names_e = _names(raw_c), _names(raw_e)
    every = F.size(F.array_union(names_c, names_e))
    words, known = _words(text), _names(declared)
    c, e = _credit(names_c, known, words, raw_c), _credit(names_e, known, words, raw_e)
    bonus = F.when((c > 0) & (e > 0), 0.2).otherwise(0.0) + F.when(F.arrays_overlap(F.transform(intents, F.lower), _literal(V.BEHAVIOURAL_INTENTS)), 0.1).otherwise(0.0)
    about = kind.isin(*V.BEHAVIOURAL_KINDS) | (F.size(conditions) > 0) | (F.size(effects) > 0)
    return F.when(about & (every > 0), F.least(F.lit(1.0), (c + e) / every + bonus)).otherwise(0.0)


def _by_kind(kind: Column, table: dict[str, tuple[str, ...]]) -> Column:
    """The table's array for a kind of change; empty for others."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), _literal(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.array().cast("array<string>"))


def intent_match(kind: Column, intents: Column, query: Column, text: Column) -> Column:
    """Share of the intents that matter to a kind of change that a candidate declares; without any, of their keywords in
    its text.  Timing words raise it for protocol changes."""
    wanted = {k: tuple(dict.fromkeys((*v, *V.UNIVERSAL_INTENTS))) for k, v in V.CHANGE_INTENTS.items()}
    relevant = F.coalesce(F.nullif(_by_kind(kind, wanted), F.array().cast("array<string>")), _literal(V.UNIVERSAL_INTENTS))
    words, asked, timing = _words(text), _words(query), _literal(V.TIMING_WORDS)
    base = F.size(F.array_intersect(_names(intents), _names(relevant))) / F.size(relevant)
    protocol = kind == "MODIFY_PROTOCOL"
    declared = base + F.when(protocol & F.arrays_overlap(asked, timing) & F.arrays_overlap(words, timing), 0.3).otherwise(0.0)
    table = {k: tuple(dict.fromkeys(w for i in v for w in i.split("_") if w not in V.STOP_WORDS)) for k, v in V.CHANGE_INTENTS.items()}
    keys = _by_kind(kind, table)
    by_words = F.size(F.array_intersect(keys, words)) / F.greatest(F.size(keys), F.lit(1)) + F.when(protocol & F.arrays_overlap(words, timing), 0.4).otherwise(0.0)
    return F.least(F.lit(1.0), F.when(F.size(intents) > 0, declared).otherwise(by_words))


def lexical(query: Column, text: Column, stop: tuple[str, ...] = V.STOP_WORDS) -> Column:
    """Dice of the tokens that aren't stop words."""
    a, b = (F.array_except(_words(x), _literal(stop)) for x in (query, text))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))).otherwise(0.0)


def chunk_preference(kind: Column) -> Column:
    pairs = [F.lit(x) for item in V.CHUNK_SCORES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(kind)), F.lit(V.OTHER_CHUNK))


#: What a reason calls the signals, in its order; from which share of its weight a signal is named.
_REASONS = {"direct": "direct link in the graph", "indirect": "indirect link in the graph", "entity": "entities", "cluster": "cluster", "condition": "condition and effect", "intent": "intents", "lexical": "wording", "chunk": "kind of chunk", "retrieval": "retrieval"}


def reason(weights: dict[str, float] = WEIGHTS, least: float = 0.5) -> Column:
    """The signals that reach half of their weight; the strongest one where none does."""
    named = F.filter(F.array(*[F.when(F.col(f"w_{k}") >= least * weights[k], F.lit(text)) for k, text in _REASONS.items()]), lambda x: x.isNotNull())
    strongest = F.array_max(F.array(*[F.struct(F.col(f"w_{k}").alias("w"), F.lit(-i).alias("i"), F.lit(text).alias("t")) for i, (k, text) in enumerate(_REASONS.items())]))
    return F.when(F.size(named) > 0, F.array_join(named, "; ")).otherwise(F.concat(F.lit("weak: "), strongest.t))


def rerank(changes: DataFrame, candidates: DataFrame, hits: DataFrame | None = None, top_n: int | None = 10, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """(change_id, test_case_id, candidate_id, chunk_type, title, w_..., final_score, reason, rank).

    ``changes``: change_id, change_kind, cluster, entities, conditions, effects (arrays of strings), query_text.
    ``candidates``: change_id, candidate_id, test_case_id, chunk_type, title, text, score, cluster, entities, intents.
    ``hits``: change_id, test_case_id, direct (boolean): tests that the graph links; a direct link goes before others.
    Of a test case's chunks the best one stays, the first of equals by candidate_id; ranks go by the score to two digits,
    then by test case.  Nulls count as empty; a candidate whose change isn't there is left out.
    """
    texts = lambda df, *cols: [F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols]
    lists = lambda df, *cols: [F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c) for c in cols]
    ch = changes.select("change_id", *texts(changes, "change_kind", "query_text"), F.coalesce("cluster", F.lit("")).alias("change_cluster"), *lists(changes, "conditions", "effects"), F.coalesce("entities", F.array().cast("array<string>")).alias("change_entities"))
    ca = candidates.select("change_id", "candidate_id", *texts(candidates, "test_case_id", "chunk_type", "title", "text", "cluster"), *lists(candidates, "entities", "intents"), F.coalesce("score", F.lit(0.0)).alias("score"))
    j = ca.join(ch, "change_id").withColumn("key", F.lower("test_case_id"))
    if hits is not None:
        h = hits.groupBy("change_id", F.lower("test_case_id").alias("key")).agg(F.max(F.col("direct").cast("int")).alias("link"))
        j = j.join(h, ["change_id", "key"], "left")
    else:
        j = j.withColumn("link", F.lit(None).cast("int"))
    c = F.col
    signals = {
        "entity": entity_overlap(c("change_entities"), c("entities"), c("text")),
        "cluster": cluster_match(c("change_cluster"), c("cluster"), c("text")),
        "condition": condition_overlap(c("change_kind"), c("conditions"), c("effects"), c("entities"), c("intents"), c("text")),
        "intent": intent_match(c("change_kind"), c("intents"), c("query_text"), c("text")),
        "direct": F.when(c("link") == 1, 1.0).otherwise(0.0),
        "indirect": F.when(c("link") == 0, 1.0).otherwise(0.0),
        "lexical": lexical(c("query_text"), c("text")),
        "chunk": chunk_preference(c("chunk_type")),
        "retrieval": F.least(F.lit(1.0), c("score")),
    }
    parts = combined(signals, weights)
    parts.pop("final_score")
    scored = j.withColumns(parts)
    total = sum((F.col(p) for p in parts), F.lit(0.0))
    scored = scored.withColumn("final_score", F.round(F.least(F.lit(1.0), total), 4))
    scored = scored.withColumn("reason", reason(weights))
    best = best_chunk(scored, ["change_id", "key"], "final_score", "candidate_id")
    cols = ["change_id", "test_case_id", "candidate_id", "chunk_type", "title", *parts, "final_score", "reason"]
    return top(best, ["change_id"], "final_score", "test_case_id", top_n or 2**31 - 1).select(*cols, "rank")


def siblings(ranked: DataFrame, tests: DataFrame, edges: DataFrame) -> DataFrame:
    """(change_id, test_case_id, of): tests of the clusters that share a base, over alias edges, with a ranked test's.

    ``tests``: test_case_id, cluster.  ``edges``: src, dst, edge_type; an alias points to its base.  Ranked tests don't
    come back.
    """
    family = edges.filter("edge_type = 'alias_of'").select(F.col("src").alias("member"), F.col("dst").alias("base"))
    family = family.unionByName(family.select(F.col("base").alias("member"), "base")).distinct()
    kin = family.join(family.withColumnRenamed("member", "other"), "base").filter("member != other").select("member", "other").distinct()
    own = ranked.select("change_id", F.col("test_case_id").alias("of")).join(tests.select(F.col("test_case_id").alias("of"), F.concat(F.lit("CLUSTER::"), "cluster").alias("member")), "of")
    found = own.join(kin, "member").join(tests.select("test_case_id", F.concat(F.lit("CLUSTER::"), "cluster").alias("other")), "other")
    found = found.groupBy("change_id", "test_case_id").agg(F.min("of").alias("of"))
    return found.join(ranked.select("change_id", "test_case_id"), ["change_id", "test_case_id"], "left_anti")


def best_chunk(df: DataFrame, group: list[str], score: str, position: str) -> DataFrame:
    """The best chunk of each document, the first of equals."""
    w = Window.partitionBy(*group).orderBy(F.desc(score), position)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top(df: DataFrame, group: list[str], score: str, key: str, n: int, digits: int = 2) -> DataFrame:
    """By rounded score, then key."""
    w = Window.partitionBy(*group).orderBy(F.round(score, digits).desc(), key)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


#: Bytes of the items' postings up to which they are sent to every task; beyond, tokens are joined.
SMALL = 64 << 20
#: Cells of a slice's table of chunks and items, and documents of a slice whose pairs are held until they go out.
CELLS, SLICE = 1 << 20, 1024


def best_chunks(docs: DataFrame, items: DataFrame, size: int = 1000, overlap: int = 200, stop: tuple[str, ...] = V.STOP_WORDS, top_n: int | None = None, small: int = SMALL) -> DataFrame:
    """(item_id, doc_id, pos, dice): for each item and document with a token in common the chunk with the highest Dice of
    distinct tokens, to six digits, the first of equals; tokens in ``stop`` don't count on either side.

    ``docs``: doc_id, text; ``items``: item_id, text.  With ``top_n`` only pairs that can be among an item's first so many by
    Dice to two digits, then id, need come out, and some others.  Nulls count as empty.

    A document's chunks and the items meet in the task that reads the document: the items' postings, whose size is measured
    first, go to every task, so no row for a chunk and token is shuffled.  Beyond ``small`` bytes tokens are joined.
    """
    tokens_of = lambda c: F.array_except(token_set(c), _literal(stop))
    windows = dealt(docs).select("doc_id", F.explode(F.array(char_windows(F.coalesce("text", F.lit("")), size, overlap))).alias("w"))
    sets = items.select("item_id", tokens_of(F.coalesce("text", F.lit(""))).alias("t"))
    weight = sets.agg(F.sum(F.aggregate("t", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 24))).first()[0] or 0
    if weight > small:
        left = windows.select("doc_id", F.explode("w").alias("c")).select(F.struct("doc_id", F.col("c.start").alias("pos")).alias("lid"), F.explode(tokens_of(F.col("c.chunk"))).alias("token"))
        right = sets.select(F.col("item_id").alias("rid"), F.explode("t").alias("token"))
        d = token_dice(left, right).select(F.col("rid").alias("item_id"), "lid.doc_id", "lid.pos", "dice")
        return best_chunk(d, ["item_id", "doc_id"], "dice", "pos")
    rows = sets.filter(F.size("t") > 0).orderBy("item_id").collect()  # ``small`` bytes of tokens at most
    words = sorted({w for r in rows for w in r.t})
    place = {w: i for i, w in enumerate(words)}
    pairs = np.array(sorted((place[w], i) for i, r in enumerate(rows) for w in r.t), np.int64).reshape(-1, 2)
    start = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
    shared = docs.sparkSession.sparkContext.broadcast((words, start, pairs[:, 1], np.array([len(r.t) for r in rows], np.int64)))
    id_types = [df.schema[c].dataType.simpleString() for df, c in ((items, "item_id"), (docs, "doc_id"))]
    out = f"item int, doc_id {id_types[1]}, pos int, dice double"
    thin = windows.select("doc_id", F.transform("w", lambda c: c.start).alias("pos"), F.transform("w", lambda c: tokens_of(c.chunk)).alias("t"))
    found = thin.mapInArrow(_matched(shared, top_n), out) if len(rows) else docs.sparkSession.createDataFrame([], out)
    numbers = docs.sparkSession.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {id_types[0]}")
    return found.join(F.broadcast(numbers), "item").select("item_id", "doc_id", "pos", "dice")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores where its files give fewer; large inputs have more and stay."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def _matched(shared, top_n: int | None):
    def run(batches):
        words, start, item, n_item = shared.value
        vocabulary, many = pa.array(words, pa.string()), len(n_item)
        for b in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            lists, docs = b.column("t"), b.column("doc_id")
            chunks = lists.flatten()  # a list of tokens for each chunk
            first = np.concatenate([[0], np.cumsum([len(x) for x in b.column("pos")])]).astype(np.int64)
            pos = b.column("pos").flatten().to_numpy(False)
            size = np.asarray(chunks.value_lengths().fill_null(0), np.int64) if len(chunks) else np.zeros(0, np.int64)
            token = pc.index_in(chunks.flatten(), vocabulary).fill_null(-1).to_numpy(False)
            edge = np.concatenate([[0], np.cumsum(size)])
            out, step = [], max(1, CELLS // many)
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + step, "right")) - 1)
                c0, c1 = int(first[lo]), int(first[hi])
                own = token[edge[c0] : edge[c1]]
                chunk = np.repeat(np.arange(c1 - c0), size[c0:c1])[own >= 0]
                own = own[own >= 0]
                n = start[own + 1] - start[own]
                hit = np.repeat(start[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(np.repeat(chunk, n) * many + item[hit], minlength=(c1 - c0) * many).reshape(c1 - c0, many)
                total = size[c0:c1, None] + n_item[None, :]
                # in millionths, halves up
                dice = (4_000_000 * both + total) // (2 * total)
                for d in range(lo, hi):
                    x, y = int(first[d]) - c0, int(first[d + 1]) - c0
                    if x == y:
                        continue
                    best = dice[x:y].argmax(0)
                    at = np.arange(many)
                    some = np.flatnonzero((both[x:y] > 0).any(0))
                    # a shared token that rounds to nothing still makes a pair: its first chunk
                    zero = some[dice[x:y][best[some], some] == 0]
                    best[zero] = (both[x:y][:, zero] > 0).argmax(0)
                    out.append((some, np.full(len(some), d), pos[c0 + x + best[some]], dice[x:y][best[some], at[some]]))
                lo = hi
            if not out:
                continue
            i, d, p, m = (np.concatenate(x) for x in zip(*out, strict=True))
            if top_n:
                by_id = pc.rank(docs, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(False)
                order = np.lexsort((by_id[d], -((m + 5000) // 10000), i))
                i, d, p, m = i[order], d[order], p[order], m[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < top_n
                i, d, p, m = i[keep], d[keep], p[keep], m[keep]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), docs.take(pa.array(d)), pa.array(p, pa.int32()), pa.array(m / 1e6)], ["item", "doc_id", "pos", "dice"])

    return run


def token_dice(left: DataFrame, right: DataFrame) -> DataFrame:
    """(lid, rid, dice) of all pairs with a common token, from (lid, token) and (rid, token): an equi-join on tokens, so
    no cross join."""
    na, nb = left.groupBy("lid").agg(F.count("*").alias("na")), right.groupBy("rid").agg(F.count("*").alias("nb"))
    both = left.join(right, "token").groupBy("lid", "rid").agg(F.count("*").alias("both"))
    return both.join(na, "lid").join(nb, "rid").select("lid", "rid", F.round(2.0 * F.col("both") / (F.col("na") + F.col("nb")), 6).alias("dice"))
