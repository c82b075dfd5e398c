"""A table of requests in, a table of answers out: the declared queries on the property graph, one plan for each kind.

Requests: request_id, kind, and what the kind needs of cluster, entity_type, entity_name, keywords (array), direction, most.
Nodes: node_id, node_type, label, cluster, text (what keywords are looked for in).  Edges: src, dst, edge_type.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import trigrams
from .lineage import cut, shares
from .ranges import numbered

#: The kinds with what they need, the planner's intents, words that make no phrase, and edges that count.
NEEDS = {"cluster_tests": ("cluster",), "phrase_tests": ("phrase",), "entity_coverage": ("entity_name",), "requirements": ("words",), "dependencies": ("cluster",), "keywords": ("words",)}
#: What the answers of each kind depend on.
ASKS = {"cluster_tests": ("cluster",), "phrase_tests": ("phrase",), "entity_coverage": ("cluster", "entity_type", "entity_name"), "requirements": ("cluster", "words"), "dependencies": ("cluster", "direction"), "keywords": ("cluster", "words", "most")}
PLAIN_WORDS = ("test", "cases", "case", "tc", "use", "uses", "using", "which", "what")
OF_CLUSTER = ("tests", "in_context")
OF_ENTITY = ("tests_command", "verifies_attribute", "observes_event", "tests", "covers", "validates")
DEPENDS = ("depends_on", "requires", "references", "related_to")
SPECS = ("requirement", "behavior_rule")
#: Ends asked for up to which they go to every task; beyond, edges may be shuffled to them.
SENT = 1 << 17
#: Answers to one question that are dealt together to meet the requests that ask it, and answers for a task.
BLOCK, SHARE = 1 << 12, 1 << 15
MOST_REQUIREMENTS, MOST_TESTS, MOST_HITS, DEFAULT_HITS = 20, 5, 30, 10

_ANSWER = "request_id", "status", "at", "of", "node_id"
#: Of a kind's questions: types of edges that tell their answers, the ends (one column) that these point to, and the answers
#: by a table of such edges.
_Asked = tuple[tuple[str, ...], DataFrame | None, Callable[[DataFrame], DataFrame]]


def _low(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def _norm(c: Column) -> Column:
    return F.trim(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(" cluster"), F.lit("")))


def planned(plans: DataFrame) -> DataFrame:
    """Requests of a planner's plans, which have ``intent`` in place of kind.

    list_test_cases asks for a cluster's tests, without a cluster for tests with a phrase; entity_coverage needs a name,
    graph_traversal a cluster; everything else, other intents and null among it, is a search by keywords.
    """
    has = lambda c: _low(c) != ""
    i = F.coalesce(F.col("intent"), F.lit(""))
    kind = F.when((i == "list_test_cases") & has("cluster"), "cluster_tests").when(i == "list_test_cases", "phrase_tests").when((i == "entity_coverage") & has("entity_name"), "entity_coverage")
    kind = kind.when(i == "requirement_lookup", "requirements").when((i == "graph_traversal") & has("cluster"), "dependencies").otherwise("keywords")
    return plans.withColumn("kind", kind).drop("intent")


def _bodies(requests: DataFrame) -> DataFrame:
    """Requests with what they ask for in one form, and ``body``, the same for all that ask the same; what a kind's answers
    don't depend on is null."""
    words = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda w: F.lower(F.trim(w))), lambda w: w.isNotNull() & (w != ""))))
    given = F.filter(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda w: F.lower(F.trim(w))), lambda w: w.isNotNull() & (w != ""))
    own = F.filter(given, lambda w: ~w.isin(*PLAIN_WORDS))
    phrase = F.when(F.size(own) > 0, F.array_join(F.slice(own, 1, 3), " ")).otherwise(F.coalesce(F.get(given, F.lit(0)), F.lit("")))
    r = requests.select(
        "request_id", F.coalesce("kind", F.lit("")).alias("kind"), _low("cluster").alias("cluster"), F.when(_low("entity_type") == "", "attribute").otherwise(_low("entity_type")).alias("entity_type"),
        F.trim(F.coalesce("entity_name", F.lit(""))).alias("entity_name"), words.alias("words"), phrase.alias("phrase"),
        F.when(_low("direction") == "outgoing_depends_on", "out").otherwise("in").alias("direction"), F.least(F.greatest(F.coalesce("most", F.lit(DEFAULT_HITS)), F.lit(0)), F.lit(MOST_HITS)).alias("most"),
    )
    lacks = lambda n: (F.size(n) == 0) if n == "words" else (F.col(n) == "")
    bad = reduce(lambda a, b: a | b, [(F.col("kind") == k) & reduce(lambda x, y: x | y, [lacks(n) for n in needs]) for k, needs in NEEDS.items()])
    told = F.when(~F.col("kind").isin(*NEEDS), "unknown").when(bad, "invalid")
    r = r.withColumn("problem", told)
    r = r.withColumns({c: F.when(F.col("kind").isin(*[k for k, asks in ASKS.items() if c in asks]), F.col(c)) for c in r.columns[2:-1]})
    return r.withColumn("body", F.sha2(F.to_json(F.struct(*r.columns[1:-1])), 256))


def _holding(asked: DataFrame, key: str, held: DataFrame, text: str) -> DataFrame:
    """(key, text): the texts that hold what is asked for; an empty text holds nothing, an empty key is held by nothing."""
    return trigrams.contained(asked.select(F.col(key).alias("needle")), held.select(F.col(text).alias("text"))).withColumnsRenamed({"needle": key, "text": text})


def _cluster_tests(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    b = b.withColumn("k", _norm(F.col("cluster"))).filter("k != ''")
    tests = nodes.filter("node_type = 'test_case'").select("node_id", _norm(F.col("cluster")).alias("n"))
    clusters = nodes.filter("node_type = 'cluster'").select(F.col("node_id").alias("dst"), _norm(F.col("label")).alias("n"))
    near = cut(trigrams.either_way(b, tests.select("n").union(clusters.select("n")), "k", "n").select("k", "n"))
    named = near.join(tests, "n").select("k", "node_id")
    ends = near.join(clusters, "n").select("k", "dst").distinct()

    def told(edges: DataFrame) -> DataFrame:
        e = edges.filter(F.col("edge_type").isin(*OF_CLUSTER)).join(ends, "dst").select("k", F.col("src").alias("node_id"))
        linked = e.join(tests.select("node_id"), "node_id", "left_semi").select("k", "node_id")
        return b.select("body", "k").join(named.union(linked).distinct(), "k").select("body", F.lit("found").alias("status"), F.lit(None).cast("string").alias("of"), "node_id")

    return OF_CLUSTER, ends.select("dst"), told


def _phrase_tests(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    tests = nodes.filter("node_type = 'test_case'").select("node_id", F.lower("text").alias("t"))
    found = b.join(_holding(b, "phrase", tests, "t"), "phrase").join(tests, "t").select("body", F.lit("found").alias("status"), F.lit(None).cast("string").alias("of"), "node_id")
    return (), None, lambda edges: found


def _entity_coverage(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    clusters = nodes.filter("node_type = 'cluster'").select(F.col("node_id").alias("c_id"), F.col("label").alias("c_label"), F.lower("label").alias("t"))
    alias = edges.filter("edge_type = 'alias_of'").select(F.col("src").alias("c_id"), F.col("dst").alias("b_id"))
    base = clusters.join(alias, "c_id").join(clusters.select(F.col("c_id").alias("b_id"), F.col("t").alias("base")), "b_id").groupBy(F.col("t").alias("cluster")).agg(F.min("base").alias("base"))
    b = cut(b.join(base, "cluster", "left").select("body", F.coalesce("base", "cluster").alias("c"), "entity_type", "entity_name"))
    named = _holding(b.filter("c != ''"), "c", clusters, "t").join(clusters, "t")
    probe = b.join(named, "c").select("body", (F.col("t") != F.col("c")).alias("part"), "c_id", F.concat_ws("::", F.upper("entity_type"), "c_label", "entity_name").alias("node_id"))
    one = probe.join(nodes.select("node_id"), "node_id", "left_semi").groupBy("body").agg(F.min(F.struct("part", "c_id", "node_id")).alias("m")).select("body", F.col("m.node_id").alias("one"))
    same = nodes.select(F.col("node_type").alias("entity_type"), F.lower("label").alias("name"), "node_id").groupBy("entity_type", "name").agg(F.min("node_id").alias("two"))
    found = cut(b.withColumn("name", F.lower("entity_name")).join(one, "body", "left").join(same, ["entity_type", "name"], "left").select("body", F.coalesce("one", "two").alias("of")))
    tests = nodes.filter("node_type = 'test_case'").select("node_id")

    def told(edges: DataFrame) -> DataFrame:
        points = edges.filter(F.col("edge_type").isin(*OF_ENTITY)).select(F.col("src").alias("node_id"), F.col("dst").alias("of"))
        points = points.join(found.select("of"), "of", "left_semi").distinct().join(tests, "node_id", "left_semi")
        status = F.when(F.col("of").isNull(), "missing").when(F.col("node_id").isNull(), "gap").otherwise("covered")
        return found.join(points, "of", "left").select("body", status.alias("status"), "of", "node_id")

    return OF_ENTITY, found.select("of"), told


def _scored(b: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """(body, most, node_id, score): nodes by how many of the words their text holds, in clusters that hold the one named.

    Of nodes alike in text and cluster, which score alike, the first ``most`` by id: no other is among the first so many."""
    n = nodes.select("node_id", F.lower("text").alias("t"), F.lower(F.coalesce("cluster", F.lit(""))).alias("of"))
    n = cut(n.withColumn("_n", F.row_number().over(Window.partitionBy("t", "of").orderBy("node_id"))).filter(F.col("_n") <= most).drop("_n"))
    asked = b.select("body", "most", "cluster", F.explode("words").alias("w"))
    hits = asked.join(_holding(asked, "w", n, "t"), "w").groupBy("body", "most", "cluster", "t").agg(F.count("*").alias("score"))
    fits = _holding(b.filter("cluster != ''"), "cluster", n, "of").withColumnRenamed("of", "fits")
    every = hits.filter("cluster = ''").join(n, "t").select("body", "most", "node_id", "score")
    some = hits.filter("cluster != ''").join(fits, "cluster").join(n, (hits["t"] == n["t"]) & (F.col("fits") == n["of"])).select("body", "most", "node_id", "score")
    return every.union(some)


def _ranked(scored: DataFrame, most: Column) -> DataFrame:
    at = F.row_number().over(Window.partitionBy("body").orderBy(F.desc("score"), "node_id"))
    return scored.withColumn("at", at).filter(F.col("at") <= most)


def _requirements(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    r = _ranked(_scored(b, nodes.filter(F.col("node_type").isin(*SPECS)), MOST_REQUIREMENTS), F.lit(MOST_REQUIREMENTS)).select("body", F.col("at").alias("_first"), F.col("node_id").alias("of"))
    r = cut(r)
    tests = nodes.filter("node_type = 'test_case'").select("node_id")

    def told(edges: DataFrame) -> DataFrame:
        v = edges.filter("edge_type = 'verifies_requirement'").select(F.col("src").alias("node_id"), F.col("dst").alias("of"))
        v = v.join(r.select("of"), "of", "left_semi").distinct().join(tests, "node_id", "left_semi")
        v = v.withColumn("n", F.row_number().over(Window.partitionBy("of").orderBy("node_id"))).filter(F.col("n") <= MOST_TESTS)
        return r.join(v, "of", "left").select("body", F.when(F.col("node_id").isNull(), "uncovered").otherwise("covered").alias("status"), "of", "node_id", "_first")

    return ("verifies_requirement",), r.select("of"), told


def _dependencies(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    clusters = nodes.filter("node_type = 'cluster'").select(F.col("node_id").alias("target"), F.lower("label").alias("t"))
    targets = cut(b.join(_holding(b, "cluster", clusters, "t"), "cluster").join(clusters, "t").select("body", "direction", "target").distinct())

    def told(edges: DataFrame) -> DataFrame:
        e = edges.filter(F.col("edge_type").isin(*DEPENDS))
        both = e.select(F.col("dst").alias("target"), F.col("src").alias("node_id"), F.lit("in").alias("direction")).union(e.select("src", "dst", F.lit("out"))).distinct()
        others = targets.join(both, ["target", "direction"]).select("body", "node_id").distinct().join(clusters.select(F.col("target").alias("node_id")), "node_id", "left_semi")
        others = others.join(targets.select("body", F.col("target").alias("node_id")), ["body", "node_id"], "left_anti")
        return others.select("body", F.lit("found").alias("status"), F.lit(None).cast("string").alias("of"), "node_id")

    return (), None, told


def _keywords(b: DataFrame, nodes: DataFrame, edges: DataFrame) -> _Asked:
    n = nodes.filter(F.col("node_type").isin(*SPECS, "test_case"))
    found = _ranked(_scored(b, n, MOST_HITS), F.lit(MOST_HITS)).filter(F.col("at") <= F.col("most")).select("body", F.lit("found").alias("status"), F.lit(None).cast("string").alias("of"), "node_id", F.col("at").alias("_first"))
    return (), None, lambda edges: found


_KINDS = {"cluster_tests": _cluster_tests, "phrase_tests": _phrase_tests, "entity_coverage": _entity_coverage, "requirements": _requirements, "dependencies": _dependencies, "keywords": _keywords}


def _pointing(edges: DataFrame, asked: list[_Asked]) -> DataFrame:
    """Edges that some answer can rest on: those between clusters, and of other types those that point to an end asked for."""
    ends = reduce(lambda x, y: x.union(y), [d.select(F.explode(F.array(*[F.lit(t) for t in types])).alias("edge_type"), F.col(d.columns[0]).alias("dst")) for types, d, _ in asked if types])
    ends = cut(ends.distinct().withColumn("_met", F.lit(True)))
    ends = F.broadcast(ends) if ends.count() <= SENT else ends
    met = edges.select("src", "dst", "edge_type").join(ends, ["edge_type", "dst"], "left")
    return cut(met.filter(F.col("_met").isNotNull() | F.col("edge_type").isin(*DEPENDS)).select("src", "dst", "edge_type"))


def _told(r: DataFrame, every: DataFrame) -> DataFrame:
    """(request_id, status, at, of, node_id): each answer once for each request that asks for it.

    Answers to one question are dealt in blocks, and requests once for each block of theirs, so of their product a row for each
    block and request is shuffled.  The requests of an answer come out one after the other, and a task has few enough answers
    for a dictionary of Parquet's: what is then written is little more than the answers and the requests."""
    block = ((F.col("at") - 1) / BLOCK).cast("int")
    last = every.groupBy("body").agg(F.max(block).alias("last"))
    n, keys = shares(every, SHARE), ["body", "_block"]
    asked = r.select("request_id", "body").join(last, "body").select("request_id", "body", F.explode(F.sequence(F.lit(0), "last")).alias("_block"))
    dealt = every.withColumn("_block", block).repartition(n, *keys)
    return dealt.hint("merge").join(asked.repartition(n, *keys), keys).select(*_ANSWER)  # the left side's rows are gone through once


def answered(requests: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(request_id, status, at, of, node_id): the answers to each request, numbered from 1 in ``at``.

    cluster_tests: test cases whose cluster's name holds the one asked for or is held by it (the word cluster left out), or
    that test such a cluster.  phrase_tests: those whose text holds the keywords as a phrase, up to three, plain words left
    out.  entity_coverage: ``of`` is the entity, of the named cluster, of the first by id whose name holds it, else of that
    type and name anywhere; 'covered' by each test, a 'gap', or 'missing'.  requirements: the 20 with most of the keywords,
    'covered' by each of up to five tests, or 'uncovered'.  dependencies: clusters that edges tie to those whose name holds
    the one asked for, which are left out.  keywords: the ``most`` nodes (10 unless given, 30 at most) with most keywords.

    A request of another kind gives one row 'unknown', one that lacks what its kind needs 'invalid', one without an answer
    'none'.  Cases don't count, but in ids; null and empty are alike; repeated requests are answered each.  Requests that ask
    the same, in what their kind depends on, are worked on once; names and words are looked up by grams.  Nodes are written once, as each kind reads them; of the edges, which may repeat,
    only those that questions ask for.
    """
    r, nodes = cut(_bodies(requests)), cut(nodes.select("node_id", "node_type", "label", "cluster", "text"))
    b = r.filter("problem is null").drop("request_id", "problem").dropDuplicates(["body"])
    asked = [f(b.filter(F.col("kind") == k), nodes, edges) for k, f in _KINDS.items()]
    pointing = _pointing(edges, asked)
    found = [told(pointing) for _, _, told in asked]
    found = [x if "_first" in x.columns else x.withColumn("_first", F.lit(0)) for x in found]
    every = reduce(lambda x, y: x.unionByName(y), found).select("body", "status", "of", "node_id", "_first")
    every = cut(numbered(every, ["body"], ["_first", "of", "node_id"], "at").withColumn("at", (F.col("at") + 1).cast("int")).drop("_first"))
    none = r.join(every.filter("at = 1").select("body"), "body", "left_anti")
    none = none.select("request_id", F.coalesce("problem", F.lit("none")).alias("status"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("string").alias("of"), F.lit(None).cast("string").alias("node_id"))
    return _told(r, every).unionByName(none)
