"""A vector store over Parquet: add, search, save, load, size; embedders; text queries over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors as V
from .lineage import cut

EmbedFn = Callable[[pd.Series], pd.Series]


def hashing_embedder(size: int = 64) -> EmbedFn:
    """The offline embedder: signed counts of word hashes, scaled to length 1; empty texts are zero vectors."""
    from zlib import crc32

    def run(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts.fillna(""):
            v = np.zeros(size, np.float32)
            for w in t.lower().split():
                h = crc32(w.encode())
                v[h % size] += 1 if h >> 16 & 1 else -1
            n = float(np.sqrt((v * v).sum()))
            out.append((v / n if n else v).tolist())
        return pd.Series(out)

    return run


def embedded(df: DataFrame, text: Column, embed: EmbedFn | None = None, prefix: str = "", name: str = "embedding") -> DataFrame:
    """Add the embedding of a text, ``prefix`` before it (as some models want for queries), in Arrow batches."""
    run = embed or hashing_embedder()
    return df.withColumn(name, F.pandas_udf(lambda s: run(s), "array<float>")(F.concat(F.lit(prefix), F.coalesce(text, F.lit("")))))


#: How backends put a score: the cosine itself, or one less a distance of 1 - cosine in whole or in half.
SCORES: dict[str, Callable[[Column], Column]] = {"cosine": lambda s: s, "distance": lambda s: 1 - (1 - s), "half_distance": lambda s: 1 - (1 - s) / 2}


class VectorStore:
    """Entries (doc_id, text, metadata, embedding); vectors are scaled to length 1, so products are cosines.

    Adding gives a new store.  Entries without ids are written once to the shared folder with the ids they get, so that a
    hit's id names the same text however often a plan is worked out.
    """

    SCHEMA = "doc_id string, text string, metadata map<string,string>, embedding array<double>"

    def __init__(self, spark: SparkSession, entries: DataFrame | None = None, score: str = "cosine"):
        self.spark, self.score = spark, score
        self.entries = entries if entries is not None else spark.createDataFrame([], self.SCHEMA)

    def add(self, entries: DataFrame) -> VectorStore:
        """``entries``: text, embedding, and where wanted doc_id and metadata.  Ids that aren't given are numbers that
        rise with the rows, after those there are, with gaps between partitions."""
        cols = entries.columns
        if not {"text", "embedding"} <= set(cols):
            raise ValueError("entries need text and embedding")
        out = entries
        if "doc_id" not in cols:
            out = cut(out.withColumn("doc_id", F.format_string("doc_%06d", F.monotonically_increasing_id() + self.size())))
        if "metadata" not in cols:
            out = out.withColumn("metadata", F.create_map().cast("map<string,string>"))
        out = out.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "metadata", V.normalised(F.col("embedding")).alias("embedding"))
        return VectorStore(self.spark, self.entries.unionByName(out), self.score)

    def add_lists(self, texts: list[str], embeddings: Iterable[Iterable[float]], metadata: list[dict] | None = None) -> VectorStore:
        """Lists of the same length, else ValueError."""
        rows = [[float(x) for x in e] for e in embeddings]
        metadata = metadata if metadata is not None else [{} for _ in texts]
        if not len(texts) == len(rows) == len(metadata):
            raise ValueError(f"{len(texts)} texts, {len(rows)} embeddings and {len(metadata)} metadata don't fit")
        if not rows:
            return self
        start = self.size()
        data = [(f"doc_{start + i:06d}", t, {k: str(v) for k, v in m.items()}, e) for i, (t, m, e) in enumerate(zip(texts, metadata, rows, strict=True))]
        return self.add(self.spark.createDataFrame(data, self.SCHEMA))

    def search(self, queries: DataFrame, k: int = 10, threshold: float | None = None) -> DataFrame:
        """(query_id, rank, doc_id, score, text, metadata) from (query_id, embedding): ranks from 0; the threshold applies
        after ranking.  Fewer entries than ``k``: all of them."""
        q = queries.select("query_id", V.normalised(F.col("embedding")).alias("q"))
        hits = V.search(q, self.entries.select(F.col("doc_id").alias("vec_id"), F.col("embedding").alias("v")), k)
        hits = hits.select("query_id", (F.col("rank") - 1).alias("rank"), F.col("vec_id").alias("doc_id"), SCORES[self.score](F.col("score")).alias("score"))
        if threshold is not None:
            hits = hits.filter(F.col("score") >= threshold)
        return hits.join(self.entries.select("doc_id", "text", "metadata"), "doc_id").select("query_id", "rank", "doc_id", "score", "text", "metadata")

    def search_texts(self, texts: DataFrame, k: int = 10, threshold: float | None = None, embed: EmbedFn | None = None, prefix: str = "") -> DataFrame:
        """As :meth:`search` from (query_id, text); a batch is one search."""
        return self.search(embedded(texts, F.col("text"), embed, prefix), k, threshold)

    def size(self) -> int:
        return self.entries.count()

    def save(self, path: str) -> None:
        self.entries.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, score: str = "cosine") -> VectorStore:
        return cls(spark, spark.read.schema(cls.SCHEMA).parquet(path), score)


def create(spark: SparkSession, config: dict) -> VectorStore:
    """A store by ``type``: parquet (a path is loaded where there is one), or memory.  Others raise ValueError."""
    kind = config.get("type", "memory")
    if kind not in ("parquet", "memory"):
        raise ValueError(f"unknown store type {kind!r}")
    if kind == "parquet" and config.get("path"):
        return VectorStore.load(spark, config["path"], config.get("score", "cosine"))
    return VectorStore(spark, score=config.get("score", "cosine"))


def by_case(hits: DataFrame) -> DataFrame:
    """(query_id, tc_id, score): the best hit of each test case, which the metadata name."""
    return hits.groupBy("query_id", F.col("metadata").getItem("tc_id").alias("tc_id")).agg(F.max("score").alias("score")).filter("tc_id is not null")
