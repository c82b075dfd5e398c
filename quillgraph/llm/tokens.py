"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content with the tokenizer's version.  Counts stored under a key are
joined to the texts; of what the cache lacks, each different content is encoded once and appended to the cache.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import HOT, new_path, passing, spread_join, tidy, written
from .tokenize import loaded, version
from .words import sliced

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def normalised(text: Column) -> Column:
    """What the count depends on: null is empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def _encoded(tokenizer: str, tag: str):
    def run(batches):
        model = loaded(tokenizer)
        for b in sliced(batches, "text"):
            n = model.counts(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array([tag] * len(n)), pa.array(n, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    return run


def _exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def token_counts(docs: DataFrame, tokenizer: str = MODEL, cache: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each input row.

    ``cache`` is a folder that is kept and shared between runs; without one, a new one in the shared folder is used.
    Null texts count as empty: no bytes, no tokens.  Ids are only carried along, so null and repeated ones are kept as
    they are; equal texts are encoded once, and a text of many rows is joined by many tasks.  Empty input gives no rows.
    """
    spark = docs.sparkSession
    own = cache is None
    cache = cache or new_path(spark, "token-counts")
    tag = version(tokenizer)
    text = normalised(F.col(text_col))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")

    def stored() -> DataFrame:
        # a run that died while appending may have left a key twice
        return spark.read.schema(_SCHEMA).parquet(cache).filter(F.col("tokenizer") == tag).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    found = docs.select(digest, text.alias("text"))
    if _exists(spark, cache):
        found = found.join(stored(), "digest", "left_anti")
    misses = found.dropDuplicates(["digest"]).mapInArrow(_encoded(tokenizer, tag), _SCHEMA)
    with tidy(spark):
        misses.write.mode("append").parquet(cache)
    if own:
        passing(spark, cache)
    keys = written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest), "digests")
    hot = keys.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > max(1, HOT * keys.count()))
    return spread_join(keys.withColumn("_at", F.monotonically_increasing_id()), stored(), ["digest"], hot, ["_at"]).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
