"""Results kept by content: what was computed from a text under a version of the rules isn't computed again."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import _hadoop, cut, discard

#: Up to so many digests that are to be computed (16 MB) go to every task, so that only their texts are shuffled.
FEW = 1 << 18

_KEYS = "_digest string, _batch string"


class Pass(NamedTuple):
    """What a pass gives: ``records``, and how many distinct contents were known, computed, and left by the budget.

    ``batch`` names what this pass computed; None if it computed nothing.
    """

    records: DataFrame
    known: int
    computed: int
    left: int
    batch: str | None


def digest(content: list[str]) -> Column:
    """SHA-256 of several columns as text; null differs from empty, and no text runs into the next."""
    told = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in content]
    return F.sha2(F.concat(*told), 256)


def version_with(version: str, names: DataFrame, name: str = "name") -> str:
    """A version of rules that also changes with a set of names, whatever their order and repeats; nulls don't count.

    One row comes to the driver: the number of names and two sums of their hashes.
    """
    n = names.select(F.col(name).alias("n")).filter("n is not null").distinct()
    wide = lambda c: F.sum(c.cast("decimal(38,0)")).cast("string")
    r = n.agg(F.count("*").alias("n"), wide(F.xxhash64("n")).alias("a"), wide(F.xxhash64("n", F.lit(1))).alias("b")).first()
    return f"{version}/{r['n']}/{r['a']}/{r['b']}"


def _stored(spark, folder: str) -> DataFrame:
    """(_digest, _batch): one batch for each content that is done."""
    p, fs = _hadoop(spark, folder + "/keys")
    if not fs.exists(p):
        return spark.createDataFrame([], _KEYS)
    return spark.read.schema(_KEYS).parquet(folder + "/keys").groupBy("_digest").agg(F.min("_batch").alias("_batch"))


def _joined(rows: DataFrame, results: DataFrame, asked: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the results of their content.  A content that has more than a quarter of a shuffle partition's even
    share of all rows is hot: its rows are dealt, by ``by``, to as many salts as it has such quarters, and its results
    repeated for each.  There are at most four hot contents a partition, so they are broadcast, and eight salts."""
    quarters = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = asked.agg(F.sum("_n").alias("n")).first()["n"] or 0
    hot = cut(asked.filter(F.col("_n") * quarters > n).select(F.col("_digest").alias("_d"), F.ceil(F.col("_n") * quarters / n).cast("int").alias("_salts")))
    marks, same = F.broadcast(hot), F.col("_digest") == F.col("_d")
    a = rows.join(marks, same, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts", "_d")
    b = results.join(marks, same, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts", "_d")
    return a.join(b, ["_digest", "_salt"]).drop("_digest", "_salt")


def through(df: DataFrame, content: list[str], compute: Callable[[DataFrame], DataFrame], path: str, version: str, by: list[str], most: int | None = None) -> Pass:
    """``df`` joined with the records that ``compute`` finds in its ``content``, each distinct content computed once for all.

    ``compute`` gets (_digest, the columns of content), a row for each content that folder ``path`` doesn't hold under
    ``version``, and returns _digest with its records' columns, any number of records each.  ``df`` gains these and
    ``batch``, which says what pass computed them; a row whose content has no records, or is still to be computed, gives none.
    Null content is content of its own.  ``by``: columns that tell rows of one content apart; rows alike in them stay, each
    with all records.  ``most``: the most contents computed in this pass, in the order of their digests, which come to the
    driver; the rest is left to the next (a budget for calls of a model).  ``df`` is read three times, so it has to give
    the same rows each time; a column ``_digest`` in it is taken as :func:`digest` of its content, and dropped.  Where names clash with the records' the call ends with an error.

    Records are appended before the keys that make them count, so a pass that is lost in between is repeated by the next,
    and of two passes at once that compute the same content one counts.
    """
    spark, folder = df.sparkSession, f"{path}/{hashlib.sha256(version.encode()).hexdigest()[:32]}"
    rows = df if "_digest" in df.columns else df.withColumn("_digest", digest(content))
    asked = cut(rows.groupBy("_digest").agg(F.count("*").alias("_n")).join(_stored(spark, folder), "_digest", "left"))
    n, missing = asked.count(), asked.filter("_batch is null").select("_digest")
    n_missing = missing.count()
    todo = min(n_missing, n_missing if most is None else most)
    batch = None
    if todo:
        batch = uuid.uuid4().hex
        if todo < n_missing:
            missing = cut(missing.orderBy("_digest").limit(todo))
        few = todo <= FEW
        fresh = rows.join(F.broadcast(missing), "_digest", "left_semi") if few else rows
        fresh = fresh.groupBy("_digest").agg(*[F.any_value(c).alias(c) for c in content])
        fresh = fresh if few else fresh.join(missing, "_digest", "left_semi")
        compute(fresh).withColumn("_batch", F.lit(batch)).write.mode("append").parquet(folder + "/records")
        missing.select("_digest", F.lit(batch).alias("_batch")).write.mode("append").parquet(folder + "/keys")
        if todo < n_missing:
            discard(missing)
    if n == n_missing and not todo:
        records = compute(rows.select("_digest", *content).limit(0)).withColumn("_batch", F.lit(None).cast("string"))
    else:
        records = spark.read.parquet(folder + "/records").join(_stored(spark, folder), ["_digest", "_batch"])
    records = records.withColumnRenamed("_batch", "batch")
    clash = sorted((set(df.columns) & set(records.columns)) - {"_digest"})
    if clash:
        raise ValueError(f"columns in both the rows and the records: {', '.join(clash)}")
    out = _joined(rows, records, asked, by)
    discard(asked)
    return Pass(out, n - n_missing, todo, n_missing - todo, batch)
