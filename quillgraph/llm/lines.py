"""Line dedup against levelled sorted runs of line hashes: DataFrame and SQL functions only.

A run is a table of the hashes of lines met so far, bucketed and sorted by hash in the shared folder.  A batch of
documents is joined to the runs by merging (neither side of a run is shuffled), lines whose hash is there go, and the
batch's own new hashes become a run of level 0.  Where a level has FANOUT runs, they are merged into one of the next, so
n batches leave about log n runs to meet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import HOT, discard, keyed, new_path, passing, spread_join, tidy, written

#: Shorter keys stay, in code points.
LEAST = 10
#: Runs of a level that are merged into one of the next.
FANOUT = 2
#: Batches that :func:`dedup_lines` deals a table to, by id.
BATCHES = 4
_TRIM = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_of(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    k = F.btrim(line, F.lit(_TRIM))
    return F.when(F.octet_length(k) == F.length(k), F.lower(k)).otherwise(F.translate(k, _UPPER, _LOWER))


def hashed_lines(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(did, ver, pos, h1, h2): place and 128-bit hash of each line of ``texts`` (did, ver, text) with a key of ``least`` code points."""
    lines = texts.select("did", "ver", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).filter(F.octet_length("line") >= least)
    lines = lines.select("did", "ver", "pos", key_of(F.col("line")).alias("k")).filter(F.length("k") >= least)
    return lines.select("did", "ver", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(7), "k").alias("h2"))


class Runs:
    """The runs in a folder, which may be kept and opened again; a run counts once its writer has finished.

    A merge writes the new run before it deletes the old ones.  Should the application end in between, hashes are there
    twice, which changes no answer.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(p)
        self.runs = [self._opened(s.getPath().getName()) for s in self.fs.listStatus(p) if self._finished(s.getPath())]

    def _finished(self, p) -> bool:
        return self.fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))

    def _opened(self, name: str) -> tuple[int, str]:
        level, buckets, tag = name.split("-")
        self.spark.sql(
            f"create table if not exists run_{tag} (h1 bigint, h2 bigint, did bigint, ver bigint, several boolean, n bigint, known boolean) using parquet "
            f"clustered by (h1, h2) sorted by (h1, h2) into {buckets} buckets location '{self.path}/{name}'"
        )
        return int(level), name

    def _write(self, df: DataFrame, level: int) -> tuple[int, str]:
        # as many buckets as a shuffle has partitions: what is dealt by hash already needs no other shuffle
        buckets, tag = int(self.spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex
        name = f"{level}-{buckets}-{tag}"
        with tidy(self.spark):
            df.write.bucketBy(buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").option("path", f"{self.path}/{name}").saveAsTable(f"run_{tag}")
        return level, name

    def table(self, run: tuple[int, str]) -> DataFrame:
        return self.spark.table("run_" + run[1].rsplit("-", 1)[1])

    def _drop(self, run: tuple[int, str]) -> None:
        self.spark.sql("drop table run_" + run[1].rsplit("-", 1)[1])
        self.fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run[1]}"), True)

    def hashes(self, run: tuple[int, str]) -> DataFrame:
        return self.table(run).filter("not known").select("h1", "h2")

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch's hashes as a run; (h1, h2, did, ver, several, n, known), a row for each hash of the batch.

        ``known``: a run had it before.  Else (did, ver) is the first document of the batch that has it, and ``several``
        says whether another one does.  The rows stay until :meth:`compact`.
        """
        doc = F.struct("did", "ver")
        found = lines.groupBy("h1", "h2").agg(F.min(doc).alias("a"), F.max(doc).alias("b"), F.count("*").alias("n"))
        found = found.select("h1", "h2", "a.did", "a.ver", (F.col("a") != F.col("b")).alias("several"), "n")
        known = F.lit(False)
        for i, run in enumerate(self.runs):
            found = found.join(self.hashes(run).withColumn(f"_{i}", F.lit(True)).hint("merge"), ["h1", "h2"], "left")
            known = known | F.coalesce(F.col(f"_{i}"), F.lit(False))
        self.runs.append(self._write(found.select("h1", "h2", "did", "ver", "several", "n", known.alias("known")), 0))
        return self.table(self.runs[-1])

    def compact(self) -> None:
        """Merge the runs of each level that has ``fanout`` of them, from the lowest up."""
        level = 0
        while level <= max((x[0] for x in self.runs), default=0):
            full = [x for x in self.runs if x[0] == level]
            if len(full) >= self.fanout:
                merged = self.hashes(full[0])
                for x in full[1:]:
                    merged = merged.union(self.hashes(x))
                none = {"did": F.lit(0).cast("long"), "ver": F.lit(0).cast("long"), "several": F.lit(False), "n": F.lit(0).cast("long"), "known": F.lit(False)}
                self.runs = [x for x in self.runs if x[0] != level] + [self._write(merged.distinct().withColumns(none), level + 1)]
                for x in full:
                    self._drop(x)
            level += 1

    def close(self, delete: bool = False) -> None:
        for run in self.runs:
            if delete:
                self._drop(run)
            else:
                self.spark.sql("drop table run_" + run[1].rsplit("-", 1)[1])
        self.runs = []


def dropped(lines: DataFrame, runs: Runs) -> DataFrame:
    """(did, ver, pos) of a batch's lines that go: those met in an earlier batch or in an earlier document of this one."""
    hashes = runs.add(lines)
    least = max(1, HOT * lines.count())
    met = hashes.filter("known or several").select("h1", "h2", F.col("did").alias("d0"), F.col("ver").alias("v0"), "known")
    out = spread_join(lines, met, ["h1", "h2"], hashes.filter("known or several").filter(F.col("n") > least), ["did", "ver", "pos"])
    return out.filter("known or did != d0 or ver != v0").select("did", "ver", "pos")


def _batches(lines: DataFrame, cuts: list[int]) -> Iterator[DataFrame]:
    for b in range(len(cuts) + 1):
        yield lines.filter(F.col("batch") == b).drop("batch")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, batches: int = BATCHES, runs: str | None = None) -> DataFrame:
    """(row, n_lines, n_dropped, text): each input row as a struct, and its text without the lines that go.

    A line goes if its key of ``least`` code points or more is also in a document with a smaller id; other lines stay as
    they are, repeated ones of one document too.  ``runs`` names a folder of runs that is kept: lines met in earlier calls
    go as well.  Without it the runs are this call's own.

    A null text is one empty line.  Null ids come before all others; rows of one id with different texts are different
    documents in the order of a hash of the text, and rows alike in id and text are one document, whose result each gets.
    Other columns, clashing names too, are in ``row``.  Empty input gives no rows.

    Hashes have 128 bits.  They are written once; texts are read for them and for the result.  Batches are ranges of ids.
    """
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col)
    n = docs.count()
    alike = base.groupBy("did", "ver").agg(F.count("*").alias("n")).filter(F.col("n") > max(1, HOT * n)).select("did", "ver")
    alike = None if alike.isEmpty() else written(alike, "copies")
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [i / batches for i in range(1, batches)], 10000)).first()[0] or []
    texts = keyed(docs, id_col, text_col, alone=True).select("did", "ver", "text")
    batch = sum((F.when(F.col("did") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    path = new_path(spark, "lines")
    with tidy(spark):
        hashed_lines(texts, least).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    passing(spark, path)
    schema = "did long, ver long, pos int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(path)
    store = Runs(spark, runs or new_path(spark, "line-runs"))
    out = new_path(spark, "dropped-lines")
    for each in _batches(lines, cuts):
        with tidy(spark):
            dropped(each, store).write.mode("append").parquet(out)
        store.compact()
    store.close(delete=runs is None)
    passing(spark, out)
    discard(lines)
    gone = spark.read.schema("did long, ver long, pos int").parquet(out)
    gone = gone.groupBy("did", "ver").agg(F.collect_set("pos").alias("gone"))
    base = base.withColumn("n_lines", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long"))
    found = spread_join(base, gone, ["did", "ver"], alike, ["_at"], "left") if alike is None else spread_join(base.withColumn("_at", F.rand(1)), gone, ["did", "ver"], alike, ["_at"], "left")
    # a generator between: beneath the lambda, the text would be split once for each line
    found = found.withColumn("_l", F.explode(F.array(F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)))))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(_l) - 1), gone), i -> _l[i]), '\n')")
    return found.select("row", "n_lines", F.coalesce(F.size(F.when(F.col("gone").isNotNull(), F.col("gone"))), F.lit(0)).cast("long").alias("n_dropped"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"))


def op13(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
