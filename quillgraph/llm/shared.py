"""What the operators of this subpackage share: the shared folder, row keys and buckets."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of every word contract: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
NULL_ID = -(1 << 63)
#: Rows of a range in :func:`running`.
RANGE = 1 << 20
#: A key with more than this share of the rows is hot; so many tasks share its rows.
HOT, SALTS = 1e-3, 32
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: the session's spark.checkpoint.dir.

    Only on a local master, where they are one machine, a folder of our own takes the place of an unset one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
        path = _local.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="quillgraph-"))
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def passing(spark: SparkSession, path: str) -> None:
    """Have what is at ``path`` deleted when the application ends."""
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back; the shuffle files behind it go at once.

    The table lasts until :func:`discard` or the application's end.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    passing(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def tidy(spark: SparkSession):
    """Within, each finished execution's shuffle files are deleted."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.startswith(("file:", shared_dir(spark).split(":")[0] + ":")):
                p, fs = _hadoop(spark, path)
                fs.delete(p, True)


def running(df: DataFrame, order: list[str], values: list[str], n: int, name: str, rows: int = RANGE) -> DataFrame:
    """Add ``before_<v>`` for each of ``values``: its sum over all rows that come before in ``order``, which is total.

    The ``n`` rows (or about as many) are range-sorted and written; sums of whole ranges, one row each, give each range
    its start, and within a range a window adds the rest.  A range has about ``rows`` rows, whatever share of them one
    key has.
    """
    parts = max(1, -(-n // rows))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, name)
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    heads = sums.select(F.col("range").alias("r"), *[F.coalesce(F.sum(f"sum_{v}").over(whole), F.lit(0)).alias(f"head_{v}") for v in values])
    inner = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"in_{v}": F.coalesce(F.sum(v).over(inner), F.lit(0)) for v in values})
    out = inside.join(heads, F.col("range") == F.col("r"))
    return out.select(*df.columns, "range", *[(F.col(f"head_{v}") + F.col(f"in_{v}")).alias(f"before_{v}") for v in values])


def some(df: DataFrame, name: str) -> DataFrame | None:
    """``df`` written, or None where it has no rows."""
    out = written(df, name)
    return None if out.isEmpty() else out


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame | None, by: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined (inner or left) to ``right``, which has a row a key at most, with the rows of hot keys dealt to SALTS tasks.

    ``hot`` holds the hot keys: at most 1 / HOT of them for each set of rows in which their share was counted, so it is
    small and broadcast whatever the input's size; None: no key is hot.  ``by`` are columns of ``left`` that tell a
    key's rows apart.
    """
    if hot is None:
        return left.join(right, on, how)
    marks = F.broadcast(hot.select(*on).distinct().withColumn("_hot", F.lit(1)))
    salt = F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")
    a = left.join(marks, on, "left").withColumn("_salt", F.when(F.col("_hot") == 1, salt).otherwise(0)).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    b = right.join(marks, on, "left").withColumn("_salt", F.explode(F.when(F.col("_hot") == 1, every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return a.join(b, [*on, "_salt"], how).drop("_salt")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: bool = False) -> DataFrame:
    """(row, did, ver, text): the whole input row as a struct, its id, a version number and its text ('' for null).

    Ids are expected to be unique; then ver is 0.  Where an id repeats or is null, ver is a hash of the text, so rows
    with one id and different texts are different documents, ordered by that hash, and rows alike in id and text are
    one document listed twice: each gets that document's result.  Null ids come before all others.  ``alone``: of rows
    alike in id and text keep the one that comes first as JSON.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = docs.groupBy(F.col(id_col).alias("i")).count().filter("i is null or count > 1")
    repeats = not ids.isEmpty()
    ver = F.xxhash64(text) if repeats else F.lit(0).cast("long")
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("did"),
        ver.alias("ver"),
        text.alias("text"),
    )
    if alone and repeats:
        out = out.groupBy("did", "ver").agg(F.min_by(F.struct("row", "text"), F.to_json("row")).alias("x")).select("x.row", "did", "ver", "x.text")
    return out


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0


def bucket_of(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def buckets(total: int, each: int) -> int:
    """How many buckets of about ``each`` bytes hold ``total``."""
    return max(1, math.ceil(total / each))
