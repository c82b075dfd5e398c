"""Cutting a plan's lineage through storage that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; on a local master, where that is unset, a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
        path = _local.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="quillgraph-"))
    return path.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cut(df: DataFrame, *before: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.  Tables ``before``, cut earlier and read by nothing else, are
    deleted then; what is left goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path
    discard(*before)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`cut` that no later plan reads."""
    for df in tables:
        path = getattr(df, "_cut_at", None)
        if path:
            p, fs = _hadoop(df.sparkSession, path)
            fs.delete(p, True)


def shares(df: DataFrame, rows: int = 1 << 20) -> int:
    """Into how many partitions ``df`` is to be dealt for about ``rows`` each, as many as a shuffle has at least; so a
    task's share doesn't grow with the table."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
