"""Token-id output: packed id matrices with cumulative segment lengths and position resets.

Windows are packed by best fit decreasing with :class:`packing.Capacities`.  A document longer than a window is cut
into full windows and a rest, which together are the document; no other document is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import EOS, MODEL, POOL, WINDOW, _pooled
from .shared import new_path, passing

_OUT = "sequence_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, position_resets array<int>, n_tokens int, input_ids binary"


def _matrices(tokenizer: str, window: int, eos: int, pool_size: int, pad: int):
    names = [x.split()[0] for x in _OUT.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary()]

    def run(batches):
        padding = np.array([pad], "<u4").tobytes()
        for pool, found in _pooled(batches, tokenizer, window, False, eos, pool_size):
            for low in range(0, len(found), 1024):
                rows = []
                for seq, pieces in found[low : low + 1024]:
                    cum = [0, *np.cumsum([n for _, _, n in pieces]).tolist()]
                    ids = b"".join(pool.ids[d][4 * s : 4 * (s + n)] for d, s, n in pieces)
                    rows.append((seq, [pool.rows[d] for d, _, _ in pieces], [s for _, s, _ in pieces], cum, cum[:-1], cum[-1], ids + padding * (window - cum[-1])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def id_matrices(docs: DataFrame, tokenizer: str = MODEL, window: int = WINDOW, eos: int = EOS, pad: int = 0, id_col: str = "doc_id", text_col: str = "text", pool: int = POOL) -> DataFrame:
    """A row for each window: its id, the documents of its segments and where in them each starts, cumulative segment
    lengths from 0, the places where positions start again at 0, how many ids aren't padding, and the row of the matrix
    (``window`` little-endian unsigned 32-bit ids, padded with ``pad``).

    A null or empty text is the end id alone; repeated and null ids are separate documents.  Empty input gives no rows.
    """
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(_matrices(tokenizer, window, eos, pool, pad), _OUT)


def write_matrices(matrices: DataFrame, path: str) -> DataFrame:
    """Write a Parquet table, in any store that Spark writes, and give it as read back: a matrix row, its segments and
    resets side by side.  Files at ``path`` are replaced once all tasks are done, so a lost executor leaves none behind."""
    matrices.write.mode("overwrite").parquet(path)
    return matrices.sparkSession.read.schema(matrices.schema).parquet(path)


def read_matrix(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows of such a table as the matrix of ids and the matrix of positions (0 in padding)."""
    ids = np.stack([np.frombuffer(r.input_ids, "<u4") for r in rows]) if rows else np.zeros((0, 0), "<u4")
    positions = np.zeros(ids.shape, np.int32)
    for i, r in enumerate(rows):
        for a, b in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            positions[i, a:b] = np.arange(b - a)
    return ids, positions


def op9(docs: DataFrame) -> DataFrame:
    """The written matrices as read back, each row with the checksum of its ids, padding not counted.  Cases are those of
    :func:`id_matrices`."""
    spark = docs.sparkSession
    path = new_path(spark, "matrices")
    table = write_matrices(id_matrices(docs), path)
    passing(spark, path)
    real = F.substring("input_ids", F.lit(1), F.col("n_tokens") * 4)
    return table.select("sequence_id", "doc_ids", "starts", "cu_seqlens", "position_resets", "n_tokens", F.crc32(real).alias("ids_crc32"))
