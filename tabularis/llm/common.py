"""Helpers shared by the training-data operators: input views, scratch tables, Arrow batches.

Row identity. ``doc_id`` identifies a document; rows that repeat a ``doc_id`` are allowed.
A null ``doc_id`` is carried as ``NULL_ID`` (the largest long, so it sorts after all others)
and is given back as null. A null text is the empty text.
"""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.session import ensure_checkpoint_dir

NULL_ID = 2**63 - 1
#: Most rows and bytes of an Arrow batch, so that a worker's memory follows neither row counts nor text lengths.
BATCH_ROWS, BATCH_BYTES = 4000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches (a smaller setting of the user stays)."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def lean(run: Callable) -> Callable:
    """A function of batches that gives freed memory back to the system when its task ends.

    Spark keeps idle Python workers, and the allocators keep what a worker once used.
    """

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to give back
            return

    return wrapped


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, also beside others that differ only in case.

    Of columns with the same name the first counts.
    """
    at = [df.columns.index(n) for n in names]
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(at, names, strict=True)])


def doc_texts(docs: DataFrame) -> DataFrame:
    """(id long, text string) without nulls."""
    small_batches(docs.sparkSession)
    d = pick(docs, "doc_id", "text")
    return d.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def public_id(c: str = "id") -> Column:
    return F.nullif(F.col(c), F.lit(NULL_ID))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks it ran, and an order or a split that
    was chosen at run time (range bounds) is the same for every later read.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tabularis-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_slices(column: pa.Array, target: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets) of a non-null string column of about ``target`` bytes.

    A slice holds whole values; a longer value makes a slice of its own. ``offsets`` start at 0.
    """
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offs = np.frombuffer(off_buf, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + target, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi
