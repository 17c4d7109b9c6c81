"""Scalable ordered operations: prefix sums and global row numbers without a one-task window.

A window with ``orderBy`` and no ``partitionBy`` runs in a single task. Here the ordered
domain is first cut into buckets (a monotone function of the order key); per-bucket totals
(a table with one row per bucket) get a running offset, and the within-bucket work is a
window partitioned by bucket. The result equals the plain global window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.session import cut_lineage

BUCKET_ROWS = 1_000_000  # rows that one task sorts


def hex_digits(rows: int) -> int:
    """Leading hex digits of a hash that cut ``rows`` rows into buckets of BUCKET_ROWS (256 buckets at least)."""
    return max(2, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16)) if rows > BUCKET_ROWS else 2)


def range_rank(df: DataFrame, key: str, out: str = "rn") -> DataFrame:
    """1-based rank of distinct keys in sorted order: ranges sorted apart, offsets by range counts.

    The ranges are written once, so that their bounds are the same for the counts and the rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, key).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_range").orderBy(key)
    return ranged.join(offsets, "_range").withColumn(out, F.col("_off") + F.row_number().over(within)).drop("_range", "_off")


def prefix_sums(
    df: DataFrame,
    order_cols: list[Column],
    bucket: Column,
    value_cols: list[str],
    inclusive: bool = True,
    partition_cols: list[str] | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` = running sum of each value column in ``order_cols`` order.

    ``bucket`` must be monotone non-decreasing along ``order_cols`` (ties of the order key
    must share a bucket). ``partition_cols`` restart the sums per group.
    """
    parts = list(partition_cols or [])
    b = df.withColumn("_bucket", bucket)
    totals = b.groupBy(*parts, "_bucket").agg(*[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    # bucket totals are tiny (one row per bucket); their running offsets use a small window
    wb = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, "_bucket",
        *[F.coalesce(F.sum(f"_tot_{v}").over(wb), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
    )
    b = b.join(offsets, [*parts, "_bucket"])
    frame_end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*parts, "_bucket").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    out = b.select(
        "*",
        *[(F.col(f"_off_{v}") + F.coalesce(F.sum(v).over(w), F.lit(0))).alias(f"cum_{v}") for v in value_cols],
    )
    return out.drop("_bucket", *[f"_off_{v}" for v in value_cols])


def global_row_number(
    df: DataFrame, order_hex: Column, partition_cols: list[str] | None = None, out: str = "rn", rows: int | None = None
) -> DataFrame:
    """1-based row number in ``order_hex`` order (a hex string such as md5), optionally per group.

    Buckets are leading hex digits, as many as ``rows`` (counted if not given) asks for: a stratum
    holding a third of all rows is spread like any other rows.
    """
    parts = list(partition_cols or [])
    digits = hex_digits(df.count() if rows is None else rows)
    b = df.withColumn("_ord", order_hex).withColumn("_bucket", F.substring("_ord", 1, digits))
    counts = b.groupBy(*parts, "_bucket").agg(F.count("*").alias("_n"))
    wb = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, "_bucket", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    b = b.join(offsets, [*parts, "_bucket"])
    w = Window.partitionBy(*parts, "_bucket").orderBy("_ord")
    return b.withColumn(out, F.col("_off") + F.row_number().over(w)).drop("_ord", "_bucket", "_off")
