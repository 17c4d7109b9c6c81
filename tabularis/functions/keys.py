"""Deterministic row keys and hash draws shared by splits, samplers and fixtures.

md5 hex is identical in Spark and DuckDB, so every draw made here can be reproduced by
an oracle query. Nothing depends on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(*cols: str | Column) -> Column:
    """``a:b:c`` text of the key columns (dates rendered as yyyy-MM-dd)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def lineitem_key() -> Column:
    """Unique lineitem row key text: orderkey:linenumber:partkey:suppkey:ship_date."""
    return key_text(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date")
    )


def seeded_md5(seed: int | str, key: Column) -> Column:
    """md5 of ``seed:key`` — a reproducible pseudo-random order for a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key))


def hex_prefix_int(hex_col: Column, digits: int) -> Column:
    """Integer value of the first ``digits`` hex characters of a md5 string."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long")


def unit_draw(hex_col: Column, start: int = 1) -> Column:
    """A number in [0, 1) from 8 hex digits starting at ``start``."""
    return F.conv(F.substring(hex_col, start, 8), 16, 10).cast("double") / F.lit(4294967296.0)
