"""Shared helpers for the registered query plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularis.plans.views import view  # noqa: F401  (re-export for plan modules)
from tabularis.sources.tables import Tables  # noqa: F401

QueryFn = Callable[[SparkSession, str], DataFrame]


def round_cols(df: DataFrame, digits: int, cols: list[str] | None = None) -> DataFrame:
    """Round the named (default: all double) columns, keeping column order."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def sql_round(expr: str, digits: int) -> str:
    return f"round({expr}, {digits})"
