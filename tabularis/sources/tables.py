"""Parquet table scans over a scale-factor directory (S5) with ingest normalisation."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Columns known to carry negative zero; ``x + 0.0`` turns -0.0 into 0.0 in every engine.
_NEG_ZERO_COLS = {"lineitem": ("l_discount", "l_tax")}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. Column pruning and filters reach the parquet scan via Catalyst."""
    df = spark.read.parquet(table_path(sf_dir, name))
    for c in _NEG_ZERO_COLS.get(name, ()):
        df = df.withColumn(c, F.col(c) + F.lit(0.0))
    return df


class Tables:
    """Lazy accessor: ``t.lineitem`` returns the scan DataFrame (nothing is read until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
