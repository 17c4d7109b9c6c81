"""Encoders fitted on a training frame and applied to any frame.

Fitted state is a small DataFrame (one row of statistics, or one row per category);
``transform`` applies it with column expressions or a join against that table, so the
data itself never leaves the executors.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularis.operators.profile import quantile_values
from tabularis.operators.ranking import range_rank


def safe_col_name(v) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(v)).strip("_")


# E1 / E2 ----------------------------------------------------------------------------------
# Fitted statistics are a handful of numbers: they are read once on the driver (one small
# aggregate row per fit) and applied as literals, so no transform re-runs the fit.
def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Exact medians (linear interpolation) per column."""
    m = quantile_values(train, cols, [0.5])
    return {c: F.lit(m.get((c, 0.5))) for c in cols}


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Most frequent value per column; ties go to the smallest value."""
    out = {}
    for c in cols:
        counts = train.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        out[c] = F.lit(counts.agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c))).alias("m")).first()["m"])
    return out


def impute(df: DataFrame, fills: dict[str, Column]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), fills[c]).alias(c) if c in fills else F.col(c) for c in df.columns])


# E3 / E4 ----------------------------------------------------------------------------------
@dataclass
class ScalerState:
    mean: dict[str, Column]
    std: dict[str, Column]


def fit_standard(train: DataFrame, cols: Sequence[str]) -> ScalerState:
    """Mean and population std per column (one aggregate pass); a zero std scales by 1."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    mean = {c: F.lit(row[f"m_{c}"]) for c in cols}
    std = {c: F.lit(1.0 if not row[f"s_{c}"] else row[f"s_{c}"]) for c in cols}
    return ScalerState(mean, std)


def standardize(df: DataFrame, st: ScalerState, suffix: str = "") -> DataFrame:
    return df.select(
        *[((F.col(c) - st.mean[c]) / st.std[c]).alias(c + suffix) if c in st.mean else F.col(c) for c in df.columns]
    )


def unstandardize(df: DataFrame, st: ScalerState, cols: Sequence[str], suffix: str = "") -> DataFrame:
    return df.select(
        "*", *[(F.col(c + suffix) * st.std[c] + st.mean[c]).alias(f"{c}_orig") for c in cols]
    )


# E5 / E6 / E7 / E8 ------------------------------------------------------------------------
def fit_categories(train: DataFrame, c: str) -> list:
    """Sorted distinct non-null categories. They become output columns, so their list is as long as
    the result is wide; ``one_hot_vector`` keeps any number of categories in one sparse column."""
    return [r[0] for r in train.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).collect()]


def one_hot_vector(df: DataFrame, c: str, table: DataFrame, drop_first: bool = False, out: str | None = None) -> DataFrame:
    """Exact indicators as one sparse column ``map<code, 1>`` for any number of categories.

    ``table`` comes from ``fit_ordinal``; unknown and NULL (and the first category with
    ``drop_first``) give the empty map, that is all zeros.
    """
    code = ordinal(df, c, table, out="_hot")
    some = F.col("_hot") >= (1 if drop_first else 0)
    at = F.col("_hot") - (1 if drop_first else 0)
    hot = F.when(some, F.create_map(at, F.lit(1))).otherwise(F.create_map().cast("map<int,int>"))
    return code.withColumn(out or f"{c}_hot", hot).drop("_hot", c)


def one_hot(df: DataFrame, c: str, categories: Sequence, drop_first: bool = False) -> DataFrame:
    """Indicator per category (alphabetical); unknown and NULL give all zeros."""
    cats = list(categories)[1:] if drop_first else list(categories)
    ind = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{safe_col_name(v)}") for v in cats]
    return df.select(*[x for x in df.columns if x != c], *ind)


def fit_ordinal(train: DataFrame, c: str) -> DataFrame:
    """Category table (value, code) with codes 0.. in sorted order, any number of categories."""
    d = train.select(F.col(c).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    return range_rank(d, "_v", "_code").select("_v", (F.col("_code") - 1).cast("int").alias("_code"))


def ordinal(df: DataFrame, c: str, table: DataFrame, unknown: int = -1, out: str | None = None) -> DataFrame:
    """Code lookup by a join against the category table; unknown/NULL -> ``unknown``."""
    out = out or f"{c}_code"
    j = df.join(table, df[c] == table["_v"], "left")
    return j.withColumn(out, F.coalesce(F.col("_code"), F.lit(unknown)).cast("int")).drop("_v", "_code")


# E9 ---------------------------------------------------------------------------------------
def scaling_stage(train: DataFrame, cols: Sequence[str], prefix: str = "z_") -> SQLTransformer:
    """Standard scaling (population std, a zero std scales by 1) as a pipeline stage that can be
    saved: the fitted numbers stand in the stage's SQL. Adds ``prefix + column``."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    scaled = [f"(CAST({c} AS DOUBLE) - ({row[f'm_{c}']!r}D)) / {row[f's_{c}'] or 1.0!r}D AS {prefix}{c}" for c in cols]
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")
