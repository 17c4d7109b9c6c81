"""Supervised learners, tuning loops and importances on ``pyspark.ml``.

Parameter mapping to the studied library calls:
* ridge α  -> ``LinearRegression(regParam = α·σ_y/n, elasticNetParam=0, standardization=False)``
  with σ_y the population std of the label (Spark scales the L2 term by σ_y/n);
* logistic C -> ``LogisticRegression(regParam = 1/(C·n), elasticNetParam=0, standardization=False)``;
* trees, forests and boosting -> ``operators.trees`` and ``operators.boosting``; RBF SVM -> ``operators.kernel_svm``.
Metrics come from ``tabularis.operators.metrics`` (aggregate queries, not driver loops).
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def features_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (), out: str = "features") -> list:
    """StringIndexer (alphabetical, unknown kept) + OneHotEncoder (unknown -> zeros) + assembler."""
    stages = []
    cat_out = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh", dropLast=True, handleInvalid="keep"))
        cat_out.append(f"{c}_oh")
    stages.append(VectorAssembler(inputCols=list(numeric) + cat_out, outputCol=out, handleInvalid="keep"))
    return stages


def ridge_reg_param(alpha: float, n: int, sigma_y: float) -> float:
    return alpha * sigma_y / n if n and sigma_y else alpha


def timed(run):
    """The result of ``run`` and the seconds it took (M17); ``run`` must do its work, not only plan it."""
    t = time.time()
    out = run()
    return out, time.time() - t


def positive_probability(df: DataFrame, col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


# L1 / L2 ----------------------------------------------------------------------------------
def ols_simple(train: DataFrame, x: str, y: str) -> tuple[Column, Column]:
    """Closed-form simple regression coefficients as aggregate expressions (slope, intercept)."""
    row = train.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).first()
    return F.lit(row["b"]), F.lit(row["a"])


def linear_fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, reg: float = 0.0) -> PipelineModel:
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                          solver="normal", standardization=False)
    return Pipeline(stages=features_pipeline(numeric, categorical) + [lr]).fit(train)


# L8 ---------------------------------------------------------------------------------------
def random_fourier(df: DataFrame, cols: Sequence[str], n_features: int, gamma: float, seed: int = 42, out: str = "rff") -> DataFrame:
    """RBF kernel map z(x) = sqrt(2/D)·cos(Wx + b), W ~ N(0, 2γ), b ~ U(0, 2π) (Rahimi & Recht).

    W and b are parameters (D × d numbers) drawn on the driver from ``seed``; the map is an
    Arrow-batched pandas UDF (one matrix product per batch) on the executors.
    """
    import pandas as pd
    from pyspark.sql.functions import PandasUDFType, pandas_udf

    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_features, len(cols)))
    b = rng.uniform(0, 2 * math.pi, size=n_features)
    scale = math.sqrt(2.0 / n_features)

    def _map(x):  # pandas Series of feature arrays -> Series of feature-map arrays
        X = np.stack(x.to_numpy()).astype(float)
        return pd.Series(list(scale * np.cos(X @ W.T + b)))

    rff = pandas_udf(_map, "array<double>", PandasUDFType.SCALAR)

    return df.withColumn(out, array_to_vector(rff(F.array(*[F.col(c).cast("double") for c in cols]))))


# L12 / L13 --------------------------------------------------------------------------------
def grid_search(fit_eval, grid: Sequence[dict], parallel: int = 4) -> list[dict]:
    """Evaluate every parameter set (each a Spark job) from a small driver thread pool."""
    with ThreadPoolExecutor(parallel) as ex:
        return list(ex.map(fit_eval, grid))


# L15 --------------------------------------------------------------------------------------
def permuted_frames(df: DataFrame, key: str, cols: Sequence[str], repeats: int, seed: int = 42) -> DataFrame:
    """Long frame (feature, rep, rows of ``df`` with that feature shuffled) for all features and repeats.

    Row i takes the value of the row at the same rank in the repeat's md5 order: ranks by key and by
    (repeat, md5), an equi-join on (rep, rank). One frame, so that one scoring pass serves them all.
    """
    from tabularis.operators.ranking import global_row_number

    n = df.count()
    base = global_row_number(df, F.md5(F.col(key).cast("string")), out="_rank", rows=n)
    reps = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("rep")
    donors = df.select(key, *cols, reps)
    order = F.md5(F.concat_ws(":", (F.col("rep") * 1000 + seed).cast("string"), F.col(key).cast("string")))
    donors = global_row_number(donors, order, partition_cols=["rep"], out="_rank", rows=n * repeats)
    donors = donors.select("rep", "_rank", *[F.col(c).alias(f"_d_{c}") for c in cols])
    long = base.join(donors, "_rank").withColumn("feature", F.explode(F.array(*[F.lit(c) for c in cols])))
    swapped = [F.when(F.col("feature") == c, F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    return long.select("feature", "rep", *swapped)


def logistic_learners(rows: int) -> dict:
    """L4 for several classes: C maps to 1 / (C · rows)."""
    return {f"logistic_C{c}": LogisticRegression(maxIter=500, regParam=1.0 / (c * rows), family="multinomial", standardization=False) for c in (0.1, 1.0, 10.0)}
