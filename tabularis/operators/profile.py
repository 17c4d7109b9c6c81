"""Profiles, correlations, histograms and exact quantiles.

Exact quantiles start from the count of every distinct value (combined map-side, so a value that
fills the table is one row), cut the distinct values into range buckets whose number follows
their count, and take the wanted ranks from running sums within buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.functions.columns import level_bucket
from tabularis.session import cut_lineage

BUCKET_ROWS = 1_000_000  # distinct values that one task sorts


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# A1 / A2 / A3 / A6 / A8 -------------------------------------------------------------------
def group_profile(df: DataFrame, by: str | Sequence[str], cols: Sequence[str], count_name: str = "n") -> DataFrame:
    g = _list(by)
    return df.groupBy(*g).agg(F.count("*").alias(count_name), *[F.avg(c).alias(f"avg_{c}") for c in cols])


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count("*").alias("n"))


def global_stats(df: DataFrame, c: str) -> DataFrame:
    return df.agg(
        F.count_distinct(c).alias("nunique"), F.min(c).alias("min"), F.max(c).alias("max"),
        F.avg(c).alias("mean"), F.sum(c).alias("sum"),
    )


# A4 / E1 / Q20 / A5 -----------------------------------------------------------------------
def exact_quantiles_of(
    df: DataFrame, values: Sequence[str], probs: Sequence[float], by: str | Sequence[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """Linear-interpolation quantiles (pandas/numpy default), exact, of several columns per group.

    Returns (by..., name, p, q) for all columns and probabilities from one pass. NULL and NaN
    values are ignored. ``buckets`` sets the number of ranges; by default one per BUCKET_ROWS.
    """
    g = [*_list(by), "name"]
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("_x")) for v in values]))
    x = df.select(*_list(by), pairs.alias("_p")).select(*_list(by), "_p.name", "_p._x").filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    counts = cut_lineage(x.groupBy(*g, "_x").agg(F.count("*").alias("_n")))
    buckets = buckets or max(1, math.ceil(counts.count() / BUCKET_ROWS))
    if buckets > 1:  # one edge per bucket reaches the driver
        edges = counts.agg(F.percentile_approx("_x", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0]
        edges = F.array(*[F.lit(float(e)) for e in sorted(set(edges))])
        counts = counts.withColumn("_b", F.size(F.filter(edges, lambda e: e < F.col("_x"))))
    else:
        counts = counts.withColumn("_b", F.lit(0))
    totals = counts.groupBy(*g, "_b").agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*g, "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"), F.sum("_t").over(Window.partitionBy(*g)).alias("_all"))
    within = Window.partitionBy(*g, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.join(totals, [*g, "_b"]).withColumn("_lo", F.col("_off") + F.coalesce(F.sum("_n").over(within), F.lit(0)))
    # a row stands for the ranks _lo .. _lo + _n - 1; keep it for the probabilities that need one of them
    holds = lambda r: (r >= F.col("_lo")) & (r < F.col("_lo") + F.col("_n"))
    place = lambda p: p * (F.col("_all") - 1)
    wanted = F.filter(F.array(*[F.lit(float(p)) for p in probs]), lambda p: holds(F.floor(place(p))) | holds(F.ceil(place(p))))
    hit = ranked.select(*g, "_x", "_all", F.explode(wanted).alias("p"))
    ends = hit.groupBy(*g, "p").agg(F.min("_x").alias("_a"), F.max("_x").alias("_z"), F.max("_all").alias("_all"))
    part = place(F.col("p")) - F.floor(place(F.col("p")))
    return ends.select(*g, "p", (F.col("_a") + part * (F.col("_z") - F.col("_a"))).alias("q"))


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: str | Sequence[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """As ``exact_quantiles_of`` for one column: (by..., p, q)."""
    return exact_quantiles_of(df, [value], probs, by, buckets).drop("name")


def quantile_values(df: DataFrame, values: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Quantiles of whole columns as numbers, {(column, p): q}."""
    return {(r["name"], r["p"]): r["q"] for r in exact_quantiles_of(df, values, probs).collect()}


def median_of(df: DataFrame, value: str, by=None) -> DataFrame:
    return exact_quantiles(df, value, [0.5], by).drop("p").withColumnRenamed("q", "median")


# A9 / A10 ---------------------------------------------------------------------------------
def corr_long(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Pearson correlations in one aggregate pass: all pairs (a<b order of ``cols``), or each
    column against ``target``. Output (col_a, col_b, r)."""
    pairs = [(c, target) for c in cols] if target else [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = agg.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    return long.select(
        F.split("pair", r"\|")[0].alias("col_a"), F.split("pair", r"\|")[1].alias("col_b"), "r"
    )


def strongest(corr: DataFrame, name_col: str = "col_a") -> DataFrame:
    """Arg-max of |r| with a name tie-break (smallest name wins)."""
    return corr.agg(
        F.min_by(F.struct(name_col, "r"), F.struct(-F.abs("r"), F.col(name_col))).alias("best")
    ).select(F.col(f"best.{name_col}").alias(name_col), F.col("best.r").alias("r"))


# A11 --------------------------------------------------------------------------------------
def equal_width_histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. Every bin is reported."""
    ends = df.agg(F.min(c).alias("a"), F.max(c).alias("b")).first()
    mn, mx = F.lit(ends["a"]), F.lit(ends["b"])
    width = (mx - mn) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col(c) - mn) / width).cast("int"))
    counts = df.filter(F.col(c).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = grid.join(counts, "bin", "left").fillna(0, ["n"])
    return full.select(
        F.lit(c).alias("column_name"), "bin",
        (mn + F.col("bin") * width).alias("lower"), (mn + (F.col("bin") + 1) * width).alias("upper"), "n",
    )


# C6 / C7 ----------------------------------------------------------------------------------
def segment_profile(
    df: DataFrame, cluster: str, id_col: str, income: str, spending: str, extra_means: Sequence[str] = ()
) -> DataFrame:
    """Cluster profile with names from tercile cuts (0.33 / 0.67) of the data itself."""
    df = cut_lineage(df)
    cuts = quantile_values(df, [income, spending], [0.33, 0.67])
    i_lo, i_hi, s_lo, s_hi = (F.lit(cuts.get(k)) for k in ((income, 0.33), (income, 0.67), (spending, 0.33), (spending, 0.67)))
    prof = df.groupBy(cluster).agg(
        F.count(id_col).alias("customers"),
        *[F.avg(c).alias(f"avg_{c}") for c in extra_means],
        F.avg(income).alias("avg_income"),
        F.avg(spending).alias("avg_spending"),
    )
    name = F.concat(
        level_bucket("avg_income", i_lo, i_hi), F.lit(" Income / "), level_bucket("avg_spending", s_lo, s_hi), F.lit(" Spending")
    )
    return prof.select(name.alias("segment_name"), *prof.columns)


def density(n_obs: Column, n_rows: Column, n_cols: Column) -> Column:
    """Observed cells / (rows × columns)."""
    return n_obs / (n_rows * n_cols)
