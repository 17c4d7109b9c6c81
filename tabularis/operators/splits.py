"""Deterministic splits and samplers (X1-X7, L9 counts).

Membership is decided by ``md5(seed:key)`` order, so it is reproducible across runs,
engines and partitionings. Row numbers come from the two-stage ranking in ``ranking.py``
(no single-task window even when one stratum holds most rows).
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.functions.keys import seeded_md5
from tabularis.operators.ranking import global_row_number
from tabularis.session import cut_lineage, spread

SEED = 42
#: Leading hex digits by which rows are counted to find where a stratum's quota ends.
CUT_DIGITS = 3


def ceil_fraction(n: int, fraction: float) -> int:
    """ceil(n·fraction) in integer arithmetic (fraction as a ratio of small integers)."""
    f = Fraction(fraction).limit_denominator(10000)
    return (n * f.numerator + f.denominator - 1) // f.denominator


def _key(c: str | Column) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c


def _count(df: DataFrame) -> int:
    return df.count()


def random_split(df: DataFrame, key: str | Column, test_fraction: float = 0.2, seed: int = SEED, out: str = "split") -> DataFrame:
    """The first ceil(n·f) rows in md5 order are ``test``, the rest ``train``."""
    n = _count(df)
    n_test = ceil_fraction(n, test_fraction)
    ranked = global_row_number(df, seeded_md5(seed, _key(key)), out="_rn", rows=n)
    return ranked.withColumn(out, F.when(F.col("_rn") <= n_test, "test").otherwise("train")).drop("_rn")


def stratum_quotas(df: DataFrame, label: str, total: int | None = None, fraction: float | None = None) -> dict:
    """Largest-remainder allocation of ``total`` rows (or ceil(n·fraction)) over strata.

    The class-count table has one row per class, so it is read on the driver; remainder
    ties go to the smaller label. Returns {label: quota}.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).agg(F.count("*")).collect()}
    n = sum(counts.values())
    if total is None:
        total = ceil_fraction(n, fraction)
    if total <= 0 or total >= n:
        return dict(counts) if total >= n else {k: 0 for k in counts}
    base = {k: v * total // n for k, v in counts.items()}
    rem = {k: v * total % n for k, v in counts.items()}
    left = total - sum(base.values())
    for i, k in enumerate(sorted(counts, key=lambda k: (-rem[k], k))):
        if i < left:
            base[k] += 1
    return base


def _quota_col(label: str, quotas: dict) -> Column:
    m = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.col(label)], F.lit(0))


def _cuts(marks: DataFrame, label: str, quotas: dict) -> list:
    """(label, cut, keep, ties) of each stratum with a quota: the md5 at which it is full, how many rows of that md5 belong to it, and
    how many there are. Only the rows that share the leading digits of a cut are sorted."""
    marks = marks.withColumn("_bucket", F.substring("_ord", 1, CUT_DIGITS))
    counts = marks.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))  # a row a bucket
    run = counts.withColumn("_run", F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket"))).withColumn("_q", _quota_col(label, quotas))
    # a quota of the whole stratum or more is full with its last row
    run = run.withColumn("_q", F.least("_q", F.sum("_n").over(Window.partitionBy(label))))
    border = run.where("_q > 0 AND _run >= _q AND _run - _n < _q").select(label, "_bucket", (F.col("_q") - F.col("_run") + F.col("_n")).alias("_left"))
    found = marks.join(F.broadcast(border), [label, "_bucket"])
    order = Window.partitionBy(label).orderBy("_ord")
    found = found.select(label, "_ord", "_left", F.row_number().over(order).alias("_rn"), F.rank().over(order).alias("_first"), F.count("*").over(Window.partitionBy(label, "_ord")).alias("ties"))
    return found.where("_rn = _left").select(label, "_ord", (F.col("_left") - F.col("_first") + 1).alias("keep"), "ties").collect()


def stratified_take(
    df: DataFrame, key: str | Column, label: str, quotas: dict, seed: int = SEED, out: str = "picked"
) -> DataFrame:
    """Per stratum, the first ``quota`` rows in md5 order are picked (``out`` = 1).

    A row is picked by comparing its md5 with the one at which its stratum is full, so the rows themselves are neither sorted nor
    moved. Rows of one key that a cut goes through are numbered, and the result is written, so that it is the same at every reading.
    """
    rows = df.where(F.col(label).isNotNull()).select(label, *[c for c in df.columns if c != label]).withColumn("_ord", seeded_md5(seed, _key(key)))
    cuts = _cuts(rows.select(label, "_ord"), label, quotas)  # an md5 is made again rather than written: it is as long as a row
    at = lambda pairs: F.create_map(*[F.lit(x) for kv in pairs for x in kv])[F.col(label)] if pairs else F.lit(None)
    cut = at([(r[0], r[1]) for r in cuts])
    torn = [(r[0], r["keep"]) for r in cuts if r["ties"] > r["keep"]]
    picked = rows.withColumn(out, F.coalesce(F.col("_ord") <= cut, F.lit(False)).cast("int"))
    if not torn:
        return picked.drop("_ord")
    on_cut = F.coalesce((F.col("_ord") == cut) & at(torn).isNotNull(), F.lit(False))
    number = F.row_number().over(Window.partitionBy(label).orderBy("_ord"))
    some = rows.where(on_cut).withColumn(out, (number <= at(torn)).cast("int"))
    return cut_lineage(picked.where(~on_cut).unionByName(some).drop("_ord"))


def stratified_split(
    df: DataFrame, key: str | Column, label: str, test_fraction: float = 0.2, seed: int = SEED, out: str = "split"
) -> DataFrame:
    """Test size ceil(n·f) allocated over classes by largest remainder."""
    q = stratum_quotas(df, label, fraction=test_fraction)
    t = stratified_take(df, key, label, q, seed, "_t")
    return t.withColumn(out, F.when(F.col("_t") == 1, "test").otherwise("train")).drop("_t")


def stratified_subset(df: DataFrame, key: str | Column, label: str, size: int, seed: int = SEED) -> DataFrame:
    """A stratified sample of ``size`` rows; the whole table when size <= 0 or >= n."""
    n = _count(df)
    total = n if size <= 0 or size >= n else size
    q = stratum_quotas(df, label, total=total)
    return stratified_take(df, key, label, q, seed, "_p").filter(F.col("_p") == 1).drop("_p")


def three_way_split(
    df: DataFrame, key: str | Column, label: str, test_fraction: float = 0.2, validation_fraction: float = 0.25,
    seed: int = SEED,
) -> DataFrame:
    """Stratified test split, then a stratified validation split of the remainder."""
    # every pass over the rows reads them from files that all tasks have a share of
    held = cut_lineage(df)
    if len(held.inputFiles()) < 2 * df.sparkSession.sparkContext.defaultParallelism:  # a large table is in many files anyway
        held = cut_lineage(spread(held))
    first = stratified_split(held, key, label, test_fraction, seed, "_s1")
    test = first.filter(F.col("_s1") == "test").withColumn("split", F.lit("test")).drop("_s1")
    rest = first.filter(F.col("_s1") == "train").drop("_s1")
    second = stratified_split(rest, key, label, validation_fraction, seed + 1, "_s2")
    second = second.withColumn("split", F.when(F.col("_s2") == "test", "validation").otherwise("train")).drop("_s2")
    return test.unionByName(second)


def stratified_folds(df: DataFrame, key: str | Column, label: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """fold = (row number within class in md5 order - 1) mod k; class sizes differ by <= 1 per fold."""
    ranked = global_row_number(df, seeded_md5(seed, _key(key)), partition_cols=[label], out="_rn")
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def shuffled_take(df: DataFrame, key: str | Column, n: int, seed: int = SEED) -> DataFrame:
    """The first ``n`` rows of a seeded shuffle (a top-k on the md5 order, no full sort)."""
    return df.withColumn("_o", seeded_md5(seed, _key(key))).orderBy("_o").limit(n).drop("_o")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k · n_c) per class (one row per class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_c"))
    n = counts.select(F.sum("n_c")).scalar()
    k = counts.select(F.count("*")).scalar()
    return counts.select(label, "n_c", (F.lit(1.0) * n / (k * F.col("n_c"))).alias("weight"))


def positive_weight(df: DataFrame, label: str) -> Column:
    """Negatives / positives (scalar subquery), the per-positive weight of a binary task."""
    return df.select(F.count_if(F.col(label) != 1) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).scalar()


def with_weight(df: DataFrame, label: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    """Attach per-row class weights (weights table: one row per class)."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(out))), label, "left")  # no row moves to its class's task


def fold_sizes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))
