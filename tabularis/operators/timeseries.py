"""Per-group time-series features, holdouts and decomposition.

All windows are partitioned by the series key, so a panel with many series spreads over
many tasks. Frames are row based (gaps are not filled), like the studied pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.functions.columns import calendar_parts, cyclic_week


def add_calendar(df: DataFrame, date_col: str) -> DataFrame:
    """P5 + P6: year, month, quarter, ISO week, and sin/cos of the week."""
    df = df.select("*", *calendar_parts(date_col))
    return df.select("*", *cyclic_week("week_of_year"))


def add_lags(df: DataFrame, key: str | list[str], order: str, target: str, lags=(1, 2, 4, 13, 52)) -> DataFrame:
    """``lag_k`` = target k rows earlier in the same series."""
    w = Window.partitionBy(key).orderBy(order)
    return df.select("*", *[F.lag(target, k).over(w).alias(f"lag_{k}") for k in lags])


def add_shifted_rolling(
    df: DataFrame, key: str | list[str], order: str, target: str, windows=(4, 13), stats=("mean", "std")
) -> DataFrame:
    """Mean / sample std over the ``w`` rows strictly before each row; NULL until full."""
    cols: list[Column] = []
    for n in windows:
        w = Window.partitionBy(key).orderBy(order).rowsBetween(-n, -1)
        full = F.count(target).over(w) == n
        if "mean" in stats:
            cols.append(F.when(full, F.avg(target).over(w)).alias(f"rolling_mean_{n}"))
        if "std" in stats:
            cols.append(F.when(full, F.stddev_samp(target).over(w)).alias(f"rolling_std_{n}"))
    return df.select("*", *cols)


def add_centered_mean(df: DataFrame, key: str | list[str] | None, order: str, target: str, n: int = 13) -> DataFrame:
    """Centred mean over ``n`` rows (odd), NULL where the frame is not full."""
    half = n // 2
    w = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy(order).rowsBetween(-half, half)
    full = F.count(target).over(w) == n
    return df.withColumn(f"centered_mean_{n}", F.when(full, F.avg(target).over(w)))


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows whose feature history is complete."""
    return df.dropna(subset=cols)


def last_n_dates(df: DataFrame, date_col: str, n: int) -> Column:
    """W7 helper: scalar-subquery cut-off = the n-th latest distinct date (top-k, no global window)."""
    top = df.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(n)
    return top.select(F.min(date_col)).scalar()


def holdout_last_dates(df: DataFrame, date_col: str, n: int = 20) -> DataFrame:
    """``is_test`` = row falls in the last ``n`` common dates."""
    cut = last_n_dates(df, date_col, n)
    return df.withColumn("is_test", (F.col(date_col) >= cut).cast("int"))


def expanding_date_folds(df: DataFrame, date_col: str, n_splits: int = 3) -> DataFrame:
    """Expanding-window folds over distinct dates.

    With ``m`` distinct dates, block size ``b = m // (n_splits + 1)``; fold i (0-based)
    validates on date ranks ``[m - (n_splits - i)·b, m - (n_splits - i - 1)·b)`` and trains on
    every earlier date. Returns one row per (fold, row) that takes part, with ``role``.
    """
    dates = df.select(date_col).distinct()
    # rank of each distinct date: the distinct-date table is calendar sized, not data sized
    ranked = dates.select(date_col, (F.dense_rank().over(Window.orderBy(date_col)) - 1).alias("date_rank"))
    m = dates.select(F.count("*")).scalar()
    b = F.floor(m / (n_splits + 1))
    folds = df.sparkSession.range(n_splits).select(F.col("id").cast("int").alias("fold"))
    starts = folds.select("fold", (m - (F.lit(n_splits) - F.col("fold")) * b).alias("v_start"))
    dr = ranked.join(F.broadcast(starts), ranked.date_rank < starts.v_start + b)
    dr = dr.select(
        date_col, "fold",
        F.when(F.col("date_rank") >= F.col("v_start"), "validate").otherwise("train").alias("role"),
    )
    return df.join(dr, date_col)


def seasonal_decompose(df: DataFrame, date_col: str, target: str, period: int = 52) -> DataFrame:
    """Additive decomposition of one series (rows ordered by date).

    trend    = centred 2×period moving average (weights ½,1,…,1,½ over period+1 rows);
    ends     = least-squares line extrapolated over the missing ends; the head line fits the
               first ``period`` trend points, the tail line the ``period`` points before the
               last one (the last point itself is left out, as in the common library routine);
    seasonal = mean of (y - trend) per position mod period, minus the mean of those means;
    resid    = y - trend - seasonal.
    The series is a per-date aggregate (calendar sized), so single-series windows are fine.
    """
    half = period // 2
    w = Window.orderBy(date_col)
    s = df.select(date_col, F.col(target).alias("y"), (F.row_number().over(w) - 1).alias("pos"))
    wf = w.rowsBetween(-half, half)
    edge = F.lag("y", half).over(w) + F.lead("y", half).over(w)
    centred = (F.sum("y").over(wf) - edge / 2) / period
    full = F.count("y").over(wf) == period + 1
    s = s.withColumn("ma", F.when(full, centred))
    # least-squares lines through the first / last `period` available trend points
    valid = s.filter(F.col("ma").isNotNull())
    first_pos = valid.select(F.min("pos")).scalar()
    last_pos = valid.select(F.max("pos")).scalar()
    head = valid.filter(F.col("pos") < first_pos + period)
    tail = valid.filter((F.col("pos") >= last_pos - period) & (F.col("pos") < last_pos))
    h_slope = head.select(F.regr_slope("ma", "pos")).scalar()
    h_icpt = head.select(F.regr_intercept("ma", "pos")).scalar()
    t_slope = tail.select(F.regr_slope("ma", "pos")).scalar()
    t_icpt = tail.select(F.regr_intercept("ma", "pos")).scalar()
    trend = F.coalesce(
        F.col("ma"),
        F.when(F.col("pos") < first_pos, h_icpt + h_slope * F.col("pos")).otherwise(t_icpt + t_slope * F.col("pos")),
    )
    s = s.withColumn("trend", trend).withColumn("season_pos", F.col("pos") % period)
    by_pos = s.groupBy("season_pos").agg(F.avg(F.col("y") - F.col("trend")).alias("sp"))
    adj = by_pos.select(F.avg("sp")).scalar()
    seas = by_pos.select("season_pos", (F.col("sp") - adj).alias("seasonal"))
    out = s.join(F.broadcast(seas), "season_pos", "left")  # at most `period` rows
    return out.select(
        date_col, "y", "trend", "seasonal", (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid")
    )
