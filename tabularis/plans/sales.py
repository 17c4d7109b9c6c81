"""Weekly sales panel queries: features, seasonal-naive holdout, trend, decomposition, folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.operators import metrics as M
from tabularis.operators import timeseries as ts
from tabularis.plans.common import round_cols, view
from tabularis.plans.oracle_views import with_views

LAGS = (1, 2, 4, 13, 52)
WINDOWS = (4, 13)
TEST_WEEKS = 20


def featured_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1-W3, W5, P5, P6 over V_SALES (one shuffle on store feeds every window)."""
    s = view(spark, sf_dir, "v_sales")
    s = ts.add_calendar(s, "week")
    s = ts.add_lags(s, "store", "week", "weekly_sales", LAGS)
    s = ts.add_shifted_rolling(s, "store", "week", "weekly_sales", WINDOWS)
    feats = [f"lag_{k}" for k in LAGS] + [f"rolling_{s}_{n}" for n in WINDOWS for s in ("mean", "std")]
    return ts.drop_incomplete(s, feats)


def sales_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = featured_sales(spark, sf_dir)
    f = round_cols(f, 6, ["week_sin", "week_cos"])
    return round_cols(f, 4, [f"rolling_{s}_{n}" for n in WINDOWS for s in ("mean", "std")])


def sales_seasonal_naive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 + W7 + M1/M2: lag-52 forecast scored on the last 20 common weeks."""
    f = ts.holdout_last_dates(featured_sales(spark, sf_dir), "week", TEST_WEEKS)
    test = f.filter(F.col("is_test") == 1)
    m = M.regression_metrics(test, "weekly_sales", "lag_52")
    m = m.select(F.lit("seasonal_naive_52").alias("model"), *m.columns)
    m = round_cols(m, 4, ["mae", "rmse"])
    return round_cols(m, 8, ["r2", "mape_percent", "wmape_percent"])


def sales_centered_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + W4: total by week and its centred 13-week mean."""
    s = view(spark, sf_dir, "v_sales")
    tot = s.groupBy("week").agg(F.sum("weekly_sales").alias("total_sales"))
    tot = ts.add_centered_mean(tot, None, "week", "total_sales", 13)
    return round_cols(tot, 2)


def sales_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive decomposition (period 52) of the weekly totals."""
    s = view(spark, sf_dir, "v_sales")
    tot = s.groupBy("week").agg(F.sum("weekly_sales").alias("total_sales"))
    d = ts.seasonal_decompose(tot, "week", "total_sales", 52)
    return round_cols(d, 1)


def sales_date_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expanding-window folds on the training weeks; sizes per fold and role."""
    f = ts.holdout_last_dates(featured_sales(spark, sf_dir), "week", TEST_WEEKS)
    train = f.filter(F.col("is_test") == 0).select("store", "week", "weekly_sales")
    folds = ts.expanding_date_folds(train, "week", 3)
    return folds.groupBy("fold", "role").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("week").alias("n_weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )


# ---------------------------------------------------------------- oracle SQL (DuckDB) ----
_FEAT_CTE = """feat_all AS (
  SELECT store, week, weekly_sales,
         CAST(year(week) AS INTEGER) AS year, CAST(month(week) AS INTEGER) AS month,
         CAST(quarter(week) AS INTEGER) AS quarter, CAST(weekofyear(week) AS INTEGER) AS week_of_year,
         round(sin(2 * pi() * weekofyear(week) / 52.0), 6) AS week_sin,
         round(cos(2 * pi() * weekofyear(week) / 52.0), 6) AS week_cos,
         lag(weekly_sales, 1) OVER w AS lag_1, lag(weekly_sales, 2) OVER w AS lag_2,
         lag(weekly_sales, 4) OVER w AS lag_4, lag(weekly_sales, 13) OVER w AS lag_13,
         lag(weekly_sales, 52) OVER w AS lag_52,
         CASE WHEN count(weekly_sales) OVER w4 = 4 THEN round(avg(weekly_sales) OVER w4, 4) END AS rolling_mean_4,
         CASE WHEN count(weekly_sales) OVER w4 = 4 THEN round(stddev_samp(weekly_sales) OVER w4, 4) END AS rolling_std_4,
         CASE WHEN count(weekly_sales) OVER w13 = 13 THEN round(avg(weekly_sales) OVER w13, 4) END AS rolling_mean_13,
         CASE WHEN count(weekly_sales) OVER w13 = 13 THEN round(stddev_samp(weekly_sales) OVER w13, 4) END AS rolling_std_13
  FROM v_sales
  WINDOW w AS (PARTITION BY store ORDER BY week),
         w4 AS (PARTITION BY store ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
         w13 AS (PARTITION BY store ORDER BY week ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING)),
feat AS (
  SELECT * FROM feat_all
  WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_4 IS NOT NULL AND lag_13 IS NOT NULL AND lag_52 IS NOT NULL
    AND rolling_mean_4 IS NOT NULL AND rolling_std_4 IS NOT NULL AND rolling_mean_13 IS NOT NULL AND rolling_std_13 IS NOT NULL),
test AS (
  SELECT * FROM feat WHERE week >= (SELECT min(week) FROM (SELECT DISTINCT week FROM feat ORDER BY week DESC LIMIT 20) t))"""

_TOTALS = "tot AS (SELECT week, sum(weekly_sales) AS total_sales FROM v_sales GROUP BY week)"

ORACLE = {
    "sales_features": with_views("SELECT * FROM feat", "v_sales", extra=_FEAT_CTE),
    "sales_seasonal_naive_metrics": with_views(
        """SELECT 'seasonal_naive_52' AS model,
       round(avg(abs(lag_52 - weekly_sales)), 4) AS mae,
       round(sqrt(avg((lag_52 - weekly_sales) * (lag_52 - weekly_sales))), 4) AS rmse,
       round(1 - sum((lag_52 - weekly_sales) * (lag_52 - weekly_sales)) / (var_pop(weekly_sales) * count(weekly_sales)), 8) AS r2,
       round(avg(abs(lag_52 - weekly_sales) / greatest(abs(weekly_sales), 1.0)) * 100, 8) AS mape_percent,
       round(sum(abs(lag_52 - weekly_sales)) / sum(abs(weekly_sales)) * 100, 8) AS wmape_percent,
       count(weekly_sales) AS n
FROM test""",
        "v_sales", extra=_FEAT_CTE,
    ),
    "sales_centered_trend": with_views(
        """SELECT week, round(total_sales, 2) AS total_sales,
       round(CASE WHEN count(total_sales) OVER c = 13 THEN avg(total_sales) OVER c END, 2) AS centered_mean_13
FROM tot WINDOW c AS (ORDER BY week ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)""",
        "v_sales", extra=_TOTALS,
    ),
    "sales_decompose": with_views(
        """SELECT week, round(y, 1) AS y, round(trend, 1) AS trend, round(seasonal, 1) AS seasonal,
       round(y - trend - seasonal, 1) AS resid
FROM d3""",
        "v_sales",
        extra=_TOTALS + """,
s AS (SELECT week, total_sales AS y, row_number() OVER (ORDER BY week) - 1 AS pos FROM tot),
ma AS (SELECT *, CASE WHEN count(y) OVER f = 53
                     THEN (sum(y) OVER f - (lag(y, 26) OVER o + lead(y, 26) OVER o) / 2) / 52 END AS ma
       FROM s WINDOW f AS (ORDER BY week ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING), o AS (ORDER BY week)),
ends AS (SELECT min(pos) AS fp, max(pos) AS lp FROM ma WHERE ma IS NOT NULL),
head AS (SELECT regr_slope(ma, pos) AS k, regr_intercept(ma, pos) AS c FROM ma, ends
         WHERE ma IS NOT NULL AND pos < fp + 52),
tail AS (SELECT regr_slope(ma, pos) AS k, regr_intercept(ma, pos) AS c FROM ma, ends
         WHERE ma IS NOT NULL AND pos >= lp - 52 AND pos < lp),
d1 AS (SELECT ma.week, ma.y, ma.pos, ma.pos % 52 AS season_pos,
              coalesce(ma.ma, CASE WHEN ma.pos < ends.fp THEN head.c + head.k * ma.pos ELSE tail.c + tail.k * ma.pos END) AS trend
       FROM ma, ends, head, tail),
sp AS (SELECT season_pos, avg(y - trend) AS sp FROM d1 GROUP BY season_pos),
d3 AS (SELECT d1.week, d1.y, d1.trend, sp.sp - (SELECT avg(sp) FROM sp) AS seasonal
       FROM d1 JOIN sp ON d1.season_pos = sp.season_pos)""",
    ),
    "sales_date_folds": with_views(
        """SELECT fold, role, count(*) AS n_rows, count(DISTINCT week) AS n_weeks,
       min(week) AS first_week, max(week) AS last_week
FROM (SELECT t.*, f.fold,
             CASE WHEN r.date_rank >= m.m - (3 - f.fold) * (m.m // 4) THEN 'validate' ELSE 'train' END AS role,
             r.date_rank, m.m, f.fold AS ff
      FROM train t JOIN ranks r ON t.week = r.week
      CROSS JOIN (SELECT count(*) AS m FROM ranks) m
      CROSS JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(3)) f
      WHERE r.date_rank < m.m - (3 - f.fold) * (m.m // 4) + (m.m // 4)) x
GROUP BY fold, role""",
        "v_sales",
        extra=_FEAT_CTE + """,
train AS (SELECT store, week, weekly_sales FROM feat WHERE week NOT IN (SELECT week FROM test)),
ranks AS (SELECT week, dense_rank() OVER (ORDER BY week) - 1 AS date_rank FROM (SELECT DISTINCT week FROM train) d)""",
    ),
}

QUERIES = {
    "sales_features": sales_features,
    "sales_seasonal_naive_metrics": sales_seasonal_naive_metrics,
    "sales_centered_trend": sales_centered_trend,
    "sales_decompose": sales_decompose,
    "sales_date_folds": sales_date_folds,
}
