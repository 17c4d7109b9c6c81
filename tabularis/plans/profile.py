"""Profiling queries: sensor features and correlations, customer histograms, cuts, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.functions.columns import sensor_features as sensor_cols
from tabularis.operators import profile as P
from tabularis.plans.common import round_cols, view
from tabularis.plans.oracle_views import with_views

SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
DERIVED = ["temperature_difference_k", "mechanical_power_w", "tool_stress", "torque_speed_ratio"]
CUST_NUM = ["income", "spend_raw", "spending", "nation"]
HIST_BINS = 20


def ops_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = view(spark, sf_dir, "v_ops")
    return ops.select("row_key", "product_type", *SENSORS, *sensor_cols(), "failure")


def sensor_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived features from one shared definition (also used by serving)."""
    return round_cols(ops_features(spark, sf_dir), 6, DERIVED)


def sensor_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson r of every sensor and derived feature with the failure target."""
    f = ops_features(spark, sf_dir)
    return round_cols(P.corr_long(f, SENSORS + DERIVED, "failure"), 8)


def strongest_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the feature with the largest |r| against failure."""
    f = ops_features(spark, sf_dir)
    return round_cols(P.strongest(P.corr_long(f, SENSORS + DERIVED, "failure")), 8)


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full pairwise correlation table of the customer numerics."""
    return round_cols(P.corr_long(view(spark, sf_dir, "v_cust"), CUST_NUM), 8)


def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 equal-width bins of income and of spending score."""
    c = view(spark, sf_dir, "v_cust")
    h = P.equal_width_histogram(c, "income", HIST_BINS).unionByName(P.equal_width_histogram(c, "spending", HIST_BINS))
    return round_cols(h, 6)


def quantile_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: exact tercile cuts (0.33 / 0.67, linear interpolation) of income and spending."""
    c = view(spark, sf_dir, "v_cust")
    q = P.exact_quantiles_of(c, ["income", "spending"], [0.33, 0.67])
    return round_cols(q.withColumnRenamed("name", "column_name"), 6)


def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 + C7 with the market segment as the grouping."""
    c = view(spark, sf_dir, "v_cust")
    return round_cols(P.segment_profile(c, "segment", "cust_id", "income", "spending", ["nation"]), 6)


def _corr_union(pairs, src):
    return "\nUNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 8) AS r FROM {src}" for a, b in pairs)


_OPS_F = """f AS (SELECT row_key, product_type, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min,
  process_temperature_k - air_temperature_k AS temperature_difference_k,
  rotational_speed_rpm * 2 * pi() / 60 * torque_nm AS mechanical_power_w,
  torque_nm * tool_wear_min AS tool_stress,
  CASE WHEN rotational_speed_rpm = 0 THEN NULL ELSE torque_nm / rotational_speed_rpm END AS torque_speed_ratio,
  failure FROM v_ops)"""

_CUTS = """cuts AS (SELECT quantile_cont(income, 0.33) AS i_lo, quantile_cont(income, 0.67) AS i_hi,
                     quantile_cont(spending, 0.33) AS s_lo, quantile_cont(spending, 0.67) AS s_hi FROM v_cust)"""


def _hist_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, CAST(b.bin AS INTEGER) AS bin,
       round(m.mn + b.bin * (m.mx - m.mn) / 20, 6) AS lower, round(m.mn + (b.bin + 1) * (m.mx - m.mn) / 20, 6) AS upper,
       count(v.{c}) AS n
FROM range(20) b(bin) CROSS JOIN (SELECT min({c}) AS mn, max({c}) AS mx FROM v_cust) m
LEFT JOIN v_cust v ON least(19, CAST(floor((v.{c} - m.mn) / ((m.mx - m.mn) / 20)) AS INTEGER)) = b.bin
GROUP BY b.bin, m.mn, m.mx"""


ORACLE = {
    "sensor_features": with_views(
        """SELECT row_key, product_type, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min,
       round(temperature_difference_k, 6) AS temperature_difference_k, round(mechanical_power_w, 6) AS mechanical_power_w,
       round(tool_stress, 6) AS tool_stress, round(torque_speed_ratio, 6) AS torque_speed_ratio, failure FROM f""",
        "v_ops", extra=_OPS_F,
    ),
    "sensor_correlations": with_views(_corr_union([(c, "failure") for c in SENSORS + DERIVED], "f"), "v_ops", extra=_OPS_F),
    "strongest_sensor": with_views(
        "SELECT col_a, r FROM (" + _corr_union([(c, "failure") for c in SENSORS + DERIVED], "f")
        + ") x ORDER BY abs(r) DESC, col_a LIMIT 1",
        "v_ops", extra=_OPS_F,
    ),
    "corr_matrix": with_views(
        _corr_union([(a, b) for i, a in enumerate(CUST_NUM) for b in CUST_NUM[i + 1:]], "v_cust"), "v_cust"
    ),
    "histogram_bins": with_views(_hist_sql("income") + "\nUNION ALL\n" + _hist_sql("spending"), "v_cust"),
    "quantile_cuts": with_views(
        """SELECT 'income' AS column_name, CAST(0.33 AS DOUBLE) AS p, round(quantile_cont(income, 0.33), 6) AS q FROM v_cust
UNION ALL SELECT 'income', CAST(0.67 AS DOUBLE), round(quantile_cont(income, 0.67), 6) FROM v_cust
UNION ALL SELECT 'spending', CAST(0.33 AS DOUBLE), round(quantile_cont(spending, 0.33), 6) FROM v_cust
UNION ALL SELECT 'spending', CAST(0.67 AS DOUBLE), round(quantile_cont(spending, 0.67), 6) FROM v_cust""",
        "v_cust",
    ),
    "segment_profile": with_views(
        """SELECT CASE WHEN avg_income < i_lo THEN 'Low' WHEN avg_income > i_hi THEN 'High' ELSE 'Moderate' END
         || ' Income / ' ||
         CASE WHEN avg_spending < s_lo THEN 'Low' WHEN avg_spending > s_hi THEN 'High' ELSE 'Moderate' END
         || ' Spending' AS segment_name,
       segment, customers, round(avg_nation, 6) AS avg_nation, round(avg_income, 6) AS avg_income,
       round(avg_spending, 6) AS avg_spending
FROM (SELECT segment, count(cust_id) AS customers, avg(nation) AS avg_nation, avg(income) AS avg_income,
             avg(spending) AS avg_spending FROM v_cust GROUP BY segment) p, cuts""",
        "v_cust", extra=_CUTS,
    ),
}

QUERIES = {
    "sensor_features": sensor_features,
    "sensor_correlations": sensor_correlations,
    "strongest_sensor": strongest_sensor,
    "corr_matrix": corr_matrix,
    "histogram_bins": histogram_bins,
    "quantile_cuts": quantile_cuts,
    "segment_profile": segment_profile,
}
