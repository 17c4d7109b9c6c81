"""Cleaning and data-quality queries over V_DIRTY / V_OPS / lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.operators import quality as Q
from tabularis.plans.common import Tables, round_cols, view
from tabularis.plans.oracle_views import with_views

# The order-priority domain of the source table.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
BALANCE_RANGE = (-1000.0, 10000.0)
FLAGS = ("twf", "hdf", "pwf", "osf", "rnf")


def loan_rules(df: DataFrame):
    """Ordered rules; the first failure is the quarantine reason (inf already NULL)."""
    return [
        ("balance_out_of_range", Q.out_of_range("balance", *BALANCE_RANGE)),
        ("negative_amount", F.coalesce(F.col("amount") < 0, F.lit(False))),
        ("priority_not_in_domain", Q.not_in_domain("priority", PRIORITIES)),
    ]


def clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2-Q8 + Q15 in one grouped pass: distinct rows carry their multiplicity."""
    d = view(spark, sf_dir, "v_dirty")
    cols = d.columns
    g = d.groupBy(*cols).agg(F.count("*").alias("_n"))
    g2 = g.withColumn("_inf_n", Q.is_infinite("balance").cast("int") + Q.is_infinite("amount").cast("int"))
    g2 = Q.infinite_to_null(g2, ["amount", "balance"])
    g2 = g2.withColumn("reason", Q.first_failure(loan_rules(g2)))
    missing = sum((F.count_if(Q.missing_expr(g2, c)) for c in cols[1:]), F.count_if(Q.missing_expr(g2, cols[0])))
    clean = F.col("reason").isNull()
    out = g2.agg(
        F.sum("_n").alias("original_rows"),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.count("*").alias("deduplicated_rows"),
        F.sum("_inf_n").alias("infinite_values"),
        missing.alias("missing_values"),
        F.count_if(~clean).alias("invalid_rows"),
        F.count_if(clean).alias("clean_rows"),
        F.count_distinct(F.when(clean, F.col("loan_id"))).alias("distinct_loans"),
        F.avg(F.when(clean, F.col("label"))).alias("label_rate"),
        F.min(F.when(clean, F.col("amount"))).alias("amount_min"),
        F.max(F.when(clean, F.col("amount"))).alias("amount_max"),
        F.avg(F.when(clean, F.col("amount"))).alias("amount_mean"),
    )
    return round_cols(out, 4)


def missing_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 + Q8: missing count per column (>0 only) after infinities become missing."""
    d = Q.infinite_to_null(view(spark, sf_dir, "v_dirty"))
    return Q.missing_by_column(d)


def dup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: lineitem keyed by (orderkey, linenumber) — not unique — keep the last by (part, supp, date)."""
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"
    )
    return Q.keep_last(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"])


def invalid_range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6-Q8: quarantine side of the split (every failing row with its first reason)."""
    d = Q.infinite_to_null(view(spark, sf_dir, "v_dirty"))
    _, bad = Q.split_by_rules(d, loan_rules(d))
    return bad.select("loan_id", "amount", "balance", "priority", "reason")


def onehot_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: one-hot product type block (3) and failure flag block (5)."""
    ops = view(spark, sf_dir, "v_ops")
    types = ops.select(
        *[(F.col("product_type") == t).cast("int").alias(f"type_{t}") for t in ("L", "M", "H")], *FLAGS
    )
    a = Q.onehot_block_checks(types, "product_type", ["type_L", "type_M", "type_H"], 3)
    b = Q.onehot_block_checks(types, "failure_type", list(FLAGS), 5)
    return a.unionByName(b)


def multi_flag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16: positives without a type, rows with several types, per-type totals."""
    return Q.multi_flag_stats(view(spark, sf_dir, "v_ops"), "failure", list(FLAGS))


_RULES_SQL = """CASE WHEN NOT coalesce(balance BETWEEN -1000.0 AND 10000.0, false) THEN 'balance_out_of_range'
            WHEN coalesce(amount < 0, false) THEN 'negative_amount'
            WHEN coalesce(priority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'), false) THEN 'priority_not_in_domain'
       END"""

_DIRTY_NOINF = """d AS (SELECT loan_id,
  CASE WHEN isinf(amount) THEN NULL ELSE amount END AS amount,
  CASE WHEN isinf(balance) THEN NULL ELSE balance END AS balance,
  priority, segment, label FROM v_dirty)"""

def constant_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: which columns of the sensor table, widened by constant and nearly constant ones, would be dropped."""
    d = view(spark, sf_dir, "v_ops").select(
        "row_key", "product_type", "torque_nm", "failure", F.lit(7).alias("batch"), F.lit(None).cast("string").alias("note"),
        F.when(F.col("torque_nm") > 20, F.lit("x")).alias("half"), (F.col("torque_nm") * 0).alias("zero"),
    )
    gone = Q.constant_columns(d)
    kept = Q.drop_columns(d, ["row_key"]).columns
    return spark.createDataFrame([(c, c in gone, c in kept) for c in d.columns], "name string, is_constant boolean, is_kept boolean")


ORACLE = {
    "constant_column_check": with_views(
        """SELECT name, d = 1 AS is_constant, d > 1 AND name <> 'row_key' AS is_kept FROM (
  SELECT 'row_key' AS name, count(DISTINCT row_key) AS d FROM v_ops UNION ALL SELECT 'product_type', count(DISTINCT product_type) FROM v_ops
  UNION ALL SELECT 'torque_nm', count(DISTINCT torque_nm) FROM v_ops UNION ALL SELECT 'failure', count(DISTINCT failure) FROM v_ops
  UNION ALL SELECT 'batch', 1 UNION ALL SELECT 'note', 1
  UNION ALL SELECT 'half', count(DISTINCT CASE WHEN torque_nm > 20 THEN 'x' ELSE '' END) FROM v_ops
  UNION ALL SELECT 'zero', count(DISTINCT torque_nm * 0) FROM v_ops) c""",
        "v_ops",
    ),
    "clean_summary": with_views(
        f"""SELECT CAST(sum(n) AS BIGINT) AS original_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) AS deduplicated_rows,
       CAST(sum(inf_n) AS BIGINT) AS infinite_values,
       count_if(loan_id IS NULL) + count_if(amount IS NULL) + count_if(balance IS NULL) + count_if(priority IS NULL)
         + count_if(segment IS NULL) + count_if(label IS NULL) AS missing_values,
       count_if(reason IS NOT NULL) AS invalid_rows, count_if(reason IS NULL) AS clean_rows,
       count(DISTINCT CASE WHEN reason IS NULL THEN loan_id END) AS distinct_loans,
       round(avg(CASE WHEN reason IS NULL THEN label END), 4) AS label_rate,
       round(min(CASE WHEN reason IS NULL THEN amount END), 4) AS amount_min,
       round(max(CASE WHEN reason IS NULL THEN amount END), 4) AS amount_max,
       round(avg(CASE WHEN reason IS NULL THEN amount END), 4) AS amount_mean
FROM (SELECT *, {_RULES_SQL} AS reason FROM (
        SELECT loan_id, CASE WHEN isinf(amount) THEN NULL ELSE amount END AS amount,
               CASE WHEN isinf(balance) THEN NULL ELSE balance END AS balance,
               priority, segment, label, n, inf_n
        FROM (SELECT loan_id, amount, balance, priority, segment, label, count(*) AS n,
                     CAST(coalesce(isinf(balance), false) AS INTEGER) + CAST(coalesce(isinf(amount), false) AS INTEGER) AS inf_n
              FROM v_dirty GROUP BY ALL) g) g2) g3""",
        "v_dirty",
    ),
    "missing_by_column": with_views(
        """SELECT * FROM (
  SELECT 'loan_id' AS column_name, count_if(loan_id IS NULL) AS missing FROM d
  UNION ALL SELECT 'amount', count_if(amount IS NULL) FROM d
  UNION ALL SELECT 'balance', count_if(balance IS NULL) FROM d
  UNION ALL SELECT 'priority', count_if(priority IS NULL) FROM d
  UNION ALL SELECT 'segment', count_if(segment IS NULL) FROM d
  UNION ALL SELECT 'label', count_if(label IS NULL) FROM d) x WHERE missing > 0""",
        "v_dirty", extra=_DIRTY_NOINF,
    ),
    "dup_keep_last": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey DESC, l_suppkey DESC, l_shipdate DESC) AS rn
      FROM lineitem) x WHERE rn = 1""",
    "invalid_range_split": with_views(
        f"SELECT loan_id, amount, balance, priority, {_RULES_SQL} AS reason FROM d WHERE {_RULES_SQL} IS NOT NULL",
        "v_dirty", extra=_DIRTY_NOINF,
    ),
    "onehot_checks": with_views(
        """SELECT 'product_type' AS block, 3 AS n_columns, 3 AS expected_columns,
       count_if(CAST(product_type = 'L' AS INTEGER) NOT IN (0,1)) + count_if(CAST(product_type = 'M' AS INTEGER) NOT IN (0,1))
         + count_if(CAST(product_type = 'H' AS INTEGER) NOT IN (0,1)) AS non_binary_values,
       count_if(CAST(product_type = 'L' AS INTEGER) + CAST(product_type = 'M' AS INTEGER) + CAST(product_type = 'H' AS INTEGER) <> 1) AS rows_sum_not_one
FROM v_ops
UNION ALL
SELECT 'failure_type', 5, 5,
       count_if(twf NOT IN (0,1)) + count_if(hdf NOT IN (0,1)) + count_if(pwf NOT IN (0,1)) + count_if(osf NOT IN (0,1)) + count_if(rnf NOT IN (0,1)),
       count_if(twf + hdf + pwf + osf + rnf <> 1)
FROM v_ops""",
        "v_ops",
    ),
    "multi_flag_stats": with_views(
        """SELECT count(*) AS rows, CAST(sum(failure) AS BIGINT) AS positives,
       count_if(failure = 1 AND twf + hdf + pwf + osf + rnf = 0) AS positive_without_type,
       count_if(twf + hdf + pwf + osf + rnf > 1) AS multi_type_rows,
       CAST(sum(twf) AS BIGINT) AS twf_count, CAST(sum(hdf) AS BIGINT) AS hdf_count, CAST(sum(pwf) AS BIGINT) AS pwf_count,
       CAST(sum(osf) AS BIGINT) AS osf_count, CAST(sum(rnf) AS BIGINT) AS rnf_count
FROM v_ops""",
        "v_ops",
    ),
}

QUERIES = {
    "constant_column_check": constant_column_check,
    "clean_summary": clean_summary,
    "missing_by_column": missing_by_column,
    "dup_keep_last": dup_keep_last,
    "invalid_range_split": invalid_range_split,
    "onehot_checks": onehot_checks,
    "multi_flag_stats": multi_flag_stats,
}
