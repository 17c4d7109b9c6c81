"""Split and encoder queries (X1-X6, E1-E8, L9) over V_STUDENT / V_LOANS / V_SCORED / V_TRACKS."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.operators import encoders as E
from tabularis.operators import splits as X
from tabularis.plans.common import round_cols, view
from tabularis.plans.oracle_views import CTES, with_views
from tabularis.session import cut_lineage

# Category vocabularies of the loan view (used to name oracle columns).
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LOAN_TEST = 0.25


def loans_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_LOANS with a stratified 75/25 split (the reference's loan split)."""
    return X.stratified_split(view(spark, sf_dir, "v_loans"), "loan_id", "label", LOAN_TEST)


def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.random_split(view(spark, sf_dir, "v_student"), "row_key", 0.2).select("row_key", "split")


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans_split(spark, sf_dir).select("loan_id", "label", "split")


def split_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = X.three_way_split(view(spark, sf_dir, "v_scored"), "row_key", "label", 0.2, 0.25)
    return s.select("row_key", "label", "split")


def stratified_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified quarter of the loans (size grows with the table)."""
    loans = view(spark, sf_dir, "v_loans")
    return X.stratified_subset(loans, "loan_id", "label", loans.count() // 4).select("loan_id", "label")


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.stratified_folds(view(spark, sf_dir, "v_tracks"), "vec_id", "label", 5).select("vec_id", "label", "fold")


def _fit_loans(spark: SparkSession, sf_dir: str):
    d = cut_lineage(loans_split(spark, sf_dir))  # fitted on and transformed: computed once
    train = d.filter(F.col("split") == "train")
    fills = {**E.fit_medians(train, ["amount"]), **E.fit_modes(train, ["priority"])}
    scaler = E.fit_standard(E.impute(train, fills), ["amount", "balance"])
    return d, train, fills, scaler


def impute_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E2 + E3 fitted on train, applied to every row."""
    d, _, fills, scaler = _fit_loans(spark, sf_dir)
    out = E.standardize(E.impute(d, fills), scaler)
    out = out.select("loan_id", "split", F.col("amount").alias("amount_z"), F.col("balance").alias("balance_z"),
                     F.col("priority").alias("priority_filled"), "segment")
    return round_cols(out, 8)


def inverse_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled values mapped back equal the imputed originals."""
    d, _, fills, scaler = _fit_loans(spark, sf_dir)
    imp = E.impute(d, fills)
    z = E.standardize(imp.select("loan_id", F.col("amount").alias("amount_imputed"), "amount", "balance"), scaler, "_z")
    back = E.unstandardize(z, scaler, ["amount", "balance"], "_z")
    return round_cols(back.select("loan_id", "amount_imputed", F.col("amount_orig").alias("amount_back"),
                                  F.col("balance_orig").alias("balance_back")), 4)


def _onehot(spark: SparkSession, sf_dir: str, drop_first: bool) -> DataFrame:
    d, train, fills, _ = _fit_loans(spark, sf_dir)
    imp = E.impute(d, fills).select("loan_id", "priority", "segment")
    for c in ("priority", "segment"):
        imp = E.one_hot(imp, c, E.fit_categories(train, c), drop_first=drop_first)
    return imp


def encode_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: indicators for every train category; unknown -> all zeros."""
    return _onehot(spark, sf_dir, False)


def encode_onehot_dropfirst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators without the first (alphabetical) category."""
    return _onehot(spark, sf_dir, True)


def encode_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted-category codes from train; NULL or unseen -> -1."""
    d = loans_split(spark, sf_dir)
    train = d.filter(F.col("split") == "train")
    out = d.select("loan_id", "priority", "segment")
    for c in ("priority", "segment"):
        out = E.ordinal(out, c, E.fit_ordinal(train, c))
    return out.select("loan_id", "priority_code", "segment_code")


def encode_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 / E6 for any number of categories: indicators as one sparse column, given as the place of the one (null: all zeros)."""
    d = loans_split(spark, sf_dir)
    train = d.filter(F.col("split") == "train")
    out = d.select("loan_id", "priority", "segment")
    for c, drop in (("priority", False), ("segment", True)):
        out = E.one_hot_vector(out, c, E.fit_ordinal(train, c), drop_first=drop)
    at = lambda c: F.get(F.map_keys(f"{c}_hot"), F.lit(0)).alias(f"{c}_at")
    return out.select("loan_id", at("priority"), at("segment"))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced class weights of the training labels and the positive-class ratio."""
    train = loans_split(spark, sf_dir).filter(F.col("split") == "train")
    w = X.class_weights(train, "label")
    return round_cols(w.withColumn("pos_ratio", X.positive_weight(train, "label")), 8)


# ---------------------------------------------------------------- oracle SQL (DuckDB) ----
def _strat_sql(src: str, key: str, label: str, num: int, den: int, seed: int, name: str) -> str:
    """CTE ``name`` = src + split ('test'/'train') by largest-remainder quotas, md5 order."""
    return f"""{name}_cnt AS (SELECT {label}, count(*) AS n_c FROM {src} GROUP BY {label}),
{name}_tot AS (SELECT sum(n_c) AS n, (sum(n_c) * {num} + {den - 1}) // {den} AS t FROM {name}_cnt),
{name}_q0 AS (SELECT {label}, n_c, floor(n_c * t / n) AS base, n_c * t / n - floor(n_c * t / n) AS rem FROM {name}_cnt, {name}_tot),
{name}_q AS (SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, {label})
                          <= (SELECT t FROM {name}_tot) - (SELECT sum(base) FROM {name}_q0) THEN 1 ELSE 0 END AS quota FROM {name}_q0),
{name} AS (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.{label} ORDER BY md5('{seed}:' || CAST(s.{key} AS VARCHAR)))
                              <= q.quota THEN 'test' ELSE 'train' END AS split
           FROM {src} s JOIN {name}_q q ON s.{label} = q.{label})"""


_LS = _strat_sql("v_loans", "loan_id", "label", 1, 4, 42, "ls")

_FIT = _LS + """,
tr AS (SELECT * FROM ls WHERE split = 'train'),
fills AS (SELECT quantile_cont(amount, 0.5) AS med,
                 (SELECT priority FROM tr WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1) AS mode_p
          FROM tr),
imp AS (SELECT ls.loan_id, ls.split, coalesce(ls.amount, f.med) AS amount, ls.balance, coalesce(ls.priority, f.mode_p) AS priority,
               ls.segment, ls.label FROM ls, fills f),
sc AS (SELECT avg(amount) AS ma, CASE WHEN stddev_pop(amount) = 0 THEN 1.0 ELSE stddev_pop(amount) END AS sa,
              avg(balance) AS mb, CASE WHEN stddev_pop(balance) = 0 THEN 1.0 ELSE stddev_pop(balance) END AS sb
       FROM imp WHERE split = 'train')"""


def _ind(col: str, values, drop_first: bool) -> str:
    vals = list(values)[1:] if drop_first else list(values)
    return ", ".join(f"CAST(coalesce({col} = '{v}', false) AS INTEGER) AS {col}_{E.safe_col_name(v)}" for v in vals)


ORACLE = {
    "split_random": with_views(
        """SELECT row_key, CASE WHEN row_number() OVER (ORDER BY md5('42:' || row_key)) <= (count(*) OVER () + 4) // 5
                        THEN 'test' ELSE 'train' END AS split FROM v_student""",
        "v_student",
    ),
    "split_stratified": with_views("SELECT loan_id, label, split FROM ls", "v_loans", extra=_LS),
    "split_three_way": with_views(
        """SELECT row_key, label, 'test' AS split FROM s1 WHERE split = 'test'
UNION ALL SELECT row_key, label, CASE WHEN split = 'test' THEN 'validation' ELSE 'train' END FROM s2""",
        "v_scored",
        extra=_strat_sql("v_scored", "row_key", "label", 1, 5, 42, "s1")
        + ",\nrest AS (SELECT row_key, product_type, label, score FROM s1 WHERE split = 'train'),\n"
        + _strat_sql("rest", "row_key", "label", 1, 4, 43, "s2"),
    ),
    "stratified_subset": with_views(
        """SELECT loan_id, label FROM sub WHERE split = 'test'""",
        "v_loans",
        extra="""sub_cnt AS (SELECT label, count(*) AS n_c FROM v_loans GROUP BY label),
sub_tot AS (SELECT sum(n_c) AS n, sum(n_c) // 4 AS t FROM sub_cnt),
sub_q0 AS (SELECT label, n_c, floor(n_c * t / n) AS base, n_c * t / n - floor(n_c * t / n) AS rem FROM sub_cnt, sub_tot),
sub_q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                        <= (SELECT t FROM sub_tot) - (SELECT sum(base) FROM sub_q0) THEN 1 ELSE 0 END AS quota FROM sub_q0),
sub AS (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.label ORDER BY md5('42:' || CAST(s.loan_id AS VARCHAR)))
                           <= q.quota THEN 'test' ELSE 'train' END AS split
        FROM v_loans s JOIN sub_q q ON s.label = q.label)""",
    ),
    "cv_folds": with_views(
        """SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(vec_id AS VARCHAR))) - 1) % 5 AS INTEGER) AS fold
FROM v_tracks""",
        "v_tracks",
    ),
    "impute_scale": with_views(
        """SELECT loan_id, split, round((amount - ma) / sa, 8) AS amount_z, round((balance - mb) / sb, 8) AS balance_z,
       priority AS priority_filled, segment FROM imp, sc""",
        "v_loans", extra=_FIT,
    ),
    "inverse_scale": with_views(
        """SELECT loan_id, round(amount, 4) AS amount_imputed, round((amount - ma) / sa * sa + ma, 4) AS amount_back,
       round((balance - mb) / sb * sb + mb, 4) AS balance_back FROM imp, sc""",
        "v_loans", extra=_FIT,
    ),
    "encode_onehot": with_views(
        f"SELECT loan_id, {_ind('priority', PRIORITIES, False)}, {_ind('segment', SEGMENTS, False)} FROM imp",
        "v_loans", extra=_FIT,
    ),
    "encode_onehot_dropfirst": with_views(
        f"SELECT loan_id, {_ind('priority', PRIORITIES, True)}, {_ind('segment', SEGMENTS, True)} FROM imp",
        "v_loans", extra=_FIT,
    ),
    "encode_ordinal": with_views(
        """SELECT ls.loan_id, CAST(coalesce(p.code, -1) AS INTEGER) AS priority_code, CAST(coalesce(s.code, -1) AS INTEGER) AS segment_code
FROM ls
LEFT JOIN (SELECT priority, dense_rank() OVER (ORDER BY priority) - 1 AS code FROM (SELECT DISTINCT priority FROM ls WHERE split = 'train' AND priority IS NOT NULL) a) p
  ON ls.priority = p.priority
LEFT JOIN (SELECT segment, dense_rank() OVER (ORDER BY segment) - 1 AS code FROM (SELECT DISTINCT segment FROM ls WHERE split = 'train' AND segment IS NOT NULL) b) s
  ON ls.segment = s.segment""",
        "v_loans", extra=_LS,
    ),
    "class_weights": with_views(
        """SELECT label, n_c, round(1.0 * (SELECT count(*) FROM tr) / ((SELECT count(DISTINCT label) FROM tr) * n_c), 8) AS weight,
       round((SELECT count_if(label <> 1) FROM tr) / greatest((SELECT count_if(label = 1) FROM tr), 1), 8) AS pos_ratio
FROM (SELECT label, count(*) AS n_c FROM tr GROUP BY label) c""",
        "v_loans", extra=_LS + ",\ntr AS (SELECT * FROM ls WHERE split = 'train')",
    ),
}

ORACLE["encode_sparse"] = f"""SELECT loan_id, CASE WHEN priority_code >= 0 THEN priority_code END AS priority_at,
       CASE WHEN segment_code >= 1 THEN segment_code - 1 END AS segment_at FROM ({ORACLE["encode_ordinal"]}) q"""

QUERIES = {
    "encode_sparse": encode_sparse,
    "split_random": split_random,
    "split_stratified": split_stratified,
    "split_three_way": split_three_way,
    "stratified_subset": stratified_subset,
    "cv_folds": cv_folds,
    "impute_scale": impute_scale,
    "inverse_scale": inverse_scale,
    "encode_onehot": encode_onehot,
    "encode_onehot_dropfirst": encode_onehot_dropfirst,
    "encode_ordinal": encode_ordinal,
    "class_weights": class_weights,
}
