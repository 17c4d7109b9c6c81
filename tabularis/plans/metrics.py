"""Metric queries over deterministic classifier / regressor outputs (V_SCORED, V_PRED, V_STUDENT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularis.operators import metrics as M
from tabularis.plans.common import Tables, round_cols, view
from tabularis.plans.oracle_views import CTES, with_views

MIN_RECALL = 0.5
CUT = 0.5

CTES["v_pred"] = ((), """v_pred AS (
  SELECT vec_id, label, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS pred
  FROM (SELECT vec_id, label, list_transform(range(10), lambda c: list_sum(list_transform(range(1, len(embedding) + 1),
          lambda i: CASE WHEN (i - 1) % 10 = c THEN CAST(round(CAST(embedding[i] AS DOUBLE) * 1e6) AS BIGINT) ELSE 0 END))) AS s
        FROM embeddings) e)""")

CTES["v_models"] = (("v_scored",), """v_models AS (
  SELECT row_key, label, 'blend' AS model, score,
         CASE WHEN substr(md5(row_key), 1, 1) < '8' THEN 'validation' ELSE 'test' END AS split FROM v_scored
  UNION ALL
  SELECT s.row_key, s.label, 'stress_only' AS model, round(least(1.0, o.torque_nm * o.tool_wear_min / 17500), 3) AS score,
         CASE WHEN substr(md5(s.row_key), 1, 1) < '8' THEN 'validation' ELSE 'test' END AS split
  FROM v_scored s JOIN v_ops o ON s.row_key = o.row_key
  UNION ALL
  SELECT row_key, label, 'hash_only' AS model,
         round(CAST(('0x' || substr(md5(row_key), 5, 4))::INTEGER AS DOUBLE) / 65535, 3) AS score,
         CASE WHEN substr(md5(row_key), 1, 1) < '8' THEN 'validation' ELSE 'test' END AS split FROM v_scored)""")


def v_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiclass output over whole vectors: class c scores the sum of the components whose place is c modulo 10
    (in millionths, so that sums are exact); the first class with the largest score is predicted."""
    e = Tables(spark, sf_dir).embeddings.withColumn("millionths", F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("long")))
    zero = F.lit(0).cast("long")
    part = lambda c: F.aggregate(F.transform("millionths", lambda x, i: F.when(i % 10 == c, x).otherwise(zero)), zero, lambda a, x: a + x)
    e = e.select("vec_id", "label", F.array(*[part(c) for c in range(10)]).alias("s"))
    return e.select("vec_id", "label", (F.array_position("s", F.array_max("s")) - 1).cast("int").alias("pred"))


def v_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three score columns as three 'models' in long form, with a validation/test split."""
    ops = view(spark, sf_dir, "v_ops")
    sc = view(spark, sf_dir, "v_scored")
    split = F.when(F.substring(F.md5("row_key"), 1, 1) < "8", "validation").otherwise("test")
    blend = sc.select("row_key", "label", F.lit("blend").alias("model"), "score", split.alias("split"))
    stress = ops.select(
        "row_key", F.col("failure").alias("label"), F.lit("stress_only").alias("model"),
        F.round(F.least(F.lit(1.0), F.col("torque_nm") * F.col("tool_wear_min") / 17500), 3).alias("score"),
        split.alias("split"),
    )
    hsh = sc.select(
        "row_key", "label", F.lit("hash_only").alias("model"),
        F.round(F.conv(F.substring(F.md5("row_key"), 5, 4), 16, 10).cast("int").cast("double") / 65535, 3).alias("score"),
        split.alias("split"),
    )
    return blend.unionByName(stress).unionByName(hsh)


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/M2 for two fixed predictors of the line price, in one grouped pass."""
    st = view(spark, sf_dir, "v_student")
    mean_t = st.select(F.avg("target")).scalar()
    long = st.select("target", F.lit("qty_x_retail").alias("model"), (F.col("quantity") * F.col("retail")).alias("pred")).unionByName(
        st.select("target", F.lit("mean_baseline").alias("model"), mean_t.alias("pred"))
    )
    m = M.regression_metrics(long, "target", "pred", by="model")
    return round_cols(round_cols(m, 4, ["mae", "rmse"]), 8, ["r2", "mape_percent", "wmape_percent"])


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.class_report(v_pred(spark, sf_dir), "label", "pred"), 8)


def class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.class_summary(v_pred(spark, sf_dir), "label", "pred"), 8)


def confusion_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.confusion(v_pred(spark, sf_dir), "label", "pred"), 8)


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.roc_auc(view(spark, sf_dir, "v_scored"), "label", "score"), 8)


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.average_precision(view(spark, sf_dir, "v_scored"), "label", "score"), 8)


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_cols(M.pr_curve(view(spark, sf_dir, "v_scored"), "label", "score"), 8, ["precision", "recall"])


_RATE_COLS = ["threshold", "alerts", "tp", "fp", "fn", "tn", "precision", "recall", "fdr", "f1"]


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = M.threshold_sweep(view(spark, sf_dir, "v_scored"), "label", "score")
    return round_cols(s.select(*_RATE_COLS), 8, ["precision", "recall", "fdr", "f1"])


def operating_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = M.operating_point(view(spark, sf_dir, "v_scored"), "label", "score", CUT)
    return round_cols(op.select(*_RATE_COLS[1:], "accuracy"), 8)


def model_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model, the constrained threshold on validation; test scored once at it;
    best model by validation (FDR, -recall, -F1)."""
    long = v_models(spark, sf_dir)
    val = long.filter(F.col("split") == "validation")
    sweep = M.threshold_sweep(val, "label", "score", by="model")
    chosen = M.select_threshold(sweep, MIN_RECALL, by="model").select(
        "model", "threshold", F.col("fdr").alias("val_fdr"), F.col("recall").alias("val_recall"), F.col("f1").alias("val_f1")
    )
    test = long.filter(F.col("split") == "test").join(F.broadcast(chosen.select("model", "threshold")), "model")
    op = M.operating_point(test, "label", "score", F.col("threshold"), by="model").select(
        "model", F.col("precision").alias("test_precision"), F.col("recall").alias("test_recall"),
        F.col("fdr").alias("test_fdr"), F.col("f1").alias("test_f1"), F.col("alerts").alias("test_alerts"),
    )
    # one row per model: a tiny window
    w = Window.orderBy(F.col("val_fdr").asc(), F.col("val_recall").desc(), F.col("val_f1").desc(), F.col("model"))
    out = chosen.join(op, "model").withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))
    return round_cols(out, 8)


# ---------------------------------------------------------------- oracle SQL (DuckDB) ----
_PRF = """cls AS (SELECT c AS cls FROM (SELECT label AS c FROM v_pred UNION SELECT pred FROM v_pred) u),
cnt AS (SELECT cls.cls,
          (SELECT count(*) FROM v_pred WHERE label = cls.cls AND pred = cls.cls) AS tp,
          (SELECT count(*) FROM v_pred WHERE pred = cls.cls) AS n_pred,
          (SELECT count(*) FROM v_pred WHERE label = cls.cls) AS n_true
        FROM cls),
prf0 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                  CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END AS recall FROM cnt),
prf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM prf0)"""

_HIST = """h AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM v_scored GROUP BY score),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             (SELECT sum(pos) FROM h) AS P FROM h)"""


def _sweep_sql(src: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""(SELECT {key}threshold, alerts, tp, fp, P - tp AS fn, total - P - fp AS tn, precision, recall,
        1.0 - precision AS fdr,
        CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
 FROM (SELECT *, CASE WHEN alerts > 0 THEN tp / alerts ELSE 0.0 END AS precision,
              CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS recall
       FROM (SELECT {key}g.threshold, count_if(s.score >= g.threshold) AS alerts,
                    count_if(s.score >= g.threshold AND s.label = 1) AS tp,
                    count_if(s.score >= g.threshold AND s.label <> 1) AS fp,
                    count_if(s.label = 1) AS P, count(*) AS total
             FROM (SELECT CAST(i * 5 + 50 AS DOUBLE) / 1000 AS threshold FROM range(189) t(i)) g, {src} s
             GROUP BY {key}g.threshold) a) b)"""


ORACLE = {
    "regression_metrics": with_views(
        """SELECT model, round(avg(abs(pred - target)), 4) AS mae, round(sqrt(avg((pred - target) * (pred - target))), 4) AS rmse,
       round(1 - sum((pred - target) * (pred - target)) / (var_pop(target) * count(target)), 8) AS r2,
       round(avg(abs(pred - target) / greatest(abs(target), 1.0)) * 100, 8) AS mape_percent,
       round(sum(abs(pred - target)) / sum(abs(target)) * 100, 8) AS wmape_percent, count(target) AS n
FROM (SELECT target, 'qty_x_retail' AS model, quantity * retail AS pred FROM v_student
      UNION ALL SELECT target, 'mean_baseline', (SELECT avg(target) FROM v_student) FROM v_student) x
GROUP BY model""",
        "v_student",
    ),
    "class_report": with_views(
        """SELECT CAST(cls AS VARCHAR) AS row_name, round(precision, 8) AS precision, round(recall, 8) AS recall,
       round(f1, 8) AS f1, n_true AS support FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(n_true), 8), CAST(sum(n_true) AS BIGINT) FROM prf
UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), CAST(sum(n_true) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', round(sum(precision * n_true) / sum(n_true), 8), round(sum(recall * n_true) / sum(n_true), 8),
                 round(sum(f1 * n_true) / sum(n_true), 8), CAST(sum(n_true) AS BIGINT) FROM prf""",
        "v_pred", extra=_PRF,
    ),
    "class_summary": with_views(
        """SELECT round(sum(tp) / sum(n_true), 8) AS accuracy,
       round(avg(CASE WHEN n_true > 0 THEN recall END), 8) AS balanced_accuracy,
       round(avg(f1), 8) AS macro_f1, round(sum(f1 * n_true) / sum(n_true), 8) AS weighted_f1 FROM prf""",
        "v_pred", extra=_PRF,
    ),
    "confusion_norm": with_views(
        """SELECT t.cls AS true_class, p.cls AS pred_class, coalesce(c.n, 0) AS n,
       round(CASE WHEN sum(coalesce(c.n, 0)) OVER (PARTITION BY t.cls) > 0
                  THEN coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY t.cls) ELSE 0.0 END, 8) AS share
FROM cls t CROSS JOIN cls p
LEFT JOIN (SELECT label, pred, count(*) AS n FROM v_pred GROUP BY label, pred) c ON c.label = t.cls AND c.pred = p.cls""",
        "v_pred", extra="cls AS (SELECT c AS cls FROM (SELECT label AS c FROM v_pred UNION SELECT pred FROM v_pred) u)",
    ),
    "roc_auc": with_views(
        """SELECT round((sum(CASE WHEN label = 1 THEN avg_rank END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0)
             / (CAST(count_if(label = 1) AS DOUBLE) * count_if(label <> 1)), 8) AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM v_scored) r""",
        "v_scored",
    ),
    "average_precision": with_views(
        "SELECT round(sum(pos / P * (tp / (tp + fp))), 8) AS average_precision FROM c", "v_scored", extra=_HIST
    ),
    "pr_curve": with_views(
        """SELECT score AS threshold, round(tp / (tp + fp), 8) AS precision, round(tp / P, 8) AS recall FROM c WHERE tp - pos < P
UNION ALL SELECT NULL, 1.0, 0.0""",
        "v_scored", extra=_HIST,
    ),
    "threshold_sweep": with_views(
        """SELECT threshold, alerts, tp, fp, fn, tn, round(precision, 8) AS precision, round(recall, 8) AS recall,
       round(fdr, 8) AS fdr, round(f1, 8) AS f1 FROM """ + _sweep_sql("v_scored") + " x",
        "v_scored",
    ),
    "operating_point": with_views(
        """SELECT alerts, tp, fp, fn, tn, round(precision, 8) AS precision, round(recall, 8) AS recall, round(1.0 - precision, 8) AS fdr,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 8) AS f1,
       round((tp + tn) / total, 8) AS accuracy
FROM (SELECT *, CASE WHEN alerts > 0 THEN tp / alerts ELSE 0.0 END AS precision, CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS recall
      FROM (SELECT count_if(score >= 0.5) AS alerts, count_if(score >= 0.5 AND label = 1) AS tp,
                   count_if(score >= 0.5 AND label <> 1) AS fp, count_if(score < 0.5 AND label = 1) AS fn,
                   count_if(score < 0.5 AND label <> 1) AS tn, count_if(label = 1) AS P, count(*) AS total FROM v_scored) a) b""",
        "v_scored",
    ),
    "model_select": with_views(
        """SELECT ch.model, ch.threshold, round(ch.fdr, 8) AS val_fdr, round(ch.recall, 8) AS val_recall, round(ch.f1, 8) AS val_f1,
       round(t.precision, 8) AS test_precision, round(t.recall, 8) AS test_recall, round(1.0 - t.precision, 8) AS test_fdr,
       round(CASE WHEN t.precision + t.recall > 0 THEN 2 * t.precision * t.recall / (t.precision + t.recall) ELSE 0.0 END, 8) AS test_f1,
       t.alerts AS test_alerts,
       CAST(row_number() OVER (ORDER BY ch.fdr, ch.recall DESC, ch.f1 DESC, ch.model) = 1 AS INTEGER) AS is_best
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY fdr, recall DESC, f1 DESC, threshold) AS r
                     FROM sw WHERE recall >= 0.5 AND alerts >= 1) q WHERE r = 1) ch
JOIN (SELECT m.model, count_if(m.score >= ch2.threshold) AS alerts,
             CASE WHEN count_if(m.score >= ch2.threshold) > 0
                  THEN count_if(m.score >= ch2.threshold AND m.label = 1) / count_if(m.score >= ch2.threshold) ELSE 0.0 END AS precision,
             count_if(m.score >= ch2.threshold AND m.label = 1) / count_if(m.label = 1) AS recall
      FROM v_models m JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY fdr, recall DESC, f1 DESC, threshold) AS r
                                           FROM sw WHERE recall >= 0.5 AND alerts >= 1) q WHERE r = 1) ch2 ON m.model = ch2.model
      WHERE m.split = 'test' GROUP BY m.model) t ON ch.model = t.model""",
        "v_models", "v_ops",
        extra="sw AS " + _sweep_sql("(SELECT * FROM v_models WHERE split = 'validation')", "model"),
    ),
}

def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + M8: one row a true class and one column a predicted class, both reindexed to all ten labels."""
    labels = range(10)
    counts = v_pred(spark, sf_dir).groupBy("label").pivot("pred", list(labels)).count()
    every = spark.range(10).select(F.col("id").cast("int").alias("label"))
    return every.join(counts, "label", "left").select("label", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"pred_{c}") for c in labels])


ORACLE["confusion_wide"] = with_views(
    "SELECT CAST(l.range AS INTEGER) AS label, " + ", ".join(f"count_if(p.pred = {c}) AS pred_{c}" for c in range(10))
    + " FROM range(10) l LEFT JOIN v_pred p ON p.label = l.range GROUP BY l.range",
    "v_pred",
)

QUERIES = {
    "confusion_wide": confusion_wide,
    "regression_metrics": regression_metrics,
    "class_report": class_report,
    "class_summary": class_summary,
    "confusion_norm": confusion_norm,
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "pr_curve": pr_curve,
    "threshold_sweep": threshold_sweep,
    "operating_point": operating_point,
    "model_select": model_select,
}
