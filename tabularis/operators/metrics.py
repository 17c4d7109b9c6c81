"""Model metrics as aggregate queries over (label, prediction[, score]) tables.

Every metric is a grouped aggregate: ``by`` columns (model, fold, split …) compute many
models in one pass. Curves reduce to one row per distinct score before any ordering.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.operators.ranking import prefix_sums
from tabularis.session import cut_lineage


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


# M1 / M2 ----------------------------------------------------------------------------------
def regression_metrics(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """MAE, RMSE, R², MAPE (denominator max(|y|,1)) in %, WMAPE in %, n."""
    y, p = F.col(label), F.col(pred)
    err = p - y
    return df.groupBy(*_by(by)).agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.sum(err * err) / (F.var_pop(y) * F.count(y))).alias("r2"),
        (F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(1.0))) * 100).alias("mape_percent"),
        (F.sum(F.abs(err)) / F.sum(F.abs(y)) * 100).alias("wmape_percent"),
        F.count(y).alias("n"),
    )


# M3-M7 ------------------------------------------------------------------------------------
def per_class_counts(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """(class, tp, n_pred, n_true) over the union of true and predicted classes."""
    g = _by(by)
    t = df.groupBy(*g, F.col(label).alias("cls")).agg(
        F.count("*").alias("n_true"), F.count_if(F.col(label) == F.col(pred)).alias("tp")
    )
    pr = df.groupBy(*g, F.col(pred).alias("cls")).agg(F.count("*").alias("n_pred"))
    j = t.join(pr, [*g, "cls"], "full")
    return j.select(
        *g, "cls",
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("n_pred", F.lit(0)).alias("n_pred"),
        F.coalesce("n_true", F.lit(0)).alias("n_true"),
    )


def _prf(c: DataFrame) -> DataFrame:
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(
        F.col("precision") + F.col("recall") > 0,
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    return c.withColumn("f1", f1)


def class_report(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro avg and weighted avg rows."""
    g = _by(by)
    c = _prf(per_class_counts(df, label, pred, by))
    per = c.select(
        *g, F.col("cls").cast("string").alias("row_name"), "precision", "recall", "f1",
        F.col("n_true").alias("support"),
    )
    tot = c.groupBy(*g).agg(
        F.sum("tp").alias("tp"), F.sum("n_true").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("n_true")) / F.sum("n_true")).alias("wp"),
        (F.sum(F.col("recall") * F.col("n_true")) / F.sum("n_true")).alias("wr"),
        (F.sum(F.col("f1") * F.col("n_true")) / F.sum("n_true")).alias("wf"),
    )
    acc = tot.select(*g, F.lit("accuracy").alias("row_name"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    macro = tot.select(*g, F.lit("macro avg").alias("row_name"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(*g, F.lit("weighted avg").alias("row_name"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def class_summary(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """accuracy, balanced accuracy (mean recall over true classes), macro-F1, weighted-F1."""
    g = _by(by)
    c = _prf(per_class_counts(df, label, pred, by))
    return c.groupBy(*g).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg(F.when(F.col("n_true") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("n_true")) / F.sum("n_true")).alias("weighted_f1"),
    )


# M8 ---------------------------------------------------------------------------------------
def confusion(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """Full class × class grid: count and row-normalised share (0 for empty rows)."""
    g = _by(by)
    cells = df.groupBy(*g, F.col(label).alias("true_class"), F.col(pred).alias("pred_class")).agg(
        F.count("*").alias("n")
    )
    # the class set is bounded by the number of classes, not by the data
    classes = df.groupBy(*g).agg(F.array_union(F.collect_set(label), F.collect_set(pred)).alias("cs"))
    grid = classes.select(*g, F.explode("cs").alias("true_class"), "cs").select(
        *g, "true_class", F.explode("cs").alias("pred_class")
    )
    full = grid.join(cells, [*g, "true_class", "pred_class"], "left").fillna(0, ["n"])
    row_tot = F.sum("n").over(Window.partitionBy(*g, "true_class"))
    return full.withColumn("share", F.when(row_tot > 0, F.col("n") / row_tot).otherwise(F.lit(0.0)))


# M9 / M10 / M11 / W10 ---------------------------------------------------------------------
def score_histogram(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """One row per distinct score: positives and negatives at that score.

    Written once: the curves read it for totals, bucket offsets and rows.
    """
    hist = df.groupBy(*_by(by), F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return cut_lineage(hist)


def _score_bucket(hist: DataFrame, bucket_rows: int = 100_000) -> Column:
    """Equal-width score buckets, as many as the distinct scores ask for."""
    return F.floor(F.col("score") * max(16, math.ceil(hist.count() / bucket_rows)))


def roc_auc(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """Mann-Whitney AUC with ties counted half: Σ pos·(neg below + neg tied/2) / (P·N)."""
    g = _by(by)
    h = score_histogram(df, label, score, by)
    h = prefix_sums(h, [F.col("score")], _score_bucket(h), ["neg"], inclusive=False, partition_cols=g)
    return h.groupBy(*g).agg(
        (F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc")
    )


def _desc_cumulative(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    g = _by(by)
    h = score_histogram(df, label, score, by)
    tot = h.groupBy(*g).agg(F.sum("pos").alias("P"))
    h = prefix_sums(h, [F.col("score").desc()], -_score_bucket(h), ["pos", "neg"], inclusive=True, partition_cols=g)
    return h.join(tot, g) if g else h.withColumn("P", tot.select("P").scalar())


def average_precision(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """Step-wise AP: Σ over distinct scores (desc) of ΔRecall · Precision."""
    g = _by(by)
    h = _desc_cumulative(df, label, score, by)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return h.groupBy(*g).agg(F.sum(F.col("pos") / F.col("P") * prec).alias("average_precision"))


def pr_curve(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """Precision-recall points per distinct score, stopping at the first full recall,
    plus the closing point (precision 1, recall 0, threshold NULL)."""
    g = _by(by)
    h = _desc_cumulative(df, label, score, by)
    h = h.filter(F.col("cum_pos") - F.col("pos") < F.col("P"))
    pts = h.select(
        *g, F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        (F.col("cum_pos") / F.col("P")).alias("recall"),
    )
    end = df.select(*g).distinct() if g else df.sparkSession.range(1).select()
    end = end.select(*g, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


# M12 / M13 --------------------------------------------------------------------------------
def threshold_grid(spark, start_milli: int = 50, stop_milli: int = 990, step_milli: int = 5) -> DataFrame:
    """Thresholds built as integers / 1000 (0.050, 0.055, … 0.990): 189 rows by default."""
    n = (stop_milli - start_milli) // step_milli + 1
    return spark.range(n).select(
        F.col("id").cast("int").alias("i"), ((F.col("id") * step_milli + start_milli) / 1000.0).alias("threshold")
    )


def threshold_sweep(
    df: DataFrame, label: str, score: str, by=None, start_milli: int = 50, stop_milli: int = 990, step_milli: int = 5
) -> DataFrame:
    """Counts and rates at every grid threshold (alarm = score >= threshold).

    Each row maps to the index of the highest threshold it reaches (exact double compare),
    counts are summed per index (≤ grid size rows) and accumulated from the top.
    """
    g = _by(by)
    n = (stop_milli - start_milli) // step_milli + 1

    def thr(i: Column) -> Column:
        return (i * step_milli + start_milli) / 1000.0

    s = F.col(score)
    c = F.floor((s * 1000 - start_milli) / step_milli).cast("int")
    c = F.when(s < thr(c), c - 1).when(s >= thr(c + 1), c + 1).otherwise(c)
    idx = F.least(F.greatest(c, F.lit(-1)), F.lit(n - 1))
    hist = df.groupBy(*g, idx.alias("i")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    tot = df.groupBy(*g).agg(F.count_if(F.col(label) == 1).alias("P"), F.count("*").alias("total"))
    # every group gets the whole grid: one exploded row per (group, threshold index)
    full = tot.select(*g, "P", "total", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    full = full.withColumn("threshold", thr(F.col("i")))
    full = full.join(hist, [*g, "i"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*g).orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    full = full.select(
        *g, "i", "threshold", "P", "total", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")
    )
    return _rates(full, g)


def _rates(c: DataFrame, g: list[str]) -> DataFrame:
    alerts = F.col("tp") + F.col("fp")
    c = c.select(
        "*",
        alerts.alias("alerts"),
        (F.col("P") - F.col("tp")).alias("fn"),
        (F.col("total") - F.col("P") - F.col("fp")).alias("tn"),
    )
    prec = F.when(F.col("alerts") > 0, F.col("tp") / F.col("alerts")).otherwise(F.lit(0.0))
    rec = F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(0.0))
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    # FDR = 1 - precision (precision is 0 without alerts, as in the reference's zero_division=0)
    c = c.withColumn("fdr", F.lit(1.0) - F.col("precision"))
    return c.withColumn(
        "f1",
        F.when(F.col("precision") + F.col("recall") > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)),
    )


def select_threshold(sweep: DataFrame, min_recall: float = 0.5, by=None) -> DataFrame:
    """Constrained choice: recall >= min and >= 1 alert; best by (FDR asc, recall desc, F1 desc,
    threshold asc). One row per group; a group with no feasible threshold yields no row."""
    g = _by(by)
    ok = sweep.filter((F.col("recall") >= min_recall) & (F.col("alerts") >= 1))
    w = Window.partitionBy(*g).orderBy(F.col("fdr").asc(), F.col("recall").desc(), F.col("f1").desc(), F.col("threshold").asc())
    return ok.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def feasible(row) -> float:
    """The threshold of a row of ``select_threshold``; an error if no threshold was feasible."""
    if row is None:
        raise ValueError("no threshold satisfies the recall requirement")
    return float(row["threshold"])


def operating_point(df: DataFrame, label: str, score: str, threshold: float | Column, by=None) -> DataFrame:
    """tn / fp / fn / tp, alerts, precision, recall, FDR, F1 and accuracy at one threshold."""
    g = _by(by)
    alarm = F.col(score) >= threshold
    pos = F.col(label) == 1
    c = df.groupBy(*g).agg(
        F.count_if(alarm & pos).alias("tp"), F.count_if(alarm & ~pos).alias("fp"),
        F.count_if(pos).alias("P"), F.count("*").alias("total"),
    )
    c = _rates(c, g)
    return c.withColumn("accuracy", (F.col("tp") + F.col("tn")) / F.col("total"))
