"""Learner, tuning and importance queries (L1-L16) on the derived views."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularis.functions.columns import sensor_features
from tabularis.operators import boosting as B
from tabularis.operators import encoders as E
from tabularis.operators import kernel_svm as K
from tabularis.operators import learners as L
from tabularis.operators import metrics as M
from tabularis.operators import oversample as O
from tabularis.operators import splits as X
from tabularis.operators import timeseries as ts
from tabularis.operators import trees as T
from tabularis.operators.stages import CodeEstimator, FillEstimator
from tabularis.plans.common import round_cols, view
from tabularis.plans.oracle_views import with_views
from tabularis.plans.prep import _fit_loans, loans_split
from tabularis.plans.sales import _FEAT_CTE, featured_sales
from tabularis.session import cut_lineage, ensure_checkpoint_dir

OPS_NUM = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min",
           "temperature_difference_k", "mechanical_power_w", "tool_stress", "torque_speed_ratio"]
FLAGS = ["twf", "hdf", "pwf", "osf", "rnf"]
SALES_FEATS = ["store", "year", "month", "quarter", "week_of_year", "week_sin", "week_cos",
               "lag_1", "lag_2", "lag_4", "lag_13", "lag_52", "rolling_mean_4", "rolling_std_4", "rolling_mean_13", "rolling_std_13"]


#: (trees, rules, bootstrap rows?) of a forest
ForestSetting = tuple[int, T.Rules, bool]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _indicators(train: DataFrame, frames: dict[str, DataFrame], categorical: list[str]) -> tuple[dict[str, DataFrame], list[str]]:
    """The frames with an indicator column for every category of the training frame, and the columns' names."""
    names = []
    for c in categorical:
        values = E.fit_categories(train, c)
        frames = {n: E.one_hot(f, c, values) for n, f in frames.items()}
        names += [f"{c}_{E.safe_col_name(v)}" for v in values]
    return frames, names


def _sqrt(features: list) -> int:
    return max(1, math.isqrt(len(features)))


def _tree_scores(
    parts: dict[str, DataFrame], features: list[str], label: str, forests: dict[str, ForestSetting], boosts: dict[str, B.Boost] | None = None, weight: str | None = None
) -> tuple[DataFrame, dict[str, tuple[float, float]], dict]:
    """(model, part, row, label, scores) of every setting fitted on the part ``train``, seconds of fit and prediction, models.

    ``rid`` numbers the rows of each part.
    """
    data = {"train": T.binned(parts["train"], features, label, weight, row="rid")}
    data |= {n: T.binned(d, features, label, None, data["train"].edges, "rid") for n, d in parts.items() if n != "train"}
    models, seconds, found = {}, {}, []
    for name, (trees, rules, draw) in forests.items():
        models[name], fit = L.timed(lambda: T.fit_forest(data["train"], trees, rules, draw))
        seconds[name] = (fit, 0.0)
    if boosts:
        many, fit = L.timed(lambda: B.fit_boosting(data["train"], boosts))
        models |= many
        seconds |= {n: (fit / len(boosts), 0.0) for n in boosts}  # the settings are fitted side by side
    for name, model in models.items():
        scored = [(B if name in (boosts or {}) else T).predict(model, d).select(F.lit(name).alias("model"), F.lit(n).alias("part"), "row", "label", "scores") for n, d in data.items() if n in parts]
        written, took = L.timed(lambda: cut_lineage(_union(scored)))
        seconds[name] = (seconds[name][0], took)
        found.append(written)
    return _union(found), seconds, models


def _with_seconds(metrics: DataFrame, seconds: dict[str, tuple[float, float]]) -> DataFrame:
    """fit_seconds and predict_seconds of each model, as measured by this run."""
    times = metrics.sparkSession.createDataFrame([(n, a, b) for n, (a, b) in seconds.items()], "model string, fit_seconds double, predict_seconds double")
    return metrics.join(F.broadcast(times), "model", "left")


def _first_of_best(c: str = "scores"):
    """Index of the largest score."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("double")


# ---------------------------------------------------------------- regression (T1) --------
def _student_split(spark, sf_dir):
    st = view(spark, sf_dir, "v_student")
    return cut_lineage(X.random_split(st, "row_key", 0.2))


def ols_simple(spark, sf_dir):
    """L1: target ~ quantity by closed form on the 80 % split; MAE/RMSE/R² on the 20 % split."""
    d = _student_split(spark, sf_dir)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    b, a = L.ols_simple(train, "quantity", "target")
    pred = test.select("target", (a + b * F.col("quantity")).alias("pred"))
    m = M.regression_metrics(pred, "target", "pred").select(b.alias("slope"), a.alias("intercept"), "mae", "rmse", "r2", "n")
    return round_cols(m, 6)


def ols_quadratic(spark, sf_dir):
    """L2: linear (1 feature), quadratic, three numerics and all features (with one-hot)."""
    d = _student_split(spark, sf_dir).withColumn("quantity_sq", F.col("quantity") * F.col("quantity"))
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    variants = {
        "linear_quantity": (["quantity"], []),
        "quadratic_quantity": (["quantity", "quantity_sq"], []),
        "numeric": (["quantity", "size", "retail"], []),
        "all_features": (["quantity", "size", "retail"], ["ptype", "flag"]),
    }
    out = None
    for name, (num, cat) in variants.items():
        model = L.linear_fit(train, num, cat, "target")
        m = M.regression_metrics(model.transform(test), "target", "prediction").select(F.lit(name).alias("model"), "*")
        out = m if out is None else out.unionByName(m)
    return round_cols(out, 6)


# ---------------------------------------------------------------- sales (T7) -------------
def _sales_frames(spark, sf_dir):
    f = ts.holdout_last_dates(featured_sales(spark, sf_dir), "week", 20)
    f = cut_lineage(f.withColumn("rid", F.xxhash64("store", "week")))
    return f.filter(F.col("is_test") == 0), f.filter(F.col("is_test") == 1)


def _ridge(train: DataFrame, alpha: float):
    """One-hot store and scaled numbers, as the studied pipeline; the fitted pipeline can be saved."""
    st = train.agg(F.count("*").alias("n"), F.stddev_pop("weekly_sales").alias("s")).first()
    lr = LinearRegression(featuresCol="features", labelCol="weekly_sales", elasticNetParam=0.0, standardization=False,
                          regParam=L.ridge_reg_param(alpha, st["n"], st["s"]), solver="normal")
    numeric = [c for c in SALES_FEATS if c != "store"]
    stages = [E.scaling_stage(train, numeric), *L.features_pipeline([f"z_{c}" for c in numeric], ["store"]), lr]
    return Pipeline(stages=stages).fit(train)


SALES_RIDGE = (1.0, 10.0, 100.0)
SALES_FORESTS = {f"forest_d{d or 'none'}": (120, T.Rules(depth=d, min_rows=2), True) for d in (12, None)}
SALES_BOOSTS = {
    f"boosting_n{n}_d{d}": B.Boost(rounds=n, depth=d, rate=0.05, rows=0.9, columns=0.9) for n in (300, 500) for d in (3, 6)
}


def _sales_predictions(parts: dict[str, DataFrame], trees: bool = True, names: tuple[str, ...] | None = None) -> tuple[DataFrame, dict]:
    """(model, part, row, label, prediction) of every setting of the sales task (or those of ``names``), fitted on
    ``train``; floored at 0."""
    found, seconds = [], {}
    wanted = lambda settings: {n: v for n, v in settings.items() if names is None or n in names}
    for name, alpha in wanted({f"ridge_a{a:g}": a for a in SALES_RIDGE}).items():
        model, fit = L.timed(lambda: _ridge(parts["train"], alpha))
        scored = _union([model.transform(d).select(F.lit(name).alias("model"), F.lit(n).alias("part"), F.col("rid").alias("row"), F.col("weekly_sales").alias("label"), "prediction") for n, d in parts.items()])
        written, took = L.timed(lambda: cut_lineage(scored))
        found.append(written)
        seconds[name] = (fit, took)
    if trees:
        hot, stores = _indicators(parts["train"], parts, ["store"])
        numeric = [c for c in SALES_FEATS if c != "store"]
        scored, more, _ = _tree_scores(hot, numeric + stores, "weekly_sales", wanted(SALES_FORESTS), wanted(SALES_BOOSTS))
        found.append(scored.withColumn("prediction", F.col("scores")[0]).drop("scores"))
        seconds |= more
    return _floored(_union(found)), seconds


def _floored(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))


def ridge(spark, sf_dir):
    """L3: ridge for α ∈ {1, 10, 100} on the training weeks, scored on the last 20 weeks."""
    train, test = _sales_frames(spark, sf_dir)
    out = None
    for alpha in (1.0, 10.0, 100.0):
        m = M.regression_metrics(_floored(_ridge(train, alpha).transform(test)), "weekly_sales", "prediction").select(F.lit(alpha).alias("alpha"), "*")
        out = m if out is None else out.unionByName(m)
    return round_cols(out, 6)


def sales_models(spark, sf_dir):
    """Ridge, forest (one without a depth limit) and boosting settings, scored on the last 20 weeks."""
    train, test = _sales_frames(spark, sf_dir)
    found, seconds = _sales_predictions({"train": train, "test": test})
    scores = M.regression_metrics(found.where("part = 'test'"), "label", "prediction", by="model")
    return round_cols(_with_seconds(scores, seconds), 4)


def _date_grid(spark, sf_dir, trees: bool) -> DataFrame:
    """Mean/std validation RMSE, mean train RMSE and rank of every setting over 3 expanding date folds."""
    train, _ = _sales_frames(spark, sf_dir)
    folds = cut_lineage(ts.expanding_date_folds(train.drop("is_test"), "week", 3))
    part = lambda k, role: folds.filter((F.col("fold") == k) & (F.col("role") == role)).drop("fold", "role")
    found = [_sales_predictions({r: part(k, r) for r in ("train", "validate")}, trees)[0].withColumn("fold", F.lit(k)) for k in range(3)]
    df = M.regression_metrics(_union(found), "label", "prediction", by=["model", "fold", "part"])
    out = df.groupBy("model").agg(
        F.avg(F.when(F.col("part") == "validate", F.col("rmse"))).alias("mean_test_rmse"),
        F.stddev_pop(F.when(F.col("part") == "validate", F.col("rmse"))).alias("std_test_rmse"),
        F.avg(F.when(F.col("part") == "train", F.col("rmse"))).alias("mean_train_rmse"),
    )
    return round_cols(out.withColumn("rank", F.rank().over(Window.orderBy("mean_test_rmse"))), 4)  # a row a setting


def grid_cv_timeseries(spark, sf_dir):
    """L13 + W8: ridge α grid over 3 expanding date folds."""
    return _date_grid(spark, sf_dir, False)


def sales_grid_cv(spark, sf_dir):
    """L13 + W8: every sales setting (ridge, forest, boosting) over 3 expanding date folds."""
    return _date_grid(spark, sf_dir, True)


def permutation_importance(spark, sf_dir):
    """RMSE increase when one feature is shuffled (5 repeats) for ridge α = 1, in one long frame."""
    train, test = _sales_frames(spark, sf_dir)
    model = _ridge(train, 1.0)
    test = cut_lineage(test.withColumn("row_id", F.concat_ws(":", F.col("store").cast("string"), F.col("week").cast("string"))))
    base = M.regression_metrics(model.transform(test), "weekly_sales", "prediction").first()["rmse"]
    shuffled = model.transform(L.permuted_frames(test, "row_id", SALES_FEATS, 5))
    per = M.regression_metrics(shuffled, "weekly_sales", "prediction", by=["feature", "rep"])
    drop = F.col("rmse") - F.lit(base)
    return round_cols(per.groupBy("feature").agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std")), 4)


def track_permutation_importance(spark, sf_dir):
    """L15 + G6: accuracy lost when one feature of the test part is shuffled (20 repeats), multinomial logistic model, by rank."""
    train, test = _track_frames(spark, sf_dir)
    va = VectorAssembler(inputCols=TRACK_COLS, outputCol="features")
    model = L.logistic_learners(train.count())["logistic_C1.0"].fit(va.transform(train))
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    base = model.transform(va.transform(test)).agg(right).first()[0]
    shuffled = L.permuted_frames(cut_lineage(test.select("vec_id", "label", *TRACK_COLS)), "vec_id", TRACK_COLS, 20)
    per = model.transform(va.transform(shuffled)).groupBy("feature", "rep").agg((F.lit(base) - right).alias("lost"))
    out = per.groupBy("feature").agg(F.avg("lost").alias("importance_mean"), F.stddev_pop("lost").alias("importance_std"))
    return round_cols(out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance_mean"), "feature"))), 6)  # a row a feature


FITTED = ("ridge_a1", "forest_dnone", "boosting_n300_d3")


def model_prediction_table(spark, sf_dir):
    """The last 20 weeks with the actual value and a column for each fitted model (the best setting of each kind on
    the training folds is left to ``sales_grid_cv``)."""
    train, test = _sales_frames(spark, sf_dir)
    found, _ = _sales_predictions({"train": train, "test": test}, names=FITTED)
    wide = found.where("part = 'test'").groupBy(F.col("row").alias("rid")).pivot("model", list(FITTED)).agg(F.first("prediction"))
    out = test.select("rid", "store", "week", F.col("weekly_sales").cast("double").alias("actual")).join(wide, "rid").drop("rid")
    return round_cols(out, 4)


def model_forecast_by_date(spark, sf_dir):
    """M15 + G7: actual and fitted totals by week."""
    p = model_prediction_table(spark, sf_dir)
    return round_cols(p.groupBy("week").agg(*[F.sum(c).alias(c) for c in ("actual", *FITTED)]), 2)


NAIVE = {"naive_52": "lag_52", "naive_1": "lag_1", "mean_4": "rolling_mean_4", "mean_13": "rolling_mean_13"}


def prediction_table(spark, sf_dir):
    """The last 20 weeks with the actual value and one column per forecast."""
    f = ts.holdout_last_dates(featured_sales(spark, sf_dir), "week", 20).filter(F.col("is_test") == 1)
    return round_cols(f.select("store", "week", F.col("weekly_sales").cast("double").alias("actual"), *[F.col(c).cast("double").alias(n) for n, c in NAIVE.items()]), 4)


def forecast_by_date(spark, sf_dir):
    """M15 + G7: actual and forecast totals by week."""
    p = prediction_table(spark, sf_dir)
    return round_cols(p.groupBy("week").agg(*[F.sum(c).alias(c) for c in ("actual", *NAIVE)]), 2)


# ---------------------------------------------------------------- loans (T4) -------------
def _loan_frames(spark, sf_dir):
    d, train, fills, scaler = _fit_loans(spark, sf_dir)
    enc = E.standardize(E.impute(d, fills), scaler)
    weights = X.class_weights(enc.filter(F.col("split") == "train"), "label")
    enc = cut_lineage(X.with_weight(enc, "label", weights, "balanced_w").withColumn("label", F.col("label").cast("double")))
    return enc.filter(F.col("split") == "train"), enc.filter(F.col("split") == "test")


LOAN_NUM, LOAN_CAT = ["amount", "balance"], ["priority", "segment"]


def _classify(train, test, est, weight: str | None, name: str) -> DataFrame:
    if weight:
        est = est.setWeightCol(weight)
    model = Pipeline(stages=L.features_pipeline(LOAN_NUM, LOAN_CAT) + [est]).fit(train)
    p = model.transform(test).select(F.lit(name).alias("model"), "label", "prediction")
    return p


def logit(spark, sf_dir):
    """L4 + L9: logistic regression, C ∈ {0.1, 1, 10}, unweighted and balanced."""
    train, test = _loan_frames(spark, sf_dir)
    n = train.count()
    preds = None
    for c in (0.1, 1.0, 10.0):
        for w in (None, "balanced_w"):
            est = LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=2000)
            p = _classify(train, test, est, w, f"logistic_C{c}_{'balanced' if w else 'plain'}")
            preds = p if preds is None else preds.unionByName(p)
    return round_cols(M.class_summary(preds, "label", "prediction", by="model"), 6)


def loan_pipeline(spark, sf_dir):
    """E9 + K3: imputer, category codes, indicators, scaling and logistic regression as one pipeline, saved and read again;
    scores of the loaded one on the test part."""
    d = cut_lineage(loans_split(spark, sf_dir).withColumn("label", F.col("label").cast("double")))
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    stages = [FillEstimator(medians=["amount"], modes=["priority"])]
    stages += [CodeEstimator(inputCol=c, outputCol=f"{c}_code") for c in LOAN_CAT]
    stages += [OneHotEncoder(inputCol=f"{c}_code", outputCol=f"{c}_hot", handleInvalid="keep") for c in LOAN_CAT]
    stages += [VectorAssembler(inputCols=LOAN_NUM, outputCol="numbers"), StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True)]
    stages += [VectorAssembler(inputCols=["scaled", *(f"{c}_hot" for c in LOAN_CAT)], outputCol="features")]
    stages += [LogisticRegression(regParam=1.0 / train.count(), elasticNetParam=0.0, standardization=False, maxIter=2000)]
    path = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    Pipeline(stages=stages).fit(train).write().save(path)
    return round_cols(M.class_summary(PipelineModel.load(path).transform(test), "label", "prediction"), 6)


def smote_rows(spark, sf_dir):
    """The synthetic loan rows that level the training classes."""
    train, _ = _loan_frames(spark, sf_dir)
    return round_cols(O.smote_nc(train, "loan_id", "label", LOAN_NUM, LOAN_CAT), 6)


def smote_models(spark, sf_dir):
    """E10 + L4 + L5: logistic regression and tree fitted on the training rows with synthetic rows added."""
    train, test = _loan_frames(spark, sf_dir)
    cols = ["label", *LOAN_NUM, *LOAN_CAT]
    both = cut_lineage(train.select(*cols).unionByName(O.smote_nc(train, "loan_id", "label", LOAN_NUM, LOAN_CAT).select(*cols)))
    est = {
        "logistic_smote": LogisticRegression(regParam=1.0 / both.count(), elasticNetParam=0.0, standardization=False, maxIter=2000),
        "tree_smote": DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=5, seed=42),
    }
    preds = [_classify(both, test, e, None, n) for n, e in est.items()]
    return round_cols(M.class_summary(preds[0].unionByName(preds[1]), "label", "prediction", by="model"), 6)


LOAN_TREES = {f"tree_d{d or 'none'}_l{leaf}": (1, T.Rules(depth=d, min_rows=leaf, classes=2), False) for d in (3, 5, 8, None) for leaf in (5, 15)}


def _loan_parts(train: DataFrame, test: DataFrame) -> tuple[dict[str, DataFrame], list[str]]:
    parts, names = _indicators(train, {"train": train, "test": test}, LOAN_CAT)
    return {n: d.withColumn("rid", F.xxhash64("loan_id")) for n, d in parts.items()}, LOAN_NUM + names


def tree(spark, sf_dir):
    """Decision tree, depth ∈ {3, 5, 8, unlimited} × leaf ∈ {5, 15}."""
    parts, features = _loan_parts(*_loan_frames(spark, sf_dir))
    found, seconds, _ = _tree_scores(parts, features, "label", LOAN_TREES)
    found = found.where("part = 'test'").withColumn("prediction", _first_of_best())
    return round_cols(_with_seconds(M.class_summary(found, "label", "prediction", by="model"), seconds), 6)


def _best_on_holdout(parts: dict[str, DataFrame], features: list[str], forests: dict, boosts: dict | None, weight: str | None) -> DataFrame:
    """Macro-F1 and accuracy of every setting on the part ``test``, with the rank that the grid search orders by."""
    found, seconds, _ = _tree_scores(parts, features, "label", forests, boosts, weight)
    found = found.where("part = 'test'").withColumn("prediction", _first_of_best())
    scores = _with_seconds(M.class_summary(found, "label", "prediction", by="model"), seconds)
    return cut_lineage(scores.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("macro_f1"), F.desc("accuracy"), "model"))))  # a row a setting


def grid_holdout(spark, sf_dir):
    """Tree grid chosen on a stratified 25 % validation part of train (macro-F1, then
    accuracy), refit on all train, test used once."""
    train, test = _loan_frames(spark, sf_dir)
    halves = cut_lineage(X.stratified_split(train, "loan_id", "label", 0.25, 43, "_s"))
    fit, val = halves.filter(F.col("_s") == "train"), halves.filter(F.col("_s") == "test")
    best = _best_on_holdout(*_loan_parts(fit, val), LOAN_TREES, None, None).where("rank = 1").first()
    rules = LOAN_TREES[best["model"]][1]
    found, _, _ = _tree_scores(*_loan_parts(train, test), "label", {best["model"]: LOAN_TREES[best["model"]]})
    s = M.class_summary(found.where("part = 'test'").withColumn("prediction", _first_of_best()), "label", "prediction")
    return round_cols(s.select(F.lit(rules.depth).cast("int").alias("depth"), F.lit(int(rules.min_rows)).alias("leaf"),
                               F.lit(best["macro_f1"]).alias("val_macro_f1"), "*"), 6)


# ---------------------------------------------------------------- alarm (T9) -------------
def _ops_frames(spark, sf_dir):
    ops = view(spark, sf_dir, "v_ops").select("row_key", "product_type", *OPS_NUM[:5], *FLAGS, "failure")
    ops = ops.select("*", *sensor_features())
    s = X.three_way_split(ops, "row_key", "failure", 0.2, 0.25)
    s = cut_lineage(s.withColumn("label", F.col("failure").cast("double")))
    train = s.filter(F.col("split") == "train")
    pw = train.select(F.count_if(F.col("failure") == 0) / F.greatest(F.count_if(F.col("failure") == 1), F.lit(1))).first()[0]
    s = s.withColumn("w", F.when(F.col("failure") == 1, F.lit(pw)).otherwise(F.lit(1.0)))
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "validation"), s.filter(F.col("split") == "test")


def _alarm_scores(v: DataFrame, t: DataFrame) -> DataFrame:
    """Threshold chosen on validation (recall >= 0.5, least false discovery), test metrics at it. Frames: (model, label, score)."""
    chosen = M.select_threshold(M.threshold_sweep(v, "label", "score", by="model"), 0.5, by="model")
    thr = M.feasible(chosen.first())
    op = M.operating_point(t, "label", "score", thr, by="model")
    auc = M.roc_auc(t, "label", "score", by="model")
    ap = M.average_precision(t, "label", "score", by="model")
    out = op.join(auc, "model").join(ap, "model").select(
        "model", F.lit(thr).alias("threshold"), "precision", "recall", "fdr", "f1",
        "accuracy", "roc_auc", "average_precision", "alerts",
    )
    return round_cols(out, 6)


def _ops_parts(train: DataFrame, others: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], list[str]]:
    parts, names = _indicators(train, {"train": train, **others}, ["product_type"])
    return {n: d.withColumn("rid", F.xxhash64("row_key")) for n, d in parts.items()}, OPS_NUM + names


def _alarm_trees(spark, sf_dir, forests: dict, boosts: dict | None = None):
    train, val, test = _ops_frames(spark, sf_dir)
    parts, features = _ops_parts(train, {"validation": val, "test": test})
    found, _, models = _tree_scores(parts, features, "label", forests, boosts, "w")
    score = F.col("scores")[0] if boosts else F.col("scores")[1]
    held = lambda part: found.where(F.col("part") == part).select("model", "label", score.alias("score"))
    return _alarm_scores(held("validation"), held("test")), models, features


def _alarm_forest(trees: int, features: int = len(OPS_NUM) + 3) -> ForestSetting:
    return trees, T.Rules(depth=10, min_rows=2, columns=math.isqrt(features), classes=2), True


def forest(spark, sf_dir):
    """L6 + M12-M14: weighted random forest (350 trees, depth 10, leaf 2), threshold chosen on
    validation (recall >= 0.5, min FDR), test metrics at that threshold."""
    return _alarm_trees(spark, sf_dir, {"random_forest": _alarm_forest(350)})[0]


def boosting(spark, sf_dir):
    """Weighted boosting (350 rounds at rate 0.04, depth 4, rows and columns 0.85, λ 2, minimum child weight 3)."""
    b = B.Boost("logistic", rounds=350, depth=4, rate=0.04, rows=0.85, columns=0.85, shrink=2.0, min_weight=3.0)
    return _alarm_trees(spark, sf_dir, {}, {"boosting": b})[0]


def logistic_alarm(spark, sf_dir):
    """L4 on the alarm task (positive weight neg/pos)."""
    train, val, test = _ops_frames(spark, sf_dir)
    est = LogisticRegression(maxIter=2000, regParam=0.0, standardization=True, weightCol="w")
    model = Pipeline(stages=[*L.features_pipeline(OPS_NUM, ["product_type"]), est]).fit(train)
    held = lambda d: cut_lineage(model.transform(d).select(F.lit("logistic").alias("model"), "label", L.positive_probability(None).alias("score")))
    return _alarm_scores(held(val), held(test))


def tree_importance(spark, sf_dir):
    """Impurity importance of the alarm forest by feature, sorted."""
    train, _, _ = _ops_frames(spark, sf_dir)
    parts, features = _ops_parts(train, {})
    model = T.fit_forest(T.binned(parts["train"], features, "label", "w", row="rid"), *_alarm_forest(350))
    rows = sorted(zip(features, T.importances(model), strict=True), key=lambda r: (-r[1], r[0]))
    return round_cols(spark.createDataFrame(rows, "feature string, importance double"), 6)


def multilabel_diagnosis(spark, sf_dir):
    """Five binary forests (300 trees, depth 10, leaf 2, weight neg/max(pos,1)), cut 0.5."""
    train, _, test = _ops_frames(spark, sf_dir)
    parts, features = _ops_parts(train, {"test": test})
    flags = train.select(*[(F.count_if(F.col(f) == 0) / F.greatest(F.count_if(F.col(f) == 1), F.lit(1))).alias(f) for f in FLAGS]).first()
    found = []
    for flag in FLAGS:
        own = {n: d.withColumn("fw", F.when(F.col(flag) == 1, F.lit(flags[flag])).otherwise(F.lit(1.0))) for n, d in parts.items()}
        scored, _, _ = _tree_scores(own, features, flag, {flag: _alarm_forest(300)}, None, "fw")
        found.append(scored.where("part = 'test'").select(F.col("model").alias("failure_type"), "label", F.col("scores")[1].alias("score")))
    p = _union(found)
    op = M.operating_point(p, "label", "score", 0.5, by="failure_type").select("failure_type", "precision", "recall", "f1", "tp", "P")
    return round_cols(op.join(M.average_precision(p, "label", "score", by="failure_type"), "failure_type", "left").withColumn("support", F.col("P")), 6)


# ---------------------------------------------------------------- tracks (T6) ------------
TRACK_COLS = [f"f{i}" for i in range(64)]


def _track_frames(spark, sf_dir):
    """Stratified 80/20 split, numbers scaled on the training part."""
    s = X.stratified_split(view(spark, sf_dir, "v_tracks"), "vec_id", "label", 0.2)
    train = s.filter(F.col("split") == "train")
    z = cut_lineage(E.standardize(s, E.fit_standard(train, TRACK_COLS)).withColumn("label", F.col("label").cast("double")))
    return z.filter(F.col("split") == "train"), z.filter(F.col("split") == "test")


TRACK_CLASSES = 10
TRACK_FORESTS = {
    f"forest_d{d or 'none'}_l{leaf}": (400, T.Rules(depth=d, min_rows=leaf, columns=_sqrt(TRACK_COLS), classes=TRACK_CLASSES), True)
    for d in (None, 15) for leaf in (1, 2)
}


def _balanced(train: DataFrame) -> DataFrame:
    return X.with_weight(train, "label", X.class_weights(train, "label"), "w")


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("rid", F.col("vec_id"))


def tracks_models(spark, sf_dir):
    """L4 + L6 + M17 for 10 classes: multinomial logistic, balanced forests (also without a depth limit) and a tree;
    accuracy and macro-F1 on the test part."""
    train, test = _track_frames(spark, sf_dir)
    va = VectorAssembler(inputCols=TRACK_COLS, outputCol="features")
    seconds, found = {}, []
    for name, est in L.logistic_learners(train.count()).items():
        model, fit = L.timed(lambda: est.fit(va.transform(train)))
        scored, took = L.timed(lambda: cut_lineage(model.transform(va.transform(test)).select(F.lit(name).alias("model"), "label", "prediction")))
        seconds[name] = (fit, took)
        found.append(scored)
    plain = {"tree_d8": (1, T.Rules(depth=8, classes=TRACK_CLASSES), False)}
    parts = {"train": _numbered(_balanced(train)), "test": _numbered(test)}
    for settings, weight in ((TRACK_FORESTS, "w"), (plain, None)):
        scored, more, _ = _tree_scores(parts, TRACK_COLS, "label", settings, None, weight)
        found.append(scored.where("part = 'test'").select("model", "label", _first_of_best().alias("prediction")))
        seconds |= more
    return round_cols(_with_seconds(M.class_summary(_union(found), "label", "prediction", by="model"), seconds), 6)


COVER_FORESTS = {
    f"forest_d{d or 'none'}_l{leaf}": (200, T.Rules(depth=d, min_rows=leaf, columns=_sqrt(TRACK_COLS), classes=TRACK_CLASSES), True)
    for d in (None, 24) for leaf in (1, 2)
}
COVER_BOOSTS = {
    f"boosting_d{d}_r{rate:g}": B.Boost("softmax", rounds=250, depth=d, rate=rate, rows=0.9, columns=0.8, outputs=TRACK_CLASSES) for d in (6, 10) for rate in (0.08, 0.15)
}


def cover_grid_holdout(spark, sf_dir):
    """L6 + L7 + L12: forest and softmax boosting grids for many classes on a stratified 25 % validation part of train
    (macro-F1, then accuracy); the best of each kind is refitted on all train and meets the test part once."""
    train, test = _track_frames(spark, sf_dir)
    halves = cut_lineage(X.stratified_split(train.drop("split"), "vec_id", "label", 0.25, 43, "_s"))
    fit, val = halves.filter(F.col("_s") == "train"), halves.filter(F.col("_s") == "test")
    grids = []
    for forests, boosts, weight in ((COVER_FORESTS, None, "w"), ({}, COVER_BOOSTS, None)):
        grid = _best_on_holdout({"train": _numbered(_balanced(fit)), "test": _numbered(val)}, TRACK_COLS, forests, boosts, weight)
        best = grid.where("rank = 1").first()["model"]
        again = {"train": _numbered(_balanced(train)), "test": _numbered(test)}
        found, _, _ = _tree_scores(again, TRACK_COLS, "label", {n: f for n, f in forests.items() if n == best}, {n: b for n, b in (boosts or {}).items() if n == best}, weight)
        final = M.class_summary(found.where("part = 'test'").withColumn("prediction", _first_of_best()), "label", "prediction", by="model")
        final = final.select("model", F.col("accuracy").alias("test_accuracy"), F.col("balanced_accuracy").alias("test_balanced_accuracy"), F.col("macro_f1").alias("test_macro_f1"))
        grids.append(grid.join(final, "model", "left"))
    return round_cols(_union(grids), 6)


def tracks_grid_cv(spark, sf_dir):
    """5-fold stratified grid of the multinomial logistic and the balanced forest settings on the training part:
    mean and std of macro-F1 and accuracy, mean training macro-F1, rank by macro-F1."""
    train, _ = _track_frames(spark, sf_dir)
    folds = cut_lineage(X.stratified_folds(train, "vec_id", "label", 5))
    va = VectorAssembler(inputCols=TRACK_COLS, outputCol="features")
    n = train.count() * 4 // 5

    def logistic(job):
        name, est, k = job
        model = est.copy().fit(va.transform(folds.filter(F.col("fold") != k)))
        part = F.when(F.col("fold") == k, "test").otherwise("train").alias("part")
        return cut_lineage(model.transform(va.transform(folds)).select(F.lit(name).alias("model"), F.lit(k).alias("cv"), part, "label", "prediction"))

    found = L.grid_search(logistic, [(name, est, k) for name, est in L.logistic_learners(n).items() for k in range(5)])
    for k in range(5):
        parts = {"train": _numbered(_balanced(folds.filter(F.col("fold") != k))), "test": _numbered(folds.filter(F.col("fold") == k))}
        scored, _, _ = _tree_scores(parts, TRACK_COLS, "label", TRACK_FORESTS, None, "w")
        found.append(scored.select("model", F.lit(k).alias("cv"), "part", "label", _first_of_best().alias("prediction")))
    s = M.class_summary(_union(found), "label", "prediction", by=["model", "part", "cv"])
    of = lambda part, c: F.when(F.col("part") == part, F.col(c))
    out = s.groupBy("model").agg(
        *[fn(of("test", c)).alias(f"{kind}_{c}") for c in ("macro_f1", "accuracy") for kind, fn in (("mean", F.avg), ("std", F.stddev_pop))],
        F.avg(of("train", "macro_f1")).alias("mean_train_macro_f1"),
    )
    return round_cols(out.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_macro_f1")))), 6)  # a row a setting


def tracks_pca(spark, sf_dir):
    """E11 + G6: two principal components of the scaled training columns; scores of every training row."""
    train, _ = _track_frames(spark, sf_dir)
    x = VectorAssembler(inputCols=TRACK_COLS, outputCol="features").transform(train)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(x)
    # a component's sign is free: its largest loading is made positive
    sign = [1.0 if max(col, key=abs) > 0 else -1.0 for col in model.pc.toArray().T.tolist()]
    pc, share = vector_to_array("pc"), model.explainedVariance.toArray().tolist()
    return round_cols(model.transform(x).select(
        "vec_id", F.col("label").cast("int").alias("label"), (pc[0] * sign[0]).alias("pc1"), (pc[1] * sign[1]).alias("pc2"),
        F.lit(share[0]).alias("share1"), F.lit(share[1]).alias("share2")), 6)


def rbf_svm_rff(spark, sf_dir):
    """RBF-kernel SVM via random Fourier features (gamma = 1/(d·var X)) + one-vs-rest
    linear SVM, one gamma and three C; accuracy and macro-F1 on test (``svm_grid_cv`` chooses in folds)."""
    tr = view(spark, sf_dir, "v_tracks")
    cols = [f"f{i}" for i in range(64)]
    s = cut_lineage(X.stratified_split(tr, "vec_id", "label", 0.2))
    train = s.filter(F.col("split") == "train")
    sc = E.fit_standard(train, cols)
    z = E.standardize(s, sc)
    var = z.filter(F.col("split") == "train").select(F.avg(sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0])) / len(cols))).first()[0]
    gamma = 1.0 / (len(cols) * var) if var else 1.0 / len(cols)
    z = L.random_fourier(z, cols, 256, gamma).withColumn("label", F.col("label").cast("double"))
    z = cut_lineage(z.select("vec_id", "split", "label", "rff"))  # the feature map is computed once
    train, test = z.filter(F.col("split") == "train"), z.filter(F.col("split") == "test")
    n = train.count()

    def fit_eval(c):
        est = OneVsRest(classifier=LinearSVC(featuresCol="rff", regParam=1.0 / (c * n), maxIter=100), featuresCol="rff", parallelism=10)
        return est.fit(train).transform(test).select(F.lit(f"rff_svm_C{c}").alias("model"), "label", "prediction")

    preds = L.grid_search(fit_eval, [1.0, 10.0, 100.0], parallel=3)
    out = preds[0].unionByName(preds[1]).unionByName(preds[2])
    return round_cols(M.class_summary(out, "label", "prediction", by="model"), 6)


SVM_COSTS = (1.0, 10.0, 100.0)
LANDMARKS = 512


def svm_grid_cv(spark, sf_dir):
    """L8 + L13: RBF machines for C ∈ {1, 10, 100} × gamma ∈ {scale, 0.01}: mean and std of macro-F1 and accuracy over 5 stratified
    folds of the training part, rank by macro-F1, and the scores of the refit on the test part."""
    train, test = _track_frames(spark, sf_dir)
    folds = cut_lineage(X.stratified_folds(train, "vec_id", "label", 5))
    square = sum((F.col(c) * F.col(c) for c in TRACK_COLS[1:]), F.col(TRACK_COLS[0]) * F.col(TRACK_COLS[0])) / len(TRACK_COLS)
    total = sum((F.col(c) for c in TRACK_COLS[1:]), F.col(TRACK_COLS[0])) / len(TRACK_COLS)
    spread = train.agg((F.avg(square) - F.pow(F.avg(total), F.lit(2))).alias("v")).first()["v"] or 1.0
    gammas = {"scale": 1.0 / (len(TRACK_COLS) * spread), "0.01": 0.01}
    rows = K.pick_landmarks(train, TRACK_COLS, "vec_id", LANDMARKS)
    maps = [K.Landmarks.fit(rows, g) for g in gammas.values()]
    held, tested = (K.mapped(d, TRACK_COLS, "vec_id", "label", f, maps) for d, f in ((folds, "fold"), (test, None)))
    found = []
    for name, blocks, other in zip(gammas, held, tested, strict=True):
        weights = K.fit(blocks, 5, TRACK_CLASSES, SVM_COSTS)
        for part, p in (("validate", K.predict(blocks, weights, TRACK_CLASSES, SVM_COSTS, True)), ("test", K.predict(other, weights, TRACK_CLASSES, SVM_COSTS, False))):
            found.append(cut_lineage(p.select(F.lit(name).alias("gamma"), "cost", F.lit(part).alias("part"), "fold", "label", "prediction")))
    by = ["gamma", "cost", "part", "fold"]
    s = M.class_summary(_union(found), "label", "prediction", by=by)
    of = lambda part, c: F.when(F.col("part") == part, F.col(c))
    out = s.groupBy("gamma", "cost").agg(
        *[fn(of("validate", c)).alias(f"{kind}_{c}") for c in ("macro_f1", "accuracy") for kind, fn in (("mean", F.avg), ("std", F.stddev_pop))],
        *[F.max(of("test", c)).alias(f"test_{c}") for c in ("macro_f1", "accuracy")],
    )
    return round_cols(out.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_macro_f1")))), 6)  # a row a setting


_FORECASTS = ", ".join(f"round({c}, 4) AS {n}" for n, c in NAIVE.items())
_FORECAST_SUMS = ", ".join(f"round(sum(round({c}, 4)), 2) AS {n}" for n, c in NAIVE.items())

ORACLE = {
    "prediction_table": with_views(
        f"SELECT store, week, round(CAST(weekly_sales AS DOUBLE), 4) AS actual, {_FORECASTS.replace('(lag', '(CAST(lag').replace('2, 4)', '2 AS DOUBLE), 4)').replace('lag_1, 4)', 'lag_1 AS DOUBLE), 4)')} FROM test",
        "v_sales", extra=_FEAT_CTE,
    ),
    "forecast_by_date": with_views(
        f"SELECT week, round(sum(CAST(weekly_sales AS DOUBLE)), 2) AS actual, {_FORECAST_SUMS} FROM test GROUP BY week", "v_sales", extra=_FEAT_CTE
    ),
    "ols_simple": with_views(
        """SELECT round(b, 6) AS slope, round(a, 6) AS intercept,
       round(avg(abs(a + b * quantity - target)), 6) AS mae,
       round(sqrt(avg((a + b * quantity - target) * (a + b * quantity - target))), 6) AS rmse,
       round(1 - sum((a + b * quantity - target) * (a + b * quantity - target)) / (var_pop(target) * count(target)), 6) AS r2,
       count(target) AS n
FROM sp, (SELECT regr_slope(target, quantity) AS b, regr_intercept(target, quantity) AS a FROM sp WHERE split = 'train') c
WHERE split = 'test' GROUP BY a, b""",
        "v_student",
        extra="""sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || row_key)) <= (count(*) OVER () + 4) // 5
                        THEN 'test' ELSE 'train' END AS split FROM v_student)""",
    ),
}

QUERIES = {
    "ols_simple": ols_simple,
    "ols_quadratic": ols_quadratic,
    "ridge": ridge,
    "sales_models": sales_models,
    "sales_grid_cv": sales_grid_cv,
    "prediction_table": prediction_table,
    "forecast_by_date": forecast_by_date,
    "model_prediction_table": model_prediction_table,
    "model_forecast_by_date": model_forecast_by_date,
    "track_permutation_importance": track_permutation_importance,
    "tracks_models": tracks_models,
    "tracks_grid_cv": tracks_grid_cv,
    "cover_grid_holdout": cover_grid_holdout,
    "tracks_pca": tracks_pca,
    "logit": logit,
    "loan_pipeline": loan_pipeline,
    "smote_rows": smote_rows,
    "smote_models": smote_models,
    "tree": tree,
    "forest": forest,
    "boosting": boosting,
    "logistic_alarm": logistic_alarm,
    "rbf_svm_rff": rbf_svm_rff,
    "svm_grid_cv": svm_grid_cv,
    "grid_holdout": grid_holdout,
    "grid_cv_timeseries": grid_cv_timeseries,
    "multilabel_diagnosis": multilabel_diagnosis,
    "permutation_importance": permutation_importance,
    "tree_importance": tree_importance,
}
