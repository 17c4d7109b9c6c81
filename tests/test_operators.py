"""Operator tests on small hand-made fixtures, each against a brute-force or closed form."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabularis.operators import annotations as A
from tabularis.operators import cluster as C
from tabularis.operators import metrics as M
from tabularis.operators import profile as P
from tabularis.operators import quality as Q
from tabularis.operators import ranking as RK
from tabularis.operators import recsys as R
from tabularis.operators import scoring as S
from tabularis.operators import splits as X
from tabularis.operators import timeseries as TS


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=3000).round(3)  # ties included
    grp = rng.integers(0, 3, size=3000)
    df = spark.createDataFrame(pd.DataFrame({"g": grp.astype(int), "x": vals}))
    got = {(r["g"], r["p"]): r["q"] for r in P.exact_quantiles(df, "x", [0.0, 0.33, 0.5, 0.67, 0.95, 1.0], by="g", buckets=16).collect()}
    for g in range(3):
        for p in (0.0, 0.33, 0.5, 0.67, 0.95, 1.0):
            assert got[(g, p)] == pytest.approx(np.percentile(vals[grp == g], p * 100), abs=1e-9)
    # pandas reference numbers of the studied pipeline: quantile([.33,.67]) of 1,2,3,10
    small = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = sorted((r["p"], r["q"]) for r in P.exact_quantiles(small, "x", [0.33, 0.67]).collect())
    assert q[0][1] == pytest.approx(1.99) and q[1][1] == pytest.approx(3.07)


def test_prefix_sums_and_row_numbers_equal_plain_windows(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 500), "v": rng.integers(0, 10, 500), "s": rng.random(500)})
    df = spark.createDataFrame(pdf)
    got = RK.prefix_sums(df, [F.col("s")], F.floor(F.col("s") * 7), ["v"], partition_cols=["g"]).toPandas()
    exp = pdf.sort_values("s").assign(cum_v=lambda d: d.groupby("g")["v"].cumsum())
    m = got.merge(exp, on=["g", "s"])
    assert (m["cum_v_x"] == m["cum_v_y"]).all()
    df2 = df.withColumn("k", F.md5(F.col("s").cast("string")))
    rn = RK.global_row_number(df2, F.col("k"), partition_cols=["g"]).withColumn(
        "plain", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert rn.filter(F.col("rn") != F.col("plain")).count() == 0


def test_auc_and_average_precision_hand_values(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, score double")
    assert M.roc_auc(df, "label", "score").first()[0] == pytest.approx(0.75)
    assert M.average_precision(df, "label", "score").first()[0] == pytest.approx(0.8333333333)
    ties = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert M.roc_auc(ties, "label", "score").first()[0] == pytest.approx(0.875)


def test_threshold_sweep_edges(spark):
    df = spark.createDataFrame([(1, 0.075), (0, 0.07), (1, 0.99), (0, 0.5)], "label int, score double")
    rows = {round(r["threshold"], 3): r for r in M.threshold_sweep(df, "label", "score").collect()}
    assert len(rows) == 189
    assert rows[0.075]["tp"] == 2 and rows[0.075]["fp"] == 1  # score equal to threshold counts
    assert rows[0.08]["tp"] == 1 and rows[0.99]["alerts"] == 1


def test_keep_last_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 1, "c")], "k int, seq int, v string")
    kept = {r["k"]: r["v"] for r in Q.keep_last(df, ["k"], ["seq"]).collect()}
    assert kept == {1: "b", 2: "c"}
    assert Q.duplicate_row_count(df).first()[0] == 1


def test_stratified_quotas_sum_and_proportion(spark):
    df = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100)], "id int, y int")
    q = X.stratum_quotas(df, "y", fraction=0.2)
    assert sum(q.values()) == 20 and q[1] == 7 and q[0] == 13
    s = X.stratified_split(df, "id", "y", 0.2)
    assert s.filter(F.col("split") == "test").count() == 20
    folds = X.stratified_folds(df, "id", "y", 5).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in folds)
    assert sum(sizes) == 100 and sizes[-1] - sizes[0] <= 2


def test_features_are_strictly_past(spark):
    """Changing the target of the last week must not change any feature of earlier weeks."""
    base = pd.DataFrame({"store": 1, "week": pd.date_range("2020-01-06", periods=60, freq="7D").date, "y": np.arange(60.0)})
    changed = base.copy()
    changed.loc[59, "y"] = 1e6

    def feats(pdf):
        df = spark.createDataFrame(pdf)
        df = TS.add_shifted_rolling(TS.add_lags(df, "store", "week", "y", (1, 52)), "store", "week", "y", (4,))
        return df.orderBy("week").toPandas()

    a, b = feats(base), feats(changed)
    cols = ["lag_1", "lag_52", "rolling_mean_4", "rolling_std_4"]
    pd.testing.assert_frame_equal(a.loc[:59, cols].reset_index(drop=True), b.loc[:59, cols].reset_index(drop=True))


def test_seasonal_decompose_recovers_linear_trend(spark):
    n = 160
    t = np.arange(n)
    season = np.sin(2 * np.pi * (t % 52) / 52) * 10
    season -= season[:52].mean()
    y = 100 + 2.5 * t + season
    pdf = pd.DataFrame({"d": pd.date_range("2020-01-06", periods=n, freq="7D").date, "y": y})
    out = TS.seasonal_decompose(spark.createDataFrame(pdf), "d", "y", 52).orderBy("d").toPandas()
    assert np.allclose(out["trend"], 100 + 2.5 * t, atol=1e-6)
    assert np.allclose(out["resid"], 0, atol=1e-6)


def test_annotation_negatives(spark):
    lines = ["3 0.5 0.5 0.1", "3 0.5 0.5 0.1 0.1 0.2", "abc 0.5 0.5 0.1 0.1", "100 0.5 0.5 0.1 0.1",
             "3 1.2 0.5 0.1 0.1", "3 0.5 0.5 0 0.1", "3.0 0.5 0.5 0.1 0.1", "3 0.5 0.5 0.1 0.1", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = {r["i"]: r["reason"] for r in A.parse_lines(df).collect()}
    assert got == {0: A.REASON_FIELDS, 1: A.REASON_FIELDS, 2: A.REASON_NUMERIC, 3: A.REASON_CLASS, 4: A.REASON_COORD,
                   5: A.REASON_SIZE, 6: A.REASON_NUMERIC, 7: None, 8: A.REASON_FIELDS}


def test_request_validation_negatives(spark):
    ok = '{"product_type": "L", "air_temperature_k": 298, "process_temperature_k": 308.6, "rotational_speed_rpm": 1500, "torque_nm": 40, "tool_wear_min": 10}'
    cases = {
        "valid": (ok, []),
        "text": (ok.replace("298", '"forty"'), ["air_temperature_k:float_type"]),
        "enum": (ok.replace('"L"', '"X"'), ["product_type:literal_error"]),
        "neg_rpm": (ok.replace("1500", "-5"), ["rotational_speed_rpm:greater_than"]),
        "unknown": (ok.replace("}", ', "extra": 1}'), ["extra:extra_forbidden"]),
        "malformed": (ok[:-1], ["body:json_invalid"]),
        "quoted": (ok.replace(": 40,", ': "40",'), ["torque_nm:float_type"]),
        "bool": (ok.replace(": 10}", ": true}"), ["tool_wear_min:float_type"]),
        "missing": (ok.replace('"process_temperature_k": 308.6, ', ""), ["process_temperature_k:missing"]),
        "null": (ok.replace(": 40,", ": null,"), ["torque_nm:float_type"]),
        "range": (ok.replace("298", "351"), ["air_temperature_k:less_than_equal"]),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "request_id string, body string")
    res = S.validate_requests(df).collect()
    for r in res:
        got = sorted(f"{e['field']}:{e['rule']}" for e in r["errors"])
        assert got == cases[r["request_id"]][1], r["request_id"]
        assert r["is_valid"] == (not got)


def _brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def _brute_dbscan(X, eps, m):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    nb = D <= eps + 1e-12
    core = nb.sum(1) >= m
    comp = -np.ones(len(X), dtype=int)
    for i in range(len(X)):
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], i
            while stack:
                j = stack.pop()
                for k in np.nonzero(nb[j] & core)[0]:
                    if comp[k] < 0:
                        comp[k] = i
                        stack.append(k)
    reps = sorted(set(comp[core]))
    lab = np.full(len(X), -1)
    for i in range(len(X)):
        if core[i]:
            lab[i] = reps.index(comp[i])
        else:
            cl = [reps.index(comp[k]) for k in np.nonzero(nb[i] & core)[0]]
            lab[i] = min(cl) if cl else -1
    return lab


def test_silhouette_and_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(3)
    X = np.concatenate([rng.normal(0, 0.3, (40, 2)), rng.normal(3, 0.3, (40, 2)), rng.uniform(-2, 5, (10, 2))])
    pts = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(X)], "id long, coords array<double>")
    lab = (X[:, 0] > 1.5).astype(int)
    labels = spark.createDataFrame([("r", i, int(l)) for i, l in enumerate(lab)], "config string, id long, label int")
    got = C.silhouette(pts, labels, block_rows=32).first()["silhouette"]  # several blocks on purpose
    assert got == pytest.approx(_brute_silhouette(X, lab))
    res = C.dbscan_grid(pts, [0.3, 0.5], [3, 5], block_rows=32).toPandas()
    for (eps, m), g in res.groupby(["eps", "min_samples"]):
        exp = _brute_dbscan(X, eps, m)
        got = g.sort_values("id")["label"].to_numpy()
        assert (got == exp).all(), (eps, m)


@pytest.mark.parametrize("heavy, shrink, blocks", [(10**6, 10.0, 3), (10**6, 0.0, None), (9, 10.0, 3), (9, 0.0, 2), (0, 10.0, 3), (14, 0.0, 5)])
def test_cosine_topk_equals_dense(spark, monkeypatch, heavy, shrink, blocks):
    """With no, some and only heavy columns; signed values, a row of zeros, a row that shares nothing."""
    from tabularis.operators import cosine

    monkeypatch.setattr(cosine, "HEAVY", heavy)
    monkeypatch.setattr(cosine, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(cosine, "PAIRS_AT_ONCE", 200)
    rng = np.random.default_rng(4)
    held = rng.random((40, 14)) < np.r_[np.full(4, 0.7), np.full(10, 0.15)]
    M_ = held * np.where(rng.random((40, 14)) < 0.3, -1, 1) * rng.integers(1, 6, (40, 14)).astype(float)
    rows = [(u, i, float(M_[u, i])) for u in range(40) for i in range(14) if held[u, i]] + [(40, 1, 0.0), (41, 99, 2.0)]
    full, O = np.zeros((42, 100)), np.zeros((42, 100))
    for u, i, v in rows:
        full[u, i], O[u, i] = v, 1
    got = cosine.cosine_topk(spark.createDataFrame(rows, "u long, i long, v double"), "u", "i", "v", 5, shrink=shrink, blocks=blocks).toPandas()
    norms = np.sqrt((full**2).sum(1))
    both = O @ O.T
    with np.errstate(invalid="ignore"):
        sim = np.nan_to_num((full @ full.T) / np.outer(norms, norms)) * (both / (both + shrink) if shrink else 1)
    for u in range(42):
        cand = [(round(sim[u, v], 12), v) for v in range(42) if v != u and both[u, v] > 0]
        exp = sorted(cand, key=lambda t: (-t[0], t[1]))[:5]
        own = got[got.a == u].sort_values("rank")
        assert list(own["b"]) == [v for _, v in exp] and own["sim"].to_numpy() == pytest.approx([s for s, _ in exp], abs=1e-9)
        assert list(own["overlap"]) == [both[u, v] for v in own["b"]] and list(own["rank"]) == list(range(1, len(own) + 1))


def test_label_file_reader_line_numbers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 0.5 0.5 0.1 0.1\n2 0.5 0.5 0.1 0.1\n")
    (tmp_path / "b.txt").write_text("")
    from tabularis.sources.files import read_label_lines

    rows = sorted((r["file"].split("/")[-1], r["line_no"], r["value"]) for r in read_label_lines(spark, str(tmp_path)).collect())
    assert rows == [("a.txt", 1, "1 0.5 0.5 0.1 0.1"), ("a.txt", 2, "2 0.5 0.5 0.1 0.1")]


def test_greedy_matching_one_to_one(spark):
    truth = spark.createDataFrame([(1, 0, 1, 0.5, 0.5, 0.2, 0.2), (1, 0, 2, 0.52, 0.5, 0.2, 0.2)],
                                  "image_id long, class_id int, box_id long, x double, y double, w double, h double")
    preds = spark.createDataFrame([(1, 0, 1, 0.5, 0.5, 0.2, 0.2, 0.9), (1, 0, 2, 0.5, 0.5, 0.2, 0.2, 0.8),
                                   (1, 0, 3, 0.9, 0.9, 0.05, 0.05, 0.7)],
                                  "image_id long, class_id int, box_id long, x double, y double, w double, h double, conf double")
    m = A.match_detections(truth, preds, partitions=2).orderBy(F.col("conf").desc()).collect()
    assert [r["tp_50"] for r in m] == [1, 1, 0]
    r = A.detection_map(truth, preds, 0.25).first()
    assert r["recall"] == pytest.approx(1.0) and r["precision"] == pytest.approx(2 / 3)


def test_truncated_svd_equals_numpy(spark):
    rng = np.random.default_rng(8)
    M_ = 0.05 * rng.normal(size=(40, 25))
    for scale in (8.0, 4.0, 2.0, 1.0):
        M_ += scale * np.outer(rng.normal(size=40), rng.normal(size=25))
    rows = [(u, i, float(M_[u, i])) for u in range(40) for i in range(25)]
    uf, vf, values = R.truncated_svd(spark.createDataFrame(rows, "user_id long, item_id long, c double"), 4)
    U, S_, Vt = np.linalg.svd(M_)
    assert values == pytest.approx(S_[:4], rel=1e-4)
    f = [f"f{i}" for i in range(4)]
    got = uf.toPandas().sort_values("user_id")[f].to_numpy() @ vf.toPandas().sort_values("item_id")[f].to_numpy().T
    assert np.abs(got - (U[:, :4] * S_[:4]) @ Vt[:4]).max() < 0.05


def test_unknown_user_is_an_error(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    recs = spark.createDataFrame([(1, 5), (2, 6)], "user_id long, item_id long")
    assert R.for_user(recs, users, 2).first()["item_id"] == 6
    with pytest.raises(ValueError):
        R.for_user(recs, users, 9)


def test_dbscan_chain_is_one_cluster_for_every_block_size(spark):
    pts = spark.createDataFrame([(i, [0.1 * i, 0.0]) for i in range(400)], "id long, coords array<double>")
    for block_rows in (2048, 40):
        s = C.dbscan_summary(C.dbscan_grid(pts, [0.15], [3], block_rows)).first()
        assert (s["clusters"], s["noise"]) == (1, 0)


def test_one_value_in_all_rows_is_one_row_of_the_quantile_counts(spark):
    df = spark.range(5000).select(F.lit(0.25).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("y"))
    got = P.quantile_values(df, ["x", "y"], [0.5, 0.9])
    assert got[("x", 0.5)] == 0.25 and got[("x", 0.9)] == 0.25
    assert got[("y", 0.5)] == pytest.approx(np.percentile(np.arange(0, 5000, 2), 50))


def test_strict_requests(spark):
    good = '{"product_type": "L", "air_temperature_k": 300, "process_temperature_k": 310.5, "rotational_speed_rpm": 1500, "torque_nm": 40.0, "tool_wear_min": 10}'
    cases = {
        "good": (good, []), "tabs": (good.replace(", ", ",\t") + "\n", []),
        "single": (good.replace('"', "'"), ["json_invalid"]), "garbage": (good + " garbage", ["json_invalid"]),
        "two": (good + good, ["json_invalid"]), "bracket": (good + "],[" + good, ["json_invalid"]), "array": ("[1]", ["json_invalid"]), "null": (None, ["json_invalid"]),
        "faults": (good.replace('"L"', '"X"').replace("1500", "-5"), ["greater_than", "literal_error"]),
        "quoted": (good.replace("40.0", '"40.0"'), ["float_type"]), "bool": (good.replace("40.0", "true"), ["float_type"]),
        "missing": (good.replace(', "torque_nm": 40.0', ""), ["missing"]), "extra": (good[:-1] + ', "foo": 1}', ["extra_forbidden"]),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "request_id string, body string")
    for r in S.validate_requests(df).collect():
        assert sorted(e["rule"] for e in r["errors"]) == cases[r["request_id"]][1], r["request_id"]
        assert r["is_valid"] == (not cases[r["request_id"]][1])
    with pytest.raises(ValueError):
        S.require_rows(df.limit(0))


def test_label_files_name_the_image(spark, tmp_path):
    from tabularis.sources import sinks

    valid = spark.createDataFrame([(1, 1, "a 1"), (1, 2, "b 2"), (2, 1, "c 3")], "image_id long, line_no int, value string")
    images = spark.createDataFrame([(1, "train"), (2, "train"), (3, "train")], "image_id long, split string")
    sinks.write_label_files(valid, images, str(tmp_path / "labels"))
    files = {p.name: p.read_text() for p in (tmp_path / "labels" / "train").iterdir()}
    assert files == {"1.txt": "a 1\nb 2\n", "2.txt": "c 3\n", "3.txt": ""}


def test_crlf_label_files(spark, tmp_path):
    from tabularis.sources import files

    (tmp_path / "a.txt").write_bytes(b"1 0.5 0.5 0.1 0.1\r\n\t2 0.5 0.5 0.1 0.1\t\r\n")
    lines = files.read_label_lines(spark, str(tmp_path))
    got = A.parse_lines(lines).orderBy("line_no").collect()
    assert [(r["line_no"], r["class_id"], r["reason"]) for r in got] == [(1, 1, None), (2, 2, None)]


def test_smote_rows_lie_between_neighbours(spark):
    from tabularis.operators import oversample as O

    rng = np.random.default_rng(9)
    X_ = rng.normal(size=(70, 2))
    rows = [(i, 1 if i < 20 else 0, float(a), float(b), "ab"[i % 2]) for i, (a, b) in enumerate(X_)]
    df = spark.createDataFrame(rows, "id long, y int, u double, v double, c string")
    got = O.smote_nc(df, "id", "y", ["u", "v"], ["c"], block_rows=8).toPandas()
    assert len(got) == 30 and set(got["y"]) == {1}
    m = X_[:20]
    step = np.median(m.std(0))
    cat = np.arange(20) % 2
    D = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1) + step**2 * (cat[:, None] != cat[None]))
    np.fill_diagonal(D, np.inf)
    near = np.argsort(D, axis=1)[:, :5]
    for r in got.itertuples():
        assert r.near in near[r.base]
        assert (r.u, r.v) == pytest.approx(tuple(m[r.base] + r.draw * (m[r.near] - m[r.base])))
        votes = [cat[j] for j in near[r.base]]
        assert r.c == ("a" if votes.count(0) > votes.count(1) else "b")
    assert O.smote_nc(df.filter("y = 1"), "id", "y", ["u", "v"], ["c"]).count() == 0


def test_batch_bodies(spark):
    """0, 1, 1,000 and 1,001 records; one bad record rejects its batch; texts that are no array."""
    import json

    good = {"product_type": "L", "air_temperature_k": 300, "process_temperature_k": 310.5, "rotational_speed_rpm": 1500, "torque_nm": 40, "tool_wear_min": 0}
    text = lambda *records: json.dumps(list(records))
    bodies = {
        "none": "[]", "one": text(good), "most": text(*[good] * 1000), "over": text(*[good] * 1001), "bad": text(good, {**good, "torque_nm": -1, "x": 1}, good, {}),
        "odd": text(good, 5, None, [good]), "object": json.dumps(good), "broken": "[{", "tail": text(good) + "]", "two": "[],[]", "null": "null", "missing": None,
    }
    df = spark.createDataFrame(list(bodies.items()), "batch_id string, body string")
    found, records = S.validate_batches(df)
    rows = {r["batch_id"]: r for r in found.collect()}
    errors = {k: sorted((e["at"], e["field"], e["rule"]) if e["at"] is not None else (e["field"], e["rule"]) for e in r["errors"]) for k, r in rows.items()}
    assert {k for k, r in rows.items() if r["is_valid"]} == {"one", "most"} and set(rows) == set(bodies)
    assert errors["none"] == [("body", "too_short")] and errors["over"] == [("body", "too_long")] and errors["object"] == [("body", "list_type")]
    assert all(errors[k] == [("body", "json_invalid")] for k in ("broken", "tail", "two", "missing")) and errors["null"] == [("body", "list_type")]
    assert errors["bad"][-2:] == [(3, "tool_wear_min", "missing"), (3, "torque_nm", "missing")] or (1, "torque_nm", "greater_than_equal") in errors["bad"]
    assert {(1, "x", "extra_forbidden"), (1, "torque_nm", "greater_than_equal")} <= set(errors["bad"]) and len(errors["bad"]) == 8
    assert [(r["at"], r["rule"]) for r in rows["odd"]["errors"]] and {r["at"] for r in rows["odd"]["errors"]} == {1, 2, 3}
    assert {k: r["n_records"] for k, r in rows.items() if r["n_records"] is not None} == {"none": 0, "one": 1, "most": 1000, "over": 1001, "bad": 4, "odd": 4}
    kept = records.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("at").alias("at"), F.min("torque_nm").alias("t")).collect()
    assert sorted((r["batch_id"], r["n"], r["at"], r["t"]) for r in kept) == [("most", 1000, 999, 40.0), ("one", 1, 0, 40.0)]


def test_kmeans_sweep_against_plain_lloyd(spark):
    """All settings in shared scans: the best inertia is no worse than that of separate fits, and labels fit it."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from tabularis.operators import kmeans

    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.35, (60, 2)) for c in ((0, 0), (3, 0), (0, 3), (3, 3), (1.5, 6))])
    pts = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)], "id long, coords array<double>").repartition(4)
    best, rounds = kmeans.sweep(pts, [2, 5, 7], 6, max_iter=100)
    assert rounds <= 100 and set(best) == {2, 5, 7}
    data = pts.select(array_to_vector("coords").alias("features"))
    for k, (inertia, _, centres) in best.items():
        separate = min(KMeans(k=k, seed=s, maxIter=100, tol=1e-4).fit(data).summary.trainingCost for s in range(3))
        assert inertia <= separate * 1.01
        lab = {r["id"]: r["label"] for r in pts.select("id", kmeans.label("coords", centres).alias("label")).collect()}
        near = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert [lab[i] for i in range(len(x))] == near.argmin(axis=1).tolist()
        assert inertia == pytest.approx(near.min(axis=1).sum())
    again, _ = kmeans.sweep(pts.repartition(2), [5], 6, max_iter=100)
    assert again[5][0] == pytest.approx(best[5][0])
    few, _ = kmeans.sweep(pts.where("id < 2"), [3], 2)
    assert few[3][0] == pytest.approx(0)


def test_detection_map_in_ranges(spark, monkeypatch):
    """Average precision by hand, with one and with many ranges of confidence."""
    rng = np.random.default_rng(3)
    truth = [(i, c, b, 0.1 + 0.2 * b, 0.5, 0.1, 0.1) for i in range(25) for c in range(2) for b in range(4)]
    preds = [(i, c, b, x + float(rng.choice([0, 0, 0.01, 0.3])), y, w, h, round(float(rng.random()), 2)) for i, c, b, x, y, w, h in truth if rng.random() < 0.8]
    t = spark.createDataFrame(truth, "image_id long, class_id int, box_id long, x double, y double, w double, h double")
    p = spark.createDataFrame(preds, "image_id long, class_id int, box_id long, x double, y double, w double, h double, conf double")
    whole = A.detection_map(t, p).first().asDict()
    found = A.match_detections(t, p).toPandas()
    ap = []
    for c in range(2):
        m = found[found["class_id"] == c].sort_values(["conf", "image_id", "box_id"], ascending=[False, True, True])
        tp = m["tp_50"].to_numpy()
        precision = np.maximum.accumulate((np.cumsum(tp) / np.arange(1, len(tp) + 1))[::-1])[::-1]
        ap.append(precision[tp == 1].sum() / 100)
    assert whole["map50"] == pytest.approx(np.mean(ap))
    monkeypatch.setattr(A, "RANGE_ROWS", 3)
    assert A.detection_map(t, p.repartition(5)).first().asDict() == pytest.approx(whole)


def test_topk_unseen_against_brute_force(spark):
    """Supported cells, seen items and fallback places in one order; scores equal to 12 digits go by the smaller item."""
    items = {i: 1 + (i * 7 % 11) / 4 for i in range(1, 40)} | {50: 4.9 + 4e-15, 41: 4.9, 60: 4.9 - 4e-15}
    seen = [(u, i) for u in range(6) for i in items if (u * 31 + i * 17) % 5 == 0 and u != 3] + [(4, i) for i in items if i % 3]
    scored = [(u, i, 1 + (u * 13 + i * 29) % 40 / 10) for u in range(5) for i in items if (u + i) % 4 == 0 and u != 3]
    ranked = R.ranked_fallback(spark.createDataFrame(list(items.items()), "item_id long, fallback double"))
    place = {r["item_id"]: r["place"] for r in ranked.collect()}
    assert sorted(place, key=place.get) == sorted(items, key=lambda i: (-round(items[i], 12), i))
    users = spark.createDataFrame([(u,) for u in range(7)], "user_id long")
    s = spark.createDataFrame(sorted(set(seen)), "user_id long, item_id long")
    cells = spark.createDataFrame([(u, i, v, place[i]) for u, i, v in scored], "user_id long, item_id long, score double, place long")
    for given, known in ((cells, {(u, i): v for u, i, v in scored}), (None, {})):
        got = {(r["user_id"], r["rank"]): (r["item_id"], r["score"]) for r in R.topk_unseen(given, users, s, ranked, 3).collect()}
        want = {}
        for u in range(7):
            open_items = [(known.get((u, i), f), i) for i, f in items.items() if (u, i) not in set(seen)]
            for n, (v, i) in enumerate(sorted(open_items, key=lambda x: (-round(x[0], 12), x[1]))[:3], 1):
                want[u, n] = (i, v)
        assert got == want


def test_topk_unseen_keeps_the_cells_of_a_null_user(spark):
    ranked = R.ranked_fallback(spark.createDataFrame([(1, 3.0), (2, 2.0), (3, 1.0)], "item_id long, fallback double"))
    users = spark.createDataFrame([(None,), (7,)], "user_id long")
    seen = spark.createDataFrame([(None, 1), (7, 1)], "user_id long, item_id long")
    cells = spark.createDataFrame([(None, 3, 5.0, 3), (7, 3, 2.5, 3)], "user_id long, item_id long, score double, place long")
    got = sorted((str(r["user_id"]), r["rank"], r["item_id"], r["score"]) for r in R.topk_unseen(cells, users, seen, ranked, 2).collect())
    assert got == [("7", 1, 3, 2.5), ("7", 2, 2, 2.0), ("None", 1, 3, 5.0), ("None", 2, 1, 3.0)]


def test_nearest_points_are_exact_over_many_leaves_and_meet_few(spark, monkeypatch):
    from tabularis.operators import oversample as O

    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(size=(1500, 2)), rng.normal(size=(20, 2)) * 30, np.zeros((30, 2))])
    x = np.column_stack([x, rng.integers(0, 2, len(x)) * 0.7])
    made = []
    dist = O._dist
    monkeypatch.setattr(O, "_dist", lambda a, b: made.append(len(a) * len(b)) or dist(a, b))
    near = [g for i, c in ((i, x[i]) for i in (0, 7, 1510)) for g in O._first_of(np.array([i]), c[None], np.arange(len(x)), x, 4)]
    assert [len(g[1]) for g in near] == [4, 4, 4] and near[0][1][0] == np.argsort(np.where(np.arange(len(x)) == 0, np.inf, dist(x[:1], x)[0]), kind="stable")[0]
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(x)], "id long, coords array<double>")
    found = O.nearest(points, 4, block_rows=50).toPandas()
    d = np.round(dist(x, x), 9)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :4]
    got = found.sort_values(["id", "rank"])["near"].to_numpy().reshape(-1, 4)
    assert len(found) == 4 * len(x)
    assert np.allclose(np.take_along_axis(d, got, 1), np.take_along_axis(d, want, 1), atol=1e-7)
    tree = O._kd_tree(x, 32)
    leaf = O._leaf_of(x, tree)
    assert leaf.max() + 1 >= 16 and np.bincount(leaf[:1500]).max() < 200
    visits = O._visits(4, *(np.array([f(x[leaf == n], axis=0) for n in range(leaf.max() + 1)]) for f in (np.min, np.max)))
    some = pd.DataFrame({"id": np.flatnonzero(leaf == 3), "coords": list(x[leaf == 3])})
    assert len(visits(some)) < 8 * len(some)


def test_exact_silhouette_makes_each_distance_once(spark, tmp_path):
    """Both sides of a pair of blocks take their sums from the same distances, so that half of the pairs of blocks are made."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (200, 2)), rng.normal(4, 1, (100, 2))])
    pts = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(x)], "id long, coords array<double>")
    pairs = C._half_pairs(pts, 5).groupBy("_ga", "_gb").count().collect()
    assert len(pairs) == 15 and all(r["_ga"] <= r["_gb"] for r in pairs)
    labs = {"a": (x[:, 0] > 2).astype(int), "b": rng.integers(-1, 3, len(x))}
    labels = spark.createDataFrame([(n, i, int(v)) for n, lab in labs.items() for i, v in enumerate(lab)], "config string, id long, label int")
    got = {r["config"]: r for r in C.silhouette(pts, labels, block_rows=64).collect()}
    for n, lab in labs.items():
        keep = lab >= 0
        assert got[n]["silhouette"] == pytest.approx(_brute_silhouette(x[keep], lab[keep]), abs=1e-9)
        assert got[n]["n_points"] == keep.sum()


def test_svd_topk_equals_full_sort_with_ties_and_copies_few_rows(spark, monkeypatch):
    from tabularis.operators import recsys as R

    rng = np.random.default_rng(8)
    left, right = rng.normal(size=(40, 4)), np.column_stack([rng.normal(size=(900, 3)), np.ones(900)])
    left[:5, :3], left[5:9, 3] = 0, 9  # equal scores for all items; all scores clipped to 5
    seen = np.unique(np.column_stack([rng.integers(0, 40, 300), rng.integers(0, 60, 300)]), axis=0)
    monkeypatch.setattr(R, "TILE_ITEMS", 37)
    rows, cols, scores = R._best_items(left, right, seen[:, 0], seen[:, 1], 6)
    full = np.round(np.clip(left @ right.T, 1, 5), 10)
    full[seen[:, 0], seen[:, 1]] = -np.inf
    want = np.argsort(-full, axis=1, kind="stable")[:, :6]
    assert (rows == np.repeat(np.arange(40), 6)).all()
    assert np.allclose(scores.reshape(40, 6), np.take_along_axis(full, want, 1)) and (cols.reshape(40, 6)[:9] == want[:9]).all()
    train = spark.createDataFrame([(int(u), int(i), float(1 + (u * i) % 5)) for u, i in seen], "user_id long, item_id long, rating double")
    users, items = (spark.range(n).select(F.col("id").alias(c)) for n, c in ((45, "user_id"), (70, "item_id")))
    one, two = (R.svd_topk(train, users, items, 3, 5, block_rows=b).toPandas().sort_values(["user_id", "rank"]) for b in (8, 1 << 16))
    assert len(one) == 45 * 5 and np.allclose(one["score"], two["score"], atol=1e-9)
    assert R._grid(900_000, 1_200_000, 12)[0] * 1_200_000 + R._grid(900_000, 1_200_000, 12)[1] * 900_000 < 12_000_000


def test_dbscan_settings_at_once_and_few_distances(spark, monkeypatch):
    """Crowded cells need no counts of their own; cells are linked by the first pair within eps; levels give all min_samples."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(0, 0.2, (150, 2)), rng.normal(1.2, 0.3, (100, 2)), rng.uniform(-2, 3, (60, 2)), np.zeros((5, 2))])
    pts = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(x)], "id long, coords array<double>")
    res = C.dbscan_grid(pts, [0.1, 0.3, 0.7], [6, 2, 4]).toPandas()
    assert len(res) == 9 * len(x)
    for (eps, m), g in res.groupby(["eps", "min_samples"]):
        assert (g.sort_values("id")["label"].to_numpy() == _brute_dbscan(x, eps, m)).all(), (eps, m)
    a, b = rng.uniform(0, 1, (20_000, 2)), rng.uniform(0, 1, (20_000, 2)) + [1, 0]
    made, dist, ones = [], C._dist, np.full(20_000, 3)
    monkeypatch.setattr(C, "_dist", lambda p, q: made.append(len(p) * len(q)) or dist(p, q))
    assert C._edge_level(a, ones, b, ones, 0.5) == 3 and sum(made) < 1e6
    assert C._edge_level(a, ones, b + [0.5, 0], ones, 0.4) == 0
    line = [spark.createDataFrame([(i, [0.05 * i] * d) for i in range(30)], "id long, coords array<double>") for d in (1, 3)]
    for df, eps in zip(line, (0.051, 0.09), strict=True):
        s = C.dbscan_summary(C.dbscan_grid(df, [eps], [3])).first()
        assert (s["clusters"], s["noise"]) == (1, 0)
