"""Hard negatives against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularis.llm import negatives


def brute(rows, every=5, n_pos=5, n_neg=3, low=50, high=95):
    whole = []
    for name, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((name, label, [math.floor(256 * x) for x in v]))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (name, label, v) in enumerate(whole):
        if name is None or name % every:
            continue
        score = [(sum(a * b for a, b in zip(v, u, strict=False)), other, lab) for j, (other, lab, u) in enumerate(whole) if j != k]
        for p, positive, _ in sorted((s for s in score if s[2] == label), key=order)[:n_pos]:
            inside = sorted((s for s in score if s[2] != label and low * p <= 100 * s[0] <= high * p), key=order)[:n_neg]
            out += [(name, positive, r + 1, negative, p, s) for r, (s, negative, _) in enumerate(inside)]
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)


def found(df, every=5):
    return sorted((tuple(r) for r in negatives.hard_negatives(negatives.whole_vectors(df), F.col("id") % every == 0).collect()), key=str)


def clustered(seed, n, dims, labels):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(labels, dims)) * 0.3
    label = rnd.integers(0, labels, n)
    return [(int(k), [float(np.float32(x)) for x in centre[label[k]] * rnd.choice([0.2, 1, 1]) + rnd.normal(size=dims) * 0.3], int(label[k])) for k in range(n)]


@pytest.mark.parametrize("dims", [3, 16, 40])
def test_several_blocks_and_chunks(spark, monkeypatch, dims):
    monkeypatch.setattr(negatives, "NUMBERS", 40 * dims)
    monkeypatch.setattr(negatives, "ANCHOR_NUMBERS", 11 * dims)
    rows = clustered(dims, 200, dims, 4)
    assert found(frame(spark, rows)) == brute(rows)


def test_one_label_of_most_rows_and_equal_vectors(spark):
    rows = clustered(2, 90, 8, 3)
    rows = [(k, rows[0][1] if k % 3 else v, 0 if k % 4 else lab) for k, v, lab in rows]
    assert found(frame(spark, rows)) == brute(rows)


def test_edges(spark):
    rows = clustered(3, 40, 5, 2)
    rows += [(40, None, 1), (45, [1.0, None, 0.0, 0.0, 0.0], 1), (50, [float("nan")] * 5, 0), (55, [float("inf")] * 5, 0), (60, [0.5] * 5, None)]
    rows += [(65, [], 0), (70, [0.25, 0.5], 1), (75, [0.1] * 9, 0), (None, [0.3] * 5, 1), (10, [0.2] * 5, 1), (10, [0.2] * 5, 1), (80, [-0.5] * 5, 7), (85, [0.0] * 5, 0)]
    df = frame(spark, rows)
    assert found(df.withColumns({"row": F.lit("x"), "id": F.lit(1)}).toDF("vec_id", "embedding", "label", "LABEL", "v")) == brute(rows)
    assert found(df.where("vec_id = 3")) == [] and found(df.where("false")) == []


def test_pruned_search_equals_all_products():
    rnd = np.random.default_rng(7)
    x = rnd.integers(-200, 200, (500, 37)).astype(np.int64)
    for ratio in (0.0, 300.0, 900.0):
        index = negatives.Index(x, ratio)
        for q in x[:20]:
            least = int(max(ratio * np.sqrt((q * q).sum()), 1))
            at, score = index.search(q, least)
            want = np.flatnonzero(x @ q >= least)
            assert sorted(at) == want.tolist() and (score == (x @ q)[at]).all()
