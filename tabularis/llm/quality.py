"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. ``document_stats``: one pass over whole texts gives a short vector of statistics a document.
2. ``fit``: cosines of random projections (a Gaussian kernel's random Fourier features) of the
   standardised statistics; each partition sums its normal equations by fold, Spark adds the partial
   sums row by row, and the driver solves systems whose size depends on ``FEATURES`` only.
   Every fold is scored by a model that did not see it; the scores' bin sums (at most ``BINS``)
   give the isotonic calibration by pooling adjacent violators.
3. ``score``: calibrated scores from 0 to 1.

All labelled rows outside the held-out fifth are used (no sample). Labels, language, source and ids are
never inputs of a score.

Cases: null and empty texts have zero statistics and get a score like any other; several labels of a
document are averaged; without any labelled row every score is 0.5; with one class it is
that class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularis.llm.common import byte_slices, doc_texts, lean, pick, public_id, small_batches, written
from tabularis.llm.words import IS_SPACE, Words

FEATURES = 192  # random features
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-3  # times the number of rows
BINS = 2048  # of raw scores, for the calibration
FOLDS = 5  # by crc32 of the id; fold 0 is held out
THRESHOLD = 0.3

_CLASSES = {
    "upper": range(65, 91), "digit": range(48, 58), "space": [32], "newline": [10], "sentence": b".,;:?'\"", "symbol": b"!#$%&*+/<=>@[\\]^_`{|}~",
    "continuation": range(128, 256),
}
CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    CLASS_OF[list(_bytes), _k] = 1.0
SYMBOL = CLASS_OF[:, 5] > 0
UPPER = CLASS_OF[:, 0] > 0
STATS = [*_CLASSES, "log_bytes", "log_words", "word_length", "distinct_words", "same_as_previous", "top_word", "distinct_triples", "symbol_ends", "capital_ends", "one_byte_words", "line_length", "distinct_lines"]


def _sorted_within(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = values.copy()
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        out[lo:hi].sort()
    return out


def _runs(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values of each text, and how often its most frequent one stands."""
    n = len(at) - 1
    distinct, top = np.zeros(n), np.zeros(n)
    if not len(values):
        return distinct, top
    s = _sorted_within(values, at)
    new = np.r_[True, s[1:] != s[:-1]]
    new[at[:-1][at[:-1] < len(s)]] = True
    first = np.flatnonzero(new)
    cum = np.r_[0, np.cumsum(new)][at]
    distinct = np.diff(cum).astype(float)
    full = np.flatnonzero(distinct)
    top[full] = np.maximum.reduceat(np.diff(np.r_[first, len(s)]), cum[full])
    return distinct, top


def _stats_of(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n = len(offs) - 1
    out = np.zeros((n, len(STATS)))
    size = np.maximum(np.diff(offs), 1).astype(float)
    words = Words(data, offs)
    at, count = words.at, np.maximum(np.diff(words.at), 1).astype(float)
    last = data[words.ends - 1]
    length = (words.ends - words.starts).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(values)]
        return (total[at[1:]] - total[at[:-1]]) / count

    same = np.r_[False, words.hash[1:] == words.hash[:-1]][: len(words.hash)]
    same[at[:-1][at[:-1] < len(same)]] = False
    triples = words.windows(3)
    whole = words.doc[2:] == words.doc[:-2] if len(triples) else np.zeros(0, bool)
    triple_at = np.r_[0, np.cumsum(whole)][np.minimum(at, len(triples))]
    distinct, top = _runs(words.hash, at)
    out[:, 7:12] = np.c_[np.log1p(np.diff(offs)), np.log1p(np.diff(at)), per_word(length), distinct / count, per_word(same) * count / np.maximum(count - 1, 1)]
    out[:, 12], out[:, 13] = top / count, _runs(triples[whole], triple_at)[0] / np.maximum(np.diff(triple_at), 1)
    out[:, 14:17] = np.c_[per_word(SYMBOL[last]), per_word(UPPER[last]), per_word(length == 1)]
    for i in range(n):
        text = data[offs[i] : offs[i + 1]]
        out[i, :7] = (np.bincount(text, minlength=256) @ CLASS_OF) / size[i]
        lines = text.tobytes().split(b"\n")
        out[i, 17:] = size[i] / len(lines), len(set(lines)) / len(lines)
    out[:, 17] = np.log1p(out[:, 17])
    return out


def _stats_column(column: pa.Array) -> np.ndarray:
    parts = [_stats_of(data, offs) for _, _, data, offs in byte_slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATS)))


def document_stats(docs: DataFrame) -> DataFrame:
    """(id, x array of statistics) of every row, whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _stats_column(b.column("text").fill_null(""))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), flat], names=["id", "x"])

    return doc_texts(docs).mapInArrow(lean(run), "id long, x array<double>")


def fold_of(c: str = "id"):
    """crc32 of the id's text, modulo 5 (a null id: of the empty text)."""
    return (F.crc32(F.coalesce(public_id(c).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # FEATURES + 1
    raw: np.ndarray  # calibration: raw scores and what they stand for
    level: np.ndarray

    def raw_score(self, x: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return _phi(x, self.mean, self.scale) @ (self.weights if weights is None else weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), float(self.level[0]))
        return np.interp(self.raw_score(x), self.raw, self.level)


def _phi(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(7)
    w = rng.standard_normal((len(STATS), FEATURES)) / WIDTH
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(z @ w + shift), np.ones((len(x), 1))])


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, len(STATS)))


def _normal_sums(train: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the sum over rows of phi phiᵀ beside phi·y: (FEATURES+1) x (FEATURES+2)."""
    size = FEATURES + 1

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in frames:
            phi, y, fold = _phi(_matrix(pdf), mean, scale), pdf["y"].to_numpy(), pdf["fold"].to_numpy()
            for f in np.unique(fold):
                p = phi[fold == f]
                sums[f] = sums.get(f, 0) + np.hstack([p.T @ p, (p.T @ y[fold == f])[:, None]])
        for f, m in sums.items():
            yield pd.DataFrame({"fold": int(f), "line": np.arange(size), "sums": list(m)})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": pdf["fold"][:1], "line": pdf["line"][:1], "sums": [np.sum(np.vstack(pdf["sums"]), axis=0)]})

    schema = "fold int, line int, sums array<double>"
    rows = train.mapInPandas(lean(partial), schema).groupBy("fold", "line").applyInPandas(added, schema).collect()
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["fold"], np.zeros((size, size + 1)))[r["line"]] = r["sums"]
    return out


def _solve(sums: np.ndarray) -> np.ndarray:
    gram, rows = sums[:, :-1].copy(), sums[-1, -2]  # the constant feature's square counts rows
    gram[np.diag_indices(FEATURES)] += RIDGE * rows
    return np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), sums[:, -1])


def pooled(level: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, float]]:
    """Pool adjacent violators: blocks (first, end, mean), rising."""
    blocks: list[list[float]] = []
    for i, (v, w) in enumerate(zip(level, weight, strict=True)):
        blocks.append([i, i + 1, v, w])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            _, end, v2, w2 = blocks.pop()
            b = blocks[-1]
            b[2], b[1], b[3] = (b[2] * b[3] + v2 * w2) / (b[3] + w2), end, b[3] + w2
    return [(int(a), int(b), float(v)) for a, b, v, _ in blocks]


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on all labelled rows whose fold is not 0. ``stats`` from document_stats."""
    y = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
    y = y.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.avg("quality").alias("y"))
    train = stats.join(y, "id").select(fold_of().alias("fold"), "x", "y").where("fold <> 0")
    train = written(train, "quality-train")
    parts = [F.struct(F.avg(F.col("x")[i]).alias("m"), F.stddev_pop(F.col("x")[i]).alias("s")).alias(f"s{i}") for i in range(len(STATS))]
    head = train.agg(F.count("*").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"), *parts).first()
    none = np.zeros(0)
    if not head["n"] or head["lo"] == head["hi"]:
        return QualityModel(none, none, none, none, np.array([0.5 if not head["n"] else head["lo"]]))
    mean = np.array([head[f"s{i}"]["m"] for i in range(len(STATS))])
    scale = np.array([head[f"s{i}"]["s"] or 1.0 for i in range(len(STATS))])
    sums = _normal_sums(train, mean, scale)
    whole = sum(sums.values())
    apart = {f: _solve(whole - s) if whole[-1, -2] > s[-1, -2] else _solve(whole) for f, s in sums.items()}

    def unseen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            phi = _phi(_matrix(pdf), mean, scale)
            raw = np.array([p @ apart[f] for p, f in zip(phi, pdf["fold"], strict=True)])
            yield pd.DataFrame({"raw": raw, "y": pdf["y"].to_numpy()})

    spot = F.floor((F.greatest(F.least(F.col("raw"), F.lit(2.0)), F.lit(-1.0)) + 1) / 3 * BINS)
    bins = train.mapInPandas(lean(unseen), "raw double, y double").groupBy(spot.alias("bin")).agg(F.count("*").alias("n"), F.avg("raw").alias("raw"), F.avg("y").alias("y"))
    bins = bins.orderBy("bin").toPandas()
    raw, level = [], []
    for a, b, v in pooled(bins["y"].to_numpy(), bins["n"].to_numpy(float)):
        raw.append(np.average(bins["raw"][a:b], weights=bins["n"][a:b]))
        level.append(v)
    return QualityModel(mean, scale, _solve(whole), np.array(raw), np.clip(level, 0.0, 1.0))


def score_stats(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(id, score) of every row of document_stats."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"id": pdf["id"], "score": model.score(_matrix(pdf))})

    return stats.mapInPandas(lean(run), "id long, score double")


def score_rows(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with a ``score`` column, in one pass over the texts."""
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_stats_column(b.column("text").fill_null("")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, "score"])

    return docs.mapInArrow(lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    stats = written(document_stats(docs), "quality-stats")
    scored = score_stats(stats, fit(stats, labels))
    return scored.select(public_id().alias("doc_id"), (fold_of() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
