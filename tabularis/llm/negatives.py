"""Hard-negative mining by threshold joins over an inverted index with suffix-norm bounds (in the manner of L2AP).

Rows are vectors of whole numbers with a label; a row's score with an anchor is their inner product. An anchor's
positives are its first rows of the same label; a positive's negatives are the first rows of other labels in a window
of scores below the positive's.

1. Rows are hashed into blocks of ``NUMBERS`` components, anchors into chunks, each packed as one row. A task meets
   one chunk with one block, so that its memory is bounded whatever the table's size, and a label that holds most rows is
   spread like any other. Every chunk meets every block, as every anchor is a stated query against all rows.
2. Index. A task orders its dimensions by weight, heaviest last, in groups of ``STEP``. A row's first groups stay out of
   the index as long as their norm times the anchor's cannot reach the threshold; the posting list of a group is
   the rows that index it. An anchor reads the lists from the last group on, adds up partial scores and drops a
   row once the score so far and the product of the remaining norms stay below the threshold.
   What is left is scored exactly, in 64-bit whole numbers.
3. Thresholds. All rows above an anchor's threshold are known after a round, so its first ones above it are final. Anchors
   whose positives (then, windows) are not yet full search again with a lower threshold; the last round has none
   (for windows: their lower end). A task returns at most the wanted number of rows for each anchor and window.

Cases: rows with a null label, a null vector, a null or non-finite component take no part, nor do vectors whose squared
norm is beyond 2**54 (a hundred times their scores doesn't fit a long). Vectors of different lengths multiply over their common components; an
empty vector scores 0. A null ``vec_id`` is no anchor; as a partner it sorts after all ids. Rows that repeat a ``vec_id``
are rows of their own (an anchor leaves out itself alone). Equal scores go by the smaller id. An empty table, or one
without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.llm.common import NULL_ID, lean, pick, public_id, shuffle_width, small_batches, written

#: Components of a block of rows, and of a chunk of anchors.
NUMBERS, ANCHOR_NUMBERS = 1 << 18, 1 << 16
#: Dimensions that an anchor reads between two prunings.
STEP = 16
NO_LIMIT = -(2**62)
#: First thresholds of the search for positives, as shares of the product of the anchor's norm and the mean norm.
SHARES = (0.45, 0.25, 0.1)
#: First thresholds of the search for negatives, as percentages of the least positive score.
PERCENTS = (85, 70)
PACKED = "block int, dims int, row binary, id binary, label binary, v binary"
HITS = "anchor long, w int, score long, row long, id long"


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row, id, label, v array<long>): floor(scale * x) of every component, without the rows that take no part."""
    small_batches(embeddings.sparkSession)
    e = pick(embeddings, "vec_id", "embedding", "label").where("label is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < 2.0**27))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    e = e.where(finite).select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    e = e.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).where(F.col("norm") <= 2.0**27)
    return written(e.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), np.int64)


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    """One row for the rows of one block that have the same number of components."""
    raw = [pa.array([rows.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("row", "id", "label")]
    v = pa.array([_numbers(rows.column("v")).tobytes()], pa.binary())
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), *raw, v], names=[c.split()[0] for c in PACKED.split(", ")])


def _pack_anchors(key: tuple, rows: pa.Table) -> pa.Table:
    packed = _pack(key, rows)
    ends = [pa.array([_numbers(rows.column(c)).tobytes()], pa.binary()) for c in ("lows", "highs")]
    least = pa.array([rows.column("least").to_numpy().astype(np.int64).tobytes()], pa.binary())
    names = ["chunk", *(f"a_{c}" for c in packed.column_names[1:]), "least", "lows", "highs"]
    return pa.table([*packed.columns, least, *ends], names=names)


def packed_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows as packed blocks, and the number of blocks."""
    total = rows.agg(F.sum(F.size("v"))).first()[0] or 0
    blocks = max(1, -(-total // NUMBERS))
    keyed = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.size("v").alias("dims"), "row", "id", "label", "v")
    return written(keyed.groupBy("block", "dims").applyInArrow(_pack, PACKED), "blocks"), blocks


class Index:
    """Posting lists of a block's rows for anchors with thresholds of at least ``ratio`` times their norm."""

    def __init__(self, x: np.ndarray, ratio: float):
        self.order = np.argsort(np.square(x, dtype=np.float64).sum(axis=0), kind="stable")
        self.starts = np.r_[np.arange(x.shape[1] % STEP, x.shape[1], STEP), x.shape[1]] if x.shape[1] else np.zeros(1, int)
        if self.starts[0]:
            self.starts = np.r_[0, self.starts]
        floats = x[:, self.order].astype(np.float64)
        norms = np.zeros((len(x), len(self.starts)))
        for k in range(1, len(self.starts)):
            part = floats[:, self.starts[k - 1] : self.starts[k]]
            norms[:, k] = norms[:, k - 1] + np.einsum("ij,ij->i", part, part)
        norms = np.sqrt(norms)
        first = (norms[:, 1:] < ratio * (1 - 1e-9)).sum(axis=1)  # groups that stay out of the index
        self.rows = np.argsort(first, kind="stable")
        self.lists = np.searchsorted(first[self.rows], np.arange(len(self.starts) - 1), "right")
        self.x, self.norms, self.whole = floats[self.rows], norms[self.rows], x

    def search(self, q: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a score of at least ``least``, and the scores."""
        if least <= NO_LIMIT or not len(self.lists):
            at = np.arange(len(self.whole))
        else:
            p = q[self.order].astype(np.float64)
            remaining = np.sqrt(np.r_[0, np.cumsum(p * p)][self.starts])
            slack = 1e-9 * (remaining[-1] * self.norms[:, -1].max(initial=0) + 1)
            alive = np.arange(self.lists[-1])
            score = np.zeros(len(self.x))
            for k in range(len(self.lists) - 1, -1, -1):
                lo, hi = self.starts[k], self.starts[k + 1]
                n = np.searchsorted(alive, self.lists[k])
                here = alive[:n]
                score[here] += (self.x[:n, lo:hi] if n == self.lists[k] else self.x[here, lo:hi]) @ p[lo:hi]
                here = here[score[here] + remaining[k] * self.norms[here, k] >= least - slack]
                alive = np.concatenate([here, alive[n:]])
            at = self.rows[alive]
        exact = self.whole[at] @ q
        keep = exact >= least
        return at[keep], exact[keep]


def _first(at: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` by score, then id (positions in ``at``)."""
    if len(at) > 4 * n:
        some = np.flatnonzero(score >= np.partition(score, len(score) - n)[len(score) - n])
        return some[np.lexsort((ids[at[some]], -score[some]))[:n]]
    return np.lexsort((ids[at], -score))[:n]


def _search(same: bool, wanted: int):
    def of_pair(r: dict) -> Iterator[tuple]:
        long = lambda c: np.frombuffer(r[c], np.int64)
        row, ids, label, names, labels, least = (long(c) for c in ("row", "id", "label", "a_row", "a_label", "least"))
        dims = min(r["dims"], r["a_dims"])
        x, q = long("v").reshape(len(row), r["dims"])[:, :dims], long("a_v").reshape(len(names), r["a_dims"])[:, :dims]
        lows, highs = (long(c).reshape(len(names), -1 if r[c] else 0) for c in ("lows", "highs"))
        norms = np.sqrt(np.square(q, dtype=np.float64).sum(axis=1))
        for one in np.unique(labels):
            asked = np.flatnonzero(labels == one)
            mine = np.flatnonzero((label == one) == same)
            if not len(mine):
                continue
            index = Index(x[mine], max(0.0, float((least[asked] / np.maximum(norms[asked], 1e-300)).min())))
            for i in asked:
                at, score = index.search(q[i], int(least[i]))
                at = mine[at]
                if same:
                    other = row[at] != names[i]
                    at, score = at[other], score[other]
                    picks = [(0, _first(at, score, ids, wanted))]
                else:
                    inside = [np.flatnonzero((score >= a) & (score <= b)) for a, b in zip(lows[i], highs[i], strict=True)]
                    picks = [(w, k[_first(at[k], score[k], ids, wanted)]) for w, k in enumerate(inside)]
                for w, k in picks:
                    if len(k):
                        yield np.full(len(k), names[i]), np.full(len(k), w, np.int32), score[k], row[at[k]], ids[at[k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                found = list(of_pair(b.slice(k, 1).to_pylist()[0]))
                if found:
                    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "w", "score", "row", "id"])

    return run


def threshold_join(blocks: DataFrame, count: int, anchors: DataFrame, same: bool, wanted: int) -> DataFrame:
    """The first ``wanted`` rows of each anchor and window that score at least the anchor's ``least``.

    ``anchors``: (row, id, label, v, least, lows, highs). Result: HITS and ``place`` from 1.
    """
    width = shuffle_width(blocks.sparkSession)
    total = anchors.agg(F.sum(F.size("v"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-total // ANCHOR_NUMBERS)))).cast("int").alias("chunk")
    keyed = anchors.select(chunk, F.size("v").alias("dims"), "row", "id", "label", "v", "least", "lows", "highs")
    schema = "chunk int, " + ", ".join(f"a_{c}" for c in PACKED.split(", ")[1:]) + ", least binary, lows binary, highs binary"
    chunks = keyed.groupBy("chunk", "dims").applyInArrow(_pack_anchors, schema)
    asked = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).repartition(width, "block")
    met = blocks.repartition(width, "block").join(asked, "block").drop("chunk", "block", "a_id")
    hits = met.mapInArrow(lean(_search(same, wanted)), HITS)
    place = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id", "row"))
    return hits.withColumn("place", place).where(F.col("place") <= wanted)


def _positives(rows: DataFrame, blocks: DataFrame, count: int, anchors: DataFrame, wanted: int) -> DataFrame:
    mean = rows.agg(F.avg("norm")).first()[0] or 0.0
    none = F.array().cast("array<long>")
    left, found = anchors, None
    for share in (*SHARES, None):
        least = F.lit(NO_LIMIT) if share is None else F.ceil(F.col("norm") * (share * mean)).cast("long")
        asked = left.withColumns({"least": least, "lows": none, "highs": none})
        hits = written(threshold_join(blocks, count, asked, True, wanted), "positives")
        full = hits.where(F.col("place") == wanted).select(F.col("anchor").alias("row")) if share is not None else left.select("row")
        final = hits.join(full, hits["anchor"] == full["row"], "left_semi")
        found = final if found is None else found.unionByName(final)
        left = written(left.join(full, "row", "left_anti"), "anchors")
        if left.isEmpty():
            break
    return written(found.select("anchor", (F.col("place") - 1).alias("w"), F.col("score").alias("positive_score"), F.col("id").alias("positive")), "positives")


def _negatives(blocks: DataFrame, count: int, anchors: DataFrame, positives: DataFrame, wanted: int, low: int, high: int) -> DataFrame:
    floor_of = lambda x: f"(({x}) - pmod({x}, 100)) div 100"
    ends = positives.withColumns({"lo": F.expr(f"-({floor_of(f'-positive_score * {low}')})"), "hi": F.expr(floor_of(f"positive_score * {high}"))})
    # an empty window asks for nothing; anchors with none but such windows are settled
    ends = ends.withColumns({"lo": F.when(F.col("lo") <= F.col("hi"), F.col("lo")).otherwise(1), "hi": F.when(F.col("lo") <= F.col("hi"), F.col("hi")).otherwise(0)})
    per = ends.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("w", "lo", "hi", "positive_score"))).alias("p"))
    asks = F.filter("p", lambda p: p["lo"] <= p["hi"])
    per = per.select("row", "p", F.size("p").alias("windows"), F.array_min(F.transform(asks, lambda p: p["lo"])).alias("bottom"), F.array_min(F.transform(asks, lambda p: p["positive_score"])).alias("lowest"))
    most = per.agg(F.max("windows")).first()[0]  # every anchor of a chunk has as many windows
    fill = lambda c, v: F.concat(F.transform("p", lambda p: p[c]), F.array_repeat(F.lit(v).cast("long"), F.lit(most) - F.col("windows")))
    left = anchors.join(per.where("bottom is not null"), "row").withColumns({"lows": fill("lo", 1), "highs": fill("hi", 0)})
    left = written(left.drop("p", "windows"), "windows")
    found = None
    for percent in (*PERCENTS, None):
        least = F.col("bottom") if percent is None else F.greatest("bottom", F.floor(F.col("lowest") * F.lit(percent / 100)).cast("long"))
        asked = left.withColumn("least", least)
        hits = written(threshold_join(blocks, count, asked, False, wanted), "negatives")
        # a window is settled if it is full, empty, or lies above the threshold as a whole
        full = hits.where(F.col("place") == wanted).groupBy(F.col("anchor").alias("row")).agg(F.collect_set("w").alias("full"))
        asked = asked.join(full, "row", "left").withColumn("full", F.coalesce("full", F.array().cast("array<int>")))
        open_ = F.exists(F.sequence(F.lit(0), F.lit(most - 1)), lambda w: (F.get("lows", w) <= F.get("highs", w)) & (F.get("lows", w) < F.col("least")) & ~F.array_contains("full", w))
        left = written(asked.where(open_).drop("full", "least"), "windows")
        final = hits.join(left.select(F.col("row").alias("anchor")), "anchor", "left_anti")
        found = final if found is None else found.unionByName(final)
        if left.isEmpty():
            break
    return found.select("anchor", "w", F.col("place").alias("rank"), F.col("id").alias("negative"), F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``whole_vectors`` rows.

    Negatives of a positive score from ``low`` to ``high`` per cent of the positive's score.
    """
    blocks, count = packed_blocks(rows)
    anchors = written(rows.where(is_anchor & (F.col("id") != NULL_ID)), "anchors")
    first = _positives(rows, blocks, count, anchors, positives)
    if first.isEmpty():
        found = first.select("anchor", "w", F.lit(0).alias("rank"), F.col("positive").alias("negative"), F.col("positive_score").alias("negative_score")).limit(0)
    else:
        found = _negatives(blocks, count, anchors, first, negatives, low, high)
    named = found.join(first, ["anchor", "w"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", public_id("positive").alias("positive_id"), "rank", public_id("negative").alias("negative_id"), "positive_score", "negative_score")
