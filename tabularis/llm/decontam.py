"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

A document is contaminated by an item if some window as long as the item (in words, cut at the
text's ends) has a weighted five-word-shingle similarity of 0.8 or more with it: the sum of the smaller
multiplicities over the sum of the larger ones. An item of fewer than five words must stand in full.

1. Windows that share no shingle with any item have similarity 0, so windows of every item's length are fingerprinted only
   where they hold a shingle of the benchmark (a lookup that loses nothing), with a 256-bit SimHash of their weighted shingles.
2. The items' fingerprints stand in a table keyed by length, block and block value: of ``BLOCKS`` blocks of 8 bits, a value
   leads to the items that lie within ``NEAR`` bits of it there. A window looks its blocks up. A fingerprint within ``RADIUS``
   bits has at least ``AGREE`` such blocks, as each other block takes NEAR + 1 bits of the radius, so that no pair within the radius
   is left out; a chance pair has as many in one case of 300. Pairs at similarity 0.8 differ by 39 +- 6 bits, so that the radius of
   64 leaves out one in 20,000.
3. Candidates are verified on the exact multisets.

A text is worked through in runs of ``RUN`` windows, whatever its length and the item's.

The items reach the tasks by broadcast, in blocks of at most ``BLOCK_BYTES`` of text; a larger benchmark
takes several passes over the documents.

Cases: null and empty texts are clean; null and empty items match nothing; repeated items are all named; rows that repeat a
doc_id, or have none, are judged row by row; columns of other names, also such as differ in case only, change nothing;
an empty benchmark leaves every document clean, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularis.llm.common import byte_slices, doc_texts, lean, pick, public_id, small_batches
from tabularis.llm.words import Words, mixed

SHINGLE = 5
BITS, BLOCKS, RADIUS, NEAR = 256, 32, 64, 2
#: Blocks within NEAR bits that a pair within RADIUS has at least.
AGREE = -(-((NEAR + 1) * BLOCKS - RADIUS) // (NEAR + 1))
SIMILAR = 0.8
BLOCK_BYTES = 4 << 20
RUN = 2048
FILTER_BITS = 20
LANES = np.array([0x9E3779B97F4A7C15 * (k + 1) % 2**64 for k in range(BITS // 64)], np.uint64)
POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 8)], np.uint8)


def signs(grams: np.ndarray) -> np.ndarray:
    """BITS signs (+1, -1) of each shingle hash."""
    lanes = mixed(grams[:, None] ^ LANES[None, :])
    return np.unpackbits(lanes.view(np.uint8).reshape(len(grams), BITS // 8), axis=1).view(np.int8) * np.int8(2) - np.int8(1)


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as BLOCKS 8-bit blocks."""
    return np.packbits(sums > 0, axis=1)


def sum_of(grams: np.ndarray) -> np.ndarray:
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(grams), RUN):
        total += signs(grams[k : k + RUN]).sum(axis=0, dtype=np.int64)
    return total


def window_prints(grams: np.ndarray, start: int, count: int, size: int) -> np.ndarray:
    """Fingerprints of ``count`` windows of ``size`` shingles from ``start`` on (cut at both ends of the text)."""
    sums = np.empty((count, BITS), np.int64)
    sums[0] = sum_of(grams[max(start, 0) : max(start + size, 0)])
    moved = np.zeros((count - 1, BITS), np.int64)
    for first, way in ((start + size, 1), (start, -1)):  # the shingles that come in, and those that fall out
        lo, hi = max(first, 0), min(first + count - 1, len(grams))
        if lo < hi:
            moved[lo - first : hi - first] += way * signs(grams[lo:hi])
    sums[1:] = sums[0] + np.cumsum(moved, axis=0)
    return packed(sums)


class Table:
    """Fingerprints of items, looked up by the values of their blocks."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = np.arange(256, dtype=np.uint8)
        self.near = (POPCOUNT[values[None, :, None] ^ prints.T[:, None, :]] <= NEAR).astype(np.uint8)  # block × value × item

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item) of all pairs that differ in RADIUS bits at most."""
        agree = np.zeros((len(prints), len(self.prints)), np.uint8)
        for b in range(BLOCKS):
            agree += self.near[b, prints[:, b]]
        one, two = np.nonzero(agree >= AGREE)
        close = POPCOUNT[prints[one] ^ self.prints[two]].sum(axis=1, dtype=np.int64) <= RADIUS
        return one[close], two[close]


@dataclass
class Item:
    item_id: int
    length: int  # in words
    grams: np.ndarray  # distinct shingles, sorted
    counts: np.ndarray
    fingerprint: np.ndarray


class Index:
    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[Item] = []
        self.short: dict[int, list[tuple[np.uint64, int]]] = {}
        grams = []
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words = Words(raw, np.array([0, len(raw)]))
            n = len(words.hash)
            if n >= SHINGLE:
                own = words.windows(SHINGLE)
                distinct, counts = np.unique(own, return_counts=True)
                grams.append(distinct)
                self.items.append(Item(item_id, n, distinct, counts, packed(sum_of(own)[None])[0]))
            elif n:
                self.short.setdefault(n, []).append((words.sequences(n)[0], item_id))
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - FILTER_BITS)] = True
        sizes: dict[int, list[Item]] = {}
        for item in self.items:
            sizes.setdefault(item.length - SHINGLE + 1, []).append(item)
        self.sizes = {size: (own, Table(np.stack([i.fingerprint for i in own]))) for size, own in sizes.items()}

    def hits(self, windows: np.ndarray) -> np.ndarray:
        """Positions of shingles that stand in an item."""
        at = np.flatnonzero(self.seen[windows >> np.uint64(64 - FILTER_BITS)])
        k = np.searchsorted(self.grams, windows[at])
        return at[(k < len(self.grams)) & (self.grams[np.minimum(k, len(self.grams) - 1)] == windows[at])] if len(self.grams) else at[:0]

    def near_windows(self, grams: np.ndarray, at: np.ndarray) -> Iterator[tuple[Item, int, int]]:
        """(item, first shingle, end) of all windows around the hits ``at`` whose fingerprints lie within the radius."""
        for size, (items, table) in self.sizes.items():
            # runs of window starts that cover a hit
            first = at - size + 1
            cut = np.flatnonzero(np.r_[True, first[1:] > at[:-1] + 1])
            for lo, hi in zip(first[cut], at[np.r_[cut[1:], len(at)] - 1] + 1, strict=True):
                for start in range(int(lo), int(hi), RUN):
                    count = min(RUN, int(hi) - start)
                    one, two = table.within(window_prints(grams, start, count, size))
                    for w, i in zip(one.tolist(), two.tolist(), strict=True):
                        yield items[i], max(start + w, 0), min(start + w + size, len(grams))

    def match(self, grams: np.ndarray, at: np.ndarray) -> dict[int, tuple[float, int, Item]]:
        """Best similarity, first word and item, by the item's place, of a text with the shingles ``grams``."""
        best: dict[int, tuple[float, int, Item]] = {}
        for item, a, b in self.near_windows(grams, at):
            own, counts = np.unique(grams[a:b], return_counts=True)
            k = np.searchsorted(item.grams, own)
            same = (k < len(item.grams)) & (item.grams[np.minimum(k, len(item.grams) - 1)] == own)
            both = np.minimum(counts[same], item.counts[k[same]]).sum()
            likeness = float(both / (counts.sum() + item.counts.sum() - both))
            if likeness >= SIMILAR and (id(item) not in best or (-likeness, a) < (-best[id(item)][0], best[id(item)][1])):
                best[id(item)] = (likeness, a, item)
        return best

    def matches(self, data: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """For each text its (item_id, first word, words, similarity), by item."""
        out: list[list] = [[] for _ in range(len(offs) - 1)]
        words = Words(data, offs)
        windows = words.windows(SHINGLE)
        at = self.hits(windows) if len(windows) else np.zeros(0, np.int64)
        at = at[words.doc[at] == words.doc[at + SHINGLE - 1]]
        for i in np.unique(words.doc[at]):
            lo, hi = words.at[i], words.at[i + 1]
            mine = at[np.searchsorted(at, lo) : np.searchsorted(at, hi)] - lo
            for likeness, word, item in self.match(windows[lo : hi - SHINGLE + 1], mine).values():
                out[i].append((item.item_id, word, min(item.length, int(hi - lo) - word), likeness))
        for n, wanted in self.short.items():
            if len(words.hash) < n:
                continue
            have = words.sequences(n)
            have_doc = words.doc[: len(have)]
            whole = have_doc == words.doc[n - 1 :]
            for code, item_id in wanted:
                at = np.flatnonzero(whole & (have == code))
                for i, k in zip(*np.unique(have_doc[at], return_index=True), strict=True):
                    out[i].append((item_id, int(at[k] - words.at[i]), n, 1.0))
        return [sorted(m) for m in out]


MATCHES = T.ArrayType(
    T.StructType([T.StructField("item_id", T.LongType()), T.StructField("word", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("similarity", T.DoubleType())])
)
_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int32()), ("words", pa.int32()), ("similarity", pa.float64())]))
_INDEXES: dict = {}


def _with_matches(rows: DataFrame, items: list[tuple[int, str]], key: str) -> DataFrame:
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((key, items))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "matches"] + [T.StructField("matches", MATCHES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, own = shared.value
        if name not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[name] = Index(own)
        for b in batches:
            found = [m for _, _, data, offs in byte_slices(b.column("text").fill_null("")) for m in _INDEXES[name].matches(data, offs)]
            names = [n for n in b.schema.names if n != "matches"]
            if "matches" in b.schema.names:
                found = [sorted([tuple(x.values()) for x in had.as_py()] + m) for had, m in zip(b.column("matches"), found, strict=True)]
            cells = pa.array([[dict(zip(("item_id", "word", "words", "similarity"), x, strict=True)) for x in m] for m in found], _MATCH)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), cells], names=[*names, "matches"])

    return rows.mapInArrow(lean(run), schema)


def with_matches(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``rows`` (with a ``text`` column) and their ``matches``: item, first word, words, similarity."""
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().collect()
        own = sorted((r["item_id"], r["text"]) for r in own)
        rows = _with_matches(rows, own, hashlib.sha256(repr(own).encode()).hexdigest())
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, similarity, matches) of every row, whole texts."""
    found = with_matches(doc_texts(docs), benchmark)
    return found.select(
        public_id().alias("doc_id"),
        (F.size("matches") > 0).alias("contaminated"),
        F.size("matches").cast("long").alias("n_items"),
        F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["similarity"])), F.lit(0.0)).alias("similarity"),
        "matches",
    )
