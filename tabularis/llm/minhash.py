"""MinHash near-dedup with min-max hashing.

Documents are sets of distinct five-word shingles (a text with fewer words: its whole sequence). Two
documents are linked if 100 * |intersection| >= percent * |union|; the classes are the connected components.

1. Signatures. Each of ``HASHES`` hash functions gives two signature values, the minimum and the
   maximum over the set, so ``2 * HASHES`` values cost half the hash evaluations. In bands of six values
   a pair at 85 per cent misses all bands with probability (1 - 0.85**6)**32 = 3e-7; for 80 per cent
   take bands of five, (1 - 0.8**5)**38 = 3e-7.
2. Equal sets (by a 128-bit digest) collapse to their smallest document before anything is compared, so
   exact copies cost one row each. Rows get their class by digest and one of ``SALTS`` salts, so that a set that most rows
   share is spread over many tasks; rows without a shingle take part in no join.
3. Band keys held by two or more sets give star edges to the key's smallest set (never pairs within a
   key); their connected components are the candidate classes. Every linked pair shares a key, so no
   link crosses two candidate classes.
4. The full sets of candidate members are compared inside their candidate class. A class is cut into blocks of
   at most ``BLOCK`` shingles, and a class of several blocks is compared block pair by block pair.
   A task indexes the shingles of its block pair, then verifies sets against all others through that index;
   sets that already belong to the main class need no comparison with each other, so a class of near
   copies costs about one pass. It returns a spanning forest of verified links, not pairs.
5. Components of the verified links, and the classes of all copies.

Cases: null, empty and wordless texts have no shingles and are linked with nothing; rows that repeat a
doc_id count as that document, with the union of the rows' links (``without_near_copies`` decides row by row
instead); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import NULL_ID, byte_slices, doc_texts, lean, public_id, written
from tabularis.llm.components import components
from tabularis.llm.words import Words, mixed, shingles

SHINGLE = 5
HASHES = 96
BLOCK = 1 << 20  # shingles
SALTS = 32
_rng = np.random.default_rng(42)
FLIP = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
FACTOR = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
BAND_CODE = _rng.integers(1, 2**63, 2 * HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(grams: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each hash function, 2 * HASHES values."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(HASHES, 2**32 - 1, np.uint32), np.zeros(HASHES, np.uint32)
    for k in range(0, len(x), 4096):
        y = (x[None, k : k + 4096] ^ FLIP[:, None]) * FACTOR[:, None]
        low, high = np.minimum(low, y.min(axis=1)), np.maximum(high, y.max(axis=1))
    return np.stack([low, high], axis=1).ravel()


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band of ``rows`` signature values."""
    n = len(sig) // rows * rows
    code = BAND_CODE[:n].reshape(-1, rows)
    return mixed((sig[:n].astype(np.uint64).reshape(-1, rows) * code).sum(axis=1, dtype=np.uint64) + code[:, 0]).view(np.int64)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi, data, offs in byte_slices(column):
        words = Words(data, offs)
        windows = words.windows(SHINGLE)
        for i in range(hi - lo):
            s = np.sort(shingles(words, windows, i, SHINGLE))
            yield s[np.r_[True, s[1:] != s[:-1]]] if len(s) else s


def _signature_rows(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, first, second, keys = [], [], [], []
            for grams in _sets(b.column("text")):
                sizes.append(len(grams))
                a, c = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), "<i8") if len(grams) else (None, None)
                first.append(a)
                second.append(c)
                keys.append(band_keys(signature(grams), rows) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("t"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "t", "n", "d1", "d2", "keys"],
            )

    return run


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of candidate members; of rows that share an id and a text's hash only those with the member's digest, once a batch."""
    for b in batches:
        sets, seen = [s.tobytes() for s in _sets(b.column("text"))], set()
        same = []
        for s, n in zip(sets, b.column("node").to_pylist(), strict=True):
            same.append(s != b"" and n not in seen and np.frombuffer(xxhash.xxh3_128_digest(s), "<i8")[0] == n)
            if same[-1]:
                seen.add(n)
        same = pa.array(same, pa.bool_())
        keep = [n for n in b.schema.names if n not in ("id", "t", "text")]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(sets, pa.binary())], names=[*keep, "grams"]).filter(same)


def linked_forest(ids: np.ndarray, sets: list[np.ndarray], num: int, den: int = 100) -> list[tuple[int, int]]:
    """Links (verified on the full sets) that connect whatever links of these sets connect."""
    m = len(ids)
    size = np.array([len(s) for s in sets])
    grams, member = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(grams, kind="stable")
    grams, member = grams[order], member[order]
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    ends = np.r_[starts[1:], len(grams)]
    code = np.empty(len(grams), np.int64)
    code[order] = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.r_[0, np.cumsum(size)]
    held = (ends - starts)[code]
    central = np.add.reduceat(held, at[:-1]) / size
    parent = list(range(m))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, main = [], -1
    for p in np.argsort(-central, kind="stable"):
        if main >= 0 and root(p) == root(main):
            continue  # whatever it links to outside the main class finds it from there
        c = code[at[p] : at[p + 1]]
        c = c[(ends - starts)[c] > 1]
        if len(c):
            n = ends[c] - starts[c]
            hits = member[np.repeat(starts[c] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
            both = np.bincount(hits, minlength=m)
            for q in np.flatnonzero((both > 0) & (den * both >= num * (size + size[p] - both))):
                a, b = root(int(p)), root(int(q))
                if a != b:
                    parent[a] = b
                    out.append((int(ids[p]), int(ids[q])))
        if main < 0:
            main = int(p)
    return out


def _verify(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        nodes, at = np.unique(rows.column("node").to_numpy(), return_index=True)
        grams = rows.column("grams").combine_chunks()
        links = linked_forest(nodes, [np.frombuffer(grams[int(i)].as_buffer(), np.uint64) for i in at], percent) if len(nodes) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def salt() -> Column:
    """Rows of one set are spread over SALTS tasks; a set knows the salts that its rows have."""
    return F.pmod(F.xxhash64("id", "t"), F.lit(SALTS)).alias("salt")


def _linked(docs: DataFrame, percent: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, distinct sets with their smallest row (id, t), and verified links between sets.

    ``t`` is ``xxhash64(text)``. A node of the link graph is a set, named by 64 bits of its digest.
    """
    texts = doc_texts(docs).select("id", F.xxhash64("text").alias("t"), "text")
    sig = written(texts.mapInArrow(lean(_signature_rows(rows)), "id long, t long, n long, d1 long, d2 long, keys array<long>"), "signatures")
    least, salts = F.min(F.struct("id", "t", "n", "keys")).alias("s"), F.collect_set(salt()).alias("salts")
    sets = sig.where("n > 0").groupBy(F.col("d1").alias("node"), "d2").agg(least, salts)
    sets = written(sets.select("node", "s.*", "salts"), "sets")
    held = sets.select("node", F.explode("keys").alias("key"))
    low = held.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("m")).where("m > 1").select("key", "low")
    stars = held.join(low, "key").where("node <> low").groupBy("node").agg(F.min("low").alias("b"), F.collect_set("low").alias("lows"))
    # a set ties the centres of its bands together: one edge to the smallest centre for it and for each of the
    # others, which are few once repeats are dropped (the set of lows has at most one entry a band)
    stars = stars.select(F.explode(F.array_union(F.array("node"), "lows")).alias("a"), "b").where("a <> b").distinct()
    classes = components(stars)
    members = sets.join(classes, "node").select("node", "id", "t", F.col("root").alias("class"), "n")
    blocks = members.groupBy("class").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    members = members.join(blocks, "class").select("node", "id", "t", "class", "blocks", F.pmod(F.xxhash64("node", "id"), "blocks").alias("block"))
    grams = texts.join(members, ["id", "t"]).mapInArrow(lean(_set_rows), "node long, class long, blocks long, block long, grams binary")
    tasks = grams.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select("node", "grams", "class", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    return sig, sets, tasks.groupBy("class", "one", "two").applyInArrow(_verify(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = 6) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row, whole texts.

    ``rows`` signature values make a band, see above for what a percentage needs.
    """
    sig, sets, links = _linked(docs, percent, rows)
    # different texts under one doc_id are one document: their sets are tied
    ids = sig.where("n > 0").groupBy("id").agg(F.min("d1").alias("b"), F.max("d1").alias("top")).where("b <> top")
    ties = sig.where("n > 0").join(ids, "id").where("d1 <> b").select(F.col("d1").alias("a"), "b")
    found = components(links.unionByName(ties))
    named = found.join(sets, "node").groupBy("root").agg(F.min("id").alias("component"))
    named = found.join(named, "root").select(F.col("node").alias("d1"), "component")
    # a set's own smallest id, or its class's; both sides have one row for each set
    firsts = sets.select(F.col("node").alias("d1"), F.col("id").alias("first"), "salts").join(named, "d1", "left")
    firsts = firsts.select("d1", F.explode("salts").alias("salt"), F.coalesce("component", "first").alias("component"))
    out = sig.where("n > 0").select("id", "n", "d1", salt()).join(firsts, ["d1", "salt"]).select("id", "n", "component")
    out = out.unionByName(sig.where("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(
        public_id().alias("doc_id"), F.col("n").alias("n_shingles"), public_id("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )


def without_near_copies(docs: DataFrame, percent: int = 85, rows: int = 6) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of every class of near copies, the one with the smallest doc_id.

    Decided row by row: rows that share an id, or have none, are not tied. A row is known by its id and its text's hash
    ``t``; of rows that agree in both one stays, too. Rows without a shingle all stay.
    """
    sig, sets, links = _linked(docs, percent, rows)
    found = components(links)
    first = F.struct("id", "t")
    named = found.join(sets, "node").groupBy("root").agg(F.min(first).alias("best"))
    named = found.join(named, "root").select("node", "best")
    best = sets.select("node", first.alias("own"), "salts").join(named, "node", "left")
    best = best.select(F.col("node").alias("d1"), F.explode("salts").alias("salt"), F.coalesce("best", "own").alias("best"))
    one = sig.where("n > 0").groupBy("id", "t", "d1").agg(F.count("*").alias("m")).withColumn("salt", salt()).join(best, ["d1", "salt"])
    # what does not stay as it is: rows of another row's class (m = 0), and rows that stand m times
    stays = F.col("best") == first
    marks = one.where(~stays | (F.col("m") > 1)).select(F.col("id").alias("_id"), F.col("t").alias("_t"), F.when(stays, F.col("m")).otherwise(0).alias("_m"))
    marks = written(marks, "near-marks")
    d = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn("_t", F.xxhash64(F.coalesce("text", F.lit(""))))
    single = d.join(marks, ["_id", "_t"], "left_anti").select(*docs.columns)
    repeated = d.join(marks.where("_m > 1").select("_id", "_t"), ["_id", "_t"], "left_semi")
    repeated = repeated.groupBy("_id", "_t").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return single.unionByName(repeated)
