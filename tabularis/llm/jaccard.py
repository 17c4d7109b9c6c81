"""Jaccard join of word n-gram sets, size-aware: subsets of small sets, inverted lists of large sets.

Documents are sets of distinct three-word shingles (a text with fewer words: its whole sequence). Two documents are
linked if 100 * |intersection| >= percent * |union|; the classes are the connected components.

1. Equal sets (by a 128-bit digest) collapse to one, so exact copies cost one row.
2. Boundary. For every size up to ``MOST_SMALL`` the number of sets of that size is known. The boundary between small and
   large is the size with the least cost: the subsets that the small sets would enumerate, and the keys and list
   entries of the large ones (and of those small ones that a large one may link to).
3. Small sets. Sets of a and b >= a shingles are linked if and only if they share a subset of o shingles, the least
   overlap that this pair of sizes needs. So every small set enumerates its subsets of just that size for each
   size it may link to; equal subsets are links, without any verification.
4. Large sets. Shingles are dealt by hash into one part more (and ``SPARE`` more) than two linked sets of such sizes can differ
   in shingles, so that linked sets agree on a part; agreeing sets form candidate classes. No link is lost, and
   none crosses two classes. Inside a class the shingles' inverted lists are built, and every set scans the lists of its
   shingles and counts its overlap with each other set; sets that already belong to the main
   component need no scan. A class of more than ``BLOCK`` shingles is cut into blocks: scans within the blocks first, then of
   the class's most central set against all, and only sets that are still apart from it meet the other blocks.
5. Rows with equal keys are never paired: they are sorted by range and streamed, each tied to the first of its key, and a
   key that spans ranges is tied together by one mark a range. Components of links give the classes.

Cases: null, empty and wordless texts have no shingles and are linked with nothing. Rows are told apart, not documents: rows
that share a ``doc_id``, or have none, are linked by their texts only; a class's id is its smallest doc_id (null
where it has none). A text of any length is one set. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import byte_slices, doc_texts, lean, public_id, shuffle_width, written
from tabularis.llm.components import components
from tabularis.llm.words import Words, mixed, shingles

SHINGLE = 3
#: Largest size that may count as small; sizes up to here are counted for the choice of the boundary.
MOST_SMALL = 40
#: Parts that linked sets agree on besides the one: a set with no more empty parts than this leaves those out.
SPARE = 2
BLOCK = 1 << 19  # shingles
#: Tasks that the copies of one set are spread over.
SALTS = 32
SALT_A, SALT_B = np.uint64(0x632BE59BD9B4E019), np.uint64(0x8CB92BA72F3D8DD7)


def overlap(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def partners(size: int, percent: int) -> range:
    """Sizes that a set of this size may be linked to."""
    return range(-(-percent * size // 100), 100 * size // percent + 1)


def subset_count(size: int, percent: int) -> int:
    return sum(math.comb(size, o) for b in partners(size, percent) if (o := overlap(size, b, percent)) < max(size, b))


@functools.cache
def _levels(percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First size and number of parts of each level of sizes; linked sets are of one level or of neighbouring ones."""
    first, parts = [1], []
    while first[-1] <= most:
        last = 100 * first[-1] // percent
        differ = (last + 100 * last // percent) * (100 - percent) // (100 + percent)
        parts.append(differ + 1 + SPARE)
        first.append(last + 1)
    return np.array(first[:-1]), np.array(parts)


def levels(percent: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _levels(percent, 1 << max(10, int(size).bit_length()))


def part_keys(grams: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, level and part) of the parts of a sorted set, for its own level and the one below."""
    first, parts = levels(percent, len(grams))
    own = int(np.searchsorted(first, len(grams), "right")) - 1
    code = mixed(grams ^ SALT_A)
    out = []
    for level in (own - 1, own):
        if level < 0:
            continue
        n = int(parts[level])
        at = ((grams >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)  # ascending, as the grams are
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        held = at[starts]
        out.append((np.add.reduceat(code, starts), level * (1 << 32) + held))
        if n - len(held) > SPARE:
            empty = np.setdiff1d(np.arange(n), held)
            out.append((np.zeros(len(empty), np.uint64), level * (1 << 32) + empty))
    hashes, names = (np.concatenate(x) for x in zip(*out, strict=True))
    return mixed(hashes + names.astype(np.uint64) * SALT_B), names


@functools.cache
def _left_out(size: int, n: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(size), n)), np.int64).reshape(math.comb(size, n), n)


def subset_keys(grams: np.ndarray, percent: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(key, key, side) of the subsets that a small set enumerates; side 1 where it is the larger of the two sizes."""
    size = len(grams)
    codes = [mixed(grams ^ SALT_A), mixed(grams ^ SALT_B)]
    for other in partners(size, percent):
        a, b = min(size, other), max(size, other)
        o = overlap(a, b, percent)
        if not 0 < a <= b <= most or o == b:  # sets of one size that need to be equal are one set
            continue
        gone = _left_out(size, size - o)
        pair = np.uint64((a << 8) + b)
        yield *(mixed(c.sum(dtype=np.uint64) - c[gone].sum(axis=1, dtype=np.uint64) + pair) for c in codes), int(size > other)


def _set_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, first, second, small, keys, names = [], [], [], [], [], []
            for grams in _sets(b.column("text")):
                n = len(grams)
                sizes.append(n)
                d = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), "<i8") if n else (None, None)
                first.append(d[0])
                second.append(d[1])
                small.append(grams.tobytes() if 0 < n <= MOST_SMALL else None)
                k, p = part_keys(grams, percent) if n else (None, None)
                keys.append(None if k is None else k.view(np.int64))
                names.append(p)
            longs = pa.list_(pa.int64())
            new = [pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(small, pa.binary()), pa.array(keys, longs), pa.array(names, longs)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("t"), *new], names=["id", "t", "n", "d1", "d2", "small", "keys", "parts"])

    return run


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi, data, offs in byte_slices(column):
        words = Words(data, offs)
        windows = words.windows(SHINGLE)
        for i in range(hi - lo):
            yield np.unique(shingles(words, windows, i, SHINGLE))


# --- equal keys ------------------------------------------------------------------------------------

TIE, OPEN, MARK = 0, 1, 2


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by (k1, k2, side, node): ties (node, first node of side 0 of its key), and what ranges leave open."""
    head, key, first = None, None, None  # the range's first key, the current key, the current key's first node of side 0

    def rows(kind, k1, k2, node, low):
        kinds = np.full(len(node), kind, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, k1, k2, node, low)], names=["kind", "k1", "k2", "node", "low"])

    for b in batches:
        if not b.num_rows:
            continue
        k1, k2, side, node = (b.column(c).to_numpy() for c in ("k1", "k2", "side", "node"))
        starts = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(k1)]))
        has, low = side[starts] == 0, node[starts].copy()
        now = (int(k1[0]), int(k2[0]))
        if key == now and first is not None:
            has[0], low[0] = True, first
        if head is None:
            head = now
        tied = has[run] & (node != low[run])
        if tied.any():
            yield rows(TIE, k1[tied], k2[tied], node[tied], low[run][tied])
        at_head = (k1 == head[0]) & (k2 == head[1])
        lone = at_head & ~has[run]
        if lone.any():
            yield rows(OPEN, k1[lone], k2[lone], node[lone], node[lone])
        if at_head[0] and has[0] and not (key == now and first is not None):
            yield rows(MARK, k1[:1], k2[:1], low[:1], low[:1])
        key, first = (int(k1[-1]), int(k2[-1])), int(low[-1]) if has[-1] else None
    if key is not None and first is not None and key != head:
        one = np.array([first])
        yield rows(MARK, np.array([key[0]]), np.array([key[1]]), one, one)


def tied(keyed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the nodes of equal keys. ``keyed``: (k1, k2, side, node).

    Nodes of side 0 are tied to each other, nodes of side 1 to those of side 0 only.
    """
    ranged = keyed.repartitionByRange(shuffle_width(keyed.sparkSession), "k1", "k2", "side", "node").sortWithinPartitions("k1", "k2", "side", "node")
    found = written(ranged.mapInArrow(lean(_ties), "kind int, k1 long, k2 long, node long, low long"), "ties")
    marks = found.where(F.col("kind") == MARK).groupBy("k1", "k2").agg(F.min("low").alias("mark"))  # two a range at most
    late = found.where(F.col("kind") != TIE).join(F.broadcast(marks), ["k1", "k2"]).where("node <> mark")
    edges = found.where(F.col("kind") == TIE).select("node", "low").unionByName(late.select("node", F.col("mark").alias("low")))
    # one edge a node to its smallest low, which also ties its other lows: few of them are different
    lows = edges.distinct().groupBy("node").agg(F.min("low").alias("b"), F.collect_set("low").alias("lows"))
    return lows.select(F.explode(F.array_union(F.array("node"), "lows")).alias("a"), "b").where("a <> b").distinct()


# --- inverted lists --------------------------------------------------------------------------------


class Lists:
    """Inverted lists of some sets: shingle -> sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        grams, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(grams, kind="stable")
        grams, self.member = grams[order], member[order]
        self.starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        self.ends, self.grams = np.r_[self.starts[1:], len(grams)], grams[self.starts]

    def overlaps(self, s: np.ndarray) -> np.ndarray:
        """Overlap of a set with every set, from a scan of its shingles' lists."""
        at = np.searchsorted(self.grams, s)
        at = at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == s)]
        n = self.ends[at] - self.starts[at]
        if not n.sum():
            return np.zeros(len(self.size), np.int64)
        hits = self.member[np.repeat(self.starts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        return np.bincount(hits, minlength=len(self.size))

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        both = self.overlaps(s)
        return np.flatnonzero((both > 0) & (100 * both >= percent * (self.size + len(s) - both)))

    def central(self) -> np.ndarray:
        """Mean length of the lists of each set's shingles."""
        held = np.bincount(self.member, np.repeat(self.ends - self.starts, self.ends - self.starts), len(self.size))
        return held / np.maximum(self.size, 1)


def _sets_of(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    grams = rows.column("grams").combine_chunks()
    return rows.column("node").to_numpy(), [np.frombuffer(g.as_buffer(), np.uint64) for g in grams]


LINKS = "a long, b long, class long, central double"


def _links(a: list, b: list, classes: list, central: list) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(classes, pa.int64()), pa.array(central, pa.float64())], names=["a", "b", "class", "central"])


def _within(percent: int):
    """Links that connect whatever links within a block connect, and the block's most central set (b null)."""

    def run(rows: pa.Table) -> pa.Table:
        nodes, sets = _sets_of(rows)
        lists = Lists(sets)
        central = lists.central()
        order = np.argsort(-central, kind="stable")
        parent = np.arange(len(nodes))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        top = int(order[0])
        a, b = [int(nodes[top])], [None]
        for p in order:
            if p != top and root(p) == root(top):
                continue  # what it links to outside the main component finds it from there
            for q in lists.linked(sets[p], percent):
                x, y = root(p), root(q)
                if x != y:
                    parent[x] = y
                    a.append(int(nodes[p]))
                    b.append(int(nodes[q]))
        return _links(a, b, [rows.column("class")[top].as_py()] * len(a), [float(central[top])] * len(a))

    return run


def _across(percent: int):
    """Links between the sets that ask and the sets of a block."""

    def run(rows: pa.Table) -> pa.Table:
        nodes, sets = _sets_of(rows)
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        a, b, block = [], [], np.flatnonzero(~asks)
        lists = Lists([sets[i] for i in block]) if len(block) else None
        for p in np.flatnonzero(asks) if len(block) else ():
            near = nodes[block[lists.linked(sets[p], percent)]]
            near = near[near != nodes[p]]
            a += [int(nodes[p])] * len(near)
            b += near.tolist()
        return _links(a, b, [None] * len(a), [None] * len(a))

    return run


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members' sets; of rows that agree in id and text, one a batch."""
    for b in batches:
        keep = [n for n in b.schema.names if n not in ("id", "t", "text")]
        first = np.zeros(b.num_rows, bool)
        first[np.unique(b.column("node").to_numpy(), return_index=True)[1]] = True
        b = b.filter(pa.array(first))
        sets = pa.array([s.tobytes() for s in _sets(b.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), sets], names=[*keep, "grams"])


def _verified(texts: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of the candidate classes (node, root)."""
    members = sets.join(classes, "node").select("node", "id", "t", F.col("root").alias("class"), "n")
    per = members.groupBy("class").agg(F.sum("n").alias("total")).withColumn("blocks", F.ceil(F.col("total") / BLOCK))
    sizes = written(per, "classes")
    tasks = max(1, math.ceil((sizes.where("blocks = 1").agg(F.sum("total")).first()[0] or 0) / BLOCK))
    members = members.join(sizes.drop("total"), "class")
    # classes of one block share tasks, larger ones are cut
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("class"), F.lit(tasks))).otherwise(F.col("class"))
    members = members.withColumns({"task": task, "block": F.pmod(F.xxhash64("node"), "blocks")})
    one = texts.join(members.select("id", "t", "node", "class", "blocks", "task", "block"), ["id", "t"])
    grams = one.mapInArrow(lean(_gram_rows), "node long, class long, blocks long, task long, block long, grams binary")
    grams = written(grams, "grams")
    within = grams.groupBy((F.col("blocks") > 1).alias("cut"), "task", "block").applyInArrow(_once(_within(percent)), LINKS)
    within = written(within, "links")
    links = within.where("b is not null").select("a", "b")
    cut = grams.where("blocks > 1")
    if cut.isEmpty():
        return links
    cut = cut.drop("task")
    centres = within.where("b is null").groupBy("class").agg(F.max_by("a", F.struct("central", "a")).alias("node"))
    centre = cut.join(centres, ["class", "node"]).withColumn("chunk", F.lit(0).cast("long"))
    near = written(_scan(cut, centre, percent), "links").select("a", "b")
    links = links.unionByName(near)
    main = components(links.join(cut.select(F.col("node").alias("a")).distinct(), "a", "left_semi"))
    heads = centres.join(main, "node").select("class", F.col("root").alias("head"))
    roots = cut.select("node", "class", "grams").join(main, "node", "left").join(heads, "class", "left")
    apart = roots.where(F.col("root").isNull() | F.col("head").isNull() | (F.col("root") != F.col("head"))).select("node", "class", "grams")
    chunks = apart.groupBy("class").agg(F.ceil(F.sum(F.length("grams")) / (8 * BLOCK)).alias("chunks"))
    apart = apart.join(chunks, "class").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    apart = written(apart.join(sizes.select("class", "blocks"), "class").select("node", "class", "grams", "blocks", "chunk"), "apart")
    return links if apart.isEmpty() else links.unionByName(written(_scan(cut, apart, percent), "links").select("a", "b"))


def _once(run):
    """``run`` over the first row of every node."""

    def wrapped(rows: pa.Table) -> pa.Table:
        nodes = rows.column("node").to_numpy()
        first = np.sort(np.unique(nodes, return_index=True)[1])
        return run(rows if len(first) == len(nodes) else rows.take(pa.array(first)))

    return wrapped


def _scan(blocks: DataFrame, asking: DataFrame, percent: int) -> DataFrame:
    """Every asking set (node, class, grams, blocks, chunk) against all blocks of its class, chunk by chunk."""
    chunks = asking.groupBy("class").agg(F.collect_set("chunk").alias("all"))
    held = blocks.join(chunks, "class").withColumn("chunk", F.explode("all"))
    asked = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    pick = lambda df, asks: df.select("class", "block", "chunk", "node", "grams", F.lit(asks).alias("asks"))
    return pick(held, False).unionByName(pick(asked, True)).groupBy("class", "block", "chunk").applyInArrow(_across(percent), LINKS)


# --- join ------------------------------------------------------------------------------------------


def boundary(sizes: dict[int, int], rest: int, percent: int) -> int:
    """Largest small size. ``sizes``: sets by size up to MOST_SMALL; ``rest``: the other sets, which are large anyway."""

    def large(size: int) -> int:
        return 2 * (size * (100 - percent) // (100 + percent) * 2 + 1 + SPARE) + size

    def cost(most: int) -> int:
        least = partners(most + 1, percent).start if rest or any(s > most for s in sizes) else MOST_SMALL + 1
        light = sum(n * subset_count(s, percent) for s, n in sizes.items() if s <= most)
        return light + sum(n * large(s) for s, n in sizes.items() if s >= least)

    return min(range(MOST_SMALL + 1), key=lambda most: (cost(most), -most))


def _small_rows(percent: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [(k1, k2, side, node) for node, g in zip(b.column("node").to_pylist(), b.column("small"), strict=True) for k1, k2, side in subset_keys(np.frombuffer(g.as_buffer(), np.uint64), percent, most)]
            if parts:
                n = [len(p[0]) for p in parts]
                columns = [np.concatenate([p[i] for p in parts]).view(np.int64) for i in (0, 1)]
                columns += [np.repeat(np.array([p[2] for p in parts], np.int32), n), np.repeat(np.array([p[3] for p in parts], np.int64), n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "k2", "side", "node"])

    return run


def jaccard_classes(docs: DataFrame, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, whole texts."""
    texts = doc_texts(docs).select("id", F.xxhash64("text").alias("t"), "text")
    schema = "id long, t long, n long, d1 long, d2 long, small binary, keys array<long>, parts array<long>"
    rows = written(texts.mapInArrow(lean(_set_rows(percent)), schema), "rows")
    salt = F.pmod(F.xxhash64("id", "t"), F.lit(SALTS)).alias("salt")
    first = F.min(F.struct("id", "t", "n", "small", "keys", "parts")).alias("s")
    sets = rows.where("n > 0").groupBy("d1", "d2").agg(first, F.collect_set(salt).alias("salts"))
    sets = written(sets.select("d1", "d2", "s.*", "salts", F.monotonically_increasing_id().alias("node")), "sets")
    counts = {r["n"]: r["count"] for r in sets.where(F.col("n") <= MOST_SMALL).groupBy("n").count().collect()}
    most = boundary(counts, sets.where(F.col("n") > MOST_SMALL).limit(1).count(), percent)
    small = sets.where(F.col("n") <= most).select("node", "small").mapInArrow(lean(_small_rows(percent, most)), "k1 long, k2 long, side int, node long")
    large = sets.where(F.col("n") >= partners(most + 1, percent).start)
    large = large.select("node", F.explode(F.arrays_zip("keys", "parts")).alias("p")).select(F.col("p.keys").alias("k1"), F.col("p.parts").alias("k2"), F.lit(0).alias("side"), "node")
    classes = components(tied(large))
    links = tied(small).unionByName(_verified(texts, sets, classes, percent))
    found = components(links)
    named = found.join(sets.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("component"))
    named = found.join(named, "root").select("node", "component")
    named = sets.select("node", "d1", "d2", "id", "salts").join(named, "node", "left").select("d1", "d2", F.explode("salts").alias("salt"), F.coalesce("component", "id").alias("component"))
    linked = rows.where("n > 0").select("id", "n", "d1", "d2", salt).join(named, ["d1", "d2", "salt"]).select("id", "n", "component")
    out = linked.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(public_id().alias("doc_id"), F.col("n").alias("n_shingles"), public_id("component").alias("component_id"))
