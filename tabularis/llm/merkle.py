"""Merkle manifest of a table: a nested-struct rollup over rank digits, proofs by transform and explode.

Every row is a leaf; the leaves of a group (``lang``) in ascending ``doc_id`` order make a binary tree whose top is
the group's subroot, and the subroots in group order make the tree whose top is the root.

1. Leaves are hashed where the rows are read; only digests and ids are moved.
2. Ranks. Leaves are sorted by range, and a range's share of a group starts at the counts of the ranges before it.
3. Rollup. A rank is a block number and ``DIGITS`` binary digits. Rows are dealt by (group, block) once; then the
   digits are grouped away one after the other, lowest first. A group of children becomes a struct of its hash and
   the children's structs, so that a block ends as one row that holds its whole tree of at most ``2**DIGITS`` nodes.
   The blocks' hashes are the leaves of the next round, until a group has one block.
4. Proofs. From the top down, a block meets the path above it in a union grouped by (group, block); a nested
   transform gives every leaf of the block the siblings on its way, and an explode makes them rows. Nothing is joined.

A group that holds all rows is as many blocks as any other rows; no row is larger than a block.

Cases: a null group comes before all others, a null ``doc_id`` before all ids of its group; rows that repeat a ``doc_id``
follow each other by their leaf digests, and equal rows are equal leaves. A null text (or any null input) hashes as
``-``, an empty one as ``0:``. A text of any length is hashed whole, and no copy of it is moved. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.llm.common import pick, shuffle_width, written

#: Binary digits of a rank that one block holds.
DIGITS = 10
STEP = "struct<l:string,r:string>"
INPUTS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the 0-based rank within ``g`` by the columns of ``order``.

    Equal rows are dealt over several ranges by their place in the input, which decides nothing else.
    """
    spread = rows.withColumn("_at", F.monotonically_increasing_id())
    ranges = spread.repartitionByRange(shuffle_width(rows.sparkSession), "g", *order, "_at")
    ranges = written(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range and group
    counts = ranges.groupBy("g", "_range").agg(F.count("*").alias("_n"))
    starts = counts.select("g", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("g", "_range").orderBy(*order, "_at"))
    placed = ranges.withColumn("_place", place - 1).join(starts, ["g", "_range"])
    return placed.withColumn("idx", F.col("_start") + F.col("_place")).drop("_at", "_range", "_start", "_place")


def rollup(nodes: DataFrame) -> DataFrame:
    """(g, blk, h, tree) from nodes (g, idx, h, p): a row for each block of ``2**DIGITS`` ranks, with its nested tree.

    A tree is a struct (d, h, k): its digit in its parent, its hash, and its one or two children; a leaf's k is its p.
    """
    digits = [F.shiftright("idx", t).bitwiseAND(F.lit(1)).cast("int").alias(f"d{t}") for t in range(DIGITS)]
    cut = nodes.select("g", F.shiftright("idx", DIGITS).alias("blk"), *digits, "h", F.col("p").alias("k")).repartition("g", "blk")
    level = cut.withColumn("m", F.count("*").over(Window.partitionBy("g", "blk")))
    for t in range(DIGITS):
        child = F.struct(F.col(f"d{t}").alias("d"), "h", "k")
        keys = ["g", "blk", "m", *(f"d{u}" for u in range(t + 1, DIGITS))]
        level = level.groupBy(*keys).agg(F.array_sort(F.collect_list(child)).alias("k"))
        # the only node of its group stays as it is; in other blocks than the first, there are always more
        lone = (F.col("blk") == 0) & (F.col("m") <= 2**t)
        first, second = F.col("k")[0]["h"], F.get("k", F.lit(1))["h"]
        level = level.withColumn("h", F.when(lone, first).otherwise(digest(first, F.coalesce(second, F.lit("")))))
    return level.select("g", "blk", "h", F.struct("h", "k").alias("tree"))


def paths(tree: Column) -> Column:
    """Array of (k, h, path) of every leaf: its payload, its hash and the siblings left and right on its way up.

    A level at which the node was the only one of its group left its hash as it was, and has no step.
    """
    none, blank = F.array().cast(f"array<{STEP}>"), F.lit("")

    def children(x: Column) -> Column:
        first, second = x["k"][0]["h"], F.coalesce(F.get(x["k"], F.lit(1))["h"], blank)

        def longer(kid: Column, i: Column) -> Column:
            step = F.struct(F.when(i == 1, first).otherwise(blank).alias("l"), F.when(i == 0, second).otherwise(blank).alias("r"))
            step = F.when(x["h"] == first, none).otherwise(F.array(step))
            return F.struct(kid["k"].alias("k"), kid["h"].alias("h"), F.concat(step, x["path"]).alias("path"))

        return F.transform(x["k"], longer)

    found = F.array(F.struct(tree["k"].alias("k"), tree["h"].alias("h"), none.alias("path")))
    for _ in range(DIGITS):
        found = F.flatten(F.transform(found, children))
    return found


def tops(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The rollups of every round, written; in the last one every group is one block."""
    rounds = []
    while True:
        rounds.append(written(rollup(nodes), f"{name}-{len(rounds)}"))
        if rounds[-1].where("blk > 0").isEmpty():
            return rounds
        nodes = rounds[-1].select("g", F.col("blk").alias("idx"), "h", F.struct("blk").alias("p"))


def descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(g, p, h, path, ends) of the leaves of ``blocks``. ``above``: (g, blk, path, ends) from each block to the root."""
    empty = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    both = blocks.select("g", "blk", "tree", empty(above, "path"), empty(above, "ends")).unionByName(above.select("g", "blk", empty(blocks, "tree"), "path", "ends"))
    met = both.groupBy("g", "blk").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("tree", "path", "ends")))
    leaf = met.select("g", F.explode(paths(F.col("tree"))).alias("leaf"), "path", "ends")
    return leaf.select("g", F.col("leaf.k").alias("p"), "leaf.h", F.concat("leaf.path", "path").alias("path"), "ends")


def proofs(leaves: DataFrame) -> DataFrame:
    """(p, leaf, path, subroot, root) of leaves (g, idx, h, p). ``path`` goes from the leaf up to the root."""
    rounds = tops(leaves, "tree")
    subroots = rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "h")
    subroots = ranked(subroots, ["name"]).select("g", "idx", "h", F.struct("name").alias("p"))
    upper = tops(subroots, "top")
    none = F.array().cast(f"array<{STEP}>").alias("path")
    above = upper[-1].select("g", "blk", none, F.struct(F.lit("").alias("subroot"), F.col("h").alias("root")).alias("ends"))
    for k in range(len(upper) - 1, -1, -1):
        found = descend(upper[k], above)
        if k:
            above = found.select("g", F.col("p.blk").alias("blk"), "path", "ends")
    ends = F.struct(F.col("h").alias("subroot"), F.col("ends.root").alias("root")).alias("ends")
    above = found.select(F.col("p.name").alias("g"), F.lit(0).cast("long").alias("blk"), "path", ends)
    for k in range(len(rounds) - 1, -1, -1):
        found = descend(rounds[k], above)
        if k:
            above = found.select("g", F.col("p.blk").alias("blk"), "path", "ends")
    return found.select("p", F.col("h").alias("leaf"), "path", "ends.*")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["l"], h, s["r"]))


def manifest(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, leaf, tampered_leaf, path (array of l, r), subroot, root.

    ``tampered_leaf`` is the leaf of the row whose n_chars is one more, where 7 divides crc32 of the decimal doc_id.
    """
    d = pick(docs, *INPUTS).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("n_chars", F.col("n_chars").cast("long"))
    leaf = lambda n: digest(*(encoded(n if c == "n_chars" else F.col(c)) for c in INPUTS))
    wrong = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    group = F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("g")
    leaves = d.select(group, "doc_id", leaf(F.col("n_chars")).alias("h"), F.when(wrong, leaf(F.col("n_chars") + 1)).alias("tampered_leaf"))
    leaves = ranked(leaves, ["doc_id", "h"]).select("g", "idx", "h", F.struct("doc_id", "tampered_leaf").alias("p"))
    return proofs(leaves).select("p.*", "leaf", "path", "subroot", "root")


def verified(found: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of a manifest."""
    start = F.coalesce("tampered_leaf", "leaf")
    out = found.withColumn("folded_root", folded(start, F.col("path")))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    proof = F.sha2(siblings.cast("binary"), 256).alias("proof_sha256")
    return out.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
