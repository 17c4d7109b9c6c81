"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame expressions only.

A text's set holds the 64-bit hashes of its distinct five-word shingles (with fewer words, of its whole
sequence). Its fingerprint is the ``K`` smallest hashes. The sketch of a union is the ``K`` smallest of both
sketches, so sketches of parts merge; two sketches estimate resemblance, containment and the number of
distinct shingles. Equal texts have equal fingerprints. A resemblance J is estimated with a standard
error of sqrt(J (1 - J) / K), exactly if the union has at most ``K`` shingles.

Cases: null and empty texts have an empty fingerprint; two empty fingerprints resemble each other fully,
an empty one and another not at all; with one document the next document is itself; rows
that repeat a doc_id follow each other by the hash of their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularis.llm.common import doc_texts, public_id, shuffle_width

K = 128
SHINGLE = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Distinct shingle hashes, sorted."""

    def hashes(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= size, many).otherwise(few)

    return F.sort_array(F.array_distinct(let(words(text), hashes)))


def sketch(text: Column, k: int = K) -> Column:
    return F.slice(shingle_hashes(text), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B| of two sketches."""

    def share(u: Column) -> Column:
        return F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)

    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(let(merged(a, b, k), share))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles behind a sketch (exact below ``k``)."""
    spread = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / spread)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B holds."""
    j = resemblance(a, b, k)
    both = j * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def merge_sketches(df: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts: every task passes on at most ``k`` hashes a key."""
    parts = df.select(*keys, F.explode_outer(column).alias("_h")).distinct()
    ranked = parts.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_h").asc_nulls_last()))).where(F.col("_r") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def as_text(s: Column) -> Column:
    """A sketch as 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def in_sequence(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows (id, text, stretch, extra) such that, within a stretch in the window's order, each row is followed
    by the next document in descending doc_id; the last row of a stretch (extra) repeats the first row of
    the next stretch, that of the last stretch the first row of all.

    Stretches are cut at quantiles of the ids, as many as there are shuffle partitions, so no task
    holds the whole order; only their heads' ids reach the driver.
    """
    d = doc_texts(docs).withColumn("t", F.xxhash64("text"))
    spark, n = docs.sparkSession, shuffle_width(docs.sparkSession)
    ids = doc_texts(docs).select("id")
    cuts = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    stretch = F.size(F.filter(cuts, lambda c: c > F.col("id")))
    heads = sorted(tuple(r) for r in ids.groupBy(stretch.alias("stretch")).agg(F.max("id")).collect())
    after = [(heads[(i + 1) % len(heads)][1], s) for i, (s, _) in enumerate(heads)]
    rows = d.withColumn("stretch", stretch).withColumn("extra", F.lit(False))
    if after:
        joint = spark.createDataFrame(after, "id long, stretch int")  # one row a stretch
        tails = d.join(F.broadcast(joint), "id").groupBy("id", "stretch").agg(F.min(F.struct("t", "text")).alias("s"))
        rows = rows.unionByName(tails.select("id", "s.text", "s.t", "stretch", F.lit(True).alias("extra")))
    return rows, Window.partitionBy("stretch").orderBy("extra", F.col("id").desc(), "t")


def edits(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text (the second half replaced by the start of the next document).

    (doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next)
    """
    rows, order = in_sequence(docs)
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("id", "t", "stretch", "extra", "n_chars", "text", F.when(~F.col("extra"), edited).alias("edited"))
    rows = rows.select("id", "t", "stretch", "extra", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("text")).alias("sketch"), F.when(~F.col("extra"), sketch(F.col("edited"))).alias("edited_sketch"))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order)).where(~F.col("extra"))
    return rows.select(
        public_id().alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
