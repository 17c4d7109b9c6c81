"""Registered queries of the training-data operators; each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.llm import bpe, decontam, fingerprint, html_extract, jaccard, licenses, line_dedup, merkle, minhash, negatives, oracles, pii, quality, suffix_dedup
from tabularis.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.tokenize_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.edits(read_table(spark, sf_dir, "documents"))
    own, edited = fingerprint.as_text(F.col("sketch")).alias("fingerprint"), fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint")
    return found.select("doc_id", "n_chars", "edited_sha256", own, edited, "near_edited", "near_next")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read_table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    base = of(*pii.BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("matches")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.manifest(read_table(spark, sf_dir, "documents")))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.whole_vectors(rows.withColumn("label", wrong)), F.col("id") % 50 == 0)


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_fingerprint": op4_fingerprint,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_html_extract": op8_html_extract,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_jaccard": op12_jaccard,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op11_merkle": oracles.MERKLE_SQL,
    "op12_jaccard": oracles.JACCARD_SQL,
    "op13_hard_negatives": oracles.NEGATIVES_SQL,
}
