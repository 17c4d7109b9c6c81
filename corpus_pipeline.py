"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and gives a DataFrame. ``run`` applies
them in order; each result is written as Parquet into the shared checkpoint folder and read back as the next
stage's docs. All stages but the last give the columns of ``documents``. Rows that repeat a doc_id are
kept or dropped row by row; a null doc_id sorts after all others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularis.llm import bpe, decontam, line_dedup, minhash, quality
from tabularis.llm.common import pick, written
from tabularis.llm.queries import TOKENIZER
from tabularis.session import ship
from tabularis.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.3)."""
    ship(spark)
    docs = pick(docs, *COLUMNS)
    stats = written(quality.document_stats(docs), "quality-stats")
    model = quality.fit(stats, read_table(spark, sf_dir, "labels"))
    return quality.score_rows(docs, model).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; n_chars follows the text.

    A document is dropped only if it lost lines and nothing but white space is left.
    """
    ship(spark)
    found = line_dedup.dedup_rows(pick(docs, *COLUMNS))
    kept = found.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    return kept.select("doc_id", "text", "lang", "source", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the smallest doc_id, of every class of near copies (similarity of 0.8 or more)."""
    ship(spark)
    return minhash.without_near_copies(pick(docs, *COLUMNS), percent=80, rows=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    found = decontam.with_matches(pick(docs, *COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text: doc_id, lang, source, n_chars, n_tokens, digests of ids and decoded text."""
    ship(spark)
    path = public_tokenizers.path(TOKENIZER)
    found = bpe.decode(bpe.encode(pick(docs, *COLUMNS), path).drop("text"), path)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return found.select("doc_id", "lang", "source", "n_chars", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", *digests)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", tokenize),
]

#: The first stage is a trained classifier, which SQL can't express; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
