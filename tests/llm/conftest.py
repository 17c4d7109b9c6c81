import pytest

from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, dealt over several partitions."""

    def make(rows, parts=3):
        df = spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return df.repartition(parts)

    return make


@pytest.fixture(scope="session")
def clashing():
    """The same table with further columns whose names clash with working columns or differ only in case."""

    def widen(df):
        for name in ("id", "t", "keys", "pos", "matches", "score", "n_lines", "TEXT", "Doc_Id", "spans", "host", "path"):
            if name not in df.columns:
                df = df.withColumn("_w", F.lit("x")).toDF(*df.columns, name)
        return df

    return widen


EDGE_ROWS = [(1, None), (2, ""), (3, " \n\t "), (None, "alone in the dark with no id at all here"), (4, "same text again and again in two rows"), (4, "same text again and again in two rows")]
