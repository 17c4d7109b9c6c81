"""Line dedup by sorted line hashes, with per-document keep bitmaps.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased. Keys of at
least ``min_chars`` code points that stand in two or more documents keep only their lines in the
smallest doc_id; all other lines stay.

Method: every long line becomes a row (128-bit key hash, document, position). Spark range-partitions
the rows by (hash, document) and sorts each partition by (hash, document, position); a task streams its
sorted rows and tells first occurrences from later ones with a carry of one key. Because the document
is part of the range key, a line that fills a third of all rows spreads over many partitions. The run
that a partition starts with may continue from the one before: its rows are written with their
key and settled against one marker row per partition end (at most two markers a partition, so the
broadcast is bounded by the number of partitions).

Cases: a null or empty text is one empty line; an empty table gives an empty result; rows that repeat
a doc_id count as the same document and each keeps or loses lines by the same rule; null ids sort last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularis.llm.common import NULL_ID, doc_texts, lean, pick, shuffle_width, written

BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # bytes.lower() changes A-Z only


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def _line_rows(min_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = b.column("id").to_numpy(), b.column("t").to_numpy()
            hashes, docs, places = bytearray(), [], []
            for i, text in enumerate(b.column("text").cast(pa.binary())):
                for at, line in enumerate(text.as_py().split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        hashes += xxhash.xxh3_128_digest(key)
                        docs.append(i)
                        places.append(at)
            h = np.frombuffer(bytes(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids[docs]), pa.array(marks[docs]), pa.array(places, pa.int32())],
                names=["h1", "h2", "id", "t", "pos"],
            )

    return rows


OUT_SCHEMA = "kind int, h1 long, h2 long, id long, t long, pos int"
REPEAT, OPEN, MARK = 0, 1, 2  # a settled repeat, a row of the run a partition starts with, a partition's end run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by (hash, document, position); give repeats, open rows and markers."""
    first_key, key, first_doc = None, None, None
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids, t, pos = (b.column(c).to_numpy() for c in ("h1", "h2", "id", "t", "pos"))
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        firsts = ids[starts].copy()
        head = (int(h1[0]), int(h2[0]))
        if key == head:
            firsts[0] = first_doc
        if first_key is None:
            first_key = head
            yield _rows(np.array([MARK], np.int32), h1[:1], h2[:1], ids[:1], t[:1], pos[:1])
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
        is_open = (h1 == first_key[0]) & (h2 == first_key[1])
        out = is_open | (ids != firsts[run])
        if out.any():
            yield _rows(np.where(is_open[out], OPEN, REPEAT).astype(np.int32), h1[out], h2[out], ids[out], t[out], pos[out])
        key, first_doc = (int(h1[-1]), int(h2[-1])), int(firsts[-1])
    if key is not None:
        one = lambda v, kind=np.int64: np.array([v], kind)
        yield _rows(one(MARK, np.int32), one(key[0]), one(key[1]), one(first_doc), one(0), one(0, np.int32))


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "h1", "h2", "id", "t", "pos"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed, counts = [], []
        for places in b.column("places"):
            gone = np.unique(np.asarray(places.values))
            keep = np.ones(-(-(gone[-1] + 1) // 8) * 8, bool)  # whole bytes
            keep[gone] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            counts.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("t"), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())], names=["id", "t", "n_dropped", "keep"]
        )


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row (id, t, n_dropped, keep) for each document that loses lines.

    ``t`` is ``xxhash64(text)``; ``keep`` is a zlib-compressed bitmap with one bit per line, in whole
    bytes, up to the last dropped line (later lines are kept).
    """
    d = doc_texts(docs).select("id", F.xxhash64("text").alias("t"), "text")
    lines = d.mapInArrow(lean(_line_rows(min_chars)), "h1 long, h2 long, id long, t long, pos int")
    lines = lines.repartitionByRange(shuffle_width(docs.sparkSession), "h1", "h2", "id")
    found = written(lines.sortWithinPartitions("h1", "h2", "id", "t", "pos").mapInArrow(lean(_repeats), OUT_SCHEMA), "lines")
    marks = found.where(F.col("kind") == MARK).groupBy("h1", "h2").agg(F.min("id").alias("first_id"))
    settled = (
        found.where(F.col("kind") == OPEN).join(F.broadcast(marks), ["h1", "h2"]).where(F.col("id") != F.col("first_id")).select("id", "t", "pos")
    )
    dropped = found.where(F.col("kind") == REPEAT).select("id", "t", "pos").unionByName(settled)
    per_doc = dropped.groupBy("id", "t").agg(F.collect_set("pos").alias("places"))
    return per_doc.mapInArrow(lean(_bitmaps), "id long, t long, n_dropped long, keep binary")


def _kept_texts(min_chars: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines_before, long_left = [], [], []
            for text, packed in zip(b.column("text").cast(pa.binary()), b.column("_keep"), strict=True):
                text, packed = text.as_py(), packed.as_py()
                if packed is None:
                    lines_before.append(text.count(b"\n") + 1)
                    long_left.append(True)
                    texts.append(text)
                    continue
                lines = text.split(b"\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[: len(lines)]
                stay = np.r_[bits, np.ones(len(lines) - len(bits), np.uint8)].astype(bool)
                left = [line for line, k in zip(lines, stay, strict=True) if k]
                lines_before.append(len(lines))
                long_left.append(any(_long_enough(line_key(line), min_chars) for line in left))
                texts.append(b"\n".join(left))
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines_before, pa.int64()), "long_left": pa.array(long_left)}
            names = [n for n in b.schema.names if n != "_keep"] + ["n_lines", "long_left"]
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)

    return kept


def dedup_rows(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with the remaining text, n_lines (before), n_dropped and long_left.

    ``long_left`` is false where lines were dropped and no line of ``min_chars`` is left. Columns of ``docs`` with
    these names give way.
    """
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped", "long_left")]
    d = pick(docs, *others, "text").withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn("_t", F.xxhash64("text"))
    gone = keep_bitmaps(docs, min_chars).select(F.col("id").alias("_id"), F.col("t").alias("_t"), F.col("n_dropped").alias("_n"), F.col("keep").alias("_keep"))
    joined = d.join(gone, ["_id", "_t"], "left").select(*others, "text", F.coalesce("_n", F.lit(0)).cast("long").alias("n_dropped"), "_keep")
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField("n_lines", T.LongType()), T.StructField("long_left", T.BooleanType())])
    return joined.mapInArrow(lean(_kept_texts(min_chars)), schema)


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, long_left) for each row of ``docs``."""
    return dedup_rows(pick(docs, "doc_id", "text"), min_chars).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_lines", "n_dropped", "long_left")
