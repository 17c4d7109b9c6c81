"""Suffix-array dedup: bytes covered by a repeated 400-byte string, by prefix doubling over sampled positions.

Every text is UTF-8 bytes; a byte is removed if it lies in a 400-byte string that also starts anywhere else
(same document included), judged on the input.

1. Sampling. The 400-byte string at start s is filed under its anchor: the leftmost of its 64-byte grams
   with the smallest hash. Equal strings have equal anchors at equal offsets, so only starts under the same
   anchor gram can be equal. An anchor serves a stretch of neighbouring starts (about 170), which share
   one row (gram, hash of the stretch's bytes, document, place): rows are a fiftieth of the positions' size.
2. Spark range-partitions and sorts the rows by (gram, stretch, document, place); a task streams them.
   Unique grams end here. Stretches that stand twice are repeated as a whole. The runs at a partition's two
   ends may continue next door: one row for each of their stretches, with its number of copies, stays open
   and is settled by a grouped count, so that a stretch that fills the table gives a row a partition.
3. What is left, different stretches under one gram, goes through prefix doubling: the (rank, hash of the
   next block) pairs of their positions are sorted at growing offsets 64, 128, 256 and 400 and reranked;
   unique positions drop out at every step. Spark sorts the stretches by gram and a task doubles the
   positions of many grams at a time. A gram with more than ``WIDE`` different stretches does not go to
   one task: its positions are doubled as rows, each step a grouped count over all executors.
4. Spans are joined per document and cut out.

Hashes have 64 bits beside the 64 of the gram. No position is dropped to bound a group.

Cases: null, empty and shorter texts lose nothing; rows that repeat a doc_id are told apart by their
text's hash, and equal rows are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import byte_slices, doc_texts, lean, public_id, shuffle_width, written
from tabularis.llm.words import SEED, mixed, prefix_hash, span_hash

LENGTH, GRAM = 400, 64
SPREAD = LENGTH - GRAM + 1  # grams of a string
STEPS = (64, 64, 128, 144)  # blocks whose hashes extend the ranks: 64, 128, 256, 400 bytes
PIECE = 1 << 22  # starts handled at once in a very long text
WIDE = 20_000
BUFFER = 2 << 20  # bytes of stretches doubled together
PLACE_BITS = np.uint64(24)
BYTES = np.random.default_rng(SEED + 1).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.pad(x, (0, pad), constant_values=np.iinfo(np.uint64).max).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of starts with one anchor: text index, first start, number of bytes, anchor offset, gram, hash."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < LENGTH:
        return none
    prefix = prefix_hash(data, BYTES)
    places = np.arange(len(data) - GRAM + 1)
    grams = span_hash(prefix, places, places + GRAM)
    low = sliding_min(grams >> PLACE_BITS << PLACE_BITS | places.astype(np.uint64), SPREAD)
    anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    ends = np.repeat(offs[1:], np.diff(offs))[: len(low)]
    starts = np.flatnonzero(np.arange(len(low)) + LENGTH <= ends)
    if not len(starts):
        return none
    anchor = anchor[starts]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first, last, at = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]], anchor[new]
    size, back = last - first + LENGTH, at - first
    whole = mixed(span_hash(prefix, first, last + LENGTH) + size.astype(np.uint64) * BYTES[0] + back.astype(np.uint64) * BYTES[1])
    doc = np.searchsorted(offs, first, "right") - 1
    return doc, first - offs[doc], size, back, grams[at], whole


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, first byte, data, offsets): slices of whole texts, or overlapping pieces of a very long one."""
    for lo, hi, data, offs in byte_slices(column):
        if hi - lo > 1 or len(data) <= PIECE + LENGTH:
            yield lo, 0, data, offs
        else:
            for at in range(0, len(data) - LENGTH + 1, PIECE):
                part = data[at : at + PIECE + LENGTH - 1]
                yield lo, at, part, np.array([0, len(part)])


ROW = "gram long, whole long, id long, t long, first int, size int, back short"
NAMES = ["gram", "whole", "id", "t", "first", "size", "back"]


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, marks = b.column("id").to_numpy(), b.column("t").to_numpy()
        for row, at, data, offs in _pieces(b.column("text")):
            doc, first, size, back, gram, whole = stretches(data, offs)
            columns = gram.view(np.int64), whole.view(np.int64), ids[row + doc], marks[row + doc], (first + at).astype(np.int32), size.astype(np.int32), back.astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=NAMES)


#: What is known of a stretch: repeated as a whole; the one that stands for its copies; in an open run.
FOUND = ROW + ", repeated boolean, stands boolean, copies int"  # copies: of an open row, else 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by gram, stretch, document, place; give those whose gram stands twice.

    A run of one gram is complete when the next gram begins. Of the first and the last run of a
    partition, and of runs that outgrow ``WIDE`` rows (their rows stream through), the first row of every
    stretch stays open; its other copies are known to be repeated.
    """
    held: list[pa.Table] = []
    count, seen_first, streaming = 0, False, None

    def flush(table: pa.Table, is_open: bool) -> pa.RecordBatch | None:
        gram, whole = table.column("gram").to_numpy(), table.column("whole").to_numpy()
        new_gram = np.r_[True, gram[1:] != gram[:-1]]
        new = new_gram | np.r_[True, whole[1:] != whole[:-1]]
        run, sub = np.cumsum(new_gram) - 1, np.cumsum(new) - 1
        same = np.bincount(sub)[sub]  # copies of the row's stretch, itself included
        if is_open:
            keep, stands, copies = np.ones(len(gram), bool), np.zeros(len(gram), bool), np.where(new, same, 0)
        else:
            keep = np.bincount(run)[run] > 1
            stands = new & (np.bincount(run[new])[run] > 1)  # there are different stretches under the gram
            copies = np.zeros(len(gram), np.int64)
        if not keep.any():
            return None
        arrays = [table.column(n).combine_chunks() for n in NAMES] + [pa.array(same > 1), pa.array(stands), pa.array(copies.astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=[*NAMES, "repeated", "stands", "copies"]).filter(pa.array(keep))

    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([b])
        gram = table.column("gram").to_numpy()
        if streaming is not None:  # the long run goes on
            n = int(np.argmax(gram != streaming)) if (gram != streaming).any() else len(gram)
            if n:
                yield flush(table.slice(0, n), True)
            table = table.slice(n)
            if not table.num_rows:
                continue
            streaming, gram = None, gram[n:]
        if held:
            table = pa.concat_tables([*held, table])
            gram = table.column("gram").to_numpy()
        last = int(np.searchsorted(gram, gram[-1], "left"))  # the last run may go on
        done, rest = table.slice(0, last), table.slice(last)
        if done.num_rows and not seen_first:
            n = int(np.searchsorted(gram, gram[0], "right"))
            yield flush(done.slice(0, n), True)
            done, seen_first = done.slice(n), True
        if done.num_rows and (out := flush(done, False)) is not None:
            yield out
        held, count = [rest], rest.num_rows
        if count > WIDE:
            yield flush(rest, True)
            held, streaming, seen_first = [], int(gram[-1]), True
    if held:
        yield flush(held[0], True)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that are asked for, from their texts."""
    for b in batches:
        grams, ids, marks, firsts, backs, parts = [], [], [], [], [], []
        for i in range(b.num_rows):
            text = b.column("text")[i].as_buffer()
            for x in b.column("asked")[i].as_py():
                grams.append(x["gram"])
                firsts.append(x["first"])
                backs.append(x["back"])
                parts.append(text[x["first"] : x["first"] + x["size"]].to_pybytes())
                ids.append(b.column("id")[i].as_py())
                marks.append(b.column("t")[i].as_py())
        columns = pa.array(grams, pa.int64()), pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(firsts, pa.int32()), pa.array(backs, pa.int16()), pa.array(parts, pa.binary())
        yield pa.RecordBatch.from_arrays(list(columns), names=["gram", "id", "t", "first", "back", "bytes"])


def positions(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each start in the table's stretches: its row, its place in the row, its byte and its rank so far (gram, offset)."""
    sizes = pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64)
    n = sizes - LENGTH + 1
    row = np.repeat(np.arange(table.num_rows), n)
    place = np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
    byte = np.repeat(np.r_[0, np.cumsum(sizes)[:-1]], n) + place
    offset = table.column("back").to_numpy().astype(np.int64)[row] - place
    rank = mixed(table.column("gram").to_numpy().view(np.uint64)[row] + offset.astype(np.uint64) * BYTES[2])
    return row, place, byte, rank


def repeated_starts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the starts in the table whose 400 bytes stand twice in it, by prefix doubling."""
    row, place, byte, rank = positions(table)
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    prefix = prefix_hash(data, BYTES)
    alive, reach = np.arange(len(row)), 0
    for step in STEPS:
        start = byte[alive] + reach
        pair = mixed(rank * BYTES[3] + span_hash(prefix, start, start + step))
        order = np.argsort(pair)
        new = np.r_[True, pair[order][1:] != pair[order][:-1]]
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        rank = number[several].astype(np.uint64)
        alive, reach = alive[order[several]], reach + step
        if not len(alive):
            break
    alive = np.sort(alive)
    return row[alive], place[alive]


SPANS = "id long, t long, start int, end int"


def _spans(table: pa.Table, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Runs of neighbouring repeated starts as spans of bytes."""
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.zeros(0, np.int64)
    first, last = place[new], place[np.r_[new[1:] - 1, len(place) - 1]] if len(new) else place[new]
    at = table.column("first").to_numpy().astype(np.int64)[row[new]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(table.column("id").to_numpy()[row[new]]),
            pa.array(table.column("t").to_numpy()[row[new]]),
            pa.array((at + first).astype(np.int32)),
            pa.array((at + last + LENGTH).astype(np.int32)),
        ],
        names=["id", "t", "start", "end"],
    )


def _double(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by gram: double the positions of whole grams, some ``BUFFER`` bytes at a time."""
    held: list[pa.Table] = []
    for b in batches:
        held.append(pa.Table.from_batches([b]))
        if sum(t.nbytes for t in held) < BUFFER:
            continue
        table = pa.concat_tables(held).combine_chunks()
        gram = table.column("gram").to_numpy()
        cuts = np.flatnonzero(gram[1:] != gram[:-1]) + 1
        lo = 0
        while len(cuts) and lo < cuts[-1]:  # slices of whole grams; the last gram may go on
            size = max(1, int(len(gram) * BUFFER / max(table.nbytes, 1)))
            hi = int(cuts[min(np.searchsorted(cuts, lo + size), len(cuts) - 1)])
            part = table.slice(lo, hi - lo).combine_chunks()
            yield _spans(part, *repeated_starts(part))
            lo = hi
        held = [table.slice(lo)] if lo < len(gram) else []
    if held:
        table = pa.concat_tables(held).combine_chunks()
        if table.num_rows:
            yield _spans(table, *repeated_starts(table))


def _position_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions of wide grams as rows: rank so far and the hashes of the blocks behind."""
    for b in batches:
        whole = pa.Table.from_batches([b])
        for lo in range(0, whole.num_rows, 1000):
            table = pa.Table.from_batches(whole.slice(lo, 1000).combine_chunks().to_batches()[:1])
            row, place, byte, rank = positions(table)
            prefix = prefix_hash(np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8), BYTES)
            blocks, reach = [], 0
            for step in STEPS:
                blocks.append(pa.array(span_hash(prefix, byte + reach, byte + reach + step).view(np.int64)))
                reach += step
            at = table.column("first").to_numpy().astype(np.int32)[row] + place.astype(np.int32)
            own = [pa.array(table.column(n).to_numpy()[row]) for n in ("id", "t")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(at), pa.array(rank.view(np.int64)), *blocks], names=["id", "t", "start", "rank", *[f"b{k}" for k in range(len(STEPS))]])


def _double_wide(contexts: DataFrame) -> DataFrame:
    blocks = [f"b{k}" for k in range(len(STEPS))]
    rows = contexts.mapInArrow(lean(_position_rows), "id long, t long, start int, rank long, " + ", ".join(f"{b} long" for b in blocks))
    for b in blocks:
        rows = rows.withColumn("pair", F.xxhash64("rank", b))
        several = rows.groupBy("pair").agg(F.count("*").alias("n")).where("n > 1").select("pair")
        rows = rows.join(several, "pair", "left_semi").withColumn("rank", F.col("pair"))
    return rows.select("id", "t", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, t, start, end): byte spans that repeated strings cover; spans may overlap. t = xxhash64(text)."""
    texts = doc_texts(docs).select("id", F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text"))
    rows = texts.mapInArrow(lean(_stretch_rows), ROW)
    rows = rows.repartitionByRange(shuffle_width(docs.sparkSession), "gram", "whole", "id", "first").sortWithinPartitions("gram", "whole", "id", "t", "first")
    found = written(rows.mapInArrow(lean(_runs), FOUND), "stretches")
    opened = found.where("copies > 0")
    wholes = opened.groupBy("gram", "whole").agg(F.sum("copies").alias("in_whole"), F.min(F.struct("id", "t", "first")).alias("one"))
    grams = wholes.groupBy("gram").agg(F.sum("in_whole").alias("in_gram"), F.count("*").alias("kinds"))
    settled = opened.join(wholes, ["gram", "whole"]).join(grams, "gram").where("in_gram > 1")
    settled = settled.withColumn("repeated", F.col("in_whole") > 1).withColumn("stands", (F.col("kinds") > 1) & (F.struct("id", "t", "first") == F.col("one")))
    known = found.where("copies = 0").select(*NAMES, "repeated", "stands").unionByName(settled.select(*NAMES, "repeated", "stands"))
    known = written(known, "repeats")
    asked = known.where("stands").groupBy("id", "t").agg(F.collect_set(F.struct("gram", "first", "size", "back")).alias("asked"))
    # equal rows give equal stretches, all of them repeated as a whole already
    contexts = texts.join(asked, ["id", "t"]).select("id", "t", "text", "asked")
    contexts = contexts.mapInArrow(lean(_contexts), "gram long, id long, t long, first int, back short, bytes binary")
    wide = known.where("stands").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > WIDE).select("gram")
    wide = written(wide, "wide")
    if wide.isEmpty():
        narrow, wide_spans = contexts, None
    else:
        contexts = written(contexts, "contexts")
        narrow, wide_spans = contexts.join(wide, "gram", "left_anti"), _double_wide(contexts.join(wide, "gram", "left_semi"))
    spans = narrow.repartition(shuffle_width(docs.sparkSession), "gram").sortWithinPartitions("gram").mapInArrow(lean(_double), SPANS)
    spans = spans.unionByName(known.where("repeated").select("id", "t", F.col("first").alias("start"), (F.col("first") + F.col("size")).alias("end")))
    return spans if wide_spans is None else spans.unionByName(wide_spans)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, removed, runs, kept = [], [], [], []
        for text, spans in zip(b.column("text"), b.column("spans"), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            if spans.as_py():
                at = np.array([(s["start"], s["end"]) for s in spans.as_py()])
                np.add.at(edge, at[:, 0], 1)
                np.add.at(edge, at[:, 1], -1)
            gone = np.cumsum(edge)[:-1] > 0
            sizes.append(len(data))
            removed.append(int(gone.sum()))
            runs.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0])))
            kept.append(data[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row."""
    texts = doc_texts(docs).select("id", F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text"))
    spans = repeated_spans(docs).groupBy("id", "t").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    out = texts.join(spans, ["id", "t"], "left").select("id", "text", "spans")
    out = out.mapInArrow(lean(_cut), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(public_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
