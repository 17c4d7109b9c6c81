"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Reads a public tokenizer file (BPE with word ends: NFC, white space dropped, lower case, split into
words, byte-level symbols). Each word starts as one symbol per byte; a segment tree holds the merge
rank of every adjacent pair, its root leads to the leftmost pair of lowest rank, and a merge updates three
leaves in logarithmic time, until no pair can be merged. A long run without spaces therefore
costs n log n. New words of a batch go through their steps together, one row of an array of trees each. The vocabulary (a fixed file, about 2 MB) reaches the tasks by broadcast.

Cases: a null or empty text has no tokens and decodes to the empty string; whole texts are
encoded, special-token strings in a text become their ids as in the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularis.llm.common import doc_texts, lean, public_id, small_batches

WORD_END = "</w>"
NO_RANK = 1 << 30
CACHE_ENTRIES = 1 << 17  # chunks remembered by a worker; beyond that the memory starts anew
BATCH, WIDEST = 1 << 13, 64  # words with a tree of at most WIDEST leaves go through their steps together
SLICE = 1 << 20
SLOT_BITS, SLOT_FACTOR = 19, np.uint64(0x9E3779B97F4A7C15)
ODD_SPACES = re.compile("[\x1c-\x1f]")  # white space to str.split, but not to the tokenizer
#: Fixed: what the tokenizer takes as white space, for a character class.
SPACES = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others follow from code point 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


def load_tokenizer(path: str) -> dict:
    """What the tasks need of a tokenizer file: vocabulary, merges, split pattern, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [m.split(" ", 1) if isinstance(m, str) else m for m in spec["model"]["merges"]]
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {"vocab": spec["model"]["vocab"], "merges": merges, "pattern": split["pattern"]["Regex"], "special": special}


class Bpe:
    def __init__(self, spec: dict):
        self.vocab, self.special = spec["vocab"], spec["special"]
        self.pairs = {}
        for rank, (a, b) in enumerate(spec["merges"]):
            self.pairs[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        symbols = byte_symbols()
        self.inner = [self.vocab.get(s) for s in symbols]
        self.last = [self.vocab.get(s + WORD_END) for s in symbols]
        self.words = regex.compile(spec["pattern"].replace(r"\s", SPACES))
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}
        self.inner_id, self.last_id = (np.array([-1 if i is None else i for i in x], np.int32) for x in (self.inner, self.last))
        self.made = np.array([self.vocab[a + b] for a, b in spec["merges"]], np.int32)
        # open addressing over merge pairs, for lookups of many pairs at once
        self.slot_key, self.slot_rank = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, np.int32)
        for rank, (a, b) in enumerate(spec["merges"]):
            key = self.vocab[a] << 32 | self.vocab[b]
            slot = key * int(SLOT_FACTOR) % 2**64 >> 64 - SLOT_BITS
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) % (1 << SLOT_BITS)
            self.slot_key[slot], self.slot_rank[slot] = key, rank

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word: merge the leftmost pair of lowest rank until none is left."""
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = [i for i in ids if i is not None]  # no unknown token: a byte outside the vocabulary is left out
        n = len(ids)
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NO_RANK] * (2 * size)
        made = [0] * n
        for i in range(n - 1):
            if hit := self.pairs.get((ids[i], ids[i + 1])):
                tree[size + i], made[i] = hit
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, rank: int) -> None:
            k = size + i
            tree[k] = rank
            while k > 1:
                k >>= 1
                tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def rerank(i: int) -> None:
            j = after[i]
            hit = self.pairs.get((ids[i], ids[j])) if j < n else None
            if hit:
                made[i] = hit[1]
            put(i, hit[0] if hit else NO_RANK)

        while tree[1] < NO_RANK:
            k = 1
            while k < size:
                k = 2 * k if tree[2 * k] <= tree[2 * k + 1] else 2 * k + 1
            i = k - size
            j = after[i]
            ids[i], after[i], ids[j] = made[i], after[j], -1
            if j < n - 1:
                put(j, NO_RANK)
            if after[i] < n:
                before[after[i]] = i
            if i < n - 1:
                rerank(i)
            if before[i] >= 0:
                rerank(before[i])
        return [x for x in ids if x >= 0]

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks, as little-endian unsigned 32-bit integers."""
        split = {c: self.words.findall(c) for c in chunks if not c.isalpha()}
        words = list({c for c in chunks if c not in split}.union(*split.values()))
        ids = dict(zip(words, self.many([w.encode("utf-8") for w in words]), strict=True))
        self.cache.update(ids)
        for c, ws in split.items():
            self.cache[c] = b"".join(map(ids.__getitem__, ws))

    def many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words. Words of like length share their steps; long ones go one by one."""
        out: list[bytes] = [b""] * len(words)
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            groups.setdefault(1 << max(0, len(w) - 2).bit_length(), []).append(k)
        for size, group in groups.items():
            for at in range(0, len(group), BATCH):
                part = group[at : at + BATCH]
                if size > WIDEST:
                    found = [np.array(self.word(words[k]), "<u4").tobytes() for k in part]
                else:
                    found = self._together([words[k] for k in part], size)
                for k, ids in zip(part, found, strict=True):
                    out[k] = ids
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of pairs of ids, NO_RANK without one."""
        key = a.astype(np.int64) << 32 | b
        slot = (key.astype(np.uint64) * SLOT_FACTOR >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = np.full(len(key), NO_RANK, np.int32)
        left = np.arange(len(key))
        while len(left):
            there = self.slot_key[slot[left]]
            hit = there == key[left]
            out[left[hit]] = self.slot_rank[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
            slot[left] = (slot[left] + 1) & ((1 << SLOT_BITS) - 1)
        return out

    def _together(self, words: list[bytes], size: int) -> list[bytes]:
        """As ``word`` for many words at once, each with its own segment tree of ``size`` leaves."""
        m, n = len(words), size + 1
        length = np.array([len(w) for w in words])
        raw = np.zeros((m, n), np.uint8)
        raw[np.arange(n) < length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        ids = np.where(np.arange(n) == length[:, None] - 1, self.last_id[raw], self.inner_id[raw])
        ids[np.arange(n) >= length[:, None]] = -1
        if (ids[np.arange(n) < length[:, None]] < 0).any():  # a byte outside the vocabulary
            return [np.array(self.word(w), "<u4").tobytes() for w in words]
        tree = np.full((m, 2 * size), NO_RANK, np.int32)
        tree[:, size:] = np.where(ids[:, 1:] >= 0, self._rank(ids[:, :-1].ravel(), np.maximum(ids[:, 1:], 0).ravel()).reshape(m, size), NO_RANK)
        for k in range(size - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        after = np.tile(np.arange(1, n + 2, dtype=np.int32), (m, 1))  # a spare column stands behind the last symbol
        before = np.tile(np.arange(-1, n, dtype=np.int32), (m, 1))
        rows = np.flatnonzero(tree[:, 1] < NO_RANK)
        while len(rows):
            k = np.ones(len(rows), np.int64)
            while k[0] < size:
                k = 2 * k + (tree[rows, 2 * k] > tree[rows, 2 * k + 1])
            i = k - size
            j = after[rows, i]
            ids[rows, i] = self.made[tree[rows, k]]
            ids[rows, j] = -1
            follow = after[rows, j]
            after[rows, i] = follow
            before[rows, follow] = i
            p = before[rows, i]
            tree[rows, size + np.minimum(j, size - 1)] = NO_RANK
            more = follow < length[rows]
            tree[rows, size + np.minimum(i, size - 1)] = np.where(more, self._rank(ids[rows, i], np.maximum(ids[rows, np.minimum(follow, n - 1)], 0)), NO_RANK)
            back = np.flatnonzero(p >= 0)
            tree[rows[back], size + p[back]] = self._rank(ids[rows[back], p[back]], ids[rows[back], i[back]])
            paths = [size + np.minimum(j, size - 1), size + np.minimum(i, size - 1), size + np.maximum(p, 0)]
            while paths[0][0] > 1:
                paths = [x >> 1 for x in paths]
                for x in paths:
                    tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
            rows = rows[tree[rows, 1] < NO_RANK]
        alive = ids >= 0
        flat, ends = ids[alive].astype("<u4").tobytes(), np.cumsum(alive.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]

    def _chunks(self, text: str) -> list[str]:
        """The text, normalised and in lower case, cut at white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = text.lower() if "\u03a3" not in text else "".join(c.lower() for c in text)  # no final sigma
        return text.split() if not ODD_SPACES.search(text) else [c for c in regex.split(f"[{SPACES}]+", text) if c]

    def plain(self, text: str) -> bytes:
        chunks = self._chunks(text)
        if new := [c for c in set(chunks) if c not in self.cache]:
            self.learn(new)
        return b"".join(map(self.cache.__getitem__, chunks))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of many texts; new chunks of about ``SLICE`` characters of text are learnt together."""
        out, lo = [], 0
        while lo < len(texts):
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            hi, size, lists = lo, 0, []
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE):
                size += len(texts[hi])
                lists.append(self._chunks(texts[hi]) if not self.has_special(texts[hi]) else None)
                hi += 1
            if new := [c for c in set().union(*(x for x in lists if x)) if c not in self.cache]:
                self.learn(new)
            out += [self.encode(t) if x is None else b"".join(map(self.cache.__getitem__, x)) for t, x in zip(texts[lo:hi], lists, strict=True)]
            lo = hi
        return out

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.has_special(text):
            return self.plain(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if k % 2 else self.plain(p) for k, p in enumerate(parts))


class Decoder:
    def __init__(self, spec: dict):
        self.tokens = {i: t for t, i in (spec["vocab"] | spec["special"]).items()}

    def decode(self, ids: bytes) -> str:
        """The file has no decoder, so tokens are joined by a space as they stand."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict = {}


def _loaded(spec, make):
    """What ``make`` builds from a tokenizer, once for each worker process and broadcast."""
    key = (make.__name__, spec.value["key"])
    if key not in _LOADED:
        _LOADED[key] = make(spec.value)
    return _LOADED[key]


def _shared(df: DataFrame, path: str):
    small_batches(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(load_tokenizer(path) | {"key": path})


def encode(df: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of a string column as binary, four little-endian bytes an id."""
    spec, schema = _shared(df, path), T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec, Bpe)
        for b in batches:
            ids = pa.array(bpe.encode_all(b.column(column).fill_null("").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, out])

    return df.mapInArrow(lean(run), schema)


def decode(df: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids of a binary column (see encode) decode to."""
    spec, schema = _shared(df, path), T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _loaded(spec, Decoder)
        for b in batches:
            texts = pa.array([decoder.decode(i.as_py() or b"") for i in b.column(column)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, out])

    return df.mapInArrow(lean(run), schema)


def tokenize_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every whole text."""
    d = encode(doc_texts(docs), path).drop("text")
    d = decode(d, path)
    return d.select(public_id().alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")
