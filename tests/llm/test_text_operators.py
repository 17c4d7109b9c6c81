"""BPE, line dedup, MinHash, suffix dedup and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabularis.llm import bpe, decontam, line_dedup, minhash, suffix_dedup
from tabularis.llm.common import byte_slices
from tests.llm.conftest import EDGE_ROWS

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["Été", "naïve", "ß", "Über"]
    line = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 14)))
    shared = [line() for _ in range(8)]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.4:  # an exact or a near copy
            w = rnd.choice(rows)[1].split(" ")
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 6])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            text = " ".join(w)
        else:
            text = "\n".join(rnd.choice(shared) if rnd.random() < 0.2 else line() for _ in range(rnd.randint(1, 25)))
        rows.append((i * 3, text))
    return rows


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- BPE -------------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_bpe_equals_the_library_on_odd_texts():
    own, decoder, library = bpe.Bpe(bpe.load_tokenizer(PATH)), bpe.Decoder(bpe.load_tokenizer(PATH)), Tokenizer.from_file(PATH)
    rnd = random.Random(2)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "é", "Σ", "ΑΣ", "İ", "ß", "<|endoftext|>", "<|startoftext|>", "<|", "1", "23", "½", "'s", "'ll", "'", "!!", "中文", "😀", "‍", "̀", "ﬁ", "\x00", "_", "q" * 40, "xyz" * 60]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)] + ["", "x" * 5000, "ab" * 3000]
    for text, raw in zip(texts, own.encode_all(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert decoder.decode(raw) == library.decode(ids, skip_special_tokens=False)


def test_bpe_one_word_at_a_time_equals_many_together():
    own = bpe.Bpe(bpe.load_tokenizer(PATH))
    rnd = random.Random(5)
    many = ["".join(rnd.choice("etaoinsh") for _ in range(rnd.randint(1, 66))).encode() for _ in range(500)]
    assert [np.array(own.word(w), "<u4").tobytes() for w in many] == own.many(many)


def test_bpe_rows(docs_of, clashing):
    found = bpe.tokenize_documents(clashing(docs_of(EDGE_ROWS)), PATH).collect()
    assert len(found) == len(EDGE_ROWS)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (1, 2, 3)} == {0}
    assert sum(r["doc_id"] is None for r in found) == 1


# --- line dedup ------------------------------------------------------------------------------


def kept_lines(rows):
    key = lambda line: line.strip(BLANK).translate(LOW)
    holders = defaultdict(set)
    order = lambda i: 2**63 if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(docs_of, clashing, seed):
    rows = corpus(seed) + [(900, "Hot line of text\n" * 40), (901, "x\n HOT line of text\t\nshort"), (902, "hot line of text"), *EDGE_ROWS]
    found = line_dedup.dedup_lines(clashing(docs_of(rows))).collect()
    as_rows = lambda xs: sorted(xs, key=str)
    assert as_rows((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found) == as_rows(kept_lines(rows))


def test_line_dedup_one_line_everywhere(docs_of):
    """One line that fills the table spreads over partitions and is still settled once."""
    rows = [(i, "the very same line in all of them\nown line number %06d" % i) for i in range(300)]
    found = line_dedup.dedup_lines(docs_of(rows, 5)).collect()
    assert sum(r["n_dropped"] for r in found) == 299 and next(r for r in found if r["doc_id"] == 0)["n_dropped"] == 0


def test_empty_tables(docs_of):
    none = docs_of([], 1)
    assert line_dedup.dedup_lines(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert bpe.tokenize_documents(none, PATH).count() == 0


# --- MinHash ---------------------------------------------------------------------------------


def classes(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_minhash(docs_of, clashing, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(7, 90) + [(1000, ""), (1001, None), (1002, "two words"), (1003, "Two  WORDS"), (1004, "one"), (1005, " \n")]
    found = minhash.near_duplicates(clashing(docs_of(rows))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == classes(rows)


def test_minhash_chain_and_repeated_ids(docs_of):
    """Copies that drift: each links to the next only. And one id with two texts ties both classes."""
    base = [f"v{k}" for k in range(300)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(base)))
        base[i * 20] = f"new{i}"
        base[i * 20 + 9] = f"more{i}"
    expected = classes(rows)
    found = table(minhash.near_duplicates(docs_of(rows)))
    assert {i: found[i]["component_id"] for i in found} == {i: expected[i][1] for i in expected}
    other = " ".join(f"z{k}" for k in range(50))
    tied = minhash.near_duplicates(docs_of([*rows, (500, other), (11, other), (None, "no id but some words here")])).collect()
    assert next(r for r in tied if r["doc_id"] == 500)["component_id"] == expected[11][1]


def test_linked_forest_spans_all_links():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 200, dtype=np.uint64)
    sets = []
    for _ in range(80):
        s = base.copy()
        at = rnd.choice(200, rnd.integers(0, 25), replace=False)
        s[at] = rnd.integers(0, 2**63, len(at), dtype=np.uint64)
        sets.append(np.unique(s))
    def groups(pairs):
        root = list(range(80))
        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in pairs:
            root[find(a)] = find(b)
        return sorted(tuple(sorted(j for j in range(80) if find(j) == r)) for r in {find(i) for i in range(80)})
    brute = [(a, b) for a in range(80) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    forest = minhash.linked_forest(np.arange(80), sets, 85)
    assert groups(forest) == groups(brute) and len(forest) < 80


# --- suffix dedup ----------------------------------------------------------------------------


def cut(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + 400] for _, b in texts for k in range(len(b) - 399))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        kept = bytes(x for x, g in zip(b, gone[:-1], strict=True) if not g)
        out.append((i, len(b), int(gone.sum()), int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("wide", [20_000, 2])
def test_suffix_dedup(docs_of, clashing, wide, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    rnd = random.Random(11)
    text = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    passage, rows = text(900), []
    for i in range(40):
        t = text(rnd.randint(0, 1500))
        if rnd.random() < 0.5:
            lo = rnd.randint(0, 500)
            t = t[: len(t) // 2] + passage[lo : lo + rnd.randint(300, 900)] + t[len(t) // 2 :]
        rows.append((i, t))
    rows += [(100, "ab " * 500), (101, "z" * 399), (102, "z" * 401), (103, rows[3][1]), (104, rows[5][1] + "!"), *EDGE_ROWS, (4, passage)]
    found = suffix_dedup.remove_repeats(clashing(docs_of(rows))).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in found), key=str)
    assert got == cut(rows)


def test_suffix_pieces_of_a_long_text(monkeypatch):
    """A text cut into pieces gives the same stretches' strings as the whole."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 5000)
    data = np.random.default_rng(1).integers(97, 100, 40_000).astype(np.uint8).tobytes()
    column = pa.array([data.decode()])
    starts = set()
    for _, at, part, offs in suffix_dedup._pieces(column):
        _, first, size, *_ = suffix_dedup.stretches(part, offs)
        for f, s in zip(first + at, size, strict=True):
            starts |= set(range(f, f + s - 399))
    assert starts == set(range(40_000 - 399))


# --- decontamination -------------------------------------------------------------------------


def leaks(text, items):
    w, out = words(text), set()
    for i, item in items:
        v = words(item)
        if not v:
            continue
        n = len(v)
        if n < 5:
            out |= {i} if any(w[k : k + n] == v for k in range(len(w) - n + 1)) else set()
            continue
        own, grams, size = Counter(tuple(v[k : k + 5]) for k in range(n - 4)), [tuple(w[k : k + 5]) for k in range(len(w) - 4)], n - 4
        for s in range(1 - size, len(grams)):
            c = Counter(grams[max(0, s) : s + size])
            if c & own and sum((c & own).values()) / sum((c | own).values()) >= 0.8:
                out.add(i)
                break
    return out


def test_decontamination(spark, docs_of, clashing):
    rnd = random.Random(3)
    vocabulary = [f"t{k}" for k in range(50)]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(6, 40)))) for k in range(15)]
    items += [(500, "The of"), (501, ""), (502, "aa bb aa bb aa bb aa bb cc"), (503, None), (504, items[0][1])]
    rows = []
    for i in range(150):
        it = words(rnd.choice(items)[1])
        for _ in range(rnd.randint(0, 3)):
            if it:
                k = rnd.randrange(len(it))
                it[k : k + rnd.randint(0, 1)] = rnd.choice([["zz"], [], ["yy", "xx"]])
        around = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        at = rnd.randint(0, len(around))
        rows.append((i, " ".join(around[:at] + it[rnd.choice([0, 0, 0, 2]) :] + around[at:])))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "the  OF"), (1004, f"{items[1][1]} " + "filler words of a very long text " * 30_000 + items[2][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = table(decontam.decontaminate(clashing(docs_of(rows)), benchmark))
    expected = {i: leaks(t, items) for i, t in rows if i != 1004} | {1004: {1, 2}}
    assert {i: set(r["item_ids"]) for i, r in found.items()} == expected
    assert any(expected.values()) and not all(expected.values())
    assert all(r["contaminated"] == bool(expected[i]) for i, r in found.items())
    nothing = decontam.decontaminate(docs_of(rows), benchmark.limit(0))
    assert not any(r["contaminated"] for r in nothing.collect())


def test_decontamination_in_blocks(spark, docs_of, monkeypatch):
    """A benchmark beyond one broadcast is taken block by block, with the same result."""
    rows = corpus(4, 30)
    items = [(k, " ".join(words(t)[:12])) for k, t in rows[:10]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = table(decontam.decontaminate(docs_of(rows), benchmark))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    parts = table(decontam.decontaminate(docs_of(rows), benchmark))
    assert {i: r["item_ids"] for i, r in whole.items()} == {i: r["item_ids"] for i, r in parts.items()}


def test_hamming_blocks_lose_nothing():
    rnd = np.random.default_rng(0)
    items = rnd.integers(0, 256, (30, decontam.BLOCKS)).astype(np.uint8)
    near = np.repeat(items, 40, axis=0)
    for row in near:
        for bit in rnd.choice(decontam.BITS, rnd.integers(0, 100), replace=False):
            row[bit // 8] ^= np.uint8(1 << (bit % 8))
    apart = decontam.POPCOUNT[near[:, None] ^ items[None]].sum(axis=2, dtype=int)
    assert set(zip(*(x.tolist() for x in decontam.Table(items).within(near)), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(apart <= decontam.RADIUS)), strict=True))


def test_window_prints_in_runs(monkeypatch):
    rnd = np.random.default_rng(1)
    grams = rnd.integers(0, 2**64, 90, dtype=np.uint64)
    monkeypatch.setattr(decontam, "RUN", 7)
    for size in (1, 4, 30, 200):
        for start, count in ((-size + 1, 60), (0, 90), (85, 5)):
            found = decontam.window_prints(grams, start, count, size)
            plain = [decontam.signs(grams[max(s, 0) : max(s + size, 0)]).sum(axis=0, dtype=int) for s in range(start, start + count)]
            assert (found == decontam.packed(np.array(plain))).all()


def test_fingerprint_recall():
    """Windows at a similarity of 0.8 and somewhat more, against brute force on their multisets: at least 0.99 are found."""
    rnd = np.random.default_rng(2)
    found = total = 0
    for _ in range(400):
        item = rnd.integers(0, 2**64, rnd.integers(20, 60), dtype=np.uint64)
        other = item.copy()
        gone = rnd.choice(len(item), int(len(item) / 9), replace=False)  # similarity 0.8 to 0.82
        other[gone] = rnd.integers(0, 2**64, len(gone), dtype=np.uint64)
        same = len(np.intersect1d(item, other))
        if same / (2 * len(item) - same) >= 0.8:
            total += 1
            table = decontam.Table(decontam.packed(decontam.sum_of(item)[None]))
            found += len(table.within(decontam.packed(decontam.sum_of(other)[None]))[0])
    assert total > 300 and found >= 0.99 * total


def test_byte_slices_cover_the_column():
    texts = ["a" * n for n in (0, 5, 0, 3000, 7, 0, 0, 2, 9000, 1)]
    column = pa.array(["zz", *texts]).slice(1)
    seen = [bytes(data[offs[k] : offs[k + 1]]).decode() for _, _, data, offs in byte_slices(column, 1000) for k in range(len(offs) - 1)]
    assert seen == texts
