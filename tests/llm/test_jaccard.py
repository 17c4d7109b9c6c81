"""The size-aware Jaccard join against brute force: small sets, large sets, classes cut into blocks, keys over many ranges."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularis.llm import jaccard
from tests.llm.conftest import EDGE_ROWS

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if x]
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute(rows, percent=90):
    """(id, size, smallest id of the row's class) of every row, in order."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(rows):
        low.setdefault(find(i), []).append(name)
    least = {r: min((x for x in names if x is not None), default=None) for r, names in low.items()}
    return sorted(((name, len(sets[i]), least[find(i)]) for i, (name, _) in enumerate(rows)), key=str)


def edited(rnd, text, n):
    w = text.split(" ")
    for _ in range(n):
        k = rnd.randrange(len(w))
        w[k : k + rnd.choice([0, 1, 1])] = [f"x{rnd.randrange(10**6)}"]
    return " ".join(w)


def corpus(seed, n, lengths):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            text = edited(rnd, rnd.choice(rows)[1], rnd.choice([0, 0, 1, 1, 2, 3]))
        else:
            text = " ".join(rnd.choice(["w", "é", "W"]) + str(rnd.randrange(300)) for _ in range(rnd.choice(lengths)))
        rows.append((i * 7 % 1009, text))
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent", [90, 80])
def test_small_and_large_sets(docs_of, clashing, percent):
    rows = corpus(1, 160, [1, 2, 3, 5, 11, 12, 13, 18, 21, 22, 23, 28, 40, 60, 150])
    assert found(jaccard.jaccard_classes(clashing(docs_of(rows)), percent)) == brute(rows, percent)


@pytest.mark.parametrize("most", [0, 12, 25])
def test_any_boundary_gives_the_same(docs_of, monkeypatch, most):
    monkeypatch.setattr(jaccard, "boundary", lambda *_: most)
    rows = corpus(2, 140, [11, 12, 13, 14, 20, 21, 22, 23, 26])
    assert found(jaccard.jaccard_classes(docs_of(rows))) == brute(rows)


def test_classes_cut_into_blocks(docs_of, monkeypatch):
    """One class of several blocks, of copies that are partly too far from its centre."""
    monkeypatch.setattr(jaccard, "BLOCK", 900)
    rnd = random.Random(3)
    base = " ".join(f"b{k}" for k in range(100))
    rows = [(k, edited(rnd, base, rnd.choice([0, 1, 1, 2, 2, 3]))) for k in range(60)] + [(100 + k, t) for k, (_, t) in enumerate(corpus(4, 30, [90]))]
    assert found(jaccard.jaccard_classes(docs_of(rows))) == brute(rows)


def test_edges(docs_of):
    rows = [*EDGE_ROWS, (None, "alone in the dark with no id at all here"), (9, "same text again and again in two rows"), (11, "w " * 10), (12, "one"), (13, "One"), (14, "long " + "word other " * 100_000)]
    assert found(jaccard.jaccard_classes(docs_of(rows))) == brute(rows)
    assert jaccard.jaccard_classes(docs_of([], 1)).count() == 0


def test_hot_keys_are_tied_over_ranges(spark):
    """Side 1 is tied to side 0 only, also where a key fills several ranges."""
    rnd = np.random.default_rng(5)
    rows = [(7, 7, int(s), int(v)) for s, v in zip(rnd.integers(0, 2, 300), rnd.permutation(300), strict=True)]
    rows += [(8, 8, 1, 1000 + k) for k in range(200)] + [(int(k) % 9, 5, 0, 2000 + k) for k in range(40)]
    edges = jaccard.tied(spark.createDataFrame(rows, "k1 long, k2 long, side int, node long").repartition(5)).collect()
    root = {v: v for *_, v in rows}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for e in edges:
        root[find(e["a"])] = find(e["b"])
    assert len({find(v) for k1, k2, _, v in rows if (k1, k2) == (7, 7)}) == 1
    assert len({find(v) for k1, k2, _, v in rows if (k1, k2) == (8, 8)}) == 200
    assert len({find(v) for _, k2, _, v in rows if k2 == 5}) == 9


def test_linked_sets_agree_on_a_part():
    rnd = np.random.default_rng(6)
    for size in (3, 10, 19, 47, 300, 2500):
        for _ in range(20):
            a = np.unique(rnd.integers(0, 2**64, size, dtype=np.uint64))
            off = len(a) // 19
            b = np.unique(np.r_[a[rnd.permutation(len(a))[off:]], rnd.integers(0, 2**64, off, dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both):
                one, two = (set(zip(*(x.tolist() for x in jaccard.part_keys(s, 90)), strict=True)) for s in (a, b))
                assert one & two


def test_many_rows_of_one_document(spark, docs_of):
    rows = [(1, "this text fills a third of all rows of the table")] * 80 + corpus(7, 60, [30])
    df = docs_of(rows)
    assert found(jaccard.jaccard_classes(df.withColumn("text", F.col("text")))) == brute(rows)
