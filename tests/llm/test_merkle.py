"""The Merkle manifest against a tree built in Python, on edge rows and with blocks of a few leaves."""

import hashlib
import random
import zlib

import pytest

from tabularis.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (row["doc_id"], row["source"], row["lang"], n, row["text"])))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i // 2 * 2 : i // 2 * 2 + 2]
        out.append((run[: i % 2], run[i % 2 + 1 :]))
        i //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["n_chars"])))
    trees = {g: levels([leaf(r, r["n_chars"]) for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    root, out = top[-1][0], []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path, n = way(trees[g], i) + way(top, k), r["n_chars"]
            if r["doc_id"] is not None and n is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                n += 1
            h = leaf(r, n)
            for left, right in path:
                h = sha(*left, h, *right)
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], root, sha(*(x for a, b in path for x in (*a, *b))), h, h == root))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)


def check(spark, rows, widen=lambda df: df):
    found = [tuple(r) for r in merkle.verified(merkle.manifest(widen(frame(spark, rows)))).collect()]
    key = lambda r: (r[0] is None, r)
    want = brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    assert sorted(found, key=lambda r: str(key(r))) == sorted(want, key=lambda r: str(key(r)))


def test_blocks_of_four_leaves(spark, monkeypatch, clashing):
    """Several rounds of blocks, runs of one at every level, one language that is most of the table."""
    monkeypatch.setattr(merkle, "DIGITS", 2)
    rnd = random.Random(4)
    langs = ["en"] * 12 + ["de", "ß", "zz", None, ""]
    rows = [(rnd.randrange(60), f"text {k} é" * rnd.randrange(3), rnd.choice(langs), rnd.choice(["s", None]), rnd.choice([7, 9, None])) for k in range(90)]
    check(spark, rows, clashing)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    check(spark, [(k, "t", "en", "s", 1) for k in range(n)])


def test_edges(spark):
    rows = [(None, None, None, None, None), (None, "", None, "s", 0), (4, "same", "en", "s", 4), (4, "same", "en", "s", 4), (4, "other", "en", "s", 4), (5, "word " * 200_000, "en", "s", 10**6)]
    check(spark, rows + [(-k, "x", "en", None, -k) for k in range(40)])
    assert merkle.verified(merkle.manifest(frame(spark, [], 1))).count() == 0
