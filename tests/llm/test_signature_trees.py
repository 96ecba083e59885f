"""The join against all pairs, bounds against exact overlaps, and edges."""

import random
import re

import numpy as np
import pytest

from obsflow.llm import signature_trees as trees
from obsflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    """Size of each set and the least index that links reach, from all pairs."""
    sets = [shingle_set(t) for t in texts]
    least = list(range(len(sets)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def joined(spark, texts):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, size string, comp string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in trees.join_groups(docs).collect()}
    return [got[i] for i in range(len(texts))]


def groups(chance, many, copies, words, changes):
    """Texts of which many are close to 80 % alike, above and below."""
    word = lambda: "".join(chance.choice("abcdefghijkl") for _ in range(6))
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(many):
        base = [word() for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(chance.randint(0, changes)):
                own[chance.randrange(words)] = word()
            if chance.random() < 0.3:
                at = chance.randrange(words)
                own[at:at] = passage
            out.append(" ".join(own))
    return out


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(trees, "LISTED", 4)
    monkeypatch.setattr(trees, "BLOCK", 6)
    monkeypatch.setattr(trees, "LEAF", 5)


def test_all_pairs(spark):
    chance = random.Random(3)
    # The last groups lie about the size from which bitmaps are wider.
    texts = groups(chance, 12, 6, 120, 4) + groups(chance, 5, 6, 770, 25) + ["", None, "one", "One", "one two", "a b c d e", "a b c d e f", "A B  C\nD E", "a b c d"]
    assert joined(spark, texts) == brute(texts)


def test_large_buckets(spark, small_limits):
    chance = random.Random(4)
    texts = groups(chance, 3, 40, 150, 9) + groups(chance, 10, 3, 80, 3)
    want = brute(texts)
    assert len({c for _, c in want}) > 20
    assert joined(spark, texts) == want


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = {docs[i].doc_id: (n, docs[c].doc_id) for i, (n, c) in enumerate(brute([r.text for r in docs]))}
    got = QUERIES["op13_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(docs)


def test_bounds_lose_no_pair():
    chance = np.random.default_rng(2)
    sets = []
    for _ in range(30):
        base = chance.integers(0, 1 << 63, 300).astype(np.uint64)
        for _ in range(4):
            own = base[chance.random(300) < 0.95]
            sets.append(np.unique(np.append(own, chance.integers(0, 1 << 63, 10).astype(np.uint64))))
    sets.sort(key=len)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    for words in (1, 4, 16):
        forest = trees.Forest(np.zeros(len(sets), int), sizes, trees.signatures(np.concatenate(sets), row, len(sets), words))
        got = {(i, j): k for a, b, shared in forest.pairs() for i, j, k in zip(a.tolist(), b.tolist(), shared.tolist(), strict=True)}
        exact = {(i, j): len(np.intersect1d(sets[i], sets[j])) for j in range(len(sets)) for i in range(j)}
        wanted = {p for p, n in exact.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
        assert wanted and wanted <= got.keys() and all(got[p] >= exact[p] for p in got)
    assert len(got) < len(exact) / 10


def test_edges(spark):
    texts = [None, "", " \n\t", "x", "x", "🙂 é 日", "w " * 30_000, "w " * 30_000 + "v"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (None, "alone"), (None, None), (6, texts[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in trees.join_groups(docs).collect()), key=repr)
    want = [(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5), (6, 1, 6), (6, 1, 6), (7, 2, 7), (None, 1, 3), (None, 1, None), (None, 0, None)]
    assert got == sorted(want, key=repr)
    assert trees.join_groups(docs.where("false")).collect() == []
    long = " ".join(f"w{i}" for i in range(40_000))
    pair = spark.createDataFrame([(1, long), (2, long.replace("w77 ", "q ")), (3, long[:1000])], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in trees.join_groups(pair).collect()} == {1: 1, 2: 1, 3: 3}
