"""Boundary sets against sorted offsets; cut texts against plain slicing; edges."""

import hashlib
import random

import numpy as np
import pytest

from obsflow.llm import infill

KINDS = {
    "runs": lambda n: np.repeat(np.random.default_rng(1).random(n // 500 + 1) < 0.7, 500)[:n],
    "few": lambda n: np.random.default_rng(2).random(n) < 0.01,
    "many": lambda n: np.random.default_rng(3).random(n) < 0.5,
    "all": lambda n: np.ones(n, bool),
    "none": lambda n: np.zeros(n, bool),
}


@pytest.mark.parametrize("size", [1, 100, 65_536, 200_001])
@pytest.mark.parametrize("kind", sorted(KINDS))
def test_rank_and_select(kind, size):
    member = KINDS[kind](size)
    found, places = infill.BoundarySet(member), np.flatnonzero(member)
    assert len(found) == len(places)
    assert found.select(np.arange(len(places))).tolist() == places.tolist()
    asked = np.unique(np.concatenate([np.random.default_rng(4).integers(0, size, 300), [0, size - 1]]))
    assert found.rank(asked).tolist() == np.searchsorted(places, asked).tolist()


def test_each_container_is_used():
    member = np.concatenate([KINDS[k](infill.CHUNK) for k in ("all", "few", "many")])
    kinds = [type(c) for c in infill.BoundarySet(member).containers]
    assert kinds == [infill.RunContainer, infill.ArrayContainer, infill.BitmapContainer]


def expected(key, text):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    text = text or ""
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_cut_and_restored(spark):
    chance = random.Random(7)
    parts = ["a", "é", "日", "🙂", " ", "\n", "<", ">", "P>", "<S", "word ", "<P>", "\0"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 60))) for _ in range(400)]
    texts += ["", None, "🙂" * 70_000, "x" * 200_000, "é日a" * 40_000, "<P>", "<", "<S"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y"), (None, "no key", "x", "y"), (None, None, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, h1 string").repartition(5)
    got = infill.restore(infill.transform(docs)).collect()
    assert len(got) == len(rows)
    want = sorted(repr((k, *expected(k, t), t or "")) for k, t, *_ in rows)
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output, r.restored)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(docs.where("false")).collect() == []


def test_word_units(spark):
    texts = ["  one two  three ", "", "   ", "solo", "é è ê " * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in infill.restore(infill.transform(docs, units="words", percent=100)).collect()}
    assert [got[i].n for i in range(5)] == [3, 0, 1, 1, 300]
    assert [got[i].restored for i in range(5)] == texts
    head = got[4].output.split("<M>")[1]
    assert head == "" or head[0] in "éèê"
    with pytest.raises(ValueError):
        infill.transform(docs, units="lines")
