"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns: defined results, no crash."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from obsflow.llm import contamination, language, maxent, near_duplicates, pages, pieces, quality, repeats, secrets, urls

# Names that the operators use inside, and names that differ in case only from results.
CLASHING = ("key", "node", "h", "words", "row", "body", "n_words", "kept", "bands", "batch", "spans", "digest", "lines", "text_b")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)
PROSE = " ".join(f"word{i % 97} other{i % 31}" for i in range(300)) + "."
LONG = PROSE * 60
TEXTS = [
    (1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, PROSE, "en"), (4, PROSE, "en"), (5, PROSE + " tail", "de"),
    (6, LONG, "fr"), (None, "no id here at all", "en"), (7, "短い 文 です。", "ja"), (8, "a", "en"), (9, "!!! ###", None), (10, "🙂" * 500, "en"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *("x" for _ in CLASHING)) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "word1 other1 word2", "x"), (1, "word1 other1 word2", "x"), (None, None, "x"), (2, "", "x"), (None, "no id here", "x")]
    return spark.createDataFrame(rows, "item_id long, text string, key string")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_quality(docs, none):
    got = by_id(quality.measure(docs))
    assert sum(map(len, got.values())) == len(TEXTS) and len(got[4]) == 2 and got[4][0] == got[4][1]
    assert (got[1][0].n_words, got[1][0].base_failed, got[1][0].kept, got[1][0].lost_share) == (0, True, False, 1.0)
    assert got[3][0].n_words == 0 and got[9][0].n_symbols == 3
    assert got[6][0].n_repeat_words == got[6][0].n_words - 2 and got[6][0].base_failed
    assert quality.measure(none).collect() == []


def test_language(docs, none):
    model = language.fit(docs)
    assert model.languages == ("de", "en", "fr", "ja")
    got = by_id(language.predict(docs, model))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for i in (1, 2, 3, 9, 10) for r in got[i])
    assert got[7][0].lang_pred == "ja" and got[4][0] == got[4][1] and all(0 <= r[2] <= 1 for x in got.values() for r in x)
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 9, 10})
    empty = language.fit(none)
    assert empty.languages == () and {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(none, model).collect() == []


def test_contamination(docs, none, items):
    got = by_id(contamination.find_contamination(docs, items))
    assert sum(map(len, got.values())) == len(TEXTS) and len(got[4]) == 2
    assert (got[1][0].n_words, got[1][0].n_hit, got[1][0].contaminated) == (0, 0, False)
    assert got[4][0]["items"] == ["1"] and got[None][0].n_hit == 3 and got[None][0].n_items == 0 and got[None][0].contaminated
    kept = contamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.contaminated for x in got.values() for r in x)
    assert contamination.find_contamination(none, items).collect() == []
    assert {r.n_hit for r in contamination.find_contamination(docs, items.where("false")).collect()} == {0}
    merged = contamination.find_contamination(docs, items, broadcast_bytes=0)
    assert sorted(map(str, merged.collect())) == sorted(map(str, (r for x in got.values() for r in x)))


def test_secrets(docs, none):
    assert secrets.find_secrets(docs).count() == len(TEXTS)
    assert by_id(secrets.find_secrets(docs))[1][0].spans == ""
    assert sorted(map(str, secrets.mask_secrets(docs).collect())) == sorted(map(str, docs.collect()))
    assert secrets.find_secrets(none).collect() == [] and secrets.mask_secrets(none).columns == none.columns


def test_pieces(docs, none):
    got = by_id(pieces.encode_checked(docs))
    assert sum(map(len, got.values())) == len(TEXTS) and all(r.round_trip for x in got.values() for r in x)
    assert got[1][0].token_ids == [] == got[2][0].token_ids and got[4][0].token_ids == got[4][1].token_ids
    assert pieces.encode(none).collect() == []
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert back[6] == LONG and back[10] == "🙂" * 500 and back[1] == ""


def test_language_model(docs, none):
    counts = maxent.count_tokens(docs)
    got = by_id(maxent.score(docs, counts, maxent.train(docs, counts)))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert got[1][0].n_tokens == got[2][0].n_tokens == got[3][0].n_tokens == 1 and got[4][0] == got[4][1]
    assert all(r.score < 0 and r.base_score < 0 for x in got.values() for r in x)
    empty = maxent.count_tokens(none)
    assert empty.total == 0
    scored = maxent.score(docs, empty, maxent.train(none, empty)).collect()
    assert len(scored) == len(TEXTS) and {r.n_known for r in scored} == {0}


def test_repeats(docs, none):
    got = by_id(repeats.remove_repeats(docs))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert got[1][0].n_bytes == 0 and bytes(got[1][0].kept) == b""
    assert [r.n_removed for r in got[4]] == [len(PROSE)] * 2
    assert got[10][0].n_removed == 2000 and got[8][0].n_removed == 0
    assert repeats.remove_repeats(none).collect() == []


def test_near_duplicates(docs, none):
    got = by_id(near_duplicates.classes(docs))
    assert sum(map(len, got.values())) == len(TEXTS)
    assert got[1][0].class_id == got[2][0].class_id == 1 and got[3][0].class_id == 3
    assert {r.class_id for i in (4, 5) for r in got[i]} == {4} and got[8][0].class_id == 8
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (i is None, i or 0) for i in {r.class_id for x in got.values() for r in x}
    )
    assert near_duplicates.classes(none).collect() == [] == near_duplicates.keep_one(none).collect()


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?q#f"), (4, "http://A.Example.NET/en/x?q#f"), (5, "http://b.net/"), (6, "x://"), (7, "http://y.org" + "/z" * 5000)]
    pages_ = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in rows], "page_id long, url string, host string, path string, gram string")
    got = {}
    for r in urls.judge(pages_).collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert [tuple(got[i][0])[1:4] for i in (1, 2, 3, 6)] == [("", "", None)] * 4 and got[1][0].verdict == "allow"
    assert tuple(got[4][0])[1:5] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[4][0] == got[4][1]
    assert tuple(got[5][0])[1:5] == ("b.net", "/", "net/", "block")
    assert {r.verdict for r in urls.judge(pages_.where("page_id = 7")).collect()} == {"allow"}
    assert urls.judge(pages_.where("false")).collect() == []


def test_pages(spark):
    page = "<html><body><nav><a>menu</a></nav><article><h1>T&amp;t</h1><p>one  two<p>three<br>four</article><footer>f</footer></body></html>"
    rows = [(1, None, None), (2, "http://h/a", ""), (3, "http://h/b", page), (3, "http://h/b", page), (4, None, page * 200), (5, "u", "<p>lone & <b>bold</b> text"), (6, "u", "<<<>>& <")]
    table = spark.createDataFrame([(*r, "c", "s") for r in rows], "page_id long, url string, html string, host string, slot string")
    got = {}
    for r in pages.extract(table).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == got[2] == [""] and got[3] == ["T&t\none two\nthree\nfour"] * 2
    assert got[5] == ["lone & bold text"] and got[4][0].startswith("T&t\none two")
    assert pages.extract(table.where("false")).collect() == []


def test_digests_are_those_of_the_texts(docs):
    kept = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in repeats.remove_repeats(docs).collect()}
    assert kept[8] == hashlib.sha256(b"a").hexdigest()


def test_language_takes_texts_in_small_slices(spark, monkeypatch):
    model, works, sizes = language.LanguageModel((), np.zeros((0, 9), np.float32), np.zeros(0)), [], []
    monkeypatch.setattr(language, "map_batches", lambda df, work, schema: works.append(work) or df)
    judge = language.judge
    monkeypatch.setattr(language, "judge", lambda m, column: sizes.append(column.nbytes) or judge(m, column))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    language.predict(docs, model), language.keep_known(docs, model)
    texts = pa.array(["word " * 4000] * 100)  # 2 MB
    list(works[0]([pa.RecordBatch.from_arrays([pa.array(range(100)), texts], names=["key", "text"])]))
    list(works[1]([pa.RecordBatch.from_arrays([pa.array(range(100)), texts], names=["doc_id", "text"])]))
    assert len(sizes) >= 8
