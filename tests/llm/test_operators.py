"""Operators against brute force, an exact round trip or held-out accuracy, on small tables."""

import base64
import gzip
import random
import re
import time
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsflow.llm import batches, contamination, language, maxent, near_duplicates, pages, pieces, quality, repeats, secrets, urls
from obsflow.llm.queries import HELD_OUT_LANGUAGE, HELD_OUT_TOKENS, QUERIES

SF = "/root/testdata/sf0.001"
GAP = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def test_words_do_not_depend_on_the_slice():
    texts = ["ab  cd", "", "cd", None, " é ab"]
    together = batches.find_words(*batches.text_bytes(pa.array(texts)), batches.SPACES)
    assert together.row.tolist() == [0, 0, 2, 4, 4]
    assert together.hash[0] == together.hash[4] and together.hash[1] == together.hash[2]
    alone = batches.find_words(*batches.text_bytes(pa.array(["xx", "cd"])), batches.SPACES)
    assert alone.hash[1] == together.hash[1]
    glued = batches.find_words(*batches.text_bytes(pa.array(["ab", "cd"])), batches.SPACES)
    assert glued.row.tolist() == [0, 1]


def test_quality_counts(docs, texts):
    for r in quality.measure(docs).collect():
        x = texts[r.doc_id]
        w = GAP.findall(x)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        marked = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[g] > 1 for k in range(3)}
        lines = [line for line in x.split("\n") if GAP.search(line)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(marked))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


def test_quality_rules(spark):
    body = "\n".join(" ".join(f"plain{i} words{k}" for k in range(6)) + " end." for i in range(20))
    bad = ["Home | News | About | Contact", "Read more", "All rights reserved.", "WOW!! NOW!! BUY!! YES!!", "a### b$$$ c&&& d%%% e***."]
    rows = [(1, body), (2, body + "\n" + "\n".join(bad)), (3, "\n".join(bad * 20)), (4, body.replace(".", ""))]
    got = {r.doc_id: r for r in quality.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].lost_share == 0
    assert got[2].clean_text == body and got[2].kept
    assert not got[3].kept and not got[4].kept and got[4].lost_share == 1


def test_quality_boilerplate_fails_short_lines_only(spark):
    notices = [
        "This site uses cookies, accept them.", "Bitte lesen Sie unsere Hinweise zum Datenschutz.", "Inscrivez-vous et lisez nos Mentions légales.",
        "TODOS LOS DERECHOS RESERVADOS.", "Login.", "Please log in or sign up, read the terms of use and the privacy policy, and " + "subscribe " * 12 + "to the newsletter.",
    ]
    article = "The engineers described how a login works, " + "and what the machine keeps of it, " * 6 + "in one paragraph."
    rows = [(i, line) for i, line in enumerate([*notices, article, " ".join([article] * 9), "Ordinary words of a short line."])]
    got = [r.clean_text != "" for r in quality.measure(spark.createDataFrame(rows, "doc_id int, text string")).orderBy("doc_id").collect()]
    assert got == [False] * 6 + [True] * 3


def test_language_model_base_scores_and_gain(docs, texts, spark):
    rows = QUERIES["op2_language_model"](spark, SF).collect()
    low = re.compile("[A-Z]")
    tokens = {i: [*GAP.findall(low.sub(lambda m: m[0].lower(), x)), None] for i, x in texts.items()}
    held = {r.doc_id: r.h for r in docs.select("doc_id", F.expr(HELD_OUT_TOKENS).alias("h")).collect()}
    counts = Counter(t for i, x in tokens.items() if not held[i] for t in x)
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        want = sum(np.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[r.doc_id]), sum(t in counts for t in tokens[r.doc_id]), total)
        assert r.base_score == pytest.approx(want)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_rare_tokens_are_joined(docs, monkeypatch):
    counts = maxent.count_tokens(docs)
    weights = maxent.train(docs, counts)
    whole = {r.doc_id: r for r in maxent.score(docs, counts, weights).collect()}
    few = maxent.Counts(counts.path, counts.total, counts.distinct, *(x[: len(counts.common) // 10] for x in (counts.common, counts.common_n)), counts.head, counts.class_total, counts.class_distinct)
    for r in maxent.score(docs, few, weights).collect():
        assert r.n_known == whole[r.doc_id].n_known and r.base_score == pytest.approx(whole[r.doc_id].base_score)


def test_class_probabilities_sum_to_one(docs):
    counts = maxent.count_tokens(docs)
    weights = maxent.train(docs, counts)
    tokens = maxent.Tokens(pa.array(["one two three four", None]))
    assert np.exp(maxent._log_classes(weights, tokens.features(maxent.classes_of(tokens, counts.head)))).sum(axis=1) == pytest.approx(1, abs=1e-4)


def test_contamination(docs, texts, spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda x: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    windows = {}
    for item in items:
        w = cut(item.text)
        for i in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item.item_id))
    got = {r.doc_id: r for r in contamination.find_contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    for i, x in texts.items():
        w, hit, found = cut(x), set(), set()
        for size in {len(k) for k in windows}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in windows:
                    hit |= set(range(a, a + size))
                    found |= windows[tuple(w[a : a + size])]
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(w), len(hit), sorted(found))
        assert got[i].contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_held_out_language(docs):
    model = language.fit(docs.where(f"NOT ({HELD_OUT_LANGUAGE})"))
    held = docs.where(HELD_OUT_LANGUAGE)
    got = {r.doc_id: r.lang_pred for r in language.predict(held, model).collect()}
    right = [got[r.doc_id] == r.lang for r in held.collect()]
    assert np.mean(right) > 0.95


HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "A1B2" * 4
LINE = f'token = "{HEX}"'
NESTED = {
    "plain": LINE,
    "url": urllib.parse.quote(LINE, safe=""),
    "url twice": urllib.parse.quote(urllib.parse.quote(LINE, safe="")),
    "base64": base64.b64encode(LINE.encode()).decode(),
    "base64 twice": base64.b64encode(base64.b64encode(LINE.encode())).decode(),
    "gzip": base64.b64encode(gzip.compress(LINE.encode())).decode(),
    "gzip in gzip": base64.b64encode(gzip.compress(gzip.compress(LINE.encode()))).decode(),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in LINE),
    "entities": "".join(f"&#{ord(c)};" for c in LINE),
    "url of base64": urllib.parse.quote(base64.b64encode((LINE + "?>~").encode()).decode(), safe=""),
}


@pytest.mark.parametrize("name", NESTED)
def test_nested_secrets(name):
    text = f"some words before {NESTED[name]} and after"
    _, found = secrets.scan(text, text.encode())
    kinds = {secrets.KINDS[k] for k, _, _ in found}
    assert {"assign", "hex"} <= kinds
    assert all(0 <= a < b <= len(text) and 18 <= a and b <= 18 + len(NESTED[name]) for _, a, b in found)


STRANGE = "\ufeffmot de passe\u202f: a\u00a0b\x00\f\u200b" + LINE
ZIPPED = gzip.compress(LINE.encode())
SPREAD = gzip.compress((LINE + random.Random(1).randbytes(300).hex().upper()).encode())
DEEP = ZIPPED
for _ in range(12):
    DEEP = gzip.compress(DEEP)
WHOLE = {
    "unprintable": base64.b64encode(STRANGE.encode()).decode(),
    "not UTF-8": base64.b64encode(b"\xe9t\xe9 " + LINE.encode()).decode(),
    "not UTF-8, percent": "%E9%20" + urllib.parse.quote(LINE, safe=""),
}
DEEPER = {
    "path": "/path/" + base64.b64encode(LINE.encode()).decode(),
    "id": "id_" + base64.b64encode(LINE.encode()).decode(),
    "glued": "x" + base64.b64encode(LINE.encode()).decode(),
    "wrapped": "\n".join(re.findall(".{1,64}", base64.b64encode(SPREAD).decode())),
    "percent gzip": urllib.parse.quote(ZIPPED, safe=""),
    "escaped gzip": "".join(f"\\x{b:02x}" for b in ZIPPED),
    "gzip, 13 deep": base64.b64encode(DEEP).decode(),
}


@pytest.mark.parametrize("name", [*WHOLE, *DEEPER])
def test_every_layer_is_entered(name):
    inner = (WHOLE | DEEPER)[name]
    text = f"some words before {inner}"
    _, found = secrets.scan(text, text.encode())
    assert {"assign", "hex"} <= {secrets.KINDS[k] for k, _, _ in found}
    assert all(18 <= a < b <= len(text) for _, a, b in found)


def test_long_layers_are_read_in_pieces():
    words = " ".join(f"w{i}" for i in range(3000))
    text = base64.b64encode(gzip.compress(f"{words} {LINE} {words}".encode())).decode()
    assert {k for k, _, _ in secrets.unwrap(text, layer_bytes=5000)} == {0, 2}


def test_escape_spans_are_exact():
    text = "é x %41KIA" + "Z9" * 8 + " end"
    base, found = secrets.scan(text, text.encode())
    assert base == [] and found == [(1, 4, 4 + 6 + 16)]
    assert secrets.masked(text, found) == "é x [secret] end"


def test_base_spans():
    text = f"{KEY} api-key: x Token: 'abcdef' PASSWD=abc secret=abc123\n{HEX}"
    base, _ = secrets.scan(text, text.encode())
    assert secrets.spelled(base) == "access:0:20,assign:32:46,assign:59:72,hex:73:105"


def test_chains_of_escapes_take_linear_time():
    secret = "AKIA" + "Z9" * 8
    for chain, code in (("%" + "25" * 500_000, "41"), ("\\" + "u005c" * 200_000, "u0041"), ("&" + "#38;" * 200_000, "#65;")):
        text = f"é {chain}{code}{secret[1:]} end"
        start = time.perf_counter()
        _, found = secrets.scan(text, text.encode())
        assert time.perf_counter() - start < 60
        assert (1, 2, len(text) - 4) in found


def test_compressed_characters_are_opened():
    for packed in (gzip.compress(LINE.encode()), zlib.compress(LINE.encode())):
        text = "a " + packed.decode("latin-1") + " b"
        assert {"assign", "hex"} <= {secrets.KINDS[k] for k, _, _ in secrets.scan(text, text.encode())[1]}


def test_base_spans_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    patterns = [
        (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    ]
    rows, seen = secrets.find_secrets(docs).collect(), 0
    for r in rows:
        want = [(m.start(), k, m.end()) for k, (p, part, least) in enumerate(patterns) for m in re.finditer(p, texts[r.doc_id]) if len(m[part]) >= least]
        assert r.base_spans == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(want))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
        seen += len(want)
    assert seen > 5


def test_cycles_end():
    text = "%2541 " * 50 + base64.b64encode(b"%25" * 20).decode()
    assert secrets.unwrap(text) == set()


@pytest.fixture(scope="module")
def processor():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)


def test_pieces_equal_the_library(processor, texts):
    chance = random.Random(3)
    parts = [" ", "  ", "a", "the", "ing", "\n", "é", "日", "🙂", "!!", "http", "://", "\t", "   ", "▁", "0", " un", "token"]
    every = list(texts.values()) + ["".join(chance.choice(parts) for _ in range(chance.randint(0, 40))) for _ in range(800)]
    every += ["a" * 3000, " " * 50, "\n\n \n  x", "", None]
    encoder = pieces.Encoder(pieces.DEFAULT_MODEL)
    for _ in range(2):  # the second time from the cache
        ids, ends = encoder.encode(every)
        for i, x in enumerate(every):
            own = ids[ends[i] : ends[i + 1]].tolist()
            assert own == processor.encode(x or "")
            # A piece writes a space as U+2581, so the character itself comes back as a space, here and in the library.
            assert encoder.decode(own) == processor.decode(own) == (x or "").replace("▁", " ")


def test_long_words_are_cut_where_no_piece_spans(processor):
    chance = random.Random(4)
    long = ["".join(chance.choice(abc) for _ in range(20_000)) for abc in ("ABCDefgh0123+/", "日本語中文字", "ab", "the ing", "🙂é")]
    long += ["a" * 5000 + "日" + "b" * 5000, "function(){return" * 400]
    vocab = pieces.vocabulary(pieces.DEFAULT_MODEL)
    assert all("".join(pieces.cut_long(w, vocab)) == w for w in long)
    assert max(map(len, pieces.cut_long(long[0], vocab))) <= pieces.LONG
    encoder = pieces.Encoder(pieces.DEFAULT_MODEL)
    ids, ends = encoder.encode(long)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [processor.encode(w) for w in long]


def test_only_the_space_mark_is_no_round_trip(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a▁b"), (3, " lead"), (4, "▁"), (5, None)], "doc_id long, text string")
    assert {r.doc_id: r.round_trip for r in pieces.encode_checked(docs).collect()} == {1: True, 2: False, 3: True, 4: False, 5: True}


def test_suffix_array_and_prefixes():
    chance = random.Random(5)
    for _ in range(500):
        x = [chance.randint(1, chance.choice([1, 2, 3, 6])) for _ in range(chance.randint(0, 40))] + [0]
        order = repeats.suffix_array(x)
        assert order == sorted(range(len(x)), key=lambda i: x[i:])


def brute_repeats(texts, length):
    raw = [t.encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((sum(gone), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("limit", [600, 2])
def test_repeats(spark, limit):
    chance = random.Random(limit)
    rand = lambda n: "".join(chance.choice("abcdefgh ") for _ in range(n))
    passage, base = rand(700), rand(2000)
    texts = [rand(50) + passage[k : 600 + k // 2] + rand(80) for k in range(0, 60, 3)] + [base, base, base[:900] + "X" + base[901:], base[300:1200]]
    texts += ["ab" * 900, passage + rand(10) + passage, "é" * 450, rand(399), "z" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in repeats.remove_repeats(docs, bucket_limit=limit).collect()}
    for i, (removed, kept) in enumerate(brute_repeats(texts, 400)):
        assert (got[i].n_removed, bytes(got[i].kept)) == (removed, kept), i


def test_sampling_agrees_with_similarity():
    chance = np.random.default_rng(1)
    hashes = np.sort(chance.integers(0, 1 << 63, 900).astype(np.uint64))
    left, right = hashes[:800], hashes[100:]
    sampler, same = near_duplicates.Sampler(), 0
    one = np.array([0])
    tries = 30
    for t in range(tries):
        move = near_duplicates.U(t * 7919)
        a, b = (near_duplicates.mixed(x + move) for x in (left, right))
        weights = [np.where(x % near_duplicates.U(3) == 0, 1.3, 2.0) for x in (a, b)]
        same += (sampler.bands(a, weights[0], one) == sampler.bands(b, weights[1], one)).sum()
    share = same / (tries * near_duplicates.BANDS)
    assert share == pytest.approx((700 / 900) ** near_duplicates.ROWS, abs=0.1)


def test_near_duplicates(spark):
    chance = random.Random(2)
    word = lambda: "".join(chance.choice("abcdefghijkl") for _ in range(6))
    rows, want = [], {}
    for g in range(12):
        base = [word() for _ in range(200)]
        for c in range(6):
            own = list(base)
            for _ in range(c % 3):
                own[chance.randrange(200)] = word()
            rows.append((len(rows), " ".join(own)))
            want[len(rows) - 1] = g * 6
    for _ in range(30):
        rows.append((len(rows), " ".join(word() for _ in range(150))))
        want[len(rows) - 1] = len(rows) - 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()} == want


def test_similarity_of_pairs():
    words = [f"w{i}" for i in range(50)]
    left, right = " ".join(words), " ".join([*words[:45], "x", *words[46:]])
    shares = np.zeros(near_duplicates.CELLS, np.float32)
    got = near_duplicates.similarity(pa.array([left, "", left]), pa.array([right, "", left.upper()]), shares)
    assert got[0] == pytest.approx(41 / 51) and got[1] == got[2] == 1


def test_url_models_learn(spark):
    rows = [(i, f"http://good{i}.org/fr/clean/{i}") for i in range(80)] + [(100 + i, f"http://spam{i}.net/xxx/{i}") for i in range(80)]
    rows += [(300, "http://good999.com/clean/1"), (301, "http://spam999.com/xxx/1")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[300].rule, got[300].verdict, got[301].verdict) == (None, "allow", "block")
    assert got[0].rule == "org/fr/" and got[100].rule == "net/"


def test_longest_rule_wins(spark):
    rows = [(1, "http://x.example.net/en/a"), (2, "http://x.example.net/de/a"), (3, "http://badexample.net/en/"), (4, "http://example.com/de/"), (5, "http://example.net"), (6, "http://a.org/fr")]
    got = {r.page_id: r.rule for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: "example.net/en/", 2: "net/", 3: "net/", 4: "example.com/de/", 5: None, 6: None}


def test_page_parts(spark):
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body><div class='top menu'>m</div><header>h</header>"
        "<div id=content><h1>Head</h1><p>First <a href='#'>link</a> text.<p>Second&nbsp;one<script>var x='</p>'</script></p>"
        "<div class='ad-box'>buy</div><form>f</form><ul><li>a<li>b</ul><aside>s</aside><section class=comments><p>c</p></section></div>"
        "<div class='cookie-notice'>k</div><footer>f</footer><!-- x --></body></html>"
    )
    rows = [(i, f"http://h.example/{i}", html.replace("Head", f"Head {i}")) for i in range(5)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Head {i}\nFirst link text.\nSecond one\na\nb" for i in range(5)}


def test_a_single_paragraph_is_not_the_slot(spark):
    html = "<html><body><article><h1>Head</h1><p>{}</p></article></body></html>".format("long text " * 200)
    other = "<html><body><div class=post><h1>Head</h1><div class=text><p>{}</p></div></div></body></html>".format("long text " * 200)
    rows = [(1, "http://a/1", html), (2, "http://b/1", other)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Head\n" + ("long text " * 200).strip()}


def extracted(spark, htmls):
    rows = [(i, f"http://h.example/{i}", x) for i, x in enumerate(htmls)]
    return {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_a_heading_in_its_own_element_keeps_the_body(spark):
    title = "<html><body><div class=page><div class=title><h1>Head {0}</h1></div><div class=text><p>Body {0}</p></div></div></body></html>"
    got = extracted(spark, [title.format(f"{i} " * 50) for i in range(5)])
    assert got == {i: f"Head {' '.join([str(i)] * 50)}\nBody {' '.join([str(i)] * 50)}" for i in range(5)}
    logo = "<html><body><div class=logo><h1>Site</h1></div><div class=text><h2>Head {0}</h2><p>Body {0}</p></div></body></html>"
    assert all(f"Head {i}\nBody {i}" in x for i, x in extracted(spark, [logo.format(i) for i in range(5)]).items())


def test_every_content_element_is_kept(spark):
    page = "<html><body><div class=lead><p>Lead {0}</p></div><div class=a><h1>Head {0}</h1><p>{1}</p></div><div class=b><p>Close {0}</p></div></body></html>"
    other = "<html><body><div class=a><h1>Head {0}</h1></div><table><tr><td>Cell {0}</td></tr></table></body></html>"
    got = extracted(spark, [page.format(i, f"long {i} " * 300) for i in range(9)] + [other.format(9)])
    assert [x.splitlines()[0::3] for i, x in got.items() if i < 9] == [[f"Lead {i}", f"Close {i}"] for i in range(9)]
    assert got[9] == "Head 9\nCell 9"


def test_texts_of_the_template_are_dropped(spark):
    # A menu, an advert in the article and comments with neutral names; a line that recurs among paragraphs stays.
    page = (
        "<html><body><div class=c7>Home <a>Shop</a> About</div><ul class=c1><li>One<li>Two</ul><div class=c2><h1>Head {0}</h1>{1}"
        "<p>Same line</p><div class=c8>Buy now</div></div><div class=c9><p>Leave a word</p></div></body></html>"
    )
    got = extracted(spark, [page.format(i, "".join(f"<p>Body {i} {k}</p>" for k in range(i % 4 + 1))) for i in range(12)])
    assert got == {i: "\n".join([f"Head {i}", *(f"Body {i} {k}" for k in range(i % 4 + 1)), "Same line"]) for i in range(12)}
    # Equal articles under different headings are no template.
    same = extracted(spark, [page.format(i, "<p>Equal</p>") for i in range(12)])
    assert all("Equal" in x and "Same line" in x for x in same.values())


def test_names_of_layouts_are_no_side_parts(spark):
    page = (
        "<html><body class=with-nav><div class='content has-sidebar'><div class='layout-with-header' id=no-comments><div class=section-header>"
        "<h2>Part {0}</h2></div><div class=related-work><p>Work {0}</p></div><div class=sidebar><article><p>Body {0}</p></article></div>"
        "<div class=ad-box>buy {0}</div>{1}</div></div></body></html>"
    )
    extra = "<div class=related><p>One page only</p></div>"
    got = extracted(spark, [page.format(i, extra if i == 4 else "") for i in range(9)])
    assert got == {i: f"Part {i}\nWork {i}\nBody {i}" + ("\nOne page only" if i == 4 else "") for i in range(9)}
    comments = "<body><header class=header><h1>Head {0}</h1></header><article><p>Body {0}</p></article><ol class=comments><li><article>No {0}</article></ol></body>"
    assert extracted(spark, [comments.format(i) for i in range(9)]) == {i: f"Head {i}\nBody {i}" for i in range(9)}


def test_every_query_gives_rows(spark):
    for name in ("op5_secret_scan", "op6_sentencepiece", "op7_url_filter", "op10_page_text"):
        assert QUERIES[name](spark, SF).count() > 0


def test_pages_do_not_depend_on_how_templates_reach_them(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    sent, shuffled = (pages.extract(table, broadcast_bytes=n) for n in (pages.BROADCAST_BYTES, 0))
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().toString()
    assert sorted(map(tuple, sent.collect()), key=str) == sorted(map(tuple, shuffled.collect()), key=str)
