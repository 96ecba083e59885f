"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: elements with their place (the path of open elements,
each with its class names) and short texts with theirs. Tokens of a host with
equal occurrence vectors (as often on each of its pages) form an equivalence class.
Vectors are compared by fingerprints that Spark adds up, so no group of pages, however large,
meets in one task. A short text belongs to the template if it lies in a class of enough
tokens, an element among them, or is on nearly every page that has its element, and if enough different
pages hold it. It must nest in the template too: a paragraph, list item or heading only counts
where its element is as often on each page, so a line that recurs in flowing text stays.
All blocks that are neither template nor in menus, headers, footers, asides, notices, adverts, forms and
comments are the main text, wherever they stand. Such a part is known by its tag or role, or by a whole
class name or id that more than one page has; what holds an h1, main or the article is none.

Pages with the same texts apart from headings are one page in "different": equal articles on many pages stay.

Null or empty html gives an empty text. Null urls are one host, the empty one. Repeated
rows are extracted each; extra columns are not looked at. Script, style and
comment content is never text. Blocks end at block elements and line breaks.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import U, map_batches, mixed, slices
from obsflow.sources.session import scratch_path

# Element kinds of HTML, and names of parts that are not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "title", "textarea", "select", "object")
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
SIDE = frozenset("nav header footer aside form head button dialog menu".split())
SIDE_NAMES = frozenset(
    "nav navbar navigation menu menus header footer sidebar aside ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies"
    " consent notice notices popup modal newsletter subscribe signup login breadcrumb breadcrumbs pagination pager share sharing social related"
    " comment comments respond reply replies disqus toolbar widget".split()
)
#: Words that may stand beside them in a name: a part's box, place or items.
SIDE_WORDS = SIDE_NAMES | frozenset(
    "box boxes bar bars block blocks area zone wrap wrapper container inner outer holder item items list link links site main primary secondary"
    " top bottom left right global mobile desktop sticky fixed posts stories articles body form buttons button icons alert icon toggle group unit"
    " col column row text count".split()
)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
CLOSES = {"p": "p", "li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
CLOSE_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(" + "|".join(RAW) + r""")\b(?:"[^"]*"|'[^']*'|[^'">])*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|([^<]+|<)""",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[^A-Za-z]+")

MAIN = frozenset(("article", "main", "h1"))
#: The page's own root elements are never a side part, whatever they are called.
ROOTS = MAIN | {"html", "body"}
_NUMBER = re.compile(r"[-_]\d+")

#: Texts up to so many characters are tokens.
SHORT = 200
#: A class has so many tokens, and is on so many different pages and this share of the host's pages.
LEAST_TOKENS, LEAST_PAGES, LEAST_SHARE = 3, 3, 0.01
#: Share of the pages with an element that makes a text part of it.
NEARLY_ALL = 0.9
#: The stored templates are broadcast up to so many bytes.
BROADCAST_BYTES = 64 << 20
FLOWING = frozenset("p li dd dt blockquote pre h1 h2 h3 h4 h5 h6 figcaption td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Element:
    """An open element: tag, path of the block elements down to it, the innermost of them, and whether it is or lies in a side part.

    ``named`` are its names that tell of a side part, ``apart`` says that its tag or role does; ``holds`` what
    main parts are in it: 1 for an h1 or main, 2 for an article.
    """

    __slots__ = ("apart", "block", "holds", "named", "outer", "path", "side", "tag")

    def __init__(self, tag: str, path: str, outer: Element | None, apart: bool = False, named: tuple[str, ...] = ()):
        self.tag, self.path, self.outer, self.apart, self.named = tag, path, outer, apart, named
        self.side, self.holds = False, 0
        self.block = outer.block if outer and tag in INLINE else self


@lru_cache(maxsize=100_000)
def _names_side(name: str) -> bool:
    """Whether a whole class name or id tells of a side part: one of its words does, and none of the others speaks of anything else."""
    words = [w for w in _PARTS.split(name) if len(w) > 1]
    return not SIDE_NAMES.isdisjoint(words) and SIDE_WORDS.issuperset(words)


def _opened(tag: str, attributes: str, outer: Element) -> Element:
    apart, names, named = tag in SIDE, [], []
    if attributes and not attributes.isspace():
        for m in _NAMES.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                apart = apart or value in SIDE_ROLES
            else:
                named += [f"{tag}.{n}" for n in _NUMBER.sub("", value).split() if _names_side(n)]
                if m[1].lower() == "class":
                    names += sorted(_NUMBER.sub("", value).split())
    return Element(tag, outer.path if tag in INLINE else f"{outer.path}/{'.'.join([tag, *names])}", outer, apart, tuple(named))


def parse(html: str, confirmed: frozenset[int] | None = None) -> list[tuple[str, Element, str]]:
    """Events of a page, its side parts settled: of those known by name only, the ones whose marks are confirmed (all for None)."""
    events = list(read(html))
    elements = [e for kind, e, _ in events if kind == "open"]
    for e in elements:
        if e.tag in MAIN:
            outer, bit = e.outer, 2 if e.tag == "article" else 1
            while outer and not outer.holds & bit:
                outer.holds |= bit
                outer = outer.outer

    def settle(keep: int) -> None:
        for e in elements:
            own = e.apart or any(confirmed is None or _mark(n) in confirmed for n in e.named)
            e.side = e.outer.side or (own and e.tag not in ROOTS and not e.holds & keep)

    # What holds the h1 or main is no side part; nor is what holds the page's articles, unless others lie outside, as with comments.
    settle(1)
    if not any(e.tag in MAIN and not e.side for e in elements):
        settle(3)
    return events


def read(html: str) -> Iterator[tuple[str, Element, str]]:
    """Events of a page: ``open`` elements, ``text`` in its element, and ``break`` between blocks."""
    stack = [Element("", "", None)]
    for m in _TOKEN.finditer(html):
        text = m[5]
        if text is not None:
            yield "text", stack[-1], text
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if at:
                del stack[at:]
            if tag not in INLINE:
                yield "break", stack[-1], tag
            continue
        if tag in INLINE and tag not in VOID:
            stack.append(_opened(tag, m[4], stack[-1]))
            yield "open", stack[-1], tag
            continue
        if tag in VOID:
            if tag not in INLINE:
                yield "break", stack[-1], tag
            continue
        closes = CLOSES.get(tag)
        if tag in CLOSE_P or closes:
            # An open paragraph (or list item, cell, ...) ends here, and the inline elements in it.
            enders = set((closes or "").split()) | ({"p"} if tag in CLOSE_P else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in enders:
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE and stack[i].tag not in enders:
                    break
        stack.append(_opened(tag, m[4], stack[-1]))
        yield "open", stack[-1], tag
        yield "break", stack[-1], tag


def blocks(events: list[tuple[str, Element, str]]) -> Iterator[tuple[Element, str]]:
    """Text blocks outside side parts, each with the block element it begins in."""
    held: list[str] = []
    at = None
    for kind, element, text in events:
        if kind == "break":
            if held and (whole := _spaced(held)):
                yield at, whole
            held.clear()
        elif kind == "text" and not element.side:
            # White space before the first word belongs to no element.
            if not held and text.isspace():
                continue
            at = at if held else element.block
            held.append(text)
    if held and (whole := _spaced(held)):
        yield at, whole


def _spaced(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def _mark(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


PAGE, ELEMENT, TEXT, PART = range(4)


def tokens(html: str) -> Iterator[tuple[int, int, int | None, bool, int]]:
    """Tokens of a page: kind, mark, mark of its element (texts), does it flow, count; first the page itself, marked by its texts."""
    events = parse(html)
    elements = [e for kind, e, _ in events if kind == "open"]
    opened: Counter[str] = Counter(e.path for e in elements if not e.side and e.block is e)
    parts = Counter(n for e in elements for n in e.named)
    texts: Counter[tuple[str, bool, str]] = Counter()
    body = hashlib.blake2b(digest_size=8)
    for element, text in blocks(events):
        if element.tag not in HEADINGS:
            body.update(text.encode("utf-8", "surrogatepass") + b"\n")
        if len(text) <= SHORT:
            texts[element.path, element.tag in FLOWING, text] += 1
    yield PAGE, int.from_bytes(body.digest(), "little", signed=True), None, False, 1
    for path, count in opened.items():
        yield ELEMENT, _mark(path), None, False, count
    for name, count in parts.items():
        yield PART, _mark(name), None, False, count
    for (path, flowing, text), count in texts.items():
        yield TEXT, _mark(path, text), _mark(path), flowing, count


def _host(url: str) -> str:
    """SQL: host of a url column, empty without one."""
    rest = f"substr({url}, instr({url}, '://') + 3)"
    return f"CASE WHEN {url} IS NOT NULL AND instr({url}, '://') > 0 THEN lower(regexp_extract({rest}, '^[^/?#]*', 0)) ELSE '' END"


def _different(side: str = "") -> str:
    """SQL: about how many different pages set the bits of two 64-bit maps (linear counting)."""
    count = lambda c: f"-64 * ln(1 - least(bit_count({side}{c}), 63.5) / 64)"
    return f"greatest({count('bits_a')}, {count('bits_b')})"


def templates(rows: DataFrame) -> DataFrame:
    """Per host ``template``, the marks of its template's texts, and ``parts``, those of names of side parts that more than one page has.

    ``parts`` is null for hosts of too few different pages to tell. From ``host``, ``page`` (a hash) and ``html``.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "kind", "token", "of", "flows", "n", "mark", "bit_a", "bit_b"]
        for piece in slices(batches, "html"):
            found: list[tuple] = []
            hosts, sizes, bodies = piece["host"].to_pylist(), [], []
            for html in piece["html"].to_pylist():
                own = list(tokens(html))
                # The page is one token that every page has, whatever its texts.
                bodies.append(own[0][1])
                sizes.append(len(own))
                found.append((PAGE, 0, None, False, 1))
                found += own[1:]
            if not found:
                continue
            kind, token, of, flows, n = zip(*found, strict=True)
            sizes_ = np.array(sizes)
            body = mixed(np.repeat(np.array(bodies, np.int64).view(U), sizes_))
            page = np.repeat(np.array(piece["page"].to_pylist(), np.int64).view(U), sizes_)
            marks = mixed(page * U(1_000_003) + np.array(n, U)) % U(1_000_000_007)
            bits = [(U(1) << (body >> U(shift)) % U(64)).view(np.int64) for shift in (0, 32)]
            arrays = [pa.array([h for h, k in zip(hosts, sizes, strict=True) for _ in range(k)], pa.string()), pa.array(kind, pa.int8())]
            arrays += [pa.array(token, pa.int64()), pa.array(of, pa.int64()), pa.array(flows, pa.bool_()), pa.array(n, pa.int64())]
            arrays += [pa.array(x) for x in (marks.astype(np.int64), *bits)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "host string, kind byte, token long, of long, flows boolean, n long, mark long, bit_a long, bit_b long"
    vectors = map_batches(rows.select("host", "page", "html"), work, schema).groupBy("host", "kind", "token").agg(
        F.max("of").alias("of"), F.max("flows").alias("flows"), F.count("*").alias("pages"), F.sum("n").alias("n"),
        F.sum(F.expr("double(n) * n")).alias("squares"), F.sum("mark").alias("vector"), F.bit_or("bit_a").alias("bits_a"), F.bit_or("bit_b").alias("bits_b"),
    )
    # What too few pages hold is of no class; the rest is worked out once.
    path = scratch_path(rows.sparkSession, "pages-vectors")
    vectors.where(f"kind = {PAGE} OR (pages >= 2 AND {_different()} > 1.5)").write.parquet(path)
    vectors = rows.sparkSession.read.parquet(path)
    whole = vectors.where(f"kind = {PAGE}").selectExpr("host", f"greatest({LEAST_PAGES}, {LEAST_SHARE} * pages) AS least")
    enough = f"{_different()} > {LEAST_PAGES} - 0.5"
    common = vectors.where(f"kind IN ({ELEMENT}, {TEXT}) AND {enough}").join(whole, "host").where("pages >= least")
    classes = common.groupBy("host", "pages", "vector").agg(F.count("*").alias("tokens"), F.count_if(F.expr(f"kind = {ELEMENT}")).alias("elements"))
    elements = common.where(f"kind = {ELEMENT}").selectExpr(
        "host", "token AS of", "pages AS with_element", "squares * pages - double(n) * n <= 0.01 * n * n AS regular", f"{_different()} AS different"
    )
    nested = (
        common.where(f"kind = {TEXT}")
        .join(elements, ["host", "of"])
        .where("regular OR NOT flows")
        .join(classes, ["host", "pages", "vector"])
        .where(
            f"(tokens >= {LEAST_TOKENS} AND elements > 0)"
            f" OR (pages >= {NEARLY_ALL} * with_element AND {_different()} >= {NEARLY_ALL} * least(different, 64))"
        )
    )
    # A page's share of the tokens bounds how many a host can have on LEAST_SHARE of its pages.
    texts = nested.groupBy("host").agg(F.collect_list("token").alias("template"))
    parts = vectors.where(f"kind = {PART}").groupBy("host").agg(F.collect_list("token").alias("names"))
    hosts = vectors.where(f"kind = {PAGE}").selectExpr("host", f"{enough} AS enough")
    return hosts.join(texts, "host", "left").join(parts, "host", "left").selectExpr(
        "host", "template", "CASE WHEN enough THEN coalesce(names, array()) END AS parts"
    )


def main_text(html: str, template: frozenset[int], parts: frozenset[int] | None) -> list[str]:
    """Blocks of a page that are neither side parts nor texts of the template."""
    return [text for element, text in blocks(parse(html, parts)) if not template or len(text) > SHORT or _mark(element.path, text) not in template]


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: ``key``, ``url`` and ``text``. All hosts' templates are sent to every task while they take ``broadcast_bytes`` or fewer."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.selectExpr("key", "url", "html", f"{_host('url')} AS host", "xxhash64(key, url) AS page")
    # Few marks a host go to the pages; beyond the bound both sides are shuffled, and a hot host's pages are split by adaptive execution.
    path = scratch_path(pages.sparkSession, "pages-templates")
    templates(rows).write.parquet(path)
    known = pages.sparkSession.read.parquet(path)
    held = "100 + length(host) + 8 * (greatest(size(template), 0) + greatest(size(parts), 0))"
    small = known.selectExpr(f"coalesce(sum({held}), 0) AS bytes").first().bytes <= broadcast_bytes
    joined = rows.join(F.broadcast(known) if small else known, "host", "left")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "html"):
            texts, known = [], {}
            for i, (host, body) in enumerate(zip(piece["host"].to_pylist(), piece["html"].to_pylist(), strict=True)):
                if host not in known:
                    parts = piece["parts"][i].as_py()
                    known[host] = frozenset(piece["template"][i].as_py() or ()), None if parts is None else frozenset(parts)
                texts.append("\n".join(main_text(body, *known[host])))
            yield pa.RecordBatch.from_arrays([piece["key"], piece["url"], pa.array(texts, pa.string())], names=["key", "url_", "text"])

    kind = rows.schema["key"].dataType.simpleString()
    result = map_batches(joined.select("key", "url", "html", "host", "template", "parts"), work, f"key {kind}, url_ string, text string")
    return result.select(F.col("key").alias(key), F.col("url_").alias(url), "text")
