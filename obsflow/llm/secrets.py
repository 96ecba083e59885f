"""Secret scan with a recursive decoding worklist.

Every text is searched for assignments, access keys and long hexadecimal runs.
Texts with anything that looks encoded go on a worklist: percent escapes and
Unicode escapes are undone over the whole layer; base64 runs, wrapped ones joined,
at each of the four alignments, and gzip, zlib, bzip2 or xz data wherever it begins
become layers of their own, and every layer is searched and unwrapped again until
none is new. A layer seen before at the same place is not entered again, so cycles
end. Bytes that are not UTF-8 are kept one to one (surrogate escapes): the patterns
alone decide what a secret is. Each character of a layer knows its range in the
original text; a match deeper down is reported there.

Null text counts as empty and has no spans. Spans are in code points, end
exclusive, without repeats. Texts are scanned row by row, depth first: memory is
bounded by one text and, per level, ``layer_bytes`` of a decompressed layer (a longer
one is read as a stream of pieces that overlap by half).
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import map_batches, slices, text_bytes

# What counts as a secret, and the order of kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, so the same as taking all runs and dropping short ones
LEAST = {"assign": 6, "access": 20, "hex": 24}
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LAYER_BYTES = 64_000_000
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: An escape escaped again and again: what begins it, and the unit that each level adds.
_CHAINS = tuple((lead, unit, re.compile(f"{re.escape(lead)}(?:{unit}){{9,}}")) for lead, unit in (("%", "25"), ("\\", "u005[cC]"), ("\\", "x5[cC]"), ("&", "#38;|#x26;")))
_CHAIN_LEFT = 4
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_NEXT_LINE = re.compile(r"(?:\r?\n|\\r\\n|\\n)[ \t]*([A-Za-z0-9+/_-]+={0,2})(?=[ \t]*(?:[\r\n\\\"'`,;)<]|\Z))")
_AFTER_MARK = re.compile(r"(?<=[/_-])(?![/_-])")
_OPENERS = {
    b"\x1f": lambda: zlib.decompressobj(31),
    b"x": lambda: zlib.decompressobj(),
    b"B": bz2.BZ2Decompressor,
    b"\xfd": lzma.LZMADecompressor,
}
_COMPRESSED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\0", re.DOTALL)
#: How these begin where bytes are spelled as characters.
_MARKS = ("\x1f\x8b\x08", "x\x01", "x^", "x\x9c", "x\xda", "BZh", "\xfd7zXZ")
_HEX_CLASS = bytes(0x78 if chr(c) in "0123456789abcdef" else 0x20 for c in range(256))
_BASE64_CLASS = bytes(0x78 if re.match(r"[A-Za-z0-9+/_-]", chr(c)) else 0x20 for c in range(256))

Span = tuple[int, int, int]


def matches(text: str) -> Iterator[Span]:
    """(kind, start, end) of the secrets in one layer, by the base patterns."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            yield 0, m.start(), m.end()
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= LEAST[KINDS[kind]]:
                yield kind, m.start(), m.end()


class _Layer:
    """A text and, for each of its characters, the range of the original it came from."""

    def __init__(self, text: str, begin: list[int] | range, end: list[int] | range):
        self.text, self.begin, self.end = text, begin, end

    def place(self, start: int, stop: int) -> tuple[int, int]:
        return min(self.begin[start:stop]), max(self.end[start:stop])


class _Inner(_Layer):
    """A layer all of whose characters came from the same range."""

    def __init__(self, text: str, low: int, high: int):
        self.text, self.whole = text, (low, high)

    def place(self, start: int, stop: int) -> tuple[int, int]:
        return self.whole


def _as_text(data: bytes) -> str:
    return data.decode("utf-8", "surrogateescape")


def _replaced(layer: _Layer, runs: Iterable[tuple[int, int, str, list[int]]]) -> _Layer | None:
    """The layer with each run's text put in; ``widths`` tells how many characters each new one took."""
    parts: list[str] = []
    begin: list[int] = []
    end: list[int] = []
    last = 0
    for start, stop, new, widths in runs:
        parts += layer.text[last:start], new
        before = last
        last = stop
        if isinstance(layer, _Inner):
            continue
        begin += layer.begin[before:start]
        end += layer.end[before:start]
        at = start
        for width in widths:
            low, high = layer.place(at, at + width)
            begin.append(low)
            end.append(high)
            at += width
    if not parts:
        return None
    parts.append(layer.text[last:])
    if isinstance(layer, _Inner):
        return _Inner("".join(parts), *layer.whole)
    return _Layer("".join(parts), begin + list(layer.begin[last:]), end + list(layer.end[last:]))


def _chain_runs(text: str) -> Iterator[tuple[int, int, str, list[int]]]:
    """Long chains of escaped escapes, all but their last levels undone at once: one level after the other would take the square of their length."""
    found = []
    for lead, unit, pattern in _CHAINS:
        if lead in text:
            for m in pattern.finditer(text):
                sizes = [u.end() - u.start() for u in re.finditer(unit, m[0])]
                left = sum(sizes[-_CHAIN_LEFT:])
                found.append((m.start(), m.end(), lead + m[0][len(m[0]) - left :], [len(m[0]) - left, *[1] * left]))
    yield from sorted(found)


def _percent_runs(text: str) -> Iterator[tuple[int, int, str, list[int]]]:
    for m in _PERCENT.finditer(text):
        new = _as_text(binascii.unhexlify(m[0].replace("%", "")))
        yield m.start(), m.end(), new, [3 * len(c.encode("utf-8", "surrogateescape")) for c in new]


def _escape_runs(text: str) -> Iterator[tuple[int, int, str, list[int]]]:
    for m in _ESCAPE.finditer(text):
        code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        if code < 0xD800 or 0xDFFF < code < 0x110000:
            yield m.start(), m.end(), chr(code), [m.end() - m.start()]


def _streamed(data: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """Decompressed pieces of at most ``most`` bytes, each but the first begun with half of the one before, and how many bytes were read."""
    opener, kept, rest = _OPENERS[data[:1]](), b"", data
    while True:
        try:
            new = opener.decompress(rest, most - len(kept))
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return
        if new:
            yield kept + new, len(data) - len(opener.unused_data)
        rest = getattr(opener, "unconsumed_tail", b"")
        if opener.eof or not new:
            return
        kept = (kept + new)[-(most // 2) :]


def _compressed_texts(text: str, most: int) -> Iterator[tuple[int, int, str]]:
    """Of compressed data anywhere in a layer: its bytes as such, and those spelled as characters up to U+00FF."""
    try:
        views = [text.encode("utf-8", "surrogateescape")]
    except UnicodeEncodeError:
        views = [text.encode("utf-8", "surrogatepass")]
    if not text.isascii():
        views.append(text.encode("latin-1", "replace"))
    for i, data in enumerate(views):
        place = (lambda n, data=data: len(_as_text(data[:n]))) if i == 0 else (lambda n: n)
        for m in _COMPRESSED.finditer(data):
            for new, size in _streamed(data[m.start() :], most):
                yield min(place(m.start()), len(text) - 1), min(place(m.start() + size), len(text)), _as_text(new)


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Base64 runs, those wrapped over lines of one width (the last may be shorter) joined."""
    done = 0
    for m in _BASE64.finditer(text):
        if m.start() < done:
            continue
        body, stop, width = [m[0]], m.end(), len(m[0])
        while not body[-1].endswith("=") and (n := _NEXT_LINE.match(text, stop)) and len(n[1]) <= width:
            body.append(n[1])
            stop, whole = n.end(), len(n[1]) == width
            if not whole:
                break
        done = stop
        yield m.start(), stop, "".join(body)


def _base64_texts(text: str) -> Iterator[tuple[int, int, str]]:
    for start, stop, run in _base64_runs(text):
        body = run.rstrip("=")
        # A value glued to something before it begins after a mark, or anywhere; its alignment is one of four.
        begins: dict[int, int] = {0: 0}
        for m in _AFTER_MARK.finditer(body):
            begins.setdefault(m.start() % 4, m.start())
            if len(begins) == 4:
                break
        for k in (1, 2, 3):
            begins.setdefault(k, k)
        for begin in begins.values():
            part = body[begin:].replace("-", "+").replace("_", "/")
            part = part[: len(part) - (len(part) % 4 == 1)]
            yield start + begin, stop, _as_text(base64.b64decode(part + "=" * (-len(part) % 4)))


def _unwrapped(layer: _Layer, layer_bytes: int) -> Iterator[_Layer]:
    """The layers directly below one."""
    x = _replaced(layer, _chain_runs(layer.text))
    if x is not None:
        yield x
    else:
        for runs in (_percent_runs, _escape_runs):
            x = _replaced(layer, runs(layer.text))
            if x is not None:
                yield x
    for start, stop, inner in _base64_texts(layer.text):
        yield _Inner(inner, *layer.place(start, stop))
    if not layer.text.isascii() or _may_be_compressed(layer.text):
        for start, stop, inner in _compressed_texts(layer.text, layer_bytes):
            yield _Inner(inner, *layer.place(start, stop))


def unwrap(text: str, layer_bytes: int = LAYER_BYTES) -> set[Span]:
    """Spans of all layers below the text itself, in places of the text."""
    seen, found = {(hash(text), 0, len(text))}, set()
    todo = [_unwrapped(_Layer(text, range(len(text)), range(1, len(text) + 1)), layer_bytes)]
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
        elif layer.text:
            mark = (hash(layer.text), layer.place(0, 1)[0], layer.place(len(layer.text) - 1, len(layer.text))[1])
            if mark not in seen:
                seen.add(mark)
                found.update((kind, *layer.place(a, b)) for kind, a, b in matches(layer.text))
                todo.append(_unwrapped(layer, layer_bytes))
    return found


def _may_be_compressed(text: str) -> bool:
    return any(mark in text for mark in _MARKS)


def _looks_encoded(text: str, raw: bytes) -> bool:
    return (
        ("%" in text and _PERCENT.search(text) is not None)
        or (("\\" in text or "&#" in text) and _ESCAPE.search(text) is not None)
        or _may_be_compressed(text)
        or b"x" * 16 in raw.translate(_BASE64_CLASS)
    )


def _may_match(text: str, raw: bytes) -> bool:
    if "AKIA" in text or b"x" * LEAST["hex"] in raw.translate(_HEX_CLASS):
        return True
    low = text.lower()
    return any(w in low for w in WORDS)


def scan(text: str, raw: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, each by start, then kind, then end."""
    order = lambda spans: sorted(spans, key=lambda s: (s[1], s[0], s[2]))
    base = order(matches(text)) if _may_match(text, raw) else []
    return base, order(unwrap(text) | set(base)) if _looks_encoded(text, raw) else base


def spelled(spans: list[Span]) -> str:
    """``kind:start:end`` of each, comma-joined."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span], mask: str = "[secret]") -> str:
    """The text with every stretch covered by spans replaced once."""
    parts, last = [], 0
    ranges: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if ranges and a < ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], b)
        else:
            ranges.append([a, b])
    for a, b in ranges:
        parts += text[last:a], mask
        last = b
    return "".join([*parts, text[last:]])


def _scanned(column: pa.Array) -> Iterator[tuple[str | None, list[Span], list[Span]]]:
    data, offsets = text_bytes(column)
    raw = data.tobytes()
    for i, text in enumerate(column.to_pylist()):
        yield (text, *(scan(text, raw[offsets[i] : offsets[i + 1]]) if text else ([], [])))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, base counts by kind, ``base_spans`` and ``spans``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = ["key", "n_assign", "n_access", "n_hex", "base_spans", "spans"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            found = [(base, every) for _, base, every in _scanned(piece["text"])]
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in range(3)]
            columns = [*(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array([spelled(x[i]) for x in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([piece["key"], *columns], names=names)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    return map_batches(rows, work, schema).withColumnRenamed("key", key)


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with every secret in ``text`` masked; null stays null."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            new = [masked(t, spans) if spans else t for t, _, spans in _scanned(piece[text])]
            at = piece.schema.get_field_index(text)
            yield piece.set_column(at, piece.schema.field(at), pa.array(new, piece.schema.field(at).type))

    return map_batches(docs, work, docs.schema)
