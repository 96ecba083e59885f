"""Fill-in-the-middle training text: two cuts per text, the parts put in another order.

The places where a text may be cut (before each of its units, and at its end) are
byte offsets. Those of a whole slice of texts form one :class:`BoundarySet`, kept the way
compressed bitmaps are: offsets with the same upper bits share a container, which
is a sorted array, a bitmap or a list of runs, whichever is smallest, and
cumulative cardinalities tell in which container the n-th boundary lies. A text's two cuts are
two ranks, so one container search and one select within it give both byte offsets, for
all texts of a slice at once; no text is decoded.

What is cut where depends on the key and the seed only, not on order or partitions.
Null text counts as empty; an empty text, one that holds a marker, and the share
of texts left alone come out ``plain``, as they are. A null key counts as empty text in the
hash. Repeated rows give equal rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import SPACES, map_batches, slices, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS


class ArrayContainer:
    """Few members: their sorted low parts."""

    def __init__(self, member: np.ndarray):
        self.values = np.flatnonzero(member).astype(np.uint16)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.values[ranks].astype(np.int64)

    def rank(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.values, places, side="left")


class RunContainer:
    """Few runs of neighbours: where they start, and how many members lie before each."""

    def __init__(self, member: np.ndarray):
        edges = np.diff(np.concatenate([[False], member, [False]]).astype(np.int8))
        self.starts = np.flatnonzero(edges == 1)
        self.before = np.append(0, np.cumsum(np.flatnonzero(edges == -1) - self.starts))

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, side="right") - 1
        return self.starts[run] + ranks - self.before[run]

    def rank(self, places: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.starts, places, side="right") - 1
        inside = np.minimum(places - self.starts[run], self.before[run + 1] - self.before[run])
        return np.where(run < 0, 0, self.before[run] + inside)


class BitmapContainer:
    """Many members without long runs: a bit per place, and how many members lie before each byte."""

    def __init__(self, member: np.ndarray):
        self.bytes = np.packbits(member, bitorder="little")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.bytes).astype(np.int64)))

    def select(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.before, ranks, side="right") - 1
        bits = np.unpackbits(self.bytes[at][:, None], axis=1, bitorder="little")
        passed = np.cumsum(bits, axis=1) > (ranks - self.before[at])[:, None]
        return at * 8 + passed.argmax(axis=1)

    def rank(self, places: np.ndarray) -> np.ndarray:
        at = places >> 3
        below = np.append(self.bytes, np.uint8(0))[at] & ((1 << (places & 7)) - 1).astype(np.uint8)
        return self.before[at] + np.bitwise_count(below)


def container(member: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
    """The smallest container for the members that a mask of a chunk names."""
    sizes = {
        ArrayContainer: 2 * int(np.count_nonzero(member)),
        RunContainer: 4 * (int(np.count_nonzero(member[1:] & ~member[:-1])) + int(member[:1].sum())),
        BitmapContainer: CHUNK // 8,
    }
    return min(sizes, key=sizes.__getitem__)(member)


class BoundarySet:
    """A set of offsets with rank and select; chunks without members have no container."""

    def __init__(self, member: np.ndarray):
        chunks = [member[a : a + CHUNK] for a in range(0, len(member), CHUNK)]
        held = [(i, c) for i, c in enumerate(chunks) if c.any()]
        self.size = len(member)
        self.chunk = np.array([i for i, _ in held], np.int64)
        self.containers = [container(c) for _, c in held]
        self.before = np.append(0, np.cumsum([np.count_nonzero(c) for _, c in held])).astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """Offset of the member with each rank, counted from 0."""
        at = np.searchsorted(self.before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for i in np.unique(at):
            mine = np.flatnonzero(at == i)
            out[mine] = (self.chunk[i] << CHUNK_BITS) + self.containers[i].select(ranks[mine] - self.before[i])
        return out

    def rank(self, offsets: np.ndarray) -> np.ndarray:
        """How many members lie below each offset."""
        at = np.searchsorted(self.chunk, offsets >> CHUNK_BITS, side="left")
        out = self.before[at]
        inside = np.flatnonzero(np.append(self.chunk, -1)[at] == offsets >> CHUNK_BITS)
        for i in np.unique(at[inside]):
            mine = inside[at[inside] == i]
            out[mine] += self.containers[i].rank(offsets[mine] & (CHUNK - 1))
        return out


def character_starts(data: np.ndarray) -> np.ndarray:
    """Is there a code point that begins at this byte?"""
    return (data & 0xC0) != 0x80


def word_starts(data: np.ndarray) -> np.ndarray:
    """Does a word begin at this byte? What stands before a text's first word is part of its first unit."""
    space = SPACES[data]
    return ~space & np.append(True, space[:-1])


UNITS = {"characters": character_starts, "words": word_starts}


def boundaries(data: np.ndarray, offsets: np.ndarray, units: str) -> BoundarySet:
    """Starts of the units of all texts, and the end of the last; every text that is not empty starts a unit."""
    member = np.append(UNITS[units](data), True)
    begin = offsets[:-1][np.diff(offsets) > 0]
    if units == "words" and len(begin):
        # The blank start of a text belongs to its first word.
        first = np.searchsorted(np.flatnonzero(member), begin)
        member[np.flatnonzero(member)[first[first < member.sum() - 1]]] &= False
    member[begin] = True
    return BoundarySet(member)


def _hash_parts(key: str, seed: int) -> list[str]:
    digest = f"sha2(concat('{int(seed)}:', coalesce(CAST({key} AS STRING), '')), 256)"
    return [f"CAST(conv(substr({digest}, {8 * i + 1}, 8), 16, 10) AS BIGINT) AS h{i + 1}" for i in range(4)]


def transform(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    percent: int = 90,
    suffix_first: int = 20,
    units: str = "characters",
) -> DataFrame:
    """Per row: ``key``, ``n`` (units), ``form``, ``prefix_units``, ``middle_units`` (null if plain), ``output``.

    ``percent`` of the texts are cut, ``suffix_first`` percent of these in the order suffix,
    prefix, middle (``spm``), the others prefix, suffix, middle (``psm``). ``units`` are
    characters (code points) or words.
    """
    if units not in UNITS:
        raise ValueError(f"units are one of {', '.join(UNITS)}, not {units}")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.selectExpr("key", "text", *_hash_parts("key", seed))
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            yield _cut(piece, marks, percent, suffix_first, units)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n long, form string, prefix_units long, middle_units long, output string"
    return map_batches(rows, work, schema).withColumnRenamed("key", key)


def _cut(piece: pa.RecordBatch, marks: list[bytes], percent: int, suffix_first: int, units: str) -> pa.RecordBatch:
    data, offsets = text_bytes(piece["text"])
    found = boundaries(data, offsets, units)
    base = found.rank(offsets)
    n = np.diff(base)
    h = [piece[f"h{i}"].to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3, 4)]
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(first, second), np.maximum(first, second)
    # A text's last boundary is the start of what follows it.
    ranks = np.concatenate([base[:-1] + low, base[:-1] + high])
    cuts = found.select(ranks) if len(ranks) else np.zeros(0, np.int64)
    one, two = cuts[: len(n)], cuts[len(n) :]
    cut = (n > 0) & (h[2] % 100 < percent)
    spm = h[3] % 100 < suffix_first
    raw, p, s, m = data.tobytes(), *marks
    outputs, forms = [], []
    for a, b, i, k, go, back in zip(offsets[:-1].tolist(), offsets[1:].tolist(), one.tolist(), two.tolist(), cut.tolist(), spm.tolist(), strict=True):
        whole = raw[a:b]
        if not go or any(x in whole for x in marks):
            outputs.append(whole)
            forms.append("plain")
        elif back:
            outputs.append(b"".join((s, raw[k:b], p, raw[a:i], m, raw[i:k])))
            forms.append("spm")
        else:
            outputs.append(b"".join((p, raw[a:i], s, raw[k:b], m, raw[i:k])))
            forms.append("psm")
    plain = pa.array([f == "plain" for f in forms], pa.bool_())
    none = pa.scalar(None, pa.int64())
    columns = [
        piece["key"],
        pa.array(n, pa.int64()),
        pa.array(forms, pa.string()),
        pa.compute.if_else(plain, none, pa.array(low, pa.int64())),
        pa.compute.if_else(plain, none, pa.array(high - low, pa.int64())),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["key", "n", "form", "prefix_units", "middle_units", "output"])


def _after(mark: str, text: str) -> str:
    """What follows the first mark; both are SQL."""
    return f"substr({text}, locate('{mark}', {text}) + {len(mark)})"


def restore(cut: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """The texts as they were before :func:`transform`, from output and form alone.

    A text that was cut holds no marker, so the first of each kind is the one put in.
    """
    body = f"substr({output}, {len(PREFIX) + 1})"
    psm = (f"substring_index({body}, '{SUFFIX}', 1)", _after(MIDDLE, output), f"substring_index({_after(SUFFIX, output)}, '{MIDDLE}', 1)")
    spm = (f"substring_index({_after(PREFIX, output)}, '{MIDDLE}', 1)", _after(MIDDLE, output), f"substring_index({body}, '{PREFIX}', 1)")
    whole = f"CASE {form} WHEN 'psm' THEN concat({', '.join(psm)}) WHEN 'spm' THEN concat({', '.join(spm)}) ELSE {output} END"
    return cut.withColumn(into, F.expr(whole))
