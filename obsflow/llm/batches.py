"""Arrow text batches as numpy arrays, cut into slices of bounded size.

Words are told apart by a 64-bit hash of their bytes. It is computed for a
whole slice at once from prefix sums of ``byte * BASE ** position``, and does
not depend on where in the slice, batch or partition a word lies.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
U = np.uint64


@cache
def _shipped(application: str, context) -> None:
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="obsflow-")) / "obsflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))


def ship(df: DataFrame) -> DataFrame:
    """Send this package to the executors, once per application (the driver serves the archive)."""
    context = df.sparkSession.sparkContext
    _shipped(context.applicationId, context)
    return df


def give_back() -> None:
    """Return freed memory to the system; Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return ship(df).mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` text bytes; a longer text stays whole, alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(text_bytes(batch[text])[1]))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(first, last - first)
            first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of the rows in them; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(U, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U(shift)
        x *= U(factor)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(size, U(_BASE)), np.full(size, U(inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Words(NamedTuple):
    """Words of a slice in order: byte range, row, hash; and where each row's words start."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range."""
    size = 1 << max(21, int(len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(U))


def find_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``separator`` is false, never across rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    change = inside[1:] != inside[:-1]
    change[offsets] |= inside[1:][offsets] | inside[:-1][offsets]
    edges = np.flatnonzero(change)
    # A row boundary inside a run both ends and starts a word there.
    both = inside[edges] & inside[edges + 1]
    edges = np.repeat(edges, 1 + both)
    start, end = edges[::2], edges[1::2]
    row = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)), side="left")
    return Words(start, end, row, span_hashes(data, start, end), first)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over bytes: true inside any of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACES = separators((0x20, 0x20), (0x09, 0x0D))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + lengths[i]`` of all i, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift


def fold(column: str, parts: int) -> str:
    """SQL: ``crc32(column as text) mod parts``; a null column counts as empty text."""
    return f"crc32(CAST(coalesce(CAST(`{column}` AS STRING), '') AS BINARY)) % {parts}"
