"""Removal of repeated byte strings with suffix arrays built by Lyndon grouping.

A byte goes if any ``length``-byte string over it starts anywhere else. Every
start of such a string is owned by the string's minimiser, the leftmost least
hash of its ``GRAM``-byte pieces. Equal strings have equal minimisers at equal
distances, so it is enough to compare, for each minimiser that occurs twice, the
stretches of text owned by its occurrences.

Stretches of one minimiser are compared through a suffix array of their
concatenation: suffixes are grouped by their Lyndon prefix, groups are processed in
descending order over previous-smaller pointers, and a final pass emits the order
within each group; nothing is renamed recursively. Longest common prefixes with
the neighbours tell which starts occur again. Columns in which all stretches of
a bucket agree are joined into one symbol, which shortens the array and keeps
the order of what differs.

Equal texts are examined once; each is a repeat of the other if it is long
enough. Equal stretches are counted and compared once. A bucket with more than
``bucket_limit`` different stretches (a passage that a large share of the documents
hold) is cut: starts go to buckets by their distance from the minimiser, in ever
smaller steps, and by all bytes that strings of such a step have in common; a step of
one start is a bucket of equal strings. So no task meets an unbounded group.

Null text counts as empty. Rows shorter than ``length`` are kept whole. Repeated
rows are copies of each other. Offsets are in bytes of UTF-8. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import U, _powers, map_batches, mixed, ship, slices, text_bytes
from obsflow.sources.session import scratch_path

LENGTH = 400
GRAM = 64
BUCKET_LIMIT = 600


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes in lexicographic order. The last symbol must be the single least one."""
    size = len(text)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    members = [by_symbol[c] for c in sorted(by_symbol)]
    group = [0] * size
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    lower = list(range(-1, len(members) - 1))
    upper = [*range(1, len(members)), -1]
    done, smaller = [False] * size, [-1] * size
    # Groups in descending order; those made on the way always lie below the current one.
    now = len(members) - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        members[now] = own
        for i in own:
            done[i] = True
        met: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        # A suffix extended more often by this group's Lyndon word is larger.
        parts: dict[tuple[int, int], list[int]] = {}
        for j, times in met.items():
            parts.setdefault((group[j], -times), []).append(j)
        for (old, _), moved in sorted(parts.items()):
            new = len(members)
            members.append(sorted(moved))
            for j in moved:
                group[j] = new
            above = upper[old]
            lower.append(old)
            upper.append(above)
            upper[old] = new
            lower[above] = new
        now = lower[now]
    # Sizes of the final groups in ascending order give their places.
    first = [0] * len(members)
    bottom = 0
    while lower[bottom] >= 0:
        bottom = lower[bottom]
    at, g = 0, bottom
    while g >= 0:
        first[g] = at
        at += len(members[g])
        g = upper[g]
    order, placed = [-1] * size, [False] * size
    order[0], placed[size - 1] = size - 1, True
    for k in range(size):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[first[g]] = j
            first[g] += 1
            placed[j] = True
            j = smaller[j]
    return order


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Symbols that each suffix shares with the one before it in ``order``."""
    size = len(text)
    rank = [0] * size
    for k, i in enumerate(order):
        rank[i] = k
    out, same = [0] * size, 0
    for i in range(size):
        if rank[i]:
            j = order[rank[i] - 1]
            while i + same < size and j + same < size and text[i + same] == text[j + same]:
                same += 1
            out[rank[i]] = same
            same = max(0, same - 1)
        else:
            same = 0
    return out


def _shared_length(a: bytes, b: bytes) -> int:
    """Bytes that two strings share at their beginning."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    return int(np.argmax(np.frombuffer(a, np.uint8, size) != np.frombuffer(b, np.uint8, size)))


def _extents(parts: list[bytes]) -> list[int]:
    """The most that each string shares with any other at its beginning (neighbours in order share most)."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:], strict=False):
        same = _shared_length(parts[i], parts[j])
        out[i], out[j] = max(out[i], same), max(out[j], same)
    return out


def repeated_starts(stretches: list[bytes], shifts: list[int], length: int) -> list[np.ndarray]:
    """For different stretches with a common anchor at ``shifts``: which of their starts occur again in another.

    Bytes farther from the anchor than a stretch has in common with any other are
    of no use; stretches that keep fewer than ``length`` bytes drop out.
    """
    after = _extents([x[s:] for x, s in zip(stretches, shifts, strict=True)])
    before = _extents([x[:s][::-1] for x, s in zip(stretches, shifts, strict=True)])
    out = [np.zeros(len(x) - length + 1, bool) for x in stretches]
    kept = [k for k in range(len(stretches)) if before[k] + after[k] >= length]
    if len(kept) > 1:
        parts = [stretches[k][shifts[k] - before[k] : shifts[k] + after[k]] for k in kept]
        for k, again in zip(kept, _starts_by_suffix_array(parts, [before[k] for k in kept], length), strict=True):
            first = shifts[k] - before[k]
            out[k][first : first + len(again)] = again
    return out


def _starts_by_suffix_array(stretches: list[bytes], shifts: list[int], length: int) -> list[np.ndarray]:
    """As :func:`repeated_starts`, from the neighbours in the suffix array of all stretches."""
    left = max(shifts)
    width = max(left - s + len(x) for s, x in zip(shifts, stretches, strict=True))
    grid = np.full((len(stretches), width), -1, np.int16)
    for row, s, x in zip(grid, shifts, stretches, strict=True):
        row[left - s : left - s + len(x)] = np.frombuffer(x, np.uint8)
    agree = (grid == grid[0]).all(axis=0)
    cut = np.ones(width + 1, bool)
    cut[1:-1] = ~(agree[1:] & agree[:-1])
    columns = np.flatnonzero(cut)
    widths = np.diff(columns)
    text: list[int] = []
    spot: list[tuple[int, np.ndarray]] = []
    # Symbols: the end, one separator per stretch, then bytes or agreed runs.
    base = len(stretches) + 1
    run_symbol = np.where(agree[columns[:-1]], 256 + np.arange(len(widths)), 0)
    for k, (s, x) in enumerate(zip(shifts, stretches, strict=True)):
        held = np.flatnonzero((columns[:-1] >= left - s) & (columns[:-1] < left - s + len(x)))
        spot.append((len(text), held))
        text += (base + np.where(run_symbol[held] > 0, run_symbol[held], grid[k, columns[held]])).tolist()
        text.append(k + 1)
    text.append(0)
    order = suffix_array(text)
    lcp = common_prefixes(text, order)
    best = np.zeros(len(text), np.int64)
    places = np.array(order)
    shared = np.array(lcp)
    best[places] = np.maximum(shared, np.append(shared[1:], 0))
    out = []
    for (begin, held), s, x in zip(spot, shifts, stretches, strict=True):
        ends = np.append(0, np.cumsum(widths[held]))
        reach = ends[np.arange(len(held)) + best[begin : begin + len(held)]]
        starts = len(x) - length + 1
        at = np.searchsorted(ends, np.arange(starts), side="right") - 1
        out.append(reach[at] - np.arange(starts) >= length)
    return out


def stretches_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with the same minimiser: hash, row, first start, number of starts, minimiser's place."""
    window = length - GRAM + 1
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (U, np.int64, np.int64, np.int64, np.int64))
    up, down = _powers(1 << max(21, int(len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    # The place in the low bits makes the leftmost of equal hashes least, and tells where it is.
    bits = U(int(len(data)).bit_length())
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
    keys = (grams >> bits << bits) | np.arange(len(grams)).astype(U)
    pad = np.append(keys, np.full(-len(keys) % window, U(0xFFFFFFFFFFFFFFFF))).reshape(-1, window)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    behind = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - length + 1
    least = np.minimum(behind[:count], ahead[window - 1 : window - 1 + count])
    place = (least & ((U(1) << bits) - U(1))).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:count]
    good = np.arange(count) + length <= ends
    new = good.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~good[:-1]
    first = np.flatnonzero(new)
    closed = np.flatnonzero(good & ~np.append(good[1:] & ~new[1:], False))
    row = np.searchsorted(offsets, first, side="right") - 1
    return grams[place[first]], row, first, closed - first + 1, place[first]


NODE = "unhex(md5(body))"
_ITEM = "h long, node binary, start long, starts long, anchor long, stretch binary"
_KIND = "md5(concat(encode(CAST(anchor AS STRING), 'UTF-8'), X'20', stretch))"
#: Widest distance of a start from its minimiser, and how much finer each cut is.
_WIDEST, _FINER = 512, 8


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """Per row: ``key``, ``n_bytes``, ``n_removed``, ``spans`` (start and end of removed runs, in bytes) and ``kept`` (binary)."""
    spark = docs.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"repeats-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body")).selectExpr("key", "body", f"{NODE} AS node")
    long = rows.where(F.octet_length("body") >= length)

    def owned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "body"):
            h, row, *_ = stretches_of(*text_bytes(piece["body"]), length)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            cut = np.flatnonzero(new)
            n = np.diff(np.append(cut, len(h)))
            yield pa.RecordBatch.from_arrays([pa.array(h[cut].view(np.int64)), piece["node"].take(pa.array(row[cut])), pa.array(n)], names=["h", "node", "n"])

    minimisers = map_batches(long.select("body", "node"), owned, "h long, node binary, n long")
    once = minimisers.groupBy("h", "node").agg(F.max("n").alias("n"))
    once = store(once, "minimisers")
    twice = once.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    wanted = once.join(twice, "h").groupBy("node").agg(F.collect_list("h").alias("wanted"))
    texts = long.select("node", "body").join(wanted, "node").groupBy("node").agg(F.first("body").alias("body"), F.first("wanted").alias("wanted"))

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "body"):
            data, offsets = text_bytes(piece["body"])
            h, row, first, starts, anchor = stretches_of(data, offsets, length)
            lists = piece["wanted"]
            want = np.concatenate([np.asarray(x) for x in lists.to_pylist()]).astype(np.int64).view(U)
            owner = np.repeat(np.arange(len(piece)), lists.value_lengths().to_numpy())
            ask, have = mixed(want + owner.astype(U)), mixed(h + row.astype(U))
            keep = np.flatnonzero(np.isin(have, ask))
            raw = data.tobytes()
            blobs = [raw[a : a + n + length - 1] for a, n in zip(first[keep], starts[keep], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[keep].view(np.int64)), piece["node"].take(pa.array(row[keep])), pa.array(first[keep] - offsets[row[keep]]),
                    pa.array(starts[keep]), pa.array(anchor[keep] - first[keep]), pa.array(blobs, pa.binary()),
                ],
                names=["h", "node", "start", "starts", "anchor", "stretch"],
            )

    items = store(map_batches(texts, cut_out, _ITEM), "stretches")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("kind")
        stretches, anchors = group["stretch"].to_pylist(), group["anchor"].to_pylist()
        found = repeated_starts(stretches, anchors, length)
        kinds, low, high = [], [], []
        for i, (n, again) in enumerate(zip(group["n"].to_pylist(), found, strict=True)):
            if n > 1:
                again = np.ones(len(again), bool)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                kinds.append(i)
                low.append(a)
                high.append(b - 1 + length)
        columns = [group["h"].take(pa.array(kinds, pa.int64())), group["kind"].take(pa.array(kinds, pa.int64())), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
        return pa.table(columns, names=["h", "kind", "low", "high"])

    def finer(step: int):
        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for x in batch.to_pylist():
                    stretch, anchor = x["stretch"], x["anchor"]
                    # A start's distance is anchor - start; steps of distances are the same in every stretch.
                    for c in range((anchor - x["starts"] + 1) // step, anchor // step + 1):
                        a, b = max(0, anchor - (c + 1) * step + 1), min(x["starts"], anchor - c * step + 1)
                        core = stretch[anchor - c * step : anchor - (c + 1) * step + 1 + length]
                        h = hashlib.blake2b(core + c.to_bytes(4, "big"), digest_size=8).digest()
                        out.append((int.from_bytes(h, "big", signed=True), x["node"], x["start"] + a, b - a, anchor - a, stretch[a : b - 1 + length]))
                columns = list(zip(*out, strict=True)) or [[]] * 6
                types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["h", "node", "start", "starts", "anchor", "stretch"])

        return cut

    spans, step, limit = None, _WIDEST, bucket_limit
    while True:
        kinds = items.groupBy("h", F.expr(_KIND).alias("kind")).agg(
            F.count("*").alias("n"), F.first("stretch").alias("stretch"), F.first("anchor").alias("anchor"), F.first("starts").alias("starts")
        )
        kinds = store(kinds, "kinds")
        sizes = kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).where("all > 1")
        # One kind only: all its starts occur again. Several: compared, unless they are too many.
        alike = kinds.join(sizes.where("kinds = 1").select("h"), "h").select("h", "kind", F.lit(0).cast("long").alias("low"), (F.col("starts") - 1 + length).alias("high"))
        # Stored, so that the join below reads it as it is and Spark can split its hot side.
        hot = store(sizes.where(f"kinds > {limit}").select("h"), "hot")
        mixed_ = kinds.join(sizes.where(f"kinds > 1 AND kinds <= {limit}").select("h"), "h")
        compared = ship(mixed_).groupBy("h").applyInArrow(compare, "h long, kind string, low long, high long")
        found = store(alike.union(compared), "found")
        at = items.select("h", F.expr(_KIND).alias("kind"), "node", "start")
        new = at.join(found, ["h", "kind"]).select("node", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
        spans = new if spans is None else spans.union(new)
        if step == 1 or hot.isEmpty():
            break
        step //= _FINER
        # Strings of a single start are equal, but for clashing hashes.
        limit = bucket_limit if step > 1 else 1 << 40
        items = store(map_batches(items.join(hot, "h").select("h", "node", "start", "starts", "anchor", "stretch"), finer(step), _ITEM), "finer")

    per_text = spans.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    copies = long.groupBy("node").agg(F.count("*").alias("copies")).where("copies > 1")
    facts = per_text.join(copies, "node", "full_outer")
    joined = rows.join(facts, "node", "left").select("key", "body", "spans", (F.coalesce("copies", F.lit(0)) > 1).alias("copied"))
    kind = rows.schema["key"].dataType.simpleString()

    def cut_away(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "body"):
            data, offsets = text_bytes(piece["body"])
            raw = data.tobytes()
            sizes, removed, runs, kept = [], [], [], []
            for i, (spans_, copied) in enumerate(zip(piece["spans"].to_pylist(), piece["copied"].to_pylist(), strict=True)):
                own = raw[offsets[i] : offsets[i + 1]]
                merged: list[list[int]] = []
                for span in [{"low": 0, "high": len(own)}] if copied else spans_ or []:
                    if merged and span["low"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span["high"])
                    else:
                        merged.append([span["low"], span["high"]])
                last, parts = 0, []
                for a, b in merged:
                    parts.append(own[last:a])
                    last = b
                parts.append(own[last:])
                sizes.append(len(own))
                removed.append(sum(b - a for a, b in merged))
                runs.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(parts))
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [piece["key"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, span_type), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "n_removed", "spans", "kept"])

    schema = f"key {kind}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    return map_batches(joined, cut_away, schema).withColumnRenamed("key", key)
