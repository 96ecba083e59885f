"""Language-model scoring with a hashed, class-factored maximum-entropy model.

A token's probability is that of its class given the three tokens before it,
times that of the token within its class. Classes are the most frequent tokens,
one each, and a few classes of words that end alike. The class softmax takes
hashed features: the token before (2-gram), the two before together (3-gram), the
one before the last (skip), the classes of the two before, and those of the two
before them (skip). Within a class, tokens have their
add-one relative frequency over all training tokens.

Training is distributed: each task runs mini-batch gradient steps over its own
documents, and the tasks' weights are averaged, each feature by how often a task
met it, in a tree of fixed fan-in. What reaches the driver is the weight table
(``FEATURES * CLASSES`` floats) and the ``COMMON`` most frequent tokens, both of
fixed size.

Token counts are exact over the whole corpus. Tokens among the broadcast common
ones are looked up within the task; all others are joined to the stored
count table, so neither side is bounded by memory. The hottest words never enter that
join, since they are common.

Null text counts as empty and scores its end token alone. Repeated rows are
scored each (and count each in training). Other columns are not looked at. With no
training rows all counts are zero and class probabilities are uniform.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import SPACES, U, find_words, map_batches, mixed, ship, slices, text_bytes
from obsflow.llm.trees import BLOCKS, tree_sum
from obsflow.sources.session import scratch_path

CLASSES = 32
HEAD = 8
FEATURES = 1 << 15
COMMON = 1 << 18
MINI_BATCH = 1 << 15
RATE = 0.5
FLUSH = 1_500_000
END, START = U(1), U(2)


class Tokens:
    """Tokens of a slice: lower-cased words and one end per row, with row, class and features."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        upper = (data >= 65) & (data <= 90)
        data = np.where(upper, data + 32, data).astype(np.uint8)
        words = find_words(data, offsets, SPACES)
        rows = len(column)
        at = np.arange(len(words.row)) + words.row
        self.end_at = words.first[1:] + np.arange(rows)
        size = len(at) + rows
        self.hash = np.empty(size, U)
        self.hash[at] = words.hash
        self.hash[self.end_at] = END
        self.row = np.empty(size, np.int64)
        self.row[at], self.row[self.end_at] = words.row, np.arange(rows)
        # Words that end in the same two bytes, leaving out one closing mark, share a class.
        last = words.end - 1
        mark = (data[last] < 0x80) & ~np.isin(data[last], np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8))
        last = last - (mark & (last > words.start))
        before = np.where(last > words.start, data[np.maximum(last - 1, 0)], 0)
        ending = mixed(data[last].astype(U) * U(256) + before.astype(U))
        self.kind = np.zeros(size, np.int64)
        self.kind[at] = HEAD + (ending % U(CLASSES - HEAD)).astype(np.int64)

    def features(self, kinds: np.ndarray) -> np.ndarray:
        """Rows of the weight table for each token, by the tokens before it and their classes."""
        first = np.append(0, self.end_at[:-1] + 1)
        place = np.arange(len(self.hash)) - first[self.row]

        def back(values: np.ndarray, none: np.uint64, distance: int) -> np.ndarray:
            earlier = np.full(len(values), none)
            earlier[distance:] = values[:-distance]
            earlier[place < distance] = none
            return earlier

        word = [back(self.hash, START, d) for d in (1, 2)]
        kind = [back(kinds.astype(U), U(CLASSES), d) for d in (1, 2, 3, 4)]
        keys = (
            word[0] + U(11),
            word[0] * U(3) + word[1] * U(5) + U(12),
            word[1] + U(13),
            kind[0] * U(64) + kind[1] + U(1 << 20),
            kind[2] * U(64) + kind[3] + U(1 << 21),
        )
        return np.stack([(mixed(k) >> U(40)).astype(np.int64) % FEATURES for k in keys])


@dataclass(frozen=True)
class Counts:
    """Totals of the training tokens, the stored table and its most frequent part."""

    path: str
    total: int
    distinct: int
    common: np.ndarray
    common_n: np.ndarray
    head: np.ndarray
    class_total: np.ndarray
    class_distinct: np.ndarray


def count_tokens(docs: DataFrame, text: str = "text") -> Counts:
    """Exact counts of the tokens of all rows; the table is stored in the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            h, n, kind = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, first, place = np.unique(h, return_index=True, return_inverse=True)
            return keys, np.bincount(place, weights=n).astype(np.int64), kind[first]

        def batch(x: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1]), pa.array(x[2])], names=["h", "n", "kind"])

        for piece in slices(batches, "text"):
            tokens = Tokens(piece["text"])
            keys, first, n = np.unique(tokens.hash, return_index=True, return_counts=True)
            held.append((keys, n, tokens.kind[first]))
            if sum(len(x[0]) for x in held) > FLUSH:
                held = [merged()]
                if len(held[0][0]) > FLUSH // 2:
                    yield batch(held.pop())
        if held:
            yield batch(merged())

    path = scratch_path(spark, "token-counts")
    partial = map_batches(rows, count, "h long, n long, kind long")
    partial.groupBy("h").agg(F.sum("n").alias("n"), F.first("kind").alias("kind")).write.parquet(path)
    table = spark.read.parquet(path)
    # A cut on the count that at most COMMON tokens reach; the histogram has some hundred rows.
    steps = table.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, words = None, 0
    for step in sorted(steps, key=lambda s: -s.step):
        words += step.words
        if words > COMMON:
            break
        least = step.least
    totals = table.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for t in totals:
        class_total[t.kind], class_distinct[t.kind] = t.n, t.words
    total, distinct = int(class_total.sum()), int(class_distinct.sum())
    found = table.where(F.col("n") >= (least if least is not None else 1 << 62)).toArrow()
    keys, n, kind = (found[c].to_numpy() for c in ("h", "n", "kind"))
    keys = keys.view(U)
    order = np.argsort(keys)
    keys, n, kind = keys[order], n[order], kind[order]
    top = np.lexsort((keys, -n))
    top = top[keys[top] != END][: HEAD - 1]
    np.subtract.at(class_total, kind[top], n[top])
    np.subtract.at(class_distinct, kind[top], 1)
    return Counts(path, total, distinct, keys, n, np.concatenate([[END], keys[top]]).astype(U), class_total, class_distinct)


def classes_of(tokens: Tokens, head: np.ndarray) -> np.ndarray:
    """Class of each token: its own for the head, else that of its ending."""
    kind = tokens.kind.copy()
    for i, h in enumerate(head):
        kind[tokens.hash == h] = i
    return kind


def _log_classes(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Log-probability of every class for each token; the last table row is the bias."""
    z = weights[features[0]]
    for f in features[1:]:
        z += weights[f]
    z += weights[FEATURES]
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def train(docs: DataFrame, counts: Counts, text: str = "text") -> np.ndarray:
    """Weights after one pass of distributed mini-batch gradient steps over all rows."""
    rows = docs.select(F.col(text).alias("text"))
    head = counts.head

    def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros((FEATURES + 1, CLASSES), np.float32)
        met = np.zeros(FEATURES + 1, np.float32)
        for piece in slices(batches, "text"):
            tokens = Tokens(piece["text"])
            kinds = classes_of(tokens, head)
            every = tokens.features(kinds)
            for a in range(0, len(kinds), MINI_BATCH):
                features, kind = every[:, a : a + MINI_BATCH], kinds[a : a + MINI_BATCH]
                slope = np.exp(_log_classes(weights, features))
                slope[np.arange(len(kind)), kind] -= 1
                flat = features.ravel().astype(np.uint16)
                order = np.argsort(flat, kind="stable")
                cuts = np.flatnonzero(np.diff(flat[order], prepend=-1))
                sums = np.add.reduceat(slope[order % len(kind)], cuts, axis=0)
                at, n = flat[order][cuts].astype(np.int64), np.diff(np.append(cuts, len(flat)))
                met[at] += n
                weights[at] -= RATE * sums / (np.sqrt(n * met[at]) + 1)[:, None]
                met[FEATURES] += len(kind)
                weights[FEATURES] -= RATE * slope.sum(axis=0) / (np.sqrt(len(kind) * met[FEATURES]) + 1)
        table = np.zeros((-(-(FEATURES + 1) // BLOCKS) * BLOCKS, CLASSES + 1), np.float32)
        table[: FEATURES + 1] = np.hstack([weights * met[:, None], met[:, None]])
        blobs = [b.tobytes() for b in np.split(table, BLOCKS)]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([part] * BLOCKS, pa.int64()), pa.array(blobs, pa.binary())],
            names=["block", "part", "sums"],
        )

    sums = tree_sum(map_batches(rows, descend, "block int, part long, sums binary"))
    if sums is None:
        return np.zeros((FEATURES + 1, CLASSES), np.float32)
    table = sums.reshape(-1, CLASSES + 1)[: FEATURES + 1]
    return (table[:, :CLASSES] / np.maximum(table[:, CLASSES:], 1)).astype(np.float32)


def score(docs: DataFrame, counts: Counts, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10)."""
    spark = docs.sparkSession
    rows = ship(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = spark.sparkContext.broadcast((counts, weights))
    names = ["row", "h", "tf", "key", "n_tokens", "known", "logs", "tail_logs", "fixed"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, w = shared.value
        share = np.log10(c.class_total + c.class_distinct + 1)
        share[:HEAD] = 0
        row0 = TaskContext.get().partitionId() << 40
        for piece in slices(batches, "text"):
            tokens = Tokens(piece["text"])
            n = len(piece)
            kind = classes_of(tokens, c.head)
            at = np.searchsorted(c.common, tokens.hash)
            at[at == len(c.common)] = 0
            common = c.common[at] == tokens.hash if len(c.common) else np.zeros(len(at), bool)
            logs = np.zeros(len(at))
            logs[common] = np.log10(c.common_n[at[common]] + 1)
            tail = kind >= HEAD
            every = tokens.features(kind)
            fixed = np.empty(len(at))
            for a in range(0, len(at), MINI_BATCH):
                z = _log_classes(w, every[:, a : a + MINI_BATCH])
                fixed[a : a + MINI_BATCH] = z[np.arange(len(z)), kind[a : a + MINI_BATCH]]
            fixed = fixed / np.log(10) - share[kind]
            per_row = lambda x: np.bincount(tokens.row, weights=x, minlength=n)  # noqa: E731, B023
            ids = row0 + np.arange(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids), pa.array(mixed(ids.astype(U)).view(np.int64)), pa.array(np.zeros(n, np.int64)), piece["key"],
                    pa.array(np.bincount(tokens.row, minlength=n)), pa.array(per_row(common).astype(np.int64)),
                    pa.array(per_row(logs)), pa.array(per_row(logs * tail)), pa.array(per_row(fixed)),
                ],
                names=names,
            )
            # Other tokens: one line per row and token.
            rare = np.flatnonzero(~common)
            order = rare[np.lexsort((tokens.hash[rare], tokens.row[rare]))]
            h, r = tokens.hash[order], tokens.row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            cut = np.flatnonzero(new)
            tf = np.diff(np.append(cut, len(h)))
            none = [pa.nulls(len(cut), t) for t in (piece["key"].type, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(row0 + r[cut]), pa.array(h[cut].view(np.int64)), pa.array(tf), *none], names=names)
            row0 += n

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"row long, h long, tf long, key {kind}, n_tokens long, known long, logs double, tail_logs double, fixed double"
    lines = rows.mapInArrow(work, schema)
    table = spark.read.parquet(counts.path).select("h", "n")
    joined = lines.alias("l").join(table.alias("c"), (F.col("l.h") == F.col("c.h")) & (F.col("l.tf") > 0), "left")
    sums = joined.groupBy("row").agg(
        F.max("key").alias("key"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.sum(F.expr("CASE WHEN n > 0 THEN tf ELSE 0 END"))).alias("n_known"),
        F.max("logs").alias("logs"),
        F.max("tail_logs").alias("tail_logs"),
        F.max("fixed").alias("fixed"),
        F.coalesce(F.sum(F.expr("tf * log10(n + 1)")), F.lit(0.0)).alias("rare"),
    )
    scale = float(np.log10(counts.total + counts.distinct + 1))
    return sums.select(
        F.col("key").alias(key),
        "n_tokens",
        "n_known",
        (F.col("logs") + F.col("rare") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("fixed") + F.col("tail_logs") + F.col("rare")).alias("score"),
    )
