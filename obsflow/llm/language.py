"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts per language and bucket: every task sends at
most ``languages * buckets`` sums, however long its texts, and the driver gets
the same bounded table once. Scoring looks buckets up in the log-probability
matrix (broadcast, ``languages * (buckets + 1)`` floats) for a slice of texts at
a time. Letters are compared in lower case; every other character counts as a
space.

Null or letterless text gives ``und`` with score 0. Equal log-likelihoods go to
the alphabetically first language. Without training rows everything is ``und``.
Repeated rows give repeated results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import U, map_batches, mixed, slices

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
#: Text bytes taken at a time: each costs some 80 bytes of arrays while n-grams are looked up.
SLICE = 500_000


@dataclass(frozen=True)
class LanguageModel:
    """Languages in alphabetical order, their log-probabilities by bucket and log priors."""

    languages: tuple[str, ...]
    table: np.ndarray
    prior: np.ndarray


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter; its lower case, or a space if it is none."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    folded = np.full(0x110000, 0x20, np.uint32)
    for code in np.flatnonzero(letters):
        low = chr(code).lower()
        folded[code] = ord(low) if len(low) == 1 else code
    return letters, folded


def _grams(column: pa.Array, buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each character, by order; the characters' rows; rows with a letter.

    Each text is closed by a space. An n-gram that would run past it gets the
    spare bucket ``buckets``.
    """
    texts = [t or "" for t in column.to_pylist()]
    raw = ("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass")
    letters, folded = _alphabet()
    codes = np.frombuffer(raw, np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    row = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    has_letter = np.zeros(len(texts), bool)
    has_letter[row[letters[codes]]] = True
    codes = folded[codes].astype(U)
    key, out = np.zeros(len(codes), U), []
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(codes), U)
        shifted[: len(codes) - order + 1] = codes[order - 1 :]
        key = key * U(0x110000) + shifted
        if order in ORDERS:
            bucket = (mixed(key + U(order << 58)) >> U(40)).astype(np.int64) % buckets
            bucket[left < order] = buckets
            out.append(bucket)
    return out, row, has_letter


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> LanguageModel:
    """Model of all rows of ``docs`` with text and language (two scans: the languages, the counts)."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    found = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(found))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * (buckets + 1), np.int64)
        for piece in slices(batches, "text", SLICE):
            grams, row, _ = _grams(piece["text"], buckets)
            base = np.array([place[x] for x in piece["lang"].to_pylist()])[row] * (buckets + 1)
            for bucket in grams:
                sums += np.bincount(base + bucket, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    if not languages:
        return LanguageModel((), np.zeros((0, buckets + 1), np.float32), np.zeros(0))
    cells = map_batches(rows, count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(len(languages) * (buckets + 1))
    sums[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    sums = sums.reshape(len(languages), -1)
    sums[:, buckets] = 0
    table = np.log((sums + SMOOTHING) / (sums.sum(axis=1, keepdims=True) + SMOOTHING * buckets))
    table[:, buckets] = 0
    counts = np.array([found[name] for name in languages], float)
    return LanguageModel(languages, table.astype(np.float32), np.log(counts / counts.sum()))


def judge(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and posterior probability of each text."""
    if not model.languages:
        return [UNDETERMINED] * len(column), np.zeros(len(column))
    grams, row, has_letter = _grams(column, model.table.shape[1] - 1)
    likely = np.empty((len(model.languages), len(column)))
    for i, logs in enumerate(model.table):
        each = sum(logs[bucket] for bucket in grams)
        likely[i] = np.bincount(row, weights=each, minlength=len(column)) + model.prior[i]
    best = likely.argmax(axis=0)
    score = 1 / np.exp(likely - likely.max(axis=0)).sum(axis=0)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter, strict=True)]
    return names, np.where(has_letter, score, 0.0)


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", SLICE):
            names, scores = judge(shared.value, piece["text"])
            yield pa.RecordBatch.from_arrays([piece["key"], pa.array(names, pa.string()), pa.array(scores)], names=["key", "lang_pred", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, score, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def keep_known(docs: DataFrame, model: LanguageModel, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with probability ``least`` or more; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, SLICE):
            names, scores = judge(shared.value, piece[text])
            known = np.array([n != UNDETERMINED for n in names]) & (scores >= least)
            yield piece.filter(pa.array(known))

    return map_batches(docs, keep, docs.schema)
