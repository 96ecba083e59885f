"""Benchmark decontamination by a broadcast set of normalised 13-word windows, in SQL only.

Documents and items are lower-cased (A-Z) and cut into words. All windows of
the items go into one table keyed by hash. The documents' windows are hashed; a bit
table of fixed size over the items' hashes drops most of them within the row, the
rest are exploded with their words and looked up within the scan stage, and a hit counts only if the
words themselves are equal. Only hits, and one row per document, are shuffled.

The window table is stored in the shared folder and broadcast while its rows, as they
lie in memory, take ``broadcast_bytes`` or fewer; beyond that the same join runs as a sort-merge join, whose hot windows
Spark can split. Items shorter than a window are one window of their own length, and
documents are scanned once more for each such length that occurs.

Null text has no words and is never contaminated. Items without words or id add
no item (their windows still hit if they have words). Repeated documents are
judged one by one, repeated items count once. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.sources.session import scratch_path

# What parts words, the window and the contaminated share (1 in 20).
GAP = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
ONE_IN = 20

BROADCAST_BYTES = 64 << 20
#: SQL: bytes of a row of the window table in memory, about: eight for each slot, texts rounded up to eights.
_ROW_BYTES = "96 + aggregate(concat(window, items), 0L, (s, x) -> s + 16 + octet_length(x))"
BIT_WORDS = 1 << 14


def words_of(text: str) -> str:
    """SQL: normalised words of a text column; none for null."""
    return f"filter(split(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{GAP}'), x -> x <> '')"


def hash_of(words: str, size: int, first: str = "0") -> str:
    """SQL: hash of ``size`` words from place ``first`` on.

    Words are taken one by one: ``slice`` would copy the whole array each time.
    """
    return f"xxhash64({', '.join(f'{words}[{first} + {k}]' for k in range(size))})"


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: ``h``, ``size``, ``window`` (words) and ``items`` (ids as text)."""
    rows = items.select(F.col(item).cast("string").alias("item"), F.col(text).alias("body"))
    words = rows.selectExpr("item", f"{words_of('body')} AS w").where("size(w) > 0")
    size = f"least({WINDOW}, size(w))"
    each = words.selectExpr(
        "item", f"{size} AS size", f"explode(transform(sequence(1, size(w) - {size} + 1), i -> slice(w, i, {size}))) AS window"
    )
    return each.groupBy("size", "window").agg(F.collect_set("item").alias("items")).selectExpr(
        f"CASE size {' '.join(f'WHEN {s} THEN {hash_of("window", s)}' for s in range(1, WINDOW + 1))} END AS h", "size", "window", "items"
    )


def _bit_table(table: DataFrame) -> np.ndarray:
    """A bit for each hash of the windows, by its low bits: of fixed size, made on the executors."""
    words = BIT_WORDS - 1
    parts = table.groupBy(F.expr(f"CAST(shiftrightunsigned(h, 6) & {words} AS INT) AS at")).agg(F.expr("bit_or(shiftleft(1L, CAST(h & 63 AS INT))) AS bits"))
    out = np.zeros(BIT_WORDS, np.int64)
    for r in parts.collect():
        out[r["at"]] = r.bits
    return out


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids), ``contaminated``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "benchmark-windows")
    item_windows(items, item, item_text).write.parquet(path)
    table = spark.read.parquet(path)
    facts = table.select(F.coalesce(F.sum(F.expr(_ROW_BYTES)), F.lit(0)), F.collect_set("size")).first()
    hint = "broadcast" if facts[0] <= broadcast_bytes else "merge"
    sizes = sorted(facts[1]) or [WINDOW]
    hashed = ", ".join(
        f"CASE WHEN size(w) < {s} THEN CAST(array() AS ARRAY<STRUCT<h: BIGINT, at: INT, size: INT>>)"
        f" ELSE transform(sequence(1, size(w) - {s} + 1), i -> struct({hash_of("w", s, "i - 1")} AS h, i AS at, {s} AS size)) END"
        for s in sizes
    )
    windows = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("body"))
        .selectExpr("row", "key", f"{words_of('body')} AS w")
        .selectExpr("row", "key", "w", "size(w) AS n_words", f"concat({hashed}) AS windows")
    )
    bits = _bit_table(table)

    def may_occur(x):
        at = F.shiftrightunsigned(x["h"], 6).bitwiseAND(F.lit(len(bits) - 1)).cast("int")
        return F.call_function("shiftrightunsigned", F.get(F.lit(bits), at), x["h"].bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    # Few windows are left now; only these carry their words.
    each = windows.select("row", "key", "n_words", "w", F.filter("windows", may_occur).alias("windows")).selectExpr(
        "row",
        "key",
        "n_words",
        "posexplode_outer(transform(windows, x -> struct(x.h AS h, x.at AS at, x.size AS size,"
        " transform(sequence(0, x.size - 1), k -> w[x.at - 1 + k]) AS gram))) AS (place, x)",
    )
    each = each.selectExpr("row", "key", "n_words", "coalesce(place, 0) AS place", "x.h AS h", "x.at AS at", "x.size AS size", "x.gram AS gram")
    same = (F.col("d.h") == F.col("t.h")) & (F.col("d.size") == F.col("t.size")) & (F.col("d.gram") == F.col("t.window"))
    hits = each.alias("d").join(table.hint(hint).alias("t"), same, "left").where("t.h IS NOT NULL OR place = 0")
    grouped = hits.groupBy("row", "key", "n_words").agg(
        F.expr("collect_list(CASE WHEN t.h IS NOT NULL THEN sequence(d.at, d.at + d.size - 1) END)").alias("hit"),
        F.expr("flatten(collect_set(items))").alias("items"),
    )
    return grouped.selectExpr(
        f"key AS `{key}`",
        "CAST(n_words AS BIGINT) AS n_words",
        "CAST(size(array_distinct(flatten(hit))) AS BIGINT) AS n_hit",
        "array_sort(array_distinct(items)) AS items",
    ).selectExpr("*", "CAST(size(items) AS BIGINT) AS n_items", f"n_hit > 0 AND {ONE_IN} * n_hit >= n_words AS contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that are not contaminated, all columns as they were.

    Whether a document is contaminated depends on its text alone, so the digests
    of contaminated texts tell which rows go.
    """
    digest = F.sha2(F.col(f"`{text}`").cast("binary"), 256)
    judged = find_contamination(docs.select(digest.alias("digest"), F.col(text).alias("body")), items, "digest", "body", item, item_text)
    bad = judged.where("contaminated").select(F.col("digest").alias("__bad")).distinct()
    return docs.join(bad, digest == F.col("__bad"), "left_anti")
