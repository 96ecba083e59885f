"""Near-duplicate classes: consistent weighted sampling over TF-IDF word shingles.

A text is the set of its five-word shingles (one shorter shingle for a text of
fewer words), each weighted by its count times its idf. Equal texts are one node.
Nodes draw ``BANDS * ROWS`` consistent weighted samples (Ioffe's improved
scheme); nodes that agree on a band meet in a bucket. A bucket links its members
to its most popular node only; each link is verified by the weighted Jaccard
similarity of the whole texts, and verified links give classes. Members of a bucket
that end up in different classes are then all compared: in a small bucket pair
by pair, in a large one block against block within a task, which reads each text
a few times and writes links only. So no link that a band found is lost, and
a bucket of near copies is never spelled out in pairs.

The idf comes from a table of ``CELLS`` counters over all documents. A shingle's
document share is read from its cell less the mean load of a cell; both are
shares of the documents, so accuracy does not change with their number. Shares
below ``RARE`` count as that, and the weight runs from 1 (in every document) to
``1 + GAIN`` (rare). Sampling looks the random variables of a sample up in fixed tables indexed by
bits of a hash of shingle and sample number.

Null text counts as empty; empty texts form a class of their own. A class is
named by the least key in it (null keys only if there is no other). Repeated rows
are in one class. Extra columns are not looked at. Intermediate tables go to the shared
folder, which also cuts the lineage of the rounds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import SPACES, U, find_words, map_batches, mixed, slices, text_bytes
from obsflow.llm.trees import BLOCKS, tree_sum
from obsflow.sources.session import scratch_path

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 13, 4
CELLS = 1 << 20
RARE = 0.002
#: How much more a rare shingle weighs than one in every document; small, so that the similarity of a
#: group of near copies does not fall because the group itself makes its shingles common.
GAIN = 0.25
#: Buckets of up to LISTED nodes are compared pair by pair, larger ones in blocks of BLOCK.
LISTED, BLOCK = 12, 256
_STEPS = 256
_FIXED = float(1 << 20)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows (sorted by row), their counts and rows."""
    data, offsets = text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    words = find_words(np.where(upper, data + 32, data).astype(np.uint8), offsets, SPACES)
    counts = np.diff(words.first)
    size = np.minimum(counts, SHINGLE)[words.row]
    place = np.arange(len(words.row)) - words.first[words.row]
    starts = np.flatnonzero(place + size <= counts[words.row])
    hashes = np.zeros(len(starts), U)
    padded = np.append(words.hash, np.zeros(SHINGLE, U))
    for i in range(SHINGLE):
        hashes = np.where(i < size[starts], hashes * U(0x100000001B3) + padded[starts + i], hashes)
    hashes, row = mixed(hashes), words.row[starts]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    cut = np.flatnonzero(new)
    return hashes[cut], np.diff(np.append(cut, len(hashes))), row[cut]


def document_shares(rows: DataFrame) -> np.ndarray:
    """Estimated share of the documents that hold a shingle of each cell."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, docs = np.zeros(CELLS, np.int64), 0
        for piece in slices(batches, "text"):
            cells += np.bincount((shingles(piece["text"])[0] & U(CELLS - 1)).astype(np.int64), minlength=CELLS)
            docs += len(piece)
        blobs = [np.append(b, docs).astype(np.float32).tobytes() for b in np.split(cells, BLOCKS)]
        part = TaskContext.get().partitionId()
        columns = [pa.array(range(BLOCKS), pa.int32()), pa.array([part] * BLOCKS, pa.int64()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "sums"])

    sums = tree_sum(map_batches(rows, count, "block int, part long, sums binary"))
    if sums is None:
        return np.zeros(CELLS, np.float32)
    cells, docs = sums[:, :-1].ravel(), sums[0, -1]
    return (np.maximum(cells - cells.mean(), 0) / max(docs, 1)).astype(np.float32)


def weigh(hashes: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """TF-IDF weight of each shingle."""
    # In double precision, so that a rare shingle met once weighs 1 + GAIN to the last bit.
    share = np.clip(shares[(hashes & U(CELLS - 1)).astype(np.int64)].astype(float), RARE, 1)
    return counts * (1 + GAIN * np.log(share) / np.log(RARE))


def _gamma_steps(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of n equal steps (bisection)."""
    want = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < want
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low


_R = _gamma_steps(_STEPS)
_BETA = (np.arange(_STEPS) + 0.5) / _STEPS
_LOG_C = np.log(_gamma_steps(4096))
_LOW = U(0xFFFFFFFF)


def _after_c(log_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """For a weight, by step of r and beta: ``-log y - r`` and the level t."""
    r, beta = np.repeat(_R, _STEPS), np.tile(_BETA, _STEPS)
    level = np.floor(log_weight / r + beta)
    return -r * (level - beta) - r, level


def _packed(logs: np.ndarray) -> np.ndarray:
    """Fixed-point value in the upper half of a 64-bit number."""
    return np.round(logs * _FIXED).astype(np.int64) << 32


class Sampler:
    """Draws the samples; tables for weights met before are kept."""

    def __init__(self) -> None:
        self.log_c = _packed(_LOG_C)
        self.tables: dict[float, tuple[np.ndarray, np.ndarray]] = {}

    def _table(self, weight: float) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables) > 64:
            self.tables.clear()
        if weight not in self.tables:
            value, level = _after_c(float(np.log(weight)))
            self.tables[weight] = _packed(value), (mixed(level.astype(np.int64).view(U)) & _LOW).view(np.int64)
        return self.tables[weight]

    def bands(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Band hashes of each text; ``first`` tells where its shingles start (no text is empty)."""
        usual = 1 + GAIN
        value, level = self._table(usual)
        odd = np.flatnonzero(weights != usual)
        log_odd = np.log(weights[odd])
        out = np.empty((len(first), BANDS), U)
        band = np.zeros(len(first), U)
        low = (hashes >> U(32)).view(np.int64)
        for k in range(BANDS * ROWS):
            x = hashes * U((0x9E3779B97F4A7C15 * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF)
            x ^= x >> U(29)
            x *= U(0xBF58476D1CE4E5B9)
            at_c, at_r = (x >> U(52)).view(np.int64), ((x >> U(36)) & U(0xFFFF)).view(np.int64)
            key = self.log_c[at_c] + value[at_r]
            key += low ^ level[at_r]
            if len(odd):
                r, beta = _R[at_r[odd] // _STEPS], _BETA[at_r[odd] % _STEPS]
                step = np.floor(log_odd / r + beta)
                mark = (mixed(step.astype(np.int64).view(U)) & _LOW).view(np.int64)
                key[odd] = _packed(_LOG_C[at_c[odd]]) + _packed(-r * (step - beta) - r) + (low[odd] ^ mark)
            sample = np.minimum.reduceat(key, first).view(U)
            band = mixed(band * U(31) + (sample & _LOW) + U(k))
            if k % ROWS == ROWS - 1:
                out[:, k // ROWS] = band
                band = np.full(len(first), U(k // ROWS + 1))
        return out


NODE = "unhex(md5(coalesce(text, '')))"


def sign(rows: DataFrame, shares: np.ndarray) -> DataFrame:
    """``node`` and ``bands`` (an array, empty for texts without words); equal texts of a slice once."""
    shared = rows.sparkSession.sparkContext.broadcast(shares)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for piece in slices(batches, "text"):
            nodes = piece["node"].to_pylist()
            once = sorted({n: i for i, n in reversed(list(enumerate(nodes)))}.values())
            piece = piece.take(pa.array(once))
            hashes, counts, row = shingles(piece["text"])
            filled, first = np.unique(row, return_index=True)
            sizes = np.zeros(len(piece), np.int64)
            sizes[filled] = BANDS
            found = sampler.bands(hashes, weigh(hashes, counts, shared.value), first) if len(first) else np.zeros((0, BANDS), U)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(found.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([piece["node"], lists], names=["node", "bands"])

    return map_batches(rows.select("node", "text"), work, "node binary, bands array<long>")


def similarity(left: pa.Array, right: pa.Array, shares: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 1 for two without words."""
    n = len(left)
    both = pa.concat_arrays([left.cast(pa.large_string()), right.cast(pa.large_string())])
    hashes, counts, row = shingles(both)
    weights = weigh(hashes, counts, shares)
    total = np.bincount(row, weights=weights, minlength=2 * n)
    total = total[:n] + total[n:]
    pair = np.where(row >= n, row - n, row)
    order = np.lexsort((hashes, pair))
    hashes, weights, pair = hashes[order], weights[order], pair[order]
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1]))
    shared = np.bincount(pair[same], weights=np.minimum(weights[same], weights[same + 1]), minlength=n)
    return np.where(total > 0, shared / np.maximum(total - shared, 1e-300), 1.0)


class _Stored:
    """Frames written to the shared folder and read back."""

    def __init__(self, spark):
        self.spark = spark

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"near-{name}")
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def components(edges: DataFrame, store: _Stored) -> DataFrame:
    """``node`` and ``comp`` (the least node reachable) for every node with an edge (``a``, ``b``)."""
    both = store(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("further"))
        new = step.join(jump, F.col("comp") == F.col("at"), "left").select("node", "old", F.least("comp", "further").alias("comp"))
        new = store(new, "labels")
        labels = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            return labels


def find_links(rows: DataFrame, shares: np.ndarray, similar: float, store: _Stored) -> tuple[DataFrame | None, DataFrame | None]:
    """Verified links (``a``, ``b``) between nodes and their components; None if there is none."""
    signed = store(sign(rows, shares), "bands")
    members = signed.dropDuplicates(["node"]).select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = store(members.join(sizes, "bucket"), "members")
    popular = members.groupBy("node").agg(F.sum("size").alias("popular"))
    members = store(members.drop("size").join(popular, "node"), "ranked")
    leaders = members.groupBy("bucket").agg(F.max(F.struct("popular", "node")).alias("lead")).select("bucket", F.col("lead.node").alias("lead"))
    pairs = members.join(leaders, "bucket").where("node <> lead").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
    pairs = store(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return None, None
    # Only texts that met another are carried on.
    met = members.select("node").distinct()
    texts = store(rows.join(met, "node", "left_semi").dropDuplicates(["node"]), "texts")
    shared = rows.sparkSession.sparkContext.broadcast(shares)

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text_a"):
            good = similarity(piece["text_a"], piece["text_b"], shared.value) >= similar
            yield piece.select(["a", "b"]).filter(pa.array(good))

    def verified(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        return store(map_batches(with_b.select("a", "b", "text_a", "text_b"), verify, "a binary, b binary"), "links")

    links = verified(pairs)
    comps = components(links, store)
    placed = members.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    open_ = placed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    placed = store(placed.join(open_.where("low <> high").select("bucket", "size"), "bucket"), "open")
    # A small bucket's pairs are listed, once for all bands.
    small = placed.where(F.col("size") <= LISTED)
    more = small.alias("x").join(small.alias("y"), "bucket").where("x.comp < y.comp")
    more = more.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = store(more.join(pairs, ["a", "b"], "left_anti"), "more")
    # A large bucket is cut into blocks, and every two blocks are compared within a task.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = placed.where(F.col("size") > LISTED).withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    met = large.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "comp"
    )

    def compare(group: pa.Table) -> pa.Table:
        return _block_links(group.combine_chunks(), shared.value, similar)

    across = met.join(texts, "node").groupBy("bucket", "lo", "hi").applyInArrow(compare, "a binary, b binary")
    found = verified(more).union(store(across.distinct(), "across"))
    if found.isEmpty():
        return links, comps
    links = links.union(found)
    return links, components(links, store)


def _block_links(group: pa.Table, shares: np.ndarray, similar: float) -> pa.Table:
    """Similar pairs of different classes between two blocks of texts (or within one).

    A shingle met c times counts as c different ones, each of the shingle's idf; then the
    shared weight of two texts is a product of two rows of a 0-1 matrix. Only
    shingles that several texts of the blocks hold enter it, some thousand at a time.
    """
    n = group.num_rows
    text = pa.concat_arrays(group["text"].chunks) if group["text"].num_chunks else pa.array([], pa.string())
    hashes, counts, row = shingles(text)
    idf = weigh(hashes, np.ones(len(hashes)), shares)
    total = np.bincount(row, weights=idf * counts, minlength=n)
    row, idf = np.repeat(row, counts), np.repeat(idf, counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, first, place, held = np.unique(np.repeat(hashes, counts) + nth.astype(U) * U(0x9E3779B97F4A7C15), return_index=True, return_inverse=True, return_counts=True)
    common = np.flatnonzero(held > 1)
    column = np.full(len(held), -1)
    column[common] = np.arange(len(common))
    at = column[place]
    row, at = row[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    shared = np.zeros((n, n))
    for a in range(0, len(common), 4096):
        low, high = np.searchsorted(at, (a, a + 4096))
        part = np.zeros((n, min(4096, len(common) - a)), np.float32)
        part[row[low:high], at[low:high] - a] = 1
        shared += (part * idf[first[common[a : a + 4096]]].astype(np.float32)) @ part.T
    same = shared / np.maximum(total[:, None] + total[None, :] - shared, 1e-300)
    comp = np.unique(np.array(group["comp"].to_pylist(), object), return_inverse=True)[1]
    own, lo, hi = (group[c].to_numpy() for c in ("own", "lo", "hi"))
    good = (same >= similar - 1e-6) & (comp[:, None] != comp[None, :])
    if n and lo[0] != hi[0]:
        good &= own[:, None] != own[None, :]
    left, right = np.nonzero(np.triu(good, 1))
    nodes = group["node"].to_pylist()
    pairs = [sorted((nodes[i], nodes[j])) for i, j in zip(left, right, strict=True)]
    return pa.table([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """Per row: ``key`` and ``class_id``, the least key of the row's class."""
    nodes = _nodes(docs, key, text, similar)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).selectExpr("key", f"{NODE} AS node")
    return rows.join(nodes, "node").select(F.col("key").alias(key), "class_id")


def _nodes(docs: DataFrame, key: str, text: str, similar: float) -> DataFrame:
    """``node``, ``comp`` and ``class_id`` of every distinct text."""
    store = _Stored(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.selectExpr("key", "text", f"{NODE} AS node")
    shares = document_shares(rows.select("text"))
    _, comps = find_links(rows.select("node", "text"), shares, similar, store)
    nodes = rows.groupBy("node").agg(F.min("key").alias("least"))
    if comps is None:
        return nodes.select("node", F.col("node").alias("comp"), F.col("least").alias("class_id"))
    placed = store(nodes.join(comps, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp")), "nodes")
    named = placed.groupBy("comp").agg(F.min("least").alias("class_id"))
    return placed.join(named, "comp").select("node", "comp", "class_id", "least")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row of each class, that of the least key, with all columns as they were."""
    nodes = _nodes(docs, key, text, similar)
    if "least" in nodes.columns:
        first = nodes.groupBy("comp").agg(F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("m"))
        nodes = first.select(F.col("m.node").alias("node"))
    else:
        nodes = nodes.select("node")
    columns = docs.columns
    packed = docs.select(
        F.expr(NODE.replace("text", f"`{text}`")).alias("node"),
        F.struct(F.col(key).isNull().alias("__none"), F.col(key).alias("__key"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row")).alias("x"),
    )
    kept = packed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("x").alias("x"))
    return kept.select(*[F.col(f"x.row.c{i}").alias(c) for i, c in enumerate(columns)])
