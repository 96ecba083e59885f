"""N-gram Jaccard join with signature trees: documents whose shingle sets agree by 80 % or more.

A text is the set of its distinct five-word shingles (all its words as one, if fewer). Equal sets are
one node. Two sets of Jaccard similarity 0.8 share one of the first ``size - ceil(0.8 size) + 1`` shingles of
each in any common order, so nodes that hold the same such shingle meet in a bucket, and no link
lies outside of a bucket. The order puts shingles of few documents first (read from a table of counters; any
table gives the same links), and buckets of the same nodes are joined once.

Nodes of a bucket are the leaves of a signature tree: an inner tree node holds the OR of the token bitmaps
below it, the range of their set sizes and the most tokens that share a bit. A pair of tree nodes is followed
only if the tokens that their bitmaps have in common, and those hidden behind shared bits, could make two sets
similar. All trees of a task are walked together, level by level.

First, each node is paired with its most promising partner of each bucket (large buckets in blocks,
the bucket's best known node in each). Pairs are verified on the whole sets, and verified pairs give
components. A bucket within one component is done. In the others, every pair of different components that the
trees let through is verified: listed pair by pair in a small bucket; in large ones leaves
of one component, or of several small ones, are made once for all buckets, summarised, pruned against each other and the
remaining pairs of leaves compared on whole sets within a task, which returns the links of a spanning forest.

Null text counts as empty. Texts without words have no shingles, link with nothing and are their own
component. Null keys count only where a component has no other. Repeated rows are in one component. Extra columns are not
looked at. Intermediate tables go to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import U, map_batches, mixed, ragged, slices
from obsflow.llm.near_duplicates import CELLS, components, document_shares, shingles
from obsflow.sources.session import scratch_path

#: Similarity as a fraction, so that no test is rounded.
NUMERATOR, DENOMINATOR = 4, 5
#: Words of the narrowest bitmap; it serves sets of up to DENSE tokens a word, and each further width twice as many.
WORDS, DENSE = 16, 48
FAN = 8
#: Nodes whose texts are fetched by sending their ids to all tasks; beyond, texts and ids are joined by sorting.
SENT = 500_000
#: Nodes of a block of a large bucket, of a listed bucket at most, of a leaf about; rows of a task's group about.
BLOCK, LISTED, LEAF, PACK = 256, 32, 64, 8192
_PAIRS = 4096


def similar(shared: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Does an overlap of this size make sets of these sizes similar?"""
    return (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * (one + other)


def prefix_sizes(sizes: np.ndarray) -> np.ndarray:
    return sizes - (NUMERATOR * sizes + DENOMINATOR - 1) // DENOMINATOR + 1


def signatures(hashes: np.ndarray, row: np.ndarray, rows: int, words: int = WORDS) -> np.ndarray:
    """Bitmap of each row's tokens, ``words`` times 64 bits."""
    bit = (hashes >> U(20)).astype(np.int64) & (64 * words - 1)
    place = np.unique(row.astype(np.int64) * 64 * words + bit)
    flags = np.zeros(rows * 64 * words, np.uint8)
    flags[place] = 1
    return np.packbits(flags, bitorder="little").view(U).reshape(rows, words)


def widths(sizes: np.ndarray) -> np.ndarray:
    """Words of the bitmap of sets of these sizes."""
    return WORDS << np.ceil(np.log2(np.maximum(sizes / (DENSE * WORDS), 1))).astype(np.int64)


def folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps half as wide."""
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


class Forest:
    """Signature trees over groups of sets, level 0 the sets themselves, each group in the order given."""

    def __init__(self, group: np.ndarray, sizes: np.ndarray, bits: np.ndarray):
        held = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = {"group": group, "bits": bits, "low": sizes, "high": sizes, "hidden": sizes - held}
        self.levels, self.children = [level], []
        while True:
            last = self.levels[-1]["group"]
            start = np.flatnonzero(np.diff(last, prepend=-1))
            if len(start) == len(last):
                break
            place = np.arange(len(last)) - np.repeat(start, np.diff(np.append(start, len(last))))
            cut = np.flatnonzero(place % FAN == 0)
            self.children.append(np.append(cut, len(last)))
            below = self.levels[-1]
            self.levels.append(
                {
                    "group": last[cut],
                    "bits": np.bitwise_or.reduceat(below["bits"], cut, axis=0),
                    "low": np.minimum.reduceat(below["low"], cut),
                    "high": np.maximum.reduceat(below["high"], cut),
                    "hidden": np.maximum.reduceat(below["hidden"], cut),
                }
            )

    def _possible(self, depth: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tree nodes that could hold a similar pair, and the most tokens it could share."""
        x = self.levels[depth]
        fits = (DENOMINATOR * x["high"][a] >= NUMERATOR * x["low"][b]) & (DENOMINATOR * x["high"][b] >= NUMERATOR * x["low"][a])
        shared = np.bitwise_count(x["bits"][a] & x["bits"][b]).sum(axis=1, dtype=np.int64) + np.minimum(x["hidden"][a], x["hidden"][b])
        shared = np.minimum(shared, np.minimum(x["high"][a], x["high"][b]))
        return fits & similar(shared, x["low"][a], x["low"][b]), shared

    def pairs(self, roots: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of sets (first before second) that no bound rules out, with the bound; by default within each tree.

        ``roots`` are pairs of trees, by their place among all trees, to be walked against each other.
        """
        top = len(self.levels) - 1
        if not len(self.levels[0]["group"]):
            return
        if roots is None:
            every = np.arange(len(self.levels[top]["group"]))
            roots = (every, every)
        todo = [(top, *roots)]
        while todo:
            depth, a, b = todo.pop()
            if len(a) > _PAIRS and depth:
                todo += [(depth, a[i : i + _PAIRS], b[i : i + _PAIRS]) for i in range(0, len(a), _PAIRS)]
                continue
            if depth == 0:
                yield from self._leaves(a, b)
                continue
            good, _ = self._possible(depth, a, b)
            a, b = a[good], b[good]
            if not len(a):
                continue
            child = self.children[depth - 1]
            na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
            one = np.repeat(ragged(child[a], na), np.repeat(nb, na))
            two = ragged(np.repeat(child[b], na), np.repeat(nb, na))
            same = np.repeat(np.repeat(a == b, na), np.repeat(nb, na))
            keep = ~same | (one < two if depth == 1 else one <= two)
            todo.append((depth - 1, one[keep], two[keep]))

    def _leaves(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        step = max(256, 16 * _PAIRS * WORDS // self.levels[0]["bits"].shape[1])
        for i in range(0, len(a), step):
            x, y = a[i : i + step], b[i : i + step]
            # A tree of one set is its own root.
            x, y = x[x != y], y[x != y]
            good, shared = self._possible(0, x, y)
            yield x[good], y[good], shared[good]


def _store(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"trees-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


TEXT_ID = "unhex(md5(text))"


def describe(rows: DataFrame, shares: np.ndarray) -> DataFrame:
    """Per row of ``key``, ``tid``, ``text``: the set's ``node``, ``size``, ``prefix`` and ``bits``; null node without shingles."""
    shared = rows.sparkSession.sparkContext.broadcast(shares)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            hashes, _, row = shingles(piece["text"])
            n = len(piece)
            sizes = np.bincount(row, minlength=n)
            # Two sums of mixed hashes name a set.
            sums = [np.zeros(n, U), np.zeros(n, U)]
            filled, first = np.unique(row, return_index=True)
            if len(first):
                for total, salt in zip(sums, (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), strict=True):
                    total[filled] = np.add.reduceat(mixed(hashes ^ U(salt)), first)
            names = np.stack([s ^ U(i) + sizes.astype(U) for i, s in enumerate(sums)], axis=1).tobytes()
            nodes = [names[16 * i : 16 * i + 16] if s else None for i, s in enumerate(sizes.tolist())]
            share = shared.value[(hashes & U(CELLS - 1)).astype(np.int64)]
            order = np.lexsort((hashes, share, row))
            start = np.zeros(n + 1, np.int64)
            np.cumsum(sizes, out=start[1:])
            counts = np.where(sizes > 0, prefix_sizes(sizes), 0)
            tokens = hashes[order][ragged(start[:-1], counts)] if len(hashes) else hashes
            ends = np.append(0, np.cumsum(counts))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens.view(np.int64)))
            columns = [piece["key"], piece["tid"], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), lists, pa.array(_bitmaps(hashes, row, sizes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "tid", "node", "size", "prefix", "bits"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, work, f"key {kind}, tid binary, node binary, size long, prefix array<long>, bits binary")


def _bitmaps(hashes: np.ndarray, row: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    wide, out = widths(sizes), [b""] * len(sizes)
    for words in np.unique(wide).tolist():
        mine = np.flatnonzero(wide == words)
        place = np.full(len(sizes), -1)
        place[mine] = np.arange(len(mine))
        own = place[row] >= 0
        for i, bits in zip(mine.tolist(), signatures(hashes[own], place[row[own]], len(mine), words), strict=True):
            out[i] = bits.tobytes()
    return out


def buckets_of(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``node`` and ``held`` (nodes of the bucket); of buckets with the same nodes one, none of a single node."""
    # The same filter on both sides of the join, so that both read one exchange.
    tokens = nodes.select("node", F.explode("prefix").alias("token")).where("token IS NOT NULL").repartition("token")
    held = tokens.groupBy("token").agg(F.count("*").alias("held"), *[F.expr(f"bit_xor(xxhash64(node, {i}))").alias(f"x{i}") for i in (1, 2)])
    once = held.where("held > 1").groupBy("held", "x1", "x2").agg(F.min("token").alias("bucket")).select("bucket", "held")
    return tokens.join(once, F.col("token") == F.col("bucket")).select("bucket", "node", "held")


def _packs(rows: int) -> int:
    return max(1, -(-rows // PACK))


def partners(members: DataFrame, nodes: DataFrame, rows: int) -> DataFrame:
    """Each node with its most promising partner of each bucket (``a`` < ``b``), if the trees leave it one."""
    full = members.join(nodes.select("node", "size", "bits", "known"), "node")
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    cut = full.withColumn("block", F.when(F.col("held") <= BLOCK, 0).otherwise(F.pmod(F.xxhash64("node"), blocks)).cast("int"))
    best = full.where(F.col("held") > BLOCK).groupBy("bucket").agg(F.max(F.struct("known", "node", "size", "bits", "held")).alias("x"))
    best = best.select("bucket", "x.*").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    columns = ["bucket", "block", "node", "size", "bits", "known"]
    every = cut.select(*columns).union(best.select(*columns)).withColumn("pack", F.pmod(F.xxhash64("bucket", "block"), F.lit(_packs(rows))).cast("int"))

    def choose(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("bucket", "ascending"), ("block", "ascending"), ("size", "ascending"), ("node", "ascending")])
        known = group["known"].to_numpy()
        rank = np.empty(len(known), np.int64)
        by_rank = np.lexsort((np.arange(len(known)), known))
        rank[by_rank] = np.arange(len(known))
        sizes = group["size"].to_numpy()
        best = np.full(len(known), -1, np.int64)
        for a, b, shared in _walked(group, ("bucket", "block")):
            score = 100 * shared // np.maximum(sizes[a] + sizes[b] - shared, 1) << 32
            np.maximum.at(best, a, score | rank[b])
            np.maximum.at(best, b, score | rank[a])
        own = np.flatnonzero(best >= 0)
        return _pair_table(group, own, by_rank[best[own] & 0xFFFFFFFF])

    return every.groupBy("pack").applyInArrow(choose, "a binary, b binary")


def _walked(group: pa.Table, by: tuple[str, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that no bound rules out, within the trees of rows equal in ``by``; rows are sorted by these and size.

    There is a tree for each width of bitmaps. Sets just above its limit are in it
    as well, their bitmaps folded, since they may be similar to sets just below.
    """
    new = np.zeros(group.num_rows, bool)
    for c in by:
        k = group[c].to_numpy()
        new[1:] |= k[1:] != k[:-1]
    tree, sizes, blobs = np.cumsum(new), group["size"].to_numpy(), group["bits"].to_pylist()
    wide = widths(sizes)
    for words in np.unique(wide).tolist():
        mine = np.flatnonzero((wide == words) | (wide == 2 * words) & (NUMERATOR * sizes <= DENOMINATOR * DENSE * words))
        bits = np.empty((len(mine), words), U)
        guest = wide[mine] > words
        for part, width in ((np.flatnonzero(~guest), words), (np.flatnonzero(guest), 2 * words)):
            if len(part):
                raw = np.frombuffer(b"".join([blobs[i] for i in mine[part].tolist()]), U).reshape(len(part), width)
                bits[part] = folded(raw) if width > words else raw
        for a, b, shared in Forest(tree[mine], sizes[mine], bits).pairs():
            yield mine[a], mine[b], shared


def _pair_table(group: pa.Table, left: np.ndarray, right: np.ndarray) -> pa.Table:
    nodes = group["node"].to_pylist()
    pairs = sorted({(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in zip(left.tolist(), right.tolist(), strict=True) if nodes[i] != nodes[j]})
    return pa.table([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])


def listed_pairs(open_members: DataFrame, nodes: DataFrame, rows: int) -> DataFrame:
    """Every pair of different components that the trees of small buckets let through."""
    full = open_members.join(nodes.select("node", "size", "bits"), "node").withColumn("pack", F.pmod(F.xxhash64("bucket"), F.lit(_packs(rows))).cast("int"))

    def walk(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("bucket", "ascending"), ("size", "ascending"), ("node", "ascending")])
        comp = np.unique(np.array(group["comp"].to_pylist(), object), return_inverse=True)[1]
        found = [(a[comp[a] != comp[b]], b[comp[a] != comp[b]]) for a, b, _ in _walked(group, ("bucket",))]
        none = np.zeros(0, np.int64)
        left, right = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)
        return _pair_table(group, left, right)

    return full.groupBy("pack").applyInArrow(walk, "a binary, b binary")


def leaf_links(open_members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components within large buckets, a spanning forest per pair of leaves.

    Nodes are gathered under the best known node of their buckets, which tends to be one for all buckets of a group of near
    copies. A leaf is of one component where that has enough nodes there, else of several small ones.
    """
    lead = open_members.groupBy("bucket").agg(F.max(F.struct("known", "node")).alias("lead"))
    home = open_members.join(lead, "bucket").groupBy("node", "comp").agg(F.max("lead").alias("h")).select("node", "comp", F.col("h.node").alias("home"))
    alone = home.groupBy("home", "comp").agg(F.count("*").alias("many"))
    rest = alone.where(F.col("many") < LEAF).groupBy("home").agg(F.sum("many").alias("few"))
    placed = home.join(alone, ["home", "comp"]).join(rest, "home", "left")
    pure = F.col("many") >= LEAF
    cut = F.when(pure, F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / LEAF))).otherwise(F.pmod(F.xxhash64("comp"), F.ceil(F.col("few") / LEAF)))
    placed = placed.withColumn("cut", cut).withColumn("pure", F.when(pure, F.col("comp"))).select("node", "comp", "home", "cut", "pure")
    placed = placed.join(nodes.select("node", "size", "bits"), "node").withColumn("leaf", F.xxhash64("home", "pure", "cut", F.length("bits")))
    placed = _store(placed.drop("home", "cut"), "leaves")

    def summary(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        bits = np.frombuffer(b"".join(group["bits"].to_pylist()), U).reshape(group.num_rows, -1)
        sizes = group["size"].to_numpy()
        hidden = int((sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)).max())
        values = [group["leaf"][0].as_py(), group["pure"][0].as_py(), int(sizes.min()), int(sizes.max()), hidden, np.bitwise_or.reduce(bits).view(np.int64).tolist()]
        return pa.table([pa.array([v], k) for v, k in zip(values, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["leaf", "pure", "low", "high", "hidden", "words"])

    leaves = _store(placed.groupBy("leaf").applyInArrow(summary, "leaf long, pure binary, low long, high long, hidden long, words array<long>"), "summaries")
    met = open_members.join(placed.select("node", "leaf"), "node").select("bucket", "leaf").distinct()
    pairs = met.alias("x").join(met.alias("y"), "bucket").where("x.leaf <= y.leaf").select(F.col("x.leaf").alias("lo"), F.col("y.leaf").alias("hi")).distinct()
    one, two = (leaves.select(*[F.col(c).alias(f"{c}_{s}") for c in leaves.columns]) for s in ("a", "b"))
    both = pairs.join(one, F.col("lo") == F.col("leaf_a")).join(two, F.col("hi") == F.col("leaf_b"))
    # Bitmaps of different widths say nothing of each other; sizes do.
    common = "aggregate(zip_with(words_a, words_b, (p, q) -> bit_count(p & q)), 0L, (s, e) -> s + e) + least(hidden_a, hidden_b)"
    shared = f"CASE WHEN size(words_a) = size(words_b) THEN {common} ELSE high_a END"
    possible = (
        f"{DENOMINATOR} * high_a >= {NUMERATOR} * low_b AND {DENOMINATOR} * high_b >= {NUMERATOR} * low_a"
        f" AND {NUMERATOR + DENOMINATOR} * least({shared}, high_a, high_b) >= {NUMERATOR} * (low_a + low_b) AND NOT coalesce(pure_a = pure_b, false)"
    )
    pairs = _store(both.where(possible).select("lo", "hi"), "leaf-pairs")
    sides = pairs.select("lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("leaf"))
    full = sides.join(placed.drop("bits", "pure"), "leaf").join(sets.select("node", "tokens"), "node")
    return full.groupBy("lo", "hi").applyInArrow(_compare_leaves, "a binary, b binary")


def _compare_leaves(group: pa.Table) -> pa.Table:
    """Links between sets of different components of two leaves (or of one), enough to span them."""
    group = group.combine_chunks().sort_by([("leaf", "ascending"), ("size", "ascending"), ("node", "ascending")])
    n = group.num_rows
    sizes, leaf = group["size"].to_numpy(), group["leaf"].to_numpy()
    tokens = np.frombuffer(b"".join(group["tokens"].to_pylist()), U)
    row = np.repeat(np.arange(n), sizes)
    # Wide bitmaps for these few sets: two bits a token at least.
    words = max(WORDS, 1 << int(2 * sizes.max() // 64).bit_length()) if n else WORDS
    tree = np.cumsum(np.diff(leaf, prepend=leaf[:1]) != 0)
    forest = Forest(tree, sizes, signatures(tokens, row, n, min(words, 1024)))
    comp = np.unique(np.array(group["comp"].to_pylist(), object), return_inverse=True)[1]
    roots = (np.array([0]), np.array([int(tree[-1])])) if n else None
    wanted = np.zeros((n, n), bool)
    for a, b, _ in forest.pairs(roots):
        apart = comp[a] != comp[b]
        wanted[a[apart], b[apart]] = True
    involved = np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1))
    if not len(involved):
        return _pair_table(group, involved, involved)
    place = np.full(n, -1)
    place[involved] = np.arange(len(involved))
    own = place[row] >= 0
    _, column, held = np.unique(tokens[own], return_inverse=True, return_counts=True)
    at, column = place[row][own], column
    common = np.cumsum(held > 1) - 1
    some = held[column] > 1
    at, column = at[some], common[column[some]]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    shared = np.zeros((len(involved), len(involved)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        low, high = np.searchsorted(column, (first, first + 8192))
        part = np.zeros((len(involved), 8192), np.float32)
        part[at[low:high], column[low:high] - first] = 1
        shared += part @ part.T
    good = similar(shared.astype(np.int64), sizes[involved][:, None], sizes[involved][None, :]) & wanted[np.ix_(involved, involved)]
    left, right = (involved[x] for x in np.nonzero(good))
    # One link joins two components; more of them add nothing.
    parent = list(range(int(comp.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        x, y = find(comp[i]), find(comp[j])
        if x != y:
            parent[x] = y
            keep.append((i, j))
    return _pair_table(group, np.array([k[0] for k in keep], np.int64), np.array([k[1] for k in keep], np.int64))


def token_sets(texts: DataFrame) -> DataFrame:
    """Sorted shingle hashes (``tokens``, binary) of ``node``, ``text``."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            hashes, _, row = shingles(piece["text"])
            ends = np.searchsorted(row, np.arange(len(piece) + 1))
            raw = [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([piece["node"], pa.array(raw, pa.binary())], names=["node", "tokens"])

    return map_batches(texts.select("node", "text"), work, "node binary, tokens binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets are similar."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(bool(similar(shared, len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    size = "length({}) DIV 8"
    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    full = full.where(f"{DENOMINATOR} * {size.format('x')} >= {NUMERATOR} * {size.format('y')} AND {DENOMINATOR} * {size.format('y')} >= {NUMERATOR} * {size.format('x')}")
    return map_batches(full.select("a", "b", "x", "y"), work, "a binary, b binary")


def link(rows: DataFrame, described: DataFrame) -> DataFrame | None:
    """``node`` and ``comp`` of every node with a link; None if there is no link."""
    nodes = _store(described.where("node IS NOT NULL").select("node", "tid", "size", "prefix", "bits").dropDuplicates(["node"]), "nodes")
    members = _store(buckets_of(nodes), "members")
    count = members.count()
    if not count:
        return None
    nodes = nodes.drop("prefix")
    # In how many other nodes' company a node is.
    known = members.groupBy("node").agg(F.sum("held").alias("known"))
    met = _store(nodes.join(known, "node"), "met")
    tried = _store(partners(members, met, count).distinct(), "tried")
    # A node without a partner in any of its buckets has no link, unless it was not compared with all of a large one.
    needed = tried.select(F.explode(F.array("a", "b")).alias("node")).union(members.where(F.col("held") > BLOCK).select("node")).distinct()
    needed = _store(met.select("node", "tid", "known").join(needed, "node"), "needed")
    few = needed.count()
    if not few:
        return None
    ids = needed.select("tid", "node")
    texts = rows.select("tid", "text").join(F.broadcast(ids) if few <= SENT else ids, "tid").dropDuplicates(["node"])
    sets = _store(token_sets(texts), "sets")
    members = members.join(needed.select("node", "known"), "node")
    links = _store(verified(tried, sets), "links")
    comps = components(links, _store)
    placed = members.join(comps, "node", "left").select("bucket", "node", "held", "known", F.coalesce("comp", "node").alias("comp"))
    open_ = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("bucket")
    placed = _store(placed.join(open_, "bucket").where("held > 2"), "open")
    listed = listed_pairs(placed.where(F.col("held") <= LISTED), met, count).distinct().join(tried, ["a", "b"], "left_anti")
    more = _store(verified(_store(listed, "listed"), sets), "more")
    large = placed.where(F.col("held") > LISTED)
    if not large.isEmpty():
        more = more.union(_store(leaf_links(large, met, sets), "across"))
    if more.isEmpty():
        return None if links.isEmpty() else comps
    return components(links.union(more), _store)


def join_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_shingles`` and ``component_id``, the least key reachable by links (itself included)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).selectExpr("key", f"{TEXT_ID} AS tid", "text")
    described = _store(describe(rows, document_shares(rows.select("text"))), "described")
    comps = link(rows, described)
    least = described.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("least"))
    if comps is None:
        named = least.select("node", F.col("least").alias("component"))
    else:
        placed = _store(least.join(comps, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp")), "placed")
        named = placed.join(placed.groupBy("comp").agg(F.min("least").alias("component")), "comp").select("node", "component")
    whole = described.select("key", "node", "size").join(named, "node", "left")
    return whole.select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
    )
