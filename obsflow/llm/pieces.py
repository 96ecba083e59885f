"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a slice are laid end to end and their suffixes sorted by
prefix doubling, only as deep as the longest vocabulary piece. Every piece is
then looked up by binary search; the suffixes in its range are its occurrences,
that is, edges of the segmentation lattice. Edges are sorted by where they end
in their word and relaxed in that order, all words of the slice at once.

The model is of the BPE kind, where a segmentation is right exactly if each two
neighbouring pieces would come out as they are when encoded alone. So relaxing
an edge keeps it if its start was reached and its piece may follow the piece
that reached it; one edge at most survives per place, and the result equals
merging by rank. Pair tests undo the two pieces' last merges step by step.

Characters without a piece become byte pieces. Runs of spaces longer than one,
whose pieces all rank alike, are cut greedily from the left. Null and empty text
give no pieces. U+2581 is how pieces write a space, so a text that holds it decodes with a
space there, as the library has it, and is no round trip.

Memory is bounded by a cache of words, a slice of texts and, in matching, ``BATCH``
characters of words. A word longer than ``LONG`` is first cut where no piece spans the
cut, which leaves its pieces as they are; only a longer stretch that pieces
span throughout (one letter over and over) is matched as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.batches import map_batches, ragged, slices

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SLICE_BYTES = 2_000_000
CACHED_WORDS = 100_000
BATCH, LONG = 1 << 18, 1024
NONE = -1


class Vocabulary:
    """Pieces of a BPE model with the tables that pair tests need.

    Ranks number the mergeable pieces from the one merged first; single
    characters come before all merges.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model_file

        model = model_file.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, kinds = model.normalizer_spec, model_file.ModelProto.SentencePiece
        if model.trainer_spec.model_type != 2 or norm.name != "identity" or norm.remove_extra_whitespaces:
            raise ValueError("a BPE model without text normalisation is needed")
        normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.spaces = {len(p): i for p, i, _ in normal if set(p) == {SPACE} and len(p) > 1}
        normal = [x for x in normal if not (len(x[0]) > 1 and set(x[0]) == {SPACE})]
        if any(SPACE in p[1:] for p, _, _ in normal):
            raise ValueError("pieces that hold a space after another character are not supported")
        normal.sort(key=lambda x: (len(x[0]) > 1, -x[2], x[1]))
        self.prefix = norm.add_dummy_prefix
        self.size = len(model.pieces)
        self.ids = np.array([i for _, i, _ in normal])
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                self.bytes.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                self.bytes.append(b"" if p.type == kinds.CONTROL else p.piece.replace(SPACE, " ").encode())
        self._tables([p for p, _, _ in normal])

    def _tables(self, pieces: list[str]) -> None:
        rank = {p: r for r, p in enumerate(pieces)}
        pairs: dict[tuple[int, int], int] = {}
        for p, r in rank.items():
            for cut in range(1, len(p)):
                left, right = rank.get(p[:cut]), rank.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = r
        self.left, self.right = np.arange(len(pieces)), np.arange(len(pieces))
        reached = np.ones(len(pieces), bool)
        for p, r in rank.items():
            parts = [rank.get(c, NONE) for c in p]
            while len(parts) > 2:
                merges = [(pairs.get((a, b), len(pieces)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
                best, at = min(merges)
                if best >= r:
                    break
                parts[at : at + 2] = [best]
            if len(parts) == 2 and pairs.get((parts[0], parts[1])) == r:
                self.left[r], self.right[r] = parts
            elif len(p) > 1:
                reached[r] = False
        keys = np.array([a * len(pieces) + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(pairs.values()))[order]
        usable = np.flatnonzero(reached)
        self.ranks = usable
        self.lengths = np.array([len(pieces[r]) for r in usable])
        self.depth = int(self.lengths.max())
        self.longer = {pieces[r] for r in usable if len(pieces[r]) > 1}
        self.codes = np.zeros((len(usable), self.depth), np.int64)
        for i, r in enumerate(usable):
            self.codes[i, : len(pieces[r])] = [ord(c) for c in pieces[r]]
        in_piece = re.escape("".join(sorted({c for p in pieces for c in p})))
        self.words = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+" if "\n" not in in_piece else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def follows(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Would the two ranks, side by side, stay as they are when encoded?"""
        first, second = first.copy(), second.copy()
        ok, open_ = np.ones(len(first), bool), np.arange(len(first))
        limit = np.full(len(first), np.iinfo(np.int64).max)
        count = len(self.left)
        while len(open_):
            a, b = first[open_], second[open_]
            key = a * count + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[at] == key, self.pair_ranks[at], count)
            bad = (merged < count) & (merged < limit[open_])
            ok[open_[bad]] = False
            live = open_[~bad]
            a, b = first[live], second[live]
            # Undo the merge that came last: the later piece on the left gives its right half, else the other its left.
            undo_a = (a > b) & (self.right[a] != a) | (self.left[b] == b) & (self.right[a] != a)
            undo_b = ~undo_a & (self.left[b] != b)
            limit[live] = np.where(undo_a, a, np.where(undo_b, b + 1, limit[live]))
            first[live] = np.where(undo_a, self.right[a], a)
            second[live] = np.where(undo_b, self.left[b], b)
            open_ = live[undo_a | undo_b]
        return ok


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the next ``depth`` codes or more (prefix doubling)."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    known = 1
    while True:
        later = np.zeros(len(codes), np.int64)
        later[: max(0, len(codes) - known)] = rank[known:] + 1
        key = rank * (len(codes) + 1) + later
        order = np.argsort(key)
        known *= 2
        if known >= depth:
            return order
        step = np.empty(len(codes), np.int64)
        step[0], step[1:] = 0, key[order][1:] != key[order][:-1]
        rank = np.empty(len(codes), np.int64)
        rank[order] = np.cumsum(step)


def occurrences(codes: np.ndarray, order: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Range in ``order`` of the suffixes that start with each piece."""
    low = np.zeros(len(vocab.ranks), np.int64)
    high = np.full(len(vocab.ranks), len(codes))
    padded = np.append(codes, np.full(vocab.depth, -1))
    for depth in range(vocab.depth):
        at = np.flatnonzero((vocab.lengths > depth) & (low < high))
        want = vocab.codes[at, depth]
        bounds = []
        for strict in (False, True):
            a, b = low[at].copy(), high[at].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                middle = (a + b) // 2
                have = padded[order[np.minimum(middle, len(codes) - 1)] + depth]
                up = open_ & (have <= want if strict else have < want)
                a = np.where(up, middle + 1, a)
                b = np.where(open_ & ~up, middle, b)
            bounds.append(a)
        low[at], high[at] = bounds
    return low, np.maximum(low, high)


def cut_long(word: str, vocab: Vocabulary) -> list[str]:
    """The word in parts of about ``LONG`` characters, no piece spanning two of them."""
    parts, first, size = [], 0, LONG
    while len(word) - first > size:
        place = next((p for p in range(first + size, first + size // 2, -1) if not _spanned(word, p, vocab)), None)
        if place is None:
            size *= 2
        else:
            parts.append(word[first:place])
            first, size = place, LONG
    return [*parts, word[first:]]


def _spanned(word: str, place: int, vocab: Vocabulary) -> bool:
    return any(
        word[a:b] in vocab.longer
        for a in range(max(0, place - vocab.depth + 1), place)
        for b in range(place + 1, min(len(word), a + vocab.depth) + 1)
    )


def encode_batched(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """:func:`encode_words` in batches, long words in parts."""
    parts, owner = [], []
    for i, w in enumerate(words):
        own = cut_long(w, vocab) if len(w) > LONG else [w]
        parts += own
        owner += [i] * len(own)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    ranks, counts, first = [], [], 0
    while first < len(parts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BATCH, side="right")))
        found = encode_words(parts[first:last], vocab)
        ranks.append(found[0])
        counts.append(found[1])
        first = last
    return np.concatenate(ranks), np.bincount(owner, weights=np.concatenate(counts), minlength=len(words)).astype(np.int64)


def encode_words(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (or ``-2 - code`` for characters without a piece) of all words, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    raw = "\0".join(words) + "\0"
    codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    order = suffix_order(codes, vocab.depth)
    low, high = occurrences(codes, order, vocab)
    counts = high - low
    start = order[ragged(low, counts)]
    rank, length = np.repeat(vocab.ranks, counts), np.repeat(vocab.lengths, counts)
    word_of = np.repeat(np.arange(len(words)), sizes + 1)
    known = np.zeros(len(codes), bool)
    known[start[length == 1]] = True
    inner = np.ones(len(codes), bool)
    inner[begin + sizes] = False
    single = np.flatnonzero(~known & inner)
    start = np.concatenate([start, single])
    rank = np.concatenate([rank, -2 - codes[single]])
    length = np.concatenate([length, np.ones(len(single), np.int64)])

    end = start + length
    depth = end - begin[word_of[start]]
    by_end = np.argsort(depth.astype(np.uint16) if sizes.max() < 65536 else depth, kind="stable")
    start, rank, end, depth = start[by_end], rank[by_end], end[by_end], depth[by_end]
    last = np.full(len(codes) + 1, NONE)
    came = np.full(len(codes) + 1, NONE)
    first = np.zeros(len(codes) + 1, bool)
    first[begin] = True
    cuts = np.flatnonzero(np.diff(depth, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(depth)), strict=True):
        s, r, e = start[a:b], rank[a:b], end[a:b]
        reached = first[s] | (last[s] != NONE)
        s, r, e = s[reached], r[reached], e[reached]
        test = np.flatnonzero(~first[s] & (r >= 0) & (last[s] >= 0))
        keep = np.ones(len(s), bool)
        keep[test] = vocab.follows(last[s[test]], r[test])
        last[e[keep]], came[e[keep]] = r[keep], s[keep]

    at, word = begin + sizes, np.arange(len(words))
    found = []
    while len(at):
        go = at > begin[word]
        at, word = at[go], word[go]
        found.append((word, at, last[at]))
        at = came[at]
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    word, at, rank = (np.concatenate(x) for x in zip(*found, strict=True))
    by_place = np.argsort(at)
    return rank[by_place], np.bincount(word, minlength=len(words))


def _space_ids(count: int, vocab: Vocabulary) -> list[int]:
    """Pieces of ``count`` spaces on their own, from the left."""
    one = int(vocab.ids[vocab.ranks[np.flatnonzero((vocab.lengths == 1) & (vocab.codes[:, 0] == ord(SPACE)))[0]]])
    out, longest = [], max(vocab.spaces, default=1)
    while count > 0:
        size = min(count, longest)
        while size > 1 and size not in vocab.spaces:
            size -= 1
        out.append(vocab.spaces.get(size, one))
        count -= size
    return out


class Encoder:
    """Encodes texts slice by slice; words seen before are not matched again."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        vocab = self.vocab
        cores = [SPACE + w.lstrip(SPACE) if w[0] == SPACE else w for w in words]
        ranks, counts = encode_batched(cores, vocab)
        at = np.cumsum(counts) - counts
        plain = ranks >= 0
        ids = np.where(plain, vocab.ids[np.maximum(ranks, 0)], ranks)
        special = {i for i, (w, c) in enumerate(zip(words, cores, strict=True)) if len(w) != len(c)}
        word_of = np.repeat(np.arange(len(words)), counts)
        special |= set(word_of[~plain].tolist())
        parts, sizes = [], counts.copy()
        last = 0
        for i in sorted(special):
            parts.append(ids[last : at[i]])
            own = list(chain.from_iterable([int(x)] if x >= 0 else vocab.byte_ids[list(chr(-2 - x).encode("utf-8", "replace"))].tolist() for x in ids[at[i] : at[i] + counts[i]].tolist()))
            extra = len(words[i]) - len(cores[i])
            if extra:
                alone = own[0] == _space_ids(1, vocab)[0]
                own = _space_ids(extra + alone, vocab) + own[alone:]
            parts.append(np.array(own, np.int64))
            sizes[i] = len(own)
            last = at[i] + counts[i]
        parts.append(ids[last:])
        base, old = len(self.flat), len(self.place)
        self.place.update(zip(words, range(old, old + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, *parts]).astype(np.int32)
        self.start = np.concatenate([self.start, base + np.cumsum(sizes) - sizes])
        self.count = np.concatenate([self.count, sizes])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts and the offsets of the texts in them."""
        find, prefix = self.vocab.words.findall, SPACE if self.vocab.prefix else ""
        words = [find(prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if len(self.place) > CACHED_WORDS:
            self._reset()
        new = list(dict.fromkeys(w for w in chain.from_iterable(words) if w not in self.place))
        if new:
            self._learn(new)
        index = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        counts = self.count[index]
        out = self.flat[ragged(self.start[index], counts)] if len(index) else np.zeros(0, np.int32)
        ends = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(sizes))]
        return out, ends

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.vocab.bytes.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.vocab.prefix and text.startswith(" ") else text


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker, so that they share the cache of words."""
    return Encoder(path)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row: ``key`` and ``token_ids``. The model file must be readable at this path on every executor."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for piece in slices(batches, "text", SLICE_BYTES):
            ids, ends = encoder.encode(piece["text"].to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece["key"], lists], names=["key", "token_ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, work, f"key {kind}, token_ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "token_ids", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row: ``key`` and ``text``; null ids give null text."""
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(texts, pa.string())], names=["key", "text"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, work, f"key {kind}, text string").withColumnRenamed("key", key)


def encode_checked(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """Per row: ``key``, ``token_ids``, ``n_tokens`` and whether decoding gives the text back (``round_trip``)."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model)
        for piece in slices(batches, "text", SLICE_BYTES):
            texts = piece["text"].to_pylist()
            ids, ends = encoder.encode(texts)
            same = [encoder.decode(ids[a:b].tolist()) == (t or "") for t, a, b in zip(texts, ends, ends[1:], strict=False)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            columns = [piece["key"], lists, pa.array(np.diff(ends)), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "token_ids", "n_tokens", "round_trip"])

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, token_ids array<int>, n_tokens long, round_trip boolean"
    return map_batches(rows, work, schema).withColumnRenamed("key", key)
