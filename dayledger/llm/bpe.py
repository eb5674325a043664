"""Byte-level BPE by ranks, with a segment tree per word.

The tree stands over the word's byte positions. A live position holds the rank of the pair that
starts there, a dead one infinity; ranks carry their position, so the root is the leftmost minimum.
A merge changes three leaves (the merged pair, its live neighbour to the left, the one swallowed)
and their ancestors. All words of one length class go through the same steps at once, as arrays; where
a class has few words, long ones mostly, each goes through them alone, which is the faster way there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.chunks import ChunkEncoder, sliced
from dayledger.llm.workers import in_arrow, kept

NONE = np.iinfo(np.int64).max
CELLS = 1 << 22  # tree nodes held at once
FEW = 32  # words that are not worth a step of arrays


class Ranks:
    """Mergeable ranks: bytes of each id, and the id of each pair of ids that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_ids < 0).any():
            raise ValueError("every single byte needs a rank")
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        keys = np.array([p[0] for p in pairs], np.uint64)
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE)
        values, slots, mask = np.array([p[1] for p in pairs], np.int64), self._slot(keys), (1 << self.bits) - 1
        while len(keys):  # those that find their slot taken try the next one
            free = self.keys[slots] == np.uint64(2**64 - 1)
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.values[slots[won]] = values[won]
            keys, values, slots = keys[~won], values[~won], (slots[~won] + 1) & mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of each pair, or infinity."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots, out = self._slot(keys), np.full(len(keys), NONE)
        open_, mask = np.arange(len(keys)), (1 << self.bits) - 1
        while len(open_):
            there = self.keys[slots]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[slots[hit]]
            go_on = ~hit & (there != np.uint64(2**64 - 1))
            open_, slots = open_[go_on], (slots[go_on] + 1) & mask
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as unsigned 32-bit integers; a word that is a token is that token."""
        out: list[bytes] = [b""] * len(words)
        classes: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif word:
                classes.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(k)
        for width, members in classes.items():
            rows = max(1, CELLS // (2 * width))
            for at in range(0, len(members), rows):
                some = [words[k] for k in members[at : at + rows]]
                found = self._merge(some, width) if len(some) > FEW else [self._merge_alone(w, width) for w in some]
                for k, ids in zip(members[at : at + rows], found, strict=True):
                    out[k] = ids
        return out

    def _merge_alone(self, word: bytes, width: int) -> bytes:
        n = len(word)
        first = self.byte_ids[np.frombuffer(word, np.uint8)]
        leaves = np.full(width, NONE)
        leaves[: n - 1] = self._leaf(first[:-1], first[1:], np.arange(n - 1), width)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [NONE, *np.concatenate(levels[::-1]).tolist()]
        ids, following, before = first.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, bytes_of, none = self.ranks.get, self.bytes_of, int(NONE)

        def put(at: int, pair: bytes | None) -> None:
            rank = None if pair is None else rank_of(pair)
            node = at + width
            tree[node] = none if rank is None else rank * width + at
            while node > 1:  # up to the first ancestor that stays as it is
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                low = a if a < b else b
                if tree[node] == low:
                    break
                tree[node] = low

        while tree[1] != none:
            merged, at = divmod(tree[1], width)
            swallowed = following[at]
            right = following[swallowed]
            ids[at], ids[swallowed], following[at] = merged, -1, right
            put(swallowed, None)
            if right < n:
                before[right] = at
            put(at, bytes_of[merged] + bytes_of[ids[right]] if right < n else None)
            if before[at] >= 0:
                put(before[at], bytes_of[ids[before[at]]] + bytes_of[merged])
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def _merge(self, words: list[bytes], width: int) -> list[bytes]:
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = self.byte_ids[text]
        place = np.arange(width)
        ids[place >= sizes[:, None]] = -1
        live = place < sizes[:, None] - 1  # positions with a right neighbour
        leaves = np.full((n, width), NONE)
        rows, cols = np.nonzero(live)
        leaves[rows, cols] = self._leaf(ids[rows, cols], ids[rows, cols + 1], cols, width)
        tree = np.empty((n, 2 * width), np.int64)
        tree[:, 0], tree[:, width:] = NONE, leaves
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        tree, ids = tree.ravel(), ids.ravel()
        following = np.tile(np.arange(1, width + 1), (n, 1)).ravel()
        before = np.tile(np.arange(-1, width - 1), (n, 1)).ravel()
        rows = np.flatnonzero(tree[1 :: 2 * width] != NONE)
        while len(rows):
            low = tree[rows * 2 * width + 1]
            at, base = low % width, rows * width
            swallowed = following[base + at]
            right = following[base + swallowed]
            ids[base + at] = low // width
            ids[base + swallowed] = -1
            following[base + at] = right
            has_right = right < sizes[rows]
            before[(base + right)[has_right]] = at[has_right]
            left = before[base + at]
            has_left = left >= 0
            self._set(tree, rows, swallowed, np.full(len(rows), NONE), width)
            new = np.full(len(rows), NONE)
            r = np.flatnonzero(has_right)
            new[r] = self._leaf(ids[base[r] + at[r]], ids[base[r] + right[r]], at[r], width)
            self._set(tree, rows, at, new, width)
            r = np.flatnonzero(has_left)
            self._set(tree, rows[r], left[r], self._leaf(ids[base[r] + left[r]], ids[base[r] + at[r]], left[r], width), width)
            rows = rows[tree[rows * 2 * width + 1] != NONE]
        alive = ids >= 0
        counts = alive.reshape(n, width).sum(axis=1)
        flat, ends = ids[alive].astype("<u4").tobytes(), np.cumsum(counts) * 4
        starts = np.concatenate(([0], ends))
        return [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist())]

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        rank = self.merged(left, right)
        found = rank != NONE
        return np.where(found, np.where(found, rank, 0) * width + at, NONE)

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray, width: int) -> None:
        """Point update: a leaf of each row, then its ancestors."""
        base, node = rows * 2 * width, at + width
        tree[base + node] = value
        while width > 1:
            node = node >> 1
            tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])
            width >>= 1


@kept
@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as file:
        return Ranks({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token})


@kept
@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> ChunkEncoder:
    """The encoder of a rank file, one per Python worker."""
    ranks, split = load_ranks(path), regex.compile(pattern)

    def encode(texts: list[str]) -> list[bytes]:
        words = [split.findall(t) for t in texts]
        distinct = list({w for ws in words for w in ws})
        ids = dict(zip(distinct, ranks.encode_words([w.encode() for w in distinct]), strict=True))
        return [b"".join(map(ids.__getitem__, ws)) for ws in words]

    return ChunkEncoder(encode)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode every `text` (null: empty) and decode it again: doc_id, n_tokens, ids_sha256 (of the
    decimal ids joined by commas), decoded_sha256 and, if wished, ids. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = rank_encoder(ranks, pattern), load_ranks(ranks).bytes_of
        digits = [str(i).encode() for i in range(len(table))]
        for batch in sliced(batches, "text", 8 << 20):
            flat, bounds = encode(batch.column("text"))
            edges = bounds.tolist()
            spelled, decoded = [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                ids = flat[a:b].tolist()
                spelled.append(hashlib.sha256(b",".join([digits[i] for i in ids])).hexdigest())
                decoded.append(hashlib.sha256(decode(ids, table)).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(spelled, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(arrays)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if with_ids else "")
    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema, "bpe")


def decode(ids: list[int], bytes_of: list[bytes]) -> bytes:
    return b"".join([bytes_of[i] for i in ids])
