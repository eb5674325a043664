"""Re-Pair grammar compression of token ids, and the shard files that hold it.

Frequent neighbouring ids are replaced by nonterminals, round after round, until no pair occurs LEAST
times in the shard; a round replaces many pairs at once, leftmost first where they overlap, and none
across a document's end. So a passage that many documents of a shard share ends as one symbol in each. A shard file
holds the rules, how many ids each expands to, and where each document starts, so that any document,
or any range of ids in one, is decoded without the rest.

Layout, little-endian: `RPR1`, then unsigned 64-bit counts of documents, rules, symbols and
terminals, then arrays: document ids (int64; a null id is the smallest int64), first symbol of each
document and the end (int64), ids of each document (int64), expansion lengths (uint32), rules (two
symbols each), symbols. A symbol has as many bits as the largest needs, one behind the other, lowest
bit first; rules and symbols begin with a byte each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.chunks import library_encoder, sliced
from dayledger.llm.files import open_file, write_file
from dayledger.llm.workers import in_arrow
from dayledger.sinks.staging import fresh_path, stage

MAGIC = b"RPR1"
NULL_ID = np.iinfo(np.int64).min
LEAST = 16  # times a pair must occur in the shard
BITS = 17  # of the table of pairs
SHORT = 64  # ids of a rule that is expanded by a table
SHARD_IDS = 1 << 21


def compress(ids: np.ndarray, bounds: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (pairs) and the documents' bounds among the symbols."""
    seq, bounds = ids.astype(np.uint32), bounds.astype(np.int64)
    rules: list[np.ndarray] = []
    names, fresh = terminals, 0
    waiting = np.zeros(1 << BITS, bool)  # slots of frequent pairs that were not replaced everywhere
    while len(seq) > 1:
        ends = bounds[(bounds > 0) & (bounds < len(seq))] - 1
        inside = np.ones(len(seq) - 1, bool)
        inside[ends] = False
        if rules:
            # only pairs with a new symbol can have become frequent; of the others some wait
            new = seq >= fresh
            inside &= new[:-1] | new[1:] | waiting[_slot(seq[:-1], seq[1:])]
        at = np.flatnonzero(inside)
        # a pair in one number, the left symbol in the upper half; wider once 16 bits do not hold a symbol
        pair, half = (np.uint32, np.uint32(16)) if names <= 1 << 16 else (np.uint64, np.uint64(32))
        # nearly all places in the first round, few in later ones
        first, second = (seq[:-1][inside], seq[1:][inside]) if 2 * len(at) > len(seq) else (seq[at], seq[at + 1])
        pairs = (first.astype(pair) << half) | second.astype(pair)
        chosen = _frequent(pairs)
        left, right = (chosen >> half).astype(np.uint32), (chosen & ((pair(1) << half) - pair(1))).astype(np.uint32)
        slots = _slot(left, right)
        at, which = _occurrences(at, _slot(first, second), pairs, chosen, slots)
        often = np.bincount(which, minlength=len(chosen)) > 1  # the others met pairs before them
        at, which = at[often[which]], which[often[which]]
        if not len(at):
            break
        waiting[:] = False
        waiting[slots] = True
        used = np.flatnonzero(often)
        number = np.zeros(len(chosen), np.uint32)
        number[used] = names + np.arange(len(used))
        fresh, names = names, names + len(used)
        seq[at] = number[which]
        rules.append(np.stack([left[used], right[used]], 1))
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        bounds = bounds - np.searchsorted(at + 1, bounds)
        seq = seq[keep]
    return seq, np.concatenate([np.empty((0, 2), np.uint32), *rules]), bounds


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)


def _frequent(pairs: np.ndarray) -> np.ndarray:
    """The pairs that occur often enough, ascending."""
    if not len(pairs):
        return pairs
    ordered = np.sort(pairs)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    return ordered[starts[counts >= LEAST]]


def _occurrences(at: np.ndarray, slot: np.ndarray, pairs: np.ndarray, chosen: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places `at` are replaced, without overlaps, and by which pair of `chosen`."""
    if not len(chosen):
        return at[:0], at[:0]
    table = np.full(1 << BITS, -1, np.int32)
    table[slots] = np.arange(len(chosen), dtype=np.int32)
    which = table[slot]
    hit = np.flatnonzero(which >= 0)
    which = which[hit]
    same = chosen[which] == pairs[hit]  # a pair that lost its slot waits a round
    at, which = at[hit[same]], which[same]
    if not len(at):
        return at, which
    # every second place of a run of neighbours: places and numbers of places rise alike in one
    number = np.arange(len(at), dtype=np.int32 if len(at) < 1 << 31 else np.int64)
    run_start = np.zeros_like(number)
    new_run = at[1:] - at[:-1] > 1
    run_start[1:][new_run] = number[1:][new_run]
    np.maximum.accumulate(run_start, out=run_start)
    first = ((number - run_start) & 1) == 0
    return at[first], which[first]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int) -> np.ndarray:
    """The ids the symbols stand for. `lengths`: of what each rule stands for."""
    seq = symbols.astype(np.int64)
    long = np.concatenate((np.zeros(terminals, bool), lengths > SHORT))
    while (is_long := long[seq]).any():  # long rules give way to their pairs, level by level
        seq = _opened(seq, is_long, rules, terminals)
    starts, flat = _short_rules(rules, lengths, terminals)
    is_rule = seq >= terminals
    rule = seq[is_rule] - terminals
    taken = np.ones(len(seq), np.int64)
    taken[is_rule] = lengths[rule]
    ends = np.cumsum(taken)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    out[ends[~is_rule] - 1] = seq[~is_rule]
    sizes = lengths[rule]
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(ends[is_rule] - sizes, sizes) + within] = flat[np.repeat(starts[rule], sizes) + within]
    return out


def _opened(seq: np.ndarray, which: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The sequence with some of its rules replaced by their pairs."""
    at = np.arange(len(seq)) + np.cumsum(which) - which
    pairs = rules[seq[which] - terminals].astype(np.int64)
    out = np.empty(len(seq) + len(pairs), np.int64)
    out[at] = seq
    out[at[which]], out[at[which] + 1] = pairs[:, 0], pairs[:, 1]
    return out


def _short_rules(rules: np.ndarray, lengths: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """What rules of at most SHORT ids stand for, one after the other, and where each begins."""
    short = lengths <= SHORT
    sizes = np.where(short, lengths, 0)
    starts = np.cumsum(sizes) - sizes
    seq = rules[short].astype(np.int64).ravel()
    while (is_rule := seq >= terminals).any():  # all of them at once
        seq = _opened(seq, is_rule, rules, terminals)
    return starts, seq.astype(np.uint32)


def packed(symbols: np.ndarray, bits: int) -> bytes:
    """Numbers of so many bits, one behind the other."""
    if bits == 16:
        return symbols.astype("<u2").tobytes()
    eights = np.zeros((-(-len(symbols) // 8), 8), np.uint64)
    eights.ravel()[: len(symbols)] = symbols
    out = np.zeros((bits, len(eights)), np.uint8)  # of eight numbers so many bytes
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        shifted = eights[:, k] << np.uint64(shift)
        for j in range(-(-(shift + bits) // 8)):
            out[byte + j] |= (shifted >> np.uint64(8 * j)).astype(np.uint8)
    return out.T.tobytes()[: -(-len(symbols) * bits // 8)]


def unpacked(data: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """`n` numbers out of packed ones; `first` bits of the first byte are not theirs."""
    raw = np.zeros(len(data) + 8, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    at = first + bits * np.arange(n)
    byte, shift = at >> 3, (at & 7).astype(np.uint64)
    word = np.zeros(n, np.uint64)
    for k in range((bits + 14) // 8):
        word |= raw[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def symbol_bits(names: int) -> int:
    return max(1, (names - 1).bit_length())


def shard_bytes(doc_ids: np.ndarray, ids: np.ndarray, bounds: np.ndarray, terminals: int) -> bytes:
    symbols, rules, first = compress(ids, bounds, terminals)
    lengths = _rule_lengths(rules, terminals)
    bits = symbol_bits(terminals + len(rules))
    head = MAGIC + struct.pack("<4Q", len(doc_ids), len(rules), len(symbols), terminals)
    arrays = (doc_ids.astype("<i8"), first.astype("<i8"), np.diff(bounds).astype("<i8"), lengths.astype("<u4"))
    return head + b"".join(a.tobytes() for a in arrays) + packed(rules.ravel(), bits) + packed(symbols, bits)


def _rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    lengths = np.ones(terminals + len(rules), np.int64)  # of every symbol
    highest = np.maximum.accumulate(rules.max(axis=1)) if len(rules) else rules
    done = 0
    while done < len(rules):  # rules name symbols before them only: as many at once as name known ones
        end = int(np.searchsorted(highest, terminals + done))
        lengths[terminals + done : terminals + end] = lengths[rules[done:end]].sum(axis=1)
        done = end
    return lengths[terminals:]


class Shard:
    """A shard file opened for reading. Symbols are read only where they are asked for."""

    def __init__(self, file):
        self.file = file
        head = file.read(36)
        if len(head) < 36 or not head.startswith(MAGIC):
            raise ValueError("not a shard file")
        docs, rules, self.n_symbols, self.terminals = struct.unpack("<4Q", head[4:])
        self.doc_ids = self._array("<i8", docs)
        self.first = self._array("<i8", docs + 1)
        self.sizes = self._array("<i8", docs)
        self.lengths = self._array("<u4", rules).astype(np.int64)
        self.bits = symbol_bits(self.terminals + rules)
        self.at = file.tell()
        self.rules = self._numbers(0, 2 * rules).reshape(-1, 2)
        self.at += -(-2 * rules * self.bits // 8)
        if self.first[-1] != self.n_symbols:
            raise ValueError("documents do not end where the symbols do")

    def _array(self, kind: str, n: int) -> np.ndarray:
        data = self.file.read(n * np.dtype(kind).itemsize)
        if len(data) != n * np.dtype(kind).itemsize:
            raise ValueError("shard file is cut off")
        return np.frombuffer(data, kind)

    def _numbers(self, start: int, end: int) -> np.ndarray:
        first, last = start * self.bits // 8, -(-end * self.bits // 8)
        self.file.seek(self.at + first)
        data = self.file.read(last - first)
        if len(data) != last - first:
            raise ValueError("shard file is cut off")
        return unpacked(data, self.bits, start * self.bits - 8 * first, end - start)

    def symbols(self, start: int, end: int) -> np.ndarray:
        return self._numbers(start, end)

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the documents' bounds."""
        ids = expand(self.symbols(0, self.n_symbols), self.rules, self.lengths, self.terminals)
        bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        if len(ids) != bounds[-1]:
            raise ValueError("symbols do not expand to the stated ids")
        return ids, bounds

    def ids(self, doc: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start to end of the doc-th document: only symbols that reach into the range are expanded."""
        symbols = self.symbols(int(self.first[doc]), int(self.first[doc + 1])).astype(np.int64)
        sizes = np.ones(len(symbols), np.int64)
        is_rule = symbols >= self.terminals
        sizes[is_rule] = self.lengths[symbols[is_rule] - self.terminals]
        ends = np.cumsum(sizes)
        end = int(self.sizes[doc]) if end is None else min(end, int(self.sizes[doc]))
        if start >= end:
            return np.empty(0, np.uint32)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, end, "left")) + 1
        skip = start - int(ends[a] - sizes[a])
        return self._expand_few(symbols[a:b])[skip : skip + end - start]

    def _expand_few(self, symbols: np.ndarray) -> np.ndarray:
        stack, out = symbols[::-1].tolist(), []
        while stack:
            s = stack.pop()
            if s < self.terminals:
                out.append(s)
            else:
                left, right = self.rules[s - self.terminals].tolist()
                stack += [right, left]
        return np.array(out, np.uint32)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str, terminals: int) -> DataFrame:
    """Encode every `text` (null: empty), add the end id, and write shards in ascending doc_id order
    (null first; repeated ids in any order). Gives one row per file: path, part, shard, n_docs,
    n_tokens and bytes. The files of a part follow those of the parts before it. Write the rows down
    before using them: reading them writes the files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        shard, held, n_held = 0, [], 0

        def close() -> pa.RecordBatch:
            doc_ids = np.concatenate([h[0] for h in held])
            sizes = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[2] for h in held])
            data = shard_bytes(doc_ids, ids, np.concatenate(([0], np.cumsum(sizes))), terminals)
            name = f"{path}/{part:06d}-{shard:06d}.rpr"
            write_file(name, data)
            row = [name], [part], [shard], [len(doc_ids)], [len(ids)], [len(data)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, KINDS, strict=True)], NAMES)

        for batch in sliced(batches, "text"):
            flat, bounds = encode(batch.column("text"))
            ids = np.insert(flat, bounds[1:], np.uint32(end_id))
            doc_ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            held.append((doc_ids, np.diff(bounds) + 1, ids))
            n_held += len(ids)
            if n_held >= SHARD_IDS:
                yield close()
                shard, held, n_held = shard + 1, [], 0
        if held:
            yield close()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # by range, as many parts as the session shuffles into; rows of one id, or without one, may be many,
    # and lie in several parts by where they were read
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = texts.withColumn("lies", F.monotonically_increasing_id()).repartitionByRange(n, "doc_id", "lies")
    ordered = spread.sortWithinPartitions("doc_id", "lies").select("doc_id", "text")
    return in_arrow(ordered, write, "path string, part int, shard int, n_docs long, n_tokens long, bytes long", "repair")


NAMES = ["path", "part", "shard", "n_docs", "n_tokens", "bytes"]
KINDS = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents out of the files: doc_id, start (ids in all documents before), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers) and path."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with open_file(path) as file:
                    shard = Shard(file)
                    ids, bounds = shard.documents()
                ids = ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                arrays = [
                    pa.array(shard.doc_ids, mask=shard.doc_ids == NULL_ID), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)),
                    pa.array(crc, pa.int64()), pa.array([path] * len(crc), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "path"])

    # parts are as many as a shuffle has, files of one part a few: neither window is large
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("within", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).join(parts, "part")
    spread = placed.select("path", (F.col("before") + F.col("within")).alias("base")).repartition(
        int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path"
    )
    return in_arrow(spread, read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string", "repair")


def token_archive(docs: DataFrame, tokenizer: str, end_id: int, terminals: int) -> DataFrame:
    """Write the shards of `docs` to a fresh shared folder and read them back. The files stay; their
    names are in `path`."""
    folder = fresh_path(docs.sparkSession, "shards")
    return read_shards(stage(write_shards(docs, tokenizer, end_id, folder, terminals), "shard-list"))
