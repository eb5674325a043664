"""Periodic runs of words: stretches that repeat with some period, and texts with them collapsed.

A run of smallest period q is a stretch of at least max(LEAST, 2 q) words in which words q apart are
the same and which no neighbouring word extends. Every run covers, for its period, a pair (i, i + q)
with i a multiple of q: the pairs of all periods form a harmonic grid, n/1 + n/2 + n/3 + ... of them.
Pairs of equal words with enough equal neighbours are candidates; extension queries on the
recompression grammar of the texts say how far each reaches to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.chunks import sliced
from dayledger.llm.recompression import EDGE, Grammar
from dayledger.llm.workers import in_arrow

LEAST = 12  # words of a run
SPACES = "\t\n\x0b\x0c\r"  # and the space itself
AT_ONCE = 200_000  # candidates that are extended together

Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # sequence, start, length, period


def find_runs(words: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of the sequences words[bounds[k]:bounds[k + 1]] (numbers from 0), by sequence, start
    and period."""
    sizes = np.diff(bounds)
    found: list[Runs] = []
    # sequences of like length together: long periods are looked for in long sequences only
    kinds = np.log2(np.maximum(sizes, 1)).astype(int) // 2
    for kind in np.unique(kinds[sizes >= LEAST]):
        which = np.flatnonzero((kinds == kind) & (sizes >= LEAST))
        taken = np.repeat(bounds[which] - np.cumsum(sizes[which]) + sizes[which], sizes[which]) + np.arange(sizes[which].sum())
        seq, start, length, period = _runs_of(words[taken], sizes[which])
        found.append((which[seq], start, length, period))
    if not found:
        return (np.empty(0, np.int64),) * 4
    seq, start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start, seq))
    return seq[order], start[order], length[order], period[order]


def _runs_of(words: np.ndarray, sizes: np.ndarray) -> Runs:
    n = len(words) + len(sizes) + 1
    text = np.full(n, EDGE, np.int32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(words)) + owner + 1] = words + 1
    begins = np.cumsum(sizes + 1) - sizes
    grammar = Grammar(text)
    inside = np.zeros(n, np.int64)  # a period that holds around a position, and how far to the right
    until = np.zeros(n, np.int64)
    found: dict[tuple[int, int], int] = {}

    def extend(at: np.ndarray, period: np.ndarray) -> None:
        # a pair inside a run whose period divides its distance only finds that run again
        known = (until[at] > at + period) & (period % np.maximum(inside[at], 1) == 0)
        at, period = at[~known], period[~known]
        start = at - grammar.extend(at - 1, at + period - 1, -1)
        end = at + period + grammar.extend(at, at + period, 1)
        runs = end - start >= np.maximum(LEAST, 2 * period)
        for s, e, p in sorted(set(zip(start[runs].tolist(), end[runs].tolist(), period[runs].tolist(), strict=True)), key=lambda r: r[2]):
            if (s, e) not in found:  # periods ascend: the first one is the smallest
                found[s, e] = p
                new = until[s:e] < e
                until[s:e][new], inside[s:e][new] = e, p

    held_at, held_period, held = [], [], 0
    for at, period in _grid(text, np.cumsum(text == EDGE), int(sizes.max()) // 2):
        held_at.append(at)
        held_period.append(period)
        held += len(at)
        if held >= AT_ONCE:
            extend(np.concatenate(held_at), np.concatenate(held_period))
            held_at, held_period, held = [], [], 0
    if held:
        extend(np.concatenate(held_at), np.concatenate(held_period))
    if not found:
        return (np.empty(0, np.int64),) * 4
    start, end = np.array(list(found), np.int64).T
    seq = np.searchsorted(begins, start, "right") - 1
    return seq, start - begins[seq], end - start, np.array(list(found.values()), np.int64)


def _grid(text: np.ndarray, owner: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions i, multiples of a period p, with equal words at i and i + p of one sequence; periods
    ascend. `owner` numbers the sequences."""
    n, p = len(text), 1
    while p <= longest:
        if p < 64:
            at, period, p = np.flatnonzero(text[: n - p : p] == text[p::p]) * p, np.array([p]), p + 1
            period = np.repeat(period, len(at))
        else:  # many periods have few pairs each: together
            periods = np.arange(p, min(longest, p + AT_ONCE * p // n) + 1)
            pairs = (n - 1) // periods
            period = np.repeat(periods, pairs)
            at = (np.arange(len(period)) - np.repeat(np.cumsum(pairs) - pairs, pairs)) * period
            equal = text[at] == text[at + period]
            at, period, p = at[equal], period[equal], int(periods[-1]) + 1
        if len(at):
            enough = (owner[at] == owner[at + period]) & _enough(text, at, period)
            yield at[enough], period[enough]


def _enough(text: np.ndarray, at: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether words i and i + p, equal, have enough equal neighbours: a run has max(p, LEAST - p), six
    or more, consecutive ones, so three from here on or four before."""
    last = len(text) - 1 - p

    def same(shift: int) -> np.ndarray:
        i = np.clip(at + shift, 0, last)  # past the ends no run goes on: any answer will do
        return text[i] == text[i + p]

    inner = text[at] != EDGE
    return inner & ((same(1) & same(2)) | (same(-1) & same(-2) & same(-3) & same(-4)))


def spaced(text: str = "text") -> Column:
    """The text with every white space character of the definition as a space; null as null."""
    return F.translate(F.col(text).cast("string"), SPACES, " " * len(SPACES))


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of texts whose only white space is the space. A null text has none."""
    split = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), " ")
    offsets, flat = split.offsets.to_numpy(), split.values
    some = pc.not_equal(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))
    return pa.ListArray.from_arrays(pa.array(kept[offsets].astype(np.int32)), flat.filter(some))


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every `text` of `docs` and the text without their repetitions.

    Gives doc_id, n_words, runs (by start, then period; empty if there are none) and collapsed: the
    words, joined by one space, that no run contains after its first period. Null and empty texts have
    no words. Repeated rows and rows without an id are texts of their own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words = words_of(batch.column("text"))
            bounds = words.offsets.to_numpy()
            numbers = words.values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            seq, start, length, period = find_runs(numbers, bounds)
            # a word is dropped where more runs repeat there than have ended
            change = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(change, bounds[seq] + start + period, 1)
            np.add.at(change, bounds[seq] + start + length, -1)
            keep = np.cumsum(change)[:-1] == 0
            left = np.concatenate(([0], np.cumsum(keep)))[bounds]
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.values.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(seq, np.arange(len(batch) + 1)).astype(np.int32)), runs),
                collapsed.cast(pa.string()),
            ], ["doc_id", "n_words", "runs", "collapsed"])

    return in_arrow(docs.select(F.col("doc_id").cast("long"), spaced().alias("text")), run, SCHEMA, "runs")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, the texts of a tenth of the ids stretched into a run: from some word on they
    repeat a few words until their end. Which ids, where and how many follow from the id alone."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), h.alias("h"))
    words = F.filter(F.split(spaced(), " "), lambda w: w != "")
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    first = (g % n).cast("int")
    period = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8)).cast("int")
    a, p = F.col("a"), F.col("p")
    chosen = rows.where("h % 10 = 0 AND text IS NOT NULL").withColumn("words", words)
    stretched = chosen.withColumn("a", F.when(n > 0, first)).withColumn("p", F.when(n > 0, period)).select(
        "doc_id",
        F.when(n > 0, F.array_join(F.transform("words", lambda w, i: F.when(i < a, w).otherwise(
            F.get("words", a + (i - a) % p))), " ")).otherwise(F.col("text")).alias("text"),
    )
    rest = rows.where("h IS NULL OR h % 10 <> 0 OR text IS NULL").select("doc_id", "text")
    return rest.unionByName(stretched)


def digested(found: DataFrame) -> DataFrame:
    """`periodic_runs` as one row of numbers and digests per document: n_runs, the longest run (the
    first, then the one of the smaller period, of equally long ones) and sha256 of all runs and of
    the collapsed text."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
