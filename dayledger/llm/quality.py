"""Quality of texts without given labels: heuristic labellers, EM over their votes, a hashed scorer.

Labellers look at overlapping signs of junk (symbols, capitals, repetition, tables) or of prose and
vote bad, good or not at all. EM estimates from the counts of vote patterns how often each labeller
casts each vote on good and on bad texts; the posterior of a text's votes is its label. A linear
scorer over hashed word shapes learns the posteriors and then needs the text alone.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.chunks import sliced
from dayledger.llm.workers import in_arrow
from dayledger.sinks.staging import stage

ABSTAIN, BAD, GOOD = 0, 1, 2
SLICE = 4 << 20  # bytes of text worked on at once


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the texts the scorer is trained on (on average); all texts are counted in EM."""

    sample: int = 20_000
    buckets: int = 1 << 12
    rounds: int = 100
    steps: int = 600
    rate: float = 0.5
    decay: float = 1e-5


@dataclass(frozen=True)
class Labeller:
    """Votes bad from `bad` of the statistic on and good up to `good`; else it does not vote."""

    name: str
    statistic: str
    bad: float
    good: float = -1.0

    def vote(self, statistics: dict[str, np.ndarray]) -> np.ndarray:
        value = statistics[self.statistic]
        known = statistics["words"] > 0
        return np.where(known & (value >= self.bad), BAD, np.where(known & (value <= self.good), GOOD, ABSTAIN)).astype(np.int8)


LABELLERS = [
    Labeller("symbols", "symbol_share", 0.03),
    Labeller("symbol_words", "symbol_words", 0.10),
    Labeller("capitals", "capital_share", 0.30),
    Labeller("capital_words", "capital_words", 0.20),
    Labeller("repeats", "repeats", 0.10),
    Labeller("few_words", "repeated_share", 0.75),
    Labeller("table", "bars", 0.05),
    Labeller("odd_words", "odd_words", 0.25, 0.05),
    Labeller("no_sentences", "words_a_stop", 60.0, 25.0),
    Labeller("monotony", "monotony", 0.15, 0.1),
]


def word_statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], list[tuple[np.ndarray, np.ndarray]], int]:
    """Statistics of each text, and its hashed features; the words of a null text are none."""
    split = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = split.flatten().dictionary_encode()
    words, flat = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = len(texts)
    owner = np.repeat(np.arange(rows), sizes)
    real = np.array([bool(w) for w in words], bool)[flat] if len(words) else np.empty(0, bool)
    flat, owner = flat[real], owner[real]

    look, codes = _look(words)
    chars, letters, capitals, symbols, all_capitals, plain, stops, with_symbol, bars, phrases = (
        np.bincount(owner, look[flat, k], rows) for k in range(look.shape[1]))
    n = np.bincount(owner, minlength=rows)
    at_least = np.maximum(n, 1)
    same = (flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner[1:][same], minlength=rows)
    pairs, first = np.unique(owner * max(1, len(words)) + flat, return_index=True)
    distinct = np.bincount(owner[first], minlength=rows)
    # prose has plain words and sentences, and does not repeat itself: a repetitive text is no evidence for it
    same_share = repeats / at_least
    odd = np.where(same_share > 0.1, 0.1, 1 - plain / at_least)
    a_stop = np.where(n > 60, n / np.maximum(stops, 1), 40)  # too short to judge: no vote
    a_stop = np.where(2 * phrases > n, 40, a_stop)  # Thai and Lao sentences end without a mark
    statistics = {
        "words": n, "symbol_share": symbols / np.maximum(chars, 1), "symbol_words": with_symbol / at_least,
        "capital_share": np.where(letters > 20, capitals / np.maximum(letters, 1), 0), "capital_words": all_capitals / at_least,
        "repeats": repeats / at_least, "repeated_share": np.where(n >= 20, 1 - distinct / at_least, 0) - np.minimum(0.5, np.maximum(0, np.log10(at_least / 300)) * 0.35),
        "bars": bars / at_least, "odd_words": odd, "words_a_stop": np.where(same_share > 0.1, 40, a_stop),
        "monotony": same_share,
    }
    return statistics, _features(codes[flat], owner, n, same, rows), rows


OTHER, CAPITAL, SMALL, DIGIT, MARK, INNER, POINT = range(7)
JOINERS = "\u200b\u200c\u200d\u2060"  # stand between letters and are not seen
STOPS = ".?!。｡．？！…‼⁇⁈⁉।॥؟۔։።፧။។៕།༎᠃᙮"
CLOSERS = "’”»›」』）】》〉］｣"  # may stand behind a stop


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each character: letters by case, numbers, marks of prose, marks that stand inside words,
    punctuation beyond ASCII, and all else. Letters without case and combining marks count as small."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        category = unicodedata.category(c)
        if category[0] == "L":
            out[code] = CAPITAL if c.isupper() else SMALL
        elif category[0] == "M" or c in JOINERS:
            out[code] = SMALL
        elif category[0] == "N":
            out[code] = DIGIT
        elif c in ".,;:?!\"()¿¡/@":
            out[code] = MARK
        elif c in "'’-":
            out[code] = INNER
        elif category[0] == "P" and code > 127:
            out[code] = POINT
    return out


def _look(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word its characters, letters, capitals, symbols, and as 0 or 1 whether all letters are
    capitals, it is a word as prose has it (numbers and addresses count as such), it ends a sentence,
    it has a symbol, it is a bar, it has Thai or Lao letters; and the hash of its shape: kinds of its characters, runs once, up to 8."""
    if not words:
        return np.zeros((0, 10)), np.zeros(0, np.int64)
    # a newline, which no word has, after each word
    text = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.flatnonzero(text == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    kind = _kinds()[text]
    kind[text == 10] = 255

    def count(which: np.ndarray) -> np.ndarray:
        return np.add.reduceat(which.astype(np.int64), starts)

    chars, capitals = ends - starts, count(kind == CAPITAL)
    letters, symbols = capitals + count(kind == SMALL), count(kind == OTHER)
    digits, marks, points = count(kind == DIGIT), count(kind == MARK), count(kind == POINT)
    last, before = text[np.maximum(ends - 1, 0)], text[np.maximum(ends - 2, 0)]
    stop = [ord(c) for c in STOPS]
    closed = (chars > 1) & np.isin(last, [ord(c) for c in CLOSERS]) & np.isin(before, stop)
    stops = (chars > 0) & np.isin(last, stop) | closed
    # a word of a text without spaces is a sentence or more, with some points among its letters
    plain = (digits > 0) | ((symbols == 0) & (letters > 0) & (marks <= 1) & (points <= letters)) | ((chars == 1) & (points == 1))
    phrase = count((text >= 0x0E00) & (text <= 0x0EFF)) > 0
    bar = (chars == 1) & (last == ord("|"))
    look = np.stack([chars, letters, capitals, symbols, (letters > 1) & (capitals == letters), plain, stops, symbols > 0, bar, phrase], 1)

    # letters and digits by kind, others as they are, points of a word with letters left out; the first of each run
    shown = (kind != POINT) | np.repeat(letters == 0, ends - starts + 1)
    text, kind = text[shown], kind[shown]
    ends = np.flatnonzero(text == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sign = np.where((kind == CAPITAL) | (kind == SMALL) | (kind == DIGIT), kind.astype(np.int64), text + 256)
    new = np.concatenate(([True], sign[1:] != sign[:-1]))
    new[starts] = True
    place = np.cumsum(new) - 1
    owner = np.repeat(np.arange(len(words)), ends - starts + 1)
    place -= place[starts][owner]
    used = new & (kind != 255) & (place < 8)
    weights = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 40, 8) | 1
    codes = np.zeros(len(words), np.int64)
    np.add.at(codes, owner[used], sign[used] * weights[place[used]])
    return look.astype(np.float64), (codes ^ (codes >> 23)) & 0x7FFFFFFF


def _features(codes: np.ndarray, owner: np.ndarray, n: np.ndarray, same: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shares of the texts' words, by the hash of their shape; a word that repeats the one before counts
    for a shape of its own. A text without words has no features."""
    codes = np.concatenate([codes, np.full(int(same.sum()), REPEAT)])
    owner = np.concatenate([owner, owner[1:][same]])
    keys, counts = np.unique(owner << 32 | codes, return_counts=True)
    of, code = keys >> 32, keys & 0xFFFFFFFF
    share = (counts / (n[of] + FEW)).astype(np.float32)
    bounds = np.searchsorted(of, np.arange(rows + 1))
    return [(code[a:b], share[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


FEW = 1  # a word that a text is taken to have besides, so that very short texts stay near the middle
REPEAT = 0x5EED5EED


def votes(docs: DataFrame, settings: Settings) -> DataFrame:
    """votes (one letter a labeller) and hashed features (at, share) of every text of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            statistics, features, rows = word_statistics(batch.column("text"))
            cast = np.stack([x.vote(statistics) for x in LABELLERS], 1)
            spelled = ["".join("_bg"[v] for v in row) for row in cast.tolist()]
            at = [np.asarray(c % settings.buckets, np.int32) for c, _ in features]
            yield pa.RecordBatch.from_arrays([
                pa.array(spelled, pa.string()), pa.array(at, pa.list_(pa.int32())),
                pa.array([s for _, s in features], pa.list_(pa.float32())), batch.column("draw"),
            ], ["votes", "at", "share", "draw"])

    texts = docs.select(F.col("text").cast("string"), F.pmod(F.xxhash64("text"), F.lit(1_000_000)).cast("int").alias("draw"))
    return in_arrow(texts, run, "votes string, at array<int>, share array<float>, draw int", "quality")


def accuracies(patterns: dict[str, int], settings: Settings) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """EM over vote patterns and their counts: the posterior of good for each pattern, and for each
    labeller how often its votes of either kind are right. At first the labellers are taken to be
    right more often than not, and most texts to be good."""
    names = sorted(patterns)
    if not names:
        return {}, {}
    weight = np.array([patterns[p] for p in names], float)
    cast = np.array([["_bg".index(v) for v in p] for p in names])
    k = cast.shape[1]
    start_good, start_bad = np.array([0.60, 0.02, 0.38]), np.array([0.55, 0.40, 0.05])
    good, bad, prior = np.tile(start_good, (k, 1)), np.tile(start_bad, (k, 1)), 0.8
    posterior = np.zeros(len(names))
    for _ in range(settings.rounds):
        each = np.arange(k)
        log_good = np.log(prior) + np.log(good[each, cast]).sum(axis=1)
        log_bad = np.log(1 - prior) + np.log(bad[each, cast]).sum(axis=1)
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        for table, share, start in ((good, posterior, start_good), (bad, 1 - posterior, start_bad)):
            for i in range(k):
                counts = np.bincount(cast[:, i], weight * share, 3) + start  # one text's worth of the start
                table[i] = counts / counts.sum()
        prior = min(max((weight * posterior).sum() / weight.sum(), 0.01), 0.99)
    stated = {}
    for i, x in enumerate(LABELLERS):
        right = {"bad": (1 - prior) * bad[i, BAD], "good": prior * good[i, GOOD]}
        wrong = {"bad": prior * good[i, BAD], "good": (1 - prior) * bad[i, GOOD]}
        stated[x.name] = {v: float(right[v] / (right[v] + wrong[v])) for v in right}
    return dict(zip(names, posterior.tolist(), strict=True)), stated


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # the last is the bias
    posterior: dict[str, float]
    accuracy: dict[str, dict[str, float]]
    settings: Settings


def learn(docs: DataFrame, settings: Settings | None = None) -> Model:
    """Learn from `docs` (text). The driver gets the counts of vote patterns, at most 3 to the number
    of labellers, and the features of the sample."""
    s = settings or Settings()
    seen = stage(votes(docs, s), "votes")
    patterns = dict(seen.groupBy("votes").count().collect())
    posterior, accuracy = accuracies(patterns, s)
    total = sum(patterns.values())
    drawn = seen.where(F.col("draw") < 1_000_000 * min(1.0, s.sample / max(total, 1)))
    # a text with very many copies is drawn with all of them or not at all: each text is taken once
    rows = drawn.groupBy("draw", "votes", "at", "share").agg(F.lit(1).alias("n")).toLocalIterator()
    return Model(_trained([(r["votes"], r["at"], r["share"]) for r in rows], posterior, s), posterior, accuracy, s)


def _trained(rows: list[tuple], posterior: dict[str, float], s: Settings) -> np.ndarray:
    """Logistic regression on the posteriors, by gradient steps with momentum."""
    weights = np.zeros(s.buckets + 1)
    if not rows:
        return weights
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    at = np.concatenate([np.asarray(r[1], np.int64) for r in rows])
    share = np.sqrt(np.concatenate([np.asarray(r[2]) for r in rows]))
    wanted = np.array([posterior[r[0]] for r in rows])
    speed = np.zeros_like(weights)
    for _ in range(s.steps):
        margin = np.bincount(row, weights[at] * share, len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-margin)) - wanted) / len(rows)
        gradient = np.append(np.bincount(at, error[row] * share, s.buckets), error.sum()) + s.decay * weights
        speed = 0.9 * speed - s.rate * 4 * gradient
        weights += speed
    return weights


def score(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The scorer's probability that each text is good, and the posterior of its votes (that of a
    pattern never seen is the score). A text without words is not good."""
    statistics, features, rows = word_statistics(texts)
    out = np.zeros(rows)
    for k, (code, share) in enumerate(features):
        if len(code):
            margin = float((model.weights[code % model.settings.buckets] * np.sqrt(share)).sum() + model.weights[-1])
            out[k] = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    cast = np.stack([x.vote(statistics) for x in LABELLERS], 1).tolist()
    weak = np.array([model.posterior.get("".join("_bg"[v] for v in row), out[k]) for k, row in enumerate(cast)])
    return out, np.where(statistics["words"] > 0, weak, 0.0)


def judged(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, score, weak_posterior, kept of every row of `docs` (doc_id, text). Texts that are null
    or without words score 0. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets and patterns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            good, weak = score(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(good), pa.array(weak), pa.array(good >= least)], ["doc_id", "score", "weak_posterior", "kept"])

    return in_arrow(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
        "doc_id long, score double, weak_posterior double, kept boolean", "quality")


def good_texts(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns as they are, that score at least `least`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            yield batch.filter(pa.array(score(batch.column("text"), shared.value)[0] >= least))

    return in_arrow(docs, run, docs.schema, "quality")
