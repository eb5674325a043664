"""Language spans of texts: script ranges, per-word scores, and Viterbi with a switching penalty.

Training counts the character n-grams (1 to 3, with word edges) and whole words of labelled texts by
language in hashed buckets, and which scripts a language uses. A word's score for a language is the
sum of its n-grams' log-probabilities; languages that do not use the word's script are ruled out.
Viterbi then labels the words of a text, paying a penalty for each change of language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.chunks import sliced
from dayledger.llm.workers import in_arrow

UNDETERMINED = "und"
SLICE = 4 << 20  # bytes of text worked on at once
# First code points of script ranges, in order; 0 is for what lies between.
SCRIPTS = [
    (0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
    (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0), (0x0E00, 10), (0x0E80, 0), (0x10A0, 11), (0x1100, 12),
    (0x1200, 13), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 14), (0x30A0, 15), (0x3100, 0), (0x3400, 16),
    (0xA000, 0), (0xAC00, 12), (0xD7B0, 0), (0xF900, 16), (0xFB00, 0), (0x20000, 16), (0x30000, 0),
]
N_SCRIPTS = 17
_EDGES = np.array([s[0] for s in SCRIPTS])
_SCRIPT = np.array([s[1] for s in SCRIPTS])
LETTER = regex.compile(r"\p{L}")
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the labelled texts learned from, per language and on average: a text is taken if
    a hash of it falls below sample / number of texts of the language. `buckets` and `languages` bound the
    model: with more distinct values of `lang`, learning fails and says so."""

    languages: int = 256
    sample: int = 2000
    buckets: int = 1 << 16
    smoothing: float = 0.5
    penalty: float = 12.0
    script_share: float = 0.01
    ruled_out: float = -40.0


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # log-probability by bucket and language, less the bucket's mean
    scripts: np.ndarray  # which script a language uses
    settings: Settings


def in_training(doc_id: str = "doc_id") -> Column:
    """Rows to learn from: the CRC of the id as text, modulo 3, is not 1. Rows without an id are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def learn(labelled: DataFrame, settings: Settings | None = None) -> Model:
    """A model of `labelled` (text, lang); rows with a null in either are not used. Counts are added up
    on the executors; the driver gets `buckets` numbers per language."""
    s = settings or Settings()
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = dict(rows.groupBy("lang").count().limit(s.languages + 1).collect())
    if len(counts) > s.languages:
        raise ValueError(f"lang has more than {s.languages} values: not a column of languages, or raise Settings.languages")
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((s.buckets, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool), s)
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, s.sample / n))))
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(1_000_000) * share[F.col("lang")]
    index = {lang: k for k, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(index), s.buckets), np.int64)
        scripts = np.zeros((len(index), N_SCRIPTS), np.int64)
        for batch in sliced(batches, "text", SLICE):
            of = np.array([index[x] for x in batch.column("lang").to_pylist()])
            words, flat, owner = _words(batch.column("text"))
            for k in np.unique(of):
                used = np.bincount(flat[of[owner] == k], minlength=len(words))
                bucket, word, script = _features(words, s.buckets)
                grams[k] += np.bincount(bucket, used[word], s.buckets).astype(np.int64)
                scripts[k] += np.bincount(script, used, N_SCRIPTS).astype(np.int64)
        for k in range(len(index)):
            for kind, table in enumerate((grams[k], scripts[k])):
                at = np.flatnonzero(table)
                columns = [pa.array(np.full(len(at), k), pa.int32()), pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int32()), pa.array(table[at])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "at", "n"])

    found = in_arrow(rows.where(draw), count, "lang int, kind int, at int, n long", "language").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n"))
    grams, scripts = np.zeros((s.buckets, len(languages))), np.zeros((N_SCRIPTS, len(languages)))
    for row in found.toLocalIterator():
        (scripts if row["kind"] else grams)[row["at"], row["lang"]] = row["n"]
    logs = np.log(grams + s.smoothing) - np.log(grams.sum(axis=0) + s.smoothing * s.buckets)
    logs -= logs.mean(axis=1, keepdims=True)
    scripts[0] = 0  # digits and marks are no script
    return Model(languages, logs.astype(np.float32), scripts >= s.script_share * np.maximum(scripts.sum(axis=0), 1), s)


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the words of all texts as indices into them, and the text of each."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    split = pc.utf8_split_whitespace(lower)
    words = split.flatten().dictionary_encode()
    flat = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    return words.dictionary.to_pylist(), flat, np.repeat(np.arange(len(texts)), sizes)


def _features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of n-grams and the word each is of, and each word's script."""
    # words of letters only, one space between them
    plain = [NOT_LETTERS.sub("", w) for w in words]
    codes = np.frombuffer((" " + " ".join(plain) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = codes == 32
    owner = np.cumsum(space) - 1
    mix = np.uint64(0x9E3779B97F4A7C15)
    out, of = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in (1, 2, 3):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        inner = np.zeros(len(rolled), bool)  # a space may stand first or last only
        for i in range(1, n - 1):
            inner |= space[i : i + len(rolled)]
        first, last = space[: len(rolled)], space[n - 1 :]
        take = ~inner & ~(first & last) & (~first if n == 1 else True)
        at = np.flatnonzero(take)
        out.append(((rolled[at] * mix) >> np.uint64(40)) % np.uint64(buckets))
        # a gram that starts with the space before a word belongs to that word
        of.append(owner[at])
    whole = np.array([hash_word(w) for w in plain], np.uint64)
    full = np.array([bool(w) for w in plain], bool)
    out.append(whole[full] % np.uint64(buckets))
    of.append(np.flatnonzero(full))
    starts = np.flatnonzero(space)[:-1] + 1
    script = _SCRIPT[np.searchsorted(_EDGES, codes[starts].astype(np.int64), "right") - 1]
    return np.concatenate(out).astype(np.int64), np.concatenate(of), np.where(full, script, 0)


def hash_word(word: str) -> int:
    """A hash that is the same in every process."""
    return zlib.crc32(word.encode()) * 0x9E3779B1 & 0xFFFFFFFF


def word_scores(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word by language, and its letters. A word without letters scores nothing."""
    bucket, word, script = _features(words, model.settings.buckets)
    scores = np.zeros((len(words), len(model.languages)))
    order = np.argsort(word, kind="stable")
    bucket, word = bucket[order], word[order]
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.empty(0, int)
    if len(starts):
        scores[word[starts]] = np.add.reduceat(model.scores[bucket], starts, axis=0)
    allowed = model.scripts[script]
    some = allowed.any(axis=1)  # a script that no language uses rules out none
    scores[some] += np.where(allowed[some], 0.0, model.settings.ruled_out)
    letters = np.fromiter((len(LETTER.findall(w)) for w in words), np.int64, len(words))
    scores[letters == 0] = 0
    return scores, letters


def viterbi(scores: np.ndarray, flat: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word in the best labelling of each text. Texts lie one after the other in
    `flat`; all of them take their t-th step together, the longest first in order."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    n_lang = scores.shape[1]
    came = np.zeros((len(flat), n_lang), np.int16)
    state = np.zeros((len(sizes), n_lang))
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # texts longer than t
    stay = np.arange(n_lang, dtype=np.int16)
    for t in range(steps):
        n = active[t]
        now, at = state[:n], starts[:n] + t
        if t:
            best = now.argmax(axis=1)
            top = now[np.arange(n), best][:, None] - penalty
            came[at] = np.where(now >= top, stay, best[:, None])
            now = np.maximum(now, top)
        now = now + scores[flat[at]]
        state[:n] = now - now.max(axis=1, keepdims=True)
    out = np.zeros(len(flat), np.int16)
    label = state.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        out[at] = label[:n]
        label[:n] = came[at, label[:n]]
    return out


def judge(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, list[list[tuple[str, int, int]]]]:
    """Language, score and spans of each text. The language has most letters in its spans (of equal
    ones the first by name), the score is its share of all letters; `und` and 0 without a letter or
    without a learned language. Spans are (language, first word, words), words between white space."""
    words, flat, owner = _words(texts)
    rows, n_lang = len(texts), len(model.languages)
    if not n_lang or not len(flat):
        return [UNDETERMINED] * rows, np.zeros(rows), [[] for _ in range(rows)]
    scores, letters = word_scores(words, model)
    sizes = np.bincount(owner, minlength=rows)
    labels = viterbi(scores, flat, sizes, model.settings.penalty)
    weight = np.bincount(owner * n_lang + labels, letters[flat], rows * n_lang).reshape(rows, n_lang)
    total, best = weight.sum(axis=1), weight.argmax(axis=1)
    languages = [model.languages[b] if t else UNDETERMINED for b, t in zip(best, total, strict=True)]
    share = np.where(total > 0, weight.max(axis=1) / np.maximum(total, 1), 0.0)
    change = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1]))))
    first = np.cumsum(sizes) - sizes
    spans: list[list[tuple[str, int, int]]] = [[] for _ in range(rows)]
    for a, b in zip(change.tolist(), np.append(change[1:], len(flat)).tolist(), strict=True):
        spans[owner[a]].append((model.languages[labels[a]], int(a - first[owner[a]]), b - a))
    return languages, share, [x if t else [] for x, t in zip(spans, total, strict=True)]


def predict(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score and, if wished, spans of every row of `docs` (doc_id, text). Only the
    text decides. Other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            languages, share, spans = judge(batch.column("text"), shared.value)
            arrays = [batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(share)]
            if with_spans:
                kind = pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())])
                arrays.append(pa.array([[dict(zip(("lang", "first", "words"), x, strict=True)) for x in s] for s in spans], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "spans"][: len(arrays)])

    schema = "doc_id long, lang_pred string, score double" + (", spans array<struct<lang:string,first:long,words:long>>" if with_spans else "")
    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema, "language")


def with_language(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text has a language with at least `least` of
    its letters. Texts without a letter go; nothing goes where no language was learned."""
    if not model.languages:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            languages, share, _ = judge(batch.column("text"), shared.value)
            yield batch.filter(pa.array([x != UNDETERMINED and s >= least for x, s in zip(languages, share, strict=True)]))

    return in_arrow(docs, run, docs.schema, "language")
