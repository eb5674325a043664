"""Token ids of whole text columns, with each distinct chunk of text encoded once per batch.

A chunk is a word with the space before it and what stands behind it up to the next space. Cutting
before a space that follows a visible character never changes a byte-level or word-level BPE result:
no pre-token runs from a visible character over a space. Texts in which a cut could matter (white
space other than single spaces and newlines, or a special token's string) are encoded whole.

A chunk of Latin letters, common marks and newlines alone is cut further, into words, runs of marks
and newlines, each a pre-token of its own. What is remembered is pieces, so a word is encoded once
whatever stands behind it, and words go to the library's model directly, without the steps that
only find out that they are words.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from dayledger.llm.workers import kept

Encode = Callable[[list[str]], list[bytes]]  # texts -> their ids as unsigned 32-bit integers

WHOLE = "[\\x09\\x0b-\\x0d\\x1c-\\x1f\u0085   -     　]|  |<\\|"


REMEMBERED = 96 << 20  # bytes, roughly, of remembered pieces and their ids
ENTRY = 200  # bytes that an entry takes besides its characters and ids
LONGEST = 64  # characters of a piece that is remembered

# Letters that Unicode composition leaves alone and that have one lower-case letter
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
# of several newlines before a visible character the last one is a pre-token of its own
MARKS = ".,;:!?$%&*#"
PIECES = re.compile(f" ?[{LETTERS}]+|[{MARKS}]+|\\n+(?=\\n[^\\n])|\\n+")
IS_WORD = re.compile(f" ?[{LETTERS}]+").fullmatch
# the same, and a word with one of the common marks or a run of the others behind it, for a whole Arrow column
WORDS = f"^ ?[{LETTERS}]+\\z"
ENDED = f"^ ?[{LETTERS}]+([.,;:!?]|[$%&*#]+)\\z"


def is_word(piece: str) -> bool:
    """Letters with or without a space before; most are ASCII, which needs no pattern."""
    letters = piece[1:] if piece[:1] == " " else piece
    return letters.isalpha() if letters.isascii() else IS_WORD(piece) is not None


class ChunkEncoder:
    """Encodes Arrow text columns. Pieces and their ids are remembered up to about `limit` bytes, then
    forgotten all at once, so that a worker's memory stays bounded. `words` encodes pieces that are
    words of LETTERS, with or without a space before; without it chunks are not cut."""

    def __init__(self, encode: Encode, limit: int = REMEMBERED, words: Encode | None = None):
        self.encode = encode
        self.words = words
        self.limit = limit
        self.held = 0
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids start (one more than
        texts). A null text has no ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        rows = len(texts)
        if not rows:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts.filter(pa.array(~whole)), " ")
        first = np.asarray(split.offsets)[:-1]
        words = split.flatten().dictionary_encode()
        n_words = len(words.dictionary)
        # after the words, each with its space: the first words of texts, then whole texts
        strings = _strings(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words.dictionary, pa.scalar(" ", pa.large_string())))
        flat = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = first - (split.offsets[0].as_py() if len(split.offsets) else 0)
        firsts, which = np.unique(flat[first], return_inverse=True)
        strings += _strings(words.dictionary.take(pa.array(firsts)))
        flat[first] = n_words + which
        n_chunks = len(strings)
        strings += _strings(texts.filter(pa.array(whole)))

        counts = np.ones(rows, np.int64)
        counts[~whole] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        of_chunk = np.empty(counts.sum(), np.int64)
        from_whole = np.repeat(whole, counts)
        of_chunk[~from_whole] = flat
        of_chunk[from_whole] = n_chunks + np.arange(whole.sum())

        once = dict.fromkeys(strings[n_chunks:])
        once = dict(zip(once, self.encode(list(once)) if once else [], strict=True))
        with _uncollected():
            ids = self._ids(strings[:n_chunks]) + [once[t] for t in strings[n_chunks:]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(ids), np.uint32)
        taken = sizes[of_chunk]
        ends = np.cumsum(taken)
        shift = starts[of_chunk] - (ends - taken)
        if ends[-1] < 1 << 31 and len(pool) < 1 << 31:  # half the bytes to move
            shift = shift.astype(np.int32)
        places = np.repeat(shift, taken)
        places += np.arange(len(places), dtype=places.dtype)
        out = pool[places]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return out, bounds

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks, of which none comes twice."""
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        known = self.known
        out = list(map(known.get, chunks))
        new = [k for k, ids in enumerate(out) if ids is None]
        long: list[str] = []

        def learn(pieces: list[str], encode: Encode) -> list[bytes]:
            if not pieces:
                return []
            found = encode(pieces)
            known.update(zip(pieces, found, strict=True))
            sizes = list(map(len, pieces))
            if max(sizes) > LONGEST:
                long.extend([p for p in pieces if len(p) > LONGEST])
            self.held += sum(sizes) + sum(map(len, found)) + ENTRY * len(found)
            return found

        def put(places: list[int], found: list[bytes]) -> None:
            for k, ids in zip(places, found, strict=True):
                out[k] = ids

        if self.words is None:
            put(new, learn([chunks[k] for k in new], self.encode))
        else:
            plain, ended, others = _sorted_out(chunks, new)
            put(plain, learn([chunks[k] for k in plain], self.words))
            # a word and marks behind it
            stems = [chunks[k].rstrip(MARKS) for k in ended]
            marks = [chunks[k][len(stem) :] for k, stem in zip(ended, stems, strict=True)]
            words = dict.fromkeys([stem for stem in stems if stem not in known])
            rest = dict.fromkeys([mark for mark in dict.fromkeys(marks) if mark not in known])
            cut: list[tuple[int, list[str]]] = []
            whole: list[int] = []
            for k in others:
                chunk = chunks[k]
                pieces = PIECES.findall(chunk)
                if len("".join(pieces)) == len(chunk) and len(pieces) != 1:
                    cut.append((k, pieces))
                    for piece in pieces:
                        if piece not in known:
                            (words if is_word(piece) else rest)[piece] = None
                else:
                    whole.append(k)  # marks alone, or other characters: not to be cut
            learn(list(words), self.words)
            learn(list(rest), self.encode)
            unknown = [k for k in whole if chunks[k] not in known]  # marks may have come as a piece
            learn([chunks[k] for k in unknown], self.encode)
            ids_of = known.__getitem__
            put(whole, [ids_of(chunks[k]) for k in whole])
            put(ended, list(map(add, map(ids_of, stems), map(ids_of, marks))))
            for k, pieces in cut:
                out[k] = b"".join(map(ids_of, pieces))
        for piece in long:
            self.held -= len(piece) + len(known.pop(piece)) + ENTRY
        return out


def _sorted_out(chunks: list[str], which: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Those of the chunks that are words, that are words with marks behind, and the others."""
    if not which:
        return [], [], []
    some, at = pa.array([chunks[k] for k in which], pa.large_string()), np.array(which)
    # most are ASCII letters behind a space, which needs no pattern: no chunk has two spaces before it
    word = pc.ascii_is_alpha(pc.ascii_ltrim(some, " ")).to_numpy(zero_copy_only=False)
    some, left = some.filter(pa.array(~word)), np.flatnonzero(~word)
    ended = pc.match_substring_regex(some, ENDED).to_numpy(zero_copy_only=False)
    others = left[~ended]
    late = pc.match_substring_regex(some.filter(pa.array(~ended)), WORDS).to_numpy(zero_copy_only=False)
    word[others[late]] = True
    return at[word].tolist(), at[left[ended]].tolist(), at[others[~late]].tolist()


@contextmanager
def _uncollected() -> Iterator[None]:
    """No search for garbage cycles while very many small objects are made, of which none is in a cycle."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


def sliced(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterable[pa.RecordBatch]:
    """The batches in pieces of about `most` bytes of the column, at least one row each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(sizes):
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


@kept
@lru_cache(maxsize=4)
def library_encoder(path: str, remembered: int = REMEMBERED) -> ChunkEncoder:
    """The encoder of a tokenizers file, one per Python worker. Special tokens in a text are found as
    the library does by default; none are added."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 20_000):  # the encodings of one slice live at a time
            found = tokenizer.encode_batch_fast(texts[at : at + 20_000], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    return ChunkEncoder(encode, remembered, _word_encoder(tokenizer))


# steps before the model that words of LETTERS pass as `_word_encoder` says: byte-level BPE, and BPE of
# lower-case words without the space before them
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLIT = [{"type": "Split", "pattern": {"Regex": PARTS}, "behavior": "Removed", "invert": True}, BYTES | {"use_regex": False}]


def _word_encoder(tokenizer) -> Encode | None:
    """Encodes words by the tokenizer's model alone, or nothing where the steps before it are others."""
    steps = json.loads(tokenizer.to_str())
    before = steps["normalizer"], steps["pre_tokenizer"]
    lower = before == ({"type": "Sequence", "normalizers": LOWER}, {"type": "Sequence", "pretokenizers": SPLIT})
    if steps["model"]["type"] != "BPE" or not (lower or before == (None, BYTES)):
        return None
    inside = re.compile(f"[ {LETTERS}{MARKS}\n]*")
    if steps["model"].get("dropout") or any(inside.fullmatch(t["content"]) for t in steps["added_tokens"]):
        return None
    # bytes that byte-level BPE writes as characters from 256 on, in their order
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    spelled = [(chr(b), chr(256 + k)) for k, b in enumerate(hidden) if b == 0x20 or b >= 0x80]
    tokenize = tokenizer.model.tokenize

    def encode(words: list[str]) -> list[bytes]:
        joined = "\n".join([w.removeprefix(" ") for w in words]).lower() if lower else "\n".join(words)
        joined = joined.encode().decode("latin-1")
        for byte, letter in spelled:
            joined = joined.replace(byte, letter)
        ids: list[int] = []
        ends = [0]
        for w in joined.split("\n"):
            ids += [t.id for t in tokenize(w)]
            ends.append(len(ids))
        data = array("I", ids).tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)]

    return encode
