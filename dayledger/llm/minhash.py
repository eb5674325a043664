"""Shingle sets of texts, and their circulant MinHash signatures."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from dayledger.llm.workers import kept

UNIVERSE_BITS = 21
SEED = 20240229
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_WEIGHTS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
_BASE = 0x5851F42D4C957F2D  # odd
SEGMENT = 256 << 10


def words(text: bytes) -> list[bytes]:
    """Words between the six ASCII white-space bytes, with A-Z in lower case."""
    return text.lower().split()


def shingle_set(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The set itself; a text of fewer words is one shingle, one without words the empty set."""
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(size)), strict=False))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def word_hashes(spaced: bytes) -> np.ndarray:
    """A 64-bit hash of each word of `spaced`, in which a space follows every word and only there."""
    data = np.frombuffer(spaced, np.uint8)
    ends = np.flatnonzero(data == 32)
    out = np.empty(len(ends), np.uint64)
    at = word = 0
    while word < len(ends):
        last = max(word + 1, int(np.searchsorted(ends, at + SEGMENT)))
        stop = int(ends[last - 1]) + 1
        n = stop - at
        power, inverse = _powers(n)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data[at:stop].astype(np.uint64) + _A) * power)))
        end = ends[word:last] - at
        start = np.concatenate(([0], end[:-1] + 1))
        out[word:last] = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
        at, word = stop, last
    return out


_held: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; those of a usual segment are kept."""
    if _held and len(_held[0]) >= n:
        return _held[0][:n], _held[1][:n]
    size = max(n, SEGMENT + 4096)
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, np.uint64(base))
        steps[0] = 1
        out.append(np.cumprod(steps))
    if n <= SEGMENT + 4096:
        _held[:] = out
    return out[0][:n], out[1][:n]


def shingle_hashes(texts: list[list[bytes]], size: int) -> list[np.ndarray]:
    """The distinct 64-bit shingle hashes of each text's words, ascending."""
    hashes = word_hashes(b"".join(b" ".join(w) + b" " for w in texts if w))
    if size > len(_WEIGHTS):
        raise ValueError(f"shingles of at most {len(_WEIGHTS)} words")
    n = max(0, len(hashes) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled = mix(rolled + hashes[i : i + n] * _WEIGHTS[i])
    out, at = [], 0
    for w in texts:
        if len(w) >= size:
            out.append(np.unique(rolled[at : at + len(w) - size + 1]))
        else:
            short = np.full(1 if w else 0, np.uint64(len(w)))
            for i in range(len(w)):
                short = mix(short + hashes[at + i : at + i + 1] * _WEIGHTS[i])
            out.append(short)
        at += len(w)
    return out


@kept
@lru_cache(maxsize=2)
def permutations(coordinates: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second with its start repeated behind its end, so that its
    circular shifts by 0, 1, ... are slices."""
    size = 1 << UNIVERSE_BITS
    random = np.random.Generator(np.random.PCG64(seed))
    first = random.permutation(size).astype(np.uint32)
    second = random.permutation(size).astype(np.uint32)
    return first, np.concatenate([second, second[:coordinates]])


def signatures(sets: list[np.ndarray], coordinates: int, most: int = 8192) -> np.ndarray:
    """Circulant MinHash: coordinate k of a set is the minimum over its elements, put in place by the
    first permutation, of the second permutation shifted by k. Empty sets get the largest value."""
    first, second = permutations(coordinates)
    shifted = np.lib.stride_tricks.sliding_window_view(second, coordinates)
    out = np.full((len(sets), coordinates), np.uint32(0xFFFFFFFF))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    places = first[(flat >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(flat), most):
        of = owner[at : at + most]
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        lows = np.minimum.reduceat(shifted[places[at : at + most]], starts, axis=0)
        out[of[starts]] = np.minimum(out[of[starts]], lows)
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key of each band of each signature; different bands have different keys."""
    rows = signature.shape[1] // bands
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        keys = mix(keys + parts[:, :, r] * _WEIGHTS[r % len(_WEIGHTS)] + np.uint64(r + 1))
    return keys.view(np.int64)
