"""Recompression: a run-length grammar over sequences, and extension queries on it.

Rounds alternate. Block compression replaces every maximal block of one symbol, `a...a`, by one
symbol; pair compression splits the alphabet in two and replaces every pair of a left and a right
symbol by one. A symbol always gets the same name, in all sequences and rounds, so equal stretches
are parsed alike but for a few symbols at their edges. Two positions are therefore compared by going
up from round to round while their symbols agree, a block remainder or one symbol at a time, and down
again from the first symbols that differ: as many steps as the grammar is high, at whatever length.

All of it works on arrays: many sequences in one grammar, many queries at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

EDGE = 0  # stands before, between and after the sequences; never compressed
MIX = 0x9E3779B97F4A7C15


@dataclass
class Round:
    """One round: the symbols before it, which symbol of the next round each belongs to, where the
    symbols of the next round begin (and the end), and whether it compressed blocks."""

    symbols: np.ndarray
    up: np.ndarray
    first: np.ndarray
    blocks: bool


class Grammar:
    """The grammar of `sequences`, symbols above 0 with an EDGE at both ends and between sequences."""

    def __init__(self, sequences: np.ndarray):
        symbols = sequences.astype(np.int32)
        self.rounds: list[Round] = []
        self.names = int(symbols.max(initial=0)) + 1
        edges = int((symbols == EDGE).sum())
        turn = 0
        while len(symbols) > 2 * edges - 1:  # until each sequence is one symbol
            step = _blocks(symbols, self) if turn % 2 == 0 else _pairs(symbols, self, turn)
            if step is not None:
                done, symbols = step
                self.rounds.append(done)
            turn += 1
        self.top = symbols

    def extend(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from positions a and b on, to the right (step 1) or the left (-1).
        Where a < b lie in one sequence, no answer reaches over an edge."""
        start = a
        a, b, live = a.astype(np.int64), b.astype(np.int64), np.arange(len(a))
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for r in self.rounds:
            agree = r.symbols[a] == r.symbols[b]
            stay = [(live[~agree], a[~agree], b[~agree])]
            live, a, b = live[agree], a[agree], b[agree]
            pa, pb = r.up[a], r.up[b]
            # what is left of the parents ahead, and whether a part of one lies behind
            if step > 0:
                left_a, left_b = r.first[pa + 1] - a, r.first[pb + 1] - b
                inside = (r.first[pa] != a) | (r.first[pb] != b)
            else:
                left_a, left_b = a - r.first[pa] + 1, b - r.first[pb] + 1
                inside = (r.first[pa + 1] - 1 != a) | (r.first[pb + 1] - 1 != b)
            move = np.where(inside, np.minimum(left_a, left_b), 0) * step
            a, b = a + move, b + move
            apart = inside & (left_a != left_b)  # one block goes on where the other ends
            stay.append((live[apart], a[apart], b[apart]))
            live, a, b = live[~apart], r.up[a[~apart]], r.up[b[~apart]]
            stopped.append(tuple(np.concatenate(x) for x in zip(*stay, strict=True)))
        for r, (more, more_a, more_b) in zip(self.rounds[::-1], stopped[::-1], strict=True):
            size_a, size_b = r.first[a + 1] - r.first[a], r.first[b + 1] - r.first[b]
            a, b = (r.first[a], r.first[b]) if step > 0 else (r.first[a + 1] - 1, r.first[b + 1] - 1)
            same = r.symbols[a] == r.symbols[b]
            move = np.where(same, np.minimum(size_a, size_b) if r.blocks else 1, 0) * step
            live, a, b = np.concatenate((live, more)), np.concatenate((a + move, more_a)), np.concatenate((b + move, more_b))
        out = np.empty(len(start), np.int64)
        out[live] = np.abs(a - start[live])
        return out


def _closed(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Round:
    begins = np.zeros(len(symbols), np.int64)
    begins[starts] = 1
    return Round(symbols, np.cumsum(begins) - 1, np.append(starts, len(symbols)), blocks)


def _named(keys: np.ndarray, grammar: Grammar) -> np.ndarray:
    """New symbols, equal for equal keys."""
    codes, values = pd.factorize(keys)
    codes = codes + grammar.names
    grammar.names += len(values)
    return codes


def _blocks(symbols: np.ndarray, grammar: Grammar) -> tuple[Round, np.ndarray] | None:
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    sizes = np.diff(np.append(starts, len(symbols)))
    long = sizes > 1
    if not long.any():
        return None
    out = symbols[starts]
    out[long] = _named(out[long].astype(np.int64) * (int(sizes.max()) + 1) + sizes[long], grammar)
    return _closed(symbols, starts, True), out


def _pairs(symbols: np.ndarray, grammar: Grammar, turn: int) -> tuple[Round, np.ndarray] | None:
    # a side for each symbol, another way each round; the better one of the two ways round
    odd = np.uint64((MIX * (2 * turn + 1)) & 0xFFFFFFFFFFFFFFFF)
    side = ((symbols.astype(np.uint64) + np.uint64(turn)) * odd >> np.uint64(47)) & np.uint64(1) == 1
    inner = symbols != EDGE
    a, b = side & inner, ~side & inner
    ahead, back = a[:-1] & b[1:], b[:-1] & a[1:]
    at = np.flatnonzero(ahead if ahead.sum() >= back.sum() else back)
    if not len(at):
        return None
    keys = symbols[at].astype(np.int64) * grammar.names + symbols[at + 1]
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    out = symbols.copy()
    out[at] = _named(keys, grammar)
    return _closed(symbols, np.flatnonzero(keep), False), out[keep]
