"""Content-defined anchors: where a repeated window can be found without listing all windows.

Texts are sequences of codes (64-bit hashes of words, or of bytes). Every window of `window`
codes has an anchor: the k-gram within it that has the smallest hash, the first of equals. Equal
windows have equal anchors at equal places, so windows need only be compared with windows of
the same anchor hash. Neighbouring windows mostly share their anchor: a run of windows with one
anchor is one row, with the hash of its context (all codes that its windows cover). Runs with
equal contexts hold equal windows throughout.
"""
from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Spans:
    """Hashes of any span of a code sequence, from sums of codes times powers (modulo 2**64)."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        powers = np.ones(n + 1, dtype=np.uint64)
        powers[1:] = _ODD
        powers = np.multiply.accumulate(powers)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.add.accumulate(codes * powers[:n], out=self.sums[1:])
        back = np.full(n + 1, _INVERSE, dtype=np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin])


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in values[i:i + width], for every i that has them all."""
    place, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = place[:-step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        reach += step
    return place


def runs(codes: np.ndarray, ends: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """All runs of a concatenation of texts (`ends`: where each ends).

    Returns, per run: text number, first window (in the concatenation), number of windows, place
    of the anchor behind the first window, hash of the anchor, hash of the context.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(codes) < window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    spans = Spans(codes)
    at = np.arange(len(codes) - k + 1)
    grams = spans.hash(at, at + k)
    anchor = first_minimum(grams, window - k + 1)
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    inside = np.flatnonzero(np.arange(len(anchor)) + window <= ends[text])
    if not len(inside):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (anchor[inside[1:]] != anchor[inside[:-1]]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(new)
    begin = inside[first]
    count = np.diff(np.append(first, len(inside)))
    return text[begin], begin, count, anchor[begin] - begin, grams[anchor[begin]], spans.hash(begin, begin + count + window - 1)
