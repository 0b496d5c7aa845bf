"""Words of many texts at once as numpy arrays: where they stand and a 64-bit hash of each.

A word's hash is a polynomial in its bytes, read off prefix sums modulo 2**64, so that a batch of
texts costs a few passes over its bytes instead of a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from planact.llm.common import groups_of

SLICE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_U64 = 1 << 64

WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def fold(raw: np.ndarray) -> np.ndarray:
    """A-Z and the two-byte capitals of Latin-1 as small letters; all else stays."""
    out = LOWER[raw]
    if len(raw) > 1:
        second = raw[1:]
        out[1:][(raw[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += 32
    return out


def powers(n: int, base: int = _BASE, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The first ``n`` powers of ``base`` and of its inverse, modulo 2**64."""
    have = _kept.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, _U64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            out.append(np.cumprod(row))
        have = _kept[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Prefix sums of values times powers of ``base``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1, base)[0][: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """The hash of values[start:end], the same wherever the span stands."""
    return mix((sums[end] - sums[start]) * powers(len(sums), base)[1][start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of the texts first .. last-1; places count from the first byte of the batch."""

    first: int
    last: int
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    prefixes: list[np.ndarray]


def _slices(inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a long text between words."""
    at, n = 0, len(inside)
    while at < n:
        end = min(n, at + SLICE)
        if end < n:
            gap = np.flatnonzero(~inside[at + 1 : end + 1])
            if len(gap):
                end = at + 1 + int(gap[-1])
            else:
                later = np.flatnonzero(~inside[end:])
                end = end + int(later[0]) if len(later) else n
        yield at, end
        at = end


def words(
    data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = WHITESPACE, cuts=None, prefix_bytes: tuple[int, ...] = ()
) -> Iterator[Words]:
    """Words as runs of bytes that ``outside`` does not mark, with capitals folded in the hash (see ``fold``).

    ``cuts(folded)`` may give extra marks: True where a word ends before this byte; ``inside`` may
    be widened by it too, as it returns both. ``prefix_bytes``: also hash that many first bytes.
    """
    for first, last in groups_of(offsets, SLICE):
        lo, hi = int(offsets[first]), int(offsets[last])
        raw = data[lo:hi]
        inside = ~outside[raw]
        breaks = None
        if cuts is not None:
            inside, breaks = cuts(raw, inside)
        heads = offsets[first:last] - lo
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        if breaks is not None:
            begins |= inside & breaks
        heads = heads[heads < len(raw)]
        begins[heads] |= inside[heads]
        start = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        end = np.flatnonzero(ends) + 1
        folded = fold(raw)
        hashes = np.empty(len(start), np.uint64)
        parts = [np.empty(len(start), np.uint64) for _ in prefix_bytes]
        for a, b in _slices(inside) if len(raw) > SLICE else [(0, len(raw))]:
            i, j = np.searchsorted(start, (a, b))
            if i == j:
                continue
            sums = prefix(folded[a:b].astype(np.uint64) + np.uint64(1))
            s, e = start[i:j] - a, end[i:j] - a
            hashes[i:j] = span_hash(sums, s, e)
            for out, n in zip(parts, prefix_bytes):
                out[i:j] = span_hash(sums, s, np.minimum(s + n, e))
        text = np.searchsorted(offsets[first : last + 1] - lo, start, "right") - 1 + first
        yield Words(first, last, start + lo, end + lo, text, hashes, parts)
