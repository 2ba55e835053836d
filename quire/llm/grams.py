"""Numpy helpers on blocks of token sequences: n-gram identifiers by prefix doubling,
window minima, and runs of windows that share a minimum.

A block holds the tokens of several documents one after the other; ``starts`` has the
offset of each document and, last, the length of the block. All identifiers are 64-bit
(wrapping unsigned arithmetic); two ``lanes`` with different constants make a 128-bit one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers, two for each doubling step and lane, from a fixed seed.
_MULT = np.random.default_rng(20240607).integers(1, 1 << 63, (2, 64, 2), dtype=np.uint64) | np.uint64(1)
#: Values of the 256 byte values, for each lane.
BYTE_VALUE = np.random.default_rng(77).integers(0, 1 << 63, (2, 256), dtype=np.uint64)
_BASE = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Positions whose windows are named at once: all arrays of the steps stay in a core's cache.
CHUNK = 1 << 14
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the information of all bits over all bits."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def pair(a: np.ndarray, b: np.ndarray, step: int, lane: int = 0) -> np.ndarray:
    """Identifier of a pair of identifiers."""
    out = a * _MULT[lane, step, 0]
    out += b * _MULT[lane, step, 1]
    out ^= out >> np.uint64(32)
    return out


def gram_ids(tokens: np.ndarray, sizes: list[int], lane: int = 0) -> dict[int, np.ndarray]:
    """For each size n, the identifier of the n tokens from each position on.

    A window of 2n tokens is named by the names of its two halves, and a window of any
    other size by two overlapping windows of the next lower power of two.
    """
    out, power, step, have = {}, 1, 0, tokens
    for n in sorted(sizes):
        while power * 2 <= n:
            have = pair(have[: max(0, len(have) - power)], have[power:], step, lane)
            power, step = power * 2, step + 1
        lag = n - power
        if lag:
            stop = max(0, len(have) - lag)
            out[n] = pair(have[:stop], have[lag:], 32 + n % 32, lane)
        else:
            out[n] = have
    return out


def window_ids(tokens: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """``gram_ids`` of one size, made in chunks."""
    out = np.empty(max(0, len(tokens) - n + 1), dtype=np.uint64)
    for i in range(0, len(out), CHUNK):
        stop = min(i + CHUNK, len(out))
        out[i:stop] = gram_ids(tokens[i:stop + n - 1], [n], lane)[n]
    return out


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours."""
    have, power = x, 1
    while power * 2 <= width:
        have = np.minimum(have[: max(0, len(have) - power)], have[power:])
        power *= 2
    lag = width - power
    return np.minimum(have[: max(0, len(have) - lag)], have[lag:]) if lag else have


def valid_windows(starts: np.ndarray, width: int) -> np.ndarray:
    """Positions from which ``width`` tokens lie within one document, ascending."""
    count = np.maximum(np.diff(starts) - width + 1, 0)
    total = int(count.sum())
    first = np.repeat(starts[:-1] - (np.cumsum(count) - count), count)
    return first + np.arange(total)


def word_bounds(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word (bytes other than 0x20 and 0x09 to 0x0D) of a buffer."""
    inside = np.empty(len(text) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[text], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int, lane: int) -> np.ndarray:
    if len(_POWERS[lane]) < n:
        row = np.full(max(n, 1 << 16), _BASE[lane], dtype=np.uint64)
        row[0] = 1
        _POWERS[lane] = np.multiply.accumulate(row)
    return _POWERS[lane]


def word_ids(text: np.ndarray, first: np.ndarray, last: np.ndarray, lane: int = 0) -> np.ndarray:
    """Identifier of each word of a buffer, from its bytes."""
    if not len(first):
        return np.empty(0, dtype=np.uint64)
    size = last - first
    at = np.zeros(int(first[-1] + size[-1]) + 1, dtype=np.int64)
    at[first[1:]] = first[1:] - first[:-1]
    at[first[0]] = first[0]
    place = np.arange(len(at)) - np.cumsum(at)  # offset from the last word start
    value = BYTE_VALUE[lane][text[: len(at) - 1]]
    value[_SPACE[text[: len(at) - 1]]] = 0
    place = place[:-1]
    np.clip(place, 0, None, out=place)
    value *= powers(int(place.max()) + 1, lane)[place]
    got = np.add.reduceat(value, first)
    return mix(got + size.astype(np.uint64))


def blocks(rows: Iterator[tuple], size_of, limit: int) -> Iterator[list[tuple]]:
    """Rows in lists whose sizes sum to about ``limit``; a longer row makes one of its own."""
    part, total = [], 0
    for row in rows:
        n = size_of(row)
        if part and total + n > limit:
            yield part
            part, total = [], 0
        part.append(row)
        total += n
    if part:
        yield part


class Windows:
    """Windows of ``k`` tokens in a block, grouped into pieces.

    The anchor of a window is the least identifier of its k - q + 1 q-grams: equal windows
    have equal anchors wherever they stand. A piece is a run of neighbouring windows of one
    document with the same anchor, at most k - q + 1 long; ``at`` and ``count`` hold the first
    window and the number of windows of each piece.
    """

    def __init__(self, tokens: np.ndarray, starts: np.ndarray, k: int, q: int, named: bool = True):
        self.k, self.starts = k, starts
        least = np.empty(max(0, len(tokens) - k + 1), dtype=np.uint64)
        self.window = np.empty_like(least) if named else None  # not made where only anchors are asked for
        for i in range(0, len(least), CHUNK):
            here = slice(i, min(i + CHUNK, len(least)))
            ids = gram_ids(tokens[i:here.stop + k - 1], [q, k] if named else [q])
            least[here] = window_min(mix(ids[q]), k - q + 1)[:here.stop - i]
            if named:
                self.window[here] = ids[k]
        stop = starts[1:] - k + 1  # of the windows that lie within each document
        new = np.ones(len(least), dtype=bool)
        new[1:] = least[1:] != least[:-1]
        new[starts[:-1][starts[:-1] < stop]] = True
        run = np.flatnonzero(new)
        size = np.minimum(np.append(run[1:], len(least)), stop[self.documents(run)]) - run
        run, size = run[size > 0], size[size > 0]
        most = k - q + 1
        if len(size) and size.max() > most:  # only where a q-gram repeats at short distance
            parts = -(-size // most)
            step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            run, size = np.repeat(run, parts) + step * most, np.repeat(size, parts)
            size = np.minimum(size - step * most, most)
        self.at, self.count, self.anchor = run, size, least[run]

    def documents(self, at: np.ndarray) -> np.ndarray:
        """The document, by its number in the block, of each position."""
        return np.searchsorted(self.starts, at, "right") - 1

    def piece_ids(self, which: np.ndarray, lane_window: np.ndarray, lane: int) -> np.ndarray:
        """Identifier of the whole token sequence of a piece: of its first and last window
        (which overlap or touch) and its length."""
        first, count = self.at[which], self.count[which]
        both = pair(lane_window[first], lane_window[first + count - 1], 31, lane)
        return mix(both + count.astype(np.uint64))
