"""Vector hashes of spans of bytes and of words, and what the repeat finders do within one task."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from xxhash import xxh3_64_intdigest

_BASE = 0x9E3779B97F4A7C15  # odd
_SEED = 0x5EED_0F_70_44_55


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = 1 << int(n).bit_length()
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS = _Powers(_BASE)


def every(buffer: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all spans of a length, by a polynomial modulo 2**64.  Texts can be made whose spans collide, so these
    hashes pick and deal; they never decide."""
    n = len(buffer) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _POWERS.to(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_table()[buffer] * up[: len(buffer)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * down[:n])


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes (XXH3) of words."""
    return np.fromiter((xxh3_64_intdigest(w, _SEED) for w in words), np.uint64, len(words))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of neighbouring spans from the spans' own; not a sum, so that no pattern of equal parts cancels out."""
    return mix(a * np.uint64(_BASE) + mix(b + np.uint64(1)))


def spans_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every so many neighbours, by spans of doubled width."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, size = None, 0, 1
    while True:
        if width & size:
            part = hashes[at : at + n]
            out, at = part if out is None else joined(out, part), at + size
        if 2 * size > width:
            return out
        hashes = joined(hashes[:-size], hashes[size:])
        size *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbours, by running minima of blocks from both sides."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(positions: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of each run of consecutive positions of one owner; both sorted."""
    if not len(positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(positions) != 1) | (np.diff(owners) != 0)]))
    return first, np.diff(np.concatenate([first, [len(positions)]]))


def covered(starts: np.ndarray, lengths: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of a width that starts in [start, start + length) for some run."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + lengths + width - 1, n), -1)
    return np.cumsum(step[:n]) > 0


def grouped(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to about most."""
    a = total = 0
    for b, size in enumerate(sizes):
        total += size
        if total >= most:
            yield a, b + 1
            a, total = b + 1, 0
    if a < len(sizes):
        yield a, len(sizes)
