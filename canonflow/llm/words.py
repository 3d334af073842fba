"""Words of many texts at once, as arrays: places, 64-bit hashes, hashes of word windows.

Words are runs of bytes other than the six ASCII spaces, so UTF-8 needs no decoding. Hashes are
polynomials modulo 2**64 taken from prefix sums (the Rabin-Karp identity: the hash of a window
is the difference of two prefix sums, divided by a power), mixed to spread their bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes whose words are hashed at once; memory for powers and sums is a few times this.
SEGMENT = 1 << 20
#: Odd multipliers.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
OTHER_BASE = 0xA0761D6478BD642F

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS = {b: Powers(b) for b in (BYTE_BASE, WORD_BASE, OTHER_BASE)}


class Words:
    """The words of `texts` (bytes), in order; `first[k]` is the number of text k's first word."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        edge = np.diff(_SPACE[self.buf].view(np.int8), prepend=np.int8(1))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]) if texts else np.zeros(1, np.int64)

    def hashes(self) -> np.ndarray:
        out, at = np.empty(len(self.start), np.uint64), 0
        while at < len(self.start):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + SEGMENT, side="right")))
            part = self.buf[base : self.end[to - 1]]
            up, down = _POWERS[BYTE_BASE].get(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
            at = to
        return mix64(out)


def window_hashes(words: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """Of every window of `width` consecutive hashes, across text borders too."""
    n = len(words)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _POWERS[base].get(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * down[: n - width + 1])


def slices(batch: pa.RecordBatch, column: int, size: int, most: int = 1 << 30) -> Iterator[tuple[int, int, list[bytes]]]:
    """The batch's rows in runs of at most `size` bytes of text and `most` rows, one row at least."""
    at, held, some = 0, 0, []
    for k, x in enumerate(batch.column(column)):
        data = b"" if not x.is_valid else x.as_py().encode()
        if some and (held + len(data) > size or len(some) == most):
            yield at, k, some
            at, held, some = k, 0, []
        some.append(data)
        held += len(data)
    if some:
        yield at, batch.num_rows, some
