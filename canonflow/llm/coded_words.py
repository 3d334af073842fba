"""Texts as numbers of their distinct words, a whole batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_set(members: bytes) -> np.ndarray:
    """A table of 256 marks."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts with A-Z lower-cased, a newline behind each, and where each ends."""
    buf = _LOWER[np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)]
    return buf, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)


def coded(buf: np.ndarray, is_word: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each occurrence's word, and where in `buf` it starts. Words
    are runs of the bytes marked in `is_word`, which must not cut a UTF-8 sequence or hold the last
    byte of `buf`."""
    word = is_word[buf]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(buf[word].tobytes())]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int32), start
