"""Words and shingles of Arrow text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Word hashes are
polynomials modulo 2**64 over random byte values, taken from one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.default_rng(20240229)
_CASED = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE = _CASED.copy()
_BYTE[65:91] = _BYTE[97:123]
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK_BYTES + (1 << 18)), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= len(steps) and len(steps) <= 8 * BLOCK_BYTES:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes each; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text the place of its first word (with the total at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return run_hashes(data, starts, ends, _BYTE), np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _CASED) -> np.ndarray:
    """Hash of the bytes data[start:end] of each run."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _power("p", _P, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("i", _P_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each text, sorted, and the offsets of the texts. Fewer words: all of them as one."""
    n = len(words)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    m = np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        for i in range(k):
            full = full * m + words[i : n - k + 1 + i] if n >= k else full
        full = mix(full)
    out, ends = [], np.zeros(len(at), np.int64)
    for d in range(len(at) - 1):
        i, j = at[d], at[d + 1]
        if j - i >= k:
            own = full[i : j - k + 1]
            own = np.sort(own)
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif j > i:
            h = np.uint64(j - i)
            with np.errstate(over="ignore"):
                for w in words[i:j]:
                    h = h * m + w
            own = mix(np.array([h], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        else:
            own = full[:0]
        out.append(own)
        ends[d + 1] = ends[d] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), ends
