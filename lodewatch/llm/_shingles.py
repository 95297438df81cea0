"""Word shingles as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SIGN = np.random.default_rng(20240601).integers(1, 2**64, 256, np.uint64)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 1 << 20)
        for k, base in enumerate((_P, _P_INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x)
    return _powers


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the bytes; equal spans have equal hashes, wherever they stand."""
    power, inverse = _power(len(buf) + 1)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_SIGN[buf] * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes (runs of anything but space and U+0009 to U+000D, A-Z lower-cased) and where each text's words end."""
    joined = b"\n".join(texts).translate(_LOWER) + b"\n"
    buf = np.frombuffer(joined, np.uint8)
    blank = _SPACE[buf]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return span_hashes(buf, starts, ends), np.searchsorted(starts, text_ends)


def shingle_sets(texts: list[str], words: int, chunk_bytes: int = 1 << 20) -> Iterator[np.ndarray]:
    """Each text's distinct ``words``-word shingles, sorted; with fewer words the whole sequence is one, with none the set is empty."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    i = 0
    while i < len(raw):
        j, size = i, 0
        while j < len(raw) and (j == i or size + len(raw[j]) <= chunk_bytes):
            size += len(raw[j])
            j += 1
        hashes, ends = word_hashes(raw[i:j])
        joined = hashes
        for k in range(1, words):
            joined = mix(joined[:-1] * np.uint64(_P) + hashes[k:]) if len(joined) > 1 else joined[:0]
        a = 0
        for b in ends.tolist():
            if b - a >= words:
                yield np.unique(joined[a : b - words + 1])
            elif b == a:
                yield hashes[:0]
            else:
                one = hashes[a : a + 1]
                for k in range(a + 1, b):
                    one = mix(one * np.uint64(_P) + hashes[k : k + 1])
                yield one.copy()
            a = b
        i = j
