"""Word shingle sets as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Bytes of text that are hashed together; bounds the working memory of a task.
CHUNK_BYTES = 1_000_000
_BASE, _STEP = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xA0761D6478BD642F)
    return x ^ (x >> U64(29))


_BYTE = mix64(np.arange(1, 257, dtype=U64) * _BASE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and each text's first word in them (with the end as last entry).

    Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z.
    """
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
    starts, stops = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, U64), np.zeros(len(texts) + 1, np.int64)
    lengths = stops - starts
    values = _BYTE[_LOWER[buf[~space]]]
    begin = np.cumsum(lengths) - lengths
    values *= powers(_STEP, int(lengths.max()))[np.arange(len(values)) - np.repeat(begin, lengths)]
    return mix64(np.add.reduceat(values, begin)), np.concatenate([[0], np.searchsorted(starts, ends)])


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """For each text its distinct k-word shingles; with fewer words, the whole sequence as one; without words, none."""
    words, first = word_hashes(texts)
    n, weights = len(words), powers(_BASE, k)
    whole = np.zeros(max(n - k + 1, 0), U64)
    for j in range(k):
        whole += words[j : n - k + 1 + j] * weights[j] if n >= k else U64(0)
    whole = mix64(whole ^ U64(k))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            out.append(mix64(np.array([(words[a:b] * weights[: b - a]).sum(dtype=U64) ^ U64(b - a)], U64)))
        else:
            out.append(np.empty(0, U64))
    return out


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about size bytes together; a longer text is alone."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def as_bytes(texts) -> list[bytes]:
    """UTF-8; null is empty."""
    return [t.encode() if isinstance(t, str) else b"" for t in texts]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union, and share something."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)
