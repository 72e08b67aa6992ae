"""Lookup tables over all code points, built once in each Python worker."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

LETTER, DIGIT, OTHER, SPACE = 1, 2, 3, 0
#: The code points of Unicode's White_Space property.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@cache
def kinds() -> np.ndarray:
    """LETTER (general category L), DIGIT (N), SPACE (White_Space) or OTHER."""
    category = unicodedata.category
    out = np.array([{"L": LETTER, "N": DIGIT}.get(category(chr(i))[0], OTHER) for i in range(0x110000)], np.uint8)
    out[list(WHITE_SPACE)] = SPACE
    return out


@cache
def lowered() -> np.ndarray:
    """The lower case of each code point, itself where that has several."""
    return np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(0x110000)], np.uint32)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def part_hashes(c: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each part of c; parts begin at starts and are adjacent."""
    from atrium.llm.shingles import mix64, powers

    lengths = np.diff(np.append(starts, len(c)))
    values = mix64((c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    values *= powers(np.uint64(0xD6E8FEB86659FD93), int(lengths.max(initial=1)))[np.arange(len(c)) - np.repeat(starts, lengths)]
    return mix64(np.add.reduceat(values, starts)) if len(starts) else np.empty(0, np.uint64)


def gathered(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[offsets[0]:+lengths[0]], flat[offsets[1]:+lengths[1]], ... behind one another."""
    begin = np.cumsum(lengths) - lengths
    return flat[np.arange(int(lengths.sum())) + np.repeat(offsets - begin, lengths)]
