"""Ids of a byte-level BPE tokenizer for many texts at once.

Texts are split into the tokenizer's words with array operations, and each
distinct word is encoded once per Python worker by the tokenizers library.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
import pandas as pd

from atrium.llm.codepoints import SPACE, gathered, kinds, part_hashes, points

#: Texts with one of these go to the library as a whole: the split below doesn't know contractions.
_CONTRACTION = re.compile("'(?:[stmd]|re|ve|ll)")
#: Distinct words that a worker remembers before it starts anew.
REMEMBERED = 400_000


def word_starts(c: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where words begin: runs of letters, digits or other signs take one space (U+0020) before them along; of
    white space before a word, the last character is apart from the rest; at a text's end it stays together."""
    kind = kinds()[c]
    new = np.zeros(len(c) + 1, bool)
    new[text_starts] = new[-1] = True
    before = np.empty_like(kind)
    before[0], before[1:] = 9, kind[:-1]
    before[text_starts] = 9
    change = kind != before
    after_blank = np.zeros(len(c), bool)
    after_blank[1:] = c[:-1] == 0x20
    after_blank[text_starts] = False
    starts = change & ~((kind != SPACE) & after_blank)
    space = kind == SPACE
    last = space & ~np.append(space[1:], False) & ~new[1:]
    return np.flatnonzero(starts | last)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.offsets, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        if len(self.known) + len(words) > len(self.offsets):
            size = 2 * (len(self.known) + len(words))
            self.offsets, self.lengths = np.resize(self.offsets, size), np.resize(self.lengths, size)
        for h, e in zip(hashes, self.library.encode_batch_fast(words, add_special_tokens=False), strict=True):
            ids, i = e.ids, len(self.known)
            if self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
            self.flat[self.used : self.used + len(ids)] = ids
            self.offsets[i], self.lengths[i], self.known[h] = self.used, len(ids), i
            self.used += len(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the library gives them without special tokens added."""
        whole = {i for i, t in enumerate(texts) if ("'" in t and _CONTRACTION.search(t)) or any(s in t for s in self.special)}
        plain = [i for i, t in enumerate(texts) if t and i not in whole]
        out = [np.empty(0, np.uint32)] * len(texts)
        for i in sorted(whole):
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        if not plain:
            return out
        joined = "".join(texts[i] for i in plain)
        c = points(joined)
        sizes = np.array([len(texts[i]) for i in plain])
        text_starts = np.cumsum(sizes) - sizes
        starts = word_starts(c, text_starts)
        codes, distinct = pd.factorize(part_hashes(c, starts))
        if len(self.known) + len(distinct) > max(REMEMBERED, len(distinct)):
            self._forget()
        hashes = distinct.tolist()
        new = [j for j, h in enumerate(hashes) if h not in self.known]
        if new:
            at = np.empty(len(distinct), np.int64)
            at[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            ends = np.append(starts[1:], len(c))
            self._learn([hashes[j] for j in new], [joined[starts[k] : ends[k]] for k in at[new]])
        word = np.array([self.known[h] for h in hashes])[codes]
        lengths = self.lengths[word]
        ids = gathered(self.flat, self.offsets[word], lengths)
        total = np.append(0, np.cumsum(lengths))
        cuts = total[np.searchsorted(starts, np.append(text_starts, len(c)))]
        for i, a, b in zip(plain, cuts[:-1], cuts[1:], strict=True):
            out[i] = ids[a:b]
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
