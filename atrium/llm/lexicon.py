"""A minimal acyclic transducer of words: one automaton with shared suffixes that maps each word to its ids.

The arcs carry numbers whose sum along a word's path is the word's rank among
all words; the ids of that rank are the output. The automaton is one file of
plain arrays, which every worker maps into memory.
"""

from __future__ import annotations

import numpy as np


class _Builder:
    """Adds words in sorted order; finished suffixes are shared with equal ones at once (Daciuk et al., 2000)."""

    def __init__(self):
        self.arcs: list[dict[int, int]] = [{}, {}]  # state 0 is the dead end, 1 the start
        self.final = [False, False]
        self.same: dict[tuple, int] = {}
        self.path: list[tuple[int, int, int]] = []
        self.last = b""

    def _state(self) -> int:
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def close(self, keep: int) -> None:
        while len(self.path) > keep:
            above, byte, state = self.path.pop()
            key = (self.final[state], tuple(self.arcs[state].items()))
            self.arcs[above][byte] = self.same.setdefault(key, state)

    def add(self, word: bytes) -> None:
        shared = 0
        while shared < min(len(word), len(self.last)) and word[shared] == self.last[shared]:
            shared += 1
        self.close(shared)
        state = self.path[-1][2] if self.path else 1
        for byte in word[shared:]:
            new = self._state()
            self.path.append((state, byte, new))
            state = new
        self.final[state] = True
        self.last = word


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The transducer of non-empty words and their ids, as a file's contents."""
    order = sorted(words)
    b = _Builder()
    for w in order:
        b.add(w)
    b.close(0)
    used = [1]
    number = {0: 0, 1: 1}
    for s in used:
        for t in b.arcs[s].values():
            if t not in number:
                number[t] = len(number)
                used.append(t)
    classes = np.zeros(256, np.uint32)
    bytes_used = sorted({x for w in order for x in w})
    classes[bytes_used] = np.arange(1, len(bytes_used) + 1)
    width = len(bytes_used) + 1
    follow = np.zeros((len(used) + 1, width), np.uint32)
    skip = np.zeros_like(follow)
    final = np.zeros(len(used) + 1, np.uint32)
    counts: dict[int, int] = {}
    stack = [(1, False)]
    while stack:
        s, done = stack.pop()
        if s in counts:
            continue
        if not done:
            stack.append((s, True))
            stack += [(t, False) for t in b.arcs[s].values() if t not in counts]
            continue
        total, row = int(b.final[s]), number[s]
        final[row] = total
        for byte in sorted(b.arcs[s]):
            t = b.arcs[s][byte]
            follow[row, classes[byte]], skip[row, classes[byte]] = number[t], total
            total += counts[t]
        counts[s] = total
    lengths = np.array([len(words[w]) for w in order], np.uint32)
    flat = np.array([i for w in order for i in words[w]], np.uint32)
    head = np.array([len(used) + 1, width, len(order), len(flat), max(map(len, order), default=0)], np.uint32)
    return b"".join(part.tobytes() for part in (head, classes, final, follow, skip, lengths, flat))


class Lexicon:
    def __init__(self, path: str):
        data = np.memmap(path, np.uint32, "r")
        states, width, n, ids, self.longest = (int(x) for x in data[:5])
        cuts = np.cumsum([5, 256, states, states * width, states * width, n, ids])
        self.classes, self.final, follow, skip, self.lengths, self.flat = (data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        self.follow, self.skip = follow.reshape(states, width), skip.reshape(states, width)
        self.offsets = np.cumsum(self.lengths, dtype=np.int64) - self.lengths

    def lookup(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The rank of each word buf[start:start + length], or -1: all words step through the automaton together."""
        state, rank = np.ones(len(starts), np.uint32), np.zeros(len(starts), np.int64)
        state[(lengths > self.longest) | (lengths == 0)] = 0
        at = np.flatnonzero(state)
        step = 0
        while len(at):
            byte = self.classes[buf[starts[at] + step]]
            here = state[at]
            rank[at] += self.skip[here, byte]
            state[at] = self.follow[here, byte]
            step += 1
            at = at[(state[at] != 0) & (lengths[at] > step)]
        return np.where(self.final[state] > 0, rank, -1)
