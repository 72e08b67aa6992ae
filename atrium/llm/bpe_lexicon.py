"""BPE encoding by a transducer of frequent words, exact merging of all others, and decoding.

The words of the whole corpus are counted; the most frequent (a bounded
number) are compiled with their ids into a minimal acyclic transducer, which
is shipped as a file and mapped into memory by the workers. Words that are not
in it are merged by the tokenizer's rules, many at once, and remembered.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.codepoints import DIGIT, LETTER, OTHER, SPACE, gathered, kinds, lowered, points
from atrium.llm.lexicon import Lexicon, compile_lexicon
from atrium.scratch import settings, write_file, write_table

#: Words in the transducer, the longest in bytes, and unseen words that a worker remembers or counts before it starts anew.
LEXICON, LONGEST, REMEMBERED = 1 << 16, 64, 300_000
_CHUNK = 1_000_000
#: Longer words are merged one by one.
_TOGETHER = 48
_NONE = 1 << 30


class Rules:
    """The tokenizer's vocabulary and merges, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary = data["model"]["vocab"]
        self.suffix = data["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        names = [b""] * size
        for token, i in [*vocabulary.items(), *self.special.items()]:
            names[i] = token.encode()
        self.names = names
        # The printable stand-ins of bytes: printable Latin-1 for itself, the others from U+0100 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        stand_in = dict(zip(plain, plain, strict=True)) | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        self.inner = np.array([vocabulary[chr(stand_in[b])] for b in range(256)], np.int64)
        self.last = np.array([vocabulary[chr(stand_in[b]) + self.suffix] for b in range(256)], np.int64)
        self.width = size
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in data["model"]["merges"]]
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array([m for *_, m in pairs], np.int64)[order]

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair of symbols: the merge's rank (_NONE if there is no such merge) and what it makes."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(found, self.ranks[at], _NONE), np.where(found, self.made[at], -1)

    def _one(self, symbols: np.ndarray) -> list[int]:
        while len(symbols) > 1:
            rank, made = self.rank(symbols[:-1], symbols[1:])
            best = rank.min()
            if best == _NONE:
                break
            # All places of the best pair, from the left, without overlap.
            at, taken = [], -2
            for p in np.flatnonzero(rank == best).tolist():
                if p > taken + 1 or p != taken + 1:
                    at.append(p)
                    taken = p
            symbols = symbols.copy()
            symbols[at] = made[at[0]]
            symbols = np.delete(symbols, np.array(at) + 1)
        return symbols.tolist()

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of non-empty words: always the merge of lowest rank, leftmost first."""
        out: list[list[int]] = [[]] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= _TOGETHER]
        for i, w in enumerate(words):
            if len(w) > _TOGETHER:
                symbols = self.inner[np.frombuffer(w, np.uint8)]
                symbols[-1] = self.last[w[-1]]
                out[i] = self._one(symbols)
        if not short:
            return out
        sizes = np.array([len(words[i]) for i in short])
        widest = int(sizes.max())
        data = np.frombuffer(b"".join(words[i].ljust(widest, b"\0") for i in short), np.uint8).reshape(len(short), widest)
        columns = np.arange(widest)
        symbols = np.where(columns < sizes[:, None], self.inner[data], -1)
        every = np.arange(len(short))
        symbols[every, sizes - 1] = self.last[data[every, sizes - 1]]
        symbols = np.hstack([symbols, np.full((len(short), 2), -1)])
        ranks, made = self.rank(symbols[:, :-1], symbols[:, 1:])
        rows = every
        while len(rows):
            p = ranks.argmin(1)
            here = np.arange(len(rows))
            go = ranks[here, p] < _NONE
            for k in np.flatnonzero(~go).tolist():
                s = symbols[k]
                out[short[rows[k]]] = s[s >= 0].tolist()
            rows, symbols, ranks, made, p = rows[go], symbols[go], ranks[go], made[go], p[go]
            if not len(rows):
                break
            here = np.arange(len(rows))
            symbols[here, p] = made[here, p]
            shift = np.minimum(np.arange(symbols.shape[1]) + (np.arange(symbols.shape[1]) > p[:, None]), symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, shift, 1)
            ranks, made = np.take_along_axis(ranks, shift[:, :-1].clip(max=ranks.shape[1] - 1), 1), np.take_along_axis(made, shift[:, :-1].clip(max=made.shape[1] - 1), 1)
            for q in (p - 1, p):
                ok = q >= 0
                h, q = here[ok], q[ok]
                ranks[h, q], made[h, q] = self.rank(symbols[h, q], symbols[h, q + 1])
            keep = int((symbols >= 0).sum(1).max()) + 2
            symbols, ranks, made = symbols[:, :keep], ranks[:, : keep - 1], made[:, : keep - 1]
        return out


@cache
def rules(path: str) -> Rules:
    return Rules(path)


class Split:
    """The tokenizer's words of some texts: NFC, lower case, letters together, digits alone, other signs together."""

    def __init__(self, texts: list[str]):
        plain = [t if t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in texts]
        joined = "\n".join(plain) + "\n"
        if "İ" in joined:  # the one letter whose lower case is two
            plain = [t.replace("İ", "i̇") for t in plain]
            joined = "\n".join(plain) + "\n"
        c = lowered()[points(joined)]
        kind = kinds()[c]
        before = np.append(np.uint8(SPACE), kind[:-1])
        starts = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
        ends = np.append((kind[:-1] != SPACE) & ((kind[:-1] != kind[1:]) | (kind[:-1] == DIGIT)), kind[-1] != SPACE)
        quotes = np.flatnonzero((c == 0x27) & starts & np.append(kind[1:] == LETTER, False))
        if len(quotes):
            x, y = c[quotes + 1], c[np.minimum(quotes + 2, len(c) - 1)]
            one = np.isin(x, [ord(k) for k in "stmd"])
            two = ((x == ord("r")) & (y == ord("e"))) | ((x == ord("v")) & (y == ord("e"))) | ((x == ord("l")) & (y == ord("l")))
            for some, size in ((quotes[one], 1), (quotes[two], 2)):
                starts[some + 1] = ends[some] = False
                ends[some + size] = True
                follows = some + size + 1
                starts[follows[kind[follows] == LETTER]] = True
        wide = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
        edge = np.append(0, np.cumsum(wide))
        first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.raw = c.astype("<u4").tobytes().decode("utf-32-le").encode()
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.starts, self.lengths = edge[first], edge[last] - edge[first]
        sizes = np.cumsum([len(t) + 1 for t in plain])
        self.cuts = np.append(0, np.searchsorted(first, sizes))

    def words(self, at: np.ndarray) -> list[bytes]:
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.starts[at].tolist(), (self.starts[at] + self.lengths[at]).tolist(), strict=True)]


class Encoder:
    def __init__(self, tokenizer: str, lexicon: str):
        self.rules, self.lexicon = rules(tokenizer), Lexicon(lexicon)
        self.cut = re.compile("|".join(map(re.escape, self.rules.special)) or "(?!)")
        self._forget()

    def _forget(self) -> None:
        n = len(self.lexicon.lengths)
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.concatenate([self.lexicon.flat, np.zeros(1 << 16, np.uint32)]), len(self.lexicon.flat)
        self.offsets, self.lengths = (np.concatenate([x, np.zeros(1 << 16, np.int64)]) for x in (self.lexicon.offsets, self.lexicon.lengths))
        self.n = n

    def _learn(self, words: list[bytes]) -> None:
        found = self.rules.merge(words)
        need = sum(map(len, found))
        if self.used + need > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + need))
        if self.n + len(words) > len(self.offsets):
            size = 2 * (self.n + len(words))
            self.offsets, self.lengths = np.resize(self.offsets, size), np.resize(self.lengths, size)
        for w, ids in zip(words, found, strict=True):
            self.flat[self.used : self.used + len(ids)] = ids
            self.offsets[self.n], self.lengths[self.n], self.known[w] = self.used, len(ids), self.n
            self.n, self.used = self.n + 1, self.used + len(ids)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        s = Split(texts)
        word = self.lexicon.lookup(s.buf, s.starts, s.lengths)
        rest = np.flatnonzero(word < 0)
        if len(rest):
            if len(self.known) > REMEMBERED:
                self._forget()
            words = s.words(rest)
            new = [w for w in dict.fromkeys(words) if w not in self.known]
            if new:
                self._learn(new)
            word[rest] = [self.known[w] for w in words]
        lengths = self.lengths[word]
        ids = gathered(self.flat, self.offsets[word], lengths)
        total = np.append(0, np.cumsum(lengths))[s.cuts]
        return [ids[a:b] for a, b in zip(total[:-1], total[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. A special token's string in a text is that token, as in the tokenizers library."""
        parts, special = [], {}
        for i, t in enumerate(texts):
            if "<" in t and (found := self.cut.findall(t)):
                special[i] = found
                parts.append(self.cut.split(t))
            else:
                parts.append([t])
        ids = iter(self._plain([p for ps in parts for p in ps]))
        out = []
        for i, ps in enumerate(parts):
            own = [next(ids)]
            for name, _ in zip(special.get(i, ()), ps[1:], strict=False):
                own += [np.array([self.rules.special[name]], np.uint32), next(ids)]
            out.append(np.concatenate(own) if len(own) > 1 else own[0])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' names with a space between, in UTF-8; the vocabulary file names no other decoder."""
        return b" ".join(map(self.rules.names.__getitem__, ids.tolist()))


@cache
def _encoder(tokenizer: str, file: str) -> Encoder:
    return Encoder(tokenizer, SparkFiles.get(file))


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > _CHUNK:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _texts(series: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in series]


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[bytes, int] = {}
    give = lambda: pd.DataFrame({"word": list(total), "n": list(total.values())})
    for pdf in frames:
        texts = _texts(pdf["text"])
        for a, b in _chunks(texts):
            s = Split(texts[a:b])
            for w, n in pd.Series(s.words(np.flatnonzero(s.lengths <= LONGEST)), dtype=object).value_counts(sort=False).items():
                total[w] = total.get(w, 0) + int(n)
            if len(total) > REMEMBERED:
                yield give()
                total.clear()
    yield give()


def build_lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON) -> str:
    """Counts all words of docs, compiles the most frequent ones and ships the file; returns its name.

    The words are those more frequent than a cut-off, the lowest that leaves
    at most `size` of them. What is in the transducer decides how fast
    encoding is, never its result.
    """
    spark = docs.sparkSession
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        counts = docs.select("text").mapInPandas(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = write_table(counts.where("n > 1"), "words")
    # Frequencies first: taking the top words of every task would send `size` words from each to the driver.
    cut, total = 1, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(size).collect():
        total += r["words"]
        if total > size:
            cut = r["n"]
            break
    words = [bytes(r["word"]) for r in counts.where(F.col("n") > cut).select("word").collect()]
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    data = compile_lexicon(dict(zip(words, rules(tokenizer).merge(words), strict=True)))
    spark.sparkContext.addFile(write_file(spark, name, data))
    return name


def encoded(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """doc_id and ids (array of int) of each row of docs."""

    @F.pandas_udf("array<int>")
    def ids(series: pd.Series) -> pd.Series:
        encode, texts = _encoder(tokenizer, lexicon).encode, _texts(series)
        return pd.Series([x.astype(np.int32) for a, b in _chunks(texts) for x in encode(texts[a:b])], dtype=object)

    return docs.select("doc_id", ids("text").alias("ids"))


def bpe_round_trip(docs: DataFrame, tokenizer: str, size: int = LEXICON) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids and decode to the empty string. Repeated
    rows and null doc_ids are encoded like any others; an empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """
    lexicon = build_lexicon(docs, tokenizer, size)

    def trip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = _encoder(tokenizer, lexicon)
        for pdf in frames:
            texts, n, digests, decoded = _texts(pdf["text"]), [], [], []
            for a, b in _chunks(texts):
                for ids in e.encode(texts[a:b]):
                    n.append(len(ids))
                    digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    decoded.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").array, "n_tokens": n, "ids_sha256": digests, "decoded_sha256": decoded})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(trip, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
