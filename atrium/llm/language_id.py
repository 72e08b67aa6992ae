"""Language identification of words, spans and documents.

Each word gets a score per language: the log likelihood of its hashed
character trigrams. The scripts of a word narrow the candidates to languages
that were seen to write in them. Viterbi over the words, with a penalty for
every switch, then labels the spans of mixed-language text. Viterbi runs in
blocks of words: each block is first solved from every possible state before
it, so that many blocks (of many documents, or of one very long one) advance
together and the result is still the exact best path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.llm.codepoints import LETTER, kinds, lowered, points
from atrium.scratch import settings

BUCKETS = 1 << 16
#: Nats that a switch of language costs.
SWITCH = 6.0
_BLOCK, _CHUNK = 64, 1_000_000
#: First code points of the Unicode ranges that tell scripts apart.
SCRIPTS = {"latin": 0x0041, "greek": 0x0370, "cyrillic": 0x0400, "armenian": 0x0530, "hebrew": 0x0590, "arabic": 0x0600, "indic": 0x0900, "thai": 0x0E00, "tibetan": 0x0F00, "georgian": 0x10A0, "hangul jamo": 0x1100, "ethiopic": 0x1200, "latin extended": 0x1E00, "greek extended": 0x1F00, "kana": 0x3040, "bopomofo": 0x3100, "han": 0x3400, "hangul": 0xAC00, "other": 0xD7B0}
_STARTS = np.array(list(SCRIPTS.values()))
_SAME = {"latin extended": "latin", "greek extended": "greek", "hangul jamo": "hangul", "bopomofo": "han"}
_SCRIPT = np.array([list(SCRIPTS).index(_SAME.get(k, k)) for k in SCRIPTS])
#: A language's share of letters in a script from which it is a candidate for words in it.
SCRIPT_SHARE = 0.001
UNKNOWN = "und"


@dataclass
class Words:
    """The words (runs of letters) of some texts, with a hashed trigram and a script for each letter."""

    grams: np.ndarray
    scripts: np.ndarray
    begin: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    at: np.ndarray


def words_of(texts: list[str]) -> Words:
    """at: each word's position within its own text, in code points. first: each text's first word, and the end."""
    c = points("\n".join(texts) + "\n")
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    letter = kinds()[c] == LETTER
    low = np.where(letter, lowered()[c], 0)
    edge = np.flatnonzero(np.diff(letter.view(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    where = np.flatnonzero(letter)
    before = np.where(where > 0, low[np.maximum(where - 1, 0)], 0)
    h = before * np.uint32(0x9E3779B1) ^ low[where] * np.uint32(0x85EBCA77) ^ low[where + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    first = np.append(np.searchsorted(begin, starts), len(begin))
    lengths = end - begin
    script = _SCRIPT[np.maximum(np.searchsorted(_STARTS, c[where], "right") - 1, 0)]
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words((h >> np.uint32(16)).astype(np.int64), script, np.cumsum(lengths) - lengths, lengths, first, begin - starts[owner])


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The state of each word on its text's best path; texts are scores[first[i]:first[i + 1]]."""
    n, k = scores.shape
    sizes = np.diff(first)
    blocks = -(-sizes // _BLOCK)
    total = int(blocks.sum())
    if not total:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), blocks)
    head = np.cumsum(blocks) - blocks
    number = np.arange(total) - head[owner]
    index = (first[owner] + number * _BLOCK)[:, None] + np.arange(_BLOCK)
    inside = index < first[owner + 1][:, None]
    padded = np.vstack([scores, np.zeros((1, k), scores.dtype)])
    steps = padded[np.where(inside, index, n)]
    # From every state before the block (a text's first block may start in any state for nothing).
    reach = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(total, 0)
    reach[number == 0] = 0.0
    for t in range(_BLOCK):
        reach = np.maximum(reach, reach.max(2, keepdims=True) - penalty) + steps[:, t, None, :]
    ahead, came = np.zeros((total, k)), np.zeros((total, k), np.int64)
    for j in range(int(blocks.max())):
        now = head[blocks > j] + j
        through = reach[now] + (ahead[now - 1][:, :, None] if j else 0.0)
        came[now], ahead[now] = through.argmax(1), through.max(1)
    ends, begins = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for j in range(int(blocks.max()) - 1, -1, -1):
        now = head[blocks > j] + j
        last = blocks[blocks > j] == j + 1
        ends[now] = np.where(last, ahead[now].argmax(1), begins[np.minimum(now + 1, total - 1)])
        begins[now] = came[now, ends[now]]
    value = np.where(np.arange(k) == begins[:, None], 0.0, -np.inf)
    value[number == 0] = 0.0
    best, stays = np.zeros((_BLOCK, total), np.int64), np.zeros((_BLOCK, total, k), bool)
    for t in range(_BLOCK):
        best[t] = value.argmax(1)
        top = value.max(1, keepdims=True) - penalty
        stays[t] = value >= top
        value = np.maximum(value, top) + steps[:, t]
    path, state, rows = np.zeros((total, _BLOCK), np.int64), ends, np.arange(total)
    for t in range(_BLOCK - 1, -1, -1):
        path[:, t] = state
        state = np.where(stays[t, rows, state], state, best[t])
    return path[inside]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > _CHUNK:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logs: np.ndarray
    allowed: np.ndarray

    def label(self, texts: list[str], penalty: float = SWITCH) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """For each text its language, that language's share of the letters, and the spans (start, end, language)."""
        if not self.languages:
            return [(UNKNOWN, 0.0, []) for _ in texts]
        w = words_of(texts)
        if not len(w.lengths):
            return [(UNKNOWN, 0.0, []) for _ in texts]
        scores = np.add.reduceat(self.logs[w.grams], w.begin)
        # A word's candidates: languages that write in all of its scripts, or all languages if none does.
        fits = np.logical_and.reduceat(self.allowed[w.scripts], w.begin)
        fits[~fits.any(1)] = True
        scores[~fits] -= 1e6
        path = best_path(scores, w.first, penalty)
        out = []
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            if a == b:
                out.append((UNKNOWN, 0.0, []))
                continue
            p, size, at = path[a:b], w.lengths[a:b], w.at[a:b]
            letters = np.bincount(p, size, len(self.languages))
            top = int(letters.argmax())
            cut = np.flatnonzero(np.diff(p)) + 1
            s, e = np.append(0, cut), np.append(cut, len(p)) - 1
            spans = [(int(x), int(y), self.languages[z]) for x, y, z in zip(at[s], at[e] + size[e], p[s], strict=True)]
            out.append((self.languages[top], float(letters[top] / letters.sum()), spans))
        return out

    def predict(self, text: Column | str, penalty: float = SWITCH) -> Column:
        """A struct of lang_pred, score and spans for a text column."""
        model = self

        @F.pandas_udf("lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
        def predicted(series: pd.Series) -> pd.DataFrame:
            texts = [t if isinstance(t, str) else "" for t in series]
            rows = [r for a, b in _chunks(texts) for r in model.label(texts[a:b], penalty)]
            return pd.DataFrame(
                {
                    "lang_pred": [r[0] for r in rows],
                    "score": np.array([r[1] for r in rows], float),
                    "spans": [[{"start": s, "end": e, "lang": g} for s, e, g in r[2]] for r in rows],
                }
            )

        return predicted(text)


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams: dict[str, np.ndarray] = {}
    for pdf in frames:
        for lang, part in pdf.groupby("lang"):
            texts = part["text"].tolist()
            for a, b in _chunks(texts):
                w = words_of(texts[a:b])
                total = grams.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                total += np.bincount(np.concatenate([w.grams, w.scripts + BUCKETS]), minlength=len(total))
    for lang, total in grams.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": total[at]})


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts the trigrams and scripts of all rows with text and lang; the model is languages x buckets numbers."""
    labelled = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    with settings(rows.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        counts = labelled.mapInPandas(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    table[np.searchsorted(languages, counts["lang"]) if languages else [], counts["bucket"].astype(int)] = counts["n"]
    grams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    smooth = 0.05
    logs = np.log(grams + smooth) - np.log(grams.sum(1, keepdims=True) + smooth * BUCKETS)
    allowed = scripts >= SCRIPT_SHARE * scripts.sum(1, keepdims=True)
    allowed &= scripts > 0
    return LanguageModel(languages, np.ascontiguousarray(logs.T.astype(np.float32)), np.ascontiguousarray(allowed.T))


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, penalty: float = SWITCH) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, n_spans, spans.

    Trained on documents that are not held out and have text and lang; the
    prediction sees the text only. lang_pred is the language of most letters
    (ties: the first in order), score its share of all letters. Null texts
    and texts without a letter get `und`, score 0 and no span. A null doc_id
    counts as not held out. If nothing can be learned, all texts get `und`.
    Other columns are ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(~held_out("doc_id")))
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), model.predict("text", penalty).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", F.size("p.spans").alias("n_spans"), "p.spans")
