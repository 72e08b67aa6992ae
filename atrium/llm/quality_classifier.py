"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document. An
expectation-maximisation over the counts of all vote patterns (there are at
most 3 to the number of labellers, whatever the corpus' size) estimates each
labeller's accuracy per class and the posterior of each pattern. Posterior
labels of a bounded sample then train a linear scorer over hashed byte
trigrams and hashed buckets of the document's statistics, which decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.llm.shingles import as_bytes, chunks, word_hashes
from atrium.scratch import settings

#: Names of the labellers, in the order of a pattern's characters.
LABELLERS = ("symbols", "shouting", "exclamations", "separators", "stutter", "variety", "lines", "words")
GOOD, BAD, ABSTAIN = "1", "0", "-"
#: Hashed features, and documents of the sample that trains the scorer (the bound of the fit).
DIMENSIONS, SAMPLE = 4096, 3000
_ROUNDS, _STEPS = 100, 250
#: The prior on a labeller's rate of false alarms: uniform from 0 to this. The labellers are written to be precise. Whether votes
#: of one labeller alone are junk that only it sees, or its false alarms, can't be told from the votes, so the prior decides.
FALSE_ALARMS = 0.001

_KIND = np.zeros(256, np.uint8)
for _kind, _chars in enumerate((b"#$%&*@^~=<>{}[]\\_+", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"!", b"|"), 1):
    _KIND[list(_chars)] = _kind


def _per(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    return counts / np.maximum(of, 1)


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """What the labellers look at, for each text."""
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    kind = _KIND[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    symbols, upper, lower, exclaim, bars = (np.add.reduceat((kind == i).astype(np.int32), starts) for i in range(1, 6))
    words, first = word_hashes(texts)
    n = np.diff(first)
    same = np.zeros(len(words) + 1, np.int64)
    if len(words) > 1:
        same[2:] = np.cumsum(words[1:] == words[:-1])
        same[1] = 0
    stutter = np.maximum(same[first[1:]] - same[np.minimum(first[:-1] + 1, len(words))], 0)
    variety = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)])
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    repeated = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    return {
        "symbols": _per(symbols, n),
        "shouting": _per(upper, upper + lower),
        "exclamations": _per(exclaim, n),
        "separators": _per(bars, n),
        "stutter": _per(stutter, n),
        # Long texts repeat words by nature: compared with the size that a text of that length has.
        "variety": variety / np.maximum(n, 1) ** 0.9,
        "lines": repeated,
        "words": n.astype(float),
    }


#: A labeller says bad above the first number and good below the second; for variety and words, the other way round.
#: Set by hand for prose with blanks between words, from what such prose has at most (or least) and junk at least (or most).
LIMITS = {"symbols": (0.3, 0.05), "shouting": (0.3, 0.15), "exclamations": (0.15, 0.05), "separators": (0.12, 0.02), "stutter": (0.2, 0.05), "variety": (0.35, 0.6), "lines": (0.45, 0.35), "words": (1, 20)}


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """One pattern of votes for each text."""
    said = []
    for name in LABELLERS:
        x, (bad, good) = stats[name], LIMITS[name]
        low = name in ("variety", "words")
        said.append(np.where(x < bad if low else x > bad, BAD, np.where(x > good if low else x < good, GOOD, ABSTAIN)))
    return np.array(["".join(v) for v in zip(*said, strict=True)], object)


def estimate(counts: dict[str, int], false_alarms: float = FALSE_ALARMS) -> dict[str, float]:
    """The posterior of good for each pattern, by expectation-maximisation (Dawid and Skene, 1979)."""
    return fitted(counts, false_alarms)[0]


def fitted(counts: dict[str, int], false_alarms: float = FALSE_ALARMS) -> tuple[dict[str, float], np.ndarray]:
    """The posterior of good for each pattern, and the rates: by class (bad, good), labeller and vote (bad, good, none).

    Each step maximises the posterior under a uniform prior on [0, false_alarms]
    for how often a labeller votes bad on good documents; all other rates are free.
    """
    if not counts:
        return {}, np.zeros((2, len(LABELLERS), 3))
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    said = np.stack([np.array([list(p) for p in patterns]) == v for v in (BAD, GOOD, ABSTAIN)], 2).astype(float)
    good = np.array([0.1 if BAD in p else 0.9 for p in patterns])
    for _ in range(_ROUNDS):
        by_class = np.stack([n * (1 - good), n * good])
        prior = (by_class.sum(1) + 1) / (n.sum() + 2)
        rates = np.einsum("cp,plv->clv", by_class, said) + 0.1
        rates /= rates.sum(2, keepdims=True)
        rates[1, :, 0] = np.minimum(rates[1, :, 0], false_alarms)
        logs = np.log(prior)[:, None] + np.einsum("clv,plv->cp", np.log(rates), said)
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    return dict(zip(patterns, good.tolist(), strict=True)), rates


def features(texts: list[bytes], stats: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
    """The hashed vector of each text: square roots of trigram shares, and one unit for the bucket of each statistic."""
    slots = np.stack([np.minimum(np.floor(np.log2(1 + 64 * stats[k])), 20).astype(np.int64) + 32 * i for i, k in enumerate(LABELLERS)], 1)
    slots = (slots * 2654435761 + 97) % 1000003 % DIMENSIONS
    for i, t in enumerate(texts):
        b = np.frombuffer(t, np.uint8).astype(np.uint32)
        x = np.zeros(DIMENSIONS)
        if len(b) >= 3:
            h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            x = np.sqrt(np.bincount(h >> np.uint32(20), minlength=DIMENSIONS) / len(h))
        np.add.at(x, slots[i], 0.5)
        yield x


def fit(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over the whole sample; each class weighs the same."""
    w, bias = np.zeros(x.shape[1]), 0.0
    if not len(x):
        return w, bias
    share = float(np.clip(good.mean(), 0.02, 0.98))
    weight = np.where(good >= 0.5, 0.5 / share, 0.5 / (1 - share)) / len(x)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, _STEPS + 1):
        error = weight * (1 / (1 + np.exp(-(x @ w + bias))) - good)
        g = np.append(x.T @ error + 1e-4 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


_NOTHING = pd.DataFrame({"votes": np.empty(0, object), "weak_posterior": np.empty(0), "score": np.empty(0), "keep": np.empty(0, bool)})


@dataclass(frozen=True)
class QualityModel:
    """Bounded in size, whatever it was fitted on."""

    posterior: dict[str, float]
    weights: np.ndarray
    bias: float

    def score(self, text: Column | str) -> Column:
        """A struct of votes, weak_posterior, score and keep for a text column."""
        model = self

        @F.pandas_udf("votes string, weak_posterior double, score double, keep boolean")
        def scored(series: pd.Series) -> pd.DataFrame:
            texts, parts = as_bytes(series), []
            for start, stop in chunks(texts):
                some = texts[start:stop]
                stats = statistics(some)
                said = votes(stats)
                z = np.array([x @ model.weights for x in features(some, stats)]) + model.bias
                s = np.where(stats["words"] > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)
                parts.append(pd.DataFrame({"votes": said, "weak_posterior": [model.posterior.get(p, 0.5) for p in said], "score": s, "keep": s >= 0.5}))
            return pd.concat(parts, ignore_index=True) if parts else _NOTHING

        return scored(text)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, int] = {}
    for pdf in frames:
        texts = as_bytes(pdf["text"])
        for start, stop in chunks(texts):
            for p in votes(statistics(texts[start:stop])):
                total[p] = total.get(p, 0) + 1
    # An empty frame's columns would have the wrong types.
    if total:
        yield pd.DataFrame({"votes": list(total), "n": list(total.values())})


def _featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        texts = as_bytes(pdf["text"])
        for start, stop in chunks(texts):
            stats = statistics(texts[start:stop])
            x = [v.astype(np.float32).tobytes() for v in features(texts[start:stop], stats)]
            yield pd.DataFrame({"votes": votes(stats), "x": x})


def train(docs: DataFrame, sample: int = SAMPLE, false_alarms: float = FALSE_ALARMS) -> QualityModel:
    """Fits the labellers' accuracies on all documents and the scorer on at most `sample` of them.

    The sample is the distinct (doc_id, text) of the smallest hashes, so it
    depends neither on the order nor on the partitioning of the rows, and
    repeated rows count once. The driver gets at most 6,561 counts and `sample`
    vectors.
    """
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        counts = docs.select("text").mapInPandas(_count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))
        counts = {r["votes"]: r["n"] for r in counts.collect()}
        posterior = estimate(counts, false_alarms)
        own = F.xxhash64("doc_id", "text").alias("own")
        # Of so many rows, those under this hash are enough; hashes are uniform.
        under = min(1.0, 16 * sample / max(sum(counts.values()), 1))
        keyed = docs.where("doc_id is not null").select("text", own)
        near = keyed.where(F.col("own") <= F.lit(int(-(2**63) + under * (2**64 - 1)))) if under < 1 else keyed
        chosen = near.select("own").distinct().orderBy("own").limit(sample)
        # At most `sample` rows are broadcast; repeated rows are merged before they are gathered.
        rows = near.join(F.broadcast(chosen), "own", "left_semi").groupBy("own").agg(F.min("text").alias("text")).orderBy("own")
        data = rows.select("text").mapInPandas(_featured, "votes string, x binary").toPandas()
    x = np.stack([np.frombuffer(v, np.float32) for v in data["x"]]).astype(float) if len(data) else np.zeros((0, DIMENSIONS))
    return QualityModel(posterior, *fit(x, np.array([posterior.get(p, 0.5) for p in data["votes"]])))


def quality(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, votes, weak_posterior, score (0 to 1), keep.

    Only doc_id and text are read; other columns may be there, whatever their
    names. Null, empty and blank texts get score 0 and are not kept. Very long
    texts are read whole, each alone. Repeated rows each get the same decision;
    a score of exactly 0.5 keeps. An empty table gives an empty result. A model
    that was fitted on no row (all doc_ids null) scores texts with words 0.5
    and keeps them.
    """
    model = train(docs, sample)
    return docs.select("doc_id", model.score("text").alias("q")).select("doc_id", "q.*")
