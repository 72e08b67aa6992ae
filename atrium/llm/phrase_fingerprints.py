"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a text into short phrases whose borders
depend on a few neighbouring characters only; phrases are named by their
contents and the names are parsed again, level by level. Equal substrings
therefore get equal names inside, wherever they stand. A fingerprint keeps,
of the names of the middle levels, the smallest of each of 64 bins; the
likeness of two fingerprints estimates the share of phrases in common.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.codepoints import points
from atrium.llm.shingles import U64, mix64, powers
from atrium.scratch import settings

#: Bins of a fingerprint, and hexadecimal digits of each.
BINS, DIGITS = 64, 4
#: Phrases of these levels count (about 3, 9, 27 ... characters); shorter texts count all they have.
LEVELS = (2, 3, 4)
_EMPTY = "." * DIGITS
_CHUNK = 1_000_000
_STEP, _SEED = U64(0xD6E8FEB86659FD93), U64(0x9E3779B97F4A7C15)
_DEBRUIJN = U64(0x03F79D71B4CB0A89)
_LOWEST = np.zeros(64, np.uint8)
for _i in range(64):
    _LOWEST[((1 << _i) * 0x03F79D71B4CB0A89 & (1 << 64) - 1) >> 58] = _i


def _tosses(n: int) -> np.ndarray:
    """The coin toss for all pairs of labels under n: twice the lowest differing bit's place, plus that bit."""
    x = np.arange(n)
    d = x[:, None] ^ x[None, :]
    low = np.where(d > 0, np.log2(np.maximum(d & -d, 1)).astype(int), 0)
    return (2 * low + ((x[:, None] >> low) & 1)).astype(np.uint8)


_SECOND, _THIRD = _tosses(130), _tosses(16)


def borders(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin. Neighbouring names of a text differ; first: where texts begin."""
    before = np.empty_like(names)
    before[0], before[1:] = 0, names[:-1]
    d = names ^ before
    low = _LOWEST[((d & (~d + U64(1))) * _DEBRUIJN) >> U64(58)]
    label = (low * np.uint8(2) + ((names >> low.astype(U64)) & U64(1)).astype(np.uint8)).astype(np.uint8)
    label[first] = 128
    for table, start in ((_SECOND, 14), (_THIRD, 7)):
        new = np.empty_like(label)
        new[0], new[1:] = start, table[label[1:], label[:-1]]
        new[first] = start
        label = new
    start = np.zeros(len(names), bool)
    start[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
    # A phrase has two names at least; where labels tie, the first one starts.
    start[1:] &= ~start[:-1]
    start[first] = True
    after = first[first + 1 < len(names)] + 1
    start[after[~np.isin(after, first)]] = False
    return np.flatnonzero(start)


def _renamed(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    lengths = np.diff(np.append(starts, len(names)))
    values = mix64(names * _SEED + U64(1)) * powers(_STEP, int(lengths.max()))[np.arange(len(names)) - np.repeat(starts, lengths)]
    return mix64(np.add.reduceat(values, starts) + lengths.astype(U64))


def _runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one name become one name; neighbours then differ."""
    start = np.append(True, names[1:] != names[:-1])
    start[first] = True
    if start.all():
        return names, first
    at = np.flatnonzero(start)
    n = np.diff(np.append(at, len(names)))
    new = names[at]
    long = n > 1
    new[long] = mix64(new[long] + n[long].astype(U64) * _SEED)
    return new, np.cumsum(start)[first] - 1


def phrases(texts: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(level, names, owner) for every level of the texts, of which none is empty; owner is each phrase's text."""
    names = points("".join(texts)).astype(U64)
    sizes = np.array([len(t) for t in texts])
    first, owner, level, out = np.cumsum(sizes) - sizes, np.arange(len(texts)), 0, []
    while len(names):
        names, first = _runs(names, first)
        starts = borders(names, first)
        names = _renamed(names, starts)
        first = np.searchsorted(starts, first)
        level += 1
        counts = np.diff(np.append(first, len(names)))
        out.append((level, names, np.repeat(owner, counts)))
        # Texts that are one phrase are done.
        going = counts > 1
        names = names[np.repeat(going, counts)]
        owner, counts = owner[going], counts[going]
        first = np.cumsum(counts) - counts
    return out


def fingerprints(texts: list[str]) -> list[str]:
    """64 bins of 4 hexadecimal digits, or dots for an empty bin; an empty text has empty bins only."""
    bins = np.full((len(texts), BINS), np.iinfo(np.uint64).max, np.uint64)
    some = [i for i, t in enumerate(texts) if t]
    if some:
        levels = phrases([texts[i] for i in some])
        deepest = np.zeros(len(some), int)
        for level, _, owner in levels:
            deepest[owner] = level
        for level, names, owner in levels:
            use = (level in LEVELS) | ((deepest[owner] <= LEVELS[1]) & (level < LEVELS[0]))
            h = mix64(names[np.broadcast_to(use, owner.shape)] ^ U64(level))
            np.minimum.at(bins, (np.array(some)[owner[np.broadcast_to(use, owner.shape)]], (h >> U64(58)).astype(int)), h & U64((1 << 58) - 1))
    out = []
    for row in bins.tolist():
        out.append("".join(_EMPTY if v == 0xFFFFFFFFFFFFFFFF else f"{(v * 0x9E3779B97F4A7C15 >> 32) & 0xFFFF:04x}" for v in row))
    return out


def likeness(a: str, b: str) -> float:
    """Share of bins in which both fingerprints have the same, of those in which either has something; 1 for equal ones."""
    if a == b:
        return 1.0
    same = used = 0
    for i in range(0, BINS * DIGITS, DIGITS):
        x, y = a[i : i + DIGITS], b[i : i + DIGITS]
        if x != _EMPTY or y != _EMPTY:
            used += 1
            same += x == y
    return same / used


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order of bucket, and in it by falling doc_id; a guest is the first row of the next bucket."""
    held: list[tuple] = []
    size = 0
    done: int | None = None

    def finish(rows: list[tuple], last: bool) -> pd.DataFrame:
        pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if a[0] == b[0] and not a[3]]
        out = []
        start = 0
        while start < len(pairs):
            stop, total = start, 0
            while stop < len(pairs) and (stop == start or total + len(pairs[stop][0][2]) + len(pairs[stop][1][2]) <= _CHUNK):
                total += len(pairs[stop][0][2]) + len(pairs[stop][1][2])
                stop += 1
            own = [a[2] for a, _ in pairs[start:stop]]
            edited = [t[: len(t) - len(t) // 2] + b[2][: len(t) // 2] for t, (_, b) in zip(own, pairs[start:stop], strict=True)]
            prints = fingerprints([*own, pairs[stop - 1][1][2], *edited])
            n = len(own)
            # The next row's own print is the following one, except at the end of a bucket inside this part.
            later = [prints[i + 1] if i + 1 == n or pairs[start + i + 1][0] is pairs[start + i][1] else None for i in range(n)]
            missing = [i for i in range(n) if later[i] is None]
            for i, p in zip(missing, fingerprints([pairs[start + i][1][2] for i in missing]), strict=True):
                later[i] = p
            for i, (a, _) in enumerate(pairs[start:stop]):
                digest = hashlib.sha256(edited[i].encode()).hexdigest()
                out.append((a[1], len(a[2]), digest, prints[i], prints[n + 1 + i], likeness(prints[i], prints[n + 1 + i]), likeness(prints[i], later[i])))
            start = stop
        frame = pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    for pdf in frames:
        ids = pdf["doc_id"].astype("Int64")
        for bucket, doc, missing, text, guest in zip(pdf["bucket"], ids, ids.isna(), pdf["text"], pdf["guest"], strict=True):
            # Of several guests of one bucket the first counts.
            if guest and done == bucket:
                continue
            done = bucket if guest else done
            held.append((bucket, None if missing else int(doc), text if isinstance(text, str) else "", guest))
            size += len(held[-1][2])
            if size > 2 * _CHUNK:
                yield finish(held, False)
                held, size = held[-1:], len(held[-1][2])
    if held:
        yield finish(held, True)


def compared(docs: DataFrame, buckets_per_partition: int = 4) -> DataFrame:
    """Fingerprints every text and its edited text, which takes its end from the next document by falling doc_id.

    One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. After the last document comes
    the first; a single one is its own next. Null texts are empty; an empty
    text's fingerprint is like an empty one's only. Null doc_ids come last;
    rows that repeat a doc_id are ordered by the hash of their text. An empty
    table gives an empty result. Other columns are ignored.

    Documents are shuffled once, by ranges of doc_id. The first document of
    each range also goes to the range before it, where it is the next of the
    last one. Tasks stream over their rows.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    parts = docs.rdd.getNumPartitions()
    n = max(8, min(10_000, buckets_per_partition * parts))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", order.alias("_order"), order.cast("double").alias("_at"))
    cuts = keyed.approxQuantile("_at", [i / n for i in range(1, n)], 0.1 / n)
    splits = [-math.inf, *(sorted({*cuts} - {-math.inf, math.inf}) or [0.0]), math.inf]
    placed = Bucketizer(splits=splits, inputCol="_at", outputCol="_b").transform(keyed)
    placed = placed.select("doc_id", "text", "_order", (F.lit(len(splits)) - F.col("_b")).cast("int").alias("bucket"))
    heads = [(r["bucket"], r["head"]) for r in placed.groupBy("bucket").agg(F.max("_order").alias("head")).orderBy("bucket").collect()]
    # At most one row per bucket, of which there are at most 10,000.
    guests = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    small = F.broadcast(spark.createDataFrame(guests, "_order long, to int"))
    own = placed.select("bucket", "doc_id", "_order", "text", F.lit(False).alias("guest"))
    sent = placed.join(small, "_order").select(F.col("to").alias("bucket"), "doc_id", "_order", "text", F.lit(True).alias("guest"))
    rows = own.unionByName(sent).repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), "bucket")
    rows = rows.sortWithinPartitions("bucket", "guest", F.desc("_order"), F.xxhash64("text"))
    return rows.select("bucket", "doc_id", "text", "guest").mapInPandas(_compare, _SCHEMA)
