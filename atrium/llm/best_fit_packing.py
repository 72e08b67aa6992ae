"""Packs documents into as few sequences of bounded length as a swap-based local search finds.

All that packing needs of the corpus is the number of pieces of each length:
at most as many numbers as a sequence has tokens. Bins with the same contents
are one pattern with a count, so the search works on thousands of patterns,
however many documents there are. It starts from best-fit decreasing and then
moves single documents, exchanges one for one or two for one between underfull
patterns as long as the sum of squared fills grows, until no such move is left
or no fewer bins could hold the tokens. Each move is made in as many bins at
once as both patterns have.

Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atrium.llm.byte_bpe import encoder
from atrium.scratch import settings, write_table

LENGTH = 2048
#: Characters that are tokenized together, and salts that split the pieces of one length.
_CHUNK, _SALTS = 1_000_000, 256

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first


def _with(pattern: Pattern, change: dict[int, int]) -> Pattern:
    total = Counter(dict(pattern))
    total.update(change)
    return tuple(sorted(((k, v) for k, v in total.items() if v), reverse=True))


def best_fit(counts: dict[int, int], size: int) -> dict[Pattern, int]:
    """Best-fit decreasing over counts of lengths."""
    room: dict[int, dict[Pattern, int]] = {size: {(): sum(counts.values())}}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for free in sorted(r for r in room if r >= length):
            each = free // length
            for pattern in list(room[free]):
                if not left:
                    break
                have = room[free].pop(pattern)
                for times, bins in ((each, min(have, left // each)), (left % each, 1)):
                    if bins and times and have and left >= times and (times == each or left < each):
                        new = _with(pattern, {length: times})
                        where = room.setdefault(free - times * length, {})
                        where[new] = where.get(new, 0) + bins
                        have, left = have - bins, left - bins * times
                if have:
                    room[free][pattern] = have
            if not left:
                break
    out: dict[Pattern, int] = {}
    for patterns in room.values():
        for p, n in patterns.items():
            if p and n:
                out[p] = out.get(p, 0) + n
    return out


def first_fit(counts: dict[int, int], size: int) -> dict[Pattern, int]:
    """A cheap packing: lengths in the order of a hash, each into the first bins that have room."""
    patterns, free, bins = [], np.zeros(0, "int64"), np.zeros(0, "int64")

    def add(p: Pattern, n: int) -> None:
        nonlocal free, bins
        if len(patterns) == len(free):
            free, bins = (np.concatenate([x, np.zeros(len(x) + 1024, "int64")]) for x in (free, bins))
        free[len(patterns)], bins[len(patterns)] = size - _fill(p), n
        patterns.append(p)

    for length in sorted(counts, key=lambda v: v * 2654435761 % 2**32):
        left = counts[length]
        for i in np.flatnonzero((free >= length) & (bins > 0)).tolist():
            if not left:
                break
            each, have = int(free[i]) // length, int(bins[i])
            full = min(have, left // each)
            rest = min(left - full * each, each) if full < have else 0
            bins[i] -= full + (rest > 0)
            if full:
                add(_with(patterns[i], {length: each}), full)
            if rest:
                add(_with(patterns[i], {length: rest}), 1)
            left -= full * each + rest
        each = size // length
        if left // each:
            add(((length, each),), left // each)
        if left % each:
            add(((length, left % each),), 1)
    out: Counter[Pattern] = Counter()
    for p, n in zip(patterns, bins.tolist(), strict=False):
        out[p] += n
    return {p: n for p, n in out.items() if n}


def _fill(pattern: Pattern) -> int:
    return sum(a * n for a, n in pattern)


def _offers(pattern: Pattern) -> list[tuple[int, int, int, int]]:
    """What can leave a bin together, one document or two: sum, number, lengths. Of equal sums and numbers one is enough."""
    out = {(a, 1): (a, 0) for a, _ in pattern}
    for i, (a, n) in enumerate(pattern):
        out |= {(a + b, 2): (a, b) for b, _ in pattern[i + (n == 1) :]}
    return [(*key, *items) for key, items in out.items()]


class _Search:
    """Underfull patterns by number. A pattern whose bins become more than none, or more than one, gets a new number,
    so a donor that found no taker has to look only at the patterns numbered since."""

    def __init__(self, bins: dict[Pattern, int], size: int):
        self.size = size
        self.full: Counter[Pattern] = Counter()
        self.patterns: list[Pattern] = []
        self.number: dict[Pattern, int] = {}
        self.fills = self.count = np.zeros(0, "int64")
        self.rows = np.zeros((0, 5), "int64")  # pattern's number, what it gives: sum, how many documents, their lengths
        self.used = 0
        self.seen: list[int] = []
        self.queue: list[tuple[int, Pattern, int]] = []
        self.bins, self.tokens = sum(bins.values()), sum(n * _fill(p) for p, n in bins.items())
        for p in sorted(bins):
            self._put(p, bins[p])

    def _put(self, p: Pattern, n: int) -> None:
        if not p or _fill(p) == self.size:
            self.full[p] += n
            self.bins -= 0 if p else n
            return
        old = self.number.get(p)
        if old is not None and self.count[old]:
            if self.count[old] > 1:
                self.count[old] += n
                return
            n += int(self.count[old])
            self.count[old] = 0
        i = self.number[p] = len(self.patterns)
        offers = [(i, 0, 0, 0, 0), *((i, *x) for x in _offers(p))]
        if i == len(self.count):
            self.fills, self.count = (np.concatenate([x, np.zeros(len(x) + 1024, "int64")]) for x in (self.fills, self.count))
        if self.used + len(offers) > len(self.rows):
            self._compact(len(offers))
        self.patterns.append(p)
        self.seen.append(0)
        self.fills[i], self.count[i] = _fill(p), n
        self.rows[self.used : self.used + len(offers)] = offers
        self.used += len(offers)
        heapq.heappush(self.queue, (_fill(p), p, i))

    def _compact(self, more: int) -> None:
        rows = self.rows[: self.used]
        rows = rows[self.count[rows[:, 0]] > 0]
        self.used = len(rows)
        self.rows = np.concatenate([rows, np.zeros((len(rows) + more + 4096, 5), "int64")])

    def run(self, moves: int | None = None) -> dict[Pattern, int]:
        """Moves until none helps or no fewer bins can hold the tokens; the sum of squared fills grows, so this ends."""
        least, stuck, done = -(-self.tokens // self.size), [], 0
        while self.bins > least and (moves is None or done < moves):
            if not self.queue:
                again = [i for i in stuck if self.count[i] and self.seen[i] < len(self.patterns)]
                if not again:
                    break
                self.queue, stuck = sorted((int(self.fills[i]), self.patterns[i], i) for i in again), [i for i in stuck if self.count[i] and self.seen[i] == len(self.patterns)]
            donor = self.queue[0][2]
            if not self.count[donor]:
                heapq.heappop(self.queue)
            elif self._improve(donor):
                done += 1
            else:
                heapq.heappop(self.queue)
                self.seen[donor] = len(self.patterns)
                stuck.append(donor)
        left = Counter({p: int(self.count[i]) for p, i in self.number.items()})
        return {p: n for p, n in (self.full + left).items() if p}

    def _improve(self, donor: int) -> bool:
        """The move that adds most to the sum of squared fills, from bins of this pattern to any not looked at yet."""
        first = int(np.searchsorted(self.rows[: self.used, 0], self.seen[donor]))
        rows = self.rows[first : self.used]
        rows = rows[self.count[rows[:, 0]] > (rows[:, 0] == donor)]
        offers = np.array(sorted(_offers(self.patterns[donor])))
        fills, filled, best, choice = self.fills[rows[:, 0]], self.fills[donor], 0, None
        for part, given in ((rows[:, 2] < 2, offers), (rows[:, 2] == 2, offers[offers[:, 1] == 1])):
            part = np.flatnonzero(part)
            # Where the gain is positive it grows with what is given, so the most that fits is the best.
            back = rows[part, 1]
            at = np.searchsorted(given[:, 0], back + self.size - fills[part], "right") - 1
            more = np.where(at >= 0, given[at, 0] - back, 0)
            gain = np.where(more > 0, more * (fills[part] + more - filled), 0)
            if len(gain) and (top := int(gain.argmax())) >= 0 and gain[top] > best:
                best, choice = gain[top], (given[at[top]], rows[part[top]])
        if choice is None:
            return False
        (_, n, *items), (taker, _, m, *returned) = ([int(x) for x in c] for c in choice)
        change = Counter(returned[:m])
        change.subtract(Counter(items[:n]))
        times = int(self.count[donor]) // 2 if taker == donor else int(min(self.count[donor], self.count[taker]))
        self.count[donor] -= times
        self.count[taker] -= times
        self._put(_with(self.patterns[donor], change), times)
        self._put(_with(self.patterns[taker], {k: -v for k, v in change.items()}), times)
        return True


def pack(counts: dict[int, int], size: int = LENGTH, moves: int | None = None, start=best_fit) -> dict[Pattern, int]:
    """Patterns of bins, with how many bins have each, that hold exactly the given counts of lengths. Without `moves`
    the search goes on until no move helps. From `first_fit` it takes thousands of moves to the same number of bins as
    from best-fit decreasing, so production starts from the latter."""
    return _Search(start({k: v for k, v in counts.items() if v}, size), size).run(moves)


def _pieces(path: str, size: int):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        for pdf in frames:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            rows, start = [], 0
            while start < len(texts):
                stop, total = start, 0
                while stop < len(texts) and (stop == start or total + len(texts[stop]) <= _CHUNK):
                    total += len(texts[stop])
                    stop += 1
                for i, ids in enumerate(encode(texts[start:stop]), start):
                    ids = np.append(ids, np.uint32(0)).astype("<u4")
                    first = len(ids) % size or size
                    edges = [0, *range(first, len(ids) + 1, size)]
                    rows += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
                start = stop
            out = pd.DataFrame(rows, columns=["row", "piece", "start", "length", "ids_crc32"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").array[out.pop("row").to_numpy(int)])
            yield out

    return cut


def ranked(rows: DataFrame, key: str, salts: int = _SALTS) -> DataFrame:
    """Adds rank: 0, 1, ... among the rows of equal key; no task sees more than about 1 / salts of a key's rows."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = rows.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(key, "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    order = Window.partitionBy(key, "_salt").orderBy("doc_id", "piece", "ids_crc32")
    placed = rows.withColumn("_own", F.row_number().over(order) - 1).join(counts, [key, "_salt"])
    return placed.withColumn("rank", F.col("_before") + F.col("_own")).drop("_salt", "_own", "_before")


def places(bins: dict[Pattern, int]) -> pd.DataFrame:
    """Per pattern and length: the ranks of that length from `low`, in sequences from `base`, `times` in each at `offset`."""
    out, next_rank, base = [], Counter(), 0
    for pattern in sorted(bins, reverse=True):
        offset = 0
        for length, times in pattern:
            out.append((length, next_rank[length], base, times, offset))
            next_rank[length] += times * bins[pattern]
            offset += times * length
        base += bins[pattern]
    return pd.DataFrame(out, columns=["length", "low", "base", "times", "offset"], dtype="int64").sort_values(["length", "low"], ignore_index=True)


def packed(docs: DataFrame, tokenizer: str, size: int = LENGTH, moves: int | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and one id 0; one of more than `size`
    ids is cut, its first piece taking the remainder. Very long texts are
    encoded whole, each alone. Pieces that tie in length are ranked by doc_id,
    piece and ids; equal ones are interchangeable. The driver gets one count
    per length, at most `size` of them. Null and empty texts are
    the id 0 alone. Repeated rows and null doc_ids are packed like any others.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        pieces = write_table(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_pieces(tokenizer, size), schema), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = places(pack(counts, size, moves))
    low, table = slots["length"].to_numpy() << 40 | slots["low"].to_numpy(), {k: slots[k].to_numpy() for k in slots}

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(low, length.to_numpy() << 40 | rank.to_numpy(), "right") - 1
        within = rank.to_numpy() - table["low"][at]
        times = table["times"][at]
        return pd.DataFrame({"sequence_id": table["base"][at] + within // times, "offset": table["offset"][at] + within % times * length.to_numpy()})

    out = ranked(pieces, "length").withColumn("place", place("length", "rank"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
