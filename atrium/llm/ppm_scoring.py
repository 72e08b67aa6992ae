"""Code length of texts by prediction by partial matching over bytes, beside a word model.

A text is read as its tokens: words, lower-cased in A-Z, and one end. Written
with one space between words and a line feed as end, these are bytes, and each
byte is predicted from the ORDER bytes before it (before a text stand line
feeds). A context that has seen the byte gives it a share of its counts;
otherwise the model escapes to the context that is one byte shorter, where all
bytes that the longer one has seen are excluded. Of a context with `total`
counts of `kinds` different bytes a byte seen n times gets (2n - 1) / 2 total,
and the escape kinds / 2 total; where bytes are excluded, both are counted
without them.

The trie is a set of tables, one for each depth: grams (a context and the byte
after it, as a number) with their counts in training. A suffix link is a gram
without its first byte, hence a join; a key of those joins and groups has at
most 252 rows, whatever the corpus. Texts meet the trie in chunks of bounded
size. A chunk's distinct grams and words, in order, are cut at the ends of the
sorted tables' blocks and travel to them packed; their scores come back packed
in the same order. So a gram costs two or three bytes a chunk however often it
occurs there, no task holds more than one block and one request, and nothing
is broadcast but the blocks' first entries.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.scratch import delete, settings, write_table, written

#: Bytes of context, 5 at most.
ORDER = 5
#: Bytes of text and pieces of documents in a chunk, and entries of a table in a block.
CHUNK, PIECES, BLOCK = 5_000_000, 1 << 16, 1 << 16
#: Chunks that one copy of a block answers; with more of them a block is copied, so that no task's input grows with the corpus.
ANSWERED = 256
#: Bytes that a normalised text may hold: all but the separators other than space and line feed.
ALPHABET = 256 - 4
_SEPARATORS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_CHUNKS = "chunk long, data binary, sizes array<int>, keys array<long>, docs array<long>, held array<boolean>, grams binary, gram_counts binary, words binary, word_counts binary"
_GRAM, _WORD = 0, 1
#: Behind all grams, of at most 48 bits and a piece; occurrences that are summed at once.
_NO_GRAM, _SLAB = np.uint64(2**64 - 1), 1 << 20
#: A written table cuts lineage, so the shuffle files of its query go when that query ends, not when the driver next collects garbage.
_CLEAN = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}


def segments(raw: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """raw in parts of about size bytes, none of which ends within a word."""
    start = 0
    while len(raw) - start > size:
        cut = max(raw.rfind(s, start, start + size) for s in _SEPARATORS)
        if cut <= start:
            cut = min((at for s in _SEPARATORS if (at := raw.find(s, start + size)) >= 0), default=len(raw))
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def normalised(text: str | None, size: int = CHUNK) -> Iterator[bytes]:
    """The pieces of a text's normal form; the last one, and no other, ends with a line feed."""
    held: bytes | None = None
    for part in segments((text or "").encode("utf-8", "replace").lower(), size):
        if words := part.split():
            if held is not None:
                yield held + b" "
            held = b" ".join(words)
    yield (held or b"") + b"\n"


def tokens(piece: bytes) -> list[bytes]:
    """The words of a piece, and the end (an empty word) if it has it."""
    return piece.split() + ([b""] if piece.endswith(b"\n") else [])


def packed(values: np.ndarray) -> bytes:
    """Numbers in few bytes; sorted ones are stored by their steps."""
    return zlib.compress(values.tobytes(), 1)


def steps(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.int64(0)))


def _unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _unstepped(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _joined(words: list[bytes]) -> bytes:
    """No word holds a line feed."""
    return zlib.compress(b"\n".join(words), 1)


def _split(data: bytes) -> list[bytes]:
    return zlib.decompress(data).split(b"\n")


class Chunk:
    """Pieces of documents with the bytes before each."""

    def __init__(self, order: int):
        self.order, self.bytes = order, 0
        self.pieces: list[bytes] = []
        self.heads: list[bytes] = []
        self.keys: list[int] = []
        self.docs: list[int | None] = []
        self.held: list[bool] = []

    def add(self, key: int, doc: int | None, held: bool, head: bytes, piece: bytes) -> None:
        self.keys.append(key)
        self.docs.append(doc)
        self.held.append(held)
        self.heads.append(head)
        self.pieces.append(piece)
        self.bytes += len(piece)

    def _stream(self) -> bytes:
        return b"".join(x for pair in zip(self.heads, self.pieces, strict=True) for x in pair)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct grams in order, where each begins in the third, and the piece of each occurrence."""
        sizes = np.array([len(p) for p in self.pieces])
        a = np.frombuffer(self._stream(), np.uint8)
        n = len(a) - self.order
        code = a[:n].astype(np.uint64)
        for j in range(1, self.order + 1):
            code <<= np.uint64(8)
            code |= a[j : n + j]
        code <<= np.uint64(16)
        np.bitwise_or(code, np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes + self.order)[:n], out=code)
        # Grams that end in a head are none, so they go to the end; a piece's first gram starts at its head.
        begin = np.cumsum(sizes + self.order) - sizes - self.order
        for j in range(1, self.order + 1):
            code[begin[1:] - j] = _NO_GRAM
        code.sort()
        code = code[: sizes.sum()]
        piece = code.astype(np.uint16)
        code >>= np.uint64(16)
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        return code[first].astype(np.int64), first, piece

    def row(self, number: int) -> pd.DataFrame:
        """The chunk's text, and its distinct grams and words with their counts in training."""
        grams, first, piece = self.grams()
        n = np.add.reduceat(~np.array(self.held)[piece], first, dtype=np.int64)
        del piece, first
        counts: Counter[bytes] = Counter()
        others: set[bytes] = set()
        for p, held in zip(self.pieces, self.held, strict=True):
            (others if held else counts).update(tokens(p))
        words = sorted(others.union(counts))
        docs = pd.Series([self.docs], dtype=object)
        return pd.DataFrame(
            {"chunk": [number], "data": [zlib.compress(self._stream(), 1)], "sizes": [[len(p) for p in self.pieces]], "keys": [self.keys], "docs": docs, "held": [self.held]}
            | {"grams": [steps(grams)], "gram_counts": [packed(n)], "words": [_joined(words)], "word_counts": [packed(np.array([counts[w] for w in words]))]}
        )

    @classmethod
    def read(cls, order: int, row: pd.Series) -> Chunk:
        out, at, data = cls(order), 0, zlib.decompress(row["data"])
        for size, key, doc, held in zip(row["sizes"], row["keys"], row["docs"], row["held"], strict=True):
            out.add(int(key), None if pd.isna(doc) else int(doc), bool(held), data[at : at + order], data[at + order : at + order + size])
            at += order + int(size)
        return out

    def totals(self, scores: np.ndarray, words: list[bytes], counts: np.ndarray, log_total: float) -> pd.DataFrame:
        """For each piece its tokens, known tokens, and both scores, of its grams' scores and its words' counts."""
        _, first, piece = self.grams()
        each = np.repeat(scores, np.diff(np.append(first, len(piece))))
        score = np.zeros(len(self.pieces))
        for s in range(0, len(piece), _SLAB):
            score += np.bincount(piece[s : s + _SLAB], each[s : s + _SLAB], len(self.pieces))
        del piece, first, each
        index = dict(zip(words, range(len(words)), strict=True))
        logs = np.log10(counts + 1.0) - log_total
        out = []
        for p in self.pieces:
            found = tokens(p)
            at = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
            out.append((len(found), int((counts[at] > 0).sum()), float(logs[at].sum())))
        n_tokens, n_known, base = zip(*out, strict=True)
        docs = pd.Series(self.docs, dtype="Int64")
        return pd.DataFrame({"key": self.keys, "doc_id": docs, "held_out": self.held, "n_tokens": n_tokens, "n_known": n_known, "base_score": base, "score": score})


def _gather(order: int, size: int):
    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition = TaskContext.get().partitionId() << 33
        chunk, number, key = Chunk(order), partition, partition
        for pdf in frames:
            for doc, text, held in zip(pdf["doc_id"], pdf["text"], pdf["held_out"], strict=True):
                head = b"\n" * order
                for piece in normalised(text, size):
                    if chunk.pieces and (chunk.bytes + len(piece) > size or len(chunk.pieces) == PIECES):
                        yield chunk.row(number)
                        number, chunk = number + 1, Chunk(order)
                    chunk.add(key, None if pd.isna(doc) else int(doc), held, head, piece)
                    head = (head + piece)[-order:]
                key += 1
        if chunk.pieces:
            yield chunk.row(number)

    return gathered


def _gram_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for grams, n in zip(pdf["grams"], pdf["gram_counts"], strict=True):
            yield pd.DataFrame({"gram": _unstepped(grams), "n": _unpacked(n)})


def _word_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for words, n in zip(pdf["words"], pdf["word_counts"], strict=True):
            yield pd.DataFrame({"word": _split(words), "n": _unpacked(n)})


def _blocked(kind: int):
    """Sorted rows (key, value) of a partition as blocks."""

    def blocked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            keys = pdf.iloc[:, 0]
            for s in range(0, len(pdf), BLOCK):
                part, values = keys.iloc[s : s + BLOCK], pdf.iloc[s : s + BLOCK, 1].to_numpy()
                if kind == _GRAM:
                    yield pd.DataFrame({"first": [int(part.iloc[0]).to_bytes(8, "big")], "asked": [steps(part.to_numpy())], "told": [packed(values)]})
                else:
                    words = [bytes(w) for w in part]
                    yield pd.DataFrame({"first": [words[0]], "asked": [_joined(words)], "told": [packed(values)]})

    return blocked


def _requests(firsts: dict[int, list[bytes]]):
    """Cuts each chunk's grams and words at the blocks' first entries."""
    grams = np.array([int.from_bytes(f, "big") for f in firsts[_GRAM]], np.int64)

    def requests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for chunk, g, w in zip(pdf["chunk"], pdf["grams"], pdf["words"], strict=True):
                out = []
                own = _unstepped(g)
                cuts = [*np.searchsorted(own, grams), len(own)]
                out += [(_GRAM, i, steps(own[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                words = _split(w)
                cuts = [*(bisect_left(words, f) for f in firsts[_WORD]), len(words)]
                out += [(_WORD, i, _joined(words[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                kind, block, asked = zip(*out, strict=True)
                yield pd.DataFrame({"kind": kind, "block": block, "chunk": chunk, "asked": asked, "told": None})

    return requests


def _answers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by kind, block, copy and chunk; the block itself, with chunk -1, comes first."""
    keys, values = None, np.zeros(0)
    for pdf in frames:
        told = []
        for kind, chunk, asked, told_here in zip(pdf["kind"], pdf["chunk"], pdf["asked"], pdf["told"], strict=True):
            if chunk < 0:
                keys = _unstepped(asked) if kind == _GRAM else {w: i for i, w in enumerate(_split(asked))}
                values = _unpacked(told_here, np.float64 if kind == _GRAM else np.int64)
                told.append(None)
            elif kind == _GRAM:
                told.append(zlib.compress(values[np.searchsorted(keys, _unstepped(asked))].astype(np.float32).tobytes(), 1))
            else:
                told.append(packed(values[[keys[w] for w in _split(asked)]]))
        pdf = pdf.assign(told=told)[pdf["chunk"] >= 0]
        yield pdf[["chunk", "kind", "block", "told"]]


def trie_scores(grams: DataFrame, order: int = ORDER) -> tuple[DataFrame, list[str]]:
    """log10 of the probability of each gram's last byte after the bytes before it: gram, score. Then the places of its tables.

    grams has distinct grams of order + 1 bytes and n, their counts in
    training, 0 for those that only want a score.
    """
    places: list[str] = []

    def write_table(df: DataFrame, name: str) -> DataFrame:
        df, place = written(df, name)
        places.append(place)
        return df

    depths = [grams.select("gram", "n")]
    for k in range(order, 0, -1):
        depths.append(write_table(depths[-1].groupBy((F.col("gram") % 256**k).alias("gram")).agg(F.sum("n").alias("n")), f"depth{k - 1}"))
    depths.reverse()
    seen = F.col("n") > 0
    context = F.floor(F.col("gram") / 256).cast("long")
    share = lambda n, total: F.log10((2 * F.col(n) - 1) / (2 * F.col(total)))
    escape = lambda kinds, total: F.log10(F.col(kinds) / (2 * F.col(total)))

    contexts = depths[0].where(seen).groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    level = depths[0].join(contexts, context == F.col("context"), "left")
    below = F.when(~seen & (F.coalesce("kinds", F.lit(0)) < ALPHABET), -F.log10(ALPHABET - F.coalesce("kinds", F.lit(0))))
    level = level.withColumn("below", below).withColumn("score", F.when(F.col("total").isNull(), F.col("below")).when(seen, share("n", "total")).otherwise(escape("kinds", "total") + F.col("below")))
    level = write_table(level.select("gram", "n", "below", "score"), "level0")
    contexts = contexts.select("context", "total", "kinds")
    for k in range(1, order + 1):
        lower = level.select(F.col("gram").alias("suffix"), F.col("n").alias("m"), F.col("below").alias("lower_below"), F.col("score").alias("lower_score"))
        linked = depths[k].join(lower, F.col("gram") % 256**k == F.col("suffix"))
        own = linked.where(seen).groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("inner"))
        shorter = contexts.select(F.col("context").alias("shorter"), F.col("total").alias("shorter_total"), F.col("kinds").alias("shorter_kinds"))
        own = own.join(shorter, F.col("context") % 256 ** (k - 1) == F.col("shorter"))
        # What the shorter context has left once the bytes that the longer one has seen are excluded.
        own = own.select("context", "total", "kinds", (F.col("shorter_kinds") - F.col("kinds")).alias("fresh"), (F.col("shorter_total") - F.col("inner")).alias("room"))
        contexts = write_table(own, f"contexts{k}")
        rows = linked.join(contexts, context == F.col("context"), "left")
        escaped = F.when(F.col("m") > 0, share("m", "room")).when(F.col("fresh") > 0, escape("fresh", "room") + F.col("lower_below")).otherwise(F.col("lower_below"))
        rows = rows.withColumn("below", F.when(~seen & F.col("total").isNotNull(), escaped))
        rows = rows.withColumn("score", F.when(F.col("total").isNull(), F.col("lower_score")).when(seen, share("n", "total")).otherwise(escape("kinds", "total") + F.col("below")))
        # A context that training has not seen passes on what its suffix says.
        rows = rows.withColumn("below", F.when(F.col("total").isNull(), F.col("lower_below")).otherwise(F.col("below")))
        level = rows.select("gram", "score") if k == order else write_table(rows.select("gram", "n", "below", "score"), f"level{k}")
    return write_table(level, f"level{order}"), places


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _told(rows: DataFrame, order: int, chunk: int, answered: int) -> tuple[DataFrame, str, DataFrame, int, float]:
    """The chunks and their place, what the tables tell each, and the words' total and the logarithm of its denominator."""
    spark = rows.sparkSession
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=500, spark__sql__parquet__compression__codec="zstd"):
        chunks, path = written(rows.mapInPandas(_gather(order, chunk), _CHUNKS), "lm-chunks")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=1):
        grams = chunks.select("grams", "gram_counts").mapInPandas(_gram_rows, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        words = chunks.select("words", "word_counts").mapInPandas(_word_rows, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        (grams, gram_place), (words, word_place) = written(grams, "lm-grams"), written(words, "lm-words")
    train_tokens, kinds = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log_total = math.log10(train_tokens + kinds + 1)

    blocks, firsts, block_places = None, {}, []
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=BLOCK):
        scores, places = trie_scores(grams, order)
        delete(spark, gram_place)
        for kind, table, key in ((_GRAM, scores, "gram"), (_WORD, words, "word")):
            size = max(1, -(-table.count() // BLOCK))
            cut = table.repartitionByRange(size, key).sortWithinPartitions(key).mapInPandas(_blocked(kind), "first binary, asked binary, told binary")
            cut, place = written(cut, "lm-blocks")
            block_places.append(place)
            firsts[kind] = sorted(bytes(r["first"]) for r in cut.select("first").collect())
            number = spark.createDataFrame(list(zip(firsts[kind], range(len(firsts[kind])), strict=True)), "first binary, block int")
            cut = cut.join(number, "first").select(F.lit(kind).alias("kind"), "block", F.lit(-1).cast("long").alias("chunk"), "asked", "told")
            blocks = cut if blocks is None else blocks.unionByName(cut)
    delete(spark, word_place, *places)

    copies = max(1, -(-chunks.count() // answered))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=4):
        asked = chunks.select("chunk", "grams", "words").mapInPandas(_requests(firsts), "kind int, block int, chunk long, asked binary, told binary")
        asked = asked.withColumn("copy", F.pmod(F.xxhash64("chunk"), F.lit(copies)).cast("int"))
        asked = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).unionByName(asked)
        asked = asked.repartition("kind", "block", "copy").sortWithinPartitions("kind", "block", "copy", "chunk")
        told = write_table(asked.mapInPandas(_answers, "chunk long, kind int, block int, told binary"), "lm-told")
    delete(spark, *block_places)
    return chunks, path, told, train_tokens, log_total


def scored(docs: DataFrame, order: int = ORDER, chunk: int = CHUNK, answered: int = ANSWERED) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Both models learn from all rows that are not held out. base_score adds
    log10 of (c + 1) / (N + V + 1) over the tokens; score is log10 of the
    probability that the byte model gives to the text's tokens. Null texts are
    empty: their only token is the end. Texts of any length are read whole, in
    pieces that end with a word. Equal rows are scored alike and each counts in
    training. A null doc_id is not held out. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    if not 1 <= order <= 5:
        raise ValueError("order must be 1 to 5")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out("doc_id").alias("held_out"))
    with settings(spark, **_CLEAN):
        chunks, path, told, train_tokens, log_total = _told(rows, order, chunk, answered)

    def total(text: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row, answers = text.iloc[0], answers.sort_values("block")
        gram, word = ([_unpacked(t, kind) for t in answers["told"][answers["kind"] == k]] for k, kind in ((_GRAM, np.float32), (_WORD, np.int64)))
        return Chunk.read(order, row).totals(np.concatenate(gram), _split(row["words"]), np.concatenate(word), log_total)

    # Read again, else the two sides of the cogroup share their columns.
    texts = spark.read.schema(chunks.schema).parquet(path).select("chunk", "data", "sizes", "keys", "docs", "held", "words")
    schema = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    pieces = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(total, schema)
    sums = pieces.groupBy("key").agg(*[F.first(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
