"""The trie of tables against a plain model that follows one text byte by byte."""

import math
import os
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from atrium.llm.ppm_scoring import ALPHABET, Chunk, normalised, scored, segments, tokens
from atrium.scratch import shared_dir

SEPARATORS = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return SEPARATORS.findall(low)


def plain(rows, order):
    """rows: doc_id, text. The result as a list of tuples, by loops over dicts."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    streams = [b"\n" * order + " ".join(words(t)).encode() + b"\n" for _, t in rows]
    after = defaultdict(Counter)
    unigrams = Counter()
    for (_, text), stream, h in zip(rows, streams, held, strict=True):
        if not h:
            unigrams.update([*words(text), None])
            for i in range(order, len(stream)):
                for k in range(order + 1):
                    after[stream[i - k : i]][stream[i]] += 1
    n, v = sum(unigrams.values()), len(unigrams)

    def log(context, byte):
        excluded, p = set(), 1.0
        while True:
            left = {b: c for b, c in after[context].items() if b not in excluded}
            if left:
                total = 2 * sum(left.values())
                if byte in left:
                    return math.log10(p * (2 * left[byte] - 1) / total)
                p *= len(left) / total
                excluded |= set(left)
            if not context:
                return math.log10(p / (ALPHABET - len(excluded)))
            context = context[1:]

    out = []
    for (doc, text), stream, h in zip(rows, streams, held, strict=True):
        own = [*words(text), None]
        base = sum(math.log10((unigrams[w] + 1) / (n + v + 1)) for w in own)
        score = sum(log(stream[i - order : i], stream[i]) for i in range(order, len(stream)))
        out.append((doc, h, len(own), sum(unigrams[w] > 0 for w in own), n, base, score))
    return out


def same(got, want):
    got = sorted((tuple(r) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-7)


@pytest.mark.parametrize("order", [1, 3, 5])
def test_against_loops(spark, docs, order):
    some = docs.where("doc_id < 60").select("doc_id", "text")
    same(scored(some.repartition(3), order).collect(), plain([tuple(r) for r in some.collect()], order))


def test_odd_rows_in_small_chunks(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want = plain(rows, 2)
    same(scored(odd_docs, 2).collect(), want)
    same(scored(odd_docs, 2, chunk=500).collect(), want)
    same(scored(odd_docs, 2, chunk=500, answered=3).collect(), want)


def test_nothing_to_learn_from(spark, no_docs):
    assert scored(no_docs).columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert scored(no_docs).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = scored(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (2, 0, 0, 0.0)
    assert row.score == pytest.approx(-3 * math.log10(ALPHABET))


def test_model_learns_what_it_scores(docs):
    trained = scored(docs).where("not held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert trained[1] > trained[0]


def test_pieces_hold_every_word():
    text = "Ab  c\t\n" + "x" * 50 + " é f g "
    for size in (1, 3, 10, 1000):
        pieces = list(normalised(text, size))
        assert b"".join(pieces).decode() == " ".join(words(text)) + "\n"
        assert [w for p in pieces for w in tokens(p)] == [*(w.encode() for w in words(text)), b""]
        assert b"".join(segments(text.encode(), size)) == text.encode()
    assert list(normalised(None)) == list(normalised(" \n")) == [b"\n"]


def test_disk_holds_only_what_is_still_read(spark, odd_docs):
    def tables():
        place = f"{shared_dir(spark)}/_atrium_tmp".removeprefix("file://")
        return set(os.listdir(place)) if os.path.isdir(place) else set()

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {os.path.basename(f) for f in files.split() if "/shuffle_" in f}

    tables_before, before = tables(), shuffled()
    got = scored(odd_docs, 2)
    assert sorted(t.rpartition("-")[0] for t in tables() - tables_before) == ["lm-chunks", "lm-told"]
    deadline = time.time() + 20  # Spark deletes behind the query's end
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    same(got.collect(), plain([tuple(r) for r in odd_docs.select("doc_id", "text").collect()], 2))


def test_a_chunk_takes_few_bytes_for_each_of_its_own():
    chunk = Chunk(5)
    for i in range(200):
        chunk.add(i, i, False, b"\n" * 5, b" ".join(b"word%d" % (j * i % 997) for j in range(700)) + b"\n")
    tracemalloc.start()
    grams, first, piece = chunk.grams()
    assert tracemalloc.get_traced_memory()[1] < 16 * chunk.bytes
    tracemalloc.stop()
    assert len(piece) == chunk.bytes and len(grams) == len(first) == len(set(grams.tolist()))
