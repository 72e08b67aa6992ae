"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Circulant MinHash (Li and Li, 2021) needs two permutations only: the first
scatters the shingles over the universe, the second is shifted circularly by
k to give the signature's coordinate k. Here the universe is the 32-bit
integers and both permutations are invertible multiply-shift mixes.

The plan:

1. One scan gives each document its set's size, a 128-bit name of the set and
   its band codes. Documents with equal sets are linked through their smallest
   doc_id, which alone goes on (a group of copies costs one representative).
2. Representatives that share a band code with others are compared with the
   smallest doc_id of that bucket, in blocks of bounded size.
3. Where a bucket still has more than one component, every member outside the
   first one's component is compared with all other members, block by block,
   so no link within a bucket is lost. Members known to be connected already
   are not compared again.
4. Components of the confirmed links are found by star contraction.

All pairs of a group are never emitted: blocks emit a spanning set of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.shingles import as_bytes, chunks, linked, mix64, shingle_sets
from atrium.llm.skew import hot_keys, lookup, spread_join
from atrium.operators.components import connected_components
from atrium.scratch import settings, write_table

#: 25 bands of 5 rows: a pair at Jaccard 0.8 shares no band with probability 5e-5.
BANDS, ROWS = 25, 5
#: Most documents of one side of a comparison block.
BLOCK = 256
_U32 = np.uint32


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The circulant MinHash of a non-empty set of 64-bit shingle hashes."""
    first = (shingles >> np.uint64(32)).astype(_U32)
    h = first[None, :] + np.arange(coordinates, dtype=_U32)[:, None]
    h *= _U32(0x9E3779B1)
    h ^= h >> _U32(15)
    h *= _U32(0x85EBCA77)
    h ^= h >> _U32(13)
    h *= _U32(0xC2B2AE3D)
    return h.min(axis=1)


def band_codes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature(shingles, bands * rows).reshape(bands, rows).astype(np.uint64)
    code = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        code = mix64(code * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return code.view(np.int64)


def _sketcher(k: int, bands: int, rows: int):
    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = as_bytes(pdf["text"])
            for start, stop in chunks(texts):
                sets = shingle_sets(texts[start:stop], k)
                names = [(int(mix64(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix64(s ^ np.uint64(len(s)))))) if len(s) else (0, 0) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": pdf["doc_id"].iloc[start:stop].astype("Int64").array,
                        "n_shingles": [len(s) for s in sets],
                        "name1": np.array([a for a, _ in names], np.uint64).view(np.int64),
                        "name2": np.array([b for _, b in names], np.uint64).view(np.int64),
                        "bands": [band_codes(s, bands, rows) if len(s) else None for s in sets],
                    }
                )

    return sketch


def _comparer(k: int, percent: int):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        """One block: rows with left set against all others; gives links that connect what belongs together."""
        ids, left = pdf["doc_id"].to_numpy(), pdf["left"].to_numpy()
        texts, sets = as_bytes(pdf["text"]), []
        for start, stop in chunks(texts):
            sets += shingle_sets(texts[start:stop], k)
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        known, out = pdf["component"].to_numpy(), []
        for i in np.flatnonzero(left):
            for j in range(len(ids)):
                if ids[i] == ids[j] or (left[j] and j <= i):
                    continue
                a, b = find(known[i]), find(known[j])
                if a != b and linked(sets[i], sets[j], percent):
                    parent[a] = b
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return compare


def _links(tasks: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """tasks: (task struct, left, doc_id, component). The head of a large bucket is in many tasks, so its text is copied."""
    tasks = write_table(tasks, "tasks")
    rows = spread_join(tasks, texts, "doc_id", "task", hot_keys(tasks.groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id"))
    with settings(rows.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=1000):
        return write_table(rows.groupBy("task").applyInPandas(_comparer(k, percent), "a long, b long"), "links")


def _blocks(n, size: int = BLOCK):
    return F.ceil(n / F.lit(size)).cast("int")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    docs needs doc_id (long) and text; other columns are ignored, whatever
    their names. Two documents are linked if 100 * intersection >= percent *
    union of their sets of word shingles, confirmed on the full sets.

    Null, empty and blank texts have an empty set and link with nothing. Very
    long texts are hashed whole, in one piece each. Rows that repeat a doc_id are one node: they share the component of any of
    them. A row without doc_id has no component (null) and is kept. An empty
    table gives an empty result. Ties need no rule: components are sets and
    carry their smallest doc_id.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        sketches = write_table(
            docs.mapInPandas(_sketcher(shingle, bands, rows), "doc_id long, n_shingles long, name1 long, name2 long, bands array<long>"),
            "sketches",
        )
    named = sketches.where("doc_id is not null and n_shingles > 0")
    keys = ["name1", "name2", "n_shingles"]
    # Equal sets have equal bands, so any row's bands do.
    classes = write_table(named.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.any_value("bands").alias("bands")), "classes")
    shared = classes.where("n > 1").select(*keys, "rep")
    copies = named.select("doc_id", *keys).join(shared, keys).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    members = write_table(classes.select(F.explode("bands").alias("code"), F.col("rep").alias("doc_id")), "members")
    buckets = write_table(
        members.groupBy("code").agg(F.min("doc_id").alias("head"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("name")).where("n > 1"), "buckets"
    )
    # Bands of near-identical documents repeat the same bucket: one of each is enough.
    buckets = write_table(buckets.groupBy("head", "n", "name").agg(F.min("code").alias("code")), "buckets")
    hot = hot_keys(buckets.select("code", "n"), "code")
    inside = write_table(lookup(members, buckets.select("code", "head"), "code", hot), "inside")
    # By shuffle at every size: the candidates grow with the corpus.
    texts = write_table(docs.join(inside.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), "texts")

    pairs = inside.where("doc_id <> head").select("head", "doc_id").distinct()
    pairs = write_table(pairs, "pairs")
    sizes = write_table(pairs.groupBy("head").agg(F.count("*").alias("n")), "sizes")
    heads = sizes.select("head", _blocks(F.col("n")).alias("blocks"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    tasks = (
        lookup(pairs, heads, "head", hot_keys(sizes, "head")).select(F.struct("head", part.alias("part")).alias("task"), F.lit(False).alias("left"), "doc_id", F.col("doc_id").alias("component"))
    ).unionByName(
        heads.select(
            F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.col("head"), i.alias("part")))).alias("task"),
            F.lit(True).alias("left"),
            F.col("head").alias("doc_id"),
            F.col("head").alias("component"),
        )
    )
    edges = write_table(copies.unionByName(_links(tasks, texts, shingle, percent)), "edges")
    found = write_table(connected_components(edges), "components")

    # What the first round left apart within a bucket.
    where = F.coalesce("component", "doc_id").alias("component")
    labelled = write_table(inside.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("code", "doc_id", "head", where), "labelled")
    first = labelled.where("doc_id = head").select("code", F.col("component").alias("main"))
    apart = lookup(labelled, first, "code", hot).withColumn("left", F.col("component") != F.col("main"))
    counts = apart.groupBy("code").agg(F.sum(F.col("left").cast("int")).alias("lefts"), F.count("*").alias("n"))
    counts = write_table(counts.where("lefts > 0 and n > 2").select("code", _blocks(F.col("lefts")).alias("lb"), _blocks(F.col("n")).alias("rb")), "counts")
    apart = write_table(lookup(apart.where("doc_id <> head"), counts, "code", hot), "apart")
    hashed = F.xxhash64("doc_id")
    other = lambda n, own, side: F.explode(
        F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda i: F.struct(F.col("code"), *((own.alias("l"), i.alias("r")) if side else (i.alias("l"), own.alias("r")))))
    )
    own_l, own_r = F.pmod(hashed, F.col("lb")).cast("int"), F.pmod(hashed, F.col("rb")).cast("int")
    rest = (
        apart.where("left").select(other("rb", own_l, True).alias("task"), F.lit(True).alias("left"), "doc_id", "component")
    ).unionByName(apart.select(other("lb", own_r, False).alias("task"), F.lit(False).alias("left"), "doc_id", "component"))
    if counts.take(1):
        more = _links(rest, texts, shingle, percent)
        if more.take(1):
            found = connected_components(edges.unionByName(more))
    out = sketches.select("doc_id", "n_shingles").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id")).drop("component")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
