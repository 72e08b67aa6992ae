"""Near-duplicate vectors by p-stable hashing for the Euclidean distance, and exact cosine checks.

Vectors are brought to length 1, where a cosine of at least c is a distance of
at most sqrt(2 - 2c). Each table concatenates several quantised random
projections; vectors of one label that share a table's code are compared.
Equal vectors count once, with their number. Large buckets are compared in
pairs of bounded blocks. Of each block only counts and a spanning set of
links leave the task, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.shingles import mix64
from atrium.llm.skew import hot_keys, lookup, spread_join
from atrium.operators.components import connected_components
from atrium.scratch import settings, write_table

#: At cosine 0.93 a pair meets in one of 20 tables of 8 projections with probability 0.998, at 0.95 with 0.9997.
TABLES, PROJECTIONS, WIDTH = 20, 8, 2.0
#: Most vectors on one side of a comparison.
BLOCK = 512
_SEED = 20240229


def codes(unit: np.ndarray, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> np.ndarray:
    """The code of each vector in each table."""
    rng = np.random.default_rng([_SEED, unit.shape[1]])
    planes = rng.standard_normal((unit.shape[1], tables * projections))
    shift = rng.uniform(0, width, tables * projections)
    cells = np.floor((unit @ planes + shift) / width).astype(np.int64).view(np.uint64).reshape(len(unit), tables, projections)
    out = np.full((len(unit), tables), np.uint64(unit.shape[1]))
    for j in range(projections):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, j])
    return out.view(np.int64)


def _units(series: pd.Series) -> list[np.ndarray | None]:
    """Vectors at length 1 in double precision; None where one is null, zero or has a null or non-finite component."""
    out = []
    for v in series:
        x = None if v is None else np.array([np.nan if y is None else y for y in v] if getattr(v, "dtype", object) == object else v, np.float64)
        if x is not None and len(x) and np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
            x = x / top  # neither overflows nor vanishes when squared
            out.append(x / np.sqrt((x * x).sum()))
        else:
            out.append(None)
    return out


def _coder(tables: int, projections: int, width: float):
    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            units = _units(pdf["embedding"])
            found: list = [None] * len(units)
            for size in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
                for i, c in zip(at, codes(np.stack([units[i] for i in at]), tables, projections, width), strict=True):
                    found[i] = c
            ok = [f is not None for f in found]
            out = pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "codes": found, "weight": pdf["weight"]})[ok]
            # 32 bits of each code tell in which table two vectors of one bucket meet first; the vector itself follows.
            short = [f.view(np.uint64).astype(np.uint32).tobytes() for f in found if f is not None]
            out["data"] = [c + u.tobytes() for c, u in zip(short, [u for u in units if u is not None], strict=True)]
            yield out

    return code


def _compare_rows(rows: pd.DataFrame, threshold: float, tables: int) -> pd.DataFrame | None:
    """One block, or two: counts the links that meet in no earlier table, and names a smaller one that each is connected to."""
    side = rows["side"].to_numpy()
    ids, weight, table = rows["vec_id"].to_numpy(), rows["weight"].to_numpy(), int(rows["table"].iloc[0])
    both = bool((side == 2).all())  # one block with itself
    data = np.frombuffer(b"".join(rows["data"]), np.uint8).reshape(len(rows), -1)
    code, units = data[:, : 4 * tables].copy().view(np.uint32), data[:, 4 * tables :].copy().view(np.float64)
    left = np.arange(len(rows)) if both else np.flatnonzero(side == 0)
    right = left if both else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return None
    a, b = np.nonzero(units[left] @ units[right].T >= threshold - 1e-9)
    a, b = left[a], right[b]
    keep = ids[a] != ids[b]
    a, b = a[keep], b[keep]
    if not len(a):
        return None
    # The product above sums in any order; what is near the limit is summed again as a plain dot product.
    exact = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
    a, b = a[exact], b[exact]
    if not len(a):
        return None
    fresh = ~(code[a, :table] == code[b, :table]).any(1)
    n, least = np.zeros(len(rows), np.int64), ids.copy()
    np.add.at(n, a[fresh], weight[b[fresh]])
    if not both:
        np.add.at(n, b[fresh], weight[a[fresh]])
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        np.minimum.at(least, b, before[a])
        if (before == least).all():
            break
    use = (n > 0) | (least != ids)
    return pd.DataFrame({"vec_id": ids[use], "links": n[use], "peer": least[use]})


def _comparer(threshold: float, tables: int):
    columns = ["vec_id", "links", "peer"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by task, and a task has at most two blocks."""
        held: pd.DataFrame | None = None
        for pdf in frames:
            rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = rows["task"].iloc[-1]
            done, held = rows[rows["task"] != last], rows[rows["task"] == last]
            out = [r for _, g in done.groupby("task", sort=False) if len(g) > 1 and (r := _compare_rows(g, threshold, tables)) is not None]
            if out:
                yield pd.concat(out, ignore_index=True)
        if held is not None and len(held) > 1 and (r := _compare_rows(held, threshold, tables)) is not None:
            yield r
        yield pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    vectors needs vec_id, label and embedding; other columns are ignored.
    Vectors of equal, non-null label and equal length are linked if their
    cosine in double precision is at least the threshold. Vectors that are
    null, empty, zero or hold a null or non-finite component link with
    nothing. Rows that repeat a vec_id are one node. A row without vec_id
    links with nothing, has no component (null) and is kept. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    usable = vectors.where("vec_id is not null and label is not null and embedding is not null")
    # Equal vectors: the smallest vec_id stands for all, with their number.
    usable = usable.withColumn("name", F.xxhash64("embedding"))
    classes = write_table(usable.groupBy("label", "name", "embedding").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("weight")), "classes")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=5000):
        coded = classes.select(F.col("rep").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding", "weight")
        schema = "vec_id long, label string, codes array<long>, weight long, data binary"
        coded = write_table(coded.mapInPandas(_coder(tables, projections, width), schema), "coded")
    keys = ["label", "table", "code"]
    members = coded.select("vec_id", "label", F.posexplode("codes").alias("table", "code")).withColumn("bucket", F.xxhash64(*keys, F.lit(0)))
    name = F.bit_xor(F.xxhash64("vec_id")).alias("name")
    buckets = members.groupBy("label", "table", "code", "bucket").agg(F.count("*").alias("n"), name).where("n > 1")
    # Close groups make the same bucket in many tables: its links are those of the first such table.
    buckets = buckets.groupBy("label", "n", "name").agg(F.min(F.struct("table", "bucket")).alias("first")).select("n", "first.bucket")
    buckets = write_table(buckets, "buckets")
    hot = hot_keys(buckets, "bucket")
    within = lookup(members.select("vec_id", "table", "bucket"), buckets.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "bucket", hot)
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    within = write_table(within.withColumn("own", own), "within")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"))))
    tasks = within.withColumn("pair", pair).select(
        "vec_id",
        "table",
        F.when(F.col("pair.i") == F.col("pair.j"), 2).when(F.col("own") == F.col("pair.i"), 0).otherwise(1).alias("side"),
        F.concat_ws("-", "bucket", "table", "pair.i", "pair.j").alias("task"),
    )
    # A vector in a large bucket meets each of its blocks.
    often = hot_keys(within.groupBy("vec_id").agg(F.sum("blocks").alias("n")), "vec_id")
    rows = spread_join(tasks, coded.select("vec_id", "data", "weight"), "vec_id", "task", often)
    rows = rows.repartition("task").sortWithinPartitions("task").select("task", "vec_id", "table", "side", "data", "weight")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=5000):
        found = write_table(rows.mapInPandas(_comparer(threshold, tables), "vec_id long, links long, peer long"), "near")

    same = usable.join(classes.select("label", "name", "embedding", "rep", "weight"), ["label", "name", "embedding"]).select("vec_id", "rep", "weight")
    valid = coded.select(F.col("vec_id").alias("rep"), F.lit(True).alias("valid")).distinct()
    same = write_table(same.join(valid, "rep").select("vec_id", "rep", "weight"), "same")
    edges = same.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    edges = edges.unionByName(found.where("vec_id <> peer").select(F.col("vec_id").alias("a"), F.col("peer").alias("b")).distinct())
    components = connected_components(edges)
    others = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("others"))
    links = same.join(others, "rep", "left").groupBy("vec_id").agg(F.max(F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = vectors.select("vec_id").join(links, "vec_id", "left").join(components.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
