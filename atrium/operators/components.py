"""Connected components of a graph that is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.scratch import delete, written


def _mins(edges: DataFrame) -> tuple[DataFrame, str]:
    return written(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least")), "least")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Returns (id, component) for every id on an edge; component is the smallest reachable id.

    Alternates two star operations: every larger neighbour of a node is hung
    on the smallest node that this node knows, then every node's smaller
    neighbours are hung on the smallest of them. The number of rounds grows
    with the logarithm of the longest path. Each round is written to the
    shared folder, and its predecessor is deleted. A node with very many neighbours is only ever a join key,
    and both join inputs come from tables, so that Spark can split it.

    Null ids and loops are ignored. An empty input gives an empty result.
    """
    pairs = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo"))
    )
    spark = edges.sparkSession
    now, path = written(pairs.distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        least, p1 = _mins(now)
        large = (
            now.join(least, now["lo"] == least["node"], "left")
            .select("hi", F.coalesce("least", "lo").alias("lo"))
            .distinct()
        )
        large, p2 = written(large, "edges")
        least, p3 = _mins(large)
        down = large.join(least, large["hi"] == least["node"]).where(F.col("lo") != F.col("least"))
        small = (
            down.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
            .unionByName(least.select(F.col("node").alias("hi"), F.col("least").alias("lo")))
            .distinct()
        )
        now, new = written(small, "edges")
        delete(spark, path, p1, p2, p3)
        path = new
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )
