"""One digest of a table of any size, and where two tables differ, by a tree of hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.scratch import write_table

#: Children of a node: a node's name is its first hexadecimal digits.
FAN = 16


def tree(rows: DataFrame, key: Column, content: Column, depth: int) -> DataFrame:
    """The nodes of a table's hash tree: level (0: root), id, rows, digest.

    A row goes to the leaf named by the first `depth` digits of its key's hash.
    A leaf adds up its rows' hashes, so neither order nor partitions matter,
    equal rows count as often as they are there, and no task gathers a leaf's
    rows. A node hashes its children in order. A null content is like the
    empty one. An empty table has no nodes.
    """
    row = F.sha2(F.coalesce(content, F.lit("")), 256)
    half = lambda start: F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")
    leaves = rows.groupBy(F.substring(F.sha2(key, 256), 1, depth).alias("id")).agg(F.count("*").alias("rows"), F.sum(half(1)).alias("a"), F.sum(half(16)).alias("b"))
    level = leaves.select(F.lit(depth).alias("level"), "id", "rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")), 256).alias("digest"))
    level = nodes = write_table(level, "nodes")
    for k in range(depth - 1, -1, -1):
        children = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "digest"))), lambda c: F.concat(c["id"], F.lit("="), c["digest"])), ";")
        level = level.groupBy(F.substring("id", 1, k).alias("id")).agg(F.sum("rows").alias("rows"), F.sha2(children, 256).alias("digest"))
        level = write_table(level.select(F.lit(k).alias("level"), "id", "rows", "digest"), "nodes")
        nodes = nodes.unionByName(level)
    return nodes


def differences(mine: DataFrame, other: DataFrame) -> DataFrame:
    """The nodes in which two trees of one depth differ, from the root down: level, id, rows, other_rows.

    Only children of nodes that differ are compared.
    """
    depth = max(t.agg(F.max("level")).first()[0] or 0 for t in (mine, other))
    renamed = other.select("level", "id", F.col("rows").alias("other_rows"), F.col("digest").alias("other_digest"))
    out = found = None
    for k in range(depth + 1):
        a, b = mine.where(F.col("level") == k), renamed.where(F.col("level") == k)
        if found is not None:
            parents = found.select(F.col("id").alias("parent"))
            a, b = (t.join(parents, F.substring("id", 1, k - 1) == F.col("parent"), "left_semi") for t in (a, b))
        both = a.join(b, ["level", "id"], "full").where(~F.col("digest").eqNullSafe(F.col("other_digest")))
        found = write_table(both.select("level", "id", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("other_rows", F.lit(0)).alias("other_rows")), "differ")
        out = found if out is None else out.unionByName(found)
        if found.isEmpty():
            return out
    return out
