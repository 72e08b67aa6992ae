"""Joins in which a few keys hold a large part of one side.

A key with at least a thousandth of a side's rows is hot. There are at most
HOT such keys, whatever the data, so a table of them has a proven size bound
and may be broadcast. All other keys hold less than a thousandth each, and
their rows are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.scratch import write_table

#: Most hot keys there can be.
HOT = 1000


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """key and copies of the hot keys of counts (key, n), at most HOT rows; copies is how many parts of a thousandth a key makes."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    least = max(2, -(-total // HOT))
    return write_table(counts.where(F.col(n) >= least).select(key, F.ceil(F.col(n) / F.lit(least)).cast("int").alias("copies")), "hot")


def lookup(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows joined with table, which has one small row of bounded size for each key: hot keys' rows of it are broadcast."""
    few = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    marked = rows.join(few, key, "left")
    there = F.broadcast(table.join(F.broadcast(hot.select(key)), key, "left_semi"))
    return marked.where("_hot").drop("_hot").join(there, key).unionByName(marked.where("_hot is null").drop("_hot").join(table, key))


def spread_join(rows: DataFrame, table: DataFrame, key: str, by: str, hot: DataFrame) -> DataFrame:
    """rows joined with table, which has one row for each key that may be large: it is copied for hot keys, and their rows,
    dealt by column `by`, meet different copies in different tasks."""
    few = F.broadcast(hot.select(key, "copies"))
    salted = rows.join(few, key, "left").withColumn("_salt", F.when(F.col("copies").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col("copies")).cast("int"))).drop("copies")
    copied = table.join(few, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("copies") - 1, F.lit(0))))).drop("copies")
    return salted.hint("merge").join(copied, [key, "_salt"]).drop("_salt")
