"""Interval algebra: merging, clipping, complements and range joins of (start, end) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(rows: DataFrame, keys: list[str], start: str = "t_in", end: str = "t_out", gap: float = 0.0) -> DataFrame:
    """Joins intervals of equal keys whose distance is at most gap (inclusive): keys, start, end.

    Rows with a null bound are dropped. (F1, F2, F5, F6, F16, F17)
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*keys, start, end)
    marked = rows.withColumn("_new", F.coalesce((F.col(start) - before > gap).cast("int"), F.lit(1)))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def total(rows: DataFrame, keys: list[str], start: str = "t_in", end: str = "t_out", name: str = "seconds") -> DataFrame:
    """Sum of lengths by key."""
    return rows.groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias(name))


def overlaps(rows: DataFrame, windows: DataFrame, keys: list[str], start: str = "t_in", end: str = "t_out", width: float = 300.0) -> DataFrame:
    """Rows joined with the windows (keys, w0, w1) that they overlap, by equi-join on time cells instead of comparing all of a key.

    Both sides are listed in every cell they touch, so width should be about
    their usual length; a pair belongs to the cell in which its overlap begins.
    """
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    left = rows.where(F.col(end) >= F.col(start)).withColumn("_cell", cells(start, end))
    right = windows.where("w1 >= w0").withColumn("_cell", cells("w0", "w1"))
    j = left.join(right, [*keys, "_cell"]).where((F.col(start) < F.col("w1")) & (F.col("w0") < F.col(end)))
    return j.where(F.col("_cell") == F.floor(F.greatest(start, "w0") / width)).drop("_cell")


def clip(rows: DataFrame, windows: DataFrame, keys: list[str], start: str = "t_in", end: str = "t_out", width: float = 300.0) -> DataFrame:
    """Parts of the rows inside windows (keys, w0, w1) of equal keys; only parts of positive length."""
    other = [c for c in rows.columns if c not in (start, end)]
    return overlaps(rows, windows, keys, start, end, width).select(*other, F.greatest(start, "w0").alias(start), F.least(end, "w1").alias(end))


def complement(merged: DataFrame, windows: DataFrame, keys: list[str], start: str = "t_in", end: str = "t_out", width: float = 300.0) -> DataFrame:
    """What merged, disjoint intervals leave free of windows (keys, w0, w1): keys, w0, start, end. Rests up to 1e-9 are dropped."""
    windows = windows.select(*keys, "w0", "w1")
    inside = overlaps(merged.select(*keys, start, end), windows, keys, start, end, width)
    edges = inside.select(*keys, "w0", "w1", F.greatest(start, "w0").alias("s"), F.least(end, "w1").alias("e"))
    edges = edges.unionByName(windows.select(*keys, "w0", "w1", F.col("w1").alias("s"), F.col("w1").alias("e")))
    order = Window.partitionBy(*keys, "w0", "w1").orderBy("s", "e")
    free = edges.withColumn("_from", F.coalesce(F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("w0")))
    return free.where(F.col("s") - F.col("_from") > 1e-9).select(*keys, "w0", F.col("_from").alias(start), F.col("s").alias(end))


def range_join(points: DataFrame, windows: DataFrame, keys: list[str], at: str, low: str, high: str, width: float) -> DataFrame:
    """Points with low <= at <= high, by equi-join on time cells of the given width instead of comparing all pairs.

    A window longer than a cell is listed in every cell it touches, so width
    should be about the usual length of a window. (E14, E15)
    """
    cells = windows.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    located = points.withColumn("_cell", F.floor(F.col(at) / width))
    return located.join(cells, [*keys, "_cell"]).where((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("_cell")
