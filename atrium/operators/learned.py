"""Zones proposed from where tracks begin and end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atrium.operators.components import connected_components


def entry_zones(boxes: DataFrame, width: float, height: float, cell: float = 96.0, least: int = 3, top: int = 3) -> DataFrame:
    """Up to `top` boxes per run around neighbouring cells in which tracks begin or end: run_id, x1, y1, x2, y2, births, deaths, score.

    A cell needs `least` ends. The score is the number of ends, halved where
    only one kind occurs, and a quarter more at the frame's edge.
    """
    f = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    e = boxes.groupBy("run_id", "track_id").agg(F.min_by(f, "t").alias("b"), F.max_by(f, "t").alias("d"))
    ends = e.select("run_id", F.explode(F.array(F.struct(F.lit(True).alias("birth"), F.col("b.x").alias("x"), F.col("b.y").alias("y")), F.struct(F.lit(False).alias("birth"), F.col("d.x").alias("x"), F.col("d.y").alias("y")))).alias("e")).select("run_id", "e.*")
    ends = ends.withColumn("gx", F.floor(F.col("x") / cell)).withColumn("gy", F.floor(F.col("y") / cell))
    seed = ends.groupBy("run_id", "gx", "gy").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    seed = seed.withColumn("id", F.xxhash64("run_id", "gx", "gy"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) > (0, 0)]))
    near = seed.select("run_id", F.col("id").alias("a"), "gx", "gy", around.alias("d")).select("run_id", "a", (F.col("gx") + F.col("d.i")).alias("gx"), (F.col("gy") + F.col("d.j")).alias("gy"))
    found = connected_components(near.join(seed.select("run_id", "gx", "gy", F.col("id").alias("b")), ["run_id", "gx", "gy"]))
    cells = seed.join(found, "id", "left").withColumn("root", F.coalesce("component", "id"))
    areas = cells.groupBy("run_id", "root").agg(
        F.min(F.struct("gx", "gy")).alias("first"), (F.min("gx") * cell).alias("x1"), (F.min("gy") * cell).alias("y1"), ((F.max("gx") + 1) * cell).alias("x2"), ((F.max("gy") + 1) * cell).alias("y2")
    )
    # Each area lists the cells of its extent, so ends meet it by an equi-join; an end on its far border counts as inside.
    wide = F.sequence((F.col("x1") / cell).cast("long"), (F.col("x2") / cell).cast("long"))
    high = F.sequence((F.col("y1") / cell).cast("long"), (F.col("y2") / cell).cast("long"))
    listed = areas.withColumn("gx", F.explode(wide)).withColumn("gy", F.explode(high))
    inside = listed.join(ends, ["run_id", "gx", "gy"]).where("x between x1 and x2 and y between y1 and y2")
    g = inside.groupBy("run_id", "root", "first", "x1", "y1", "x2", "y2").agg(F.count_if("birth").alias("births"), F.count_if(~F.col("birth")).alias("deaths"))
    balance = F.least("births", "deaths") / F.greatest("births", "deaths")
    edge = F.least(F.col("x1") / width, F.col("y1") / height, (width - F.col("x2")) / width, (height - F.col("y2")) / height)
    g = g.withColumn("score", (F.col("births") + F.col("deaths")) * (0.5 + 0.5 * balance) * F.when(edge <= 0.06, 1.25).otherwise(1.0))
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc(F.round("score", 9)), "first"))
    return g.withColumn("rank", rank).where(F.col("rank") <= top).drop("rank", "root", "first")
