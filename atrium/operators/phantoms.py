"""Tracks and places that are not people: furniture, reflections, rigid shapes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["run_id", "track_id"]


def cx() -> Column:
    return (F.col("x1") + F.col("x2")) / 2


def cy() -> Column:
    return (F.col("y1") + F.col("y2")) / 2


def bw() -> Column:
    return F.col("x2") - F.col("x1")


def bh() -> Column:
    return F.col("y2") - F.col("y1")


def static_tracks(boxes: DataFrame, life: float = 120.0, sightings: int = 20, centre: float = 0.02, size: float = 0.03) -> DataFrame:
    """Tracks that stay in one place at one size, relative to their median height (population deviations)."""
    s = boxes.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        (F.max("t") - F.min("t")).alias("life"),
        F.greatest(F.stddev_pop(cx()), F.stddev_pop(cy())).alias("c"),
        F.greatest(F.stddev_pop(bw()), F.stddev_pop(bh())).alias("s"),
        F.median(bh()).alias("h"),
    )
    return s.where((F.col("n") >= sightings) & (F.col("life") >= life) & (F.col("c") / F.col("h") <= centre) & (F.col("s") / F.col("h") <= size)).select(*KEYS, "n", "life")


def rigid_tracks(boxes: DataFrame, diagonal: float, life: float = 60.0, sightings: int = 25, aspect: float = 0.06, travel: float = 0.10) -> DataFrame:
    """Tracks of unchanging shape that never get far from their first point."""
    first = boxes.groupBy(*KEYS).agg(F.min_by(F.struct(cx().alias("fx"), cy().alias("fy")), "t").alias("f"))
    b = boxes.join(first, KEYS)
    far = F.sqrt((cx() - F.col("f.fx")) * (cx() - F.col("f.fx")) + (cy() - F.col("f.fy")) * (cy() - F.col("f.fy")))
    s = b.groupBy(*KEYS).agg(F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("life"), (F.stddev_pop(bh() / bw()) / F.avg(bh() / bw())).alias("cv"), F.max(far).alias("far"))
    return s.where((F.col("n") >= sightings) & (F.col("life") >= life) & (F.col("cv") <= aspect) & (F.col("far") <= travel * diagonal)).select(*KEYS, "n")


def mirrored_pairs(boxes: DataFrame, shared: int = 30, seconds: float = 20.0, offset: float = 15.0, cv: float = 0.10, travel: float = 80.0, protected: DataFrame | None = None) -> DataFrame:
    """Pairs of tracks whose feet keep one distance while both travel. Joins a frame's boxes, which are few.

    protected (run_id, track_id): a pair of two of these is left out.
    """
    p = boxes.select("run_id", "t", "track_id", cx().alias("x"), F.col("y2").alias("y"))
    o = p.select("run_id", "t", F.col("track_id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    both = p.join(o, ["run_id", "t"]).where("track_id < other")
    d = F.sqrt((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
    from pyspark.sql import Window

    w = Window.partitionBy("run_id", "track_id", "other").orderBy("t")
    step = lambda x, y: F.sqrt((F.col(x) - F.lag(x).over(w)) * (F.col(x) - F.lag(x).over(w)) + (F.col(y) - F.lag(y).over(w)) * (F.col(y) - F.lag(y).over(w)))
    both = both.withColumn("d", d).withColumn("s1", step("x", "y")).withColumn("s2", step("ox", "oy"))
    g = both.groupBy("run_id", "track_id", "other").agg(
        F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("span"), F.avg("d").alias("mean"), F.stddev_pop("d").alias("dev"), F.sum("s1").alias("p1"), F.sum("s2").alias("p2")
    )
    ok = (F.col("n") >= shared) & (F.col("span") >= seconds) & (F.col("mean") >= offset) & (F.col("dev") / F.col("mean") <= cv) & (F.col("p1") >= travel) & (F.col("p2") >= travel)
    found = g.where(ok).select("run_id", "track_id", "other", "n")
    if protected is None:
        return found
    safe = protected.select("run_id", "track_id").distinct().withColumn("_a", F.lit(True))
    other = safe.select("run_id", F.col("track_id").alias("other"), F.lit(True).alias("_b"))
    both = found.join(safe, ["run_id", "track_id"], "left").join(other, ["run_id", "other"], "left")
    return both.where("not coalesce(_a and _b, false)").select("run_id", "track_id", "other", "n")


def phantom_cells(boxes: DataFrame, protected: DataFrame, cell: float = 64.0, hits: int = 40, span: float = 60.0, jitter: float = 0.02, size_cv: float = 0.07) -> DataFrame:
    """Grid cells in which something stays put at one size under whatever ids, unless a protected track (run_id, track_id) was there.

    The region is the box of median size around the median centre; both spreads of size are relative to its median.
    """
    b = boxes.withColumn("gx", F.floor(cx() / cell)).withColumn("gy", F.floor(cy() / cell))
    safe = b.join(protected, KEYS, "left_semi").select("run_id", "gx", "gy").distinct()
    b = b.join(safe, ["run_id", "gx", "gy"], "left_anti")
    g = b.groupBy("run_id", "gx", "gy").agg(
        F.count("*").alias("hits"),
        F.count_distinct("track_id").alias("ids"),
        (F.max("t") - F.min("t")).alias("span"),
        F.greatest(F.stddev_pop(cx()), F.stddev_pop(cy())).alias("c"),
        F.median(cx()).alias("mx"),
        F.median(cy()).alias("my"),
        F.median(bw()).alias("w"),
        F.median(bh()).alias("h"),
        F.stddev_pop(bw()).alias("dw"),
        F.stddev_pop(bh()).alias("dh"),
    )
    steady = (F.col("c") / F.col("h") <= jitter) & (F.greatest(F.col("dw") / F.col("w"), F.col("dh") / F.col("h")) <= size_cv)
    g = g.where((F.col("hits") >= hits) & (F.col("span") >= span) & (F.col("h") > 1) & steady)
    half = lambda m, s, sign: F.col(m) + sign * F.col(s) / 2
    return g.select("run_id", "gx", "gy", "hits", "ids", "span", half("mx", "w", -1).alias("x1"), half("my", "h", -1).alias("y1"), half("mx", "w", 1).alias("x2"), half("my", "h", 1).alias("y2"))


def phantom_regions(cells: DataFrame, least: float = 0.3) -> DataFrame:
    """Merges a run's cells by falling hits: one that overlaps a region by `least` adds its hits to the first such region and
    stretches its ids and span. Cells are few per run: at most the frame's. (H17)"""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for r in pdf.sort_values(["hits", "gx", "gy"], ascending=[False, True, True]).to_dict("records"):
            for k in kept:
                both = max(0.0, min(r["x2"], k["x2"]) - max(r["x1"], k["x1"])) * max(0.0, min(r["y2"], k["y2"]) - max(r["y1"], k["y1"]))
                union = (r["x2"] - r["x1"]) * (r["y2"] - r["y1"]) + (k["x2"] - k["x1"]) * (k["y2"] - k["y1"]) - both
                if union > 0 and both / union >= least:
                    k["hits"] += r["hits"]
                    k["ids"], k["span"] = max(k["ids"], r["ids"]), max(k["span"], r["span"])
                    break
            else:
                kept.append(r)
        return pd.DataFrame(kept)[["run_id", "hits", "ids", "span", "x1", "y1", "x2", "y2"]]

    return cells.groupBy("run_id").applyInPandas(fold, "run_id int, hits long, ids long, span double, x1 double, y1 double, x2 double, y2 double")
