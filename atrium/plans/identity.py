"""Queries on identity (tables K and E of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.functions.geometry import cosine
from atrium.operators import identity as I
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, sql, table

#: Fragments with times and places by vec_id: 100 vectors are a run.
TRACK = """trk AS (SELECT CAST(vec_id // 100 AS INT) AS run_id, CAST(vec_id AS VARCHAR) AS track_id, CASE WHEN label = 0 THEN 'staff' ELSE 'customer' END AS role, CAST((vec_id % 100) * 8 AS DOUBLE) AS t_first, CAST((vec_id % 100) * 8 + 4 + label AS DOUBLE) AS t_last,
CAST(vec_id * 37 % 640 AS DOUBLE) AS x0, CAST(vec_id * 53 % 480 AS DOUBLE) AS y0, CAST((vec_id + 1) * 37 % 640 AS DOUBLE) AS x1, CAST((vec_id + 1) * 53 % 480 + label AS DOUBLE) AS y1, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"""
CAND = """cand AS (SELECT a.run_id, a.track_id AS a, b.track_id AS b, b.t_first - a.t_last AS gap, sqrt((a.x1 - b.x0) * (a.x1 - b.x0) + (a.y1 - b.y0) * (a.y1 - b.y0)) AS drift, list_cosine_similarity(a.vec, b.vec) AS sim
FROM trk a JOIN trk b ON a.run_id = b.run_id AND a.track_id <> b.track_id AND b.t_first - a.t_last >= 0 AND b.t_first - a.t_last <= 480)"""


def tracks(spark, sf):
    v, n = F.col("vec_id"), F.col("vec_id") % 100
    d = lambda c: c.cast("double")
    return table(spark, sf, "embeddings").select(
        F.expr("cast(vec_id div 100 as int)").alias("run_id"),
        v.cast("string").alias("track_id"),
        F.when(F.col("label") == 0, "staff").otherwise("customer").alias("role"),
        d(n * 8).alias("t_first"),
        d(n * 8 + 4 + F.col("label")).alias("t_last"),
        d(v * 37 % 640).alias("x0"),
        d(v * 53 % 480).alias("y0"),
        d((v + 1) * 37 % 640).alias("x1"),
        d((v + 1) * 53 % 480 + F.col("label")).alias("y1"),
        F.col("embedding").alias("vec"),
    )


@query("e6_handoff_candidates", sql("SELECT run_id, a, b, gap, round(drift, 5) AS drift, round(sim, 5) AS sim FROM cand", TRACK, CAND))
def e6(spark, sf):
    return I.candidates(tracks(spark, sf)).select("run_id", "a", "b", "gap", F.round("drift", 5).alias("drift"), F.round("sim", 5).alias("sim"))


@query("e2_remap_events", sql("SELECT run_id, CASE WHEN track_id LIKE 'm%' THEN substr(track_id, 2) ELSE track_id END AS track_id, count(*) AS n FROM v_box GROUP BY 1, 2"))
def e2(spark, sf):
    """Reflections are mapped to the person they mirror."""
    b = boxes(spark, sf)
    mapping = b.where("track_id like 'm%'").select("run_id", "track_id").distinct().withColumn("canon", F.expr("substr(track_id, 2)"))
    return I.remap(b, mapping).groupBy("run_id", "track_id").agg(F.count("*").alias("n"))


@query("k4_appearance_veto", sql("SELECT run_id, a, b, coalesce(sim < 0.3, false) AS veto FROM cand", TRACK, CAND))
def k4(spark, sf):
    return I.candidates(tracks(spark, sf)).select("run_id", "a", "b", F.coalesce(F.col("sim") < 0.30, F.lit(False)).alias("veto"))


DOORS = "((x - 0.0) * (x - 0.0) + (y - 240.0) * (y - 240.0) <= 6400.0)"


@query("k15_reappearance", sql(
    "SELECT c.run_id, c.a, c.b, CASE WHEN gap <= 10 THEN 'continuous' WHEN (a.x1 * a.x1 + (a.y1 - 240.0) * (a.y1 - 240.0) <= 6400.0) AND (b.x0 * b.x0 + (b.y0 - 240.0) * (b.y0 - 240.0) <= 6400.0) THEN 'door_to_door' WHEN drift <= 48.0 AND NOT (a.x1 * a.x1 + (a.y1 - 240.0) * (a.y1 - 240.0) <= 6400.0) AND NOT (b.x0 * b.x0 + (b.y0 - 240.0) * (b.y0 - 240.0) <= 6400.0) THEN 'occlusion_recovery' ELSE 'impossible' END AS verdict FROM cand c JOIN trk a ON a.run_id = c.run_id AND a.track_id = c.a JOIN trk b ON b.run_id = c.run_id AND b.track_id = c.b",
    TRACK, CAND))
def k15(spark, sf):
    t = tracks(spark, sf)
    door = lambda x, y: F.col(x) * F.col(x) + (F.col(y) - 240.0) * (F.col(y) - 240.0) <= 6400.0
    dead = t.select("run_id", F.col("track_id").alias("a"), door("x1", "y1").alias("dead"))
    born = t.select("run_id", F.col("track_id").alias("b"), door("x0", "y0").alias("born"))
    c = I.candidates(t).join(dead, ["run_id", "a"]).join(born, ["run_id", "b"])
    return c.select("run_id", "a", "b", I.verdict(F.col("gap"), F.col("drift"), F.col("dead"), F.col("born"), 800.0).alias("verdict"))


@query("k10_fusion_cost", sql("SELECT run_id, a, b, round(0.45 * (1 - sim) + 0.25 * least(drift / 800.0, 1.0) + 0.3 * 0.5, 5) AS cost FROM cand", TRACK, CAND))
def k10(spark, sf):
    """Missing evidence counts a half."""
    cost = 0.45 * (1 - F.col("sim")) + 0.25 * F.least(F.col("drift") / 800.0, F.lit(1.0)) + 0.3 * 0.5
    return I.candidates(tracks(spark, sf)).select("run_id", "a", "b", F.round(cost, 5).alias("cost"))


@query("e7_covisible_pairs", sql("SELECT a.run_id, a.track_id AS a, b.track_id AS b, least(a.t_last, b.t_last) - greatest(a.t_first, b.t_first) AS overlap FROM trk a JOIN trk b ON a.run_id = b.run_id AND a.track_id < b.track_id AND a.t_first < b.t_last AND b.t_first < a.t_last", TRACK))
def e7(spark, sf):
    t = tracks(spark, sf).select("run_id", "track_id", "t_first", "t_last", F.explode(F.sequence(F.floor(F.col("t_first") / 32), F.floor(F.col("t_last") / 32))).alias("cell"))
    o = t.select("run_id", "cell", F.col("track_id").alias("b"), F.col("t_first").alias("f"), F.col("t_last").alias("l"))
    both = t.join(o, ["run_id", "cell"]).where("track_id < b and t_first < l and f < t_last")
    # A pair may share several cells; it belongs to the one in which its overlap begins.
    both = both.where(F.col("cell") == F.floor(F.greatest("t_first", "f") / 32))
    return both.select("run_id", F.col("track_id").alias("a"), "b", (F.least("t_last", "l") - F.greatest("t_first", "f")).alias("overlap"))


@query("e12_nearest_door", sql("SELECT run_id, track_id, door, round(d, 5) AS d FROM (SELECT *, row_number() OVER (PARTITION BY run_id, track_id ORDER BY d, n) AS rn FROM (SELECT t.run_id, t.track_id, v.door, v.n, sqrt((t.x0 - v.x) * (t.x0 - v.x) + (t.y0 - v.y) * (t.y0 - v.y)) AS d FROM trk t, (VALUES ('west', 1, 0.0, 240.0), ('east', 2, 640.0, 240.0), ('north', 3, 320.0, 0.0)) AS v(door, n, x, y))) WHERE rn = 1", TRACK))
def e12(spark, sf):
    doors = [("west", 0.0, 240.0), ("east", 640.0, 240.0), ("north", 320.0, 0.0)]
    d = lambda x, y: F.sqrt((F.col("x0") - x) * (F.col("x0") - x) + (F.col("y0") - y) * (F.col("y0") - y))
    best = F.array_min(F.array(*[F.struct(d(x, y).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("door")) for i, (n, x, y) in enumerate(doors)]))
    return tracks(spark, sf).select("run_id", "track_id", best.alias("b")).select("run_id", "track_id", "b.door", F.round("b.d", 5).alias("d"))


@query("e13_nearest_time_join", sql(
    "SELECT run_id, frame_idx, g FROM (SELECT *, row_number() OVER (PARTITION BY run_id, g ORDER BY dt, frame_idx) AS rg FROM (SELECT p.run_id, p.frame_idx, g.frame_idx AS g, abs(p.t - g.t) AS dt, row_number() OVER (PARTITION BY p.run_id, p.frame_idx ORDER BY abs(p.t - g.t), g.frame_idx) AS rp FROM (SELECT DISTINCT run_id, frame_idx, t + 0.03 AS t FROM v_box WHERE frame_idx % 3 <> 0) p JOIN (SELECT DISTINCT run_id, frame_idx, t FROM v_box WHERE frame_idx % 2 = 0) g ON p.run_id = g.run_id AND abs(p.t - g.t) <= 0.1) WHERE rp = 1) WHERE rg = 1"))
def e13(spark, sf):
    """Each predicted frame takes the nearest true one within the tolerance, and each true one its nearest taker."""
    f = boxes(spark, sf).select("run_id", "frame_idx", "t").distinct()
    p = f.where("frame_idx % 3 <> 0").withColumn("t", F.col("t") + 0.03)
    g = f.where("frame_idx % 2 = 0").select("run_id", F.col("frame_idx").alias("g"), F.col("t").alias("gt"))
    g = g.withColumn("cell", F.explode(F.array(*[F.floor(F.col("gt")) + i for i in (-1, 0, 1)])))
    j = p.withColumn("cell", F.floor("t")).join(g, ["run_id", "cell"]).withColumn("dt", F.abs(F.col("t") - F.col("gt"))).where("dt <= 0.1")
    best = j.withColumn("r", F.row_number().over(Window.partitionBy("run_id", "frame_idx").orderBy("dt", "g"))).where("r = 1")
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("run_id", "g").orderBy("dt", "frame_idx"))).where("r = 1")
    return best.select("run_id", "frame_idx", "g")


@query("e17_seam_tails", sql("SELECT run_id, track_id, arg_max((x1 + x2) / 2, t) AS x, arg_max(y2, t) AS y, max(t) AS t FROM v_box JOIN (SELECT run_id, max(t) AS e FROM v_box GROUP BY run_id) USING (run_id) WHERE t >= e - 1.0 GROUP BY run_id, track_id"))
def e17(spark, sf):
    b = boxes(spark, sf)
    last = b.join(b.groupBy("run_id").agg(F.max("t").alias("e")), "run_id").where("t >= e - 1.0")
    f = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    return last.groupBy("run_id", "track_id").agg(F.max_by(f, "t").alias("f"), F.max("t").alias("t")).select("run_id", "track_id", "f.x", "f.y", "t")


@query("e18_seam_heads", sql("SELECT run_id, track_id, arg_min((x1 + x2) / 2, t) AS x, arg_min(y2, t) AS y, min(t) AS t FROM v_box JOIN (SELECT run_id, min(t) AS s FROM v_box GROUP BY run_id) USING (run_id) WHERE t <= s + 1.0 GROUP BY run_id, track_id"))
def e18(spark, sf):
    b = boxes(spark, sf)
    first = b.join(b.groupBy("run_id").agg(F.min("t").alias("s")), "run_id").where("t <= s + 1.0")
    f = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    return first.groupBy("run_id", "track_id").agg(F.min_by(f, "t").alias("f"), F.min("t").alias("t")).select("run_id", "track_id", "f.x", "f.y", "t")


@query("h24_best_crops", sql("SELECT run_id, track_id, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY run_id, track_id ORDER BY conf * (y2 - y1) DESC, frame_idx) AS rn FROM v_box) WHERE rn <= 6"))
def h24(spark, sf):
    w = Window.partitionBy("run_id", "track_id").orderBy((F.col("conf") * (F.col("y2") - F.col("y1"))).desc(), "frame_idx")
    return boxes(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 6").select("run_id", "track_id", "frame_idx")


@query("h21_duplicate_raw_split", sql("SELECT run_id, frame_idx, track_id, row_number() OVER (PARTITION BY run_id, frame_idx, role ORDER BY x1, track_id) = 1 AS keeps FROM v_box"))
def h21(spark, sf):
    """The role stands for a canonical id that several raw ids claim in one frame."""
    w = Window.partitionBy("run_id", "frame_idx", "role").orderBy("x1", "track_id")
    return boxes(spark, sf).select("run_id", "frame_idx", "track_id", (F.row_number().over(w) == 1).alias("keeps"))


@query("k2_gallery_similarity", "SELECT a.vec_id // 6 AS g, round(max(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 5) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id // 6 = a.vec_id // 6 + 1 GROUP BY 1")
def k2(spark, sf):
    """Best cosine between a gallery and the next one; six vectors are a gallery."""
    g = table(spark, sf, "embeddings").groupBy(F.expr("vec_id div 6").alias("g")).agg(F.collect_list("embedding").alias("v"))
    p = g.join(g.select((F.col("g") - 1).alias("g"), F.col("v").alias("w")), "g")
    best = F.array_max(F.transform("v", lambda x: F.array_max(F.transform("w", lambda y: cosine(x, y)))))
    return p.select("g", F.round(best, 5).alias("sim"))
