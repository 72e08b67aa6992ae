"""Queries on track quality, phantoms, calibration and learned zones."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.functions.geometry import cosine
from atrium.operators import detections as D
from atrium.operators import phantoms as P
from atrium.operators.components import connected_components
from atrium.operators.occupancy import floor_quantile
from atrium.plans.detections import AREA, IOU
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sql, table

STATIC = """stat AS (SELECT run_id, track_id, count(*) AS n, max(t) - min(t) AS life FROM (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, x2 - x1 AS w, y2 - y1 AS h FROM v_box) GROUP BY run_id, track_id
HAVING count(*) >= 20 AND max(t) - min(t) >= 60.0 AND greatest(stddev_pop(cx), stddev_pop(cy)) / median(h) <= 0.02 AND greatest(stddev_pop(w), stddev_pop(h)) / median(h) <= 0.03)"""


@query("h13_static_tracks", sql("SELECT * FROM stat", STATIC))
def h13(spark, sf):
    return P.static_tracks(boxes(spark, sf), life=60.0)


@query("h15_rigid_tracks", sql(
    "SELECT run_id, track_id, count(*) AS n FROM (SELECT *, first_value(cx) OVER w AS fx, first_value(cy) OVER w AS fy FROM (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, (y2 - y1) / (x2 - x1) AS a FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t)) GROUP BY run_id, track_id HAVING count(*) >= 25 AND max(t) - min(t) >= 60.0 AND stddev_pop(a) / avg(a) <= 0.06 AND max(sqrt((cx - fx) * (cx - fx) + (cy - fy) * (cy - fy))) <= 0.1 * 2202.9"))
def h15(spark, sf):
    return P.rigid_tracks(boxes(spark, sf), 2202.9)


@query("e11_mirrored_pairs", sql(
    "SELECT * FROM (SELECT run_id, track_id, other, count(*) AS n FROM (SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS s1, sqrt((ox - lag(ox) OVER w) * (ox - lag(ox) OVER w) + (oy - lag(oy) OVER w) * (oy - lag(oy) OVER w)) AS s2 FROM (SELECT a.run_id, a.t, a.track_id, b.track_id AS other, a.x, a.y, b.x AS ox, b.y AS oy, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM c a JOIN c b ON a.run_id = b.run_id AND a.t = b.t AND a.track_id < b.track_id) WINDOW w AS (PARTITION BY run_id, track_id, other ORDER BY t)) GROUP BY run_id, track_id, other HAVING count(*) >= 20 AND max(t) - min(t) >= 20.0 AND avg(d) >= 15.0 AND stddev_pop(d) / avg(d) <= 0.1 AND sum(s1) >= 80.0 AND sum(s2) >= 80.0) WHERE NOT ((run_id, track_id) IN (SELECT run_id, track_id FROM v_box WHERE role = 'staff') AND (run_id, other) IN (SELECT run_id, track_id FROM v_box WHERE role = 'staff'))",
    "c AS (SELECT run_id, t, track_id, (x1 + x2) / 2 AS x, y2 AS y FROM v_box)"))
def e11(spark, sf):
    b = boxes(spark, sf)
    return P.mirrored_pairs(b, shared=20, protected=b.where("role = 'staff'").select("run_id", "track_id"))


@query("e27_protected_ids", sql("SELECT DISTINCT run_id, track_id FROM v_crossing WHERE line = 'entry line' UNION SELECT DISTINCT run_id, track_id FROM v_box WHERE role = 'staff'"))
def e27(spark, sf):
    crossed = crossings(spark, sf).where("line = 'entry line'").select("run_id", "track_id")
    return crossed.unionByName(boxes(spark, sf).where("role = 'staff'").select("run_id", "track_id")).distinct()


@query("e26_drop_phantoms", sql("SELECT run_id, frame_idx, track_id FROM v_box ANTI JOIN (SELECT run_id, track_id FROM stat WHERE (run_id, track_id) NOT IN (SELECT run_id, track_id FROM v_box WHERE role = 'staff')) USING (run_id, track_id)", STATIC))
def e26(spark, sf):
    b = boxes(spark, sf)
    safe = b.where("role = 'staff'").select("run_id", "track_id").distinct()
    gone = P.static_tracks(b, life=60.0).join(safe, ["run_id", "track_id"], "left_anti")
    return b.join(gone, ["run_id", "track_id"], "left_anti").select("run_id", "frame_idx", "track_id")


CELLS = """cells AS (SELECT run_id, gx, gy, hits, ids, span, mx - w / 2 AS x1, my - h / 2 AS y1, mx + w / 2 AS x2, my + h / 2 AS y2 FROM (SELECT run_id, gx, gy, count(*) AS hits, count(DISTINCT track_id) AS ids, max(t) - min(t) AS span, greatest(stddev_pop(cx), stddev_pop(cy)) AS c, median(cx) AS mx, median(cy) AS my, median(x2 - x1) AS w, median(y2 - y1) AS h, stddev_pop(x2 - x1) AS dw, stddev_pop(y2 - y1) AS dh
FROM (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, CAST(floor((x1 + x2) / 2 / 64.0) AS BIGINT) AS gx, CAST(floor((y1 + y2) / 2 / 64.0) AS BIGINT) AS gy FROM v_box) b
WHERE (run_id, gx, gy) NOT IN (SELECT run_id, CAST(floor((x1 + x2) / 2 / 64.0) AS BIGINT), CAST(floor((y1 + y2) / 2 / 64.0) AS BIGINT) FROM v_box WHERE track_id = '10') GROUP BY run_id, gx, gy) WHERE hits >= 30 AND span >= 60.0 AND h > 1 AND c / h <= 0.2 AND greatest(dw / w, dh / h) <= 0.2)"""
REGIONS = """o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY hits DESC, gx, gy) AS rn FROM cells),
fold AS (WITH RECURSIVE r AS (SELECT run_id, rn, [{'hits': hits, 'ids': ids, 'span': span, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}] AS k FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.rn, CASE WHEN s.at IS NULL THEN list_append(s.k, {'hits': s.hits, 'ids': s.ids, 'span': s.span, 'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}) ELSE list_transform(s.k, lambda m, i: CASE WHEN i = s.at THEN {'hits': m.hits + s.hits, 'ids': greatest(m.ids, s.ids), 'span': greatest(m.span, s.span), 'x1': m.x1, 'y1': m.y1, 'x2': m.x2, 'y2': m.y2} ELSE m END) END
  FROM (SELECT o.*, r.k, list_position(list_transform(r.k, lambda m: greatest(0, least(o.x2, m.x2) - greatest(o.x1, m.x1)) * greatest(0, least(o.y2, m.y2) - greatest(o.y1, m.y1)) / ((o.x2 - o.x1) * (o.y2 - o.y1) + (m.x2 - m.x1) * (m.y2 - m.y1) - greatest(0, least(o.x2, m.x2) - greatest(o.x1, m.x1)) * greatest(0, least(o.y2, m.y2) - greatest(o.y1, m.y1))) >= 0.3), true) AS at FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) s) SELECT run_id, unnest(k) AS m FROM r QUALIFY rn = max(rn) OVER (PARTITION BY run_id))"""


def _cells(spark, sf):
    b = boxes(spark, sf)
    safe = b.where("track_id = '10'").select("run_id", "track_id").distinct()
    return P.phantom_cells(b, safe, hits=30, jitter=0.2, size_cv=0.2)


@query("h17_phantom_cells", sql("SELECT * FROM cells", CELLS))
def h17(spark, sf):
    return _cells(spark, sf)


@query("h17_phantom_regions", sql("SELECT run_id, m.hits AS hits, m.ids AS ids, m.span AS span, m.x1 AS x1, m.y1 AS y1, m.x2 AS x2, m.y2 AS y2 FROM fold", CELLS, REGIONS))
def h17b(spark, sf):
    return P.phantom_regions(_cells(spark, sf))


@query("c21_without_phantom_regions", sql(f"SELECT a.run_id, a.frame_idx, a.track_id FROM v_box a WHERE NOT EXISTS (SELECT 1 FROM cells b WHERE a.run_id = b.run_id AND {IOU} / nullif({AREA.format('a')} + {AREA.format('b')} - {IOU}, 0) >= 0.55)", CELLS))
def c21(spark, sf):
    return D.without_regions(boxes(spark, sf), _cells(spark, sf).select("run_id", "x1", "y1", "x2", "y2")).select("run_id", "frame_idx", "track_id")


@query("h12_track_endpoints", sql("SELECT run_id, track_id, arg_min(fx, t) AS bx, arg_min(fy, t) AS by_, arg_max(fx, t) AS dx, arg_max(fy, t) AS dy, max(t) - min(t) AS life FROM (SELECT *, (x1 + x2) / 2 AS fx, y2 AS fy FROM v_box) GROUP BY run_id, track_id HAVING max(t) - min(t) >= 1.5"))
def h12(spark, sf):
    f = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    e = boxes(spark, sf).groupBy("run_id", "track_id").agg(F.min_by(f, "t").alias("b"), F.max_by(f, "t").alias("d"), (F.max("t") - F.min("t")).alias("life")).where("life >= 1.5")
    return e.select("run_id", "track_id", F.col("b.x").alias("bx"), F.col("b.y").alias("by_"), F.col("d.x").alias("dx"), F.col("d.y").alias("dy"), "life")


@query("g38_id_reuse", sql("SELECT run_id, track_id, count(*) FILTER (gap >= 2) AS stale, count(*) FILTER (gap >= 2 AND jump > 200.0) AS reused FROM (SELECT *, frame_idx - lag(frame_idx) OVER w - 1 AS gap, sqrt((fx - lag(fx) OVER w) * (fx - lag(fx) OVER w) + (y2 - lag(y2) OVER w) * (y2 - lag(y2) OVER w)) AS jump FROM (SELECT *, (x1 + x2) / 2 AS fx FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY frame_idx)) GROUP BY run_id, track_id"))
def g38(spark, sf):
    w = Window.partitionBy("run_id", "track_id").orderBy("frame_idx")
    b = boxes(spark, sf).withColumn("fx", (F.col("x1") + F.col("x2")) / 2)
    step = lambda c: F.col(c) - F.lag(c).over(w)
    b = b.withColumn("gap", step("frame_idx") - 1).withColumn("jump", F.sqrt(step("fx") * step("fx") + step("y2") * step("y2")))
    stale = F.col("gap") >= 2
    return b.groupBy("run_id", "track_id").agg(F.count_if(stale).alias("stale"), F.count_if(stale & (F.col("jump") > 200.0)).alias("reused"))


@query("g39_frame_audit", sql(
    f"SELECT run_id, sum(n) AS boxes, max(n) AS most, coalesce(max(dup), 0) AS duplicates FROM (SELECT run_id, frame_idx, count(*) AS n FROM v_box GROUP BY ALL) LEFT JOIN (SELECT a.run_id, count(*) AS dup FROM v_box a JOIN v_box b ON a.run_id = b.run_id AND a.frame_idx = b.frame_idx AND a.track_id < b.track_id WHERE {IOU} / ({AREA.format('a')} + {AREA.format('b')} - {IOU}) > 0.3 GROUP BY a.run_id) USING (run_id) GROUP BY run_id"))
def g39(spark, sf):
    from atrium.functions.geometry import box, iou

    b = boxes(spark, sf)
    dup = D.pairs(b).where((F.col("track_id") < F.col("o_track_id")) & (iou(box(), box("o_")) > 0.3)).groupBy("run_id").agg(F.count("*").alias("dup"))
    n = b.groupBy("run_id", "frame_idx").agg(F.count("*").alias("n")).groupBy("run_id").agg(F.sum("n").alias("boxes"), F.max("n").alias("most"))
    return n.join(dup, "run_id", "left").select("run_id", "boxes", "most", F.coalesce("dup", F.lit(0)).alias("duplicates"))


@query("g35_track_stats", sql("SELECT run_id, count(*) AS tracks, round(100.0 * avg(CASE WHEN b THEN 0 ELSE 1 END), 2) AS born_inside, round(100.0 * avg(CASE WHEN d THEN 0 ELSE 1 END), 2) AS died_inside FROM (SELECT run_id, track_id, arg_min(e <= 64.8, t) AS b, arg_max(e <= 64.8, t) AS d FROM (SELECT *, least(x1, y1, 1920.0 - x2, 1080.0 - y2) AS e FROM v_box) GROUP BY ALL) GROUP BY run_id"))
def g35(spark, sf):
    edge = F.least(F.col("x1"), F.col("y1"), 1920.0 - F.col("x2"), 1080.0 - F.col("y2")) <= 64.8
    t = boxes(spark, sf).groupBy("run_id", "track_id").agg(F.min_by(edge, "t").alias("b"), F.max_by(edge, "t").alias("d"))
    share = lambda c: F.round(100.0 * F.avg(F.when(F.col(c), 0).otherwise(1)), 2)
    return t.groupBy("run_id").agg(F.count("*").alias("tracks"), share("b").alias("born_inside"), share("d").alias("died_inside"))


@query("g37_pixel_height", sql("SELECT run_id, list_sort(list(h))[CAST(floor(0.1 * (count(*) - 1)) AS INT) + 1] AS p10, list_sort(list(h))[CAST(floor(0.5 * (count(*) - 1)) AS INT) + 1] AS p50, list_sort(list(h))[CAST(floor(0.9 * (count(*) - 1)) AS INT) + 1] AS p90, round(avg(CASE WHEN h < 110.0 THEN 1.0 ELSE 0.0 END), 4) AS below FROM (SELECT run_id, y2 - y1 AS h FROM v_box) GROUP BY run_id"))
def g37(spark, sf):
    h = F.col("y2") - F.col("y1")
    q = [floor_quantile(h, p).alias(f"p{int(100 * p)}") for p in (0.1, 0.5, 0.9)]
    return boxes(spark, sf).groupBy("run_id").agg(*q, F.round(F.avg(F.when(h < 110.0, 1.0).otherwise(0.0)), 4).alias("below"))


@query("g36_recovery_gaps", sql("SELECT run_id, count(*) FILTER (gap > 1.5 / 8) AS gaps, round(max(gap), 4) AS longest FROM (SELECT *, t - lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS gap FROM v_box) GROUP BY run_id"))
def g36(spark, sf):
    gap = F.col("t") - F.lag("t").over(Window.partitionBy("run_id", "track_id").orderBy("t"))
    return boxes(spark, sf).withColumn("gap", gap).groupBy("run_id").agg(F.count_if(F.col("gap") > 1.5 / 8).alias("gaps"), F.round(F.max("gap"), 4).alias("longest"))


CLUST = """seed AS (SELECT run_id, CAST(floor(bx / 96.0) AS BIGINT) AS gx, CAST(floor(by_ / 96.0) AS BIGINT) AS gy, count(*) AS n FROM (SELECT run_id, track_id, arg_min((x1 + x2) / 2, t) AS bx, arg_min(y2, t) AS by_ FROM v_box GROUP BY run_id, track_id) GROUP BY 1, 2, 3)"""


@query("i8_grid_clusters", sql(
    "SELECT run_id, root, count(*) AS cells, sum(n) AS births FROM (SELECT s.run_id, s.gx, s.gy, s.n, min(r.o) AS root FROM seed s JOIN reach r ON r.run_id = s.run_id AND r.gx = s.gx AND r.gy = s.gy GROUP BY ALL) GROUP BY run_id, root",
    CLUST,
    "reach AS (WITH RECURSIVE rr AS (SELECT run_id, gx, gy, gx * 1000 + gy AS o FROM seed UNION SELECT s.run_id, s.gx, s.gy, rr.o FROM rr JOIN seed s ON s.run_id = rr.run_id AND abs(s.gx - rr.gx) <= 1 AND abs(s.gy - rr.gy) <= 1) SELECT * FROM rr)"))
def i8(spark, sf):
    """Eight-neighbour components of the cells in which tracks begin."""
    f = F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    b = boxes(spark, sf).groupBy("run_id", "track_id").agg(F.min_by(f, "t").alias("b"))
    seed = b.groupBy("run_id", F.floor(F.col("b.x") / 96.0).alias("gx"), F.floor(F.col("b.y") / 96.0).alias("gy")).agg(F.count("*").alias("n"))
    seed = seed.withColumn("id", F.col("run_id").cast("long") * 1_000_000_000 + F.col("gx") * 1000 + F.col("gy"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) > (0, 0)]))
    near = seed.select("run_id", "id", "gx", "gy", around.alias("d")).select("run_id", F.col("id").alias("a"), (F.col("gx") + F.col("d.i")).alias("gx"), (F.col("gy") + F.col("d.j")).alias("gy"))
    edges = near.join(seed.select("run_id", "gx", "gy", F.col("id").alias("b")), ["run_id", "gx", "gy"])
    found = connected_components(edges)
    out = seed.join(found, "id", "left").withColumn("root", F.coalesce("component", "id") - F.col("run_id").cast("long") * 1_000_000_000)
    return out.groupBy("run_id", "root").agg(F.count("*").alias("cells"), F.sum("n").alias("births"))


SIMS = """sims AS (SELECT a.label AS la, b.label AS lb, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 UNION ALL SELECT a.label, b.label, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 7)"""


def _sims(spark, sf):
    """Similarities of neighbouring vectors: same label, or different."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    far = e.select(F.explode(F.array(F.lit(1), F.lit(7))).alias("d"), F.col("vec_id").alias("v"), F.col("label").alias("lb"), F.col("embedding").alias("other")).withColumn("vec_id", F.col("v") - F.col("d"))
    return e.join(far, "vec_id").select((F.col("label") == F.col("lb")).alias("same"), cosine(F.col("embedding"), F.col("other")).alias("s"))


def _sweep(spark, sf, n):
    """Rates at the thresholds 0, 1 / n, ..., 1: pairs are counted once by the last threshold that they reach, then added up over n + 2 rows."""
    at = lambda i: i / F.lit(float(n))
    near = F.floor(F.col("s") * n)
    cell = F.when(at(near) > F.col("s"), near - 1).when(at(near + 1) <= F.col("s"), near + 1).otherwise(near)
    cell = F.least(F.greatest(cell, F.lit(-1)), F.lit(n))
    counts = _sims(spark, sf).groupBy(cell.alias("cell")).agg(F.count_if("same").alias("same"), F.count_if(~F.col("same")).alias("different"))
    grid = spark.range(-1, n + 1).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("same"), F.lit(0).cast("long").alias("different"))
    counts = counts.unionByName(grid).groupBy("cell").agg(F.sum("same").alias("same"), F.sum("different").alias("different"))
    every, below = Window.partitionBy(), Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.sum(c).over(every)
    under = lambda c: F.coalesce(F.sum(c).over(below), F.lit(0))
    r = counts.select("cell", (under("same") / total("same")).alias("fr"), ((total("different") - under("different")) / total("different")).alias("fa"))
    return r.where("cell >= 0").select(at(F.col("cell")).alias("th"), "fr", "fa")


RATES = "rates AS (SELECT i / 100.0::DOUBLE AS th, avg(CASE WHEN s < i / 100.0::DOUBLE THEN 1.0 ELSE 0.0 END) FILTER (la = lb) AS fr, avg(CASE WHEN s >= i / 100.0::DOUBLE THEN 1.0 ELSE 0.0 END) FILTER (la <> lb) AS fa FROM sims, range(101) g(i) GROUP BY i)"


@query("g53_best_threshold", sql("SELECT th, round(1 - (fr + fa) / 2, 6) AS balanced FROM rates ORDER BY round(1 - (fr + fa) / 2, 9) DESC, th LIMIT 1", SIMS, RATES))
def g53(spark, sf):
    r = _sweep(spark, sf, 100).withColumn("b", 1 - (F.col("fr") + F.col("fa")) / 2)
    return r.orderBy(F.desc(F.round("b", 9)), "th").limit(1).select("th", F.round("b", 6).alias("balanced"))


@query("g54_cost_threshold", sql("SELECT th, round(8 * fa + fr, 6) AS cost, fr >= 0.99 AS degenerate FROM rates ORDER BY round(8 * fa + fr, 9), th DESC LIMIT 1", SIMS, RATES))
def g54(spark, sf):
    r = _sweep(spark, sf, 100).withColumn("c", 8 * F.col("fa") + F.col("fr"))
    return r.orderBy(F.round("c", 9), F.desc("th")).limit(1).select("th", F.round("c", 6).alias("cost"), (F.col("fr") >= 0.99).alias("degenerate"))


@query("p11_rates", sql("SELECT th, round(fr, 6) AS fr, round(fa, 6) AS fa FROM rates", SIMS, RATES))
def p11(spark, sf):
    return _sweep(spark, sf, 100).select("th", F.round("fr", 6).alias("fr"), F.round("fa", 6).alias("fa"))


@query("g56_youden", sql("SELECT th, round(1 - fr - fa, 6) AS j FROM rates ORDER BY round(1 - fr - fa, 9) DESC, th LIMIT 1", SIMS, RATES))
def g56(spark, sf):
    r = _sweep(spark, sf, 100).withColumn("j", 1 - F.col("fr") - F.col("fa"))
    return r.orderBy(F.desc(F.round("j", 9)), "th").limit(1).select("th", F.round("j", 6).alias("j"))


@query("g55_separability_verdict", sql("SELECT CASE WHEN b >= 0.95 THEN 'separable' WHEN b >= 0.8 THEN 'usable' ELSE 'not separable' END AS verdict FROM (SELECT max(1 - (fr + fa) / 2) AS b FROM rates)", SIMS, RATES))
def g55(spark, sf):
    b = F.max(1 - (F.col("fr") + F.col("fa")) / 2)
    return _sweep(spark, sf, 100).agg(F.when(b >= 0.95, "separable").when(b >= 0.8, "usable").otherwise("not separable").alias("verdict"))
