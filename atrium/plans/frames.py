"""More queries on frames, tracks and seams (tables C, D, E, H, P of the inventory)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.operators import detections as D
from atrium.operators import phantoms as P
from atrium.operators.occupancy import floor_quantile, runs_of, upper_median
from atrium.plans.detections import AREA, IOU, PLANE
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sql, table

KEY = ["run_id", "frame_idx", "track_id"]


def fx():
    return (F.col("x1") + F.col("x2")) / 2


def fy():
    return F.col("y2")


def by_track():
    return Window.partitionBy("run_id", "track_id").orderBy("t")


@query("c3_drop_rate_guard", sql(
    "SELECT run_id, count(*) AS seen, count(*) FILTER (n > trip) AS relaxed FROM (SELECT *, coalesce(min(CASE WHEN n > 500 AND dropped > 0.12 * n THEN n END) OVER (PARTITION BY run_id), 1000000000) AS trip FROM (SELECT run_id, row_number() OVER w AS n, sum(CASE WHEN (x2 - x1) * (y2 - y1) > 1.5 * (0.2 * y2 + 20.0) * (0.2 * y2 + 20.0) / 3.5 THEN 1 ELSE 0 END) OVER w AS dropped FROM v_box WINDOW w AS (PARTITION BY run_id ORDER BY frame_idx, track_id ROWS UNBOUNDED PRECEDING))) GROUP BY run_id"))
def c3(spark, sf):
    """From the first row at which over 12 % of more than 500 seen were dropped, the rest of the run is judged by a relaxed bar."""
    w = Window.partitionBy("run_id").orderBy("frame_idx", "track_id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    b = boxes(spark, sf).withColumn("n", F.row_number().over(w)).withColumn("dropped", F.sum(D.implausible(PLANE, 1.5).cast("int")).over(so_far))
    trip = b.where((F.col("n") > 500) & (F.col("dropped") > 0.12 * F.col("n"))).groupBy("run_id").agg(F.min("n").alias("trip"))
    b = b.join(trip, "run_id", "left")
    return b.groupBy("run_id").agg(F.count("*").alias("seen"), F.count_if(F.col("n") > F.coalesce("trip", F.lit(1_000_000_000))).alias("relaxed"))


@query("c4_class_split", sql("SELECT run_id, count(*) FILTER (role = 'staff') AS heads, count(*) FILTER (role <> 'staff') AS persons FROM v_box GROUP BY run_id"))
def c4(spark, sf):
    head = F.col("role") == "staff"
    return boxes(spark, sf).groupBy("run_id").agg(F.count_if(head).alias("heads"), F.count_if(~head).alias("persons"))


@query("c6_split_merged", sql(
    "SELECT run_id, frame_idx, track_id, n, lo, hi FROM (SELECT *, lag(cut, 1, x1) OVER w AS lo, coalesce(cut, x2) AS hi, row_number() OVER w - 1 AS n, count(*) OVER (PARTITION BY run_id, frame_idx, track_id) AS heads FROM (SELECT p.run_id, p.frame_idx, p.track_id, p.x1, p.x2, h.cx, (h.cx + lead(h.cx) OVER (PARTITION BY p.run_id, p.frame_idx, p.track_id ORDER BY h.cx, h.track_id)) / 2 AS cut, h.track_id AS hid FROM v_box p JOIN (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy FROM v_box) h ON p.run_id = h.run_id AND p.frame_idx // 8 = h.frame_idx // 8 AND p.track_id <> h.track_id AND h.cx BETWEEN p.x1 AND p.x2 AND h.cy BETWEEN p.y1 AND p.y2) WINDOW w AS (PARTITION BY run_id, frame_idx, track_id ORDER BY cx, hid)) WHERE heads >= 2"))
def c6(spark, sf):
    """A box with several heads is cut at the midpoints between neighbouring ones; the centres of other boxes of the same second stand for heads."""
    b = boxes(spark, sf).withColumn("second", F.floor(F.col("frame_idx") / 8))
    h = b.select("run_id", "second", fx().alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"), F.col("track_id").alias("hid"))
    j = b.join(h, ["run_id", "second"]).where("track_id <> hid and cx between x1 and x2 and cy between y1 and y2")
    heads = j.groupBy(*KEY, "x1", "x2").agg(F.sort_array(F.collect_list(F.struct("cx", "hid"))).alias("h")).where(F.size("h") >= 2)
    part = heads.select(*KEY, "x1", "x2", F.col("h.cx").alias("c"), F.posexplode("h").alias("n", "_"))
    mid = lambda i: (F.get("c", i) + F.get("c", i + 1)) / 2
    return part.select(*KEY, "n", F.when(F.col("n") == 0, F.col("x1")).otherwise(mid(F.col("n") - 1)).alias("lo"), F.coalesce(mid(F.col("n")), F.col("x2")).alias("hi"))


@query("c7_body_from_head", sql("SELECT run_id, frame_idx, track_id, round(0.5 * (0.5 * (0.5 * h0 + 0.5 * e0) + 0.5 * (0.2 * (y1 + 0.5 * h0 + 0.5 * e0) + 20.0)) + 0.5 * (0.2 * (y1 + 0.5 * (0.5 * h0 + 0.5 * e0) + 0.5 * (0.2 * (y1 + 0.5 * h0 + 0.5 * e0) + 20.0)) + 20.0), 6) AS h FROM (SELECT *, 2.0 * (y2 - y1) AS h0, 0.2 * (y1 + 2.0 * (y2 - y1)) + 20.0 AS e0 FROM v_box WHERE role = 'staff')"))
def c7(spark, sf):
    """Three damped steps towards the height that the plane expects at the feet."""
    start = 2.0 * (F.col("y2") - F.col("y1"))
    step = lambda h, _: 0.5 * h + 0.5 * (0.2 * (F.col("y1") + h) + 20.0)
    h = F.aggregate(F.sequence(F.lit(1), F.lit(3)), start, step)
    return boxes(spark, sf).where("role = 'staff'").select(*KEY, F.round(h, 6).alias("h"))


@query("c20_height_band", sql("SELECT run_id, CASE WHEN a > 0 AND (110.0 - b) / a >= 120.0 THEN round(least((110.0 - b) / a * 1.05, 1080.0), 4) END AS bottom FROM (SELECT run_id, regr_slope(y2 - y1, y2) AS a, regr_intercept(y2 - y1, y2) AS b FROM v_box GROUP BY run_id)"))
def c20(spark, sf):
    """The band of rows in which people are smaller than wanted; null if none or too thin."""
    f = boxes(spark, sf).groupBy("run_id").agg(F.regr_slope(F.col("y2") - F.col("y1"), "y2").alias("a"), F.regr_intercept(F.col("y2") - F.col("y1"), "y2").alias("b"))
    row = (110.0 - F.col("b")) / F.col("a")
    return f.select("run_id", F.when((F.col("a") > 0) & (row >= 120.0), F.round(F.least(row * 1.05, F.lit(1080.0)), 4)).alias("bottom"))


@query("c28_debounced_modality", sql("SELECT run_id, event_id, night FROM fold",
    "o AS (SELECT run_id, event_id, value, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS rn FROM v_event)",
    """fold AS (WITH RECURSIVE r AS (SELECT run_id, event_id, rn, false AS night, CASE WHEN value < 20.0 THEN 1 ELSE 0 END AS against FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.event_id, s.rn, CASE WHEN s.a >= 24 THEN NOT s.night ELSE s.night END, CASE WHEN s.a >= 24 THEN 0 ELSE s.a END FROM (SELECT o.*, r.night, CASE WHEN (o.value < 20.0 * CASE WHEN r.night THEN 1.35 ELSE 1.0 END) <> r.night THEN r.against + 1 ELSE 0 END AS a FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) s) SELECT * FROM r)"""))
def c28(spark, sf):
    """A value's side of a bar, with hysteresis, that changes after 24 disagreeing rows only."""
    e = table(spark, sf, "events").select(F.expr("cast(event_id div 5000 as int)").alias("run_id"), "event_id", "value")
    return D.debounced_side(e, 20.0, 1.35, 24)


@query("d14_isolated_boxes", sql("SELECT run_id, frame_idx, track_id FROM v_box a WHERE conf >= 0.5 AND NOT EXISTS (SELECT 1 FROM v_box b WHERE a.run_id = b.run_id AND a.frame_idx = b.frame_idx AND a.track_id <> b.track_id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2)"))
def d14(spark, sf):
    b = boxes(spark, sf)
    hit = D.pairs(b).where("x1 < o_x2 and o_x1 < x2 and y1 < o_y2 and o_y1 < y2").select(*KEY).distinct()
    return b.where("conf >= 0.5").join(hit, KEY, "left_anti").select(*KEY)


@query("d8_speed", sql("SELECT run_id, track_id, t, round(sqrt((gx - lag(gx) OVER w) * (gx - lag(gx) OVER w) + (gz - lag(gz) OVER w) * (gz - lag(gz) OVER w)) / (t - lag(t) OVER w), 4) AS mps FROM (SELECT *, ((x1 + x2) / 2 - 960.0) * 1.7 / (0.2 * y2 + 20.0) AS gx, " + repr(PLANE.focal) + " * 1.7 / (0.2 * y2 + 20.0) AS gz FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t)"))
def d8(spark, sf):
    gx, gz = PLANE.to_ground(fx(), fy())
    b = boxes(spark, sf).withColumn("gx", gx).withColumn("gz", gz)
    dx, dz, dt = (F.col(c) - F.lag(c).over(by_track()) for c in ("gx", "gz", "t"))
    return b.select("run_id", "track_id", "t", F.round(F.when(dt > 0, F.sqrt(dx * dx + dz * dz) / dt), 4).alias("mps"))


@query("d12_plane_sanity", sql("SELECT run_id, 1.7 / 0.2 NOT BETWEEN 1.8 AND 7.0 AS bad_height, (0.2 * max(y2) + 20.0) / (0.2 * min(y2) + 20.0) < 1.15 AS too_flat FROM v_box GROUP BY run_id"))
def d12(spark, sf):
    ratio = PLANE.expected_height(F.max("y2")) / PLANE.expected_height(F.min("y2"))
    return boxes(spark, sf).groupBy("run_id").agg(F.lit(not 1.8 <= PLANE.camera_height() <= 7.0).alias("bad_height"), (ratio < 1.15).alias("too_flat"))


@query("d21_straightness", sql("SELECT run_id, track_id, round(CASE WHEN n < 3 OR l1 < 1e-6 THEN 0.0 ELSE sqrt(CASE WHEN l2 < 1e-9 * l1 THEN 0.0 ELSE l2 END) / sqrt(l1) END, 5) AS bend FROM (SELECT *, (sx + sy) / 2 + sqrt((sx - sy) * (sx - sy) / 4 + c * c) AS l1, (sx + sy) / 2 - sqrt((sx - sy) * (sx - sy) / 4 + c * c) AS l2 FROM (SELECT run_id, track_id, count(*) AS n, var_pop(fx) AS sx, var_pop(y2) AS sy, covar_pop(fx, y2) AS c FROM (SELECT *, (x1 + x2) / 2 AS fx FROM v_box  ) GROUP BY ALL))"))
def d21(spark, sf):
    """Spread across the principal axis relative to the spread along it, from the covariance's eigenvalues; 0 for a track that stands or is straight to the last digits."""
    b = boxes(spark, sf)
    g = b.groupBy("run_id", "track_id").agg(F.count("*").alias("n"), F.var_pop(fx()).alias("sx"), F.var_pop(fy()).alias("sy"), F.covar_pop(fx(), fy()).alias("c"))
    mid, half = (F.col("sx") + F.col("sy")) / 2, F.sqrt((F.col("sx") - F.col("sy")) * (F.col("sx") - F.col("sy")) / 4 + F.col("c") * F.col("c"))
    across = F.when(mid - half < 1e-9 * (mid + half), 0.0).otherwise(mid - half)
    bend = F.when((F.col("n") < 3) | (mid + half < 1e-6), 0.0).otherwise(F.sqrt(across) / F.sqrt(mid + half))
    return g.select("run_id", "track_id", F.round(bend, 5).alias("bend"))


@query("d27_carried_activity", sql("SELECT run_id, track_id, t, last_value(act IGNORE NULLS) OVER w AS activity, t - last_value(CASE WHEN act IS NOT NULL THEN t END IGNORE NULLS) OVER w AS age FROM (SELECT *, CASE WHEN frame_idx % 8 = 0 THEN CASE WHEN y2 < 400 THEN 'far' ELSE 'near' END END AS act FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t ROWS UNBOUNDED PRECEDING)"))
def d27(spark, sf):
    """Sampled every eighth frame and carried forward with its age; never sampled is null."""
    w = by_track().rowsBetween(Window.unboundedPreceding, 0)
    act = F.when(F.col("frame_idx") % 8 == 0, F.when(F.col("y2") < 400, "far").otherwise("near"))
    b = boxes(spark, sf).withColumn("act", act)
    at = F.last(F.when(F.col("act").isNotNull(), F.col("t")), ignorenulls=True).over(w)
    return b.select("run_id", "track_id", "t", F.last("act", ignorenulls=True).over(w).alias("activity"), (F.col("t") - at).alias("age"))


@query("d30_blob_direction", sql("SELECT run_id, track_id, CASE WHEN a IS NULL OR b IS NULL OR a < b THEN 'in' ELSE 'out' END AS direction FROM (SELECT run_id, track_id, sum(t * (x2 - x1)) FILTER (y2 < 400) / sum(x2 - x1) FILTER (y2 < 400) AS a, sum(t * (x2 - x1)) FILTER (y2 >= 400) / sum(x2 - x1) FILTER (y2 >= 400) AS b FROM v_box GROUP BY ALL)"))
def d30(spark, sf):
    """The door's side first is inward; a missing side counts as inward."""
    w, door = F.col("x2") - F.col("x1"), F.col("y2") < 400
    mean = lambda c: F.sum(F.when(c, F.col("t") * w)) / F.sum(F.when(c, w))
    g = boxes(spark, sf).groupBy("run_id", "track_id").agg(mean(door).alias("a"), mean(~door).alias("b"))
    return g.select("run_id", "track_id", F.when(F.col("a").isNull() | F.col("b").isNull() | (F.col("a") < F.col("b")), "in").otherwise("out").alias("direction"))


@query("e16_seam_bridge", sql("SELECT run_id, tail, head, d FROM fold WHERE taken",
    "tl AS (SELECT run_id, track_id AS tail, arg_max((x1 + x2) / 2, t) AS tx, arg_max(y2, t) AS ty FROM v_box JOIN (SELECT run_id, max(t) AS e FROM v_box GROUP BY run_id) USING (run_id) WHERE t >= e - 1.0 GROUP BY run_id, track_id)",
    "hd AS (SELECT run_id - 1 AS run_id, track_id AS head, arg_min((x1 + x2) / 2, t) AS x, arg_min(y2, t) AS y FROM v_box JOIN (SELECT run_id, min(t) AS s FROM v_box GROUP BY run_id) USING (run_id) WHERE t <= s + 1.0 GROUP BY run_id, track_id)",
    "near AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY d, head, tail) AS rn FROM (SELECT run_id, tail, head, sqrt((tx - x) * (tx - x) + (ty - y) * (ty - y)) AS d FROM tl JOIN hd USING (run_id)) WHERE d <= 0.05 * 2202.9)",
    "fold AS (WITH RECURSIVE r AS (SELECT n.*, true AS taken, ['h' || head, 't' || tail] AS used FROM near n WHERE rn = 1 UNION ALL SELECT n.*, NOT (list_contains(r.used, 'h' || n.head) OR list_contains(r.used, 't' || n.tail)), CASE WHEN list_contains(r.used, 'h' || n.head) OR list_contains(r.used, 't' || n.tail) THEN r.used ELSE r.used || ['h' || n.head, 't' || n.tail] END FROM r JOIN near n ON n.run_id = r.run_id AND n.rn = r.rn + 1) SELECT * FROM r)"))
def e16(spark, sf):
    """Tails of a run and heads of the next one, nearest first, each used once; a seam has few of both."""
    from atrium.plans.identity import e17, e18

    tails = e17(spark, sf).select("run_id", F.col("track_id").alias("tail"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    heads = e18(spark, sf).select((F.col("run_id") - 1).alias("run_id"), F.col("track_id").alias("head"), "x", "y")
    d = F.sqrt((F.col("tx") - F.col("x")) * (F.col("tx") - F.col("x")) + (F.col("ty") - F.col("y")) * (F.col("ty") - F.col("y")))
    near = tails.join(heads, "run_id").withColumn("d", d).where(d <= 0.05 * 2202.9)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for r in pdf.sort_values(["d", "head", "tail"]).itertuples():
            if ("h", r.head) not in used and ("t", r.tail) not in used:
                used |= {("h", r.head), ("t", r.tail)}
                out.append((r.run_id, r.tail, r.head, r.d))
        return pd.DataFrame(out, columns=["run_id", "tail", "head", "d"])

    return near.groupBy("run_id").applyInPandas(pick, "run_id int, tail string, head string, d double")


@query("e25_ghost_crossings", sql("SELECT run_id, track_id, count(*) AS n FROM v_crossing ANTI JOIN (SELECT DISTINCT run_id, track_id FROM v_box WHERE conf >= 0.95) USING (run_id, track_id) GROUP BY ALL"))
def e25(spark, sf):
    seen = boxes(spark, sf).where("conf >= 0.95").select("run_id", "track_id").distinct()
    return crossings(spark, sf).join(seen, ["run_id", "track_id"], "left_anti").groupBy("run_id", "track_id").agg(F.count("*").alias("n"))


@query("h4_door_transitions", sql("SELECT run_id, track_id, t, px - x AS step FROM (SELECT *, lag(x) OVER w AS px, lag(y2) OVER w AS py, lag(t) OVER w AS pt FROM (SELECT *, (x1 + x2) / 2 AS x FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t)) WHERE x < 600.0 AND y2 BETWEEN 200.0 AND 600.0 AND NOT (px < 600.0 AND py BETWEEN 200.0 AND 600.0) AND abs(px - x) >= 60.0 AND t - pt <= 30.0"))
def h4(spark, sf):
    """From outside the door's band to inside, with some travel, within a gap."""
    b = boxes(spark, sf).withColumn("x", fx())
    for c, p in (("x", "px"), ("y2", "py"), ("t", "pt")):
        b = b.withColumn(p, F.lag(c).over(by_track()))
    now, was = F.expr("x < 600.0 and y2 between 200.0 and 600.0"), F.expr("px < 600.0 and py between 200.0 and 600.0")
    return b.where(now & ~was & (F.abs(F.col("px") - F.col("x")) >= 60.0) & (F.col("t") - F.col("pt") <= 30.0)).select("run_id", "track_id", "t", (F.col("px") - F.col("x")).alias("step"))


@query("h16_path_length", sql("SELECT run_id, track_id, round(coalesce(sum(d), 0.0), 3) AS path FROM (SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y2 - lag(y2) OVER w) * (y2 - lag(y2) OVER w)) AS d FROM (SELECT *, (x1 + x2) / 2 AS x FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t)) GROUP BY ALL"))
def h16(spark, sf):
    b = boxes(spark, sf).withColumn("x", fx())
    dx, dy = F.col("x") - F.lag("x").over(by_track()), F.col("y2") - F.lag("y2").over(by_track())
    return b.withColumn("d", F.sqrt(dx * dx + dy * dy)).groupBy("run_id", "track_id").agg(F.round(F.coalesce(F.sum("d"), F.lit(0.0)), 3).alias("path"))


@query("h14_patience_by_zone", sql("SELECT run_id, track_id, greatest(CASE WHEN x BETWEEN 100.0 AND 900.0 THEN 300 ELSE 0 END, CASE WHEN y BETWEEN 100.0 AND 500.0 THEN 180 ELSE 0 END, CASE WHEN NOT (x BETWEEN 100.0 AND 900.0) AND NOT (y BETWEEN 100.0 AND 500.0) THEN 120 ELSE 0 END) AS patience FROM (SELECT run_id, track_id, median((x1 + x2) / 2) AS x, median(y2) AS y FROM v_box GROUP BY ALL)"))
def h14(spark, sf):
    """The longest patience of the zones that hold the median foot, else the default."""
    m = boxes(spark, sf).groupBy("run_id", "track_id").agg(F.median(fx()).alias("x"), F.median(fy()).alias("y"))
    a, b = F.col("x").between(100.0, 900.0), F.col("y").between(100.0, 500.0)
    return m.select("run_id", "track_id", F.greatest(F.when(a, 300).otherwise(0), F.when(b, 180).otherwise(0), F.when(~a & ~b, 120).otherwise(0)).alias("patience"))


@query("i7_slow_places", sql("SELECT run_id, CAST(floor(x / 96.0) AS BIGINT) AS gx, CAST(floor(y2 / 96.0) AS BIGINT) AS gy, count(*) AS n FROM (SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y2 - lag(y2) OVER w) * (y2 - lag(y2) OVER w)) / (t - lag(t) OVER w) AS v FROM (SELECT *, (x1 + x2) / 2 AS x FROM v_box) WINDOW w AS (PARTITION BY run_id, track_id ORDER BY t)) WHERE v <= 8.8 GROUP BY 1, 2, 3 HAVING count(*) >= 10"))
def i7(spark, sf):
    b = boxes(spark, sf).withColumn("x", fx())
    dx, dy, dt = (F.col(c) - F.lag(c).over(by_track()) for c in ("x", "y2", "t"))
    slow = b.withColumn("v", F.when(dt > 0, F.sqrt(dx * dx + dy * dy) / dt)).where("v <= 8.8")
    return slow.groupBy("run_id", F.floor(F.col("x") / 96.0).alias("gx"), F.floor(F.col("y2") / 96.0).alias("gy")).agg(F.count("*").alias("n")).where("n >= 10")


@query("g57_live_separability", sql("SELECT run_id, count(*) FILTER (d) AS different, count(*) FILTER (s) AS same FROM (SELECT a.run_id, true AS d, false AS s FROM v_box a JOIN v_box b ON a.run_id = b.run_id AND a.frame_idx = b.frame_idx AND a.track_id < b.track_id UNION ALL SELECT run_id, false, true FROM (SELECT run_id, t - lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS g FROM v_box) WHERE g > 0 AND g <= 0.5) GROUP BY run_id"))
def g57(spark, sf):
    """Pairs seen together are different people; neighbouring sightings of one id are the same."""
    b = boxes(spark, sf)
    n = b.groupBy("run_id", "frame_idx").agg(F.count("*").alias("k")).groupBy("run_id").agg(F.sum(F.expr("cast(k * (k - 1) div 2 as bigint)")).alias("different"))
    g = b.withColumn("g", F.col("t") - F.lag("t").over(by_track())).groupBy("run_id").agg(F.count_if((F.col("g") > 0) & (F.col("g") <= 0.5)).alias("same"))
    return n.join(g, "run_id")


@query("n7_stride", sql("SELECT run_id, frame_idx, track_id FROM fold WHERE kept",
    "o AS (SELECT run_id, frame_idx, track_id, row_number() OVER (PARTITION BY run_id, track_id ORDER BY frame_idx) AS rn FROM v_box)",
    "fold AS (WITH RECURSIVE r AS (SELECT o.*, true AS kept, frame_idx AS last FROM o WHERE rn = 1 UNION ALL SELECT o.*, o.frame_idx - r.last >= 8, CASE WHEN o.frame_idx - r.last >= 8 THEN o.frame_idx ELSE r.last END FROM r JOIN o ON o.run_id = r.run_id AND o.track_id = r.track_id AND o.rn = r.rn + 1) SELECT * FROM r)"))
def n7(spark, sf):
    """Keeps a sighting eight frames or more after the track's last kept one."""
    return D.spaced(boxes(spark, sf).select(*KEY), ["run_id", "track_id"], "frame_idx", 8)


@query("n3_pending_keys", "SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ANTI JOIN (SELECT conv_id FROM conversations WHERE role = 'system') USING (conv_id)")
def n3(spark, sf):
    """Keys that a done-table does not hold yet."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id").distinct().join(c.where("role = 'system'"), "conv_id", "left_anti")


@query("n6_tracker_resets", sql("SELECT run_id, track_id, count(*) AS sightings, max(n) + 1 AS lives FROM (SELECT *, sum(CASE WHEN g > 60.0 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id ORDER BY t) AS n FROM (SELECT *, t - lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS g FROM v_box)) GROUP BY ALL"))
def n6(spark, sf):
    return runs_of(boxes(spark, sf), ["run_id", "track_id"], "t", 60.0).groupBy("run_id", "track_id").agg(F.count("*").alias("sightings"), F.max("run").alias("lives"))


@query("p26_modality_split", sql("SELECT run_id, threshold FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY score DESC, threshold) AS rn FROM (SELECT run_id, (v + nv) / 2 AS threshold, round((nv - v) / (slo + shi + 1e-9), 9) AS score FROM (SELECT *, lead(v) OVER (PARTITION BY run_id ORDER BY v) AS nv, coalesce(stddev_pop(v) OVER (PARTITION BY run_id ORDER BY v ROWS UNBOUNDED PRECEDING), 0) AS slo, coalesce(stddev_pop(v) OVER (PARTITION BY run_id ORDER BY v ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS shi, row_number() OVER (PARTITION BY run_id ORDER BY v) AS k, count(*) OVER (PARTITION BY run_id) AS n FROM (SELECT DISTINCT run_id, round(value, 6) AS v FROM v_event)) WHERE k >= 2 AND k <= n - 2)) WHERE rn = 1"))
def p26(spark, sf):
    """The cut between sorted readings of saturation (the events' values) with the widest gap relative to both sides' spread.

    Spreads come from running sums of the readings less their mean and of its squares, so a run costs one pass.
    """
    v = table(spark, sf, "events").select(F.expr("cast(event_id div 5000 as int)").alias("run_id"), F.round("value", 6).alias("v")).distinct()
    run = Window.partitionBy("run_id")
    w = run.orderBy("v")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumn("c", F.col("v") - F.avg("v").over(run))
    v = v.select("run_id", "v", F.lead("v").over(w).alias("nv"), F.row_number().over(w).alias("k"), F.count("*").over(run).alias("n"), F.sum("c").over(so_far).alias("s"), F.sum(F.col("c") * F.col("c")).over(so_far).alias("ss"), F.sum("c").over(run).alias("t"), F.sum(F.col("c") * F.col("c")).over(run).alias("tt"))
    spread = lambda s, ss, n: F.sqrt(F.greatest(ss / n - (s / n) * (s / n), F.lit(0.0)))
    lo, hi = spread(F.col("s"), F.col("ss"), F.col("k")), spread(F.col("t") - F.col("s"), F.col("tt") - F.col("ss"), F.greatest(F.col("n") - F.col("k"), F.lit(1)))
    score = F.round((F.col("nv") - F.col("v")) / (lo + hi + 1e-9), 9)
    c = v.where("k >= 2 and k <= n - 2").select("run_id", ((F.col("v") + F.col("nv")) / 2).alias("th"), score.alias("score"))
    return c.groupBy("run_id").agg(F.max_by("th", F.struct("score", -F.col("th"))).alias("threshold"))


@query("p45_best_box", sql("SELECT run_id, track_id, arg_max(frame_idx, (x2 - x1) * (y2 - y1) * 100000 - frame_idx) AS frame_idx FROM v_box GROUP BY ALL"))
def p45(spark, sf):
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return boxes(spark, sf).groupBy("run_id", "track_id").agg(F.max_by("frame_idx", area * 100000 - F.col("frame_idx")).alias("frame_idx"))


@query("p49_height_scales", sql("SELECT run_id, list_sort(list(y2 - y1))[CAST(floor(0.5 * (count(*) - 1)) AS INT) + 1] AS p50, round(list_sort(list(y2 - y1))[CAST(floor(0.5 * (count(*) - 1)) AS INT) + 1] * 1280 / 1920.0, 5) AS net FROM v_box GROUP BY run_id"))
def p49(spark, sf):
    p = floor_quantile(F.col("y2") - F.col("y1"), 0.5)
    return boxes(spark, sf).groupBy("run_id").agg(p.alias("p50"), F.round(p * 1280 / 1920.0, 5).alias("net"))


@query("p70_widened_windows", sql("SELECT run_id, track_id, least(coalesce(a, c), coalesce(c, a)) AS t0, greatest(coalesce(b, d), coalesce(d, b)) AS t1 FROM (SELECT run_id, track_id, min(t) AS a, max(t) AS b FROM v_box GROUP BY ALL) FULL JOIN (SELECT run_id, track_id, min(t) AS c, max(t) AS d FROM v_sighting GROUP BY ALL) USING (run_id, track_id)"))
def p70(spark, sf):
    from atrium.sources.adapters import sightings

    span = lambda d, a, b: d.groupBy("run_id", "track_id").agg(F.min("t").alias(a), F.max("t").alias(b))
    j = span(boxes(spark, sf), "a", "b").join(span(sightings(spark, sf), "c", "d"), ["run_id", "track_id"], "full")
    return j.select("run_id", "track_id", F.least("a", "c").alias("t0"), F.greatest("b", "d").alias("t1"))


@query("p73_median_boxes", sql("SELECT run_id, track_id, list_sort(list(x1))[count(*) // 2 + 1] AS x1, list_sort(list(y1))[count(*) // 2 + 1] AS y1, list_sort(list(x2))[count(*) // 2 + 1] AS x2, list_sort(list(y2))[count(*) // 2 + 1] AS y2 FROM v_box GROUP BY ALL"))
def p73(spark, sf):
    return boxes(spark, sf).groupBy("run_id", "track_id").agg(*[upper_median(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("p25_probe_vote", sql("SELECT run_id, max(value) FILTER (event_id % 500 = 0) < 12 OR min(value) FILTER (event_id % 500 = 0) < 6 AS night, count(*) FILTER (event_id % 500 = 0) AS probes FROM v_event GROUP BY run_id"))
def p25(spark, sf):
    """Ten evenly spaced probes of each run vote."""
    e = table(spark, sf, "events").select(F.expr("cast(event_id div 5000 as int)").alias("run_id"), F.when(F.col("event_id") % 500 == 0, F.col("value")).alias("v"), (F.col("event_id") % 500 == 0).alias("p"))
    return e.groupBy("run_id").agg(((F.max("v") < 12) | (F.min("v") < 6)).alias("night"), F.count_if("p").alias("probes"))


@query("p28_sample_deviation", sql("SELECT run_id, track_id, avg(x1) AS mean, CASE WHEN count(*) >= 2 THEN round(stddev_samp(x1), 6) END AS dev FROM v_box GROUP BY ALL"))
def p28(spark, sf):
    return boxes(spark, sf).groupBy("run_id", "track_id").agg(F.avg("x1").alias("mean"), F.round(F.when(F.count("*") >= 2, F.stddev_samp("x1")), 6).alias("dev"))


@query("p36_drop_ledger", sql("SELECT run_id, stage, count(*) AS n, min(frame_idx) AS first FROM (SELECT run_id, frame_idx, CASE WHEN conf < 0.35 THEN 'conf' WHEN y2 - y1 < 110 THEN 'height' END AS stage FROM v_box) WHERE stage IS NOT NULL GROUP BY ALL"))
def p36(spark, sf):
    stage = F.when(F.col("conf") < 0.35, "conf").when(F.col("y2") - F.col("y1") < 110, "height")
    return boxes(spark, sf).withColumn("stage", stage).where("stage is not null").groupBy("run_id", "stage").agg(F.count("*").alias("n"), F.min("frame_idx").alias("first"))


@query("p44_frame_renumbering", sql("SELECT run_id, frame_idx, dense_rank() OVER (PARTITION BY run_id ORDER BY frame_idx) AS n, count(*) AS boxes FROM v_box GROUP BY run_id, frame_idx"))
def p44(spark, sf):
    f = boxes(spark, sf).groupBy("run_id", "frame_idx").agg(F.count("*").alias("boxes"))
    return f.select("run_id", "frame_idx", F.row_number().over(Window.partitionBy("run_id").orderBy("frame_idx")).alias("n"), "boxes")


@query("e19_greedy_matches", sql("SELECT run_id, frame_idx, track_id, o_track_id, iou FROM fold WHERE taken",
    f"""ov AS (SELECT *, row_number() OVER (PARTITION BY run_id, frame_idx ORDER BY iou DESC, track_id, o_track_id) AS rn FROM (SELECT a.run_id, a.frame_idx, a.track_id, b.track_id AS o_track_id, {IOU} / ({AREA.format('a')} + {AREA.format('b')} - {IOU}) AS iou FROM v_box a JOIN v_box b ON a.run_id = b.run_id AND a.frame_idx = b.frame_idx AND a.role <> 'staff' AND b.role = 'staff') WHERE iou >= 0.1)""",
    "fold AS (WITH RECURSIVE r AS (SELECT o.*, true AS taken, ['a' || track_id, 'b' || o_track_id] AS used FROM ov o WHERE rn = 1 UNION ALL SELECT o.*, NOT (list_contains(r.used, 'a' || o.track_id) OR list_contains(r.used, 'b' || o.o_track_id)), CASE WHEN list_contains(r.used, 'a' || o.track_id) OR list_contains(r.used, 'b' || o.o_track_id) THEN r.used ELSE r.used || ['a' || o.track_id, 'b' || o.o_track_id] END FROM r JOIN ov o ON o.run_id = r.run_id AND o.frame_idx = r.frame_idx AND o.rn = r.rn + 1) SELECT * FROM r)"))
def e19(spark, sf):
    """Guests' boxes with those of staff."""
    b = boxes(spark, sf)
    return D.greedy_matches(b.where("role <> 'staff'"), b.where("role = 'staff'"), 0.1)


@query("e22_global_links")
def e22(spark, sf):
    from atrium.operators.identity import candidates, global_links
    from atrium.plans.identity import tracks

    t = tracks(spark, sf)
    return global_links(t, candidates(t, 7200.0), accept=0.2)
