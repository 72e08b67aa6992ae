"""Queries on zones, lines, anchors, planes and lenses (tables A, C, D, K, M and P of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import zones as Z
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, sql, table

SIZE = (1280.0, 720.0)
KEY = ["run_id", "frame_idx", "track_id"]


def configs(spark, sf):
    """One JSON configuration for each supplier: three zones, a line, and a frame size for every other one."""
    s = F.col("s_suppkey")
    x0, y0 = s * 37 % 900, s * 53 % 400
    p = lambda *xy: F.array(*[F.array(F.lit(x).cast("int"), F.lit(y).cast("int")) if isinstance(x, int) else F.array((x).cast("int"), (y).cast("int")) for x, y in xy])
    room = p((x0, y0), (x0 + 400, y0), (x0 + 400, y0 + 300), (x0 + 200, y0 + 150), (x0, y0 + 300))
    desk = F.when(s % 4 == 0, p((100, 100), (300, 300), (300, 100), (100, 300))).otherwise(p((100, 100), (300, 100), (300, 300), (100, 300)))
    mask = F.when(s % 3 == 0, p((x0, y0), (x0 + 400, y0), (x0 + 400, y0 + 300), (x0, y0 + 300))).when(s % 3 == 1, p((x0, y0), (x0 + 190, y0), (x0 + 190, y0 + 170), (x0, y0 + 170))).otherwise(p((1500, 900), (1600, 900), (1600, 1000), (1500, 1000)))
    line = p((s * 61 % 1000, s * 29 % 600), (s * 61 % 1000 + s % 150, s * 29 % 600 + 40))
    text = F.to_json(F.struct(
        F.struct(room.alias("room"), desk.alias("desk"), mask.alias("mask")).alias("polygons"),
        F.when(s % 2 == 1, F.struct(line.alias("entry line"))).alias("entry_lines"),
        F.when(s % 2 == 0, line).alias("entry_line"),
        F.when(s % 2 == 0, F.array(F.lit(1920), F.lit(1080))).alias("frame_size"),
        F.struct(F.lit("wait").alias("room"), F.array(F.lit("desk"), F.lit("staff")).alias("desk"), F.lit("mask").alias("mask")).alias("roles"),
    ))
    return table(spark, sf, "supplier").select(s.alias("camera"), text.alias("value"))


CONFIG = """cfg AS (SELECT s_suppkey AS s, s_suppkey * 37 % 900 AS x0, s_suppkey * 53 % 400 AS y0, s_suppkey * 61 % 1000 AS p, s_suppkey * 29 % 600 AS q FROM supplier),
rv AS (SELECT s, v.zone, v.i, CAST(v.x AS DOUBLE) AS x, CAST(v.y AS DOUBLE) AS y FROM cfg, LATERAL (VALUES ('room', 0, x0, y0), ('room', 1, x0 + 400, y0), ('room', 2, x0 + 400, y0 + 300), ('room', 3, x0 + 200, y0 + 150), ('room', 4, x0, y0 + 300),
  ('desk', 0, 100, 100), ('desk', 1, 300, CASE WHEN s % 4 = 0 THEN 300 ELSE 100 END), ('desk', 2, 300, CASE WHEN s % 4 = 0 THEN 100 ELSE 300 END), ('desk', 3, 100, 300),
  ('mask', 0, CASE s % 3 WHEN 2 THEN 1500 ELSE x0 END, CASE s % 3 WHEN 2 THEN 900 ELSE y0 END), ('mask', 1, CASE s % 3 WHEN 0 THEN x0 + 400 WHEN 1 THEN x0 + 190 ELSE 1600 END, CASE s % 3 WHEN 2 THEN 900 ELSE y0 END),
  ('mask', 2, CASE s % 3 WHEN 0 THEN x0 + 400 WHEN 1 THEN x0 + 190 ELSE 1600 END, CASE s % 3 WHEN 0 THEN y0 + 300 WHEN 1 THEN y0 + 170 ELSE 1000 END), ('mask', 3, CASE s % 3 WHEN 2 THEN 1500 ELSE x0 END, CASE s % 3 WHEN 0 THEN y0 + 300 WHEN 1 THEN y0 + 170 ELSE 1000 END)) v(zone, i, x, y)),
rl AS (SELECT s, CASE WHEN s % 2 = 0 THEN 'entry' ELSE 'entry line' END AS line, CAST(p AS DOUBLE) AS x1, CAST(q AS DOUBLE) AS y1, CAST(p + s % 150 AS DOUBLE) AS x2, CAST(q + 40 AS DOUBLE) AS y2 FROM cfg),
most AS (SELECT s, max(x) AS mx, max(y) AS my FROM (SELECT s, x, y FROM rv UNION ALL SELECT s, x1, y1 FROM rl UNION ALL SELECT s, x2, y2 FROM rl) GROUP BY s),
sc AS (SELECT s, CASE WHEN s % 2 = 0 THEN CAST(1280 AS DOUBLE) / 1920 WHEN mx > 1280 OR my > 720 THEN CAST(1280 AS DOUBLE) / mx ELSE 1.0 END AS sx, CASE WHEN s % 2 = 0 THEN CAST(720 AS DOUBLE) / 1080 WHEN mx > 1280 OR my > 720 THEN CAST(720 AS DOUBLE) / my ELSE 1.0 END AS sy FROM most),
zv AS (SELECT s AS camera, zone, i, trunc(x * sx) AS x, trunc(y * sy) AS y FROM rv JOIN sc USING (s)),
zl AS (SELECT s AS camera, line, trunc(x1 * sx) AS x1, trunc(y1 * sy) AS y1, trunc(x2 * sx) AS x2, trunc(y2 * sy) AS y2 FROM rl JOIN sc USING (s)),
ze AS (SELECT camera, zone, i, x AS ax, y AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yb, count(*) OVER (PARTITION BY camera, zone) AS n FROM zv WINDOW w AS (PARTITION BY camera, zone ORDER BY i))"""


def zones(spark, sf):
    return Z.zone_config(configs(spark, sf), "camera", "value", SIZE)[0]


def lines(spark, sf):
    return Z.zone_config(configs(spark, sf), "camera", "value", SIZE)[1]


@query("a8_zone_config", sql("SELECT camera, zone AS name, CASE zone WHEN 'room' THEN 'wait' WHEN 'desk' THEN 'desk,staff' ELSE 'mask' END AS roles, CAST(i AS INT) AS i, x, y FROM zv UNION ALL SELECT camera, line, 'line', 0, x1, y1 FROM zl UNION ALL SELECT camera, line, 'line', 1, x2, y2 FROM zl", CONFIG))
def a8(spark, sf):
    z, li = Z.zone_config(configs(spark, sf), "camera", "value", SIZE)
    v = z.select("camera", F.col("zone").alias("name"), F.array_join("roles", ",").alias("roles"), F.posexplode("vertices").alias("i", "v")).select("camera", "name", "roles", "i", "v.x", "v.y")
    ends = F.posexplode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))))
    return v.unionByName(li.select("camera", F.col("line").alias("name"), F.lit("line").alias("roles"), ends.alias("i", "v")).select("camera", "name", "roles", "i", "v.x", "v.y"))


@query("p30_scaled_lines", sql("SELECT s AS camera, line, x1 * 0.25 AS x1, y1 * 0.25 AS y1, x2 * 0.25 AS x2, y2 * 0.25 AS y2 FROM rl", CONFIG))
def p30(spark, sf):
    """Lines of 1920 x 1080 frames in a mask of 480 x 270."""
    c = configs(spark, sf).withColumn("value", F.regexp_replace("value", r'"frame_size":\[1920,1080\]', '"frame_size":[1280,720]'))
    lone = Z.zone_config(c.where("camera % 2 = 0"), "camera", "value", SIZE)[1]
    named = Z.zone_config(c.where("camera % 2 = 1").withColumn("value", F.regexp_replace("value", r"^\{", '{"frame_size":[1280,720],')), "camera", "value", SIZE)[1]
    return lone.unionByName(named).select("camera", "line", *[(F.col(k) * 480 / 1920).alias(k) for k in ("x1", "y1", "x2", "y2")])


def _constant(x, y):
    return F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in zip(x, y, strict=True)])


@query("c12_anchor_choice", sql("SELECT run_id, frame_idx, track_id, z.zone, (x1 + x2) / 2 AS ax, CASE WHEN z.zone = 'desk' THEN (y1 + y2) / 2 ELSE y2 END AS ay FROM v_box, (VALUES ('desk'), ('room')) z(zone)"))
def c12(spark, sf):
    b = boxes(spark, sf).withColumn("zone", F.explode(F.array(F.lit("desk"), F.lit("room"))))
    ax, ay = Z.anchor(F.col("zone").isin("desk"))
    return b.select(*KEY, "zone", ax.alias("ax"), ay.alias("ay"))


ROOM = [(100.0, 100.0), (1200.0, 100.0), (1200.0, 600.0), (650.0, 350.0), (100.0, 600.0)]
CARD = " + ".join(f"CASE WHEN ({ay} > y) <> ({by} > y) AND x < ({bx} - {ax}) * (y - {ay}) / ({by} - {ay} + 1e-9) + {ax} THEN 1 ELSE 0 END" for (ax, ay), (bx, by) in zip(ROOM, ROOM[1:] + ROOM[:1], strict=True))


@query("c15_points_in_polygon", sql(f"SELECT run_id, count(*) FILTER (({CARD}) % 2 = 1) AS inside, count(*) AS n FROM (SELECT run_id, x, y FROM v_crossing) GROUP BY run_id"))
def c15(spark, sf):
    """The scorecard's rule: the small number is added to the denominator of every edge."""
    from atrium.sources.adapters import crossings

    hit = G.inside(F.col("x"), F.col("y"), ROOM, 1e-9, always=True)
    return crossings(spark, sf).groupBy("run_id").agg(F.count_if(hit).alias("inside"), F.count("*").alias("n"))


SIGNED = """ps AS (SELECT b.run_id, b.frame_idx, b.track_id, b.conf, b.w, e.zone, (b.x1 + b.x2) / 2 AS x, CASE WHEN e.zone = 'desk' THEN (b.y1 + b.y2) / 2 ELSE b.y2 END AS y, e.ax, e.ay, e.bx, e.yb FROM (SELECT *, greatest(x2 - x1, 1.0) AS w, run_id % (SELECT count(*) FROM supplier) AS camera FROM v_box) b JOIN ze e ON e.camera = b.camera AND e.zone <> 'mask'),
pt AS (SELECT *, least(greatest(((x - ax) * (bx - ax) + (y - ay) * (yb - ay)) / greatest((bx - ax) * (bx - ax) + (yb - ay) * (yb - ay), 1e-12), 0.0), 1.0) AS t FROM ps),
sd AS (SELECT run_id, frame_idx, track_id, conf, w, zone, sqrt(min((x - (ax + t * (bx - ax))) * (x - (ax + t * (bx - ax))) + (y - (ay + t * (yb - ay))) * (y - (ay + t * (yb - ay))))) * CASE WHEN sum(CASE WHEN (ay > y) <> (yb > y) AND x < (bx - ax) * (y - ay) / CASE WHEN yb = ay THEN 1e-12 ELSE yb - ay END + ax THEN 1 ELSE 0 END) % 2 = 1 THEN 1 ELSE -1 END AS d FROM pt GROUP BY ALL),
zc AS (SELECT *, row_number() OVER (PARTITION BY run_id, frame_idx, track_id ORDER BY round(d, 9) DESC, zone) AS rn FROM sd)"""
ZONED = "SELECT run_id, frame_idx, track_id, CASE WHEN d >= 0 THEN zone END AS zone, CASE WHEN d >= 0 THEN round(least(greatest(0.5 + d / w, 0.0), 1.0) * CASE WHEN conf >= 0.6 THEN 1.0 ELSE 0.5 END, 3) ELSE 0.0 END AS zone_conf FROM zc WHERE rn = 1"


def _zoned(spark, sf):
    """Each run is filmed by the camera whose number it has, round by round."""
    n = table(spark, sf, "supplier").count()
    z = zones(spark, sf).where("zone <> 'mask'").select("camera", "zone", F.array_contains("roles", "staff").alias("centre"), "vertices")
    b = boxes(spark, sf).withColumn("camera", F.col("run_id") % n)
    return Z.zone_and_confidence(b, z, ["camera"], KEY, F.col("conf") >= 0.6)


@query("d25_zone_confidence", sql(ZONED, CONFIG, SIGNED))
def d25(spark, sf):
    return _zoned(spark, sf)


@query("d28_observation_rows", sql(
    f"SELECT 'r' || b.run_id AS run_id, 'cam' || b.run_id AS camera_id, b.frame_idx, b.t AS t_s, round(b.x1, 1) AS x1, round(b.y1, 1) AS y1, round(b.x2, 1) AS x2, round(b.y2, 1) AS y2, round(b.conf, 4) AS det_conf, b.track_id AS raw_track_id, CASE WHEN b.track_id LIKE 'm%' THEN substr(b.track_id, 2) ELSE b.track_id END AS canon_id, CASE WHEN b.conf >= 0.35 THEN b.run_id || ':' || b.track_id END AS emb_id, z.zone, z.zone_conf, (b.x1 + b.x2) / 2 AS foot_x, b.y2 AS foot_y, CASE WHEN b.y2 - b.y1 >= 110 THEN 'near' ELSE 'far' END AS place FROM v_box b JOIN ({ZONED}) z USING (run_id, frame_idx, track_id)", CONFIG, SIGNED))
def d28(spark, sf):
    """One wide row for each box: what was measured, or null."""
    j = boxes(spark, sf).join(_zoned(spark, sf), KEY)
    text = lambda prefix: F.concat(F.lit(prefix), F.col("run_id").cast("string"))
    return j.select(
        text("r").alias("run_id"), text("cam").alias("camera_id"), "frame_idx", F.col("t").alias("t_s"), *[F.round(c, 1).alias(c) for c in ("x1", "y1", "x2", "y2")], F.round("conf", 4).alias("det_conf"),
        F.col("track_id").alias("raw_track_id"), F.regexp_replace("track_id", "^m", "").alias("canon_id"), F.when(F.col("conf") >= 0.35, F.concat_ws(":", "run_id", "track_id")).alias("emb_id"), "zone", "zone_conf",
        ((F.col("x1") + F.col("x2")) / 2).alias("foot_x"), F.col("y2").alias("foot_y"), F.when(F.col("y2") - F.col("y1") >= 110, "near").otherwise("far").alias("place"),
    )


@query("k17_doors_from_zones", sql("SELECT camera, sum(x) / count(*) AS x, sum(y) / count(*) AS y FROM zv WHERE zone = 'desk' GROUP BY camera", CONFIG))
def k17(spark, sf):
    """The mean vertex of each zone with a wanted role; desks stand for entries."""
    z = zones(spark, sf).where(F.arrays_overlap("roles", F.array(F.lit("desk"))))
    mean = lambda c: F.aggregate("vertices", F.lit(0.0), lambda s, v: s + v[c]) / F.size("vertices")
    return z.select("camera", mean("x").alias("x"), mean("y").alias("y"))


@query("m3_polygon_validation", sql(
    "SELECT camera, zone, n >= 3 AS enough, NOT bool_or(outside) AS in_frame, coalesce(bool_or(crossing), false) AS crosses FROM (SELECT a.camera, a.zone, a.n, NOT (a.ax BETWEEN 0 AND 1.2 * 640 AND a.ay BETWEEN 0 AND 1.2 * 360) AS outside, ((b.ay - a.ay) * (a.bx - a.ax) > (a.yb - a.ay) * (b.ax - a.ax)) <> ((b.yb - a.ay) * (a.bx - a.ax) > (a.yb - a.ay) * (b.bx - a.ax)) AND ((b.yb - a.ay) * (b.ax - a.ax) > (b.ay - a.ay) * (b.bx - a.ax)) <> ((b.yb - a.yb) * (b.ax - a.bx) > (b.ay - a.yb) * (b.bx - a.bx)) AS crossing FROM ze a LEFT JOIN ze b ON b.camera = a.camera AND b.zone = a.zone AND b.i > a.i + 1 AND NOT (a.i = 0 AND b.i = a.n - 1)) GROUP BY camera, zone, n", CONFIG))
def m3(spark, sf):
    """Enough vertices, all near the frame, and no edge that crosses another; the frame is taken to be 640 x 360."""
    near = F.forall("vertices", lambda v: v["x"].between(0, 1.2 * 640) & v["y"].between(0, 1.2 * 360))
    return zones(spark, sf).select("camera", "zone", (F.size("vertices") >= 3).alias("enough"), near.alias("in_frame"), Z.crosses_itself(F.col("vertices")).alias("crosses"))


PIP = "(SELECT count(*) FILTER ((e.ay > {y}) <> (e.yb > {y}) AND {x} < (e.bx - e.ax) * ({y} - e.ay) / CASE WHEN e.yb = e.ay THEN 1e-12 ELSE e.yb - e.ay END + e.ax) % 2 = 1 FROM ze e WHERE e.camera = {c} AND e.zone = '{z}')"


def _masked(spark, sf):
    m = zones(spark, sf).where("zone = 'mask'").select("camera", F.col("vertices").alias("mask"))
    return m


@query("m2_mask_swallows_zone", sql(
    f"SELECT camera, zone, CASE WHEN share >= 0.6 THEN 'ERROR' WHEN share >= 0.25 THEN 'WARN' ELSE 'OK' END AS verdict, round(share, 6) AS share FROM (SELECT camera, zone, count(*) FILTER (masked) / count(*) AS share FROM (SELECT g.camera, g.zone, {PIP.format(x='g.x', y='g.y', c='g.camera', z='mask')} AS masked FROM grid g WHERE {PIP.format(x='g.x', y='g.y', c='g.camera', z='room')}) GROUP BY camera, zone)",
    CONFIG, "grid AS (SELECT camera, zone, (i + 0.5) * 20.0::DOUBLE AS x, (j + 0.5) * 20.0::DOUBLE AS y FROM (SELECT camera, zone, CAST(floor(min(x) / 20) AS INT) AS a, CAST(ceil(max(x) / 20) AS INT) AS b, CAST(floor(min(y) / 20) AS INT) AS c, CAST(ceil(max(y) / 20) AS INT) AS d FROM zv WHERE zone = 'room' GROUP BY ALL), LATERAL (SELECT unnest(range(a, b + 1))) u(i), LATERAL (SELECT unnest(range(c, d + 1))) v(j))"))
def m2(spark, sf):
    """How much of a zone a mask covers, by points of a grid."""
    j = zones(spark, sf).where("zone = 'room'").join(_masked(spark, sf), "camera")
    share = Z.grid_share(F.col("vertices"), lambda x, y: G.inside_array(x, y, F.col("mask")), 20.0)
    j = j.select("camera", "zone", share.alias("share"))
    return j.select("camera", "zone", F.when(F.col("share") >= 0.6, "ERROR").when(F.col("share") >= 0.25, "WARN").otherwise("OK").alias("verdict"), F.round("share", 6).alias("share"))


@query("m4_entry_line_validation", sql(
    f"SELECT camera, line, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) < greatest(20.0, 0.08 * sqrt(1280.0 * 1280.0 + 720.0 * 720.0)) AS short, least(x1, y1, 1280.0 - x1, 720.0 - y1) > 0.12 * 720.0 OR least(x2, y2, 1280.0 - x2, 720.0 - y2) > 0.12 * 720.0 AS open_end, {PIP.format(x='l.x1', y='l.y1', c='l.camera', z='mask')} OR {PIP.format(x='l.x2', y='l.y2', c='l.camera', z='mask')} OR {PIP.format(x='((l.x1 + l.x2) / 2)', y='((l.y1 + l.y2) / 2)', c='l.camera', z='mask')} AS masked FROM zl l", CONFIG))
def m4(spark, sf):
    """Too short to cross, an end that people can walk around, and a start, middle or end under a mask."""
    j = lines(spark, sf).join(_masked(spark, sf), "camera")
    x1, y1, x2, y2 = G.box()
    w, h = SIZE
    edge = lambda x, y: F.least(x, y, w - x, h - y)
    under = lambda x, y: G.inside_array(x, y, F.col("mask"))
    length = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    return j.select(
        "camera", "line", (length < max(20.0, 0.08 * (w * w + h * h) ** 0.5)).alias("short"), ((edge(x1, y1) > 0.12 * h) | (edge(x2, y2) > 0.12 * h)).alias("open_end"),
        (under(x1, y1) | under(x2, y2) | under((x1 + x2) / 2, (y1 + y2) / 2)).alias("masked"),
    )


@query("p29_line_under_mask", sql(
    "SELECT camera, line, round(count(*) FILTER (m) / 201, 6) AS share FROM (SELECT s.camera, s.line, s.i, count(*) FILTER ((e.ay > s.y) <> (e.yb > s.y) AND s.x < (e.bx - e.ax) * (s.y - e.ay) / CASE WHEN e.yb = e.ay THEN 1e-12 ELSE e.yb - e.ay END + e.ax) % 2 = 1 AS m FROM (SELECT camera, line, i, x1 + (x2 - x1) * i / 200 AS x, y1 + (y2 - y1) * i / 200 AS y FROM zl, range(201) r(i)) s JOIN ze e ON e.camera = s.camera AND e.zone = 'mask' GROUP BY ALL) GROUP BY ALL", CONFIG))
def p29(spark, sf):
    j = lines(spark, sf).join(_masked(spark, sf), "camera")
    return j.select("camera", "line", F.round(Z.samples_inside(*G.box(), lambda x, y: G.inside_array(x, y, F.col("mask"))), 6).alias("share"))


@query("p8_zone_gaps", sql("SELECT s AS camera, 'seating' AS missing FROM cfg UNION ALL SELECT s, 'entry line' FROM cfg WHERE s % 2 = 0", CONFIG))
def p8(spark, sf):
    """Roles and lines that each camera needs and has not."""
    c = configs(spark, sf).select("camera")
    need = c.select("camera", F.explode(F.array(F.lit("wait"), F.lit("seating"), F.lit("entry line"))).alias("missing"))
    have = zones(spark, sf).select("camera", F.explode("roles").alias("missing")).unionByName(lines(spark, sf).select("camera", F.col("line").alias("missing")))
    return need.join(have, ["camera", "missing"], "left_anti")


# Planes: coefficients are columns, one row for each supplier; some have no plane.
PLANES = "pl AS (SELECT s_suppkey AS camera, CASE WHEN s_suppkey % 7 = 0 THEN 0.0 ELSE 0.05 + s_suppkey % 40 / 100.0::DOUBLE END AS a, s_suppkey % 90 - 60.0::DOUBLE AS b, 400.0::DOUBLE + s_suppkey % 300 AS y FROM supplier)"


def planes(spark, sf):
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(s.alias("camera"), F.when(s % 7 == 0, 0.0).otherwise(0.05 + s % 40 / 100.0).alias("a"), (s % 90 - 60.0).alias("b"), (400.0 + s % 300).alias("y"))


FOCAL = G.Plane(1.0, 0.0, 1920.0).focal


@query("d1_plane_coefficients", sql(f"SELECT camera, a > 1e-6 AS ok, CASE WHEN a > 1e-6 THEN round({FOCAL!r}::DOUBLE, 6) END AS focal FROM pl", PLANES))
def d1(spark, sf):
    ok = F.col("a") > 1e-6
    return planes(spark, sf).select("camera", ok.alias("ok"), F.when(ok, F.round(F.lit(FOCAL), 6)).alias("focal"))


@query("d10_height_and_horizon", sql("SELECT camera, CASE WHEN a > 1e-6 THEN round(1.7 / a, 6) END AS height_m, CASE WHEN a > 1e-6 THEN round(-b / a, 6) END AS horizon FROM pl", PLANES))
def d10(spark, sf):
    ok = F.col("a") > 1e-6
    return planes(spark, sf).select("camera", F.when(ok, F.round(1.7 / F.col("a"), 6)).alias("height_m"), F.when(ok, F.round(-F.col("b") / F.col("a"), 6)).alias("horizon"))


@query("p14_horizon_row", sql("SELECT camera, round(-b / a, 6) AS horizon, -b / a BETWEEN 0 AND 1080 AS in_frame FROM pl WHERE a > 1e-6", PLANES))
def p14(spark, sf):
    h = -F.col("b") / F.col("a")
    return planes(spark, sf).where("a > 1e-6").select("camera", F.round(h, 6).alias("horizon"), h.between(0, 1080).alias("in_frame"))


HEIGHT = "CASE WHEN a > 1e-6 AND a * y + b > 1e-6 THEN a * y + b END"


def _height():
    h = F.col("a") * F.col("y") + F.col("b")
    return F.when((F.col("a") > 1e-6) & (h > 1e-6), h)


@query("d5_expected_heights", sql(f"SELECT camera, round({HEIGHT}, 6) AS px FROM pl", PLANES))
def d5(spark, sf):
    return planes(spark, sf).select("camera", F.round(_height(), 6).alias("px"))


@query("d6_scales", sql(f"SELECT camera, round(1.7 / ({HEIGHT}), 8) AS metres FROM pl", PLANES))
def d6(spark, sf):
    return planes(spark, sf).select("camera", F.round(1.7 / _height(), 8).alias("metres"))


@query("d9_pixels_for_metres", sql(f"SELECT camera, round(2.5 / (1.7 / ({HEIGHT})), 6) AS px FROM pl", PLANES))
def d9(spark, sf):
    return planes(spark, sf).select("camera", F.round(2.5 / (1.7 / _height()), 6).alias("px"))


@query("d11_scale_references", sql(f"SELECT camera, got, want FROM (SELECT camera, round(120.0 * 1.7 / ({HEIGHT}), 6) AS got, 0.5::DOUBLE + camera % 30 / 10.0 AS want FROM pl) WHERE abs(got - want) / want > 0.35", PLANES))
def d11(spark, sf):
    """Planes that measure 120 pixels at a row far from what they are known to be."""
    p = planes(spark, sf).select("camera", F.round(120.0 * 1.7 / _height(), 6).alias("got"), (0.5 + F.col("camera") % 30 / 10.0).alias("want"))
    return p.where(F.abs(F.col("got") - F.col("want")) / F.col("want") > 0.35)


@query("p13_rebuilt_planes", sql(f"SELECT run_id, camera, round({HEIGHT}, 6) AS px FROM (SELECT r.run_id, p.* FROM (SELECT DISTINCT run_id FROM v_event) r JOIN pl p ON p.camera = r.run_id % (SELECT count(*) FROM supplier))", PLANES))
def p13(spark, sf):
    """A run's plane from the stored coefficients of its camera."""
    from atrium.sources.adapters import sightings

    n = table(spark, sf, "supplier").count()
    runs = sightings(spark, sf).select("run_id").distinct().withColumn("camera", F.col("run_id") % n)
    return runs.join(planes(spark, sf), "camera").select("run_id", "camera", F.round(_height(), 6).alias("px"))


# Points of a floor of tiles, as a camera of each supplier sees them.
TILES = [(0, 0), (3, 0), (3, 2), (0, 2), (1, 5)]
MATRIX = "1200.0 + camera % 50, 40.0, 300.0 + camera % 70, 25.0, -900.0 - camera % 30, 1000.0, 0.05, 0.2, 1.0"


def correspondences(spark, sf):
    """camera, i, tx, ty (tile) and x, y (pixel) through a known matrix."""
    c = F.col("camera")
    h = [1200.0 + c % 50, F.lit(40.0), 300.0 + c % 70, F.lit(25.0), -900.0 - c % 30, F.lit(1000.0), F.lit(0.05), F.lit(0.2), F.lit(1.0)]
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"))
    tiles = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(a)).alias("tx"), F.lit(float(b)).alias("ty")) for i, (a, b) in enumerate(TILES)])
    p = s.select("camera", F.explode(tiles).alias("t")).select("camera", "t.*")
    tx, ty = F.col("tx"), F.col("ty")
    w = h[6] * tx + h[7] * ty + h[8]
    return p.select("camera", "i", "tx", "ty", ((h[0] * tx + h[1] * ty + h[2]) / w).alias("x"), ((h[3] * tx + h[4] * ty + h[5]) / w).alias("y"))


SEEN = f"""tile AS (SELECT s_suppkey AS camera, v.i, v.tx, v.ty FROM supplier, (VALUES {', '.join(f'({i}, {a}.0::DOUBLE, {b}.0::DOUBLE)' for i, (a, b) in enumerate(TILES))}) v(i, tx, ty)),
seen AS (SELECT camera, i, tx, ty, ((1200.0 + camera % 50) * tx + 40.0 * ty + 300.0 + camera % 70) / (0.05 * tx + 0.2 * ty + 1.0) AS x, (25.0 * tx + (-900.0 - camera % 30) * ty + 1000.0) / (0.05 * tx + 0.2 * ty + 1.0) AS y FROM tile)"""


@query("d2_plane_from_points", sql("SELECT camera, round(tx, 5) AS gx, round(ty, 5) AS gy, CAST(i AS INT) AS i FROM tile", SEEN))
def d2(spark, sf):
    """A homography fitted to each camera's points brings the pixels back to their tiles."""
    from atrium.operators.calibration import homographies

    p = correspondences(spark, sf)
    h = F.col("h")
    w = h[6] * F.col("x") + h[7] * F.col("y") + h[8]
    got = p.join(homographies(p, "camera", ("x", "y"), ("tx", "ty")), "camera")
    clean = lambda v: F.round(v, 5) + 0.0
    return got.select("camera", clean((h[0] * F.col("x") + h[1] * F.col("y") + h[2]) / w).alias("gx"), clean((h[3] * F.col("x") + h[4] * F.col("y") + h[5]) / w).alias("gy"), "i")


RESIDUALS = """res AS (SELECT a.camera, a.i AS i, b.i AS j, 0.3 * sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty)) AS want, CASE WHEN a.y > 450 AND b.y > 450 THEN sqrt(((a.x - 960) / (a.y - 450) - (b.x - 960) / (b.y - 450)) * ((a.x - 960) / (a.y - 450) - (b.x - 960) / (b.y - 450)) + (900 / (a.y - 450) - 900 / (b.y - 450)) * (900 / (a.y - 450) - 900 / (b.y - 450))) END AS got FROM seen a JOIN seen b ON a.camera = b.camera AND a.i < b.i)"""


def _residuals(spark, sf):
    """Distances of all pairs of a camera's few points, on the floor and through a plane with its horizon at row 450."""
    p = correspondences(spark, sf)
    ok = F.col("y") > 450
    p = p.select("camera", "i", "tx", "ty", F.when(ok, (F.col("x") - 960) / (F.col("y") - 450)).alias("gx"), F.when(ok, 900 / (F.col("y") - 450)).alias("gz"))
    o = p.select("camera", *[F.col(c).alias(f"o_{c}") for c in ("i", "tx", "ty", "gx", "gz")])
    d = lambda a, b: F.sqrt((F.col(a) - F.col(f"o_{a}")) * (F.col(a) - F.col(f"o_{a}")) + (F.col(b) - F.col(f"o_{b}")) * (F.col(b) - F.col(f"o_{b}")))
    return p.join(o, "camera").where("i < o_i").select("camera", "i", F.col("o_i").alias("j"), (0.3 * d("tx", "ty")).alias("want"), d("gx", "gz").alias("got"))


@query("d16_tile_residuals", sql("SELECT camera, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(want, 6) AS want, round(got, 6) AS got, round(abs(got - want), 6) AS error FROM res", SEEN, RESIDUALS))
def d16(spark, sf):
    r = _residuals(spark, sf)
    return r.select("camera", "i", "j", F.round("want", 6).alias("want"), F.round("got", 6).alias("got"), F.round(F.abs(F.col("got") - F.col("want")), 6).alias("error"))


@query("p46_plane_verdicts", sql("SELECT camera, bool_and(got IS NOT NULL) AND max(abs(got - want)) <= 2.0 AS ok, CASE WHEN bool_and(got IS NOT NULL) THEN round(max(abs(got - want)), 6) END AS worst FROM res GROUP BY camera", SEEN, RESIDUALS))
def p46(spark, sf):
    """A pair that cannot be mapped fails the plane."""
    mapped, worst = F.bool_and(F.col("got").isNotNull()), F.max(F.abs(F.col("got") - F.col("want")))
    return _residuals(spark, sf).groupBy("camera").agg((mapped & (worst <= 2.0)).alias("ok"), F.when(mapped, F.round(worst, 6)).alias("worst"))


@query("p47_evidence", "SELECT s_suppkey AS camera, s_suppkey % 4 = 3 OR s_suppkey % 9 >= 5 AS enough FROM supplier")
def p47(spark, sf):
    """Four points always fit: only a fifth or a held-out one is evidence."""
    s = F.col("s_suppkey")
    n_fit, n_check = s % 9, F.when(s % 4 == 3, 1).otherwise(0)
    return table(spark, sf, "supplier").select(s.alias("camera"), ((n_check > 0) | (n_fit >= 5)).alias("enough"))


@query("p48_tile_places", sql("SELECT camera, CAST(i AS INT) AS i, tx * 0.3 AS x, ty * 0.3 AS z FROM tile", SEEN))
def p48(spark, sf):
    return correspondences(spark, sf).select("camera", "i", (F.col("tx") * 0.3).alias("x"), (F.col("ty") * 0.3).alias("z"))


@query("d24_synthetic_camera", "SELECT s, CASE WHEN zc > 1e-6 THEN round(960.0 + 1200.0 * x / zc, 5) END AS px, CASE WHEN zc > 1e-6 THEN round(540.0 + 1200.0 * yv / zc, 5) END AS py FROM (SELECT *, z * cos(radians(t)) - 3.0 * sin(radians(t)) AS zc, z * sin(radians(t)) + 3.0 * cos(radians(t)) AS yv FROM (SELECT s_suppkey AS s, s_suppkey % 11 - 5.0::DOUBLE AS x, s_suppkey % 13 + 0.0::DOUBLE AS z, s_suppkey % 40 + 0.0::DOUBLE AS t FROM supplier))")
def d24(spark, sf):
    """Floor points seen by tilted cameras three metres up; null behind the camera."""
    s = F.col("s_suppkey")
    px, py = G.project(s % 11 - 5.0, s % 13 + 0.0, F.lit(0.0), s % 40 + 0.0, 3.0, 1200.0, (1920.0, 1080.0))
    return table(spark, sf, "supplier").select(s.alias("s"), F.round(px, 5).alias("px"), F.round(py, 5).alias("py"))


@query("d19_fisheye_horizons", "SELECT s_suppkey AS s, CASE WHEN s_suppkey % 30 > 0 THEN round(sqrt(1 / (3 * (s_suppkey % 30 / 100.0))) * 2 / 3, 8) END AS r FROM supplier")
def d19(spark, sf):
    """The largest radius that a barrel lens images; none without distortion."""
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(s.alias("s"), F.round(G.fisheye_horizon(-(s % 30) / 100.0), 8).alias("r"))


def _perimeter() -> str:
    at = [(f"x1 + (x2 - x1) * {i / 4}", y) for i in range(5) for y in ("y1", "y2")] + [(x, f"y1 + (y2 - y1) * {i / 4}") for i in range(5) for x in ("x1", "x2")]
    return ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(at))


@query("d20_boxes_in_source", sql(
    f"SELECT run_id, frame_idx, track_id, round(min(sx), 5) AS x1, round(min(sy), 5) AS y1, round(max(sx), 5) AS x2, round(max(sy), 5) AS y2 FROM (SELECT run_id, frame_idx, track_id, (px - 960.0) * f + 960.0 AS sx, (py - 540.0) * f + 540.0 AS sy FROM (SELECT *, 1 - 0.08 * ((px - 960.0) * (px - 960.0) + (py - 540.0) * (py - 540.0)) / (960.0 * 960.0 + 540.0 * 540.0) AS f FROM (SELECT b.*, p.px, p.py FROM v_box b, LATERAL (VALUES {_perimeter()}) p(i, px, py)))) GROUP BY ALL"))
def d20(spark, sf):
    """The box around a box's mapped outline, of which five points a side are taken."""
    return boxes(spark, sf).select(*KEY, *[F.round(c, 5).alias(n) for c, n in zip(G.box_to_source(G.box(), -0.08, 1920.0, 1080.0), ("x1", "y1", "x2", "y2"), strict=True)])


@query("d22_lens_fit", "SELECT s_suppkey AS camera, round(-0.02 - s_suppkey % 20 / 100.0, 3) AS k, true AS straight FROM supplier")
def d22(spark, sf):
    """Straight lines bent by a known lens: the fit finds the lens again."""
    from atrium.operators.calibration import fit_lenses

    k = -0.02 - F.col("s_suppkey") % 20 / 100.0
    straight = [(0, 300.0, 250.0, 1600.0, 250.0), (1, 400.0, 850.0, 1500.0, 800.0), (2, 350.0, 200.0, 350.0, 900.0)]
    ends = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, ("line", "ax", "ay", "bx", "by"), strict=True)]) for row in straight])
    p = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"), k.alias("k"), F.explode(ends).alias("e")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(8))))
    x = F.col("e.ax") + (F.col("e.bx") - F.col("e.ax")) * F.col("i") / 8
    y = F.col("e.ay") + (F.col("e.by") - F.col("e.ay")) * F.col("i") / 8
    sx, sy = G.fisheye_to_source(x, y, F.col("k"), 1920.0, 1080.0)
    found = fit_lenses(p.select("camera", F.col("e.line").alias("line"), sx.alias("x"), sy.alias("y")), "camera", (1920.0, 1080.0))
    return found.select("camera", F.round("k", 3).alias("k"), (F.col("rms") < 1e-4).alias("straight"))


@query("d15_robust_plane", sql("SELECT DISTINCT run_id, 0.21::DOUBLE AS a, 12.0::DOUBLE + run_id % 9 AS b FROM v_event"))
def d15(spark, sf):
    """Boxes whose height is linear in the foot's row, but for every fifth: RANSAC finds the line."""
    from atrium.operators.calibration import robust_planes

    b = boxes(spark, sf)
    true = 0.21 * F.col("y2") + 12.0 + F.col("run_id") % 9
    h = F.when(F.pmod(F.crc32(F.concat_ws("-", "frame_idx", "track_id").cast("binary")), F.lit(5)) == 0, true * 1.6 + 40).otherwise(true)
    d = b.select("run_id", "frame_idx", "track_id", F.lit(0.0).alias("x1"), (h / 3).alias("x2"), (F.col("y2") - h).alias("y1"), "y2")
    return robust_planes(d, 1080.0).select("run_id", F.round("a", 3).alias("a"), F.round("b", 1).alias("b"))


@query("d3_plane_choice", sql("SELECT camera, CASE WHEN camera % 4 = 3 THEN 'exact' WHEN a > 1e-6 THEN 'auto' ELSE 'none' END AS plane FROM pl", PLANES))
def d3(spark, sf):
    """A plane from measured points wins over one from heights; without either there is none."""
    p = planes(spark, sf)
    points = correspondences(spark, sf).where("camera % 4 = 3").select("camera").distinct().withColumn("exact", F.lit(True))
    return p.join(points, "camera", "left").select("camera", F.when(F.col("exact"), "exact").when(F.col("a") > 1e-6, "auto").otherwise("none").alias("plane"))


@query("p59_plane_findings", sql("SELECT camera, 'height' AS finding FROM pl WHERE a > 1e-6 AND 1.7 / a NOT BETWEEN 1.8 AND 7.0 UNION ALL SELECT camera, 'no plane' FROM pl WHERE a <= 1e-6 UNION ALL SELECT camera, 'flat' FROM pl WHERE a > 1e-6 AND a * 200 + b > 0 AND (a * 1080 + b) / (a * 200 + b) < 1.15", PLANES))
def p59(spark, sf):
    """Cameras whose plane is missing, puts them at an unlikely height, or hardly changes from top to bottom."""
    a, b = F.col("a"), F.col("b")
    ok, low = a > 1e-6, a * 200 + b
    found = F.array(F.when(~ok, "no plane"), F.when(ok & ~(1.7 / F.when(ok, a)).between(1.8, 7.0), "height"), F.when(ok & (low > 0) & ((a * 1080 + b) / F.when(low != 0, low) < 1.15), "flat"))
    return planes(spark, sf).select("camera", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("finding"))


@query("d32_calibration_cosine", "SELECT a.vec_id, CASE WHEN a.vec_id % 7 = 0 OR a.vec_id % 11 = 0 THEN 0.0 ELSE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) END AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 3")
def d32(spark, sf):
    """A missing or zero vector is like nothing: 0."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    n = F.col("vec_id")
    own = F.when(n % 7 != 0, F.when(n % 11 == 0, F.transform("embedding", lambda v: v * 0)).otherwise(F.col("embedding")))
    o = e.select((n - 3).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(o, "vec_id").select("vec_id", F.round(G.cosine(own, F.col("other")), 5).alias("cosine"))


@query("g66_disk_estimates", sql("SELECT run_id, count(*) AS rows, round(count(*) * 280 / 1e6, 6) AS rows_mb, round(count(DISTINCT frame_idx) * 0.311, 6) AS frames_mb FROM v_box GROUP BY run_id"))
def g66(spark, sf):
    """What a run's rows and proxy frames take."""
    n = F.count("*")
    return boxes(spark, sf).groupBy("run_id").agg(n.alias("rows"), F.round(n * 280 / 1e6, 6).alias("rows_mb"), F.round(F.count_distinct("frame_idx") * 0.311, 6).alias("frames_mb"))
