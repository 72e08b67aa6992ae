"""Queries on masks, recovered bodies, live identities, learned zones and scores by window, point and condition (tables C, E, G, H, I, M, N and P of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import detections as D
from atrium.operators import scoring as S
from atrium.operators.intervals import range_join
from atrium.plans.detections import AREA, IOU
from atrium.plans.events import TRUTH, TRUTH_ROWS
from atrium.plans.registry import query
from atrium.plans.scoring import _found, _truth
from atrium.sources.adapters import boxes, crossings, sightings, sql, table

KEY = ["run_id", "frame_idx", "track_id"]


@query("c8_recovered_bodies", sql(
    """SELECT run_id, frame_idx, track_id, false AS inferred, round(conf, 6) AS conf, round(y2 - y1, 6) AS h FROM v_box WHERE role <> 'staff' UNION ALL
SELECT run_id, frame_idx, track_id, true, round(greatest(0.01, conf * 0.7), 6), round(0.5 * h2 + 0.5 * (0.2 * (y1 + h2) + 20.0), 6) FROM (SELECT *, 0.5 * h1 + 0.5 * (0.2 * (y1 + h1) + 20.0) AS h2 FROM (SELECT *, 0.5 * (2.0 * (y2 - y1)) + 0.5 * (0.2 * (y1 + 2.0 * (y2 - y1)) + 20.0) AS h1 FROM v_box h WHERE role = 'staff' AND conf >= 0.35 AND NOT EXISTS (SELECT 1 FROM v_box p WHERE p.run_id = h.run_id AND p.frame_idx = h.frame_idx AND p.role <> 'staff' AND (h.x1 + h.x2) / 2 BETWEEN p.x1 AND p.x2 AND (h.y1 + h.y2) / 2 BETWEEN p.y1 AND p.y2)))
WHERE 0.5 * h2 + 0.5 * (0.2 * (y1 + h2) + 20.0) >= 8"""))
def c8(spark, sf):
    """Persons, and a less certain body for each head without one; staff boxes stand for heads."""
    b = boxes(spark, sf)
    return D.recovered(b.where("role <> 'staff'"), b.where("role = 'staff'"), G.Plane(0.2, 20.0, 1920.0)).select(*KEY, "inferred", F.round("conf", 6).alias("conf"), F.round("h", 6).alias("h"))


MASK = [(280.3, 100.3), (1000.3, 100.3), (1000.3, 700.3), (280.3, 700.3)]
INSIDE = "x > 280.3 AND x < 1000.3 AND y > 100.3 AND y < 700.3"


@query("c10_dead_area", sql(
    """SELECT run_id, frame_idx, track_id, CASE WHEN NOT inside THEN true WHEN n = 0 THEN true ELSE NOT (span >= 30.0 AND spread < 12.0) END AS kept FROM (
SELECT m.run_id, m.frame_idx, m.track_id, m.inside, count(h.t) AS n, m.t - min(h.t) AS span, coalesce(max(sqrt((h.x - g.x) * (h.x - g.x) + (h.y - g.y) * (h.y - g.y))), 0.0) AS spread
FROM m LEFT JOIN m h ON m.inside AND h.inside AND h.run_id = m.run_id AND h.cx = m.cx AND h.cy = m.cy AND h.t < m.t AND m.t - h.t <= 60.0 AND sqrt((m.x - h.x) * (m.x - h.x) + (m.y - h.y) * (m.y - h.y)) <= 90.0
LEFT JOIN m g ON m.inside AND g.inside AND g.run_id = m.run_id AND g.cx = m.cx AND g.cy = m.cy AND g.t < m.t AND m.t - g.t <= 60.0 AND sqrt((m.x - g.x) * (m.x - g.x) + (m.y - g.y) * (m.y - g.y)) <= 90.0
GROUP BY m.run_id, m.frame_idx, m.track_id, m.inside, m.t)""",
    f"m AS (SELECT *, {INSIDE} AS inside, floor(x / 128) AS cx, floor(y / 128) AS cy FROM (SELECT run_id, frame_idx, track_id, t, (x1 + x2) / 2 AS x, y2 AS y FROM v_box))"))
def c10(spark, sf):
    """A mask drops only what stands still: half a minute of boxes at one spot that hardly spread."""
    return D.dead_area(boxes(spark, sf), MASK, need=12.0).select(*KEY, "kept")


@query("p21_phantom_members", sql("SELECT run_id, frame_idx, track_id FROM v_box b WHERE EXISTS (SELECT 1 FROM (VALUES (300.0, 200.0, 380.0, 330.0), (640.0, 400.0, 700.0, 530.0)) a(x1, y1, x2, y2) WHERE " + f"{IOU} / ({AREA.format('a')} + {AREA.format('b')} - {IOU}) >= 0.35)"))
def p21(spark, sf):
    """Boxes that overlap one of some fixed regions."""
    hit = F.lit(False)
    for r in ((300.0, 200.0, 380.0, 330.0), (640.0, 400.0, 700.0, 530.0)):
        hit = hit | (G.iou(tuple(map(F.lit, r)), G.box()) >= 0.35)
    return boxes(spark, sf).where(hit).select(*KEY)


PROVEN = """cl AS (SELECT *, CAST(floor((x1 + x2) / 2 / 64.0) AS BIGINT) AS gx, CAST(floor((y1 + y2) / 2 / 64.0) AS BIGINT) AS gy FROM v_box),
pv AS (SELECT run_id, gx, gy, min(t) FILTER (n >= 15) AS since FROM (SELECT *, count(*) OVER (PARTITION BY run_id, gx, gy ORDER BY t, track_id) AS n FROM cl) GROUP BY ALL HAVING count(*) >= 15)"""


def _cells(spark, sf):
    b = boxes(spark, sf)
    b = b.withColumn("gx", F.floor((F.col("x1") + F.col("x2")) / 2 / 64.0)).withColumn("gy", F.floor((F.col("y1") + F.col("y2")) / 2 / 64.0))
    n = F.row_number().over(Window.partitionBy("run_id", "gx", "gy").orderBy("t", "track_id"))
    b = b.withColumn("n", n)
    return b, b.where("n >= 15").groupBy("run_id", "gx", "gy").agg(F.min("t").alias("since"))


@query("p22_suppressor_drops", sql("SELECT c.run_id, count(*) AS seen, count(*) FILTER (c.t >= p.since) AS dropped FROM cl c LEFT JOIN pv p ON p.run_id = c.run_id AND p.gx = c.gx AND p.gy = c.gy GROUP BY c.run_id", PROVEN))
def p22(spark, sf):
    """From its fifteenth box on a place is proven and drops what comes."""
    b, proven = _cells(spark, sf)
    j = b.join(proven, ["run_id", "gx", "gy"], "left")
    return j.groupBy("run_id").agg(F.count("*").alias("seen"), F.count_if(F.col("t") >= F.col("since")).alias("dropped"))


@query("p23_suppressed_lookup", sql("SELECT c.run_id, c.frame_idx, c.track_id FROM cl c JOIN pv p ON p.run_id = c.run_id AND p.gx = c.gx AND p.gy = c.gy", PROVEN))
def p23(spark, sf):
    b, proven = _cells(spark, sf)
    return b.join(proven, ["run_id", "gx", "gy"], "left_semi").select(*KEY)


@query("p27_modality_labels", sql("SELECT event_id, CASE WHEN bimodal THEN CASE WHEN value <= 20.0 THEN 'infrared' ELSE 'colour' END ELSE CASE WHEN value < 8.0 THEN 'infrared' ELSE 'colour' END END AS modality FROM (SELECT event_id, value, max(value) OVER (PARTITION BY run_id) - min(value) OVER (PARTITION BY run_id) > 60 AS bimodal FROM v_event)"))
def p27(spark, sf):
    """A run of two kinds of light is cut at its own threshold, another at a fixed bar."""
    run = Window.partitionBy(F.expr("event_id div 5000"))
    two = F.max("value").over(run) - F.min("value").over(run) > 60
    return table(spark, sf, "events").select("event_id", F.when(F.when(two, F.col("value") <= 20.0).otherwise(F.col("value") < 8.0), "infrared").otherwise("colour").alias("modality"))


@query("p2_staff_contacts", sql("SELECT run_id, count(*) AS contacts, count(DISTINCT track_id) AS guests FROM contact GROUP BY run_id",
    """near AS (SELECT DISTINCT g.run_id, g.track_id, g.t FROM v_box g JOIN v_box s ON s.run_id = g.run_id AND s.frame_idx = g.frame_idx
WHERE g.role <> 'staff' AND s.role = 'staff' AND ((g.x1 + g.x2) / 2 - (s.x1 + s.x2) / 2) * ((g.x1 + g.x2) / 2 - (s.x1 + s.x2) / 2) + (g.y2 - s.y2) * (g.y2 - s.y2) <= 4 * (g.y2 - g.y1) * (g.y2 - g.y1))""",
    """runs AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p > 60.0 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id ORDER BY t) AS r FROM (SELECT *, lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS p FROM near)),
contact AS (SELECT run_id, track_id, min(t) AS t FROM runs GROUP BY run_id, track_id, r HAVING max(t) - min(t) >= 1.0)"""))
def p2(spark, sf):
    """Proximity to staff, then stretches of it."""
    from atrium.operators.answers import contacts
    from atrium.plans.answers import _near

    return contacts(_near(spark, sf), gap=60.0, least=1.0).groupBy("run_id").agg(F.count("*").alias("contacts"), F.count_distinct("track_id").alias("guests"))


# Live identities.


def detections(spark, sf, gap=60.0):
    from atrium.operators.memory import detections_of

    e = table(spark, sf, "embeddings")
    v = e.select(F.col("vec_id").cast("string").alias("track_id"), F.col("embedding").alias("vec"))
    return detections_of(boxes(spark, sf), v, gap)


def traded(spark, sf):
    """Tracks in pairs that walk together and overlap for four seconds of every eight, after each of which a tracker trades their ids:
    what they look like changes places. A raw id ends at a pause of six seconds."""
    d = detections(spark, sf, gap=6.0).withColumn("number", F.substring_index("raw", "#", 1).try_cast("int")).where("number is not null")
    other = F.when(F.col("number") % 2 == 0, F.col("number") + 1).otherwise(F.col("number") - 1)
    life = F.substring_index("raw", "#", -1)
    beside = d.withColumn("number", other).withColumn("x", F.col("x") + 30).withColumn("raw", F.concat_ws("#", F.col("number").cast("string"), life, F.lit("b")))
    d = d.unionByName(beside).withColumn("frozen", F.floor(F.col("t") / 4) % 2 == 1)
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("shown"), F.col("embedding").alias("vec"))
    return d.drop("vec").withColumn("shown", F.when(F.floor(F.col("t") / 8) % 2 == 1, other).otherwise(F.col("number"))).join(e, "shown", "left").drop("shown", "number")


@query("h20_live_identities")
def h20(spark, sf):
    """Identities of raw ids as a camera would give them, frame by frame; a stream and plain Python give the same in tests."""
    from atrium.operators.memory import live_identities

    return live_identities(detections(spark, sf)).select("run_id", "t", "raw", "canon")


@query("h22_undone_swaps")
def h22(spark, sf):
    """Tracks that traded ids while they overlapped, and trade them back when they are free."""
    from atrium.operators.memory import live_identities

    return live_identities(traded(spark, sf)).where("swapped is not null").select("run_id", "t", "raw", "canon", "swapped")


@query("h23_remembered_crops")
def h23(spark, sf):
    """For each identity how often its appearance was taken from a better crop, and how often only its place."""
    from atrium.operators.memory import live_identities

    g = live_identities(detections(spark, sf)).groupBy("run_id", "canon")
    return g.agg(F.count_if("crop").alias("crops"), F.count_if(~F.col("crop")).alias("places"), F.max_by("raw", F.struct("t", "raw")).alias("last_raw"))


@query("n5_forgotten_identities")
def n5(spark, sf):
    """How many identities a memory of five minutes and one of half an hour know of each run."""
    from atrium.operators.memory import identities_known

    return identities_known(detections(spark, sf), {"short": 300.0, "long": 1800.0})


# Learned zones and plans.


@query("i5_entry_windows", sql(
    "SELECT run_id, w, doors, place, CASE WHEN place = 'busiest' THEN true ELSE false END AS sealed, w % 2 = 1 AS held_out FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY run_id ORDER BY doors, w) = 1 THEN 'quiet' WHEN row_number() OVER (PARTITION BY run_id ORDER BY doors DESC, w) = 1 THEN 'busiest' ELSE 'busy' END AS place, row_number() OVER (PARTITION BY run_id ORDER BY doors, w) AS up, row_number() OVER (PARTITION BY run_id ORDER BY doors DESC, w) AS down FROM (SELECT run_id, CAST(floor(t / 60) AS BIGINT) AS w, count(DISTINCT track_id) FILTER (line = 'side door') AS doors FROM v_crossing GROUP BY ALL)) WHERE up = 1 OR down <= 7"))
def i5(spark, sf):
    """Eight windows of each run to be labelled: the quietest, and the busiest at the door, of which the first is sealed."""
    g = crossings(spark, sf).groupBy("run_id", F.floor(F.col("t") / 60).alias("w")).agg(F.count_distinct(F.when(F.col("line") == "side door", F.col("track_id"))).alias("doors"))
    rank = lambda order: F.row_number().over(Window.partitionBy("run_id").orderBy(order, "w"))
    g = g.withColumn("up", rank(F.col("doors"))).withColumn("down", rank(F.desc("doors"))).where("up = 1 or down <= 7")
    place = F.when(F.col("up") == 1, "quiet").when(F.col("down") == 1, "busiest").otherwise("busy")
    return g.select("run_id", "w", "doors", place.alias("place"), (place == "busiest").alias("sealed"), (F.col("w") % 2 == 1).alias("held_out"))


@query("i6_zone_proposals", sql(
    """SELECT run_id, x1, y1, x2, y2, births, deaths, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY round(score, 9) DESC, root) AS rn FROM (SELECT *, (births + deaths) * (0.5 + 0.5 * least(births, deaths) / greatest(births, deaths)) * CASE WHEN least(x1 / 1920, y1 / 1080, (1920 - x2) / 1920, (1080 - y2) / 1080) <= 0.06 THEN 1.25 ELSE 1.0 END AS score FROM (
SELECT k.run_id, k.root, k.x1, k.y1, k.x2, k.y2, count(*) FILTER (e.birth) AS births, count(*) FILTER (NOT e.birth) AS deaths FROM cells k JOIN ends e ON e.run_id = k.run_id AND e.x BETWEEN k.x1 AND k.x2 AND e.y BETWEEN k.y1 AND k.y2 GROUP BY ALL))) WHERE rn <= 3""",
    "ends AS (SELECT run_id, true AS birth, arg_min((x1 + x2) / 2, t) AS x, arg_min(y2, t) AS y FROM v_box GROUP BY run_id, track_id UNION ALL SELECT run_id, false, arg_max((x1 + x2) / 2, t), arg_max(y2, t) FROM v_box GROUP BY run_id, track_id)",
    "seed AS (SELECT run_id, CAST(floor(x / 96.0) AS BIGINT) AS gx, CAST(floor(y / 96.0) AS BIGINT) AS gy FROM ends GROUP BY ALL HAVING count(*) >= 3)",
    "reach AS (WITH RECURSIVE rr AS (SELECT run_id, gx, gy, gx * 1000 + gy AS o FROM seed UNION SELECT s.run_id, s.gx, s.gy, rr.o FROM rr JOIN seed s ON s.run_id = rr.run_id AND abs(s.gx - rr.gx) <= 1 AND abs(s.gy - rr.gy) <= 1) SELECT * FROM rr)",
    "cells AS (SELECT run_id, root, min(gx) * 96.0::DOUBLE AS x1, min(gy) * 96.0::DOUBLE AS y1, (max(gx) + 1) * 96.0::DOUBLE AS x2, (max(gy) + 1) * 96.0::DOUBLE AS y2 FROM (SELECT run_id, gx, gy, min(o) AS root FROM reach GROUP BY ALL) GROUP BY ALL)"))
def i6(spark, sf):
    """Of each run the three places at which tracks begin and end most evenly."""
    from atrium.operators.learned import entry_zones

    return entry_zones(boxes(spark, sf), 1920.0, 1080.0).select("run_id", "x1", "y1", "x2", "y2", "births", "deaths", F.round("score", 6).alias("score"))


# Scores.


@query("e20_points_in_boxes", sql(
    "SELECT run_id, frame_idx, p, track_id FROM fold WHERE taken",
    "pts AS (SELECT run_id, frame_idx, track_id AS p, x1 + 12.0 AS x, y1 + 12.0 AS y FROM v_box WHERE CAST(regexp_replace(track_id, 'm', '') AS INT) % 2 = 0)",
    "hit AS (SELECT *, row_number() OVER (PARTITION BY run_id, frame_idx ORDER BY p, track_id) AS rn FROM (SELECT q.run_id, q.frame_idx, q.p, b.track_id FROM pts q JOIN v_box b ON b.run_id = q.run_id AND b.frame_idx = q.frame_idx AND q.x BETWEEN b.x1 AND b.x2 AND q.y BETWEEN b.y1 AND b.y2))",
    "fold AS (WITH RECURSIVE r AS (SELECT h.*, true AS taken, ['p' || p, 'b' || track_id] AS used FROM hit h WHERE rn = 1 UNION ALL SELECT h.*, NOT (list_contains(r.used, 'p' || h.p) OR list_contains(r.used, 'b' || h.track_id)), CASE WHEN list_contains(r.used, 'p' || h.p) OR list_contains(r.used, 'b' || h.track_id) THEN r.used ELSE r.used || ['p' || h.p, 'b' || h.track_id] END FROM r JOIN hit h ON h.run_id = r.run_id AND h.frame_idx = r.frame_idx AND h.rn = r.rn + 1) SELECT * FROM r)"))
def e20(spark, sf):
    """Each labelled point takes the first box that holds it and is free."""
    b = boxes(spark, sf)
    p = b.where("cast(regexp_replace(track_id, 'm', '') as int) % 2 = 0").select("run_id", "frame_idx", F.col("track_id").alias("p"), (F.col("x1") + 12.0).alias("x"), (F.col("y1") + 12.0).alias("y"))
    return D.points_in_boxes(p, b)


@query("e21_optimal_pairs")
def e21(spark, sf):
    """Pairs of the assignment at IoU 0.5; a brute-force test stands for SQL."""
    return S.frame_matches(_truth(spark, sf), _found(spark, sf)).where("abs(alpha - 0.5) < 1e-9").select("run_id", "frame_idx", "gt", "pr")


@query("b12_error_boxes")
def b12(spark, sf):
    """Truth that nothing was matched with, and findings that match nothing, with their boxes to a tenth."""
    return S.errors(_truth(spark, sf), _found(spark, sf), 0.5)


@query("g43_scores_by_condition", sql("SELECT * FROM (SELECT run_id, 'bright' AS condition, 1.0::DOUBLE AS hota, false AS weakest FROM v_box WHERE track_id NOT LIKE 'm%' AND frame_idx % 2 = 0 GROUP BY run_id UNION ALL SELECT run_id, 'dark', 0.0::DOUBLE, true FROM v_box WHERE track_id NOT LIKE 'm%' AND frame_idx % 2 = 1 GROUP BY run_id)"))
def g43(spark, sf):
    """A tracker that is perfect in one light and sees nothing in the other: each condition has its score, and the weakest is named."""
    t = _truth(spark, sf)
    dark = F.when(F.col("frame_idx") % 2 == 1, "dark").otherwise("bright").alias("condition")
    t = t.select("run_id", "frame_idx", "track_id", "x1", "y1", "x2", "y2", dark)
    # Left of the frame, where no truth is, however wide it is.
    away = lambda c, other: F.when(F.col("condition") == "dark", -1.0 - F.col(other)).otherwise(F.col(c)).alias(c)
    return S.by_condition(t, t.select("run_id", "frame_idx", "track_id", away("x1", "x2"), "y1", away("x2", "x1"), "y2", "condition")).select("run_id", "condition", "hota", "weakest")


@query("p43_packages_scored", sql("SELECT DISTINCT run_id AS package, 1.0::DOUBLE AS hota FROM v_box WHERE track_id NOT LIKE 'm%'"))
def p43(spark, sf):
    """One score for each package; a run with its labels is one."""
    t = _truth(spark, sf)
    return S.hota(t, t).select(F.col("run_id").alias("package"), "hota")


@query("e23_assigned_costs")
def e23(spark, sf):
    """The cheapest assignment of a run's fragments that end to those that begin: total likeness and pairs; a brute-force test stands for SQL."""
    from atrium.operators.identity import candidates, global_links
    from atrium.plans.identity import tracks

    t = tracks(spark, sf)
    c = candidates(t)
    links = global_links(t, c, accept=0.4)
    return links.join(c, ["run_id", "a", "b"]).groupBy("run_id").agg(F.count("*").alias("pairs"), F.round(F.sum("sim"), 6).alias("likeness"))


@query("e24_global_over_groups")
def e24(spark, sf):
    """Identities of the greedy pass as one fragment each, linked once more so that the total cost is least; groups are never split."""
    from atrium.operators.identity import link_groups
    from atrium.plans.merging import merged, tracks

    return link_groups(tracks(spark, sf), merged(spark, sf))


FALSE = (40.0, 100.0, 300.0, 610.5)
REVERSALS = ((40.0, 40.5), (300.0, 301.5))


@query("m10_rule_scores", sql(
    f"""SELECT e.run_id, count(*) AS events, (SELECT count(*) FROM (VALUES {', '.join(f'({x})' for x in FALSE)}) f(a) WHERE EXISTS (SELECT 1 FROM ev x WHERE x.run_id = e.run_id AND abs(x.t - f.a) <= 0.6)) AS false_present,
(SELECT count(*) FROM ev x JOIN truth w ON x.t >= w.w0 AND x.t <= w.w1 WHERE x.run_id = e.run_id AND NOT w.tuned) AS held_emitted, (SELECT CAST(sum(expected) AS BIGINT) FROM truth WHERE NOT tuned) AS held_truth,
(SELECT count(*) FROM ev x JOIN truth w ON x.t >= w.w0 AND x.t <= w.w1 WHERE x.run_id = e.run_id AND w.tuned) AS tuned_emitted, (SELECT CAST(sum(expected) AS BIGINT) FROM truth WHERE tuned) AS tuned_truth,
(SELECT count(*) FROM (VALUES {', '.join(f'({a}, {b})' for a, b in REVERSALS)}) v(a, b) WHERE EXISTS (SELECT 1 FROM ev x WHERE x.run_id = e.run_id AND abs(x.t - v.a) <= 0.6) AND EXISTS (SELECT 1 FROM ev x WHERE x.run_id = e.run_id AND abs(x.t - v.b) <= 0.6)) AS reversals FROM ev e GROUP BY e.run_id""",
    TRUTH, "ev AS (SELECT run_id, t FROM v_crossing WHERE x < 500.0)"))
def m10(spark, sf):
    """What a rule keeps: all events, known false ones, events in held-out and tuned windows against their truth, and impossible reversals."""
    return S.rule_scores(crossings(spark, sf).where("x < 500.0"), FALSE, 0.6, TRUTH_ROWS, REVERSALS)


@query("p37_x_cut", sql("SELECT run_id, CASE WHEN count(*) FILTER (x IS NULL) = 0 THEN count(*) FILTER (x < 181) END AS kept, count(*) FILTER (x IS NULL) > 0 AS not_applicable FROM (SELECT run_id, CASE WHEN run_id % 2 = 1 AND CAST(t * 4 AS INT) % 9 = 0 THEN NULL ELSE x END AS x FROM v_crossing) GROUP BY run_id"))
def p37(spark, sf):
    """Events before a column; where one has no place the rule can't be judged, which is no pass."""
    x = F.when((F.col("run_id") % 2 == 1) & ((F.col("t") * 4).cast("int") % 9 == 0), None).otherwise(F.col("x"))
    c = crossings(spark, sf).withColumn("x", x).groupBy("run_id").agg(F.count_if(F.col("x") < 181).alias("n"), F.count_if(F.col("x").isNull()).alias("missing"))
    return c.select("run_id", F.when(F.col("missing") == 0, F.col("n")).alias("kept"), (F.col("missing") > 0).alias("not_applicable"))


@query("p38_truth_from_json", sql("SELECT run_id, w, CAST(n AS INT) AS expected, w % 3 = 2 AS tuned FROM (SELECT run_id, CAST(floor(t / 100) AS BIGINT) AS w, count(*) FILTER (direction = 'in') AS n FROM v_crossing GROUP BY ALL)"))
def p38(spark, sf):
    """Windows with their truth, written as JSON and read again; a count that is not stated is the number of entries."""
    from atrium.sources.readers import truth_windows

    g = crossings(spark, sf).groupBy("run_id", F.floor(F.col("t") / 100).alias("w")).agg(F.collect_list(F.when(F.col("direction") == "in", F.col("t"))).alias("entries"))
    doc = F.to_json(F.struct(F.array(F.col("w") * 100.0, F.col("w") * 100.0 + 100.0).alias("window_s"), F.when(F.col("w") % 2 == 0, F.size("entries")).alias("truth_count"), "entries"))
    docs = g.select("run_id", F.concat(F.lit("entries_"), F.col("w").cast("string"), F.when(F.col("w") % 3 == 2, "_tuned").otherwise("")).alias("name"), doc.alias("value"))
    t = truth_windows(docs, ["run_id", "name"])
    return t.select("run_id", F.round(F.col("w0") / 100).cast("long").alias("w"), "expected", F.col("name").endswith("_tuned").alias("tuned"))


@query("m11_label_set_check", sql("SELECT run_id, count(*) FILTER (truth = 0) = 0 AS no_quiet, count(*) FILTER (w % 2 = 1) = 0 AS nothing_held_out, count(*) FILTER (w % 2 = 1 AND truth >= 3) = 0 AS no_group_held_out FROM (SELECT run_id, CAST(floor(t / 100) AS BIGINT) AS w, count(*) FILTER (direction = 'in' AND line = 'bar line') AS truth FROM v_crossing GROUP BY ALL) GROUP BY run_id"))
def m11(spark, sf):
    """What a set of labels lacks: a quiet window, a held-out one, a held-out group."""
    at_bar = (F.col("direction") == "in") & (F.col("line") == "bar line")
    g = crossings(spark, sf).groupBy("run_id", F.floor(F.col("t") / 100).alias("w")).agg(F.count_if(at_bar).alias("truth"))
    none = lambda c: F.count_if(c) == 0
    held = F.col("w") % 2 == 1
    return g.groupBy("run_id").agg(none(F.col("truth") == 0).alias("no_quiet"), none(held).alias("nothing_held_out"), none(held & (F.col("truth") >= 3)).alias("no_group_held_out"))


SCORED = "SELECT r.run_id, w0, expected, count(c.t) AS got, least(count(c.t), expected) AS hits, greatest(count(c.t) - expected, 0) AS extra FROM (SELECT DISTINCT run_id FROM v_crossing WHERE {c}) r CROSS JOIN truth w LEFT JOIN v_crossing c ON c.run_id = r.run_id AND {d} AND c.t >= w0 - {s} AND c.t <= w1 + {s} {h} GROUP BY r.run_id, w0, expected"


def _scored(events, slack, rows=TRUTH_ROWS):
    return S.windows_scored(events, rows, slack).select("run_id", "w0", "expected", "got", "hits", "extra")


@query("m12_entry_scores", sql(SCORED.format(c="direction = 'in'", d="c.direction = 'in'", s="1.5", h=""), TRUTH))
def m12(spark, sf):
    """All entries against the truth of each window, widened by a second and a half."""
    return _scored(crossings(spark, sf).where("direction = 'in'"), 1.5)


@query("m13_line_entry_scores", sql(SCORED.format(c="direction = 'in' AND line = 'entry line'", d="c.direction = 'in' AND c.line = 'entry line'", s="3.0", h=""), TRUTH))
def m13(spark, sf):
    return _scored(crossings(spark, sf).where("direction = 'in' and line = 'entry line'"), 3.0)


@query("p41_held_out_scores", sql(SCORED.format(c="direction = 'in' AND line = 'side door'", d="c.direction = 'in' AND c.line = 'side door'", s="0.0", h="WHERE NOT tuned"), TRUTH))
def p41(spark, sf):
    """A door's entries in held-out windows, bounds included."""
    return _scored(crossings(spark, sf).where("direction = 'in' and line = 'side door'"), 0.0, [r for r in TRUTH_ROWS if not r[3]])
