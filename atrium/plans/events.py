"""Queries on zone events, intervals and crossings (tables F, G, H and E of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.operators import crossings as cross
from atrium.operators.intervals import clip, complement, merge, range_join, total
from atrium.operators.occupancy import minute_summaries, runs_of, spans, timeline, zone_events
from atrium.plans.registry import query
from atrium.sources.adapters import crossings, sightings, sql

#: Zone events of all lengths; Z in SQL is the same.
Z0 = """z0 AS (SELECT *, max(t + 0.25) OVER (PARTITION BY run_id, track_id, role, zone ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM v_sighting),
z1 AS (SELECT *, sum(CASE WHEN pe IS NULL OR t - pe > 15.0 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id, role, zone ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM z0),
zone_event AS (SELECT run_id, track_id, role, zone, min(t) AS t_in, max(t + 0.25) AS t_out, max(t + 0.25) - min(t) AS duration FROM z1 GROUP BY run_id, track_id, role, zone, island)"""


def islands(name: str, source: str, keys: str, gap: float = 0.0) -> str:
    """SQL of intervals.merge."""
    return f"""{name}_0 AS (SELECT *, max(t_out) OVER (PARTITION BY {keys} ORDER BY t_in, t_out ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {source}),
{name}_1 AS (SELECT *, sum(CASE WHEN pe IS NULL OR t_in - pe > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY t_in, t_out ROWS UNBOUNDED PRECEDING) AS island FROM {name}_0),
{name} AS (SELECT {keys}, min(t_in) AS t_in, max(t_out) AS t_out FROM {name}_1 GROUP BY {keys}, island)"""


def _z(spark, sf):
    return zone_events(sightings(spark, sf), min_event=0.0)


@query("f7_occupancy_events", sql("SELECT run_id, track_id, role, zone, round(t_in, 2) AS t_in, round(t_out, 2) AS t_out, round(duration, 2) AS duration FROM zone_event WHERE duration >= CASE WHEN zone = 'main_entrance' THEN 0.5 ELSE 2.0 END", Z0))
def f7(spark, sf):
    return zone_events(sightings(spark, sf), entry_zones=("main_entrance",))


@query("f1_merge_intervals", sql("SELECT * FROM m", Z0, islands("m", "zone_event", "run_id, zone", 5.0)))
def f1(spark, sf):
    return merge(_z(spark, sf), ["run_id", "zone"], gap=5.0)


@query("f3_total_duration", sql("SELECT run_id, zone, sum(t_out - t_in) AS seconds FROM zone_event GROUP BY run_id, zone", Z0))
def f3(spark, sf):
    return total(_z(spark, sf), ["run_id", "zone"])


W = "w AS (SELECT run_id, 100.0::DOUBLE AS w0, 400.0::DOUBLE AS w1 FROM (SELECT DISTINCT run_id FROM v_event) UNION ALL SELECT run_id, 500.0, 900.0 FROM (SELECT DISTINCT run_id FROM v_event))"


def windows(spark, sf):
    runs = sightings(spark, sf).select("run_id").distinct()
    return runs.select("run_id", F.explode(F.array(F.struct(F.lit(100.0).alias("w0"), F.lit(400.0).alias("w1")), F.struct(F.lit(500.0).alias("w0"), F.lit(900.0).alias("w1")))).alias("w")).select("run_id", "w.*")


@query("e5_clip_and_merge", sql("SELECT * FROM m", Z0, W, "c AS (SELECT run_id, zone, greatest(t_in, w0) AS t_in, least(t_out, w1) AS t_out FROM zone_event JOIN w USING (run_id) WHERE t_in < w1 AND w0 < t_out)", islands("m", "c", "run_id, zone")))
def e5(spark, sf):
    return merge(clip(_z(spark, sf).select("run_id", "zone", "t_in", "t_out"), windows(spark, sf), ["run_id"]), ["run_id", "zone"])


@query(
    "f4_complement",
    sql(
        "SELECT run_id, w0, s0 AS t_in, s AS t_out FROM (SELECT *, coalesce(max(e) OVER (PARTITION BY run_id, w0 ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), w0) AS s0 FROM c) WHERE s - s0 > 1e-9",
        Z0,
        W,
        "d AS (SELECT * FROM zone_event WHERE zone = 'reception' AND role = 'staff')",
        islands("m", "d", "run_id"),
        "c AS (SELECT run_id, w0, greatest(t_in, w0) AS s, least(t_out, w1) AS e FROM m JOIN w USING (run_id) WHERE t_in < w1 AND w0 < t_out UNION ALL SELECT run_id, w0, w1, w1 FROM w)",
    ),
)
def f4(spark, sf):
    desk = merge(_z(spark, sf).where("zone = 'reception' and role = 'staff'"), ["run_id"])
    return complement(desk, windows(spark, sf), ["run_id"])


@query("f16_parties_at_tables", sql("SELECT *, t_out - t_in AS seconds FROM m WHERE t_out - t_in >= 60.0", Z0, "d AS (SELECT * FROM zone_event WHERE zone = 'dining' AND role = 'customer')", islands("m", "d", "run_id", 120.0)))
def f16(spark, sf):
    found = merge(_z(spark, sf).where("zone = 'dining' and role = 'customer'"), ["run_id"], gap=120.0)
    return found.withColumn("seconds", F.col("t_out") - F.col("t_in")).where("seconds >= 60")


@query("f17_staff_visits", sql("SELECT * FROM m WHERE t_out - t_in >= 8.0", Z0, "d AS (SELECT run_id, zone, t_in, t_out FROM zone_event WHERE zone = 'dining' AND role = 'staff' AND t_in < 600.0 AND t_out > 100.0)", islands("m", "d", "run_id, zone", 30.0)))
def f17(spark, sf):
    rows = _z(spark, sf).where("zone = 'dining' and role = 'staff' and t_in < 600.0 and t_out > 100.0")
    return merge(rows, ["run_id", "zone"], gap=30.0).where("t_out - t_in >= 8.0")


@query("f10_observed_windows", sql("SELECT run_id, min(t) AS w0, max(t) + 0.25 AS w1, count(*) AS n FROM (SELECT *, sum(n0) OVER (PARTITION BY run_id ORDER BY t) AS g FROM (SELECT run_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY run_id ORDER BY t) <= 1.5 THEN 0 ELSE 1 END AS n0 FROM v_sighting WHERE zone = 'bar')) GROUP BY run_id, g"))
def f10(spark, sf):
    rows = runs_of(sightings(spark, sf).where("zone = 'bar'"), ["run_id"], "t", 1.5)
    return rows.groupBy("run_id", "run").agg(F.min("t").alias("w0"), (F.max("t") + 0.25).alias("w1"), F.count("*").alias("n")).drop("run")


@query(
    "f11_activity_segments",
    sql(
        "SELECT run_id, greatest(t_in, 0.0) AS t_in, least(t_out, 1250.0) AS t_out FROM m WHERE least(t_out, 1250.0) - greatest(t_in, 0.0) >= 10.0",
        "a AS (SELECT run_id, floor(t / 10) AS b, count(*) AS n FROM v_sighting WHERE zone = 'main_entrance' AND role = 'staff' GROUP BY 1, 2)",
        "p AS (SELECT run_id, b * 10.0 - 20.0 AS t_in, b * 10.0 + 30.0 AS t_out FROM a WHERE n >= 1)",
        islands("m", "p", "run_id", 45.0),
    ),
)
def f11(spark, sf):
    scan = sightings(spark, sf).where("zone = 'main_entrance' and role = 'staff'").groupBy("run_id", F.floor(F.col("t") / 10).alias("b")).agg(F.count("*").alias("n"))
    padded = scan.where("n >= 1").select("run_id", (F.col("b") * 10.0 - 20.0).alias("t_in"), (F.col("b") * 10.0 + 30.0).alias("t_out"))
    found = merge(padded, ["run_id"], gap=45.0).select("run_id", F.greatest("t_in", F.lit(0.0)).alias("t_in"), F.least("t_out", F.lit(1250.0)).alias("t_out"))
    return found.where("t_out - t_in >= 10.0")


@query("f15_detector_silence", sql("SELECT run_id, min(t) AS t0, max(t) AS t1, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t) - row_number() OVER (PARTITION BY run_id, quiet ORDER BY t) AS g FROM (SELECT run_id, t, zone NOT IN ('reception', 'bar') AS quiet FROM v_sighting)) WHERE quiet GROUP BY run_id, g HAVING count(*) >= 8"))
def f15(spark, sf):
    rows = sightings(spark, sf).select("run_id", "t", (~F.col("zone").isin("reception", "bar")).alias("quiet"))
    at, own = Window.partitionBy("run_id").orderBy("t"), Window.partitionBy("run_id", "quiet").orderBy("t")
    rows = rows.withColumn("g", F.row_number().over(at) - F.row_number().over(own)).where("quiet")
    return rows.groupBy("run_id", "g").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n")).where("n >= 8").drop("g")


@query("g1_entered_count", sql("SELECT run_id, count(DISTINCT track_id) AS entered FROM v_crossing WHERE direction = 'in' AND role <> 'staff' AND (line IS NULL OR line IN ('entry line', 'side door')) GROUP BY run_id"))
def g1(spark, sf):
    at_door = F.col("line").isNull() | F.col("line").isin("entry line", "side door")
    return crossings(spark, sf).where((F.col("direction") == "in") & (F.col("role") != "staff") & at_door).groupBy("run_id").agg(F.count_distinct("track_id").alias("entered"))


@query("g2_seated_count", sql("SELECT run_id, count(DISTINCT track_id) AS seated FROM zone_event WHERE zone = 'dining' AND role = 'customer' AND duration >= 5.0 GROUP BY run_id", Z0))
def g2(spark, sf):
    return _z(spark, sf).where("zone = 'dining' and role = 'customer' and duration >= 5.0").groupBy("run_id").agg(F.count_distinct("track_id").alias("seated"))


@query("g3_waited_over", sql("SELECT run_id, track_id, round(sum(t_out - t_in), 1) AS waited FROM m GROUP BY run_id, track_id HAVING round(sum(t_out - t_in), 1) >= 20.0", Z0, "d AS (SELECT * FROM zone_event WHERE zone = 'waiting' AND role = 'customer')", islands("m", "d", "run_id, track_id", 30.0)))
def g3(spark, sf):
    waits = merge(_z(spark, sf).where("zone = 'waiting' and role = 'customer'"), ["run_id", "track_id"], gap=30.0)
    return total(waits, ["run_id", "track_id"], name="waited").withColumn("waited", F.round("waited", 1)).where("waited >= 20.0")


@query("g8_occupancy_timeline", sql(
    "SELECT run_id, n * 10.0::DOUBLE AS t0, role, count(DISTINCT track_id) AS people FROM (SELECT g.run_id, g.n, r.role, e.track_id FROM grid g JOIN (SELECT DISTINCT run_id, role FROM zone_event) r USING (run_id) LEFT JOIN zone_event e ON e.run_id = g.run_id AND e.role = r.role AND e.t_out > g.n * 10.0 AND e.t_in < (g.n + 1) * 10.0) GROUP BY run_id, n, role",
    Z0, "grid AS (SELECT run_id, unnest(range(0, CAST(ceil(max(t_out) / 10.0) AS INT))) AS n FROM zone_event GROUP BY run_id)"))
def g8(spark, sf):
    z = _z(spark, sf)
    return timeline(z, spans(z))


@query("g10_minute_summaries", sql(
    """SELECT g.run_id, g.n * 60.0::DOUBLE AS t0, coalesce(p.people, 0) AS people, coalesce(p.ids, '') AS person_ids, coalesce(p.zones, '') AS zones, coalesce(c.n_in, 0) AS n_in, coalesce(c.n_out, 0) AS n_out
FROM grid g LEFT JOIN p ON p.run_id = g.run_id AND p.n = g.n LEFT JOIN c ON c.run_id = g.run_id AND c.n = g.n""",
    Z0, "grid AS (SELECT run_id, unnest(range(0, CAST(ceil(max(t_out) / 60.0) AS INT))) AS n FROM zone_event GROUP BY run_id)",
    "p AS (SELECT g.run_id, g.n, count(DISTINCT track_id) AS people, array_to_string(list_sort(list(DISTINCT track_id)), ',') AS ids, array_to_string(list_sort(list(DISTINCT zone)), ',') AS zones FROM grid g JOIN zone_event e ON e.run_id = g.run_id AND e.t_out > g.n * 60.0 AND e.t_in < (g.n + 1) * 60.0 GROUP BY g.run_id, g.n)",
    "c AS (SELECT run_id, CAST(floor(t / 60.0) AS INT) AS n, count(*) FILTER (direction = 'in') AS n_in, count(*) FILTER (direction = 'out') AS n_out FROM v_crossing GROUP BY 1, 2)"))
def g10(spark, sf):
    z = _z(spark, sf)
    return minute_summaries(z, crossings(spark, sf), spans(z))


@query("g9_occupancy_reconciliation", sql(
    "SELECT run_id, n, expected, observed, observed - expected AS drift FROM (SELECT g.run_id, g.n, (SELECT count(*) FILTER (direction = 'in') - count(*) FILTER (direction = 'out') FROM v_crossing c WHERE c.run_id = g.run_id AND c.t < (g.n + 1) * 30.0) AS expected, (SELECT count(DISTINCT track_id) FROM zone_event e WHERE e.run_id = g.run_id AND e.t_out > g.n * 30.0 AND e.t_in < (g.n + 1) * 30.0) AS observed FROM grid g)",
    Z0, "grid AS (SELECT run_id, unnest(range(0, CAST(ceil(max(t_out) / 30.0) AS INT))) AS n FROM zone_event GROUP BY run_id)"))
def g9(spark, sf):
    z = _z(spark, sf)
    grid = spans(z).select("run_id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("t_end") / 30).cast("int") - 1)).alias("n"))
    seen = z.where("t_out > t_in").select("run_id", "track_id", F.explode(F.sequence(F.floor(F.col("t_in") / 30).cast("int"), F.ceil(F.col("t_out") / 30).cast("int") - 1)).alias("n"))
    observed = seen.groupBy("run_id", "n").agg(F.count_distinct("track_id").alias("observed"))
    moves = crossings(spark, sf).groupBy("run_id", F.floor(F.col("t") / 30).cast("int").alias("n")).agg(F.sum(F.when(F.col("direction") == "in", 1).otherwise(-1)).alias("net"))
    rows = grid.join(moves, ["run_id", "n"], "left").join(observed, ["run_id", "n"], "left")
    expected = F.coalesce(F.sum("net").over(Window.partitionBy("run_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = rows.select("run_id", "n", expected.alias("expected"), F.coalesce("observed", F.lit(0)).alias("observed"))
    return rows.withColumn("drift", F.col("observed") - F.col("expected"))


@query("g11_wait_seconds", sql("SELECT run_id, track_id, sum(duration) AS wait_s FROM zone_event WHERE zone = 'waiting' GROUP BY run_id, track_id", Z0))
def g11(spark, sf):
    return _z(spark, sf).where("zone = 'waiting'").groupBy("run_id", "track_id").agg(F.sum("duration").alias("wait_s"))


@query("g12_span_by_track", sql("SELECT run_id, track_id, min(t_in) AS t_first, max(t_out) AS t_last FROM zone_event GROUP BY run_id, track_id", Z0))
def g12(spark, sf):
    return _z(spark, sf).groupBy("run_id", "track_id").agg(F.min("t_in").alias("t_first"), F.max("t_out").alias("t_last"))


@query("g14_first_line_arrival", sql("SELECT run_id, track_id, min(t) AS t FROM v_crossing WHERE direction = 'in' AND role <> 'staff' AND line = 'entry line' GROUP BY run_id, track_id"))
def g14(spark, sf):
    return crossings(spark, sf).where("direction = 'in' and role <> 'staff' and line = 'entry line'").groupBy("run_id", "track_id").agg(F.min("t").alias("t"))


@query("g28_closure_by_door", sql(
    "SELECT run_id, line, count(*) FILTER (direction = 'in') AS n_in, count(*) FILTER (direction = 'out') AS n_out, min(running) AS lowest, max(running) AS highest, count(*) >= 4 AND abs(count(*) FILTER (direction = 'in') - count(*) FILTER (direction = 'out')) > 0.3 * count(*) AS biased FROM (SELECT *, sum(CASE WHEN direction = 'in' THEN 1 ELSE -1 END) OVER (PARTITION BY run_id, line ORDER BY t ROWS UNBOUNDED PRECEDING) AS running FROM v_crossing) GROUP BY run_id, line"))
def g28(spark, sf):
    step = F.when(F.col("direction") == "in", 1).otherwise(-1)
    rows = crossings(spark, sf).withColumn("running", F.sum(step).over(Window.partitionBy("run_id", "line").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))
    n_in, n_out = F.count_if(F.col("direction") == "in"), F.count_if(F.col("direction") == "out")
    out = rows.groupBy("run_id", "line").agg(n_in.alias("n_in"), n_out.alias("n_out"), F.min("running").alias("lowest"), F.max("running").alias("highest"))
    return out.withColumn("biased", (F.col("n_in") + F.col("n_out") >= 4) & (F.abs(F.col("n_in") - F.col("n_out")) > 0.3 * (F.col("n_in") + F.col("n_out"))))


@query("h1_confirmed_crossings", sql(
    "SELECT run_id, track_id, role, direction, line, x, y, t FROM f WHERE keep AND rn > 0",
    "o AS (SELECT *, row_number() OVER (PARTITION BY run_id, track_id, line ORDER BY t, direction) AS rn FROM v_crossing)",
    "p AS (SELECT a.*, coalesce(b.direction <> a.direction AND b.t - a.t <= 5.0, false) AS pairs FROM o a LEFT JOIN o b ON b.run_id = a.run_id AND b.track_id = a.track_id AND b.line = a.line AND b.rn = a.rn + 1)",
    # In a chain of rows that each pair with the next one, rows cancel two by two from the chain's start.
    "q AS (SELECT *, coalesce(lag(pairs) OVER (PARTITION BY run_id, track_id, line ORDER BY rn), false) AS paired FROM p)",
    "g AS (SELECT *, sum(CASE WHEN paired THEN 0 ELSE 1 END) OVER (PARTITION BY run_id, track_id, line ORDER BY rn) AS chain FROM q)",
    "f AS (SELECT *, row_number() OVER (PARTITION BY run_id, track_id, line, chain ORDER BY rn) = count(*) OVER (PARTITION BY run_id, track_id, line, chain) AND count(*) OVER (PARTITION BY run_id, track_id, line, chain) % 2 = 1 AS keep FROM g)"))
def h1(spark, sf):
    return cross.confirmed(crossings(spark, sf))


#: Every ninth crossing has no place; spans are those of a track's sightings.
PLACED = """pc AS (SELECT c.run_id, c.track_id, role, direction, line, CASE WHEN CAST(t * 4 AS INT) % 9 = 0 THEN NULL ELSE x END AS x, CASE WHEN CAST(t * 4 AS INT) % 9 = 0 THEN NULL ELSE y END AS y, t, s.t0, s.t1 FROM v_crossing c JOIN (SELECT run_id, track_id, min(t) AS t0, max(t) AS t1 FROM v_sighting WHERE t % 100 < 60 GROUP BY ALL) s USING (run_id, track_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t, track_id, line) AS rn FROM pc WHERE direction = 'in' AND role <> 'staff' AND line IN ('entry line')),
fold AS (WITH RECURSIVE r AS (
  SELECT o.run_id, o.track_id, o.role, o.direction, o.line, o.x, o.y, o.t, o.rn, true AS kept, [{'t': o.t, 'x': o.x, 'y': o.y, 'k': o.track_id, 'a': o.t0, 'b': o.t1}] AS near FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.track_id, s.role, s.direction, s.line, s.x, s.y, s.t, s.rn, s.n = 0, CASE WHEN s.n = 0 THEN list_append(s.live, {'t': s.t, 'x': s.x, 'y': s.y, 'k': s.track_id, 'a': s.t0, 'b': s.t1}) ELSE s.live END
  FROM (SELECT q.*, len(list_filter(q.live, lambda k: CASE WHEN q.x IS NULL OR k.x IS NULL THEN k.k = q.track_id ELSE (q.x - k.x) * (q.x - k.x) + (q.y - k.y) * (q.y - k.y) <= 19600.0 AND NOT least(q.t1, k.b) - greatest(q.t0, k.a) > 0.4 END)) AS n
    FROM (SELECT o.*, list_filter(r.near, lambda k: o.t - k.t <= 2.5) AS live FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) q) s) SELECT * FROM r)"""


def _placed(spark, sf):
    nowhere = (F.col("t") * 4).cast("int") % 9 == 0
    return crossings(spark, sf).withColumn("x", F.when(~nowhere, F.col("x"))).withColumn("y", F.when(~nowhere, F.col("y")))


def _spans(spark, sf):
    return sightings(spark, sf).where("t % 100 < 60").groupBy("run_id", "track_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))


@query("h2_deduplicated_entries", sql("SELECT run_id, track_id, role, direction, line, x, y, t FROM fold WHERE kept", PLACED))
def h2(spark, sf):
    """The venue's own line, with the times at which tracks are seen together."""
    from atrium.plans.reports import l2

    spans = _spans(spark, sf)
    return cross.deduplicated(_placed(spark, sf).join(spans.select("run_id", "track_id"), ["run_id", "track_id"], "left_semi"), lines=l2(spark, sf), spans=spans)


@query("h5_door_dedupe", sql("SELECT run_id, track_id, role, direction, line, x, y, t FROM fold WHERE kept",
    "pc AS (SELECT c.*, s.t0, s.t1 FROM v_crossing c LEFT JOIN (SELECT run_id, track_id, min(t) AS t0, max(t) AS t1 FROM v_sighting WHERE t % 100 < 60 GROUP BY ALL) s USING (run_id, track_id) WHERE line = 'side door')",
    "o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t, track_id, line, direction) AS rn FROM pc)",
    """fold AS (WITH RECURSIVE r AS (
  SELECT o.run_id, o.track_id, o.role, o.direction, o.line, o.x, o.y, o.t, o.rn, true AS kept, [{'t': o.t, 'd': o.direction, 'x': o.x, 'a': o.t0, 'b': o.t1}] AS near FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.track_id, s.role, s.direction, s.line, s.x, s.y, s.t, s.rn, s.n = 0, CASE WHEN s.n = 0 THEN list_append(s.near, {'t': s.t, 'd': s.direction, 'x': s.x, 'a': s.t0, 'b': s.t1})[-6:] ELSE s.near END
  FROM (SELECT o.*, r.near, len(list_filter(r.near, lambda k: k.d = o.direction AND o.t - k.t <= 2.5 AND abs(o.x - k.x) <= 180.0 AND NOT coalesce(CASE WHEN o.t0 IS NOT NULL AND k.a IS NOT NULL THEN least(o.t1, k.b) - greatest(o.t0, k.a) END > 0.4, false))) AS n FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) s) SELECT * FROM r)"""))
def h5(spark, sf):
    return cross.door_deduplicated(crossings(spark, sf).where("line = 'side door'"), _spans(spark, sf))


LINED = "o AS (SELECT *, row_number() OVER (PARTITION BY run_id, line ORDER BY t, track_id, direction) AS rn FROM v_crossing)"
NO_REVERSAL = """fold AS (WITH RECURSIVE r AS (SELECT o.*, true AS kept, o.t AS lt, o.direction AS ld FROM o WHERE rn = 1
  UNION ALL SELECT o.*, o.direction = r.ld OR o.t - r.lt >= 3.0, CASE WHEN o.direction = r.ld OR o.t - r.lt >= 3.0 THEN o.t ELSE r.lt END, CASE WHEN o.direction = r.ld OR o.t - r.lt >= 3.0 THEN o.direction ELSE r.ld END FROM r JOIN o ON o.run_id = r.run_id AND o.line = r.line AND o.rn = r.rn + 1) SELECT * FROM r)"""


@query("h8_without_reversals", sql("SELECT run_id, track_id, role, direction, line, x, y, t FROM fold WHERE kept", LINED, NO_REVERSAL))
def h8(spark, sf):
    return cross.without_reversals(crossings(spark, sf))


@query("h7_merged_over_seams", sql("SELECT run_id, track_id, role, direction, line, x, y, t FROM fold WHERE kept", LINED, """fold AS (WITH RECURSIVE r AS (SELECT o.*, true AS kept, o.t AS lt, o.direction AS ld FROM o WHERE rn = 1
  UNION ALL SELECT o.*, o.direction <> r.ld OR o.t - r.lt > 1.0, CASE WHEN o.direction <> r.ld OR o.t - r.lt > 1.0 THEN o.t ELSE r.lt END, CASE WHEN o.direction <> r.ld OR o.t - r.lt > 1.0 THEN o.direction ELSE r.ld END FROM r JOIN o ON o.run_id = r.run_id AND o.line = r.line AND o.rn = r.rn + 1) SELECT * FROM r)"""))
def h7(spark, sf):
    return cross.merged_directions(crossings(spark, sf))


#: One fold for both passes: what waits for its neighbour, and the last that stayed.
BOUNCE = """b AS (SELECT *, lead(direction) OVER w AS nd, lead(t) OVER w AS nt, lead(x) OVER w AS nx FROM o WINDOW w AS (PARTITION BY run_id, line ORDER BY rn)),
p1 AS (WITH RECURSIVE r AS (SELECT b.*, coalesce(nd <> direction AND nt - t <= 3.0 AND abs(nx - x) <= 45.0, false) AS opens, false AS closes FROM b WHERE rn = 1
  UNION ALL SELECT b.*, NOT r.opens AND coalesce(b.nd <> b.direction AND b.nt - b.t <= 3.0 AND abs(b.nx - b.x) <= 45.0, false), r.opens FROM r JOIN b ON b.run_id = r.run_id AND b.line = r.line AND b.rn = r.rn + 1) SELECT * FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY run_id, line ORDER BY rn) AS qn FROM p1 WHERE NOT opens AND NOT closes),
p2 AS (WITH RECURSIVE r AS (SELECT q.run_id, q.track_id, q.role, q.direction, q.line, q.x, q.y, q.t, q.qn, true AS kept, q.t AS lt, q.direction AS ld, q.x AS lx FROM q WHERE qn = 1
  UNION ALL SELECT s.run_id, s.track_id, s.role, s.direction, s.line, s.x, s.y, s.t, s.qn, NOT s.dup, CASE WHEN s.dup THEN s.lt ELSE s.t END, CASE WHEN s.dup THEN s.ld ELSE s.direction END, CASE WHEN s.dup THEN s.lx ELSE s.x END FROM (SELECT q.*, r.lt, r.ld, r.lx, r.ld = q.direction AND q.t - r.lt < 0.8 AND abs(q.x - r.lx) <= 45.0 AS dup FROM r JOIN q ON q.run_id = r.run_id AND q.line = r.line AND q.qn = r.qn + 1) s) SELECT * FROM r)"""


@query("h6_debounced_crossings", sql("SELECT run_id, track_id, role, direction, line, x, y, t FROM p2 WHERE kept", LINED, BOUNCE))
def h6(spark, sf):
    return cross.debounced(crossings(spark, sf))


@query("p32_slit_counts", sql("SELECT run_id, line, count(*) FILTER (direction = 'in') AS n_in, count(*) FILTER (direction = 'out') AS n_out FROM p2 WHERE kept GROUP BY ALL", LINED.replace("FROM v_crossing", "FROM v_crossing WHERE x < 900.0 AND y BETWEEN 60.0 AND 1000.0"), BOUNCE))
def p32(spark, sf):
    """Blobs that pass both gates of place and size, without bounces, by direction."""
    passed = crossings(spark, sf).where("x < 900.0 and y between 60.0 and 1000.0")
    n = lambda d: F.count_if(F.col("direction") == d)
    return cross.debounced(passed).groupBy("run_id", "line").agg(n("in").alias("n_in"), n("out").alias("n_out"))


@query("h11_parties", sql("SELECT run_id, track_id, t, CAST(party AS INT) AS party FROM fold",
    "o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t, track_id) AS rn FROM v_crossing WHERE direction = 'in' AND role <> 'staff' AND line = 'entry line')",
    """fold AS (WITH RECURSIVE r AS (
  SELECT o.run_id, o.track_id, o.t, o.rn, 0 AS party, 1 AS n, [{'p': 0, 't': o.t, 'x': o.x, 'y': o.y}] AS seen FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.track_id, s.t, s.rn, coalesce(s.own, s.n), s.n + CASE WHEN s.own IS NULL THEN 1 ELSE 0 END, list_append(s.live, {'p': coalesce(s.own, s.n), 't': s.t, 'x': s.x, 'y': s.y})
  FROM (SELECT q.*, list_min(list_transform(list_filter(q.live, lambda k: (q.x - k.x) * (q.x - k.x) + (q.y - k.y) * (q.y - k.y) <= 102400.0), lambda k: k.p)) AS own
    FROM (SELECT o.*, r.n, list_filter(r.seen, lambda k: len(list_filter(r.seen, lambda z: z.p = k.p AND o.t - z.t <= 25.0)) > 0) AS live FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) q) s) SELECT * FROM r)"""))
def h11(spark, sf):
    return cross.parties(crossings(spark, sf).where("direction = 'in' and role <> 'staff' and line = 'entry line'"))


TRUTH = "truth AS (SELECT * FROM (VALUES (26.0::DOUBLE, 39.0::DOUBLE, 0, false), (221.0, 234.0, 3, false), (305.0, 318.0, 6, true)) AS v(w0, w1, expected, tuned))"


TRUTH_ROWS = [(26.0, 39.0, 0, False), (221.0, 234.0, 3, False), (305.0, 318.0, 6, True)]


@query("e14_truth_windows", sql("SELECT run_id, w0, expected, tuned, count(c.t) AS got, least(count(c.t), expected) AS hits, greatest(count(c.t) - expected, 0) AS extra FROM truth w JOIN v_crossing c ON c.direction = 'in' AND c.line = 'entry line' AND c.t >= w0 - 3.0 AND c.t <= w1 + 3.0 GROUP BY run_id, w0, expected, tuned", TRUTH))
def e14(spark, sf):
    from atrium.operators.scoring import windows_scored

    inward = crossings(spark, sf).where("direction = 'in' and line = 'entry line'")
    return windows_scored(inward, TRUTH_ROWS).where("got > 0")


@query("e15_flagged_false_events", sql("SELECT run_id, a, count(DISTINCT track_id || ':' || direction) AS matches, count(DISTINCT track_id || ':' || direction) >= 2 AS reversal FROM v_crossing JOIN (SELECT unnest([40.0, 100.0, 300.0, 610.5]) AS a) f ON abs(t - a) <= 0.6 GROUP BY run_id, a"))
def e15(spark, sf):
    runs = crossings(spark, sf).select("run_id").distinct()
    flagged = runs.select("run_id", F.explode(F.array(*[F.lit(x) for x in (40.0, 100.0, 300.0, 610.5)])).alias("a"))
    near = range_join(crossings(spark, sf), flagged.select("run_id", "a", (F.col("a") - 0.6).alias("lo"), (F.col("a") + 0.6).alias("hi")), ["run_id"], "t", "lo", "hi", 5.0)
    n = F.count_distinct(F.concat_ws(":", "track_id", "direction"))
    return near.groupBy("run_id", "a").agg(n.alias("matches"), (n >= 2).alias("reversal"))


@query("j2_event_stream", sql("SELECT run_id, t, 'cross' AS kind, track_id, line AS place FROM v_crossing UNION ALL SELECT run_id, t_in, 'zone', track_id, zone FROM zone_event", Z0))
def j2(spark, sf):
    z = _z(spark, sf).select("run_id", F.col("t_in").alias("t"), F.lit("zone").alias("kind"), "track_id", F.col("zone").alias("place"))
    return crossings(spark, sf).select("run_id", "t", F.lit("cross").alias("kind"), "track_id", F.col("line").alias("place")).unionByName(z)


@query("n4_late_rows", sql("SELECT run_id, count(*) FILTER (t < seen) AS late, count(*) FILTER (NOT coalesce(t < seen, false)) AS on_time FROM (SELECT run_id, t, max(t) OVER (PARTITION BY run_id ORDER BY k, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM (SELECT *, CAST(i * 0.25 AS DOUBLE) AS t FROM v_event)) GROUP BY run_id"))
def n4(spark, sf):
    from atrium.sources.adapters import _events

    order = Window.partitionBy("run_id").orderBy("k", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = _events(spark, sf).withColumn("t", F.col("i") * 0.25).withColumn("seen", F.max("t").over(order))
    late = F.coalesce(F.col("t") < F.col("seen"), F.lit(False))
    return rows.groupBy("run_id").agg(F.count_if(late).alias("late"), F.count_if(~late).alias("on_time"))
