"""Queries on reports, clocks, validity, geometry of the venue and identity checks (tables F, G, K, L, M, P of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.functions.geometry import cosine
from atrium.operators import answers as A
from atrium.operators.intervals import complement, merge, total
from atrium.operators.occupancy import spans, zone_events
from atrium.plans.answers import CONF, COVERAGE, ENTRY, INTERIOR, STAFF, _confidence, _windows
from atrium.plans.events import Z0, islands
from atrium.plans.identity import CAND, TRACK, tracks
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sightings, sql, table


def _z(spark, sf):
    return zone_events(sightings(spark, sf), min_event=0.0)


@query("f2_merged_answers", sql("SELECT run_id, count(*) AS spans, sum(t_out - t_in) AS seconds FROM m GROUP BY run_id", Z0, islands("m", "(SELECT run_id, t_in, t_out FROM zone_event WHERE role = 'staff')", "run_id")))
def f2(spark, sf):
    m = merge(_z(spark, sf).where("role = 'staff'"), ["run_id"])
    return m.groupBy("run_id").agg(F.count("*").alias("spans"), F.sum(F.col("t_out") - F.col("t_in")).alias("seconds"))


@query("f12_coverage_report", sql("SELECT run_id, s AS analysed, w1 - s AS skipped, round(100 * s / w1, 2) AS pct FROM (SELECT run_id, sum(t_out - t_in) AS s FROM m GROUP BY run_id) JOIN (SELECT run_id, max(t_out) AS w1 FROM zone_event GROUP BY run_id) USING (run_id)", Z0, islands("m", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone = 'bar')", "run_id", 2.0)))
def f12(spark, sf):
    z = _z(spark, sf)
    seen = total(merge(z.where("zone = 'bar'"), ["run_id"], gap=2.0), ["run_id"], name="analysed")
    return seen.join(spans(z), "run_id").select("run_id", "analysed", (F.col("t_end") - F.col("analysed")).alias("skipped"), F.round(100 * F.col("analysed") / F.col("t_end"), 2).alias("pct"))


@query("f19_reception_absence", sql(
    "SELECT run_id, sum(g) FILTER (g >= 1.0) AS absent_s, count(*) FILTER (g >= 10.0) AS gaps FROM (SELECT run_id, s - a AS g FROM (SELECT *, coalesce(max(e) OVER (PARTITION BY run_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS a FROM (SELECT run_id, t_in AS s, t_out AS e FROM m UNION ALL SELECT run_id, max(t_out), max(t_out) FROM zone_event GROUP BY run_id)) WHERE s - a > 1e-9) GROUP BY run_id",
    Z0, islands("m", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone = 'reception' AND role = 'staff')", "run_id")))
def f19(spark, sf):
    z = _z(spark, sf)
    g = complement(A.presence(z, STAFF, "staff"), _windows(z), ["run_id"]).withColumn("g", F.col("t_out") - F.col("t_in"))
    return g.groupBy("run_id").agg(F.sum(F.when(F.col("g") >= 1.0, F.col("g"))).alias("absent_s"), F.count_if(F.col("g") >= 10.0).alias("gaps"))


@query("f20_union_seconds", sql("SELECT run_id, track_id, sum(t_out - t_in) AS seconds FROM m GROUP BY ALL", Z0, islands("m", "(SELECT run_id, track_id, t_in, t_out FROM zone_event WHERE role = 'staff')", "run_id, track_id")))
def f20(spark, sf):
    return total(merge(_z(spark, sf).where("role = 'staff'"), ["run_id", "track_id"]), ["run_id", "track_id"])


@query("g23_answer_set", sql(
    "SELECT run_id, 'coverage' AS key, value, tier FROM cov UNION ALL SELECT run_id, 'guests', count(*)::DOUBLE, 'ESTIMATE' FROM conf GROUP BY run_id",
    Z0, CONF, "cov AS (" + COVERAGE.partition("\nSELECT")[0].replace("WITH ", "SELECT * FROM (WITH ", 1) + "\nSELECT" + COVERAGE.partition("\nSELECT")[2] + "))"))
@query("g24_report_rows", sql(
    "SELECT run_id, 'coverage' AS key, value, tier FROM cov UNION ALL SELECT run_id, 'guests', count(*)::DOUBLE, 'ESTIMATE' FROM conf GROUP BY run_id",
    Z0, CONF, "cov AS (" + COVERAGE.partition("\nSELECT")[0].replace("WITH ", "SELECT * FROM (WITH ", 1) + "\nSELECT" + COVERAGE.partition("\nSELECT")[2] + "))"))
def g23(spark, sf):
    z = _z(spark, sf)
    cover = A.desk_coverage(z, STAFF, _windows(z)).select("run_id", F.lit("coverage").alias("key"), "value", "tier")
    guests = _confidence(spark, sf).groupBy("run_id").agg(F.count("*").cast("double").alias("value"))
    return cover.unionByName(guests.select("run_id", F.lit("guests").alias("key"), "value", F.lit(A.ESTIMATE).alias("tier")))


@query("g17_guest_ids", sql("SELECT DISTINCT run_id, track_id FROM (SELECT run_id, track_id FROM v_crossing WHERE direction = 'in' AND role <> 'staff' UNION ALL SELECT run_id, track_id FROM zone_event WHERE role <> 'staff' AND zone = 'dining')", Z0))
def g17(spark, sf):
    a = crossings(spark, sf).where("direction = 'in' and role <> 'staff'").select("run_id", "track_id")
    return a.unionByName(_z(spark, sf).where("role <> 'staff' and zone = 'dining'").select("run_id", "track_id")).distinct()


@query("g16_arrival_source", sql("SELECT run_id, CASE WHEN r > 0 THEN 'region' WHEN l > 0 THEN 'line' ELSE 'none' END AS source FROM (SELECT run_id, count(*) FILTER (zone = 'main_entrance') AS r FROM zone_event GROUP BY run_id) LEFT JOIN (SELECT run_id, count(*) FILTER (direction = 'in') AS l FROM v_crossing GROUP BY run_id) USING (run_id)", Z0))
def g16(spark, sf):
    r = _z(spark, sf).groupBy("run_id").agg(F.count_if(F.col("zone") == "main_entrance").alias("r"))
    c = crossings(spark, sf).groupBy("run_id").agg(F.count_if(F.col("direction") == "in").alias("l"))
    return r.join(c, "run_id", "left").select("run_id", F.when(F.col("r") > 0, "region").when(F.col("l") > 0, "line").otherwise("none").alias("source"))


@query("g44_before_after", sql("SELECT zone, a, b, round(b - a, 5) AS delta, abs(b - a) < 0.02 AS noise FROM (SELECT zone, count(*) FILTER (run_id % 2 = 0) / nullif((SELECT count(*) FROM v_sighting WHERE run_id % 2 = 0), 0) AS a, count(*) FILTER (run_id % 2 = 1) / nullif((SELECT count(*) FROM v_sighting WHERE run_id % 2 = 1), 0) AS b FROM v_sighting GROUP BY zone)"))
def g44(spark, sf):
    s = sightings(spark, sf).withColumn("odd", F.col("run_id") % 2 == 1)
    n = s.groupBy("odd").agg(F.count("*").alias("n"))
    share = s.groupBy("zone", "odd").agg(F.count("*").alias("k")).join(n, "odd").select("zone", "odd", (F.col("k") / F.col("n")).alias("p"))
    p = share.groupBy("zone").agg(F.sum(F.when(~F.col("odd"), F.col("p"))).alias("a"), F.sum(F.when(F.col("odd"), F.col("p"))).alias("b"))
    return p.select("zone", "a", "b", F.round(F.col("b") - F.col("a"), 5).alias("delta"), (F.abs(F.col("b") - F.col("a")) < 0.02).alias("noise"))


@query("g51_validity_summary", sql("SELECT run_id, max(t) - min(t) AS elapsed, 0.25 * count(*) FILTER (zone <> 'bar') AS observed, round(0.25 * count(*) FILTER (zone <> 'bar') / nullif(max(t) - min(t), 0), 5) AS share, count(*) FILTER (zone = 'bar') >= 0.02 * count(*) AS blind FROM v_sighting GROUP BY run_id"))
def g51(spark, sf):
    """The bar's sightings stand for blind samples."""
    seen, elapsed = 0.25 * F.count_if(F.col("zone") != "bar"), F.max("t") - F.min("t")
    blind = F.count_if(F.col("zone") == "bar") >= 0.02 * F.count("*")
    return sightings(spark, sf).groupBy("run_id").agg(elapsed.alias("elapsed"), seen.alias("observed"), F.round(F.when(elapsed != 0, seen / elapsed), 5).alias("share"), blind.alias("blind"))


@query("p17_sampling_step", sql("SELECT run_id, list_sort(list(g))[count(*) // 2 + 1] AS step FROM (SELECT run_id, t - lag(t) OVER (PARTITION BY run_id ORDER BY t) AS g FROM v_sighting WHERE zone = 'waiting') WHERE g > 0 GROUP BY run_id"))
def p17(spark, sf):
    from atrium.operators.occupancy import upper_median

    g = F.col("t") - F.lag("t").over(Window.partitionBy("run_id").orderBy("t"))
    return sightings(spark, sf).where("zone = 'waiting'").withColumn("g", g).where("g > 0").groupBy("run_id").agg(upper_median("g").alias("step"))


@query("g63_miss_risk", "SELECT event_id, round(greatest(0.0, CASE WHEN value > 25.0 THEN 1 - 25.0 / value ELSE 0.0 END), 6) AS risk FROM events")
def g63(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select("event_id", F.round(F.greatest(F.lit(0.0), F.when(v > 25.0, 1 - 25.0 / v).otherwise(0.0)), 6).alias("risk"))


@query("g59_appearance_samples", sql("SELECT run_id, CASE WHEN gap <= 20.0 AND drift <= 260.0 THEN 'same' ELSE 'open' END AS kind, count(*) AS n, round(avg(sim), 5) AS mean FROM cand GROUP BY ALL", TRACK, CAND))
def g59(spark, sf):
    from atrium.operators.identity import candidates

    kind = F.when((F.col("gap") <= 20.0) & (F.col("drift") <= 260.0), "same").otherwise("open")
    return candidates(tracks(spark, sf)).groupBy("run_id", kind.alias("kind")).agg(F.count("*").alias("n"), F.round(F.avg("sim"), 5).alias("mean"))


ARRIVED = f"""ar AS (SELECT e.run_id, e.track_id, min(e.t_in) AS t, CAST(CAST(e.track_id AS INT) * 37 % 640 AS DOUBLE) AS x, CAST(CAST(e.track_id AS INT) * 53 % 480 AS DOUBLE) AS y FROM zone_event e JOIN (SELECT run_id, track_id, min(t_in) AS f FROM zone_event WHERE zone IN ({', '.join(repr(z) for z in ENTRY)}) GROUP BY ALL) g ON g.run_id = e.run_id AND g.track_id = e.track_id WHERE e.zone IN ({', '.join(repr(z) for z in INTERIOR)}) AND e.t_in >= g.f GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t, track_id) AS rn FROM ar),
fold AS (WITH RECURSIVE r AS (
  SELECT run_id, track_id, t, x, y, rn, true AS kept, [{{'t': t, 'x': x, 'y': y}}] AS near FROM o WHERE rn = 1
  UNION ALL SELECT s.run_id, s.track_id, s.t, s.x, s.y, s.rn, len(list_filter(s.live, lambda k: (s.x - k.x) * (s.x - k.x) + (s.y - k.y) * (s.y - k.y) <= 19600.0)) = 0,
    CASE WHEN len(list_filter(s.live, lambda k: (s.x - k.x) * (s.x - k.x) + (s.y - k.y) * (s.y - k.y) <= 19600.0)) = 0 THEN list_append(s.live, {{'t': s.t, 'x': s.x, 'y': s.y}}) ELSE s.live END
  FROM (SELECT o.*, list_filter(r.near, lambda k: o.t - k.t <= 2.5) AS live FROM r JOIN o ON o.run_id = r.run_id AND o.rn = r.rn + 1) s) SELECT * FROM r)"""


def _region_arrivals(spark, sf):
    a = A.region_arrivals(_z(spark, sf), ENTRY, INTERIOR)
    n = F.col("track_id").cast("int")
    return a.select("run_id", "track_id", F.lit("customer").alias("role"), F.lit("in").alias("direction"), F.lit("region").alias("line"), (n * 37 % 640).cast("double").alias("x"), (n * 53 % 480).cast("double").alias("y"), "t")


@query("h3_region_arrival_dedupe", sql("SELECT run_id, track_id, 'customer' AS role, 'in' AS direction, 'region' AS line, x, y, t FROM fold WHERE kept", Z0, ARRIVED))
def h3(spark, sf):
    from atrium.operators.crossings import deduplicated

    return deduplicated(_region_arrivals(spark, sf))


@query("p1_region_arrivals", sql("SELECT run_id, count(*) AS entered, CASE WHEN count(*) < (SELECT count(*) FROM ar a WHERE a.run_id = f.run_id) THEN 'some arrivals were one person' ELSE 'all arrivals apart' END AS why FROM fold f WHERE kept GROUP BY run_id", Z0, ARRIVED))
def p1(spark, sf):
    """Guests who came from an entry to the interior, without repeats, and why the number is what it is."""
    from atrium.operators.crossings import deduplicated

    every = _region_arrivals(spark, sf)
    n = deduplicated(every).groupBy("run_id").agg(F.count("*").alias("entered"))
    total = every.groupBy("run_id").agg(F.count("*").alias("total"))
    return n.join(total, "run_id").select("run_id", "entered", F.when(F.col("entered") < F.col("total"), "some arrivals were one person").otherwise("all arrivals apart").alias("why"))


@query("i2_canonical_priority", sql("SELECT run_id, role, track_id FROM (SELECT *, row_number() OVER (PARTITION BY run_id, role ORDER BY t_first, track_id) AS rn FROM trk) WHERE rn = 1", TRACK))
def i2(spark, sf):
    return tracks(spark, sf).groupBy("run_id", "role").agg(F.min(F.struct("t_first", "track_id")).alias("m")).select("run_id", "role", "m.track_id")


@query("k8_face_agreement", sql("SELECT a.run_id, a.track_id AS a, b.track_id AS b, round(list_cosine_similarity(a.vec, b.vec), 5) AS sim, list_cosine_similarity(a.vec, b.vec) >= 0.35 AS agrees FROM trk a JOIN trk b ON a.run_id = b.run_id AND a.role = 'staff' AND b.role = 'staff' AND a.track_id < b.track_id", TRACK))
def k8(spark, sf):
    """Faces are compared among staff only: the filter stands before the join."""
    t = tracks(spark, sf).where("role = 'staff'")
    o = t.select("run_id", F.col("track_id").alias("b"), F.col("vec").alias("w"))
    p = t.join(o, "run_id").where("track_id < b").withColumn("s", cosine(F.col("vec"), F.col("w")))
    return p.select("run_id", F.col("track_id").alias("a"), "b", F.round("s", 5).alias("sim"), (F.col("s") >= 0.35).alias("agrees"))


@query("k21_best_earlier_match", sql("SELECT run_id, b, a FROM (SELECT *, row_number() OVER (PARTITION BY run_id, b ORDER BY round(sim, 9) DESC, a DESC) AS rn FROM cand) WHERE rn = 1", TRACK, CAND))
def k21(spark, sf):
    from atrium.operators.identity import candidates

    return candidates(tracks(spark, sf)).groupBy("run_id", "b").agg(F.max_by("a", F.struct(F.round("sim", 9), "a")).alias("a"))


@query("k22_customer_map", sql("SELECT run_id, track_id, CASE WHEN role = 'staff' THEN NULL ELSE printf('C%03d', row_number() OVER (PARTITION BY run_id, role ORDER BY t_first, track_id)) END AS customer FROM trk", TRACK))
def k22(spark, sf):
    n = F.row_number().over(Window.partitionBy("run_id", "role").orderBy("t_first", "track_id"))
    return tracks(spark, sf).select("run_id", "track_id", "role", n.alias("n")).select("run_id", "track_id", F.when(F.col("role") != "staff", F.format_string("C%03d", "n")).alias("customer"))


@query("l2_venue_entry_lines", sql("SELECT run_id, line FROM (SELECT DISTINCT run_id, line, line LIKE '%entry%' AND line NOT LIKE '%bar%' AS e, line LIKE '%entry%' OR line LIKE '%door%' AS d FROM v_crossing) QUALIFY e OR (NOT bool_or(e) OVER (PARTITION BY run_id) AND d)"))
def l2(spark, sf):
    """Entry lines; where a run has none, its doors."""
    names = crossings(spark, sf).select("run_id", "line").distinct()
    e = F.contains("line", F.lit("entry")) & ~F.contains("line", F.lit("bar"))
    any_entry = names.groupBy("run_id").agg(F.bool_or(e).alias("any"))
    door = F.contains("line", F.lit("entry")) | F.contains("line", F.lit("door"))
    return names.join(any_entry, "run_id").where(e | (~F.col("any") & door)).select("run_id", "line")


#: Instants around a spring and an autumn change of New York's clocks, by event.
CHANGES = "inst AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-11-03 03:00:00' ELSE TIMESTAMP '2024-03-10 05:00:00' END + to_seconds(CAST(event_id % 360 AS INT) * 60) AS u FROM events)"


def _instants(spark, sf):
    n = F.col("event_id")
    base = F.when(n % 2 == 0, F.lit("2024-11-03 03:00:00").cast("timestamp")).otherwise(F.lit("2024-03-10 05:00:00").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", F.timestamp_add("SECOND", (n % 360 * 60).cast("int"), base).alias("u"))


@query("l6_daylight_saving", "WITH " + CHANGES + ", loc AS (SELECT event_id, timezone('America/New_York', timezone('UTC', u)) AS local, timezone('America/New_York', timezone('UTC', u + INTERVAL 1 HOUR)) AS later, timezone('America/New_York', timezone('UTC', u - INTERVAL 1 HOUR)) AS earlier FROM inst) SELECT event_id, strftime(local, '%Y-%m-%d %H:%M:%S') AS local, local = later OR local = earlier AS ambiguous FROM loc")
def l6(spark, sf):
    """Local times on the days the clocks change; one that two instants show is ambiguous."""
    from atrium.functions.clock import ambiguous, local_time

    return _instants(spark, sf).select("event_id", F.date_format(local_time(F.col("u"), "America/New_York"), "yyyy-MM-dd HH:mm:ss").alias("local"), ambiguous(F.col("u"), "America/New_York").alias("ambiguous"))


@query("l7_daylight_saving_span", "WITH " + CHANGES + " SELECT event_id // 100 AS part, (max(u) FILTER (event_id % 2 = 1) >= TIMESTAMP '2024-03-10 07:00:00' AND min(u) FILTER (event_id % 2 = 1) < TIMESTAMP '2024-03-10 07:00:00') AS spring, (max(u) FILTER (event_id % 2 = 0) >= TIMESTAMP '2024-11-03 06:00:00' AND min(u) FILTER (event_id % 2 = 0) < TIMESTAMP '2024-11-03 06:00:00') AS autumn FROM inst GROUP BY 1")
def l7(spark, sf):
    """Whether the clocks change between the first and the last instant of each hundred events, in spring and in autumn."""
    from atrium.functions.clock import offset_changes

    part, odd = F.expr("event_id div 100").alias("part"), F.col("event_id") % 2 == 1
    g = _instants(spark, sf).groupBy(part).agg(*[f(F.when(c, F.col("u"))).alias(n) for f, c, n in ((F.min, odd, "a"), (F.max, odd, "b"), (F.min, ~odd, "c"), (F.max, ~odd, "d"))])
    return g.select("part", offset_changes(F.col("a"), F.col("b"), "America/New_York").alias("spring"), offset_changes(F.col("c"), F.col("d"), "America/New_York").alias("autumn"))


@query("l8_clock_drift", sql("SELECT run_id, round(max(abs(frame_idx / 8.0 - t) / t * 100), 6) AS drift_pct FROM v_box WHERE t > 0 GROUP BY run_id"))
def l8(spark, sf):
    d = F.max(F.abs(F.col("frame_idx") / 8.0 - F.col("t")) / F.col("t") * 100)
    return boxes(spark, sf).where("t > 0").groupBy("run_id").agg(F.round(d, 6).alias("drift_pct"))


@query("l12_coverage_strip", sql(
    "SELECT run_id, string_agg(CASE WHEN o >= 0.5 * c THEN '#' ELSE '.' END, '' ORDER BY n) AS strip FROM (SELECT w.run_id, n, w1 / 48.0 AS c, coalesce(sum(least(t_out, (n + 1) * w1 / 48.0) - greatest(t_in, n * w1 / 48.0)), 0.0) AS o FROM (SELECT run_id, max(t_out) AS w1 FROM zone_event GROUP BY run_id) w CROSS JOIN range(48) r(n) LEFT JOIN m ON m.run_id = w.run_id AND m.t_in < (n + 1) * w1 / 48.0 AND n * w1 / 48.0 < m.t_out GROUP BY w.run_id, n, w1) GROUP BY run_id",
    Z0, islands("m", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone = 'waiting')", "run_id")))
def l12(spark, sf):
    z = _z(spark, sf)
    w = spans(z).withColumn("c", F.col("t_end") / 48.0)
    m = merge(z.where("zone = 'waiting'"), ["run_id"]).join(w, "run_id")
    first, last = F.floor(F.col("t_in") / F.col("c")).cast("int"), F.least(F.floor(F.col("t_out") / F.col("c")).cast("int"), F.lit(47))
    parts = m.select("run_id", "t_in", "t_out", "c", F.explode(F.sequence(first, last)).alias("n"))
    o = parts.groupBy("run_id", "n").agg(F.sum(F.greatest(F.lit(0.0), F.least(F.col("t_out"), (F.col("n") + 1) * F.col("c")) - F.greatest(F.col("t_in"), F.col("n") * F.col("c")))).alias("o"))
    cells = w.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(47)))).join(o, ["run_id", "n"], "left")
    mark = F.when(F.coalesce("o", F.lit(0.0)) >= 0.5 * F.col("c"), "#").otherwise(".")
    return cells.groupBy("run_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", mark.alias("m")))), lambda x: x["m"]), "").alias("strip"))


@query("m7_zone_displacement", sql("SELECT run_id, round(max(sqrt((0.01 * x1 + 2.0) * (0.01 * x1 + 2.0) + (0.02 * y1 - 1.0) * (0.02 * y1 - 1.0))), 5) AS worst FROM v_box GROUP BY run_id"))
def m7(spark, sf):
    """The largest move of a vertex under x -> 1.01 x + 2, y -> 1.02 y - 1."""
    dx, dy = 0.01 * F.col("x1") + 2.0, 0.02 * F.col("y1") - 1.0
    return boxes(spark, sf).groupBy("run_id").agg(F.round(F.max(F.sqrt(dx * dx + dy * dy)), 5).alias("worst"))


@query("p9_line_alarms", sql("SELECT run_id, line, count(*) >= 20 AND count(*) FILTER (direction = 'out') > 1.1 * count(*) FILTER (direction = 'in') AS backwards FROM v_crossing GROUP BY ALL"))
def p9(spark, sf):
    n_in, n_out = F.count_if(F.col("direction") == "in"), F.count_if(F.col("direction") == "out")
    return crossings(spark, sf).groupBy("run_id", "line").agg(((F.count("*") >= 20) & (n_out > 1.1 * n_in)).alias("backwards"))


@query("p64_people_text", sql("SELECT run_id, track_id, coalesce(CAST(CASE WHEN count(*) > 50 THEN count(*) END AS VARCHAR), '') AS n FROM v_box GROUP BY ALL"))
def p64(spark, sf):
    n = F.count("*")
    return boxes(spark, sf).groupBy("run_id", "track_id").agg(F.coalesce(F.when(n > 50, n).cast("string"), F.lit("")).alias("n"))


@query("p72_rejection_histogram", sql("SELECT run_id, split_part(reason, '(', 1) AS reason, count(*) AS n FROM (SELECT run_id, CASE WHEN gap > 30 THEN 'gap(' || CAST(CAST(gap AS INT) AS VARCHAR) || ')' WHEN drift > 90 THEN 'drift(far)' ELSE 'none' END AS reason FROM cand) GROUP BY ALL", TRACK, CAND))
def p72(spark, sf):
    from atrium.operators.identity import candidates

    reason = F.when(F.col("gap") > 30, F.concat(F.lit("gap("), F.col("gap").cast("int").cast("string"), F.lit(")"))).when(F.col("drift") > 90, "drift(far)").otherwise("none")
    return candidates(tracks(spark, sf)).groupBy("run_id", F.substring_index(reason, "(", 1).alias("reason")).agg(F.count("*").alias("n"))


@query("f14_activity_timeline", sql(
    "SELECT run_id, track_id, arg_min(zone, rn) AS activity, min(t0) AS t0, max(t1) AS t1, CAST(sum(n) AS INT) AS n FROM (SELECT *, sum(CASE WHEN own IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id ORDER BY rn) AS g FROM (SELECT *, lag(own) OVER (PARTITION BY run_id, track_id ORDER BY rn) AS before FROM owned)) GROUP BY run_id, track_id, g",
    "s AS (SELECT *, row_number() OVER (PARTITION BY run_id, track_id ORDER BY t) AS i, row_number() OVER (PARTITION BY run_id, track_id ORDER BY t) - row_number() OVER (PARTITION BY run_id, track_id, zone ORDER BY t) AS d FROM v_sighting)",
    "runs AS (SELECT run_id, track_id, zone, min(t) AS t0, max(t) AS t1, count(*) AS n, row_number() OVER (PARTITION BY run_id, track_id ORDER BY min(t)) AS rn FROM s GROUP BY run_id, track_id, zone, d)",
    "owned AS (SELECT *, last_value(CASE WHEN n >= 2 OR rn = 1 THEN zone END IGNORE NULLS) OVER (PARTITION BY run_id, track_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS own FROM runs)"))
def f14(spark, sf):
    """Run lengths of a track's activity; a run of one sample joins the one before, and then equal neighbours join."""
    track = Window.partitionBy("run_id", "track_id").orderBy("t")
    own = Window.partitionBy("run_id", "track_id", "zone").orderBy("t")
    s = sightings(spark, sf).withColumn("d", F.row_number().over(track) - F.row_number().over(own))
    r = s.groupBy("run_id", "track_id", "zone", "d").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count("*").alias("n"))
    order = Window.partitionBy("run_id", "track_id").orderBy("t0")
    stays = (F.col("n") >= 2) | (F.row_number().over(order) == 1)
    r = r.withColumn("stays", stays)
    r = r.withColumn("activity", F.last(F.when(F.col("stays"), F.col("zone")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("new", F.coalesce((F.col("activity") != F.lag("activity").over(order)).cast("int"), F.lit(1)))
    r = r.withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy("run_id", "track_id", "g").agg(F.min("activity").alias("activity"), F.min("t0").alias("t0"), F.max("t1").alias("t1"), F.sum("n").cast("int").alias("n")).drop("g")
