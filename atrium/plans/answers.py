"""Queries on answers, roles and visits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.operators import answers as A
from atrium.operators.occupancy import floor_quantile, spans, upper_median, zone_events
from atrium.plans.events import Z0, islands
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sightings, sql

STAFF, WAITING, ENTRY, INTERIOR = ("reception",), ("waiting",), ("main_entrance",), ("waiting", "dining", "bar")


def _z(spark, sf):
    return zone_events(sightings(spark, sf), min_event=0.0)


def _windows(z):
    """The whole run is observed."""
    return spans(z).select("run_id", F.lit(0.0).alias("w0"), F.col("t_end").alias("w1"))


DESK = islands("desk", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone = 'reception' AND role = 'staff')", "run_id")
WIN = "win AS (SELECT run_id, 0.0::DOUBLE AS w0, max(t_out) AS w1 FROM zone_event GROUP BY run_id)"
COVERAGE = sql(
    "SELECT run_id, w1 AS observed_s, coalesce(covered, 0.0) AS covered_s, round(100 * coalesce(covered, 0.0) / w1, 1) AS value, 'EXACT' AS tier, round(100 * coalesce(covered, 0.0) / w1, 1) >= 90.0 AS on_target FROM win LEFT JOIN (SELECT run_id, sum(t_out - t_in) AS covered FROM desk GROUP BY run_id) USING (run_id)",
    Z0, DESK, WIN,
)


@query("entry_desk_coverage", COVERAGE)
@query("g20_desk_coverage", COVERAGE)
def g20(spark, sf):
    z = _z(spark, sf)
    return A.desk_coverage(z, STAFF, _windows(z))


@query("f6_presence", sql("SELECT * FROM m", Z0, islands("m", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone IN ('waiting', 'bar') AND role = 'customer')", "run_id")))
def f6(spark, sf):
    return A.presence(_z(spark, sf), ("waiting", "bar"), "customer")


@query("f18_desk_gaps", sql(
    """SELECT g.run_id, g.a AS t_in, g.b AS t_out, g.b - g.a AS gap_s, count(w.t_in) AS guests_waiting FROM gaps g LEFT JOIN waits w ON w.run_id = g.run_id AND w.t_in < g.b AND g.a < w.t_out GROUP BY g.run_id, g.a, g.b""",
    Z0, DESK, WIN, islands("waits", "(SELECT run_id, t_in, t_out FROM zone_event WHERE zone = 'waiting' AND role = 'customer')", "run_id"),
    "edges AS (SELECT run_id, t_in AS s, t_out AS e FROM desk UNION ALL SELECT run_id, w1, w1 FROM win)",
    "gaps AS (SELECT run_id, a, s AS b FROM (SELECT *, coalesce(max(e) OVER (PARTITION BY run_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS a FROM edges) WHERE s - a >= 20.0)"))
def f18(spark, sf):
    z = _z(spark, sf)
    return A.desk_gaps(z, STAFF, WAITING, _windows(z), least=20.0)


EVID = """evid AS (SELECT run_id, track_id, round(dwell, 2) AS dwell, round(life, 2) AS lifetime, round(least(dwell / life, 1.0), 4) AS share, visits, round(span, 2) AS span, round(span / w1, 4) AS spread, w1 AS observed_s FROM (
SELECT run_id, track_id, sum(CASE WHEN zone = 'reception' THEN duration ELSE 0.0 END) AS dwell, greatest(max(t_out) - min(t_in), 1e-9) AS life, count(*) FILTER (zone = 'reception') AS visits, coalesce(max(t_out) FILTER (zone = 'reception') - min(t_in) FILTER (zone = 'reception'), 0.0) AS span
FROM zone_event GROUP BY run_id, track_id) JOIN win USING (run_id))"""


def _evidence(spark, sf):
    z = _z(spark, sf)
    return A.staff_evidence(z, STAFF, spans(z).withColumnRenamed("t_end", "observed_s"))


@query("g4_staff_evidence", sql("SELECT * FROM evid", Z0, WIN, EVID))
def g4(spark, sf):
    return _evidence(spark, sf)


@query("g5_staff_override", sql("SELECT run_id, track_id, reason, CASE WHEN reason IS NULL THEN 'customer' ELSE 'staff' END AS role FROM (SELECT *, CASE WHEN visits >= 2 AND spread >= 0.25 THEN 'spread' WHEN dwell >= greatest(60.0, least(600.0, 0.5 * observed_s)) THEN 'sole' END AS reason FROM evid)", Z0, WIN, EVID))
def g5(spark, sf):
    return A.staff_override(_evidence(spark, sf))


@query("g6_role_hint", sql("SELECT run_id, track_id, CASE WHEN s >= 0.5 AND s >= 3 * o THEN 'staff' WHEN o >= 1.0 THEN 'customer' END AS hint FROM (SELECT run_id, track_id, sum(CASE WHEN zone = 'reception' THEN duration ELSE 0.0 END) AS s, sum(CASE WHEN zone = 'reception' THEN 0.0 ELSE duration END) AS o FROM zone_event GROUP BY run_id, track_id)", Z0))
def g6(spark, sf):
    desk = F.col("zone") == "reception"
    d = _z(spark, sf).groupBy("run_id", "track_id").agg(F.sum(F.when(desk, F.col("duration")).otherwise(0.0)).alias("s"), F.sum(F.when(desk, 0.0).otherwise(F.col("duration"))).alias("o"))
    return d.select("run_id", "track_id", F.when((F.col("s") >= 0.5) & (F.col("s") >= 3 * F.col("o")), "staff").when(F.col("o") >= 1.0, "customer").alias("hint"))


@query("g7_zone_votes", sql("SELECT run_id, track_id, zone FROM (SELECT run_id, track_id, zone, row_number() OVER (PARTITION BY run_id, track_id ORDER BY count(*) DESC, min(t)) AS rn FROM v_sighting GROUP BY run_id, track_id, zone) WHERE rn = 1"))
def g7(spark, sf):
    votes = sightings(spark, sf).groupBy("run_id", "track_id", "zone").agg(F.count("*").alias("n"), F.min("t").alias("first"))
    return votes.groupBy("run_id", "track_id").agg(F.max_by("zone", F.struct("n", -F.col("first"))).alias("zone"))


ARR = """arr AS (SELECT e.run_id, e.track_id, min(e.t_in) AS t FROM zone_event e JOIN (SELECT run_id, track_id, min(t_in) AS entered FROM zone_event WHERE zone = 'main_entrance' GROUP BY ALL) f USING (run_id, track_id)
WHERE e.zone IN ('waiting', 'dining', 'bar') AND e.t_in >= f.entered GROUP BY e.run_id, e.track_id)"""


@query("g18_region_arrivals", sql("SELECT * FROM arr", Z0, ARR))
def g18(spark, sf):
    return A.region_arrivals(_z(spark, sf), ENTRY, INTERIOR)


@query("g15_first_region_arrival", sql("SELECT run_id, track_id, min(t) AS t FROM arr WHERE track_id IN (SELECT track_id FROM zone_event WHERE role <> 'staff') GROUP BY run_id, track_id", Z0, ARR))
def g15(spark, sf):
    z = _z(spark, sf)
    guests = z.where("role <> 'staff'").select("track_id").distinct()
    return A.region_arrivals(z, ENTRY, INTERIOR).join(guests, "track_id", "left_semi").groupBy("run_id", "track_id").agg(F.min("t").alias("t"))


@query("g19_entry_zone_coverage", sql("SELECT run_id, round(count(DISTINCT track_id) FILTER (zone = 'main_entrance') / count(DISTINCT track_id), 4) AS coverage FROM zone_event WHERE role <> 'staff' GROUP BY run_id", Z0))
def g19(spark, sf):
    seen = F.count_distinct(F.when(F.col("zone") == "main_entrance", F.col("track_id")))
    return _z(spark, sf).where("role <> 'staff'").groupBy("run_id").agg(F.round(seen / F.count_distinct("track_id"), 4).alias("coverage"))


NEAR = """near AS (SELECT DISTINCT g.run_id, g.track_id, g.t FROM v_box g JOIN v_box s ON s.run_id = g.run_id AND s.frame_idx = g.frame_idx
WHERE g.role <> 'staff' AND s.role = 'staff' AND ((g.x1 + g.x2) / 2 - (s.x1 + s.x2) / 2) * ((g.x1 + g.x2) / 2 - (s.x1 + s.x2) / 2) + (g.y2 - s.y2) * (g.y2 - s.y2) <= 4 * (g.y2 - g.y1) * (g.y2 - g.y1))"""


def _near(spark, sf):
    """Guests within two of their body heights of staff in the same frame."""
    b = boxes(spark, sf).withColumn("fx", (F.col("x1") + F.col("x2")) / 2)
    staff = b.where("role = 'staff'").select("run_id", "frame_idx", F.col("fx").alias("sx"), F.col("y2").alias("sy"))
    guests = b.where("role <> 'staff'").join(staff, ["run_id", "frame_idx"])
    d2 = (F.col("fx") - F.col("sx")) * (F.col("fx") - F.col("sx")) + (F.col("y2") - F.col("sy")) * (F.col("y2") - F.col("sy"))
    return guests.where(d2 <= 4 * (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1"))).select("run_id", "track_id", "t").distinct()


@query("e10_staff_proximity", sql("SELECT * FROM near", NEAR))
def e10(spark, sf):
    return _near(spark, sf)


CONTACTS = """runs AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p > 60.0 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id ORDER BY t) AS r FROM (SELECT *, lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS p FROM near)),
contact AS (SELECT run_id, track_id, min(t) AS t FROM runs GROUP BY run_id, track_id, r HAVING max(t) - min(t) >= 1.0)"""


@query("h10_staff_contacts", sql("SELECT * FROM contact", NEAR, CONTACTS))
def h10(spark, sf):
    return A.contacts(_near(spark, sf), gap=60.0, least=1.0)


@query("g21_greet_latency", sql(
    "SELECT run_id, count(*) AS guests, count(wait) AS greeted, round(list_sort(list(wait) FILTER (wait IS NOT NULL))[count(wait) // 2 + 1], 2) AS median_s, CASE WHEN count(wait) > 0 THEN 'PROXY' ELSE 'UNKNOWN' END AS tier FROM (SELECT a.run_id, a.track_id, min(n.t) FILTER (n.t >= a.t) - a.t AS wait FROM arr a LEFT JOIN near n USING (run_id, track_id) GROUP BY a.run_id, a.track_id, a.t) GROUP BY run_id",
    Z0, ARR, NEAR))
def g21(spark, sf):
    return A.greet_latency(A.region_arrivals(_z(spark, sf), ENTRY, INTERIOR), _near(spark, sf))


@query("h9_visits", sql(
    "SELECT run_id, track_id, CASE WHEN direction = 'in' THEN t END AS t_in, CASE WHEN status = 'closed' THEN nt WHEN status = 'entry_missed' THEN t END AS t_out, status FROM (SELECT *, CASE WHEN direction = 'in' AND nd = 'out' THEN 'closed' WHEN direction = 'in' AND nd = 'in' THEN 'exit_missed' WHEN direction = 'in' THEN 'open' ELSE 'entry_missed' END AS status FROM (SELECT *, lead(direction) OVER o AS nd, lead(t) OVER o AS nt, lag(direction) OVER o AS ld FROM v_crossing WINDOW o AS (PARTITION BY run_id, track_id ORDER BY t, direction, line))) WHERE direction = 'in' OR coalesce(ld, 'out') <> 'in'"))
def h9(spark, sf):
    return A.visits(crossings(spark, sf))


@query("g27_visit_counts", sql(
    "SELECT * FROM (SELECT run_id, count(*) AS unique_people, count(*) FILTER (n > 1) AS repeat_visitors FROM (SELECT run_id, track_id, count(*) AS n FROM visit GROUP BY ALL) GROUP BY run_id) JOIN (SELECT run_id, count(*) AS n_visits, count(*) FILTER (status = 'closed') AS closed, count(*) FILTER (status = 'open') AS open, count(*) FILTER (status = 'exit_missed') AS exit_missed, count(*) FILTER (status = 'entry_missed') AS entry_missed, median(nt - t) FILTER (status = 'closed') AS median_s FROM visit GROUP BY run_id) USING (run_id)",
    "visit AS (SELECT *, CASE WHEN direction = 'in' AND nd = 'out' THEN 'closed' WHEN direction = 'in' AND nd = 'in' THEN 'exit_missed' WHEN direction = 'in' THEN 'open' ELSE 'entry_missed' END AS status FROM (SELECT *, lead(direction) OVER o AS nd, lead(t) OVER o AS nt, lag(direction) OVER o AS ld FROM v_crossing WINDOW o AS (PARTITION BY run_id, track_id ORDER BY t, direction, line)) WHERE direction = 'in' OR coalesce(ld, 'out') <> 'in')"))
def g27(spark, sf):
    return A.visit_counts(A.visits(crossings(spark, sf)))


CONF = """conf AS (SELECT e.run_id, e.track_id, greatest(0, least(100, 40 + CASE WHEN life >= 60 THEN 20 WHEN life >= 20 THEN 10 ELSE 0 END + CASE WHEN frags <= 1 THEN 15 WHEN frags <= 3 THEN 5 ELSE -10 END + CASE WHEN c.track_id IS NOT NULL THEN 15 ELSE 0 END)) AS confidence
FROM (SELECT run_id, track_id, max(t_out) - min(t_in) AS life, count(*) AS frags FROM zone_event WHERE role <> 'staff' GROUP BY ALL) e LEFT JOIN (SELECT DISTINCT run_id, track_id FROM v_crossing) c USING (run_id, track_id))"""


def _confidence(spark, sf):
    crossed = crossings(spark, sf).select("run_id", "track_id").distinct().withColumn("crossed", F.lit(15))
    e = _z(spark, sf).where("role <> 'staff'").groupBy("run_id", "track_id").agg((F.max("t_out") - F.min("t_in")).alias("life"), F.count("*").alias("frags"))
    life = F.when(F.col("life") >= 60, 20).when(F.col("life") >= 20, 10).otherwise(0)
    frags = F.when(F.col("frags") <= 1, 15).when(F.col("frags") <= 3, 5).otherwise(-10)
    points = F.lit(40) + life + frags + F.coalesce("crossed", F.lit(0))
    return e.join(crossed, ["run_id", "track_id"], "left").select("run_id", "track_id", F.greatest(F.lit(0), F.least(F.lit(100), points)).alias("confidence"))


@query("g13_id_confidence", sql("SELECT * FROM conf", Z0, CONF))
def g13(spark, sf):
    return _confidence(spark, sf)


@query("g22_guest_count_range", sql("SELECT run_id, count(*) AS value, count(*) FILTER (confidence >= 60) AS low, count(*) AS high, CASE WHEN count(*) = 0 THEN 'UNKNOWN' ELSE 'ESTIMATE' END AS tier FROM conf GROUP BY run_id", Z0, CONF))
def g22(spark, sf):
    n = F.count("*")
    return _confidence(spark, sf).groupBy("run_id").agg(n.alias("value"), F.count_if(F.col("confidence") >= 60).alias("low"), n.alias("high"), F.when(n == 0, A.UNKNOWN).otherwise(A.ESTIMATE).alias("tier"))


@query("g26_customer_registry", sql("SELECT run_id, track_id, printf('C%03d', row_number() OVER (PARTITION BY run_id ORDER BY t, track_id)) AS customer FROM (SELECT run_id, track_id, min(t_in) AS t FROM zone_event WHERE role <> 'staff' GROUP BY run_id, track_id)", Z0))
def g26(spark, sf):
    first = _z(spark, sf).where("role <> 'staff'").groupBy("run_id", "track_id").agg(F.min("t_in").alias("t"))
    n = F.row_number().over(Window.partitionBy("run_id").orderBy("t", "track_id"))
    return first.select("run_id", "track_id", F.format_string("C%03d", n).alias("customer"))


PEOPLE = """people AS (SELECT e.run_id, e.track_id, e.role, e.t0, e.t1, coalesce(w.wait_s, 0.0) AS wait_s, c.t - e.t0 AS greet_s, coalesce(w.wait_s, 0.0) >= 2.0 AND c.t IS NULL AS flagged
FROM (SELECT run_id, track_id, role, min(t_in) AS t0, max(t_out) AS t1 FROM zone_event GROUP BY ALL) e LEFT JOIN (SELECT run_id, track_id, sum(duration) AS wait_s FROM zone_event WHERE zone = 'waiting' GROUP BY ALL) w USING (run_id, track_id) LEFT JOIN (SELECT run_id, track_id, min(t) AS t FROM near GROUP BY ALL) c USING (run_id, track_id))"""


@query("g25_people_rows", sql("SELECT * FROM people", Z0, NEAR, PEOPLE))
@query("e1_lookup_joins", sql("SELECT * FROM people", Z0, NEAR, PEOPLE))
def g25(spark, sf):
    z, keys = _z(spark, sf), ["run_id", "track_id"]
    waits = z.where("zone = 'waiting'").groupBy(*keys).agg(F.sum("duration").alias("wait_s"))
    first = _near(spark, sf).groupBy(*keys).agg(F.min("t").alias("c"))
    p = z.groupBy(*keys, "role").agg(F.min("t_in").alias("t0"), F.max("t_out").alias("t1")).join(waits, keys, "left").join(first, keys, "left")
    wait = F.coalesce("wait_s", F.lit(0.0))
    return p.select(*keys, "role", "t0", "t1", wait.alias("wait_s"), (F.col("c") - F.col("t0")).alias("greet_s"), ((wait >= 2.0) & F.col("c").isNull()).alias("flagged"))


@query("b3_people_csv_lines", sql("SELECT run_id, concat_ws(',', track_id, role, printf('%.3f', t0), printf('%.3f', t1), printf('%.3f', wait_s), coalesce(printf('%.3f', greet_s), '')) AS line FROM people", Z0, NEAR, PEOPLE))
def b3(spark, sf):
    three = lambda c: F.format_string("%.3f", F.col(c))
    # What was not measured is empty, never 0.
    greet = F.when(F.col("greet_s").isNotNull(), three("greet_s")).otherwise("")
    return g25(spark, sf).select("run_id", F.concat_ws(",", "track_id", "role", three("t0"), three("t1"), three("wait_s"), greet).alias("line"))


@query("g29_cross_check", sql(
    """SELECT run_id, line_n, region_n, CASE WHEN coverage < 0.5 AND movers >= 5 THEN 'misplaced_entry' WHEN line_n IS NULL AND region_n IS NULL THEN 'neither' WHEN region_n IS NULL THEN 'line_only' WHEN line_n IS NULL THEN 'region_only'
 WHEN line_n = 0 AND region_n = 0 THEN CASE WHEN movers >= 5 THEN 'neither' ELSE 'quiet' END WHEN (greatest(line_n, region_n) - least(line_n, region_n)) / greatest(line_n, region_n) <= 0.25 THEN 'agree' WHEN line_n > region_n THEN 'line_high' ELSE 'region_high' END AS verdict
FROM (SELECT run_id, count(DISTINCT track_id) AS movers, round(count(DISTINCT track_id) FILTER (zone = 'main_entrance') / count(DISTINCT track_id), 4) AS coverage FROM zone_event WHERE role <> 'staff' GROUP BY run_id)
LEFT JOIN (SELECT run_id, count(DISTINCT track_id) AS line_n FROM v_crossing WHERE direction = 'in' AND line = 'entry line' AND role <> 'staff' GROUP BY run_id) USING (run_id) LEFT JOIN (SELECT run_id, count(*) AS region_n FROM arr GROUP BY run_id) USING (run_id)""", Z0, ARR))
def g29(spark, sf):
    z = _z(spark, sf)
    seen = F.count_distinct(F.when(F.col("zone") == "main_entrance", F.col("track_id")))
    base = z.where("role <> 'staff'").groupBy("run_id").agg(F.count_distinct("track_id").alias("movers"), F.round(seen / F.count_distinct("track_id"), 4).alias("coverage"))
    line = crossings(spark, sf).where("direction = 'in' and line = 'entry line' and role <> 'staff'").groupBy("run_id").agg(F.count_distinct("track_id").alias("line_n"))
    region = A.region_arrivals(z, ENTRY, INTERIOR).groupBy("run_id").agg(F.count("*").alias("region_n"))
    verdict = A.cross_check(F.col("line_n"), F.col("region_n"), F.col("movers"), F.col("coverage"))
    return base.join(line, "run_id", "left").join(region, "run_id", "left").select("run_id", "line_n", "region_n", verdict.alias("verdict"))


@query("g30_arrival_tier", sql(
    "SELECT run_id, CASE WHEN hi = 0 THEN 'CONFIRMED' WHEN (hi - lo) / hi <= 0.25 THEN 'CONFIRMED' ELSE 'UNCERTAIN' END AS tier FROM (SELECT run_id, greatest(a, b) AS hi, least(a, b) AS lo FROM (SELECT run_id, count(*) FILTER (line = 'entry line') AS a, count(*) FILTER (line = 'side door') AS b FROM v_crossing WHERE direction = 'in' GROUP BY run_id))"))
def g30(spark, sf):
    c = crossings(spark, sf).where("direction = 'in'").groupBy("run_id").agg(F.count_if(F.col("line") == "entry line").alias("a"), F.count_if(F.col("line") == "side door").alias("b"))
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    return c.select("run_id", F.when((hi == 0) | ((hi - lo) / hi <= 0.25), "CONFIRMED").otherwise("UNCERTAIN").alias("tier"))


@query("g31_event_tier", sql(
    "SELECT run_id, track_id, t, CASE WHEN line IS NULL THEN 'UNCERTAIN' WHEN weak = 0 THEN 'CONFIRMED' WHEN weak = 1 THEN 'PROBABLE' ELSE 'UNCERTAIN' END AS tier FROM (SELECT *, CASE WHEN x < 100.0 THEN 1 ELSE 0 END + CASE WHEN y < 200.0 THEN 1 ELSE 0 END AS weak FROM v_crossing)"))
def g31(spark, sf):
    weak = (F.col("x") < 100.0).cast("int") + (F.col("y") < 200.0).cast("int")
    tier = F.when(F.col("line").isNull(), "UNCERTAIN").when(weak == 0, "CONFIRMED").when(weak == 1, "PROBABLE").otherwise("UNCERTAIN")
    return crossings(spark, sf).select("run_id", "track_id", "t", tier.alias("tier"))


@query("g32_tier_summary", sql("SELECT run_id, count(*) FILTER (weak = 0) AS confirmed, count(*) FILTER (weak = 1) AS probable, count(*) FILTER (weak = 2) AS uncertain FROM (SELECT *, CASE WHEN x < 100.0 THEN 1 ELSE 0 END + CASE WHEN y < 200.0 THEN 1 ELSE 0 END AS weak FROM v_crossing) GROUP BY run_id"))
def g32(spark, sf):
    t = g31(spark, sf).groupBy("run_id").pivot("tier", ["CONFIRMED", "PROBABLE", "UNCERTAIN"]).agg(F.count(F.lit(1)))
    return t.select("run_id", *[F.coalesce(k, F.lit(0)).alias(k.lower()) for k in ("CONFIRMED", "PROBABLE", "UNCERTAIN")])


@query("g33_zone_anomaly_baseline", sql(
    "SELECT run_id, zone, m, n, round(CASE WHEN c >= 3 THEN (n - a) / CASE WHEN s * s < 1e-6 THEN 1.0 ELSE s END END, 4) AS z FROM (SELECT *, avg(n) OVER h AS a, stddev_pop(n) OVER h AS s, count(*) OVER h AS c FROM (SELECT run_id, zone, CAST(floor(t / 60) AS INT) AS m, count(*) AS n FROM v_sighting GROUP BY 1, 2, 3) WINDOW h AS (PARTITION BY run_id, zone ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"))
def g33(spark, sf):
    """Each count is scored against those before it only."""
    n = sightings(spark, sf).groupBy("run_id", "zone", F.floor(F.col("t") / 60).cast("int").alias("m")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("run_id", "zone").orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    s = F.stddev_pop("n").over(before)
    n = n.withColumn("a", F.avg("n").over(before)).withColumn("s", F.when(s * s < 1e-6, 1.0).otherwise(s)).withColumn("c", F.count("*").over(before))
    return n.select("run_id", "zone", "m", "n", F.round(F.when(F.col("c") >= 3, (F.col("n") - F.col("a")) / F.col("s")), 4).alias("z"))


@query("g64_entry_direction", sql(
    "SELECT run_id, line, count(*) AS evidence, CASE WHEN count(*) >= 6 THEN sum(CASE WHEN direction = 'in' THEN 1 ELSE -1 END * (coalesce(after, 0) - coalesce(before, 0))) END AS score FROM (SELECT c.*, (SELECT count(*) FROM v_sighting s WHERE s.run_id = c.run_id AND s.track_id = c.track_id AND s.zone = 'dining' AND s.t > c.t AND s.t <= c.t + 60) AS after, (SELECT count(*) FROM v_sighting s WHERE s.run_id = c.run_id AND s.track_id = c.track_id AND s.zone = 'dining' AND s.t < c.t AND s.t >= c.t - 60) AS before FROM v_crossing c) GROUP BY run_id, line"))
def g64(spark, sf):
    s = sightings(spark, sf).where("zone = 'dining'").select("run_id", "track_id", F.col("t").alias("st"))
    c = crossings(spark, sf)
    near = c.join(s, ["run_id", "track_id"]).where("st >= t - 60 and st <= t + 60 and st <> t").select("run_id", "line", "direction", F.when(F.col("st") > F.col("t"), 1).otherwise(-1).alias("side"))
    sign = F.when(F.col("direction") == "in", 1).otherwise(-1)
    sums = near.groupBy("run_id", "line").agg(F.sum(sign * F.col("side")).alias("s"))
    n = c.groupBy("run_id", "line").agg(F.count("*").alias("evidence")).join(sums, ["run_id", "line"], "left")
    return n.select("run_id", "line", "evidence", F.when(F.col("evidence") >= 6, F.coalesce("s", F.lit(0))).alias("score"))


@query("l15_median_conventions", sql("SELECT run_id, median(duration) AS true_median, list_sort(list(duration))[count(*) // 2 + 1] AS upper_median, list_sort(list(duration))[CAST(floor(0.5 * (count(*) - 1)) AS INT) + 1] AS floor_median, round(quantile_cont(duration, 0.9), 6) AS p90 FROM zone_event GROUP BY run_id", Z0))
@query("g58_percentiles", sql("SELECT run_id, median(duration) AS true_median, list_sort(list(duration))[count(*) // 2 + 1] AS upper_median, list_sort(list(duration))[CAST(floor(0.5 * (count(*) - 1)) AS INT) + 1] AS floor_median, round(quantile_cont(duration, 0.9), 6) AS p90 FROM zone_event GROUP BY run_id", Z0))
def l15(spark, sf):
    return _z(spark, sf).groupBy("run_id").agg(F.median("duration").alias("true_median"), upper_median("duration").alias("upper_median"), floor_quantile("duration", 0.5).alias("floor_median"), F.round(F.percentile("duration", 0.9), 6).alias("p90"))
