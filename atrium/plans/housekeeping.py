"""Queries on checks, stamps and scorecards of runs (rows of tables A, B, G, I, J, L, M and P of the inventory that report on a run as a whole)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atrium.operators.occupancy import zone_events
from atrium.plans.events import Z0
from atrium.plans.registry import query
from atrium.sources.adapters import ZONES, boxes, crossings, sightings, sql


def _z(spark, sf):
    return zone_events(sightings(spark, sf), min_event=0.0)


@query("a10_repeated_keys", sql("SELECT run_id, line || '.' || track_id AS key, count(*) AS times, min(t) AS first_t FROM v_crossing GROUP BY run_id, line, track_id HAVING count(*) > 1"))
def a10(spark, sf):
    """Dotted keys that a run's list gives more than once, of which a map would keep the last in silence."""
    key = F.concat_ws(".", "line", "track_id")
    n = crossings(spark, sf).groupBy("run_id", "line", "track_id").agg(F.count("*").alias("times"), F.min("t").alias("first_t"))
    return n.where("times > 1").select("run_id", key.alias("key"), "times", "first_t")


NAMES = "names AS (SELECT DISTINCT run_id, printf('cam%d_%03d.mp4', run_id % 4, CAST(floor(t / 300.0) AS INT)) AS name FROM v_sighting)"


@query("a14_chunk_choice", sql("SELECT part, count(*) AS found, CASE WHEN count(*) = 1 THEN min(name) END AS chosen, CASE WHEN count(*) = 1 THEN 'ok' ELSE 'ERROR: several match' END AS verdict FROM (SELECT *, regexp_extract(name, '_([0-9]+)', 1) AS part FROM names) GROUP BY part", NAMES))
def a14(spark, sf):
    """The one file that a part's number names; several are an error and none is chosen."""
    chunk = F.floor(F.col("t") / 300.0).cast("int")
    names = sightings(spark, sf).select("run_id", F.format_string("cam%d_%03d.mp4", F.col("run_id") % 4, chunk).alias("name")).distinct()
    found = names.groupBy(F.regexp_extract("name", "_([0-9]+)", 1).alias("part")).agg(F.count("*").alias("found"), F.min("name").alias("name"))
    one = F.col("found") == 1
    return found.select("part", "found", F.when(one, F.col("name")).alias("chosen"), F.when(one, "ok").otherwise("ERROR: several match").alias("verdict"))


@query("b7_key_violations", sql("SELECT run_id, frame_idx, user AS track_id, count(*) AS times FROM (SELECT run_id, frame_idx, regexp_replace(track_id, 'm', '') AS user FROM v_box) GROUP BY ALL HAVING count(*) > 1"))
def b7(spark, sf):
    """Rows that a table keyed by run, frame and raw track would refuse; mirror images carry their person's raw id."""
    raw = F.regexp_replace("track_id", "m", "").alias("track_id")
    return boxes(spark, sf).groupBy("run_id", "frame_idx", raw).agg(F.count("*").alias("times")).where("times > 1")


@query("b17_label_seed", sql("SELECT run_id, frame_idx + 1 AS frame, printf('%d,%s,%.2f,%.2f,%.2f,%.2f,1,1,1', frame_idx + 1, regexp_replace(track_id, 'm', '9'), x1, y1, x2 - x1, y2 - y1) AS line, frame_idx + 1 <= n AS usable FROM v_box JOIN (SELECT run_id, max(frame_idx) + 1 AS n FROM v_box WHERE track_id NOT LIKE 'm%' GROUP BY run_id) USING (run_id)"))
def b17(spark, sf):
    """Predictions as label lines to start from, frames counted from one; a line outside the run's images is not usable."""
    b = boxes(spark, sf)
    images = b.where(~F.col("track_id").startswith("m")).groupBy("run_id").agg((F.max("frame_idx") + 1).alias("n"))
    frame = F.col("frame_idx") + 1
    line = F.format_string("%d,%s,%.2f,%.2f,%.2f,%.2f,1,1,1", frame, F.regexp_replace("track_id", "m", "9"), "x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return b.join(images, "run_id").select("run_id", frame.alias("frame"), line.alias("line"), (frame <= F.col("n")).alias("usable"))


STAMP = """stamp AS (SELECT run_id, printf('{"boxes":%d,"frames":%d,"last_frame":%d,"tracks":%d}', count(*), count(DISTINCT frame_idx), max(frame_idx), count(DISTINCT track_id)) AS stamp FROM v_box GROUP BY run_id)"""


def _stamps(spark, sf):
    b = boxes(spark, sf).groupBy("run_id")
    facts = b.agg(F.count("*").alias("boxes"), F.count_distinct("frame_idx").alias("frames"), F.max("frame_idx").alias("last_frame"), F.count_distinct("track_id").alias("tracks"))
    return facts.select("run_id", F.to_json(F.struct("boxes", "frames", "last_frame", "tracks")).alias("stamp"))


@query("p61_provenance_stamp", sql("SELECT run_id, stamp FROM stamp", STAMP))
def p61(spark, sf):
    """What a run's counts stand on, in one record with sorted names."""
    return _stamps(spark, sf)


@query("g48_fingerprint", sql("SELECT run_id, left(sha256(stamp), 12) AS fingerprint FROM stamp", STAMP))
def g48(spark, sf):
    """Twelve hex digits of the stamp's hash: equal for runs that stand on equal inputs."""
    return _stamps(spark, sf).select("run_id", F.substring(F.sha2("stamp", 256), 1, 12).alias("fingerprint"))


@query("g65_status_counts", sql("SELECT run_id, status, count(*) AS tracks FROM (SELECT run_id, track_id, CASE WHEN count(DISTINCT zone) >= 3 THEN 'full' WHEN count(DISTINCT zone) = 2 THEN 'partial' ELSE 'single' END AS status FROM v_sighting GROUP BY ALL) GROUP BY ALL"))
def g65(spark, sf):
    """How many tracks of a run support answers on many zones, two or one."""
    n = F.count_distinct("zone")
    tracks = sightings(spark, sf).groupBy("run_id", "track_id").agg(F.when(n >= 3, "full").when(n == 2, "partial").otherwise("single").alias("status"))
    return tracks.groupBy("run_id", "status").agg(F.count("*").alias("tracks"))


@query("i9_extended_lines", sql("SELECT run_id, line, round(cx - 0.8 * (bx - ax), 4) AS x1, round(cy - 0.8 * (b_y - ay), 4) AS y1, round(cx + 0.8 * (bx - ax), 4) AS x2, round(cy + 0.8 * (b_y - ay), 4) AS y2 FROM (SELECT run_id, line, min(x) AS ax, max(x) AS bx, min(y) AS ay, max(y) AS b_y, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy FROM v_crossing GROUP BY run_id, line)"))
def i9(spark, sf):
    """A line through the places where people crossed, made 60 % longer about its centre, as the proposal for the settings."""
    ends = crossings(spark, sf).groupBy("run_id", "line").agg(F.min("x").alias("ax"), F.max("x").alias("bx"), F.min("y").alias("ay"), F.max("y").alias("by"))
    at = lambda a, b, sign: F.round((F.col(a) + F.col(b)) / 2 + sign * 0.8 * (F.col(b) - F.col(a)), 4)
    return ends.select("run_id", "line", at("ax", "bx", -1).alias("x1"), at("ay", "by", -1).alias("y1"), at("ax", "bx", 1).alias("x2"), at("ay", "by", 1).alias("y2"))


@query("j1_merged_profiles", sql("SELECT run_id, coalesce(b.zone, o.zone) AS zone, coalesce(o.dwell, b.dwell) AS dwell, o.dwell IS NOT NULL AS own FROM (SELECT run_id, zone, dwell FROM (SELECT zone, max(duration) AS dwell FROM zone_event WHERE role = 'staff' GROUP BY zone), (SELECT DISTINCT run_id FROM v_sighting)) b FULL JOIN (SELECT run_id, zone, max(duration) AS dwell FROM zone_event WHERE role <> 'staff' GROUP BY run_id, zone HAVING count(*) >= 20) o USING (run_id, zone)", Z0))
def j1(spark, sf):
    """Each run's settings: its own where it has them, else the base's, section by section."""
    z = _z(spark, sf)
    base = z.where("role = 'staff'").groupBy("zone").agg(F.max("duration").alias("usual"))
    sections = F.explode(F.array(*[F.lit(v) for v in ZONES.values()])).alias("zone")
    base = z.select("run_id").distinct().select("run_id", sections).join(base, "zone")
    own = z.where("role <> 'staff'").groupBy("run_id", "zone").agg(F.max("duration").alias("dwell"), F.count("*").alias("n")).where("n >= 20").drop("n")
    both = base.join(own, ["run_id", "zone"], "full")
    return both.select("run_id", "zone", F.coalesce("dwell", "usual").alias("dwell"), F.col("dwell").isNotNull().alias("own"))


@query("l13_target_lines", sql("SELECT run_id, printf('%s: %s %.1f%% (target %.1f%%)', CASE WHEN share >= 15.0 THEN 'PASS' ELSE 'FAIL' END, zone, share, 15.0) AS line FROM (SELECT run_id, zone, floor(1000.0 * count(*) / sum(count(*)) OVER (PARTITION BY run_id)) / 10.0 AS share FROM v_sighting GROUP BY run_id, zone)"))
def l13(spark, sf):
    """A line of text for each zone's share of sightings against its target, cut to one decimal."""
    s = sightings(spark, sf)
    n = s.groupBy("run_id", "zone").agg(F.count("*").alias("n")).join(s.groupBy("run_id").agg(F.count("*").alias("total")), "run_id")
    share = F.floor(1000.0 * F.col("n") / F.col("total")) / 10.0
    word = F.when(share >= 15.0, "PASS").otherwise("FAIL")
    return n.select("run_id", F.format_string("%s: %s %.1f%% (target %.1f%%)", word, "zone", share, F.lit(15.0)).alias("line"))


@query("m1_preflight", sql("""SELECT run_id, people, seen, CASE WHEN entries = 0 THEN 'ERROR: no entry zone' WHEN inner_zones = 0 THEN 'ERROR: no interior zone' WHEN people >= 5 AND seen < 0.5 * people THEN 'WARN: entry zone misplaced' ELSE 'ok' END AS verdict
FROM (SELECT run_id, count(*) FILTER (e > 0) AS entries, count(*) FILTER (i > 0) AS inner_zones, count(*) AS people, count(*) FILTER (e > 0) AS seen FROM (SELECT run_id, track_id, count(*) FILTER (zone = 'main_entrance') AS e, count(*) FILTER (zone IN ('waiting', 'dining')) AS i FROM zone_event GROUP BY ALL) GROUP BY run_id)""", Z0))
def m1(spark, sf):
    """Whether a run's zones can give answers: an entry and an interior, and an entry through which at least half of the people came."""
    people = _z(spark, sf).groupBy("run_id", "track_id").agg(F.count_if(F.col("zone") == "main_entrance").alias("e"), F.count_if(F.col("zone").isin("waiting", "dining")).alias("i"))
    runs = people.groupBy("run_id").agg(F.count("*").alias("people"), F.count_if(F.col("e") > 0).alias("seen"), F.count_if(F.col("i") > 0).alias("inside"))
    missed = (F.col("people") >= 5) & (F.col("seen") < 0.5 * F.col("people"))
    verdict = F.when(F.col("seen") == 0, "ERROR: no entry zone").when(F.col("inside") == 0, "ERROR: no interior zone").when(missed, "WARN: entry zone misplaced").otherwise("ok")
    return runs.select("run_id", "people", "seen", verdict.alias("verdict"))


CARD = """card AS (SELECT run_id, 'tracks' AS metric, CAST(count(DISTINCT track_id) AS DOUBLE) AS value FROM v_box GROUP BY run_id
  UNION ALL SELECT run_id, 'crossings in', CAST(count(*) FILTER (direction = 'in') AS DOUBLE) FROM v_crossing GROUP BY run_id
  UNION ALL SELECT run_id, 'crossings out', CAST(count(*) FILTER (direction = 'out') AS DOUBLE) FROM v_crossing GROUP BY run_id
  UNION ALL SELECT run_id, 'visits', CAST(count(*) FILTER (role <> 'staff') AS DOUBLE) FROM zone_event GROUP BY run_id
  UNION ALL SELECT run_id, 'staff seconds', sum(t_out - t_in) FILTER (role = 'staff') FROM zone_event GROUP BY run_id)"""


def _card(spark, sf):
    one = lambda df, name, value: df.groupBy("run_id").agg(value.cast("double").alias("value")).select("run_id", F.lit(name).alias("metric"), "value")
    c, z = crossings(spark, sf), _z(spark, sf)
    card = one(boxes(spark, sf), "tracks", F.count_distinct("track_id"))
    for way in ("in", "out"):
        card = card.unionByName(one(c, f"crossings {way}", F.count_if(F.col("direction") == way)))
    card = card.unionByName(one(z, "visits", F.count_if(F.col("role") != "staff")))
    return card.unionByName(one(z, "staff seconds", F.sum(F.when(F.col("role") == "staff", F.col("t_out") - F.col("t_in")))))


@query("p4_scorecard", sql("SELECT run_id, metric, value FROM card", Z0, CARD))
def p4(spark, sf):
    """All metrics of a run as rows; what was not measured is null, not 0."""
    return _card(spark, sf)


@query("p56_scorecard_reconciled", sql("SELECT run_id, a.value AS n_in, b.value AS n_out, abs(a.value - b.value) / greatest(a.value, b.value, 1) <= 0.2 AS reconciled FROM card a JOIN card b USING (run_id) WHERE a.metric = 'crossings in' AND b.metric = 'crossings out'", Z0, CARD))
def p56(spark, sf):
    """From a finished scorecard: whether as many came as went, to a fifth."""
    pick = lambda name: F.max(F.when(F.col("metric") == name, F.col("value")))
    both = _card(spark, sf).groupBy("run_id").agg(pick("crossings in").alias("n_in"), pick("crossings out").alias("n_out")).where("n_in is not null")
    return both.withColumn("reconciled", F.abs(F.col("n_in") - F.col("n_out")) / F.greatest("n_in", "n_out", F.lit(1.0)) <= 0.2)


@query("p63_decision_summary", sql("SELECT run_id, decision, count(*) AS n, round(min(conf), 4) AS least FROM (SELECT *, CASE WHEN conf < 0.35 THEN 'dropped: confidence' WHEN y2 - y1 < 110 THEN 'dropped: height' WHEN track_id LIKE 'm%' THEN 'warned: mirror' ELSE 'kept' END AS decision FROM v_box) GROUP BY run_id, decision"))
def p63(spark, sf):
    """How often each rule decided on a box of a run; the first rule that applies decides."""
    low, small, mirror = F.col("conf") < 0.35, F.col("y2") - F.col("y1") < 110, F.col("track_id").startswith("m")
    decision = F.when(low, "dropped: confidence").when(small, "dropped: height").when(mirror, "warned: mirror").otherwise("kept")
    return boxes(spark, sf).groupBy("run_id", decision.alias("decision")).agg(F.count("*").alias("n"), F.round(F.min("conf"), 4).alias("least"))
