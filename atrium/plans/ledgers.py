"""Queries on validity, funnels, logs, clocks, exposures and other row-wise rules (tables A, B, C, D, F, G, L, N and P of the inventory)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.operators import detections as D
from atrium.operators.intervals import clip, merge
from atrium.operators.occupancy import floor_quantile, runs_of, spans, upper_median, zone_events
from atrium.plans.events import W, Z0, islands, windows
from atrium.plans.registry import query
from atrium.scratch import shared_dir, write_table
from atrium.sources import readers as R
from atrium.sources import sinks as S
from atrium.sources.adapters import boxes, crossings, sightings, sql, table

KEY = ["run_id", "frame_idx", "track_id"]
ID = "CAST(regexp_replace(track_id, 'm', '9') AS INT)"


def _events(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.expr("cast(event_id div 5000 as int)").alias("run_id"), "event_id", (F.col("event_id") % 5000).alias("i"), "user_id", "event_type", "value", "ts")


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/_atrium_tmp/files-{uuid.uuid4().hex}"


def _z(spark, sf):
    return zone_events(sightings(spark, sf), min_event=0.0)


# Readers and writers.


@query("a4_run_frame_logs", sql(f"SELECT CAST(run_id AS VARCHAR) AS run, frame_idx, t, CAST({ID} AS VARCHAR) AS track_id, x1, y1, x2, y2 FROM v_box"))
def a4(spark, sf):
    """Compressed frame logs, a folder for each run; the run comes from the path."""
    b = boxes(spark, sf).withColumn("id", F.regexp_replace("track_id", "m", "9").cast("double"))
    f = b.groupBy("run_id", "frame_idx", "t").agg(F.collect_list(F.array("id", "x1", "y1", "x2", "y2")).alias("boxes"))
    one = F.concat(F.lit("["), F.concat_ws(",", F.col("frame_idx").cast("string"), F.col("t").cast("string"), F.to_json("boxes")), F.lit("]"))
    docs = f.select("run_id", F.floor(F.col("frame_idx") / 100).alias("part"), one.alias("one")).groupBy("run_id", "part").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("one")), F.lit("]")).alias("value"))
    path = _folder(spark)
    docs.select("run_id", "value").write.partitionBy("run_id").option("compression", "gzip").text(path)
    return R.run_frame_logs(spark, path)


@query("a3_frame_records", sql(f"SELECT run_id, frame_idx, t, CAST({ID} AS VARCHAR) AS track_id, x1, y1, x2, y2 FROM v_box WHERE frame_idx >= 40"))
def a3(spark, sf):
    """Logs read a frame at a time, from a frame on; each run's is written as one array in as many records as it has frames."""
    from pyspark.sql import Window

    b = boxes(spark, sf).withColumn("id", F.regexp_replace("track_id", "m", "9").cast("double"))
    f = b.groupBy("run_id", "frame_idx", "t").agg(F.collect_list(F.array("id", "x1", "y1", "x2", "y2")).alias("boxes"))
    one = F.concat_ws(",", F.col("frame_idx").cast("string"), F.col("t").cast("string"), F.to_json("boxes"))
    run = Window.partitionBy("run_id")
    first = F.col("frame_idx") == F.min("frame_idx").over(run)
    # A record ends with the separator, so a frame is written without the closing brackets of its boxes, and the log stays open.
    text = F.concat(F.when(first, "[[").otherwise(""), F.expr("substring(one, 1, length(one) - 2)"))
    path = _folder(spark)
    rows = f.withColumn("one", one).select("run_id", "frame_idx", text.alias("value"))
    rows.repartition("run_id").sortWithinPartitions("run_id", "frame_idx").select("run_id", "value").write.partitionBy("run_id").option("lineSep", "]]],[").text(path)
    return R.frame_records(spark, path).where("frame_idx >= 40")


@query("a7_people_files", sql("SELECT CAST(run_id AS VARCHAR) AS run, track_id, CAST(count(*) AS VARCHAR) AS sightings, CASE WHEN count(*) > 50 THEN CAST(max(t) AS VARCHAR) END AS last_t FROM v_sighting GROUP BY run_id, track_id"))
def a7(spark, sf):
    """People as CSV files in a folder for each run, read again; what was not measured is null."""
    n = F.count("*")
    people = sightings(spark, sf).groupBy("run_id", "track_id").agg(n.alias("sightings"), F.when(n > 50, F.max("t")).alias("last_t"))
    path = _folder(spark)
    people.write.partitionBy("run_id").option("header", True).option("nullValue", "").csv(path)
    rows = R.people_csv(spark, f"{path}/*/*.csv")
    return rows.select(F.regexp_replace("run", "run_id=", "").alias("run"), "track_id", "sightings", "last_t")


@query("a13_point_labels", sql("SELECT run_id, frame_idx + 1 AS frame, (x1 + x2) / 2 AS x, y2 AS y FROM v_box"))
def a13(spark, sf):
    lines = boxes(spark, sf).select("run_id", F.concat_ws(",", (F.col("frame_idx") + 1).cast("string"), ((F.col("x1") + F.col("x2")) / 2).cast("string"), F.col("y2").cast("string")).alias("value"))
    return R.points(lines, ["run_id"])


FUNNEL = "fun AS (SELECT run_id, count(*) AS raw, count(*) FILTER (conf < 0.35) AS d1, count(*) FILTER (conf >= 0.35 AND y2 - y1 < 110) AS d2, count(*) FILTER (conf >= 0.35 AND y2 - y1 >= 110 AND x1 > 99999) AS d3 FROM v_box GROUP BY run_id), stage AS (SELECT run_id, v.i, v.stage, v.n, raw FROM fun, LATERAL (VALUES (1, 'confidence', d1), (2, 'height', d2), (3, 'extent', d3)) v(i, stage, n))"


def _stages(spark, sf):
    """run_id, raw and for each stage how many it dropped."""
    low, small = F.col("conf") < 0.35, F.col("y2") - F.col("y1") < 110
    far = F.col("x1") > 99999
    f = boxes(spark, sf).groupBy("run_id").agg(F.count("*").alias("raw"), F.count_if(low).alias("d1"), F.count_if(~low & small).alias("d2"), F.count_if(~low & ~small & far).alias("d3"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(c).alias("n")) for n, c in (("confidence", "d1"), ("height", "d2"), ("extent", "d3"))]))
    return f.select("run_id", "raw", each.alias("s")).select("run_id", "raw", "s.stage", "s.n")


@query("a16_funnel_in_logs", sql("SELECT run_id, stage, CAST(printf('%.1f', 100.0 * n / raw) AS DOUBLE) AS drop_pct FROM stage", FUNNEL))
def a16(spark, sf):
    """The share that each stage drops, printed as a table and read from the text."""
    share = S.printed(F.array(100.0 * F.col("n") / F.col("raw")), 1)[0]
    line = F.format_string("  %-12s dropped %6d  %5s%%", "stage", "n", "share")
    log = _stages(spark, sf).withColumn("share", share).groupBy("run_id").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("text"))
    return log.select("run_id", F.explode(R.funnel_in_text(F.col("text"))).alias("f")).select("run_id", "f.stage", "f.drop_pct")


@query("g50_funnel_findings", sql("SELECT run_id, stage, CASE WHEN n / raw >= 0.25 THEN 'WARN' ELSE 'INFO' END AS level FROM stage WHERE n / raw >= 0.25 OR n = 0 OR n / raw < 0.001", FUNNEL))
def g50(spark, sf):
    """Stages that drop a quarter or more, nothing, or next to nothing."""
    share = F.col("n") / F.col("raw")
    return _stages(spark, sf).where((share >= 0.25) | (F.col("n") == 0) | (share < 0.001)).select("run_id", "stage", F.when(share >= 0.25, "WARN").otherwise("INFO").alias("level"))


@query("p54_counts_from_logs", sql("SELECT run_id, line, sum(CASE WHEN direction = 'in' THEN 1 ELSE 0 END)::BIGINT AS n_in, sum(CASE WHEN direction = 'out' THEN 1 ELSE 0 END)::BIGINT AS n_out FROM v_crossing GROUP BY ALL"))
def p54(spark, sf):
    """The last counter that a growing log prints for each line is its total."""
    w = Window.partitionBy("run_id", "line").orderBy("t", "track_id", "direction").rowsBetween(Window.unboundedPreceding, 0)
    n = lambda d: F.count_if(F.col("direction") == d).over(w)
    c = crossings(spark, sf).withColumn("i", n("in")).withColumn("o", n("out"))
    log = c.groupBy("run_id", "line").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col("i") + F.col("o"), F.format_string("t LINE IN %d | OUT %d", "i", "o").alias("s")))), lambda r: r["s"]), "\n").alias("text"))
    last = F.element_at(R.counts_in_text(F.col("text")), -1)
    return log.select("run_id", "line", last["n_in"].cast("long").alias("n_in"), last["n_out"].cast("long").alias("n_out"))


@query("p55_plane_from_logs", "SELECT s_suppkey AS camera, CASE WHEN s_suppkey % 5 > 0 THEN CAST(printf('%.2f', 2.0 + s_suppkey % 40 / 10.0) AS DOUBLE) END AS height_m, CASE WHEN s_suppkey % 5 > 0 THEN CAST(s_suppkey % 300 - 150 AS DOUBLE) END AS horizon FROM supplier")
def p55(spark, sf):
    s = F.col("s_suppkey")
    text = F.when(s % 5 > 0, F.format_string("plane: camera height %.2f m, horizon row %d px", 2.0 + s % 40 / 10.0, s % 300 - 150)).otherwise(F.lit("plane: none"))
    number = lambda p: F.regexp_extract(text, p, 1).try_cast("double")
    return table(spark, sf, "supplier").select(s.alias("camera"), number(r"camera height (-?[0-9.]+) m").alias("height_m"), number(r"horizon row (-?[0-9.]+)").alias("horizon"))


@query("b2_track_export", sql("SELECT run_id, frame_idx + 1 AS frame, CAST(regexp_replace(track_id, 'm', '') AS INT) AS id, count(*) AS boxes, min(x1) AS x FROM v_box GROUP BY 1, 2, 3"))
def b2(spark, sf):
    """Boxes under canonical ids as lines of a file, written and read again."""
    from atrium.operators.identity import remap

    b = boxes(spark, sf)
    mapping = b.where("track_id like 'm%'").select("run_id", "track_id").distinct().withColumn("canon", F.expr("substr(track_id, 2)"))
    b = remap(b, mapping)
    line = S.mot_line(F.col("frame_idx") + 1, F.col("track_id").cast("int"), F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    path = _folder(spark)
    b.select("run_id", line.alias("value")).write.partitionBy("run_id").text(path)
    good = R.mot(spark.read.text(path), extra=["run_id"])[0]
    return good.groupBy("run_id", "frame", "id").agg(F.count("*").alias("boxes"), F.min("x").alias("x"))


@query("b6_replaced_runs", sql("SELECT run_id, zone, count(*) AS n FROM v_sighting WHERE run_id % 2 = 0 OR zone = 'bar' GROUP BY ALL"))
def b6(spark, sf):
    """Odd runs are written once more with fewer rows: none of the former ones may stay, and other runs are untouched."""
    n = sightings(spark, sf).groupBy("run_id", "zone").agg(F.count("*").alias("n"))
    path = _folder(spark)
    S.replace_runs(n, path)
    S.replace_runs(n.where("run_id % 2 = 1 and zone = 'bar'"), path)
    return spark.read.parquet(path).select(F.col("run_id").cast("int"), "zone", "n")


@query("b11_embedding_rows", "SELECT 'r' || (vec_id // 100) AS run_id, CAST(vec_id AS VARCHAR) AS raw_track_id, 'e' || vec_id AS emb_id, len(embedding) AS dims, round(CAST(embedding[1] AS DOUBLE), 6) AS first, CASE WHEN vec_id % 3 > 0 THEN round(vec_id % 17 / 10.0, 2) END AS blur_score FROM embeddings")
def b11(spark, sf):
    v = F.col("vec_id")
    blur = F.when(v % 3 > 0, F.round(v % 17 / 10.0, 2))
    return table(spark, sf, "embeddings").select(F.concat(F.lit("r"), F.expr("cast(vec_id div 100 as string)")).alias("run_id"), v.cast("string").alias("raw_track_id"), F.concat(F.lit("e"), v.cast("string")).alias("emb_id"), F.size("embedding").cast("long").alias("dims"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), blur.alias("blur_score"))


@query("p52_point_boxes", sql(f"SELECT run_id, frame_idx + 1 AS frame, {ID} AS id, CAST(printf('%.2f', x1) AS DOUBLE) AS x1, round(CAST(printf('%.2f', x1) AS DOUBLE) + CAST(printf('%.2f', x2 - x1) AS DOUBLE), 4) AS x2 FROM v_box"))
def p52(spark, sf):
    """Lines of x, y, w, h as corners."""
    b = boxes(spark, sf)
    track = F.regexp_replace("track_id", "m", "9").cast("int")
    lines = b.select("run_id", S.mot_line(F.col("frame_idx") + 1, track, F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("value"))
    return R.mot(lines, extra=["run_id"])[0].select("run_id", "frame", "id", F.col("x").alias("x1"), F.round(F.col("x") + F.col("w"), 4).alias("x2"))


@query("p53_truth_rows", sql(f"SELECT run_id, count(*) AS good, 2 * count(DISTINCT frame_idx) AS bad FROM v_box WHERE {ID} % 2 = 0 GROUP BY run_id"))
def p53(spark, sf):
    """Good rows and bad lines of each run: a box without extent and an unreadable line stand in every frame."""
    b = boxes(spark, sf).where("cast(regexp_replace(track_id, 'm', '9') as int) % 2 = 0")
    track = F.regexp_replace("track_id", "m", "9").cast("int")
    lines = b.select("run_id", S.mot_line(F.col("frame_idx") + 1, track, F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("value"))
    broken = b.select("run_id", "frame_idx").distinct()
    broken = broken.select("run_id", F.explode(F.array(F.format_string("%d,1,2,3,0,5,1", "frame_idx"), F.format_string("%d,one,2,3,4,5", "frame_idx"))).alias("value"))
    good, bad = R.mot(lines.unionByName(broken), extra=["run_id"])
    return good.groupBy("run_id").agg(F.count("*").alias("good")).join(bad.groupBy("run_id").agg(F.count("*").alias("bad")), "run_id")


# Frames: exposure, quality, gates.

EXPOSURE = "ex AS (SELECT event_id, run_id, i, value * 2.5 AS mean, event_id % 50 / 100.0 AS low, event_id % 37 / 100.0 AS high, CASE WHEN value * 2.5 < 60 OR event_id % 50 / 100.0 > 0.2 THEN 'dark' WHEN value * 2.5 > 195 OR event_id % 37 / 100.0 > 0.2 THEN 'bright' ELSE 'ok' END AS verdict FROM v_event)"


def _exposed(spark, sf):
    e = _events(spark, sf).select("event_id", "run_id", "i", (F.col("value") * 2.5).alias("mean"), (F.col("event_id") % 50 / 100.0).alias("low"), (F.col("event_id") % 37 / 100.0).alias("high"))
    return e.withColumn("verdict", D.exposure(F.col("mean"), F.col("low"), F.col("high")))


@query("c26_exposure_verdicts", sql("SELECT event_id, verdict FROM ex", EXPOSURE))
def c26(spark, sf):
    return _exposed(spark, sf).select("event_id", "verdict")


@query("c27_clip_limits", sql("SELECT event_id, round(2.0 + 2.0 * CASE verdict WHEN 'ok' THEN 0.0 WHEN 'dark' THEN least(1.0, greatest(0.0, (60.0 - mean) / 60.0)) ELSE least(1.0, greatest(0.0, (mean - 195.0) / 60.0)) END, 6) AS clip FROM ex", EXPOSURE))
def c27(spark, sf):
    return _exposed(spark, sf).select("event_id", F.round(D.clip_limit(F.col("mean"), F.col("verdict")), 6).alias("clip"))


@query("c30_batch_confidence_floor", sql("SELECT run_id, CAST(i // 16 AS BIGINT) AS batch, CASE WHEN bool_or(value < 3.0) THEN least(0.35, 0.22) ELSE 0.35 END AS floor FROM v_event GROUP BY ALL"))
def c30(spark, sf):
    """One infrared frame lowers the floor of its whole batch."""
    e = _events(spark, sf).groupBy("run_id", F.expr("i div 16").alias("batch"))
    return e.agg(F.when(F.bool_or(F.col("value") < 3.0), 0.22).otherwise(0.35).alias("floor"))


@query("p60_image_quality", sql("SELECT event_id, concat_ws(',', CASE WHEN value * 9 < 40 THEN 'focus' END, CASE WHEN event_id % 256 > 242 THEN 'bright' WHEN event_id % 256 < 12 THEN 'dark' END, CASE WHEN user_id % 100 / 1000.0 < 0.004 THEN 'blocked' END, CASE WHEN i > 0 AND i % 90 / 10.0 < 0.2 THEN 'frozen' END) AS problems FROM v_event"))
def p60(spark, sf):
    """Sharpness, brightness, density of edges and change of each frame, held against their bars; a first frame cannot be frozen."""
    q = D.image_problems(F.col("value") * 9, (F.col("event_id") % 256).cast("double"), F.col("user_id") % 100 / 1000.0, F.when(F.col("i") > 0, F.col("i") % 90 / 10.0))
    return _events(spark, sf).select("event_id", F.array_join(q, ",").alias("problems"))


@query("c29_motion_gate", sql(
    "SELECT run_id, i, skip FROM fold",
    "g AS (SELECT run_id, i, CAST(i * 0.25 AS DOUBLE) AS t, value / 100.0 < 0.04 AS still, event_type = 'purchase' AS det, row_number() OVER (PARTITION BY run_id ORDER BY i) AS rn FROM v_event)",
    "fold AS (WITH RECURSIVE r AS (SELECT run_id, i, rn, false AS skip, CASE WHEN det THEN t ELSE t END AS last FROM g WHERE rn = 1 UNION ALL SELECT g.run_id, g.i, g.rn, g.still AND g.t - r.last > 10.0, CASE WHEN g.det AND NOT (g.still AND g.t - r.last > 10.0) THEN g.t ELSE r.last END FROM r JOIN g ON g.run_id = r.run_id AND g.rn = r.rn + 1) SELECT * FROM r)"))
def c29(spark, sf):
    """A still frame is skipped if nothing was detected for ten seconds in the frames that were looked at."""
    e = _events(spark, sf).select("run_id", "i", (F.col("i") * 0.25).alias("t"), (F.col("value") / 100.0 < 0.04).alias("still"), (F.col("event_type") == "purchase").alias("detected"))
    return D.motion_gate(e).select("run_id", "i", "skip")


@query("p68_dataset_frames", sql(
    "SELECT run_id, frame_idx FROM fold WHERE keep",
    "g AS (SELECT run_id, frame_idx, frame_idx * 0.125::DOUBLE AS t, count(*) AS n, row_number() OVER (PARTITION BY run_id ORDER BY frame_idx) AS rn FROM v_box GROUP BY run_id, frame_idx)",
    "fold AS (WITH RECURSIVE r AS (SELECT run_id, frame_idx, rn, n >= 2 AS keep, CASE WHEN n >= 2 THEN t ELSE -1e9 END AS last FROM g WHERE rn = 1 UNION ALL SELECT g.run_id, g.frame_idx, g.rn, g.n >= 2 AND g.t - r.last >= 5.0, CASE WHEN g.n >= 2 AND g.t - r.last >= 5.0 THEN g.t ELSE r.last END FROM r JOIN g ON g.run_id = r.run_id AND g.rn = r.rn + 1) SELECT * FROM r)"))
def p68(spark, sf):
    """Frames with enough boxes, five seconds or more after the one taken before."""
    f = boxes(spark, sf).groupBy("run_id", "frame_idx", "t").agg(F.count("*").alias("n")).where("n >= 2")
    return D.spaced(f.select("run_id", "frame_idx", "t"), ["run_id"], "t", 5.0).select("run_id", "frame_idx")


# Validity.

VERDICT = "va AS (SELECT run_id, i, CAST(i * 0.25 AS DOUBLE) AS t, CASE WHEN value < 0.5 THEN 'BAD_FRAME' WHEN value < 1.2 THEN 'BLIND_CAMERA' WHEN user_id % 97 = 5 THEN 'TIME_WENT_BACKWARDS' WHEN value < 3 THEN 'SKIPPED_IDLE' ELSE 'OK' END AS verdict FROM v_event), st AS (SELECT run_id, list_sort(list(g))[count(*) // 2 + 1] AS step FROM (SELECT run_id, t - lag(t) OVER (PARTITION BY run_id ORDER BY t) AS g FROM va) WHERE g > 0 GROUP BY run_id)"
UNSEEN = "('BLIND_CAMERA', 'BAD_FRAME', 'GEOMETRY_CHANGED', 'TIME_WENT_BACKWARDS')"


def _verdicts(spark, sf):
    v = F.when(F.col("value") < 0.5, "BAD_FRAME").when(F.col("value") < 1.2, "BLIND_CAMERA").when(F.col("user_id") % 97 == 5, "TIME_WENT_BACKWARDS").when(F.col("value") < 3, "SKIPPED_IDLE").otherwise("OK")
    return _events(spark, sf).select("run_id", "i", (F.col("i") * 0.25).alias("t"), v.alias("verdict"))


def _step(v):
    g = v.withColumn("g", F.col("t") - F.lag("t").over(Window.partitionBy("run_id").orderBy("t"))).where("g > 0")
    return g.groupBy("run_id").agg(upper_median("g").alias("step"))


@query("p15_observed_seconds", sql(f"SELECT run_id, count(*) FILTER (verdict NOT IN {UNSEEN}) * any_value(step) AS observed_s FROM va JOIN st USING (run_id) GROUP BY run_id", VERDICT))
def p15(spark, sf):
    """Idle frames that were skipped have been looked at; blind and broken ones not."""
    v = _verdicts(spark, sf)
    seen = F.count_if(~F.expr(f"verdict in {UNSEEN}"))
    return v.groupBy("run_id").agg(seen.alias("n")).join(_step(v), "run_id").select("run_id", (F.col("n") * F.col("step")).alias("observed_s"))


@query("p16_elapsed_seconds", sql("SELECT run_id, max(t) - min(t) AS elapsed_s FROM va GROUP BY run_id", VERDICT))
def p16(spark, sf):
    return _verdicts(spark, sf).groupBy("run_id").agg((F.max("t") - F.min("t")).alias("elapsed_s"))


@query("p18_validity_findings", sql(
    "SELECT run_id, verdict AS kind, CASE verdict WHEN 'BLIND_CAMERA' THEN CASE WHEN n / total >= 0.02 THEN 'ERROR' ELSE 'WARN' END WHEN 'BAD_FRAME' THEN 'WARN' ELSE 'ERROR' END AS level, n FROM (SELECT run_id, verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY run_id) AS total FROM va GROUP BY run_id, verdict) WHERE verdict IN ('BLIND_CAMERA', 'TIME_WENT_BACKWARDS', 'GEOMETRY_CHANGED', 'BAD_FRAME', 'DETECTOR_BLIND')", VERDICT))
def p18(spark, sf):
    n = _verdicts(spark, sf).groupBy("run_id", "verdict").agg(F.count("*").alias("n"))
    n = n.withColumn("total", F.sum("n").over(Window.partitionBy("run_id")))
    kind = F.col("verdict")
    level = F.when(kind == "BLIND_CAMERA", F.when(F.col("n") / F.col("total") >= 0.02, "ERROR").otherwise("WARN")).when(kind == "BAD_FRAME", "WARN").otherwise("ERROR")
    return n.where(kind.isin("BLIND_CAMERA", "TIME_WENT_BACKWARDS", "GEOMETRY_CHANGED", "BAD_FRAME", "DETECTOR_BLIND")).select("run_id", kind.alias("kind"), level.alias("level"), "n")


SILENT = "si AS (SELECT run_id, min(t) AS t0, max(t) AS t1, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY t) - row_number() OVER (PARTITION BY run_id, quiet ORDER BY t) AS g FROM (SELECT run_id, t, zone NOT IN ('reception', 'bar') AS quiet FROM v_sighting)) WHERE quiet GROUP BY run_id, g HAVING count(*) >= 8)"


def _silences(spark, sf):
    from atrium.plans.events import f15

    return f15(spark, sf)


@query("p19_canary_findings", sql("SELECT run_id, 'ERROR' AS level, count(*) AS episodes, max(n) AS longest FROM si GROUP BY run_id", SILENT))
def p19(spark, sf):
    return _silences(spark, sf).groupBy("run_id").agg(F.lit("ERROR").alias("level"), F.count("*").alias("episodes"), F.max("n").alias("longest"))


@query("p20_open_canaries", sql("SELECT run_id, t0, n FROM si JOIN (SELECT run_id, max(t) AS e FROM v_sighting GROUP BY run_id) USING (run_id) WHERE t1 = e", SILENT))
def p20(spark, sf):
    """Silences that last to the end of their run count as well."""
    ends = sightings(spark, sf).groupBy("run_id").agg(F.max("t").alias("e"))
    return _silences(spark, sf).join(ends, "run_id").where("t1 = e").select("run_id", "t0", "n")


# Windows and intervals.


@query("e4_clipped_intervals", sql("SELECT run_id, zone, greatest(t_in, w0) AS t_in, least(t_out, w1) AS t_out, track_id FROM zone_event JOIN w USING (run_id) WHERE t_in < w1 AND w0 < t_out", Z0, W))
def e4(spark, sf):
    return clip(_z(spark, sf).select("run_id", "zone", "track_id", "t_in", "t_out"), windows(spark, sf), ["run_id"])


LIVES = "lv AS (SELECT run_id, track_id, list({'a': t_in, 'b': t_out}) AS w FROM zone_event GROUP BY ALL)"


def _lives(spark, sf):
    return _z(spark, sf).groupBy("run_id", "track_id").agg(F.collect_list(F.struct(F.col("t_in").alias("a"), F.col("t_out").alias("b"))).alias("w"))


def _overlap(p, q, tolerance):
    """Whether any two windows of the lists overlap by more than the tolerance."""
    return F.exists(p, lambda x: F.exists(q, lambda y: (x["a"] < y["b"] - tolerance) & (y["a"] < x["b"] - tolerance)))


@query("e8_window_overlaps", sql("SELECT x.run_id, x.track_id AS a, y.track_id AS b, len(list_filter(x.w, lambda p: len(list_filter(y.w, lambda q: p.a < q.b - 2.0 AND q.a < p.b - 2.0)) > 0)) > 0 AS together FROM lv x JOIN lv y ON x.run_id = y.run_id AND CAST(y.track_id AS INT) = CAST(x.track_id AS INT) + 1", Z0, LIVES))
def e8(spark, sf):
    """Tracks and the ones numbered next: seen together for more than two seconds?"""
    v = _lives(spark, sf)
    o = v.select("run_id", F.col("track_id").alias("b"), (F.col("track_id").cast("int") - 1).cast("string").alias("track_id"), F.col("w").alias("q"))
    return v.join(o, ["run_id", "track_id"]).select("run_id", F.col("track_id").alias("a"), "b", _overlap(F.col("w"), F.col("q"), 2.0).alias("together"))


@query("e9_replayed_overlaps", sql("SELECT run_id, count(*) AS pairs, count(*) FILTER (a.t0 < b.t1 - 2.0 AND b.t0 < a.t1 - 2.0) AS blocked FROM (SELECT run_id, track_id, min(t) AS t0, max(t) AS t1 FROM v_sighting GROUP BY ALL) a JOIN (SELECT run_id, track_id, min(t) AS t0, max(t) AS t1 FROM v_sighting GROUP BY ALL) b USING (run_id) WHERE CAST(b.track_id AS INT) BETWEEN CAST(a.track_id AS INT) + 1 AND CAST(a.track_id AS INT) + 3 GROUP BY run_id"))
def e9(spark, sf):
    """The same rule on single windows, as the replay of merges uses it."""
    s = sightings(spark, sf).groupBy("run_id", F.col("track_id").cast("int").alias("n")).agg(F.array(F.struct(F.min("t").alias("a"), F.max("t").alias("b"))).alias("w"))
    o = s.select("run_id", F.explode(F.array(*[F.col("n") - i for i in (1, 2, 3)])).alias("n"), F.col("w").alias("q"))
    return s.join(o, ["run_id", "n"]).groupBy("run_id").agg(F.count("*").alias("pairs"), F.count_if(_overlap(F.col("w"), F.col("q"), 2.0)).alias("blocked"))


CHUNKS = "ch AS (SELECT run_id, CAST(i // 1200 * 300 AS DOUBLE) AS t_in, max(CAST(i * 0.25 AS DOUBLE)) + 0.25 AS t_out FROM v_event WHERE run_id % 3 <> 1 AND i // 1200 <> 2 GROUP BY run_id, i // 1200)"


@query("f5_covered_windows", sql("SELECT * FROM m UNION ALL SELECT run_id, 0.0, max(CAST(i * 0.25 AS DOUBLE)) + 0.25 FROM v_event WHERE run_id % 3 = 1 GROUP BY run_id", CHUNKS, islands("m", "ch", "run_id")))
def f5(spark, sf):
    """The merged chunks of a run; a run without chunks is covered from start to end."""
    e = _events(spark, sf).withColumn("t", F.col("i") * 0.25)
    chunks = e.where("run_id % 3 <> 1 and i div 1200 <> 2").groupBy("run_id", F.expr("i div 1200").alias("c")).agg((F.max("t") + 0.25).alias("t_out"))
    merged = merge(chunks.select("run_id", (F.col("c") * 300.0).alias("t_in"), "t_out"), ["run_id"])
    whole = e.groupBy("run_id").agg(F.lit(0.0).alias("t_in"), (F.max("t") + 0.25).alias("t_out"))
    return merged.unionByName(whole.join(merged.select("run_id").distinct(), "run_id", "left_anti").select("run_id", "t_in", "t_out"))


@query("f8_sightings_added", sql("SELECT run_id, zone, track_id, count(*) AS sightings, count(*) * 0.25 AS seconds FROM v_sighting GROUP BY ALL"))
def f8(spark, sf):
    return sightings(spark, sf).groupBy("run_id", "zone", "track_id").agg(F.count("*").alias("sightings"), (F.count("*") * 0.25).alias("seconds"))


@query("f9_observed_spans", sql("SELECT run_id, CASE WHEN run_id % 4 = 1 THEN 100.0 ELSE t0 END AS w0, CASE WHEN run_id % 4 = 1 THEN 300.0 ELSE t1 END AS w1 FROM (SELECT run_id, CASE WHEN run_id % 4 = 2 THEN 5000.0 ELSE 0.0 END AS t0, max(CAST(i * 0.25 AS DOUBLE)) AS t1 FROM v_event GROUP BY run_id) WHERE run_id % 4 = 1 OR t1 > t0"))
def f9(spark, sf):
    """Stated windows win; else the span of the run, or nothing if that is empty."""
    runs = _events(spark, sf).groupBy("run_id").agg((F.max("i") * 0.25).alias("end"))
    stated = F.when(F.col("run_id") % 4 == 1, F.array(F.struct(F.lit(100.0).alias("w0"), F.lit(300.0).alias("w1"))))
    start = F.when(F.col("run_id") % 4 == 2, 5000.0).otherwise(0.0)
    derived = F.when(F.col("end") > start, F.array(F.struct(start.alias("w0"), F.col("end").alias("w1"))))
    return runs.select("run_id", F.explode(F.coalesce(stated, derived)).alias("w")).select("run_id", "w.w0", "w.w1")


@query("f13_regimes", sql(
    "SELECT run_id, min(i) AS lo, max(i) + 1 AS hi FROM (SELECT f.run_id, f.seg, f.i, last_value(CASE WHEN f.n >= 8 OR f.seg = 0 THEN f.seg END IGNORE NULLS) OVER (PARTITION BY f.run_id ORDER BY f.i) AS own FROM (SELECT *, count(*) OVER (PARTITION BY run_id, seg) AS n FROM seg) f) GROUP BY run_id, own",
    "jump AS (SELECT run_id, i, CASE WHEN abs(value - lag(value) OVER (PARTITION BY run_id ORDER BY i)) > 38.0 THEN 1 ELSE 0 END AS cut FROM v_event)",
    "seg AS (SELECT run_id, i, sum(cut) OVER (PARTITION BY run_id ORDER BY i) AS seg FROM jump)"))
def f13(spark, sf):
    """Rows between jumps of a value; a stretch of fewer than eight rows joins the one before it."""
    w = Window.partitionBy("run_id").orderBy("i")
    e = _events(spark, sf).withColumn("cut", F.coalesce((F.abs(F.col("value") - F.lag("value").over(w)) > 38.0).cast("int"), F.lit(0)))
    e = e.withColumn("seg", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = e.groupBy("run_id", "seg").agg(F.min("i").alias("lo"), (F.max("i") + 1).alias("hi"), F.count("*").alias("n"))
    own = F.last(F.when((F.col("n") >= 8) | (F.col("seg") == 0), F.col("seg")), ignorenulls=True).over(Window.partitionBy("run_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("own", own).groupBy("run_id", "own").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("own")


# Reports.


@query("g34_anomaly_history", sql("SELECT run_id, zone, n, round(avg(n) OVER w, 6) AS mean, count(*) OVER w AS seen FROM (SELECT run_id, zone, count(*) AS n FROM v_sighting GROUP BY ALL) WINDOW w AS (PARTITION BY zone ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
def g34(spark, sf):
    """What a zone's earlier runs make one expect, without the run itself."""
    n = sightings(spark, sf).groupBy("run_id", "zone").agg(F.count("*").alias("n"))
    w = Window.partitionBy("zone").orderBy("run_id").rowsBetween(Window.unboundedPreceding, -1)
    return n.select("run_id", "zone", "n", F.round(F.avg("n").over(w), 6).alias("mean"), F.count("*").over(w).alias("seen"))


@query("g40_track_lifecycle", sql(
    "SELECT run_id, track_id, born, died, CASE WHEN born THEN 0 ELSE 1 END + CASE WHEN died THEN 0 ELSE 1 END AS mid_scene, gaps FROM (SELECT run_id, track_id, arg_min(least(x1, y1, 1920 - x2, 1080 - y2) <= 0.06 * 1920, t) AS born, arg_max(least(x1, y1, 1920 - x2, 1080 - y2) <= 0.06 * 1920, t) AS died, count(*) FILTER (g > 20.0) AS gaps FROM (SELECT *, t - lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS g FROM v_box) GROUP BY run_id, track_id)"))
def g40(spark, sf):
    """Whether tracks begin and end at the frame's edge, and how often they pause."""
    edge = F.least(F.col("x1"), F.col("y1"), 1920 - F.col("x2"), 1080 - F.col("y2")) <= 0.06 * 1920
    g = F.col("t") - F.lag("t").over(Window.partitionBy("run_id", "track_id").orderBy("t"))
    b = boxes(spark, sf).withColumn("g", g).withColumn("edge", edge)
    s = b.groupBy("run_id", "track_id").agg(F.min_by("edge", "t").alias("born"), F.max_by("edge", "t").alias("died"), F.count_if(F.col("g") > 20.0).alias("gaps"))
    return s.select("run_id", "track_id", "born", "died", ((~F.col("born")).cast("int") + (~F.col("died")).cast("int")).alias("mid_scene"), "gaps")


@query("l16_floor_quantiles", sql("SELECT run_id, zone, list_sort(list(t))[CAST(floor(0.1 * (count(*) - 1)) AS INT) + 1] AS p10, list_sort(list(t))[CAST(floor(0.9 * (count(*) - 1)) AS INT) + 1] AS p90 FROM v_sighting GROUP BY ALL"))
def l16(spark, sf):
    return sightings(spark, sf).groupBy("run_id", "zone").agg(floor_quantile("t", 0.1).alias("p10"), floor_quantile("t", 0.9).alias("p90"))


@query("l3_safe_ids", sql("SELECT run_id, track_id, TRY_CAST(track_id AS BIGINT) AS number, CASE WHEN TRY_CAST(track_id AS BIGINT) IS NULL THEN track_id END AS name FROM (SELECT DISTINCT run_id, track_id FROM v_box)"))
def l3(spark, sf):
    """Ids of digits only are numbers, others stay text."""
    t = boxes(spark, sf).select("run_id", "track_id").distinct()
    digits = F.col("track_id").rlike("^[0-9]+$")
    return t.select("run_id", "track_id", F.when(digits, F.col("track_id").cast("long")).alias("number"), F.when(~digits, F.col("track_id")).alias("name"))


@query("l5_wall_clock", sql("SELECT run_id, track_id, t, strftime(TIMESTAMP '2024-03-05 21:30:00' + to_microseconds(CAST(round(t * 1000000) AS BIGINT)), '%H:%M:%S') AS wall FROM v_crossing"))
def l5(spark, sf):
    start = F.lit("2024-03-05 21:30:00").cast("timestamp_ntz")
    at = F.timestamp_add("SECOND", F.floor("t").cast("int"), start)
    return crossings(spark, sf).select("run_id", "track_id", "t", F.date_format(at, "HH:mm:ss").alias("wall"))


@query("l9_clock_provenance", "SELECT event_id, CASE WHEN event_id % 5 = 1 THEN 'ERROR' WHEN event_id % 5 = 2 THEN 'WARN' ELSE 'OK' END AS finding FROM events")
def l9(spark, sf):
    """Names of the chosen, the decoded and the clock's file: different starts are an error, different names a warning."""
    e, n = table(spark, sf, "events"), F.col("event_id")
    name = lambda cam, hour: F.concat(F.lit(cam), F.lit(" 3-5-2024, "), hour.cast("string"), F.lit(".30.00pm.mp4"))
    seven = F.lit(7)
    chosen, decoded = name("a", seven), name("a", F.when(n % 5 == 1, 4).otherwise(7))
    clock = F.when(n % 5 == 2, name("b", seven)).when(n % 5 == 3, F.lit(None).cast("string")).otherwise(name("a", seven))
    stamps = F.array_distinct(F.filter(F.array(*[R.start_in_name(c) for c in (chosen, decoded, clock)]), lambda x: x.isNotNull()))
    names = F.array_distinct(F.filter(F.array(chosen, decoded, clock), lambda x: x.isNotNull()))
    return e.select("event_id", F.when(F.size(stamps) > 1, "ERROR").when(F.size(names) > 1, "WARN").otherwise("OK").alias("finding"))


@query("l10_local_clock", sql("SELECT run_id, track_id, t, strftime(timezone('America/New_York', timezone('UTC', TIMESTAMP '2024-03-10 06:50:00' + to_microseconds(CAST(round(t * 1000000) AS BIGINT)))), '%Y-%m-%d %H:%M:%S') AS local FROM v_crossing"))
def l10(spark, sf):
    """Seconds are added in UTC and only then shown locally, so an hour that is left out in spring never shows."""
    at = F.timestamp_add("SECOND", F.floor("t").cast("int"), F.lit("2024-03-10 06:50:00").cast("timestamp"))
    return crossings(spark, sf).select("run_id", "track_id", "t", F.date_format(F.from_utc_timestamp(at, "America/New_York"), "yyyy-MM-dd HH:mm:ss").alias("local"))


@query("l17_numbers_in_json", "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS missing FROM events")
def l17(spark, sf):
    number = lambda path: F.get_json_object("props", path).try_cast("double")
    return table(spark, sf, "events").select("event_id", number("$.k").alias("k"), number("$.absent").alias("missing"))


@query("p39_truth_times", sql("SELECT run_id, frame_idx, 2.5 + (12 + frame_idx) / 8.0 AS t FROM (SELECT DISTINCT run_id, frame_idx FROM v_box)"))
def p39(spark, sf):
    """Time of a label's frame, counted from 0 behind an offset."""
    return boxes(spark, sf).select("run_id", "frame_idx").distinct().select("run_id", "frame_idx", (2.5 + (12 + F.col("frame_idx")) / 8.0).alias("t"))


@query("p40_predicted_times", sql("SELECT run_id, frame_idx + 1 AS frame, 2.5 + frame_idx / 8.0 AS t FROM (SELECT DISTINCT run_id, frame_idx FROM v_box)"))
def p40(spark, sf):
    """Time of a predicted frame, counted from 1."""
    f = boxes(spark, sf).select("run_id", (F.col("frame_idx") + 1).alias("frame")).distinct()
    return f.select("run_id", "frame", (2.5 + (F.col("frame") - 1) / 8.0).alias("t"))


@query("p42_frame_shift", sql("SELECT run_id, CASE WHEN run_id % 2 = 1 THEN 1 ELSE 0 END AS shift, CAST(n_gt AS BIGINT) AS truth, CAST(n_gt AS BIGINT) AS shared, false AS warn FROM (SELECT run_id, count(DISTINCT frame_idx) AS n_gt FROM v_box GROUP BY run_id)"))
def p42(spark, sf):
    """Labels that start at frame 0 where predictions start at 1 are moved by one; little overlap is a warning."""
    f = boxes(spark, sf).select("run_id", "frame_idx").distinct()
    first = f.groupBy("run_id").agg(F.min("frame_idx").alias("base"))
    f = f.join(first, "run_id").withColumn("f", F.col("frame_idx") - F.col("base"))
    gt = f.select("run_id", (F.col("f") + F.when(F.col("run_id") % 2 == 1, 0).otherwise(1)).alias("f"))
    pr = f.select("run_id", (F.col("f") + 1).alias("f"), F.lit(1).alias("there"))
    least = gt.groupBy("run_id").agg(F.min("f").alias("g0")).join(pr.groupBy("run_id").agg(F.min("f").alias("p0")), "run_id")
    least = least.select("run_id", F.when((F.col("g0") == 0) & (F.col("p0") == 1), 1).otherwise(0).alias("shift"))
    moved = gt.join(least, "run_id").select("run_id", "shift", (F.col("f") + F.col("shift")).alias("f")).join(pr, ["run_id", "f"], "left")
    s = moved.groupBy("run_id", "shift").agg(F.count("*").alias("truth"), F.count("there").alias("shared"))
    return s.withColumn("warn", F.col("shared") < 0.5 * F.col("truth"))


@query("p50_network_scales", "SELECT s_suppkey AS camera, least(1.0, (960 + s_suppkey % 5 * 320) / 1920.0) * least(1.0, 1280.0 / (960 + s_suppkey % 5 * 320)) AS scale FROM supplier")
def p50(spark, sf):
    """How much smaller the network sees a person than the source shows them; nothing is ever enlarged."""
    wide = 960 + F.col("s_suppkey") % 5 * 320
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"), (F.least(F.lit(1.0), wide / 1920.0) * F.least(F.lit(1.0), 1280.0 / wide)).alias("scale"))


@query("p57_detector_cost", "SELECT s_suppkey AS camera, (1 + CAST(ceil((w - 640) / 512.0) AS BIGINT)) * (1 + CAST(ceil((h - 640) / 512.0) AS BIGINT)) + 1 AS calls FROM (SELECT s_suppkey, 1280 + s_suppkey % 9 * 160 AS w, 720 + s_suppkey % 7 * 120 AS h FROM supplier)")
def p57(spark, sf):
    """Overlapping tiles of 640 with a step of 512, and the whole frame once."""
    w, h = 1280 + F.col("s_suppkey") % 9 * 160, 720 + F.col("s_suppkey") % 7 * 120
    n = lambda size: 1 + F.ceil((size - 640) / 512.0)
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"), (n(w) * n(h) + 1).alias("calls"))


@query("p51_spans_of_ids", sql("SELECT run_id, track_id, min(t) AS t0, max(t) AS t1 FROM v_box GROUP BY ALL"))
def p51(spark, sf):
    return boxes(spark, sf).groupBy("run_id", "track_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))


@query("p66_review_clips", sql("SELECT run_id, track_id, t, greatest(0.0, t - 5.0) AS a, t + 5.0 AS b FROM v_crossing"))
def p66(spark, sf):
    return crossings(spark, sf).select("run_id", "track_id", "t", F.greatest(F.lit(0.0), F.col("t") - 5.0).alias("a"), (F.col("t") + 5.0).alias("b"))


@query("p69_canonical_spans", sql("SELECT run_id, CASE WHEN track_id LIKE 'm%' THEN substr(track_id, 2) ELSE track_id END AS canon, min(t) AS t0, max(t) AS t1, count(DISTINCT track_id) AS raw FROM v_box GROUP BY 1, 2"))
def p69(spark, sf):
    b = boxes(spark, sf).withColumn("canon", F.regexp_replace("track_id", "^m", ""))
    return b.groupBy("run_id", "canon").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.count_distinct("track_id").alias("raw"))


@query("p74_run_ids", sql("SELECT run_id, CASE WHEN run_id % 3 = 0 THEN 'cam' || (run_id % 4) || '_' || run_id ELSE 'cam' || (run_id % 4) || '_clip' || run_id || '_' || CAST(min(CAST(i * 0.25 AS DOUBLE)) AS BIGINT) END AS name FROM v_event GROUP BY run_id"))
def p74(spark, sf):
    """Camera and chunk, or without chunks camera, file and start."""
    r = _events(spark, sf).groupBy("run_id").agg((F.min("i") * 0.25).cast("long").alias("start"))
    run = F.col("run_id")
    cam = F.concat(F.lit("cam"), (run % 4).cast("string"))
    return r.select("run_id", F.when(run % 3 == 0, F.concat_ws("_", cam, run)).otherwise(F.concat_ws("_", cam, F.concat(F.lit("clip"), run.cast("string")), F.col("start"))).alias("name"))


@query("p5_arrival_agreement", sql("SELECT run_id, line, region, CASE WHEN line IS NULL AND region IS NULL THEN NULL WHEN line IS NULL OR region IS NULL THEN 'one' WHEN abs(line - region) <= 0.25 * greatest(line, region) THEN 'agree' ELSE 'differ' END AS agreement FROM (SELECT run_id, (SELECT nullif(count(*), 0) FROM v_crossing c WHERE c.run_id = r.run_id AND c.direction = 'in' AND c.line = 'entry line' AND c.run_id % 3 <> 1) AS line, (SELECT nullif(count(DISTINCT track_id), 0) FROM v_sighting s WHERE s.run_id = r.run_id AND s.zone = 'main_entrance' AND s.run_id % 2 = 0) AS region FROM (SELECT DISTINCT run_id FROM v_event) r)"))
def p5(spark, sf):
    """Arrivals by line and by region; null only if neither was measured."""
    runs = sightings(spark, sf).select("run_id").distinct()
    line = crossings(spark, sf).where("direction = 'in' and line = 'entry line' and run_id % 3 <> 1").groupBy("run_id").agg(F.count("*").alias("line"))
    region = sightings(spark, sf).where("zone = 'main_entrance' and run_id % 2 = 0").groupBy("run_id").agg(F.count_distinct("track_id").alias("region"))
    j = runs.join(line, "run_id", "left").join(region, "run_id", "left")
    a, b = F.col("line"), F.col("region")
    both = F.when(F.abs(a - b) <= 0.25 * F.greatest(a, b), "agree").otherwise("differ")
    return j.select("run_id", "line", "region", F.when(a.isNotNull() & b.isNotNull(), both).when(a.isNotNull() | b.isNotNull(), "one").alias("agreement"))


@query("o6_patience_at_places", sql("SELECT run_id, frame_idx, track_id, CASE WHEN x BETWEEN 100.0 AND 900.0 THEN 300.0 WHEN y BETWEEN 100.0 AND 500.0 THEN 180.0 ELSE 120.0 END AS least_life FROM (SELECT *, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y FROM v_box)"))
def o6(spark, sf):
    """How long something must stay put to be furniture depends on where it is."""
    x, y = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    return boxes(spark, sf).select(*KEY, F.when(x.between(100.0, 900.0), 300.0).when(y.between(100.0, 500.0), 180.0).otherwise(120.0).alias("least_life"))


@query("d29_activities", sql(
    """SELECT event_id, CASE WHEN NOT seen THEN 'unknown' WHEN knee AND sqrt(dx * dx + dy * dy) > 1e-6 AND thigh / sqrt(dx * dx + dy * dy) < 0.25 THEN 'sitting' WHEN degrees(atan2(abs(dx), abs(dy) + 1e-6)) >= 45.0 THEN 'bending' WHEN move >= 12.0 THEN 'walking' ELSE 'standing' END AS activity
FROM (SELECT event_id, event_id % 9 <> 4 AS seen, event_id % 4 <> 1 AS knee, CAST(event_id % 60 AS DOUBLE) AS dx, CAST(40 + event_id % 31 AS DOUBLE) AS dy, CAST(event_id % 47 AS DOUBLE) AS thigh, CAST(user_id % 25 AS DOUBLE) AS move FROM v_event)"""))
def d29(spark, sf):
    """Joints to an activity; the order of the rules matters."""
    n = F.col("event_id")
    at = lambda ok, x, y: F.when(ok, F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    always = F.lit(True)
    shoulders, hips = at(always, F.lit(100), F.lit(100)), at(n % 9 != 4, 100 + n % 60, 140 + n % 31)
    knees = at(n % 4 != 1, F.lit(100), 140 + n % 31 + n % 47)
    return table(spark, sf, "events").select("event_id", D.activity(shoulders, hips, knees, (F.col("user_id") % 25).cast("double")).alias("activity"))
