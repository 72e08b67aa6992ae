"""Queries on sources, sinks, strings, set operations and the generic tables (tables A, B, I, J, L of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.plans.registry import query
from atrium.sources import readers as R
from atrium.sources import sinks as S
from atrium.sources.adapters import boxes, crossings, sql, table

ID = "CAST(regexp_replace(track_id, 'm', '9') AS INT)"


def _mot(spark, sf):
    b = boxes(spark, sf)
    track = F.regexp_replace("track_id", "m", "9").cast("int")
    line = S.mot_line(F.col("frame_idx") + 1, track, F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return b.select("run_id", line.alias("value"))


@query("b1_mot_lines", sql(f"SELECT run_id, printf('%d,%d,%.2f,%.2f,%.2f,%.2f,1,-1,-1,-1', frame_idx + 1, {ID}, x1, y1, x2 - x1, y2 - y1) AS value FROM v_box"))
def b1(spark, sf):
    return _mot(spark, sf)


@query("a2_mot_scan", sql(f"SELECT frame_idx + 1 AS frame, {ID} AS id, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h, 1.0::DOUBLE AS conf FROM v_box"))
def a2(spark, sf):
    return R.mot(_mot(spark, sf))[0]


@query("a3_frame_log_scan", sql("SELECT frame_idx, t, CAST(CAST(regexp_replace(track_id, 'm', '9') AS INT) AS VARCHAR) AS track_id, x1, y1, x2, y2 FROM v_box"))
def a3(spark, sf):
    """Frames are written as nested JSON arrays, hundred frames to a document, and read again."""
    b = boxes(spark, sf).withColumn("id", F.regexp_replace("track_id", "m", "9").cast("double"))
    f = b.groupBy("run_id", "frame_idx", "t").agg(F.collect_list(F.array("id", "x1", "y1", "x2", "y2")).alias("boxes"))
    one = F.concat(F.lit("["), F.concat_ws(",", F.col("frame_idx").cast("string"), F.col("t").cast("string"), F.to_json("boxes")), F.lit("]"))
    docs = f.select("run_id", F.floor(F.col("frame_idx") / 100).alias("part"), one.alias("one")).groupBy("run_id", "part").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("one")), F.lit("]")).alias("value"))
    return R.frame_log(docs)


@query("a5_counts_in_logs", sql("SELECT run_id, line, CAST(count(*) FILTER (direction = 'in') AS INT) AS n_in, CAST(count(*) FILTER (direction = 'out') AS INT) AS n_out FROM v_crossing GROUP BY run_id, line"))
def a5(spark, sf):
    c = crossings(spark, sf).groupBy("run_id", "line").agg(F.count_if(F.col("direction") == "in").alias("i"), F.count_if(F.col("direction") == "out").alias("o"))
    log = c.select("run_id", "line", F.format_string("run %d at %s: LINE IN %d | OUT %d\n", "run_id", "line", "i", "o").alias("text"))
    return log.select("run_id", "line", F.explode(R.counts_in_text(F.col("text"))).alias("n")).select("run_id", "line", "n.n_in", "n.n_out")


@query("a6_observation_lines", sql("SELECT 'r' || run_id AS run_id, frame_idx, track_id AS raw_track_id, role AS zone, round(conf, 4) AS det_conf FROM v_box"))
def a6(spark, sf):
    b = boxes(spark, sf).select(F.to_json(F.struct(F.lit("obs").alias("kind"), F.concat(F.lit("r"), "run_id").alias("run_id"), "frame_idx", F.col("track_id").alias("raw_track_id"), F.col("role").alias("zone"), F.round("conf", 4).alias("det_conf"))).alias("value"))
    runs = boxes(spark, sf).select("run_id").distinct().select(F.to_json(F.struct(F.lit("run").alias("kind"), F.col("run_id").cast("string").alias("run_id"))).alias("value"))
    return R.observations(b.unionByName(runs))[0]


@query("a12_start_in_name", "SELECT event_id, date_trunc('second', ts) AS started FROM events")
def a12(spark, sf):
    e = table(spark, sf, "events")
    name = F.concat(F.lit("CAM_"), F.date_format("ts", "M-d-yyyy, h.mm.ssa"), F.lit("_end 1-1-1999, 1.00.00AM.mp4"))
    return e.select("event_id", R.start_in_name(name).alias("started"))


@query("b10_vector_text", "SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda v: printf('%.6f', CAST(v AS DOUBLE))), ',') || ']' AS text FROM embeddings WHERE vec_id >= 0")
def b10(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", S.vector_text(F.col("embedding")).alias("text"))


@query("b14_dataset_split", "SELECT page_id, (row_number() OVER (PARTITION BY page_id // 1000 ORDER BY url, page_id) - 1) % 5 = 0 AS val FROM pages")
def b14(spark, sf):
    """Every fifth by name is for validation, within parts of a thousand ids."""
    w = Window.partitionBy(F.expr("page_id div 1000")).orderBy("url", "page_id")
    return table(spark, sf, "pages").select("page_id", ((F.row_number().over(w) - 1) % 5 == 0).alias("val"))


def _labelled(spark, sf):
    b = boxes(spark, sf).select("run_id", "frame_idx", "x1", "y1", "x2", "y2")
    copies = b.where("frame_idx % 12 = 0").withColumn("frame_idx", 2 * F.col("frame_idx") + 1)
    return b.withColumn("frame_idx", 2 * F.col("frame_idx")).unionByName(copies)


@query("b16_carried_forward_frames", sql(
    "SELECT run_id, frame_idx FROM nums n WHERE boxes = before AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.run_id = n.run_id AND p.frame_idx = n.frame_idx AND p.moved)",
    "labelled AS (SELECT run_id, 2 * frame_idx AS frame_idx, x1, y1, x2, y2 FROM v_box UNION ALL SELECT run_id, 2 * frame_idx + 1, x1, y1, x2, y2 FROM v_box WHERE frame_idx % 12 = 0)",
    "ranked AS (SELECT run_id, frame_idx, x1, y1, x2, y2, row_number() OVER (PARTITION BY run_id, frame_idx ORDER BY x1, y1, x2, y2) AS k FROM labelled)",
    "frames AS (SELECT run_id, frame_idx, count(*) AS boxes FROM ranked GROUP BY ALL)",
    "nums AS (SELECT *, lag(boxes) OVER (PARTITION BY run_id ORDER BY frame_idx) AS before, lag(frame_idx) OVER (PARTITION BY run_id ORDER BY frame_idx) AS bf FROM frames)",
    "pairs AS (SELECT n.run_id, n.frame_idx, greatest(abs(a.x1 - b.x1), abs(a.y1 - b.y1), abs(a.x2 - b.x2), abs(a.y2 - b.y2)) > 0.01 AS moved FROM nums n JOIN ranked a ON a.run_id = n.run_id AND a.frame_idx = n.frame_idx JOIN ranked b ON b.run_id = n.run_id AND b.frame_idx = n.bf AND b.k = a.k)"))
def b16(spark, sf):
    """Frames all of whose boxes are where they were in the frame before, to a hundredth: labels carried forward.

    All frames are labelled, at even numbers; behind every twelfth the view has a copy.
    """
    return R.carried_forward(_labelled(spark, sf)).select("run_id", "frame_idx")


@query("i1_mixed_id_order", sql("SELECT run_id, track_id, row_number() OVER (PARTITION BY run_id ORDER BY CASE WHEN try_cast(track_id AS INT) IS NULL THEN 0 ELSE 1 END, try_cast(track_id AS INT), track_id) AS n FROM (SELECT DISTINCT run_id, track_id FROM v_box)"))
def i1(spark, sf):
    number = F.col("track_id").try_cast("int")
    w = Window.partitionBy("run_id").orderBy(F.when(number.isNull(), 0).otherwise(1), number, "track_id")
    return boxes(spark, sf).select("run_id", "track_id").distinct().select("run_id", "track_id", F.row_number().over(w).alias("n"))


@query("i3_review_queue", sql("SELECT run_id, track_id, severity, t, greatest(found - 200, 0) AS cut_off FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS found, row_number() OVER (PARTITION BY run_id ORDER BY severity, t, track_id, line) AS rn FROM (SELECT run_id, track_id, line, t, CASE WHEN x < 100 AND y < 200 THEN 0 WHEN x < 100 THEN 1 ELSE 2 END AS severity FROM v_crossing)) WHERE rn <= 200"))
def i3(spark, sf):
    """The two hundred most severe findings of each run, and how many more there are."""
    severity = F.when((F.col("x") < 100) & (F.col("y") < 200), 0).when(F.col("x") < 100, 1).otherwise(2)
    w = Window.partitionBy("run_id").orderBy("severity", "t", "track_id", "line")
    c = crossings(spark, sf).withColumn("severity", severity)
    cut = F.greatest(F.count("*").over(Window.partitionBy("run_id")) - 200, F.lit(0)).alias("cut_off")
    return c.select("*", F.row_number().over(w).alias("rn"), cut).where("rn <= 200").select("run_id", "track_id", "severity", "t", "cut_off")


@query("i4_longest_tracks", sql("SELECT run_id, track_id, life FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY life DESC, track_id DESC) AS rn FROM (SELECT run_id, track_id, max(t) - min(t) AS life FROM v_box GROUP BY ALL HAVING max(t) - min(t) >= 2.0)) WHERE rn <= 8"))
def i4(spark, sf):
    life = boxes(spark, sf).groupBy("run_id", "track_id").agg((F.max("t") - F.min("t")).alias("life")).where("life >= 2.0")
    w = Window.partitionBy("run_id").orderBy(F.desc("life"), F.desc("track_id"))
    return life.withColumn("rn", F.row_number().over(w)).where("rn <= 8").select("run_id", "track_id", "life")


@query("j3_distinct_boxes", sql("SELECT run_id, count(DISTINCT (x1, y1, x2, y2)) AS boxes, count(DISTINCT track_id) AS ids, round(count(DISTINCT (x1, y1, x2, y2)) / count(*), 5) AS share FROM v_box GROUP BY run_id"))
def j3(spark, sf):
    d = F.count_distinct(F.struct("x1", "y1", "x2", "y2"))
    return boxes(spark, sf).groupBy("run_id").agg(d.alias("boxes"), F.count_distinct("track_id").alias("ids"), F.round(d / F.count("*"), 5).alias("share"))


@query("j4_manifest_difference", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'only_there' WHEN b.k IS NULL THEN 'only_here' ELSE 'changed' END AS state FROM (SELECT doc_id AS k, n_chars AS v FROM documents WHERE source <> 'src1') a FULL JOIN (SELECT doc_id AS k, n_chars + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS v FROM documents WHERE source <> 'src2') b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
@query("g47_provenance_difference", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'only_there' WHEN b.k IS NULL THEN 'only_here' ELSE 'changed' END AS state FROM (SELECT doc_id AS k, n_chars AS v FROM documents WHERE source <> 'src1') a FULL JOIN (SELECT doc_id AS k, n_chars + CASE WHEN lang = 'de' THEN 1 ELSE 0 END AS v FROM documents WHERE source <> 'src2') b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
def j4(spark, sf):
    """Two versions of a manifest, made from one table."""
    d = table(spark, sf, "documents")
    a = d.where("source <> 'src1'").select(F.col("doc_id").alias("k"), F.col("n_chars").alias("v"), F.lit(1).alias("here"))
    b = d.where("source <> 'src2'").select(F.col("doc_id").alias("k"), (F.col("n_chars") + F.when(F.col("lang") == "de", 1).otherwise(0)).alias("w"), F.lit(1).alias("there"))
    j = a.join(b, "k", "full").where(~F.col("v").eqNullSafe(F.col("w")))
    return j.select("k", F.when(F.col("here").isNull(), "only_there").when(F.col("there").isNull(), "only_here").otherwise("changed").alias("state"))


@query("j5_seen_in_both", sql("SELECT run_id, t FROM v_box WHERE role = 'staff' INTERSECT SELECT run_id, t FROM v_box WHERE role <> 'staff'"))
def j5(spark, sf):
    b = boxes(spark, sf)
    return b.where("role = 'staff'").select("run_id", "t").intersect(b.where("role <> 'staff'").select("run_id", "t"))


@query("g46_flatten_ledger", sql("SELECT run_id, 'cross.' || line || '.' || direction AS counter, count(*)::DOUBLE AS value FROM v_crossing GROUP BY ALL"))
def g46(spark, sf):
    c = crossings(spark, sf).groupBy("run_id", "line", "direction").agg(F.count("*").cast("double").alias("v"))
    maps = c.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(".", F.lit("cross"), "line", "direction"), "v"))).alias("m"))
    return maps.select("run_id", F.explode("m").alias("counter", "value"))


LEDGER = """ledger AS (SELECT run_id, line, direction, count(*) AS n FROM v_crossing GROUP BY ALL),
moved AS (SELECT coalesce(a.run_id, b.run_id) AS run_id, line, direction, b.n AS before, a.n AS after FROM ledger a
  FULL JOIN (SELECT run_id + 1 AS run_id, line, direction, n FROM ledger WHERE run_id + 1 IN (SELECT run_id FROM ledger)) b USING (run_id, line, direction) WHERE a.n IS DISTINCT FROM b.n)"""


def _moved(spark, sf):
    """Counters that moved, appeared or vanished between each run and the one before it; all of a first run's appear."""
    now = crossings(spark, sf).groupBy("run_id", "line", "direction").agg(F.count("*").alias("after"))
    was = now.select((F.col("run_id") + 1).alias("run_id"), "line", "direction", F.col("after").alias("before"))
    was = was.join(now.select("run_id").distinct(), "run_id", "left_semi")
    both = was.join(now, ["run_id", "line", "direction"], "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("run_id", "line", "direction", "before", "after")


@query("g45_ledger_compare", sql("SELECT run_id, line, direction, before, after FROM moved", LEDGER))
def g45(spark, sf):
    return _moved(spark, sf)


@query("p62_ledger_flags", sql("SELECT run_id, line, direction, before, coalesce(after, 0) AS after, CASE WHEN after IS NULL THEN 'ERROR: stopped being recorded' WHEN before IS NULL THEN 'new' WHEN after < before THEN 'less' ELSE 'more' END AS flag FROM moved", LEDGER))
def p62(spark, sf):
    """The same with what each change means. A counter of a run's ledger that no later run has is an error."""
    gone, fresh = F.col("after").isNull(), F.col("before").isNull()
    flag = F.when(gone, "ERROR: stopped being recorded").when(fresh, "new").when(F.col("after") < F.col("before"), "less").otherwise("more")
    return _moved(spark, sf).select("run_id", "line", "direction", "before", F.coalesce("after", F.lit(0)).alias("after"), flag.alias("flag"))


@query("g49_funnel", sql("SELECT run_id, count(*) AS n_in, count(*) FILTER (conf >= 0.35) AS confident, count(*) FILTER (conf >= 0.35 AND y2 - y1 >= 110) AS tall, round(1 - count(*) FILTER (conf >= 0.35 AND y2 - y1 >= 110) / count(*), 5) AS dropped, CASE WHEN count(*) FILTER (conf >= 0.35 AND y2 - y1 >= 110) < 0.75 * count(*) THEN 'WARN' ELSE 'OK' END AS finding FROM v_box GROUP BY run_id"))
def g49(spark, sf):
    first = F.col("conf") >= 0.35
    both = F.count_if(first & (F.col("y2") - F.col("y1") >= 110))
    n = F.count("*")
    return boxes(spark, sf).groupBy("run_id").agg(n.alias("n_in"), F.count_if(first).alias("confident"), both.alias("tall"), F.round(1 - both / n, 5).alias("dropped"), F.when(both < 0.75 * n, "WARN").otherwise("OK").alias("finding"))


@query("l1_zone_roles", "SELECT user_id, CASE WHEN contains(n, 'entr') OR contains(n, 'door') THEN 'entry' WHEN contains(n, 'table') OR contains(n, 'dining') THEN 'seating' WHEN contains(n, 'wait') THEN 'waiting' WHEN contains(n, 'desk') OR contains(n, 'recep') THEN 'staff' ELSE 'other' END AS zone_role FROM (SELECT event_id AS user_id, lower(CASE event_type WHEN 'signup' THEN 'Main Entrance' WHEN 'view' THEN 'Waiting Area' WHEN 'click' THEN 'Dining 2' WHEN 'purchase' THEN 'Reception' ELSE 'Bar' END) AS n FROM events)")
def l1(spark, sf):
    names = {"signup": "Main Entrance", "view": "Waiting Area", "click": "Dining 2", "purchase": "Reception"}
    n = F.lit("Bar")
    for k, v in names.items():
        n = F.when(F.col("event_type") == k, v).otherwise(n)
    n = F.lower(n)
    has = lambda *words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(n, w))
    role = F.when(has("entr", "door"), "entry").when(has("table", "dining"), "seating").when(has("wait"), "waiting").when(has("desk", "recep"), "staff").otherwise("other")
    return table(spark, sf, "events").select(F.col("event_id").alias("user_id"), role.alias("zone_role"))


@query("l4_mmss", sql("SELECT run_id, frame_idx, track_id, printf('%02d:%02d', CAST(floor(t) AS INT) // 60, CAST(floor(t) AS INT) % 60) AS at, strftime(TIMESTAMP '2024-01-01 09:30:00' + to_seconds(floor(t)), '%H:%M:%S') AS wall FROM v_box"))
def l4(spark, sf):
    s = F.floor("t").cast("int")
    wall = F.date_format(F.timestamp_add("SECOND", s, F.lit("2024-01-01 09:30:00").cast("timestamp")), "HH:mm:ss")
    return boxes(spark, sf).select("run_id", "frame_idx", "track_id", F.format_string("%02d:%02d", F.expr("cast(floor(t) as int) div 60").cast("int"), s % 60).alias("at"), wall.alias("wall"))


@query("l14_name_from_path", "SELECT page_id, lower(regexp_replace(regexp_replace(url, '^.*/', ''), '[-_]?[0-9]*([.][a-z]+)?$', '')) AS name FROM pages")
def l14(spark, sf):
    stem = F.regexp_replace(F.regexp_replace("url", "^.*/", ""), "[-_]?[0-9]*([.][a-z]+)?$", "")
    return table(spark, sf, "pages").select("page_id", F.lower(stem).alias("name"))


PRICING = "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus"


@query("rel_pricing_summary", PRICING)
def pricing(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("date"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("rel_nation_revenue", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def nation_revenue(spark, sf):
    """Nations are few by nature; everything else is left to the planner."""
    c, o, li, n = (table(spark, sf, t) for t in ("customer", "orders", "lineitem", "nation"))
    j = li.select("l_orderkey", "l_extendedprice", "l_discount").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("rel_customers_without_orders", "SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey")
def no_orders(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("rel_conversation_gaps", "SELECT conv_id, count(*) AS turns, count(*) FILTER (role = p) AS repeats FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY conv_id")
def gaps(spark, sf):
    same = F.col("role") == F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, sf, "conversations").withColumn("same", same).groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if("same").alias("repeats"))
