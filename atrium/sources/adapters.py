"""Venue-shaped views of the generic tables, and the same views as SQL.

A run is 5,000 consecutive events of a quarter of a second each; everything
downstream is keyed by run_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = {"signup": "main_entrance", "view": "waiting", "click": "dining", "purchase": "reception", "error": "bar"}
LINES = ("entry line", "side door", "bar line")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.expr("cast(event_id div 5000 as int)").alias("run_id"),
        (F.col("event_id") % 5000).alias("i"),
        "user_id",
        "event_type",
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.when(F.col("user_id") % 10 == 0, "staff").otherwise("customer").alias("role"),
        F.col("user_id").cast("string").alias("track_id"),
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, track_id, role, zone, t."""
    zone = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])[F.col("event_type")]
    return _events(spark, sf_dir).select("run_id", "track_id", "role", zone.alias("zone"), (F.col("i") * 0.25).alias("t"))


def crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, track_id, role, direction, line, x, y, t."""
    line = F.element_at(F.array(*[F.lit(x) for x in LINES]), F.col("k") % 3 + 1)
    return (
        _events(spark, sf_dir)
        .where(F.col("event_type").isin("view", "click"))
        .select(
            "run_id",
            "track_id",
            "role",
            F.when(F.col("event_type") == "view", "in").otherwise("out").alias("direction"),
            line.alias("line"),
            (F.col("k") * 12.0).alias("x"),
            ((F.col("event_id") % 90) * 12.0).alias("y"),
            (F.col("i") * 0.25).alias("t"),
        )
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, frame_idx, t, track_id, role, x1, y1, x2, y2, conf: with some furniture and some reflections."""
    e = _events(spark, sf_dir).withColumn("frame_idx", F.expr("cast(i div 5 as int)"))
    # A track's first event in a frame, with one shuffle.
    first = F.min_by(F.struct("event_id", "track_id", "role", "k"), "event_id").alias("f")
    e = e.groupBy("run_id", "frame_idx", "user_id").agg(first).select("run_id", "frame_idx", "user_id", "f.*")
    still = F.col("user_id") % 25 == 7
    b = e.select(
        "run_id",
        "frame_idx",
        (F.col("frame_idx") * 0.125).alias("t"),
        "user_id",
        "track_id",
        "role",
        F.when(still, 300.0 + F.col("user_id")).otherwise(F.col("k") * 16.0).alias("x1"),
        F.when(still, 200.0).otherwise((F.col("event_id") % 60) * 10.0).alias("y1"),
        (40.0 + F.col("user_id") % 20).alias("w"),
        (100.0 + 2.5 * (F.col("user_id") % 20)).alias("h"),
        (0.3 + (F.col("event_id") % 70) / 100.0).alias("conf"),
    )
    mirror = b.where("user_id % 25 = 3").withColumn("track_id", F.concat(F.lit("m"), "track_id")).withColumn("x1", F.col("x1") + 200.0)
    both = b.unionByName(mirror)
    return both.select("run_id", "frame_idx", "t", "track_id", "role", "x1", "y1", (F.col("x1") + F.col("w")).alias("x2"), (F.col("y1") + F.col("h")).alias("y2"), "conf")


#: CTEs for DuckDB: v_event, v_sighting, v_crossing, v_box.
VIEWS = """
v_event AS (SELECT event_id, CAST(event_id // 5000 AS INT) AS run_id, event_id % 5000 AS i, user_id, event_type, value,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, CASE WHEN user_id % 10 = 0 THEN 'staff' ELSE 'customer' END AS role, CAST(user_id AS VARCHAR) AS track_id FROM events),
v_sighting AS (SELECT run_id, track_id, role, CASE event_type WHEN 'signup' THEN 'main_entrance' WHEN 'view' THEN 'waiting' WHEN 'click' THEN 'dining' WHEN 'purchase' THEN 'reception' WHEN 'error' THEN 'bar' END AS zone,
  CAST(i * 0.25 AS DOUBLE) AS t FROM v_event),
v_crossing AS (SELECT run_id, track_id, role, CASE WHEN event_type = 'view' THEN 'in' ELSE 'out' END AS direction, ['entry line', 'side door', 'bar line'][k % 3 + 1] AS line,
  CAST(k * 12.0 AS DOUBLE) AS x, CAST((event_id % 90) * 12.0 AS DOUBLE) AS y, CAST(i * 0.25 AS DOUBLE) AS t FROM v_event WHERE event_type IN ('view', 'click')),
v_box0 AS (SELECT run_id, CAST(i // 5 AS INT) AS frame_idx, CAST((i // 5) * 0.125 AS DOUBLE) AS t, user_id, track_id, role,
  CAST(CASE WHEN user_id % 25 = 7 THEN 300.0 + user_id ELSE k * 16.0 END AS DOUBLE) AS x1, CAST(CASE WHEN user_id % 25 = 7 THEN 200.0 ELSE (event_id % 60) * 10.0 END AS DOUBLE) AS y1,
  CAST(40.0 + user_id % 20 AS DOUBLE) AS w, CAST(100.0 + 2.5 * (user_id % 20) AS DOUBLE) AS h, CAST(0.3 AS DOUBLE) + CAST(event_id % 70 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS conf
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id, i // 5, user_id ORDER BY event_id) AS rn FROM v_event) WHERE rn = 1),
v_box AS (SELECT run_id, frame_idx, t, track_id, role, x1, y1, x1 + w AS x2, y1 + h AS y2, conf FROM v_box0
  UNION ALL SELECT run_id, frame_idx, t, 'm' || track_id, role, x1 + 200.0, y1, x1 + 200.0 + w, y1 + h, conf FROM v_box0 WHERE user_id % 25 = 3)
"""


def sql(text: str, *ctes: str) -> str:
    """A DuckDB query over the views, after further CTEs."""
    return "WITH " + ",\n".join([VIEWS.strip(), *[c.strip() for c in ctes]]) + "\n" + text
