"""Queries that score detections against truth (tables G and M of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atrium.operators import scoring as S
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sql


def _truth(spark, sf):
    return boxes(spark, sf).where("track_id not like 'm%'")


def _found(spark, sf):
    """The truth moved by a few pixels, thinned, and with some identities swapped halfway."""
    t = _truth(spark, sf).where(F.pmod(F.crc32(F.concat_ws("-", "frame_idx", "track_id").cast("binary")), F.lit(7)) != 0)
    n = F.col("track_id").cast("int")
    swapped = F.when((n % 5 == 0) & (F.col("frame_idx") >= 200), (n + 1).cast("string")).otherwise(F.col("track_id"))
    moved = t.withColumn("track_id", swapped).withColumn("x1", F.col("x1") + n % 4).withColumn("x2", F.col("x2") + n % 4)
    return moved.groupBy("run_id", "frame_idx", "track_id").agg(*[F.min(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("g42_hota")
def g42(spark, sf):
    return S.hota(_truth(spark, sf), _found(spark, sf))


@query("g42_mota")
def g42b(spark, sf):
    return S.mota(_truth(spark, sf), _found(spark, sf))


@query("g42_perfect_tracker", sql("SELECT DISTINCT run_id, 1.0::DOUBLE AS hota, 1.0::DOUBLE AS deta, 1.0::DOUBLE AS assa FROM v_box WHERE track_id NOT LIKE 'm%'"))
def g42c(spark, sf):
    t = _truth(spark, sf)
    return S.hota(t, t)


@query("g41_truth_validation", sql(
    "SELECT run_id, count(DISTINCT (x1, y1, x2, y2)) / count(*) < 0.3 AS repeated, median((y2 - y1) / (x2 - x1)) BETWEEN 1.5 AND 4.5 AS shapes_ok, count(DISTINCT frame_idx) < 30 AS short FROM v_box GROUP BY run_id"))
def g41(spark, sf):
    unique = F.count_distinct(F.struct("x1", "y1", "x2", "y2")) / F.count("*")
    shape = F.median((F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    return boxes(spark, sf).groupBy("run_id").agg((unique < 0.3).alias("repeated"), shape.between(1.5, 4.5).alias("shapes_ok"), (F.count_distinct("frame_idx") < 30).alias("short"))


@query("m8_scorecard_verdicts", sql(
    "SELECT run_id, name, CASE WHEN v IS NULL THEN 'NO-TRUTH' WHEN v >= bar THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT run_id, count(*) FILTER (direction = 'in') / count(*) AS a, CASE WHEN count(*) > 1000 THEN avg(x) / 1200 END AS b FROM v_crossing GROUP BY run_id) s, LATERAL (VALUES ('entries', a, 0.4), ('balance', b, 0.5)) v(name, v, bar)"))
def m8(spark, sf):
    """A metric without truth is NO-TRUTH, never PASS."""
    n = F.count("*")
    s = crossings(spark, sf).groupBy("run_id").agg((F.count_if(F.col("direction") == "in") / n).alias("a"), F.when(n > 1000, F.avg("x") / 1200).alias("b"))
    named = F.explode(F.array(F.struct(F.lit("entries").alias("name"), F.col("a").alias("v"), F.lit(0.4).alias("bar")), F.struct(F.lit("balance").alias("name"), F.col("b").alias("v"), F.lit(0.5).alias("bar"))))
    r = s.select("run_id", named.alias("r")).select("run_id", "r.*")
    return r.select("run_id", "name", F.when(F.col("v").isNull(), "NO-TRUTH").when(F.col("v") >= F.col("bar"), "PASS").otherwise("FAIL").alias("verdict"))


CASES = "cases AS (SELECT * FROM (VALUES ('quiet', 26.0, 39.0, 0), ('busy', 221.0, 234.0, 40), ('beyond', 99000.0, 99010.0, 1)) AS v(name, w0, w1, most))"


@query("m9_regression_cases", sql("SELECT run_id, name, CASE WHEN w0 > e THEN 'NO-DATA' WHEN n <= most THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT r.run_id, r.e, c.name, c.w0, c.most, (SELECT count(*) FROM v_crossing x WHERE x.run_id = r.run_id AND x.t >= c.w0 AND x.t <= c.w1) AS n FROM (SELECT run_id, max(t) AS e FROM v_crossing GROUP BY run_id) r, cases c)", CASES))
def m9(spark, sf):
    from atrium.operators.intervals import range_join

    c = crossings(spark, sf)
    cases = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("w0"), F.lit(b).alias("w1"), F.lit(m).alias("most")) for n, a, b, m in (("quiet", 26.0, 39.0, 0), ("busy", 221.0, 234.0, 40), ("beyond", 99000.0, 99010.0, 1))])
    each = c.groupBy("run_id").agg(F.max("t").alias("e")).select("run_id", "e", F.explode(cases).alias("c")).select("run_id", "e", "c.*")
    n = range_join(c.select("run_id", "t"), each, ["run_id"], "t", "w0", "w1", 20.0).groupBy("run_id", "name").agg(F.count("*").alias("n"))
    r = each.join(n, ["run_id", "name"], "left")
    return r.select("run_id", "name", F.when(F.col("w0") > F.col("e"), "NO-DATA").when(F.coalesce("n", F.lit(0)) <= F.col("most"), "PASS").otherwise("FAIL").alias("verdict"))
