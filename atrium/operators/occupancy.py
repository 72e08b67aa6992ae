"""Sightings to zone events, timelines and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.operators.intervals import merge

STEP, GAP = 0.25, 15.0


def zone_events(sightings: DataFrame, step: float = STEP, gap: float = GAP, min_event: float = 2.0, entry_zones: tuple[str, ...] = (), entry_min: float = 0.5) -> DataFrame:
    """Sightings last one step each and merge over gaps up to `gap`: run_id, track_id, role, zone, t_in, t_out, duration.

    Short events are dropped; entry zones have their own minimum. (F7, F8)
    """
    keys = ["run_id", "track_id", "role", "zone"]
    merged = merge(sightings.select(*keys, F.col("t").alias("t_in"), (F.col("t") + step).alias("t_out")), keys, gap=gap)
    least = F.when(F.col("zone").isin(*entry_zones), entry_min).otherwise(min_event) if entry_zones else F.lit(min_event)
    kept = merged.where(F.col("t_out") - F.col("t_in") >= least)
    return kept.select(*keys, F.round("t_in", 2).alias("t_in"), F.round("t_out", 2).alias("t_out"), F.round(F.col("t_out") - F.col("t_in"), 2).alias("duration"))


def timeline(events: DataFrame, spans: DataFrame, step: float = 10.0) -> DataFrame:
    """Distinct tracks per role and step of each run, zero-filled: run_id, t0, role, people.

    spans: run_id, t_end. An event counts in every step it overlaps. (G8)
    """
    steps = spans.select("run_id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("t_end") / step).cast("int") - 1)).alias("n"))
    steps = steps.join(events.select("run_id", "role").distinct(), "run_id")
    # An event lists the steps it overlaps: an equi-join instead of comparing every event with every step.
    last = F.ceil(F.col("t_out") / step).cast("int") - 1
    listed = events.where("t_out > t_in").select("run_id", "role", "track_id", F.explode(F.sequence(F.floor(F.col("t_in") / step).cast("int"), last)).alias("n"))
    counts = listed.groupBy("run_id", "role", "n").agg(F.count_distinct("track_id").alias("people"))
    return steps.join(counts, ["run_id", "role", "n"], "left").select("run_id", (F.col("n") * step).alias("t0"), "role", F.coalesce("people", F.lit(0)).alias("people"))


def minute_summaries(events: DataFrame, crossings: DataFrame, spans: DataFrame, window: float = 60.0) -> DataFrame:
    """Per minute of each run: people, person_ids, n_in, n_out, zones (sorted lists as text)."""
    grid = spans.select("run_id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("t_end") / window).cast("int") - 1)).alias("n"))
    last = F.ceil(F.col("t_out") / window).cast("int") - 1
    seen = events.where("t_out > t_in").select("run_id", "track_id", "zone", F.explode(F.sequence(F.floor(F.col("t_in") / window).cast("int"), last)).alias("n"))
    text = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    people = seen.groupBy("run_id", "n").agg(F.count_distinct("track_id").alias("people"), text("track_id").alias("person_ids"), text("zone").alias("zones"))
    is_in = F.col("direction") == "in"
    moves = crossings.groupBy("run_id", F.floor(F.col("t") / window).cast("int").alias("n")).agg(F.count_if(is_in).alias("n_in"), F.count_if(~is_in).alias("n_out"))
    out = grid.join(people, ["run_id", "n"], "left").join(moves, ["run_id", "n"], "left")
    zero, none = F.lit(0), F.lit("")
    return out.select("run_id", (F.col("n") * window).alias("t0"), F.coalesce("people", zero).alias("people"), F.coalesce("person_ids", none).alias("person_ids"), F.coalesce("zones", none).alias("zones"), F.coalesce("n_in", zero).alias("n_in"), F.coalesce("n_out", zero).alias("n_out"))


def spans(events: DataFrame) -> DataFrame:
    """Each run's end: run_id, t_end."""
    return events.groupBy("run_id").agg(F.max("t_out").alias("t_end"))


def upper_median(values: Column | str) -> Column:
    """The upper of the two middle values. (one of the five quantile conventions)"""
    ordered = F.sort_array(F.collect_list(values))
    return F.try_element_at(ordered, F.floor(F.size(ordered) / 2).cast("int") + 1)


def floor_quantile(values: Column | str, p: float) -> Column:
    """The value at floor(p * (n - 1)) of the sorted values."""
    ordered = F.sort_array(F.collect_list(values))
    return F.try_element_at(ordered, F.floor(F.lit(p) * (F.size(ordered) - 1)).cast("int") + 1)


def runs_of(rows: DataFrame, keys: list[str], at: str, gap: float) -> DataFrame:
    """Numbers runs of rows whose distance in time is at most gap: adds `run`."""
    order = Window.partitionBy(*keys).orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(order) > gap).cast("int"), F.lit(1))
    return rows.withColumn("_new", new).withColumn("run", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")
