"""The venue's answers: desk coverage, greeting latency, guest counts, roles, visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.operators.intervals import clip, complement, merge, total
from atrium.operators.occupancy import runs_of, upper_median

EXACT, PROXY, ESTIMATE, WEAK, UNKNOWN = "EXACT", "PROXY", "ESTIMATE", "WEAK", "UNKNOWN"


def presence(events: DataFrame, zones: tuple[str, ...], role: str | None = None, gap: float = 0.0) -> DataFrame:
    """Merged intervals per run in which anybody of the role is in the zones: run_id, t_in, t_out."""
    rows = events.where(F.col("zone").isin(*zones))
    return merge(rows if role is None else rows.where(F.col("role") == role), ["run_id"], gap=gap)


def desk_coverage(events: DataFrame, zones: tuple[str, ...], windows: DataFrame, target: float = 90.0) -> DataFrame:
    """Share of observed time with staff at the desk. Without observed time the value is null and the tier UNKNOWN.

    windows: run_id, w0, w1, disjoint. (G20)
    """
    observed = windows.groupBy("run_id").agg(F.sum(F.greatest(F.col("w1") - F.col("w0"), F.lit(0.0))).alias("observed_s"))
    covered = total(clip(presence(events, zones, "staff"), windows, ["run_id"]), ["run_id"], name="covered_s")
    out = observed.join(covered, "run_id", "left").withColumn("covered_s", F.coalesce("covered_s", F.lit(0.0)))
    value = F.when(F.col("observed_s") > 0, F.round(100 * F.col("covered_s") / F.col("observed_s"), 1))
    return out.select("run_id", "observed_s", "covered_s", value.alias("value"), F.when(value.isNull(), UNKNOWN).otherwise(EXACT).alias("tier"), (value >= target).alias("on_target"))


def desk_gaps(events: DataFrame, staff_zones: tuple[str, ...], waiting_zones: tuple[str, ...], windows: DataFrame, least: float = 60.0) -> DataFrame:
    """Uncovered spans of at least `least` seconds, with the number of merged waiting episodes that overlap."""
    gaps = complement(presence(events, staff_zones, "staff"), windows, ["run_id"]).where(F.col("t_out") - F.col("t_in") >= least)
    waits = presence(events, waiting_zones, "customer").select("run_id", F.col("t_in").alias("a"), F.col("t_out").alias("b"))
    overlapping = gaps.join(waits, "run_id").where("a < t_out and t_in < b").groupBy("run_id", "t_in").agg(F.count("*").alias("n"))
    out = gaps.join(overlapping, ["run_id", "t_in"], "left")
    return out.select("run_id", "t_in", "t_out", (F.col("t_out") - F.col("t_in")).alias("gap_s"), F.coalesce("n", F.lit(0)).alias("guests_waiting"))


def contacts(near: DataFrame, gap: float = 3.0, least: float = 3.0) -> DataFrame:
    """Starts of runs of nearness of at least `least` seconds: run_id, track_id, t. near: run_id, track_id, t."""
    keys = ["run_id", "track_id"]
    found = runs_of(near.select(*keys, "t").distinct(), keys, "t", gap).groupBy(*keys, "run").agg(F.min("t").alias("t"), F.max("t").alias("last"))
    return found.where(F.col("last") - F.col("t") >= least).select(*keys, "t")


def greet_latency(arrivals: DataFrame, greetings: DataFrame) -> DataFrame:
    """Per run: guests, greeted, and the upper median of the wait from arrival to the first contact after it."""
    first = arrivals.join(greetings.withColumnRenamed("t", "contact"), ["run_id", "track_id"], "left").groupBy("run_id", "track_id", "t").agg(
        F.min(F.when(F.col("contact") >= F.col("t"), F.col("contact"))).alias("contact")
    )
    waits = first.withColumn("wait", F.col("contact") - F.col("t"))
    out = waits.groupBy("run_id").agg(F.count("*").alias("guests"), F.count("wait").alias("greeted"), F.round(upper_median("wait"), 2).alias("median_s"))
    return out.withColumn("tier", F.when(F.col("greeted") > 0, PROXY).otherwise(UNKNOWN))


def staff_evidence(events: DataFrame, staff_zones: tuple[str, ...], observed: DataFrame) -> DataFrame:
    """Per track: dwell in staff zones, lifetime, share, visits and spread over the run. observed: run_id, observed_s."""
    inside = F.col("zone").isin(*staff_zones)
    out = events.groupBy("run_id", "track_id").agg(
        F.sum(F.when(inside, F.col("duration")).otherwise(0.0)).alias("dwell"),
        F.greatest(F.max("t_out") - F.min("t_in"), F.lit(1e-9)).alias("lifetime"),
        F.count_if(inside).alias("visits"),
        F.coalesce(F.max(F.when(inside, F.col("t_out"))) - F.min(F.when(inside, F.col("t_in"))), F.lit(0.0)).alias("span"),
    )
    out = out.join(observed.select("run_id", "observed_s"), "run_id")
    return out.select(
        "run_id",
        "track_id",
        F.round("dwell", 2).alias("dwell"),
        F.round("lifetime", 2).alias("lifetime"),
        F.round(F.least(F.col("dwell") / F.col("lifetime"), F.lit(1.0)), 4).alias("share"),
        "visits",
        F.round("span", 2).alias("span"),
        F.round(F.when(F.col("observed_s") > 0, F.col("span") / F.col("observed_s")), 4).alias("spread"),
        "observed_s",
    )


def staff_override(evidence: DataFrame, least: float = 60.0, share: float = 0.6, share_dwell: float = 15.0) -> DataFrame:
    """Who is staff by evidence, and why: returns over much of the run, or sole occupancy; without observed time, dwell or share."""
    sole = F.greatest(F.lit(least), F.least(F.lit(10 * least), 0.5 * F.col("observed_s")))
    spread = (F.col("visits") >= 2) & (F.col("spread") >= 0.25)
    timed = F.col("observed_s") > 0
    reason = (
        F.when(timed & spread, "spread")
        .when(timed & (F.col("dwell") >= sole), "sole")
        .when(~timed & (F.col("dwell") >= least), "dwell")
        .when(~timed & (F.col("share") >= share) & (F.col("dwell") >= share_dwell), "share")
    )
    return evidence.select("run_id", "track_id", reason.alias("reason"), F.when(reason.isNotNull(), "staff").otherwise("customer").alias("role"))


def region_arrivals(events: DataFrame, entry: tuple[str, ...], interior: tuple[str, ...]) -> DataFrame:
    """First interior event at or after the first entry event of each track: run_id, track_id, t."""
    keys = ["run_id", "track_id"]
    first = events.where(F.col("zone").isin(*entry)).groupBy(*keys).agg(F.min("t_in").alias("entered"))
    inside = events.where(F.col("zone").isin(*interior)).join(first, keys).where("t_in >= entered")
    return inside.groupBy(*keys).agg(F.min("t_in").alias("t"))


def visits(crossings: DataFrame) -> DataFrame:
    """Visits of each person: run_id, track_id, t_in, t_out, status.

    An `in` followed by an `out` is closed, followed by another `in` it has a
    missed exit, and as the last it is open; an `out` that no `in` precedes
    has a missed entry. (H9)
    """
    order = Window.partitionBy("run_id", "track_id").orderBy("t", "direction", "line")
    rows = crossings.withColumn("next", F.lead("direction").over(order)).withColumn("next_t", F.lead("t").over(order)).withColumn("last", F.lag("direction").over(order))
    is_in = F.col("direction") == "in"
    status = F.when(is_in & (F.col("next") == "out"), "closed").when(is_in & (F.col("next") == "in"), "exit_missed").when(is_in, "open").otherwise("entry_missed")
    rows = rows.withColumn("status", status).where(is_in | (F.coalesce(F.col("last"), F.lit("out")) != "in"))
    t_out = F.when(F.col("status") == "closed", F.col("next_t")).when(F.col("status") == "entry_missed", F.col("t"))
    return rows.select("run_id", "track_id", F.when(is_in, F.col("t")).alias("t_in"), t_out.alias("t_out"), "status")


def visit_counts(found: DataFrame) -> DataFrame:
    """Per run: people, visits, each status, repeat visitors and the true median of closed durations."""
    per = found.groupBy("run_id", "track_id").agg(F.count("*").alias("n"))
    repeat = per.groupBy("run_id").agg(F.count("*").alias("unique_people"), F.count_if(F.col("n") > 1).alias("repeat_visitors"))
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    duration = F.when(F.col("status") == "closed", F.col("t_out") - F.col("t_in"))
    totals = found.groupBy("run_id").agg(F.count("*").alias("n_visits"), of("closed"), of("open"), of("exit_missed"), of("entry_missed"), F.median(duration).alias("median_s"))
    return repeat.join(totals, "run_id")


def cross_check(line: Column, region: Column, movers: Column, coverage: Column, tolerance: float = 0.25, least_share: float = 0.5) -> Column:
    """Which of the two arrival counts can be trusted; the order of the branches matters."""
    top = F.greatest(line, region)
    return (
        F.when(coverage.isNotNull() & (coverage < least_share) & (movers >= 5), "misplaced_entry")
        .when(line.isNull() & region.isNull(), "neither")
        .when(region.isNull(), "line_only")
        .when(line.isNull(), "region_only")
        .when((line == 0) & (region == 0), F.when(movers >= 5, "neither").otherwise("quiet"))
        .when((top - F.least(line, region)) / top <= tolerance, "agree")
        .otherwise(F.when(line > region, "line_high").otherwise("region_high"))
    )
