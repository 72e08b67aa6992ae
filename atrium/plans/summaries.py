"""Queries that put a run's answers together: derived fields, full scorecards, proposals, and summaries as lines (rows B4, P3, P4 and P6 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from atrium.plans.registry import ORACLE_SQL, QUERIES, query

#: (section, metric, query, value) of a full scorecard; the last is the text of one column in both engines.
PARTS = [
    ("funnel", "detections", "g49_funnel", "CAST(n_in AS STRING)"),
    ("funnel", "finding", "g49_funnel", "finding"),
    ("tiers", "confirmed", "g32_tier_summary", "CAST(confirmed AS STRING)"),
    ("tiers", "uncertain", "g32_tier_summary", "CAST(uncertain AS STRING)"),
    ("provenance", "fingerprint", "g48_fingerprint", "fingerprint"),
    ("validity", "blind", "g51_validity_summary", "CAST(blind AS STRING)"),
    ("arrivals", "source", "g16_arrival_source", "source"),
    ("arrivals", "agreement", "p5_arrival_agreement", "agreement"),
    ("ledger", "reconciled", "p56_scorecard_reconciled", "CAST(reconciled AS STRING)"),
    ("zones", "preflight", "m1_preflight", "verdict"),
]


def _sub(name: str) -> str:
    return f"({ORACLE_SQL[name]})"


_CARD = " UNION ALL ".join(f"SELECT run_id, '{s}' AS section, '{m}' AS metric, {v} AS value FROM {_sub(q)}" for s, m, q, v in PARTS)
_CARD += f" UNION ALL SELECT run_id, 'review', 'queued', CAST(count(*) AS STRING) FROM {_sub('i3_review_queue')} GROUP BY run_id UNION ALL SELECT run_id, 'review', 'cut off', CAST(max(cut_off) AS STRING) FROM {_sub('i3_review_queue')} GROUP BY run_id"
_CARD += f" UNION ALL SELECT run_id, 'decisions', decision, CAST(n AS STRING) FROM {_sub('p63_decision_summary')}"


@query("p4_full_scorecard", f"SELECT run_id, section, metric, value FROM ({_CARD})")
def p4(spark, sf):
    """Funnel, tiers, provenance, validity, arrivals, review, ledger and zones of a run, each as the text of its own query; a part that
    has nothing on a run has no row, never a 0."""
    card = None
    for section, metric, name, value in PARTS:
        rows = QUERIES[name](spark, sf).select("run_id", F.lit(section).alias("section"), F.lit(metric).alias("metric"), F.expr(value).alias("value"))
        card = rows if card is None else card.unionByName(rows)
    queue = QUERIES["i3_review_queue"](spark, sf).groupBy("run_id").agg(F.count("*").alias("queued"), F.max("cut_off").alias("cut off"))
    for metric in ("queued", "cut off"):
        card = card.unionByName(queue.select("run_id", F.lit("review").alias("section"), F.lit(metric).alias("metric"), F.col(f"`{metric}`").cast("string").alias("value")))
    decisions = QUERIES["p63_decision_summary"](spark, sf).select("run_id", F.lit("decisions").alias("section"), F.col("decision").alias("metric"), F.col("n").cast("string").alias("value"))
    return card.unionByName(decisions)


_WARN = "CASE source WHEN 'line' THEN 'arrivals from the line only: check the entry zone' WHEN 'none' THEN 'both arrival sensors are empty: greet latency is unknown' END"


@query("p3_enriched_runs", f"SELECT run_id, source, analysed AS observed_s, coalesce(g.guests, 0) AS guests, coalesce(contacts, 0) AS contacts, {_WARN} AS warning FROM {_sub('f12_coverage_report')} LEFT JOIN {_sub('g16_arrival_source')} USING (run_id) LEFT JOIN (SELECT run_id, count(*) AS guests FROM {_sub('g17_guest_ids')} GROUP BY run_id) g USING (run_id) LEFT JOIN (SELECT run_id, contacts FROM {_sub('p2_staff_contacts')}) USING (run_id)")
def p3(spark, sf):
    """What is derived of a run before answers: where arrivals come from, what was observed, guests, contacts, and what weakens them."""
    q = lambda name: QUERIES[name](spark, sf)
    guests = q("g17_guest_ids").groupBy("run_id").agg(F.count("*").alias("guests"))
    runs = q("f12_coverage_report").select("run_id", F.col("analysed").alias("observed_s")).join(q("g16_arrival_source"), "run_id", "left")
    runs = runs.join(guests, "run_id", "left").join(q("p2_staff_contacts").select("run_id", "contacts"), "run_id", "left")
    return runs.select("run_id", "source", "observed_s", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("guests", "contacts")], F.expr(_WARN).alias("warning"))


@query("p6_proposed_entries", f"SELECT i.* FROM {_sub('i6_zone_proposals')} i JOIN {_sub('p5_arrival_agreement')} a USING (run_id) WHERE a.agreement IS DISTINCT FROM 'agree'")
def p6(spark, sf):
    """Where tracks say the door is, for runs whose line and region don't agree on arrivals or can't tell."""
    doubted = QUERIES["p5_arrival_agreement"](spark, sf).where(~F.col("agreement").eqNullSafe("agree")).select("run_id").distinct()
    return QUERIES["i6_zone_proposals"](spark, sf).join(doubted, "run_id", "left_semi")


_LINES = f"""SELECT run_id, 0 AS part, '' AS key, 'RUN ' || CAST(run_id AS STRING) || '   ' || printf('%.2f', analysed) || ' s analysed   ' || printf('%.2f', skipped) || ' s missing' AS line FROM {_sub('f12_coverage_report')}
UNION ALL SELECT run_id, 1, '', 'source  ' || fingerprint FROM {_sub('g48_fingerprint')}
UNION ALL SELECT run_id, 2, '', strip FROM {_sub('l12_coverage_strip')}
UNION ALL SELECT run_id, 3, key, rpad(key, 38, ' ') || ' ' || rpad(coalesce(printf('%.1f', value), 'NOT MEASURED'), 18, ' ') || ' [' || tier || ']' FROM {_sub('g23_answer_set')}
UNION ALL SELECT run_id, 4, '', '!! desk empty ' || CAST(gaps AS STRING) || ' times for ten seconds or more' FROM {_sub('f19_reception_absence')} WHERE gaps > 0"""


@query("b4_summary_lines", f"SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY part, key) AS n, line FROM ({_LINES})")
def b4(spark, sf):
    """A run's summary, a row for each line: what it stands on, the strip of coverage, the answers with their tiers, and notes."""
    from pyspark.sql import Window

    q = lambda name: QUERIES[name](spark, sf)
    one = lambda c: F.format_string("%.1f", c)
    row = lambda part, key, line: ["run_id", F.lit(part).alias("part"), key.alias("key"), line.alias("line")]
    none = F.lit("")
    head = F.concat(F.lit("RUN "), F.col("run_id").cast("string"), F.lit("   "), F.format_string("%.2f", "analysed"), F.lit(" s analysed   "), F.format_string("%.2f", "skipped"), F.lit(" s missing"))
    shown = F.coalesce(F.when(F.col("value").isNotNull(), one("value")), F.lit("NOT MEASURED"))
    answer = F.concat(F.rpad("key", 38, " "), F.lit(" "), F.rpad(shown, 18, " "), F.lit(" ["), F.col("tier"), F.lit("]"))
    gaps = F.concat(F.lit("!! desk empty "), F.col("gaps").cast("string"), F.lit(" times for ten seconds or more"))
    lines = q("f12_coverage_report").select(*row(0, none, head)).unionByName(q("g48_fingerprint").select(*row(1, none, F.concat(F.lit("source  "), F.col("fingerprint")))))
    lines = lines.unionByName(q("l12_coverage_strip").select(*row(2, none, F.col("strip")))).unionByName(q("g23_answer_set").select(*row(3, F.col("key"), answer)))
    lines = lines.unionByName(q("f19_reception_absence").where("gaps > 0").select(*row(4, none, gaps)))
    return lines.select("run_id", F.row_number().over(Window.partitionBy("run_id").orderBy("part", "key")).cast("long").alias("n"), "line")
