"""Known answers, edge cases and properties."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from atrium.functions import geometry as G
from atrium.operators import answers as A
from atrium.operators import crossings as C
from atrium.operators import detections as D
from atrium.operators import identity as I
from atrium.operators import scoring as S
from atrium.operators.components import connected_components
from atrium.operators.intervals import complement, merge, range_join

EVENT = "run_id int, track_id string, role string, zone string, t_in double, t_out double, duration double"


def events(spark, *rows):
    return spark.createDataFrame([(0, *r, r[4] - r[3]) for r in rows], EVENT)


def windows(spark, *rows):
    return spark.createDataFrame([(0, *r) for r in rows], "run_id int, w0 double, w1 double")


@pytest.mark.parametrize(("seen", "value", "tier"), [([(0.0, 3600.0)], 50.0, "EXACT"), ([(0.0, 1800.0)], 100.0, "EXACT"), ([(5.0, 5.0)], None, "UNKNOWN")])
def test_desk_coverage_divides_by_observed_time(spark, seen, value, tier):
    e = events(spark, ("1", "staff", "desk", 0.0, 1800.0))
    r = A.desk_coverage(e, ("desk",), windows(spark, *seen)).first()
    assert (r["value"], r["tier"]) == (value, tier)


def test_desk_gaps_count_waiting_episodes(spark):
    e = events(spark, ("1", "staff", "desk", 0.0, 100.0), ("1", "staff", "desk", 300.0, 400.0), ("2", "customer", "wait", 150.0, 160.0), ("3", "customer", "wait", 155.0, 170.0), ("4", "customer", "wait", 200.0, 210.0))
    rows = A.desk_gaps(e, ("desk",), ("wait",), windows(spark, (0.0, 400.0))).collect()
    assert [(r["t_in"], r["t_out"], r["guests_waiting"]) for r in rows] == [(100.0, 300.0, 2)]


def test_leave_and_return_is_one_person_with_two_visits(spark):
    rows = [(0, "7", "customer", d, "door", 0.0, 0.0, t) for d, t in (("in", 1.0), ("out", 5.0), ("in", 9.0), ("out", 12.0))] + [(0, "8", "customer", "out", "door", 0.0, 0.0, 3.0)]
    v = A.visits(spark.createDataFrame(rows, C._COLUMNS))
    r = A.visit_counts(v).first()
    assert (r["unique_people"], r["n_visits"], r["repeat_visitors"], r["closed"], r["entry_missed"], r["median_s"]) == (2, 3, 1, 2, 1, 3.5)


def test_greeting_after_arrival_only(spark):
    a = spark.createDataFrame([(0, "1", 10.0), (0, "2", 10.0)], "run_id int, track_id string, t double")
    c = spark.createDataFrame([(0, "1", 5.0), (0, "1", 14.0), (0, "2", 9.0)], "run_id int, track_id string, t double")
    r = A.greet_latency(a, c).first()
    assert (r["guests"], r["greeted"], r["median_s"]) == (2, 1, 4.0)


def test_merge_is_idempotent_and_gap_inclusive(spark):
    random.seed(2)
    rows = [(0, a := random.randint(0, 300) / 4, a + random.randint(0, 20) / 4) for _ in range(80)]
    df = spark.createDataFrame(rows, "run_id int, t_in double, t_out double")
    once = merge(df, ["run_id"], gap=1.0)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merge(once, ["run_id"], gap=1.0).collect()))
    pair = spark.createDataFrame([(0, 0.0, 1.0), (0, 2.0, 3.0), (0, 4.25, 5.0), (0, None, 1.0)], "run_id int, t_in double, t_out double")
    assert sorted((r["t_in"], r["t_out"]) for r in merge(pair, ["run_id"], gap=1.0).collect()) == [(0.0, 3.0), (4.25, 5.0)]


def test_intervals_and_complement_fill_the_window(spark):
    random.seed(3)
    rows = [(r, a := random.randint(0, 400) / 4, a + random.randint(1, 40) / 4) for r in range(4) for _ in range(random.randint(0, 9))]
    df = spark.createDataFrame(rows, "run_id int, t_in double, t_out double")
    w = spark.createDataFrame([(r, 10.0, 80.0) for r in range(4)], "run_id int, w0 double, w1 double")
    merged = merge(df, ["run_id"])
    free = {r["run_id"]: r["s"] for r in complement(merged, w, ["run_id"]).groupBy("run_id").agg(F.sum(F.col("t_out") - F.col("t_in")).alias("s")).collect()}
    for run in range(4):
        used = sum(max(0.0, min(r["t_out"], 80.0) - max(r["t_in"], 10.0)) for r in merged.collect() if r["run_id"] == run)
        assert abs(used + free.get(run, 0.0) - 70.0) < 1e-9


def test_range_join_against_all_pairs(spark):
    random.seed(4)
    p = [(0, random.random() * 100) for _ in range(60)]
    w = [(0, a := random.random() * 100, a + random.random() * 30) for _ in range(20)]
    got = range_join(spark.createDataFrame(p, "k int, t double"), spark.createDataFrame(w, "k int, a double, b double"), ["k"], "t", "a", "b", 7.0)
    assert got.count() == sum(a <= t <= b for _, t in p for _, a, b in w)


def test_components(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(90)] + [(5, None), (7, 7)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_confirmed_crossings_consume_pairs(spark):
    rows = [(0, "1", "customer", d, "door", 0.0, 0.0, t) for d, t in (("in", 0.0), ("out", 3.0), ("in", 6.0), ("out", 20.0))]
    got = C.confirmed(spark.createDataFrame(rows, C._COLUMNS)).collect()
    assert sorted(r["t"] for r in got) == [6.0, 20.0]


def test_a_dropped_crossing_does_not_prolong_the_window(spark):
    rows = [(0, str(i), "customer", "in", "door", 0.0, 0.0, t) for i, t in enumerate((0.0, 2.0, 4.0, 10.0))] + [(0, "9", "staff", "in", "door", 0.0, 0.0, 30.0)]
    got = C.deduplicated(spark.createDataFrame(rows, C._COLUMNS).repartition(3)).collect()
    assert sorted(r["t"] for r in got) == [0.0, 4.0, 10.0]


def test_dense_crossings_are_deduplicated_as_in_one_pass(spark):
    """No pause of 2.5 s anywhere; some have no place or no span, some rows repeat. Against a loop over whole runs."""
    rng = np.random.default_rng(5)
    rows, spans = [], []
    for run in range(3):
        for i in range(400):
            x, y = (None, None) if rng.random() < 0.1 else (float(rng.integers(0, 900)), float(rng.integers(0, 500)))
            rows.append((run, f"t{rng.integers(60)}", "customer", "in", "door", x, y, float(rng.integers(0, 400)) * 0.25))
        spans += [(run, f"t{k}", float(k), float(k) + 3 * rng.random()) for k in range(50)]
    rows += [*rows[:40], (0, "t1", None, "in", "door", 5.0, 5.0, None)]
    where = {(r, k): (a, b) for r, k, a, b in spans}

    def together(r, j, k):
        a, b = where.get((r, j)), where.get((r, k))
        return a is not None and b is not None and min(a[1], b[1]) - max(a[0], b[0]) > 0.4

    want = [r for r in rows if r[7] is None]
    for run in range(3):
        kept = []
        for r in sorted((r for r in rows if r[0] == run and r[7] is not None), key=lambda r: (r[7], r[1], r[4], math.inf if r[5] is None else r[5], math.inf if r[6] is None else r[6])):
            near = (k for k in kept if r[7] - k[7] <= 2.5)
            if not any(r[1] == k[1] if r[5] is None or k[5] is None else (r[5] - k[5]) ** 2 + (r[6] - k[6]) ** 2 <= 140**2 and not together(run, r[1], k[1]) for k in near):
                kept.append(r)
        want += kept
    assert len(want) < len(rows) - 100
    for folded in (0, 405, C.FOLDED):  # all by components, one run whole, all whole
        got = C.deduplicated(spark.createDataFrame(rows, C._COLUMNS).repartition(5), spans=spark.createDataFrame(spans, "run_id int, track_id string, t0 double, t1 double"), folded=folded).collect()
        assert Counter(map(tuple, got)) == Counter(want)
    assert C.deduplicated(spark.createDataFrame([], C._COLUMNS)).count() == 0


def test_point_in_polygon_and_iou(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    df = spark.createDataFrame([(5.0, 5.0), (11.0, 5.0), (-1.0, -1.0)], "x double, y double")
    assert [r[0] for r in df.select(G.inside(F.col("x"), F.col("y"), square)).collect()] == [True, False, False]
    b = lambda *v: tuple(F.lit(float(x)) for x in v)
    got = spark.range(1).select(G.iou(b(0, 0, 2, 2), b(0, 0, 2, 2)), F.round(G.iou(b(0, 0, 2, 2), b(1, 0, 3, 2)), 6), G.iou(b(0, 0, 1, 1), b(5, 5, 6, 6)), G.iou(b(0, 0, 0, 0), b(0, 0, 0, 0))).first()
    assert tuple(got) == (1.0, 0.333333, 0.0, 0.0)


def test_size_filter_keeps_what_it_cannot_judge(spark):
    plane = G.Plane(a=0.2, b=-100.0, width=1920.0)
    rows = [(0.0, 0.0, 500.0, 400.0), (0.0, 740.0, 20.0, 800.0), (0.0, 300.0, 900.0, 800.0)]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    assert [r[0] for r in df.select(D.implausible(plane)).collect()] == [False, False, True]


def test_assignment_is_optimal():
    rng = np.random.default_rng(0)
    for n, m in itertools.product(range(1, 5), range(1, 6)):
        s = rng.random((n, m))
        a, b = S.assignment(s)
        small, large = (n, m) if n <= m else (m, n)
        t = s if n <= m else s.T
        best = max(sum(t[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert len(a) == small and abs(s[a, b].sum() - best) < 1e-9


BOX = "run_id int, frame_idx int, track_id string, x1 double, y1 double, x2 double, y2 double"


def test_perfect_tracker_and_identity_swap(spark):
    gt = [(0, f, k, x, 0.0, x + 10.0, 20.0) for f in range(20) for k, x in (("a", 0.0), ("b", 100.0))]
    swap = {"a": "b", "b": "a"}
    pr = [(r, f, swap[k] if f >= 10 else k, *rest) for r, f, k, *rest in gt]
    truth, found = spark.createDataFrame(gt, BOX), spark.createDataFrame(pr, BOX)
    assert tuple(S.hota(truth, truth).first())[1:] == (1.0, 1.0, 1.0)
    h = S.hota(truth, found).first()
    assert abs(h["assa"] - 1 / 3) < 1e-6 and abs(h["hota"] - 3**-0.5) < 1e-6
    m = S.mota(truth, found).first()
    assert (m["fn"], m["fp"], m["idsw"]) == (0, 0, 2)


def test_groups_never_hold_two_people_seen_at_once(spark):
    random.seed(6)
    t = [(0, str(i), random.choice(["staff", "customer"]), float(s := random.randint(0, 200)), float(s + random.randint(3, 40))) for i in range(60)]
    e = [(0, a, b, random.random(), "gallery") for a, b in {(str(random.randrange(60)), str(random.randrange(60))) for _ in range(300)} if a != b]
    tracks, edges = spark.createDataFrame(t, "run_id int, track_id string, role string, t_first double, t_last double"), spark.createDataFrame(e, "run_id int, a string, b string, score double, tier string")
    canon = {r["track_id"]: r["canon"] for r in I.constrained_groups(tracks, edges).collect()}
    assert canon == {r["track_id"]: r["canon"] for r in I.constrained_groups(tracks.repartition(5), edges.repartition(7)).collect()}
    for x, y in itertools.combinations(t, 2):
        if canon[x[1]] == canon[y[1]]:
            assert x[2] == y[2] and not (x[3] < y[4] - 2.0 and y[3] < x[4] - 2.0)
    assert len(set(canon.values())) < 60


def test_suppression_keeps_the_surest(spark):
    rows = [(0, 0, "a", 0.0, 0.0, 10.0, 10.0, 0.9), (0, 0, "b", 1.0, 0.0, 11.0, 10.0, 0.8), (0, 0, "c", 50.0, 0.0, 60.0, 10.0, 0.1)]
    got = D.suppressed(spark.createDataFrame(rows, BOX + ", conf double"), 0.5).collect()
    assert sorted(r["track_id"] for r in got) == ["a", "c"]


def test_global_links_take_the_best_total(spark):
    t = spark.createDataFrame([(0, k) for k in "abcd"], "run_id int, track_id string")
    # Greedy would take a-c (0.95) and leave b-d (0.3) as too weak; together a-d and b-c are better.
    p = spark.createDataFrame([(0, "a", "c", 0.0, 0.95), (0, "a", "d", 0.0, 0.90), (0, "b", "c", 0.0, 0.90), (0, "b", "d", 0.0, 0.30)], "run_id int, a string, b string, gap double, sim double")
    assert sorted((r["a"], r["b"]) for r in I.global_links(t, p).collect()) == [("a", "d"), ("b", "c")]


def test_identities_reach_over_more_than_a_minute(spark):
    from atrium.plans.registry import QUERIES
    from atrium.plans.identity import tracks

    sf = "/root/testdata/sf0.001"
    t = {(r["run_id"], r["track_id"]): (r["t_first"], r["t_last"]) for r in tracks(spark, sf).collect()}
    waits = []
    for r in QUERIES["k20_dossiers"](spark, sf).collect():
        seen = sorted(t[r["run_id"], k] for k in r["members"].split(","))
        waits += [y[0] - x[1] for x, y in zip(seen, seen[1:])]
    assert 60 < max(waits) <= 480
    assert max(t[r["run_id"], r["b"]][0] - t[r["run_id"], r["a"]][1] for r in QUERIES["e22_global_links"](spark, sf).collect()) > 60


def test_greedy_matches_use_each_box_once(spark):
    left = spark.createDataFrame([(0, 0, "a", 0.0, 0.0, 10.0, 10.0), (0, 0, "b", 2.0, 0.0, 12.0, 10.0), (0, 1, "a", 0.0, 0.0, 1.0, 1.0)], BOX)
    right = spark.createDataFrame([(0, 0, "x", 1.0, 0.0, 11.0, 10.0), (0, 0, "y", 2.5, 0.0, 12.5, 10.0), (0, 1, "z", 0.0, 0.0, 1.0, 1.0)], BOX)
    got = sorted((r["frame_idx"], r["track_id"], r["o_track_id"]) for r in D.greedy_matches(left, right).collect())
    assert got == [(0, "a", "x"), (0, "b", "y"), (1, "a", "z")]


def test_debouncing(spark):
    rows = [(0, "1", "customer", d, "door", x, 0.0, t) for d, t, x in (("in", 0.0, 0.0), ("out", 2.0, 10.0), ("in", 10.0, 0.0), ("in", 10.5, 5.0), ("out", 12.0, 300.0))]
    got = C.debounced(spark.createDataFrame(rows, C._COLUMNS)).collect()
    assert sorted(r["t"] for r in got) == [10.0, 12.0]


@pytest.mark.parametrize("known", ["a", "b"])
def test_door_tracks_without_a_span_are_never_together(spark, known):
    """Two crossings of one door within a second; of the two tracks only one has a span."""
    rows = [(0, k, "customer", "in", "side door", 100.0, 0.0, t) for k, t in (("a", 1.0), ("b", 2.0))]
    crossings = spark.createDataFrame(rows, "run_id int, track_id string, role string, direction string, line string, x double, y double, t double")
    spans = spark.createDataFrame([(0, known, 0.0, 50.0)], "run_id int, track_id string, t0 double, t1 double")
    assert [r["track_id"] for r in C.door_deduplicated(crossings, spans).collect()] == ["a"]
    both = spans.union(spans.withColumn("track_id", F.lit("b" if known == "a" else "a")))
    assert sorted(r["track_id"] for r in C.door_deduplicated(crossings, both).collect()) == ["a", "b"]


def test_the_way_back_through_a_fisheye_beyond_its_turning_point(spark):
    """Points before the turning point, beyond it and past the centre; without a fold, those beyond are held at the turning point."""
    points = [(960.0 + a * math.cos(w), 540.0 + a * math.sin(w)) for a in (0.0, 10.0, 1000.0, 2247.0, 2250.0, 3000.0, 3890.0, 3900.0, 9000.0, 90000.0) for w in (0.3, 2.0, 4.5)]
    d = spark.createDataFrame(points, "x double, y double")
    sx, sy = G.fisheye_to_source(F.col("x"), F.col("y"), -0.08, 1920.0, 1080.0)
    d = d.withColumn("sx", sx).withColumn("sy", sy).withColumn("fold", G.fisheye_fold(F.col("x"), F.col("y"), -0.08, 1920.0, 1080.0))
    rx, ry = G.fisheye_to_rectified(F.col("sx"), F.col("sy"), -0.08, 1920.0, 1080.0, fold=F.col("fold"))
    hx, hy = G.fisheye_to_rectified(F.col("sx"), F.col("sy"), -0.08, 1920.0, 1080.0)
    for r in d.select("x", "y", "fold", rx.alias("rx"), ry.alias("ry"), F.hypot(hx - 960, hy - 540).alias("held")).collect():
        assert abs(r["rx"] - r["x"]) < 1e-4 and abs(r["ry"] - r["y"]) < 1e-4, r
        assert r["held"] < 2249.0
    assert {r["fold"] for r in d.collect()} == {0, 1, 2}


def test_what_a_tracker_does_not_see_meets_no_truth_in_a_wide_frame(spark, tmp_path):
    """Users 7 and 5007 stand 5,000 pixels apart in the same frames."""
    from atrium.plans.registry import ORACLE_SQL, QUERIES
    from tests import oracle

    rows = [(i, u, "view", 1.0, '{"k": 5}') for i, u in ((0, 7), (1, 5007), (5, 7), (6, 5007), (15, 7), (16, 5007))]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").coalesce(1).toPandas().to_parquet(f"{tmp_path}/events.parquet")
    q = "g43_scores_by_condition"
    assert oracle.difference(spark, oracle.connect(str(tmp_path)), QUERIES[q], ORACLE_SQL[q], str(tmp_path)) == ""
