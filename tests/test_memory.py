"""The memory against a plain version that scans everything it has ever seen, case by case and on whole tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from atrium.operators.memory import Memory, live_identities, live_identity_stream
from atrium.plans.scenes import detections, traded
from atrium.streaming.occupancy import keyed_state, to_table

A, B, C = np.array([1.0, 0, 0]), np.array([0, 1.0, 0]), np.array([0, 0, 1.0])


def cosine(a, b):
    dot, na, nb = (sum(x * y for x, y in zip(p, q, strict=True)) for p, q in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(na * nb) if na > 0 and nb > 0 else 0.0


def plain(rows, ttl=1800.0):
    """rows: run_id, t, raw, x, y, score, frozen, vec, of any order. One list of people a run; nothing is indexed or removed."""
    out = []
    for run in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == run), key=lambda r: (r[1], r[2]))
        people, name, since = {}, {}, {}

        def alive(who, now, people=people):
            return who in people and now - people[who]["t"] <= ttl

        for now in sorted({r[1] for r in own}):
            frame = [r for r in own if r[1] == now]
            parted, partner = set(), {}
            for who in {name[r[2]] for r in frame if r[2] in name}:
                claim = sorted((since[r[2]], r[2]) for r in frame if name.get(r[2]) == who)
                for _, raw in claim[1:]:
                    parted.add(raw)
            for raw in parted:
                name[raw], since[raw] = raw, now
            freed = [r for r in frame if not r[6] and r[2] in name and alive(name[r[2]], now) and people[name[r[2]]]["frozen"]]
            for i in range(len(freed)):
                for j in range(i + 1, len(freed)):
                    a, b = freed[i], freed[j]
                    if a[7] is None or b[7] is None or name[a[2]] == name[b[2]] or not alive(name[a[2]], now) or not alive(name[b[2]], now):
                        continue
                    pa, pb = people[name[a[2]]]["vec"], people[name[b[2]]]["vec"]
                    if pa is not None and pb is not None and cosine(a[7], pb) - cosine(a[7], pa) > 0.1 and cosine(b[7], pa) - cosine(b[7], pb) > 0.1:
                        name[a[2]], name[b[2]] = name[b[2]], name[a[2]]
                        partner[a[2]], partner[b[2]] = b[2], a[2]
            for _, _, raw, x, y, score, frozen, vec in frame:
                how = "known"
                if raw not in name:
                    visible = {name[r[2]] for r in frame if r[2] in name}
                    found = []
                    for who, p in people.items():
                        away, gap = math.hypot(x - p["x"], y - p["y"]), now - p["t"]
                        if frozen or vec is None or not alive(who, now) or p["vec"] is None or who in visible or away > 260:
                            continue
                        fine = min(0.3, 0.15 * max(0.0, away - 220 * gap) / (220 * gap)) if gap > 0 else 0.0
                        found.append((cosine(vec, p["vec"]) - fine - 0.09 * min(max((gap - 15) / 165, 0), 1), who))
                    found.sort(reverse=True)
                    good = bool(found) and found[0][0] >= 0.32 and not (len(found) > 1 and found[1][0] > 0 and found[1][0] / found[0][0] > 0.9)
                    name[raw], since[raw] = found[0][1] if good else raw, now
                    how = "frozen" if frozen else "matched" if good else "new"
                who = name[raw]
                p = people[who] if alive(who, now) else None
                crop = not frozen and vec is not None and (p is None or score >= p["best"])
                if crop:
                    p = {"vec": vec, "best": score}
                elif p is None:
                    p = {"vec": None, "best": -1.0 if frozen else score}
                people[who] = {"vec": p["vec"], "best": p["best"], "x": x, "y": y, "t": now, "frozen": frozen}
                out.append((run, now, raw, who, how, crop, partner.get(raw), raw in parted))
    return out


def canons(decisions):
    return [d.canon for d in decisions]


def one(m, raw, vec, x, y, now, score=1, frozen=False):
    return m.frame(now, [(raw, vec, x, y, score, frozen)])[0].canon


def test_matches_what_was_seen_nearby_and_lately():
    m = Memory(ttl=100)
    assert one(m, "1", A, 0, 0, 0.0) == "1"
    assert one(m, "2", A, 10, 0, 5.0) == "1"  # same person, new track
    assert one(m, "3", A, 900, 0, 6.0) == "3"  # too far away
    assert one(m, "4", B, 10, 0, 7.0) == "4"  # looks different
    assert canons(m.frame(8.0, [("2", A, 10, 0, 1, False), ("5", A, 10, 0, 1, False)])) == ["1", "5"]  # visible elsewhere
    assert one(m, "6", None, 10, 0, 9.0) == "6"  # nothing to compare
    assert one(m, "7", A, 10, 0, 300.0) == "7"  # forgotten
    assert set(m.bank) == {"3", "7"}  # what nobody asked for costs nothing


def test_two_likely_matches_are_none():
    m = Memory()
    m.frame(0.0, [("1", A, 0, 0, 1, False), ("2", A + 0.01 * B, 0, 0, 1, False)])
    assert one(m, "3", A, 0, 0, 1.0) == "3"


def test_appearance_changes_for_better_crops_only():
    m = Memory()
    one(m, "1", A, 0, 0, 0.0, 5)
    one(m, "1", B, 1, 0, 1.0, 3)
    assert np.array_equal(m.bank["1"].vec, A) and m.bank["1"].x == 1
    one(m, "1", B, 2, 0, 2.0, 9)
    assert np.array_equal(m.bank["1"].vec, B)
    one(m, "1", C, 3, 0, 3.0, 99, frozen=True)
    assert np.array_equal(m.bank["1"].vec, B) and m.bank["1"].x == 3


def test_split_keeps_the_first():
    m = Memory()
    one(m, "1", A, 0, 0, 0.0)
    m.known["3"] = ("1", 9.0)
    assert m.split(["1", "3"], 10.0) == {"3"} and m.known["3"] == ("3", 10.0)


def test_frame_undoes_a_swap_after_an_overlap():
    m = Memory()
    m.frame(0.0, [("1", A, 0, 0, 1, False), ("2", B, 50, 0, 1, False)])
    m.frame(1.0, [("1", A, 20, 0, 1, True), ("2", B, 30, 0, 1, True)])
    assert [(d.canon, d.swapped) for d in m.frame(2.0, [("1", B, 40, 0, 1, False), ("2", A, 10, 0, 1, False)])] == [("2", "2"), ("1", "1")]


def test_untouched_identities_are_not_read():
    class Counted(dict):
        reads = 0

        def get(self, k, d=None):
            Counted.reads += 1
            return super().get(k, d)

    m = Memory(bank=Counted())
    for i in range(500):
        one(m, str(i), A, 1000.0 * i, 0, float(i))
    Counted.reads = 0
    one(m, "new", A, 0, 0, 600.0)
    assert Counted.reads < 5


def reborn(spark, sf):
    return detections(spark, sf, gap=0.8)


@pytest.mark.parametrize("view", [reborn, traded])
def test_whole_table_is_the_plain_version(spark, view):
    d = view(spark, "/root/testdata/sf0.001").persist()
    rows = [tuple(r) for r in d.select("run_id", "t", "raw", "x", "y", "score", "frozen", "vec").collect()]
    how = set()
    for ttl in (1800.0, 5.0):
        got = sorted((tuple(r) for r in live_identities(d, ttl=ttl).collect()), key=repr)
        assert got == sorted(plain(rows, ttl), key=repr)
        how |= {r[4] for r in got}
    assert how >= {"known", "new", "frozen"} and len(got) > 100
    assert "matched" in how if view is reborn else any(r[6] for r in got)


def test_stream_is_the_batch(spark, tmp_path):
    d = traded(spark, "/root/testdata/sf0.001").where("t < 25").persist()
    want = sorted(map(repr, live_identities(d).collect()))
    ts = F.timestamp_micros((F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + F.col("t") * 1_000_000).cast("long"))
    rows = d.withColumn("ts", ts)
    with keyed_state(spark):
        for k in range(3):  # three arrivals, three runs of the stream over one checkpoint
            rows.where(F.floor(F.col("t") / 9) == k).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
            out = to_table(live_identity_stream(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert sorted(map(repr, out.collect())) == want
    assert len(want) > 100


def test_a_match_reads_no_single_entry_of_a_crowded_place():
    class Counted(dict):
        reads = 0

        def get(self, k, d=None):
            Counted.reads += 1
            return super().get(k, d)

    m = Memory(bank=Counted())
    for i in range(500):
        one(m, str(i), None if i % 3 else B, 10.0, 10.0, 0.1 * i)
    one(m, "like", A, 20.0, 10.0, 60.0)
    Counted.reads = 0
    assert one(m, "new", A, 10.0, 10.0, 61.0) == "like"
    assert Counted.reads < 5


def test_columns_of_a_place_follow_what_leaves_grows_and_is_forgotten():
    """Vectors of two lengths, identities that move to another cell and back, and some that are forgotten, against the plain version."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        shown = [rng.normal(size=3 if k % 4 else 2) for k in range(3)]
        for k in range(3):
            rows.append((0, i * 0.7, f"{int(rng.integers(60))}.{k}.{i // 40}", float(rng.choice([100, 250, 270, 600])), float(rng.choice([100, 500])), float(rng.random()), bool(rng.random() < 0.2), None if rng.random() < 0.1 else list(np.round(shown[k], 1))))
    for ttl in (1800.0, 30.0):
        m, got = Memory(ttl=ttl), []
        for now in sorted({r[1] for r in rows}):
            frame = sorted((r for r in rows if r[1] == now), key=lambda r: r[2])
            unit = [None if r[7] is None else np.array(r[7]) / np.linalg.norm(r[7]) if any(r[7]) else np.array(r[7]) for r in frame]
            got += [(0, now, r[2], *d) for r, d in zip(frame, m.frame(now, [(r[2], v, r[3], r[4], r[5], r[6]) for r, v in zip(frame, unit, strict=True)]), strict=True)]
        assert [g[:5] for g in sorted(got, key=repr)] == [w[:5] for w in sorted(plain_by_length(rows, ttl), key=repr)]
        assert {"known", "matched", "new", "frozen"} <= {g[4] for g in got}


def plain_by_length(rows, ttl):
    """The plain version, in which vectors of other lengths are like nothing: a shorter one gets a place of its own."""
    return plain([(*r[:7], None if r[7] is None else [*r[7], 0.0, 0.0] if len(r[7]) == 3 else [0.0, 0.0, 0.0, *r[7]]) for r in rows], ttl)


def test_memories_of_two_lengths_of_time_read_the_detections_once(spark):
    from atrium.operators.memory import identities_known
    from atrium.plans.registry import QUERIES

    d = reborn(spark, "/root/testdata/sf0.001").persist()
    got = {tuple(r) for r in identities_known(d, {"short": 5.0, "long": 1800.0}).collect()}
    n = lambda ttl: dict(live_identities(d, ttl=ttl).groupBy("run_id").agg(F.count_distinct("canon")).collect())
    short, long = n(5.0), n(1800.0)
    assert got == {(k, short[k], long[k]) for k in long} and any(short[k] != long[k] for k in long)
    plan = QUERIES["n5_forgotten_identities"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1
