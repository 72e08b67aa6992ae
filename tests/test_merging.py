"""Rounds of dominant edges against the fold, sparse assignment against all matchings, and whose faces are compared."""

import itertools
import random
import time
import tracemalloc

import pytest

from atrium.operators import evidence as V
from atrium.operators.scoring import sparse_assignment
from atrium.plans import merging as M

SF = "/root/testdata/sf0.001"


def test_rounds_are_the_fold(spark):
    rng = random.Random(3)
    tracks = [(r, f"t{i}", t := rng.uniform(0, 300), t + rng.uniform(1, 40)) for r in range(2) for i in range(60)]
    pairs = {(r, *rng.sample(range(60), 2), rng.choice("xy")) for r in range(2) for _ in range(150)}
    edges = [(r, f"t{a}", f"t{b}", tier, rng.choice([0.5, 0.6, rng.random()])) for r, a, b, tier in pairs]
    t = spark.createDataFrame(tracks, "run_id int, track_id string, t_first double, t_last double")
    e = spark.createDataFrame(edges, "run_id int, a string, b string, tier string, score double")
    (one, ids), (other, same) = V.replay(t, e), V.replay(t, e, folded=0)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert sorted(map(tuple, ids.collect())) == sorted(map(tuple, same.collect()))
    assert {r.accepted for r in one.collect()} == {True, False, None}


def test_no_edges(spark):
    t = spark.createDataFrame([(0, "a", 0.0, 1.0)], "run_id int, track_id string, t_first double, t_last double")
    e = spark.createDataFrame([], "run_id int, a string, b string, tier string, score double")
    done, ids = V.replay(t, e, folded=0)
    assert done.count() == 0 and [tuple(r) for r in ids.collect()] == [(0, "a", "a")]


def test_overlaps():
    rng = random.Random(1)
    some = lambda: [(a := rng.uniform(0, 50), a + rng.uniform(0, 9)) for _ in range(rng.randint(1, 6))]
    for _ in range(500):
        x, y = some(), some()
        assert V.overlap(x, y, 2.0) == any(p < s - 2.0 and q < o - 2.0 for p, o in x for q, s in y)


def best(rows, columns, gain):
    g = dict(zip(zip(rows, columns, strict=True), gain, strict=True))
    n, m = max(rows) + 1, max(columns) + 1
    return max(sum(g.get((r, c), 0.0) for r, c in enumerate(p[:n])) for p in itertools.permutations([*range(m), *[-1] * n], n))


@pytest.mark.parametrize("seed", range(40))
def test_sparse_assignment_is_the_best_matching(seed):
    rng = random.Random(seed)
    pairs = sorted({(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randint(1, 12))})
    gain = [rng.choice([0.25, 0.5, rng.random()]) + 0.01 for _ in pairs]
    rows, columns = zip(*pairs, strict=True)
    found = sparse_assignment(rows, columns, gain)
    g = dict(zip(pairs, gain, strict=True))
    assert len({r for r, _ in found}) == len({c for _, c in found}) == len(found)
    assert sum(g[p] for p in found) == pytest.approx(best(rows, columns, gain))


def test_a_component_of_ten_thousand_fits_in_memory():
    rng = random.Random(0)
    pairs = sorted({(i, j) for i in range(10_000) for j in (i, (i + 1) % 10_000, rng.randrange(10_000))})
    tracemalloc.start()
    began = time.time()
    found = sparse_assignment(*zip(*pairs, strict=True), [rng.random() + 0.01 for _ in pairs])
    assert tracemalloc.get_traced_memory()[1] < 60e6  # the matrix would have 200 million numbers
    tracemalloc.stop()
    assert len(found) > 9_000 and time.time() - began < 120


def test_a_guests_face_is_never_compared(spark):
    t = M.tracks(spark, SF).persist()
    guests = {(r.run_id, r.track_id) for r in t.where("role <> 'staff'").select("run_id", "track_id").collect()}
    seen = [tuple(r) for r in V.pairs(t).where("face is not null").select("run_id", "a", "b").collect()]
    assert seen and not any((r, x) in guests for r, a, b in seen for x in (a, b))
    joined = V.tiers(V.pairs(t)).where("tier = 'face'").collect()
    assert not any((r.run_id, x) in guests for r in joined for x in (r.a, r.b))
    assert V.pairs(t, face_scope="all").where("face is not null").count() > len(seen)
    named = t.withColumn("enrolled", M.F.col("role") != "staff")
    assert V.pairs(named).where("face is not null").count() == V.pairs(t, face_scope="all").where("face is not null").count()
    with pytest.raises(ValueError):
        V.eligible_faces(t, "some")
