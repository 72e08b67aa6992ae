"""Settings trees, digest trees and the grid of polygons against plain Python."""

import json
import random

from pyspark.sql import functions as F

from atrium.operators import hashtree, polygons, trees


def leaves(v, path=""):
    if isinstance(v, dict):
        for k, x in v.items():
            yield from leaves(x, f"{path}.{k}" if path else k)
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from leaves(x, f"{path}[{i}]")
    else:
        kind = "null" if v is None else "flag" if isinstance(v, bool) else "text" if isinstance(v, str) else "number"
        yield path, kind, None if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def tree(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice([1, 2.5, True, None, "x", "", "é.ü"])
    if rng.random() < 0.5:
        return {f"k{i}": tree(rng, depth - 1) for i in range(rng.randint(0, 3))}
    return [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]


def test_flattened_trees_of_any_shape(spark):
    rng = random.Random(2)
    docs = [{"a": tree(rng, 5), "b": tree(rng, 2)} for _ in range(80)]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(900, None), (901, "{bad"), (902, "{}"), (903, "7")]
    got = trees.flattened(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()
    want = [(i, *leaf) for i, d in enumerate(docs) for leaf in leaves(d)] + [(903, "", "number", "7")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_indented_lines_know_their_parents(spark):
    text = "a:\n  b: 1\n    c: 2\n  # no: comment\n\nd:\n      e: 3\n  f: 4\ng: 5\n  a: 6\nno colon"
    got = trees.indented(spark.createDataFrame([(0, text), (1, None), (2, "")], "id int, t string"), "id", "t")
    assert [(r.line, r.path, r.value) for r in got.orderBy("line").collect()] == [(0, "a", None), (1, "a.b", "1"), (2, "a.b.c", "2"), (5, "d", None), (6, "d.e", "3"), (7, "d.f", "4"), (8, "g", "5"), (9, "g.a", "6")]


def test_later_layers_win_and_problems_are_named(spark):
    one = lambda *rows: spark.createDataFrame([(0, *r) for r in rows], "id int, path string, kind string, value string")
    got = trees.resolved([one(("a", "number", "1"), ("b", "text", "x")), one(("a", "null", None)), one(("b", "number", "7"), ("c", "text", "y"))], "id")
    rows = {r.path: (r.kind, r.value, r.layer) for r in got.collect()}
    assert rows == {"a": ("null", None, 1), "b": ("number", "7", 2), "c": ("text", "y", 2)}
    bad = trees.problems(got, {"b": (8.0, 9.0), "c": (0.0, 1.0)}, {"a": ("z",)}).collect()
    assert {r.path: r.problem for r in bad} == {"b": "outside 8 to 9", "c": "outside 0 to 1"}


def test_digests_don_t_depend_on_partitions_and_name_what_changed(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") * 7).cast("string").alias("c"))
    make = lambda df: hashtree.tree(df, F.col("k"), F.col("c"), 2)
    root = lambda t: t.where("level = 0").first().digest
    mine = make(rows.repartition(7))
    assert root(mine) == root(make(rows.coalesce(1).orderBy(F.desc("k")))) != root(make(rows.limit(499)))
    assert hashtree.differences(mine, make(rows)).count() == 0
    other = make(rows.withColumn("c", F.when(F.col("k") == "77", "new").otherwise(F.col("c"))))
    leaf = rows.where("k = '77'").select(F.substring(F.sha2("k", 256), 1, 2)).first()[0]
    assert {(r.level, r.id) for r in hashtree.differences(mine, other).collect()} == {(0, ""), (1, leaf[0]), (2, leaf)}
    assert root(make(rows.union(rows.limit(1)))) != root(mine)
    assert make(rows.limit(0)).count() == 0


def test_polygons_by_cells(spark):
    rng = random.Random(4)
    zones = []
    for i in range(120):
        cx, cy, n = rng.uniform(-200, 800), rng.uniform(-200, 800), rng.randint(3, 7)
        corners = [(cx + rng.uniform(-150, 150), cy + rng.uniform(-150, 150)) for _ in range(n)]  # sides may cross
        zones.append((i, [float(x) for x, _ in corners], [float(y) for _, y in corners]))
    zones += [(500, [0.0, 1.0], [0.0, 1.0]), (501, None, None), (502, [], [])]
    points = [(i, rng.uniform(-300, 900), rng.uniform(-300, 900)) for i in range(800)] + [(900, None, 1.0)]

    def inside(x, y, xs, ys):
        hit = False
        for i in range(len(xs)):
            j = (i + 1) % len(xs)
            if (ys[i] > y) != (ys[j] > y) and x < (xs[j] - xs[i]) * (y - ys[i]) / (ys[j] - ys[i]) + xs[i]:
                hit = not hit
        return hit

    want = {(p, z) for p, x, y in points if x is not None for z, xs, ys in zones if xs and len(xs) > 2 and inside(x, y, xs, ys)}
    pts, zs = spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(zones, "polygon int, xs array<double>, ys array<double>")
    found = polygons.containing(pts, zs, 64.0)
    assert {(r.id, r.polygon) for r in found.collect()} == want and found.count() == len(want) > 500
    assert polygons.cells(zs, 64.0).where("full").count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_equal_outlines_and_places_are_tested_once(spark, monkeypatch):
    """2,500 points at three places and 90 zones of three outlines: 9 tests of 225,000, and every point and zone in the result."""
    monkeypatch.setattr(polygons, "ALIKE", 1_000)
    outlines = [([0.0, 40.0, 40.0, 0.0], [0.0, 0.0, 40.0, 40.0]), ([10.0, 60.0, 10.0], [10.0, 10.0, 60.0]), ([-9.0, -1.0, -5.0], [-9.0, -9.0, -1.0])]
    zones = spark.createDataFrame([(i, *outlines[i % 3]) for i in range(90)], "polygon long, xs array<double>, ys array<double>")
    places = [(20.0, 20.0), (50.0, 12.0), (500.0, 1.0)]
    points = spark.createDataFrame([(i, *places[i % 3]) for i in range(2500)], "id int, x double, y double")
    found = polygons.containing(points, zones, 64.0)
    holds = {0: {0, 1}, 1: {1}, 2: set()}
    want = {(i, z) for i in range(2500) for z in range(90) if z % 3 in holds[i % 3]}
    got = [(r.id, r.polygon) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    monkeypatch.setattr(polygons, "ALIKE", 7)
    assert sorted((r.id, r.polygon) for r in polygons.containing(points, zones, 64.0).collect()) == sorted(want)
    pairs = polygons.corners_within(zones, zones.where("polygon % 2 = 0"), 64.0)
    want = {(a, b): n for a in range(90) for b in range(0, 90, 2) if a != b and (n := sum(inside(x, y, *outlines[b % 3]) for x, y in zip(*outlines[a % 3])))}
    rows = pairs.collect()
    assert {(r.polygon, r.mask): r.corners for r in rows} == want and len(rows) == len(want) > 500
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(_points") < plan.index("Join Inner")  # the plan prints from the top: points are told apart after the join


def inside(x, y, xs, ys):
    hit = False
    for i in range(len(xs)):
        j = (i + 1) % len(xs)
        if (ys[i] > y) != (ys[j] > y) and x < (xs[j] - xs[i]) * (y - ys[i]) / (ys[j] - ys[i]) + xs[i]:
            hit = not hit
    return hit
