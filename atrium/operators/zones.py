"""Zones and lines as rows: reading their configuration, anchors, distances and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions.geometry import inside_array

CONFIG = "polygons map<string,array<array<double>>>, entry_lines map<string,array<array<double>>>, entry_line array<array<double>>, frame_size array<double>, roles map<string,string>"
VERTICES = "array<struct<x:double,y:double>>"


def zone_config(texts: DataFrame, key: str, column: str, size: tuple[float, float]) -> tuple[DataFrame, DataFrame]:
    """Zones (key, zone, roles, vertices) and lines (key, line, x1, y1, x2, y2) of JSON configurations, for frames of this size.

    Coordinates are scaled from the configuration's frame_size; without one,
    from the largest coordinates if these lie outside the frame, else not at
    all; then cut to whole pixels. A lone entry_line is named `entry`; a role
    may be one string or a list. Lines without two points are left out.
    """
    c = texts.select(key, F.from_json(F.col(column), CONFIG).alias("c"))
    lone = F.when(F.col("c.entry_line").isNotNull(), F.create_map(F.lit("entry"), F.col("c.entry_line")))
    lines = F.when(F.size("c.entry_lines") > 0, F.col("c.entry_lines")).otherwise(lone)
    c = c.select(key, F.col("c.polygons").alias("polygons"), F.col("c.roles").alias("roles"), F.map_filter(F.coalesce(lines, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<array<double>>>"))), lambda _, v: F.size(v) == 2).alias("lines"), F.col("c.frame_size").alias("stated"))
    points = F.flatten(F.concat(F.map_values("polygons"), F.map_values("lines")))
    most = [F.array_max(F.transform(points, lambda p: F.get(p, F.lit(0)))), F.array_max(F.transform(points, lambda p: F.get(p, F.lit(1))))]
    beyond = (most[0] > size[0]) | (most[1] > size[1])
    scale = [F.coalesce(size[i] / F.get("stated", F.lit(i)), F.when(beyond, size[i] / most[i]), F.lit(1.0)) for i in (0, 1)]
    c = c.withColumn("sx", scale[0]).withColumn("sy", scale[1])
    pixel = lambda v, s: (v * F.col(s)).cast("int").cast("double")
    vertices = F.transform("points", lambda p: F.struct(pixel(F.get(p, F.lit(0)), "sx").alias("x"), pixel(F.get(p, F.lit(1)), "sy").alias("y")))
    role = F.try_element_at("roles", F.col("zone"))
    roles = F.coalesce(F.when(role.startswith("["), F.from_json(role, "array<string>")).otherwise(F.array(role)), F.array().cast("array<string>"))
    zones = c.select(key, "roles", "sx", "sy", F.explode("polygons").alias("zone", "points"))
    at = lambda i, j: pixel(F.get(F.get("points", F.lit(i)), F.lit(j)), ("sx", "sy")[j])
    lined = c.select(key, "sx", "sy", F.explode("lines").alias("line", "points"))
    return (
        zones.select(key, "zone", F.filter(roles, lambda r: r.isNotNull()).alias("roles"), vertices.alias("vertices")),
        lined.select(key, "line", at(0, 0).alias("x1"), at(0, 1).alias("y1"), at(1, 0).alias("x2"), at(1, 1).alias("y2")),
    )


def anchor(centre: Column) -> tuple[Column, Column]:
    """The point of a box that counts: its centre in staff zones, where a counter hides the feet, else the feet."""
    return (F.col("x1") + F.col("x2")) / 2, F.when(centre, (F.col("y1") + F.col("y2")) / 2).otherwise(F.col("y2"))


def _edges(vertices: Column) -> Column:
    after = F.concat(F.slice(vertices, 2, F.size(vertices)), F.slice(vertices, 1, 1))
    return F.zip_with(vertices, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def signed_distance(x: Column, y: Column, vertices: Column) -> Column:
    """Pixels to the nearest edge, negative outside."""

    def square(e):
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        along = (x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy
        t = F.least(F.greatest(along / F.greatest(dx * dx + dy * dy, F.lit(1e-12)), F.lit(0.0)), F.lit(1.0))
        px, py = x - (e["a"]["x"] + t * dx), y - (e["a"]["y"] + t * dy)
        return px * px + py * py

    d = F.sqrt(F.array_min(F.transform(_edges(vertices), square)))
    return F.when(inside_array(x, y, vertices), d).otherwise(-d)


def zone_and_confidence(boxes: DataFrame, zones: DataFrame, by: list[str], key: list[str], feet_visible: Column) -> DataFrame:
    """Per box (key) the zone in which its anchor lies deepest, and how sure that is: 0.5 on the edge, 1 from half a
    box width inside, halved where the feet are hidden; no zone and 0 outside of all. (D25)

    zones: by, zone, centre, vertices, few to each value of by. Ties go by name.
    A box meets its camera's zones as one array, so boxes are neither
    multiplied nor shuffled again.
    """
    listed = zones.groupBy(*by).agg(F.collect_list(F.struct("zone", "centre", "vertices")).alias("zs"))
    width = F.greatest(F.col("x2") - F.col("x1"), F.lit(1.0))

    def deep(z: Column) -> Column:
        x, y = anchor(z["centre"])
        d = signed_distance(x, y, z["vertices"])
        return F.struct((-F.round(d, 9)).alias("order"), z["zone"].alias("zone"), d.alias("d"))

    best = boxes.join(listed, by).select(*key, width.alias("width"), feet_visible.alias("feet"), F.array_min(F.transform("zs", deep)).alias("b"))
    sure = F.least(F.greatest(0.5 + F.col("b.d") / F.col("width"), F.lit(0.0)), F.lit(1.0)) * F.when(F.col("feet"), 1.0).otherwise(0.5)
    within = F.col("b.d") >= 0
    return best.select(*key, F.when(within, F.col("b.zone")).alias("zone"), F.when(within, F.round(sure, 3)).otherwise(0.0).alias("zone_conf"))


def crosses_itself(vertices: Column) -> Column:
    """Whether two edges of a polygon that have no corner in common cross. (M3)"""
    turn = lambda o, p, q: (q["y"] - o["y"]) * (p["x"] - o["x"]) > (p["y"] - o["y"]) * (q["x"] - o["x"])

    def cut(e, f):
        return (turn(e["a"], f["a"], f["b"]) != turn(e["b"], f["a"], f["b"])) & (turn(e["a"], e["b"], f["a"]) != turn(e["a"], e["b"], f["b"]))

    edges, n = _edges(vertices), F.size(vertices)
    numbered = F.transform(edges, lambda e, i: F.struct(e["a"].alias("a"), e["b"].alias("b"), i.alias("i")))
    far = lambda e, f: (f["i"] > e["i"] + 1) & ~((e["i"] == 0) & (f["i"] == n - 1))
    return F.exists(numbered, lambda e: F.exists(numbered, lambda f: far(e, f) & cut(e, f)))


def samples_inside(x1: Column, y1: Column, x2: Column, y2: Column, inside, samples: int = 201) -> Column:
    """Share of evenly spaced points of a segment that lie inside; inside(x, y) gives a boolean column."""
    at = F.sequence(F.lit(0), F.lit(samples - 1))
    hit = lambda i: inside(x1 + (x2 - x1) * i / (samples - 1), y1 + (y2 - y1) * i / (samples - 1)).cast("int")
    return F.aggregate(F.transform(at, hit), F.lit(0), lambda s, v: s + v) / samples


def grid_share(vertices: Column, inside, step: float) -> Column:
    """Share of a polygon's grid points (multiples of step within its extent) that lie inside something else; null if it holds none. (M2)"""
    low = lambda c: F.floor(F.array_min(F.transform(vertices, lambda v: v[c])) / step).cast("int")
    high = lambda c: F.ceil(F.array_max(F.transform(vertices, lambda v: v[c])) / step).cast("int")
    points = F.flatten(F.transform(F.sequence(low("x"), high("x")), lambda i: F.transform(F.sequence(low("y"), high("y")), lambda j: F.struct(((i + 0.5) * step).alias("x"), ((j + 0.5) * step).alias("y")))))
    own = F.filter(points, lambda p: inside_array(p["x"], p["y"], vertices))
    return F.when(F.size(own) > 0, F.size(F.filter(own, lambda p: inside(p["x"], p["y"]))) / F.size(own))
