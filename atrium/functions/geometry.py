"""Geometry as column expressions: boxes are x1, y1, x2, y2; feet are at (mid x, y2)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[float, float]


def area(b: tuple[Column, ...]) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union; 0 where the union is empty."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def box(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))


def inside(x: Column, y: Column, polygon: list[Point], eps: float = 1e-12, always: bool = False) -> Column:
    """Even-odd rule by ray casting over a fixed polygon; eps is added to the denominator of level edges, or of all."""
    crossed = F.lit(0)
    for (ax, ay), (bx, by) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        at = (F.lit(bx) - ax) * (y - ay) / (F.lit(by) - ay + (eps if always or by == ay else 0.0)) + ax
        crossed = crossed + (((F.lit(ay) > y) != (F.lit(by) > y)) & (x < at)).cast("int")
    return crossed % 2 == 1


def inside_array(x: Column, y: Column, vertices: Column, eps: float = 1e-12) -> Column:
    """The same for a column of vertices, array<struct<x,y>>; null vertices give null."""
    after = F.concat(F.slice(vertices, 2, F.size(vertices)), F.slice(vertices, 1, 1))

    def edge(a, b):
        d = b["y"] - a["y"]
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.when(d == 0, F.lit(eps)).otherwise(d) + a["x"]
        return (((a["y"] > y) != (b["y"] > y)) & (x < at)).cast("int")

    return F.aggregate(F.zip_with(vertices, after, edge), F.lit(0), lambda s, v: s + v) % 2 == 1


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers, 0 if one is null or zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when(norm > 0, dot(a, b) / norm), F.lit(0.0))


class Plane:
    """A ground plane from the pixel height of a standing person by row: height = a * y + b."""

    def __init__(self, a: float, b: float, width: float, person: float = 1.7, hfov: float = 70.0):
        self.a, self.b, self.cx, self.person = a, b, width / 2, person
        self.focal = width / 2 / math.tan(math.radians(hfov) / 2)

    def expected_height(self, y: Column) -> Column:
        """Null above the horizon."""
        h = F.lit(self.a) * y + self.b
        return F.when(h > 1e-6, h)

    def to_ground(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(D4)"""
        h = self.expected_height(y)
        return (x - self.cx) * self.person / h, F.lit(self.focal * self.person) / h

    def scale(self, y: Column) -> Column:
        """Metres of a pixel at a row."""
        return F.lit(self.person) / self.expected_height(y)

    def distance(self, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
        """(D7)"""
        (ax, az), (bx, bz) = self.to_ground(x1, y1), self.to_ground(x2, y2)
        return F.sqrt((ax - bx) * (ax - bx) + (az - bz) * (az - bz))

    def camera_height(self) -> float | None:
        """(D10)"""
        return self.person / self.a if self.a > 1e-6 else None

    def horizon(self) -> float | None:
        """(D10, P14)"""
        return -self.b / self.a if self.a > 1e-6 else None


def fisheye_to_source(x: Column, y: Column, k: float | Column, width: float, height: float) -> tuple[Column, Column]:
    """Where the lens puts a straight image's point: r * (1 + k r^2), r in half-diagonals."""
    half = math.hypot(width, height) / 2
    dx, dy = (x - width / 2) / half, (y - height / 2) / half
    f = 1 + (k if isinstance(k, Column) else F.lit(k)) * (dx * dx + dy * dy)
    return dx * f * half + width / 2, dy * f * half + height / 2


def fisheye_fold(x: Column, y: Column, k: float, width: float, height: float) -> Column:
    """On which side of the lens's turning point a straight image's point is: 0 before it, which is all a lens images; 1 beyond,
    where images come back to the centre; 2 where they have passed it and lie opposite."""
    if k >= 0:
        return F.lit(0)
    half = math.hypot(width, height) / 2
    dx, dy = (x - width / 2) / half, (y - height / 2) / half
    r = F.sqrt(dx * dx + dy * dy)
    return F.when(r <= math.sqrt(-1 / (3 * k)), 0).when(r <= math.sqrt(-1 / k), 1).otherwise(2)


def fisheye_to_rectified(x: Column, y: Column, k: float, width: float, height: float, steps: int = 60, fold: Column | None = None) -> tuple[Column, Column]:
    """The inverse, by bisection of the radius. Where the lens folds (k < 0) up to three points have one image: fold says which is
    meant (fisheye_fold); without it the one before the turning point, and radii beyond that are held there. (D18)"""
    half = math.hypot(width, height) / 2
    dx, dy = (x - width / 2) / half, (y - height / 2) / half
    r = F.sqrt(dx * dx + dy * dy)
    top = math.sqrt(-1 / (3 * k)) if k < 0 else None
    goal = F.least(r, F.lit(top * (1 + k * top * top))) if top else r
    lo, hi, sign = F.lit(0.0), (F.lit(top) if top else r + F.lit(1e-9)).cast("double"), F.lit(1.0)
    if fold is not None and top:
        # Beyond the turning point the length falls to 0 at `back`, and past it grows with the cube of the radius.
        back = math.sqrt(-1 / k)
        of = lambda near, middle, far: F.when(fold == 1, middle).when(fold == 2, far).otherwise(near)
        lo, hi, goal = of(lo, F.lit(top), F.lit(back)), of(hi, F.lit(back), F.cbrt(r / -k) + back), of(goal, -goal, r)
        sign = of(sign, F.lit(-1.0), F.lit(-1.0))
    start = F.struct(lo.alias("lo"), hi.alias("hi"))

    def halve(s, _):
        mid = (s["lo"] + s["hi"]) / 2
        low = sign * mid * (1 + F.lit(k) * mid * mid) < goal
        return F.struct(F.when(low, mid).otherwise(s["lo"]).alias("lo"), F.when(low, s["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: (s["lo"] + s["hi"]) / 2)
    f = F.when(r > 0, found / r).otherwise(F.lit(1.0))
    if fold is not None and top:
        f = F.when(fold == 2, -f).otherwise(f)
    return dx * f * half + width / 2, dy * f * half + height / 2


def fisheye_horizon(k: Column) -> Column:
    """The largest radius, in half-diagonals, that a lens images; null if there is no limit (k >= 0)."""
    turn = F.sqrt(-1 / (3 * F.when(k < 0, k)))
    return turn * (1 + k * turn * turn)


def box_to_source(b: tuple[Column, ...], k: float, width: float, height: float, samples: int = 5) -> tuple[Column, ...]:
    """The box around the mapped outline of a rectified image's box: edges bulge, so corners are not enough."""
    xs, ys = [], []
    for i in range(samples):
        t = i / (samples - 1)
        x, y = b[0] + (b[2] - b[0]) * t, b[1] + (b[3] - b[1]) * t
        for p in ((x, b[1]), (x, b[3]), (b[0], y), (b[2], y)):
            sx, sy = fisheye_to_source(*p, k, width, height)
            xs.append(sx)
            ys.append(sy)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def project(x: Column, z: Column, y: Column, tilt: Column, up: float, focal: float, frame: tuple[float, float]) -> tuple[Column, Column]:
    """Where a camera `up` metres high, tilted down by `tilt` degrees, sees a point; null behind it."""
    below, t = up - y, F.radians(tilt)
    depth, down = z * F.cos(t) - below * F.sin(t), z * F.sin(t) + below * F.cos(t)
    depth = F.when(depth > 1e-6, depth)
    return frame[0] / 2 + focal * x / depth, frame[1] / 2 + focal * down / depth


def segments_cross(p1: Point, p2: Point, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a fixed segment and another cross, by orientation."""
    (ax, ay), (bx, by) = p1, p2
    turn = lambda ox, oy, px, py, qx, qy: (qy - oy) * (px - ox) > (py - oy) * (qx - ox)
    a, b, c, d = F.lit(ax), F.lit(ay), F.lit(bx), F.lit(by)
    return (turn(a, b, x1, y1, x2, y2) != turn(c, d, x1, y1, x2, y2)) & (turn(a, b, c, d, x1, y1) != turn(a, b, c, d, x2, y2))
