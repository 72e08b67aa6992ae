"""Filters and joins on detections within a frame."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.functions.geometry import Plane, area, box, intersection, iou

FRAME = ["run_id", "frame_idx"]


def pairs(boxes: DataFrame, keys: list[str] = FRAME) -> DataFrame:
    """All ordered pairs of different tracks in a frame: the second one's columns start with o_. A frame holds few boxes."""
    other = boxes.select(*keys, *[F.col(c).alias(f"o_{c}") for c in boxes.columns if c not in keys])
    return boxes.join(other, keys).where(F.col("track_id") != F.col("o_track_id"))


def absurd(width: float, height: float, tall: float = 0.70, large: float = 0.30) -> Column:
    """(C1)"""
    b = box()
    return ((b[3] - b[1]) / height > tall) | (area(b) / (width * height) > large)


def implausible(plane: Plane, tolerance: float = 2.5, aspect: float = 3.5) -> Column:
    """Larger than a person can be at that row; where no height is expected, the box stays."""
    h = plane.expected_height(F.col("y2"))
    return F.coalesce(area(box()) > tolerance * h * h / aspect, F.lit(False))


def suppressed(boxes: DataFrame, threshold: float = 0.7, by_class: str | None = None) -> DataFrame:
    """Greedy non-maximum suppression in each frame, or in each class of a frame: by falling confidence, then track, what overlaps a kept box goes."""
    order = ["frame_idx", *([by_class] if by_class else [])]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*order, "conf", "track_id"], ascending=[True] * len(order) + [False, True], ignore_index=True)
        kept: list[tuple[float, ...]] = []
        keep, last = [], None
        for frame, x1, y1, x2, y2 in zip(zip(*[pdf[c] for c in order], strict=True), pdf["x1"], pdf["y1"], pdf["x2"], pdf["y2"], strict=True):
            if frame != last:
                kept, last = [], frame
            own, ok = (x2 - x1) * (y2 - y1), True
            for a, b, c, d in kept:
                both = max(0.0, min(x2, c) - max(x1, a)) * max(0.0, min(y2, d) - max(y1, b))
                union = own + (c - a) * (d - b) - both
                if union > 0 and both / union >= threshold:
                    ok = False
                    break
            keep.append(ok)
            if ok:
                kept.append((x1, y1, x2, y2))
        return pdf[keep].drop(columns="_part")

    # Many frames to a call: a call costs far more than a frame.
    return boxes.withColumn("_part", F.expr("frame_idx div 64")).groupBy("run_id", "_part").applyInPandas(fold, boxes.schema)


def occluded(boxes: DataFrame, over: float = 0.30, inside_share: float = 0.60) -> DataFrame:
    """Each box with whether another of its frame overlaps it much: run_id, frame_idx, track_id, occluded."""
    p = pairs(boxes)
    least = F.least(F.greatest(area(box()), F.lit(1.0)), F.greatest(area(box("o_")), F.lit(1.0)))
    hit = (iou(box(), box("o_")) >= over) | (intersection(box(), box("o_")) / least >= inside_share)
    hits = p.where(hit).select(*FRAME, "track_id").distinct().withColumn("hit", F.lit(True))
    return boxes.join(hits, [*FRAME, "track_id"], "left").select(*FRAME, "track_id", F.coalesce("hit", F.lit(False)).alias("occluded"))


def carried(boxes: DataFrame, plane: Plane, tolerance: float = 0.85, drop: float = 0.15, within: float = 0.7, small: float = 0.45) -> DataFrame:
    """Boxes without those that look carried by another person: short, low, mostly inside and much smaller."""
    h = F.col("y2") - F.col("y1")
    low = (F.col("y1") - F.col("o_y1")) / (F.col("o_y2") - F.col("o_y1")) >= drop
    inside = intersection(box(), box("o_")) / area(box()) >= within
    much = area(box()) <= small * area(box("o_"))
    gone = pairs(boxes).where((h < tolerance * plane.expected_height(F.col("y2"))) & low & inside & much).select(*FRAME, "track_id").distinct()
    return boxes.join(gone, [*FRAME, "track_id"], "left_anti")


def without_regions(boxes: DataFrame, regions: DataFrame, least: float = 0.55) -> DataFrame:
    """Boxes that overlap no phantom region (run_id, x1, y1, x2, y2) by `least`."""
    r = regions.select("run_id", *[F.col(c).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")])
    hit = boxes.join(r, "run_id").where(iou(box(), box("o_")) >= least).select(*FRAME, "track_id").distinct()
    return boxes.join(hit, [*FRAME, "track_id"], "left_anti")


def _median(values: Column) -> Column:
    """The true median of an array, null if it is empty."""
    s, n = F.sort_array(values), F.size(values)
    at = lambda i: F.get(s, i.cast("int"))
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def motion(boxes: DataFrame, still: float = 8.0) -> DataFrame:
    """Speed (median over the last four anchors' intervals) and heading in degrees, null when still."""
    order = Window.partitionBy("run_id", "track_id").orderBy("t")
    fx, fy = (F.col("x1") + F.col("x2")) / 2, F.col("y2")
    b = boxes.select("run_id", "track_id", "t", fx.alias("fx"), fy.alias("fy"))
    dx, dy, dt = (F.col(c) - F.lag(c).over(order) for c in ("fx", "fy", "t"))
    b = b.withColumn("v", F.when(dt > 0, F.sqrt(dx * dx + dy * dy) / dt))
    last = order.rowsBetween(-2, 0)
    three = Window.partitionBy("run_id", "track_id").orderBy("t").rowsBetween(-3, 0)
    sx, sy = F.col("fx") - F.first("fx").over(three), F.col("fy") - F.first("fy").over(three)
    b = b.withColumn("speed", _median(F.collect_list("v").over(last))).withColumn("sx", sx).withColumn("sy", sy)
    heading = F.pmod(F.degrees(F.atan2("sx", -F.col("sy"))), F.lit(360.0))
    return b.select("run_id", "track_id", "t", F.round("speed", 4).alias("speed"), F.round(F.when((F.col("speed") >= still) & ((F.col("sx") != 0) | (F.col("sy") != 0)), heading), 3).alias("heading"))


def greedy_matches(left: DataFrame, right: DataFrame, least: float = 0.3) -> DataFrame:
    """Pairs of boxes of a frame by falling IoU, each box in one pair: run_id, frame_idx, track_id, o_track_id, iou.

    A pair whose boxes meet no others is taken as it is; only the rest of a frame is folded.
    """
    other = right.select(*FRAME, *[F.col(c).alias(f"o_{c}") for c in ("track_id", "x1", "y1", "x2", "y2")])
    p = left.select(*FRAME, "track_id", "x1", "y1", "x2", "y2").join(other, FRAME).withColumn("iou", iou(box(), box("o_")))
    p = p.where(F.col("iou") >= least).select(*FRAME, "track_id", "o_track_id", "iou")
    n1, n2 = (p.groupBy(*FRAME, c).agg(F.count("*").alias(f"n_{c}")) for c in ("track_id", "o_track_id"))
    p = p.join(n1, [*FRAME, "track_id"]).join(n2, [*FRAME, "o_track_id"])
    alone = (F.col("n_track_id") == 1) & (F.col("n_o_track_id") == 1)
    columns = [*FRAME, "track_id", "o_track_id", "iou"]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        used: set = set()
        keep = []
        pdf = pdf.sort_values(["frame_idx", "iou", "track_id", "o_track_id"], ascending=[True, False, True, True])
        for f, a, b in zip(pdf["frame_idx"], pdf["track_id"], pdf["o_track_id"], strict=True):
            ok = (f, 0, a) not in used and (f, 1, b) not in used
            keep.append(ok)
            if ok:
                used |= {(f, 0, a), (f, 1, b)}
        return pdf[keep][columns]

    rest = p.where(~alone).withColumn("part", F.expr("frame_idx div 64"))
    solved = rest.groupBy("run_id", "part").applyInPandas(fold, "run_id int, frame_idx int, track_id string, o_track_id string, iou double")
    return p.where(alone).select(*columns).unionByName(solved)


def exposure(mean: Column, low: Column, high: Column) -> Column:
    """dark, bright or ok, from a frame's mean and its shares of nearly black and nearly white pixels."""
    return F.when((mean < 60) | (low > 0.20), "dark").when((mean > 195) | (high > 0.20), "bright").otherwise("ok")


def clip_limit(mean: Column, verdict: Column, base: float = 2.0, most: float = 4.0) -> Column:
    """How strongly to equalise: more the worse the exposure, up to a bound."""
    severity = F.when(verdict == "ok", 0.0).when(verdict == "dark", (60 - mean) / 60.0).otherwise((mean - 195) / 60.0)
    return base + (most - base) * F.least(F.greatest(severity, F.lit(0.0)), F.lit(1.0))


def image_problems(sharpness: Column, brightness: Column, edges: Column, change: Column) -> Column:
    """What is wrong with a picture, as an array; change is null for a first frame."""
    found = F.array(
        F.when(sharpness < 40.0, "focus"),
        F.when(brightness > 242.0, "bright").when(brightness < 12.0, "dark"),
        F.when(edges < 0.004, "blocked"),
        F.when(change < 0.2, "frozen"),
    )
    return F.filter(found, lambda p: p.isNotNull())


def activity(shoulders: Column, hips: Column, knees: Column, moved: Column, walk: float = 12.0, bend: float = 45.0, sit: float = 0.25) -> Column:
    """Activity from midpoints (x, y) of joints, null where hidden, and the feet's move in pixels since the last sample."""
    dx, dy = hips["x"] - shoulders["x"], hips["y"] - shoulders["y"]
    torso = F.sqrt(dx * dx + dy * dy)
    low = F.coalesce((torso > 1e-6) & (F.abs(knees["y"] - hips["y"]) / torso < sit), F.lit(False))
    return (
        F.when(shoulders.isNull() | hips.isNull(), "unknown")
        .when(low, "sitting")
        .when(F.degrees(F.atan2(F.abs(dx), F.abs(dy) + 1e-6)) >= bend, "bending")
        .when(moved >= walk, "walking")
        .otherwise("standing")
    )


def motion_gate(frames: DataFrame, idle: float = 10.0) -> DataFrame:
    """Marks frames that a motion gate skips: still ones, if the last detection in a frame that was looked at is more than `idle` seconds ago.

    frames: run_id, i, t, still, detected. A moving frame with a detection
    sets the state whatever was before, so each begins an island of its own;
    only islands, never runs, are folded. A run's first frame is looked at and
    counts as a detection.
    """
    order = Window.partitionBy("run_id").orderBy("i")
    first = F.row_number().over(order) == 1
    certain = (F.col("detected") & ~F.col("still")) | first
    rows = frames.withColumn("sure", certain.cast("int")).withColumn("island", F.sum("sure").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["island", "i"], ignore_index=True)
        last, out = 0.0, []
        for t, still, detected, sure in zip(pdf["t"], pdf["still"], pdf["detected"], pdf["sure"], strict=True):
            skip = bool(not sure and still and t - last > idle)
            if sure or (detected and not skip):
                last = t
            out.append(skip)
        return pdf.assign(skip=out)[["run_id", "i", "skip"]]

    # Many islands to a call.
    return rows.withColumn("part", F.expr("island div 256")).groupBy("run_id", "part").applyInPandas(fold, "run_id int, i long, skip boolean")


def debounced_side(rows: DataFrame, bar: float, hysteresis: float, patience: int) -> DataFrame:
    """run_id, event_id, night of rows (run_id, event_id, value): night begins after `patience` values in a row under the bar and
    ends after as many at bar * hysteresis or above. (C28)

    `patience` rows that are surely on one side fix the state, so what follows them is an island with a known start, and
    islands are folded alone. A run begins by day.
    """
    order = Window.partitionBy("run_id").orderBy("event_id")
    last = order.rowsBetween(-patience, -1)
    full = F.count("*").over(last) == patience
    known = F.when(full & (F.max("value").over(last) < bar), True).when(full & (F.min("value").over(last) >= bar * hysteresis), False)
    rows = rows.withColumn("_known", F.when(F.row_number().over(order) == 1, False).otherwise(known))
    rows = rows.withColumn("_island", F.count("_known").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("event_id")
        on, against, out = False, 0, []
        for v, known in zip(pdf["value"], pdf["_known"], strict=True):
            if known is not None and known == known:
                on, against = bool(known), 0
            raw = v < bar * (hysteresis if on else 1.0)
            against = against + 1 if raw != on else 0
            if against >= patience:
                on, against = raw, 0
            out.append(on)
        return pd.DataFrame({"run_id": pdf["run_id"], "event_id": pdf["event_id"], "night": out})

    parts = rows.withColumn("_part", F.expr("_island div 256"))
    return parts.groupBy("run_id", "_part").applyInPandas(fold, "run_id int, event_id long, night boolean")


def spaced(rows: DataFrame, keys: list[str], at: str, least: float) -> DataFrame:
    """Rows at least `least` after the one kept before them, the first of each key included.

    A row that follows none within `least` is kept whatever was before, so each begins an island that is folded alone.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    gap = F.col(at) - F.lag(at).over(order)
    rows = rows.withColumn("_new", F.coalesce((gap >= least).cast("int"), F.lit(1)))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    columns = [c for c in rows.columns if not c.startswith("_")]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*keys, "_island", at])
        keep, last = [], 0.0
        for t, new in zip(pdf[at], _starts(pdf, [*keys, "_island"]), strict=True):
            ok = bool(new or t - last >= least)
            keep.append(ok)
            last = t if ok else last
        return pdf[keep][columns]

    # Islands of one key stay in order; small ones go to a call together.
    parts = rows.withColumn("_part", F.pmod(F.xxhash64(*keys, "_island"), F.lit(64)))
    return parts.groupBy("_part").applyInPandas(fold, parts.select(*columns).schema)


def _starts(pdf: pd.DataFrame, keys: list[str]) -> pd.Series:
    """Whether each row differs from the one before in some key."""
    return (pdf[keys] != pdf[keys].shift()).any(axis=1)


def recovered(persons: DataFrame, heads: DataFrame, plane: Plane, least: float = 0.35, penalty: float = 0.3) -> DataFrame:
    """Persons, and for each sure enough head within none of its frame a body as tall as the plane expects: FRAME, track_id,
    conf, h, inferred. Three damped steps find the height; bodies of under 8 pixels are noise. (C7, C8)"""
    middle = heads.where(F.col("conf") >= least).withColumn("_cx", (F.col("x1") + F.col("x2")) / 2).withColumn("_cy", (F.col("y1") + F.col("y2")) / 2)
    p = persons.select(*FRAME, *[F.col(c).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")])
    held = middle.join(p, FRAME).where("_cx between o_x1 and o_x2 and _cy between o_y1 and o_y2").select(*FRAME, "track_id").distinct()
    step = lambda h, _: 0.5 * h + 0.5 * (plane.a * (F.col("y1") + h) + plane.b)
    h = F.aggregate(F.sequence(F.lit(1), F.lit(3)), 2.0 * (F.col("y2") - F.col("y1")), step)
    new = middle.join(held, [*FRAME, "track_id"], "left_anti").withColumn("h", h).where("h >= 8")
    inferred = new.select(*FRAME, "track_id", F.greatest(F.lit(0.01), F.col("conf") * (1 - penalty)).alias("conf"), "h", F.lit(True).alias("inferred"))
    return persons.select(*FRAME, "track_id", "conf", (F.col("y2") - F.col("y1")).alias("h"), F.lit(False).alias("inferred")).unionByName(inferred)


def dead_area(boxes: DataFrame, mask: list[tuple[float, float]], need: float, still: float = 30.0, window: float = 60.0, radius: float = 90.0, cell: float = 128.0) -> DataFrame:
    """Marks boxes (kept) that a mask doesn't drop: those with feet outside, and inside it those whose spot was not held for
    `still` seconds by boxes that spread less than `need` pixels. need = 0 drops all inside. (C10)

    A spot's history are the earlier boxes of its cell within the window and the
    radius. They come by an equi-join on cell and time step, never by comparing
    a run's boxes with each other; at most a window's boxes of one cell meet.
    """
    x, y = (F.col("x1") + F.col("x2")) / 2, F.col("y2")
    b = boxes.withColumn("_x", x).withColumn("_y", y).withColumn("_in", _inside(x, y, mask))
    if need <= 0:
        return b.withColumn("kept", ~F.col("_in")).drop("_x", "_y", "_in")
    at = ["run_id", "_cx", "_cy"]
    held = b.where("_in").withColumn("_cx", F.floor(F.col("_x") / cell)).withColumn("_cy", F.floor(F.col("_y") / cell)).withColumn("_s", F.floor(F.col("t") / window))
    past = held.select(*at, F.explode(F.array(F.col("_s"), F.col("_s") + 1)).alias("_s"), F.col("t").alias("_t"), F.col("_x").alias("_px"), F.col("_y").alias("_py"))
    away = F.sqrt((F.col("_x") - F.col("_px")) * (F.col("_x") - F.col("_px")) + (F.col("_y") - F.col("_py")) * (F.col("_y") - F.col("_py")))
    near = held.join(past, [*at, "_s"]).where((F.col("_t") < F.col("t")) & (F.col("t") - F.col("_t") <= window) & (away <= radius))
    across = F.greatest(F.max("_px") - F.min("_px"), F.max("_py") - F.min("_py"))
    g = near.groupBy(*FRAME, "track_id", "t").agg(F.min("_t").alias("_first"), across.alias("_across"), F.collect_set(F.struct("_px", "_py")).alias("_spots"))
    # Spots that span the need in one direction spread too far; only of the others, which lie in so small a square, pairs are measured.
    g = g.where((F.col("t") - F.col("_first") >= still) & (F.col("_across") < need))
    apart = lambda p, q: F.sqrt((p["_px"] - q["_px"]) * (p["_px"] - q["_px"]) + (p["_py"] - q["_py"]) * (p["_py"] - q["_py"]))
    spread = F.array_max(F.transform("_spots", lambda p: F.array_max(F.transform("_spots", lambda q: apart(p, q)))))
    gone = g.where(spread < need).select(*FRAME, "track_id", F.lit(False).alias("kept"))
    return b.join(gone, [*FRAME, "track_id"], "left").withColumn("kept", F.coalesce("kept", F.lit(True))).drop("_x", "_y", "_in")


def _inside(x: Column, y: Column, polygon: list[tuple[float, float]]) -> Column:
    from atrium.functions.geometry import inside

    return inside(x, y, polygon)


def points_in_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Each point of a frame (p, x, y), in order, takes the first box by id that holds it and is free: FRAME, p, track_id."""
    o = boxes.select(*FRAME, "track_id", "x1", "y1", "x2", "y2")
    j = points.join(o, FRAME).where("x between x1 and x2 and y between y1 and y2").select(*FRAME, "p", "track_id")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        used: set = set()
        keep = []
        pdf = pdf.sort_values(["frame_idx", "p", "track_id"])
        for f, p, b in zip(pdf["frame_idx"], pdf["p"], pdf["track_id"], strict=True):
            ok = (f, 0, p) not in used and (f, 1, b) not in used
            keep.append(ok)
            if ok:
                used |= {(f, 0, p), (f, 1, b)}
        return pdf[keep][[*FRAME, "p", "track_id"]]

    # Frames of a part go to one call; a frame holds few boxes.
    return j.withColumn("_part", F.expr("frame_idx div 64")).groupBy("run_id", "_part").applyInPandas(fold, j.select(*FRAME, "p", "track_id").schema)
