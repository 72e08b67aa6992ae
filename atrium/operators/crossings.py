"""Ordered decisions over door crossings: cancelling U-turns and duplicates.

Cancelling is a matter of windows. Elsewhere, whether a crossing is kept
depends on the ones kept before, so rows are folded in order, but no state
outlives a pause longer than a fold's window: each stretch between such
pauses is folded alone. Where only near crossings matter to each other, a
stretch that is too long for one task is cut into components of near pairs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atrium.operators.components import connected_components
from atrium.scratch import write_table

_COLUMNS = "run_id int, track_id string, role string, direction string, line string, x double, y double, t double"


def confirmed(crossings: DataFrame, confirm: float = 5.0) -> DataFrame:
    """Drops both of two neighbouring opposite crossings of one track and line within `confirm` seconds (inclusive). (H1)

    Where several in a row pair with the next one, they cancel two by two from
    the first, so of such a chain only the last stays, if their number is odd.
    """
    keys = ["run_id", "track_id", "line"]
    order = Window.partitionBy(*keys).orderBy("t", "direction")
    pairs = (F.lag("direction").over(order) != F.col("direction")) & (F.col("t") - F.lag("t").over(order) <= confirm)
    rows = crossings.withColumn("_new", F.when(pairs, 0).otherwise(1))
    rows = rows.withColumn("_chain", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chain = Window.partitionBy(*keys, "_chain")
    rows = rows.withColumn("_n", F.count("*").over(chain)).withColumn("_i", F.row_number().over(chain.orderBy("t", "direction")))
    return rows.where((F.col("_i") == F.col("_n")) & (F.col("_n") % 2 == 1)).select(*crossings.columns)


def islands(rows: DataFrame, keys: list[str], gap: float, inclusive: bool = True) -> DataFrame:
    """Adds _island: a number that grows at each pause of more than gap (or of gap, if not inclusive) between rows of equal keys.

    A fold whose state never outlives such a pause can be done for each island alone, so no task holds a whole run.
    """
    order = Window.partitionBy(*keys).orderBy("t")
    pause = F.col("t") - F.lag("t").over(order)
    new = F.coalesce((pause > gap if inclusive else pause >= gap).cast("int"), F.lit(1))
    return rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")


def _per_island(rows: DataFrame, keys: list[str], fold, schema: str, part: str = "_island div 128") -> DataFrame:
    """Folds islands; many small ones of one key, those of equal part, share a call. fold gets one island in order."""
    names = [f.split()[0] for f in schema.split(", ")]

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [fold(g) for _, g in pdf.groupby("_island", sort=True)]
        return pd.concat(parts, ignore_index=True)[names]

    return rows.withColumn("_part", F.expr(part)).groupBy(*keys, "_part").applyInPandas(each, schema)


#: Most crossings between two pauses that one task folds.
FOLDED = 20_000


def _near_pairs(rows: DataFrame, seconds: float, distance: float, overlap: float) -> DataFrame:
    """(a, b) of the _id of crossings of one run that could drop each other. Cells are twice as long as the window, so that
    rounding of a time never parts a pair; what meets in a cell is what one camera sees in four windows."""
    side = lambda s: [F.col(c).alias(f"{s}{c}") for c in ("_id", "track_id", "t", "x", "y", "_t0", "_t1")]
    once = rows.dropDuplicates(["_id"]).withColumn("_cell", F.floor(F.col("t") / (2 * seconds)))
    a = once.select("run_id", F.explode(F.array("_cell", F.col("_cell") + 1)).alias("_cell"), *side("a"))
    b = once.select("run_id", "_cell", *side("b"))
    col = F.col
    gap = col("bt") - col("at")
    seen = F.least("a_t1", "b_t1") - F.greatest("a_t0", "b_t0") > overlap
    together = F.coalesce(col("a_t0").isNotNull() & col("a_t1").isNotNull() & col("b_t0").isNotNull() & col("b_t1").isNotNull() & seen, F.lit(False))
    apart = (col("ax") - col("bx")) * (col("ax") - col("bx")) + (col("ay") - col("by")) * (col("ay") - col("by"))
    near = F.when(apart.isNull() | F.isnan(apart), col("atrack_id") == col("btrack_id")).otherwise((apart <= distance * distance) & ~together)
    met = a.join(b, ["run_id", "_cell"]).where((gap >= 0) & (gap <= seconds) & (col("a_id") != col("b_id")) & near)
    return met.select(col("a_id").alias("a"), col("b_id").alias("b"))


def deduplicated(crossings: DataFrame, seconds: float = 2.5, distance: float = 140.0, direction: str = "in", lines: DataFrame | None = None, spans: DataFrame | None = None, overlap: float = 0.4, folded: int = FOLDED) -> DataFrame:
    """Guests' crossings in one direction that are not near, in time and place, one that was kept before. (H2, H3)

    A dropped crossing doesn't prolong the window. A crossing without a place
    repeats only a kept one of its own track, and so does any crossing against
    a kept one without a place. lines (run_id, line): the venue's own lines;
    crossings of other named lines don't count. spans (run_id, track_id, t0,
    t1): two tracks that are seen together for more than `overlap` seconds are
    two people, however near; tracks without a span never are. Both are left out of account if not given.

    Stretches between pauses are folded as they are, up to `folded` crossings. Of longer ones only crossings that have a
    near one are folded, a component of near pairs at a time, and the rest stays: the same rows. Ties in time go by track,
    line and place. A null time is near nothing.
    """
    rows = crossings.where((crossings["direction"] == direction) & (F.coalesce(crossings["role"], F.lit("")) != "staff"))
    if lines is not None:
        rows = rows.join(lines.select("run_id", "line").distinct().withColumn("_known", F.lit(True)), ["run_id", "line"], "left").where("_known or line is null").drop("_known")
    if spans is not None:
        rows = rows.join(spans.select("run_id", "track_id", F.col("t0").alias("_t0"), F.col("t1").alias("_t1")), ["run_id", "track_id"], "left")
    else:
        rows = rows.withColumn("_t0", F.lit(None).cast("double")).withColumn("_t1", F.lit(None).cast("double"))

    names = [f.split()[0] for f in _COLUMNS.split(", ")]
    rows = rows.select(*names, "_t0", "_t1")
    rows = write_table(islands(rows, ["run_id"], seconds), "crossings")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id", "line", "x", "y"], ignore_index=True)
        kept: list[tuple] = []
        keep = []
        for t, x, y, track, a, b in zip(pdf["t"], pdf["x"], pdf["y"], pdf["track_id"], pdf["_t0"], pdf["_t1"], strict=True):
            kept = [k for k in kept if t - k[0] <= seconds]
            placed = x == x and y == y
            new = True
            for _, kx, ky, other, ka, kb in kept:
                if not placed or kx != kx or ky != ky:
                    near = track == other
                else:
                    known = a == a and b == b and ka == ka and kb == kb
                    near = (x - kx) ** 2 + (y - ky) ** 2 <= distance * distance and not (known and min(b, kb) - max(a, ka) > overlap)
                if near:
                    new = False
                    break
            keep.append(new)
            if new:
                kept.append((t, x, y, track, a, b))
        return pdf[keep]

    whole = lambda df: _per_island(df, ["run_id"], fold, _COLUMNS)
    long = write_table(rows.groupBy("run_id", "_island").agg(F.count("*").alias("n")).where(F.col("n") > folded).select("run_id", "_island"), "long")
    if long.isEmpty():
        return whole(rows)
    same = rows["run_id"].eqNullSafe(long["run_id"]) & (rows["_island"] == long["_island"])
    cut = rows.join(long, same, "left_semi").drop("_island").withColumn("_id", F.xxhash64(*names, "_t0", "_t1"))
    # Equal rows need no pair between them to be in one component, but one needs a component.
    copies = cut.groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("_id").alias("id"), F.col("_id").alias("own"))
    found = connected_components(_near_pairs(cut, seconds, distance, overlap)).join(copies, "id", "full").select(F.col("id").alias("_id"), F.coalesce("component", "own").alias("_island"))
    parts = cut.join(found, "_id", "left")
    near = _per_island(parts.where("_island is not null"), ["run_id"], fold, _COLUMNS, "pmod(_island, 128)")
    return whole(rows.join(long, same, "left_anti")).unionByName(parts.where("_island is null").select(*names)).unionByName(near)


def without_reversals(crossings: DataFrame, gap: float = 3.0) -> DataFrame:
    """Drops a crossing that reverses the last kept one of its run and line within `gap` seconds (exclusive). (H8)"""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id", "direction"], ignore_index=True)
        keep, last = [], None
        for row in pdf.itertuples():
            new = last is None or row.direction == last[1] or row.t - last[0] >= gap
            keep.append(new)
            if new:
                last = (row.t, row.direction)
        return pdf[keep]

    return _per_island(islands(crossings, ["run_id", "line"], gap, inclusive=False), ["run_id", "line"], fold, _COLUMNS)


def parties(arrivals: DataFrame, seconds: float = 25.0, radius: float = 320.0) -> DataFrame:
    """Numbers groups that arrive together: each arrival joins the first group whose last member came at most
    `seconds` before and one of whose members is within the radius. arrivals: run_id, track_id, t, x, y. (H11)"""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id"], ignore_index=True)
        open_groups: list[tuple[int, list]] = []
        party, n = [], 0
        for r in pdf.itertuples():
            open_groups = [g for g in open_groups if r.t - g[1][-1][0] <= seconds]
            for number, members in open_groups:
                if any((r.x - x) ** 2 + (r.y - y) ** 2 <= radius * radius for _, x, y in members):
                    members.append((r.t, r.x, r.y))
                    party.append(number)
                    break
            else:
                open_groups.append((n, [(r.t, r.x, r.y)]))
                party.append(n)
                n += 1
        return pdf.assign(local=party, island=pdf["_island"])

    found = _per_island(islands(arrivals, ["run_id"], seconds), ["run_id"], fold, "run_id int, track_id string, t double, island long, local int")
    # Numbers run on from island to island.
    sizes = found.groupBy("run_id", "island").agg((F.max("local") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("run_id").orderBy("island").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("run_id", "island", F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(sizes, ["run_id", "island"]).select("run_id", "track_id", "t", (F.col("before") + F.col("local")).cast("int").alias("party"))


def debounced(crossings: DataFrame, reversal: float = 3.0, same: float = 0.8, place: float = 45.0) -> DataFrame:
    """Two passes over a run's line in order: neighbouring opposite crossings within `reversal` seconds at one place drop
    each other; then of two in the same direction within `same` seconds at one place the first stays. (H6, H7, P32)"""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id", "direction"], ignore_index=True)
        t, d, x = pdf["t"].tolist(), pdf["direction"].tolist(), pdf["x"].tolist()
        left, i = [], 0
        while i < len(t):
            if i + 1 < len(t) and d[i] != d[i + 1] and t[i + 1] - t[i] <= reversal and abs(x[i + 1] - x[i]) <= place:
                i += 2
            else:
                left.append(i)
                i += 1
        keep: list[int] = []
        for i in left:
            if keep and d[keep[-1]] == d[i] and t[i] - t[keep[-1]] < same and abs(x[i] - x[keep[-1]]) <= place:
                continue
            keep.append(i)
        return pdf.iloc[keep]

    # Passes look at neighbours only, at most max(reversal, same) apart.
    return _per_island(islands(crossings, ["run_id", "line"], max(reversal, same)), ["run_id", "line"], fold, _COLUMNS)


def merged_directions(crossings: DataFrame, seconds: float = 1.0) -> DataFrame:
    """Of a run's line, drops a crossing in the direction of the last kept one within `seconds` (inclusive): one person on a seam between chunks. (H7)"""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id", "direction"], ignore_index=True)
        keep, last = [], None
        for row in pdf.itertuples():
            new = last is None or row.direction != last[1] or row.t - last[0] > seconds
            keep.append(new)
            if new:
                last = (row.t, row.direction)
        return pdf[keep]

    return _per_island(islands(crossings, ["run_id", "line"], seconds), ["run_id", "line"], fold, _COLUMNS)


def door_deduplicated(crossings: DataFrame, spans: DataFrame, seconds: float = 2.5, reach: float = 180.0, overlap: float = 0.4, last: int = 6) -> DataFrame:
    """Drops a door's crossing near one of the last six kept ones: same direction, at most `seconds` and `reach` pixels across
    apart, unless both tracks are seen together; tracks without a span never are. spans: run_id, track_id, t0, t1. (H5)"""
    rows = crossings.join(spans.select("run_id", "track_id", F.col("t0").alias("_t0"), F.col("t1").alias("_t1")), ["run_id", "track_id"], "left")

    # The smaller of a number and NaN depends on their order, so spans are compared only where both are known.
    together = lambda a, b, c, d: a == a and b == b and c == c and d == d and min(b, d) - max(a, c) > overlap

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "track_id", "line", "direction"], ignore_index=True)
        kept: list[tuple] = []
        keep = []
        for t, d, x, a, b in zip(pdf["t"], pdf["direction"], pdf["x"], pdf["_t0"], pdf["_t1"], strict=True):
            new = not any(d == kd and t - kt <= seconds and abs(x - kx) <= reach and not together(a, b, ka, kb) for kt, kd, kx, ka, kb in kept[-last:])
            keep.append(new)
            if new:
                kept.append((t, d, x, a, b))
        return pdf[keep]

    return _per_island(islands(rows, ["run_id"], seconds), ["run_id"], fold, _COLUMNS)
