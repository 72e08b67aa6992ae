"""Evidence that two fragments are one person: six tiers, vetoes, doors, and unions replayed under constraints."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions.geometry import cosine
from atrium.operators.components import connected_components
from atrium.operators.identity import candidates, verdict
from atrium.scratch import write_table

#: What each tier needs, and the range of its scores.
HANDOFF_GAP, HANDOFF_PX, STATIONARY_PX = 2.5, 90.0, 30.0
GALLERY, ANCHOR, ATTIRE, FACE = 0.65, 0.75, 0.75, 0.35
APPEARANCE_VETO, HSV_VETO, HANDOFF_HSV_VETO = 0.30, 0.45, 0.50


def eligible_faces(tracks: DataFrame, scope: str = "staff_only") -> DataFrame:
    """tracks whose faces may be looked at: with `staff_only` those of staff, and of tracks that a staff gallery has named
    (column enrolled, where there is one); the faces of all others become null before anything compares them."""
    if scope == "all":
        return tracks
    if scope != "staff_only":
        raise ValueError(f"no such scope of faces: {scope}")
    staff = F.col("role") == "staff"
    if "enrolled" in tracks.columns:
        staff = staff | F.coalesce("enrolled", F.lit(False))
    return tracks.withColumn("face", F.when(staff, F.col("face")))


def pairs(tracks: DataFrame, max_gap: float = 480.0, face_scope: str = "staff_only") -> DataFrame:
    """Candidates with all similarities: gallery (sim), anchor, hsv and face; null where one side has none. (K2, K3)

    tracks as for `candidates`, with anchor, hsv, face (arrays or null), infrared and role besides. Faces of guests are
    never compared unless face_scope is `all`.
    """
    tracks = eligible_faces(tracks, face_scope)
    more = ["anchor", "hsv", "face", "infrared", "role"]
    side = lambda p: tracks.select("run_id", F.col("track_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in more])
    like = lambda c: F.when(F.col(f"a_{c}").isNotNull() & F.col(f"b_{c}").isNotNull(), cosine(F.col(f"a_{c}"), F.col(f"b_{c}")))
    j = candidates(tracks, max_gap).join(side("a"), ["run_id", "a"]).join(side("b"), ["run_id", "b"])
    return j.select("run_id", "a", "b", "gap", "drift", "sim", *[like(c).alias(c) for c in ("anchor", "hsv", "face")], (F.col("a_infrared") != F.col("b_infrared")).alias("other_light"), (F.col("a_role") == F.col("b_role")).alias("same_role"))


def colour_contradicts(hsv: Column, least: float = HSV_VETO) -> Column:
    """Whether colours speak against a pair; without colours they don't. (K5, K6)"""
    return F.coalesce(hsv < least, F.lit(False))


def required(gap: Column, base: float = GALLERY, near: float = 15.0, far: float = 180.0, more: float = 0.09) -> Column:
    """The likeness that a gallery match needs, higher after a longer gap."""
    return base + more * F.least(F.greatest((gap - near) / (far - near), F.lit(0.0)), F.lit(1.0))


def tiers(found: DataFrame) -> DataFrame:
    """One row for each tier that accepts a pair: run_id, a, b, tier, score. Pairs of different roles have none. (K1)

    Hand-off needs a short gap and a near birth, stationary a very near one,
    both unless appearance or (in one light) colour contradict. Gallery, anchor
    and attire need likeness and one light, the first two no contradiction of
    colours. Face needs likeness only.
    """
    calm = F.coalesce(F.col("anchor") >= APPEARANCE_VETO, F.lit(True))
    colour = F.col("other_light") | ~colour_contradicts(F.col("hsv"), HANDOFF_HSV_VETO)
    in_light = ~F.col("other_light") & ~colour_contradicts(F.col("hsv"))
    part = lambda c, least: F.least((F.col(c) - least) / (1 - least), F.lit(1.0))
    sure = F.coalesce("anchor", F.lit(0.0))
    accepted = (
        ("handoff", (F.col("gap") <= HANDOFF_GAP) & (F.col("drift") <= HANDOFF_PX) & calm & colour, 0.90 + 0.09 * (1 - F.col("drift") / HANDOFF_PX)),
        ("stationary", (F.col("drift") <= STATIONARY_PX) & calm & colour, 0.85 + 0.09 * (1 - F.col("drift") / STATIONARY_PX)),
        ("gallery", (F.col("sim") >= required(F.col("gap"))) & in_light, F.col("sim")),
        ("anchor", (sure >= ANCHOR) & in_light, 0.80 + 0.09 * part("anchor", ANCHOR)),
        ("attire", (F.col("hsv") >= ATTIRE) & ~F.col("other_light"), 0.76 + 0.06 * part("hsv", ATTIRE)),
        ("face", F.col("face") >= FACE, 0.92 + 0.07 * part("face", FACE)),
    )
    listed = F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.struct(F.lit(n).alias("tier"), score.alias("score"))) for n, ok, score in accepted])
    e = found.where("same_role").select("run_id", "a", "b", F.explode(F.filter(listed, lambda x: x.isNotNull())).alias("e"))
    return e.select("run_id", "a", "b", "e.tier", "e.score")


def with_verdicts(found: DataFrame, tracks: DataFrame, doors: list[tuple[float, float]], diagonal: float) -> DataFrame:
    """Adds whether doors and places allow a pair: column verdict. Without doors all abstain."""
    at_door = lambda x, y: F.array_min(F.array(*[F.sqrt((F.col(x) - dx) * (F.col(x) - dx) + (F.col(y) - dy) * (F.col(y) - dy)) for dx, dy in doors])) <= 0.10 * diagonal if doors else F.lit(None).cast("boolean")
    dead = tracks.select("run_id", F.col("track_id").alias("a"), at_door("x1", "y1").alias("_dead"))
    born = tracks.select("run_id", F.col("track_id").alias("b"), at_door("x0", "y0").alias("_born"))
    j = found.join(dead, ["run_id", "a"]).join(born, ["run_id", "b"])
    return j.withColumn("verdict", verdict(F.col("gap"), F.col("drift"), F.col("_dead"), F.col("_born"), diagonal)).drop("_dead", "_born")


def grouped(tracks: DataFrame, edges: DataFrame) -> DataFrame:
    """Tracks with the component of edges that they are in (column part): no union ever crosses components."""
    key = lambda c: F.concat(F.col("run_id").cast("string"), F.lit(":"), F.col(c))  # noqa: E731  the number ends at the first colon, so no two keys are equal
    found = connected_components(edges.select(key("a").alias("a"), key("b").alias("b")))
    t = tracks.withColumn("_id", key("track_id")).join(found.withColumnRenamed("id", "_id"), "_id", "left")
    return t.withColumn("part", F.coalesce("component", "_id")).drop("_id", "component")


#: Most edges of a component that one task folds; larger ones are decided in rounds.
FOLDED = 20_000
_EDGE = "run_id int, a string, b string, tier string, accepted boolean"


def replay(tracks: DataFrame, edges: DataFrame, tolerance: float = 2.0, folded: int = FOLDED) -> tuple[DataFrame, DataFrame]:
    """Unites tracks along edges (run_id, a, b, tier, score) by falling score, refusing unions of groups any two members of
    which are seen together by more than the tolerance. (K12, K19)

    Gives run_id, a, b, tier, accepted for each edge, and run_id, track_id,
    canon for each track: the earliest of its group. Edges within a group that is united already are neither accepted nor
    refused: accepted is null. A component of at most `folded` edges is one group of one task; larger ones are decided in
    rounds over all of them at once, with the same result.
    """
    t = grouped(tracks.select("run_id", "track_id", "t_first", "t_last"), edges)
    own = t.select("run_id", "part", F.lit(0).alias("kind"), F.col("track_id").alias("a"), F.lit("").alias("b"), F.col("t_first").alias("u"), F.col("t_last").alias("v"), F.lit("").alias("tier"))
    part = t.select("run_id", F.col("track_id").alias("a"), "part")
    e = edges.join(part, ["run_id", "a"]).select("run_id", "part", F.lit(1).alias("kind"), "a", "b", F.col("score").alias("u"), F.lit(0.0).alias("v"), "tier")
    rows = write_table(own.unionByName(e), "merge")
    large = write_table(rows.where("kind = 1").groupBy("run_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > folded).select("run_id", "part"), "large")
    small = rows.join(large, ["run_id", "part"], "left_anti")
    done = small.groupBy("run_id", "part").applyInPandas(_fold(tolerance), _EDGE)
    if not large.isEmpty():
        many = rows.join(large, ["run_id", "part"], "left_semi")
        spans = many.where("kind = 0").select("run_id", F.col("a").alias("track_id"), F.col("u").alias("t_first"), F.col("v").alias("t_last"))
        done = done.unionByName(rounds(spans, many.where("kind = 1").select("run_id", "a", "b", "tier", F.col("u").alias("score")), tolerance))
    done = write_table(done, "replayed")
    return done, united(tracks, done.where("accepted"))


def _fold(tolerance: float):
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf[pdf["kind"] == 0]
        parent = {a: a for a in t["a"]}
        spans = {a: [(u, v)] for a, u, v in zip(t["a"], t["u"], t["v"], strict=True)}

        def find(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for r in pdf[pdf["kind"] == 1].sort_values(["u", "a", "b", "tier"], ascending=[False, True, True, True]).itertuples():
            x, y = find(r.a), find(r.b)
            fits = None
            if x != y:
                fits = not overlap(spans[x], spans[y], tolerance)
                if fits:
                    parent[y] = x
                    spans[x] += spans.pop(y)
            out.append((r.run_id, r.a, r.b, r.tier, fits))
        return pd.DataFrame(out, columns=["run_id", "a", "b", "tier", "accepted"])

    return fold


def overlap(some: list, others: list, tolerance: float) -> bool:
    """Whether a stretch of one list and one of the other share more than the tolerance: one sort and one search."""
    q, s = np.array(sorted(others), float).T
    far = np.maximum.accumulate(s) - tolerance
    p, o = np.array(some, float).T
    n = np.searchsorted(q, o - tolerance, "left")
    return bool((far[np.maximum(n - 1, 0)][n > 0] > p[n > 0]).any())


def rounds(tracks: DataFrame, edges: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """The replay's decisions on edges without gathering a component.

    An edge that is the best left at both groups it touches is what the replay
    takes before any other edge of theirs, so the groups are then as they are
    now, and all such edges are decided at once; no two share a group. Groups
    keep their stretches as a list, which only the edges decided in a round are
    given. Rounds go on until no edge is left: each decides the best edge of
    all at least, and commonly a constant share.
    """

    @F.pandas_udf("boolean")
    def clash(au: pd.Series, av: pd.Series, bu: pd.Series, bv: pd.Series) -> pd.Series:
        return pd.Series([overlap(list(zip(a, b, strict=True)), list(zip(c, d, strict=True)), tolerance) for a, b, c, d in zip(au, av, bu, bv, strict=True)], dtype=bool)

    key = F.struct((-F.col("score")).alias("s"), "a", "b", "tier")
    groups = write_table(tracks.select("run_id", F.col("track_id").alias("root"), F.array("t_first").alias("us"), F.array("t_last").alias("vs")), "groups")
    left = write_table(edges.select("run_id", "a", "b", "tier", "score", F.col("a").alias("ra"), F.col("b").alias("rb")), "left")
    done = None
    while not left.isEmpty():
        ends = left.select("run_id", F.explode(F.array("ra", "rb")).alias("root"), key.alias("key"))
        best = write_table(ends.groupBy("run_id", "root").agg(F.min("key").alias("best")), "best")
        side = lambda r, best=best: best.select("run_id", F.col("root").alias(r), F.col("best").alias(f"best_{r}"))
        first = left.join(side("ra"), ["run_id", "ra"]).join(side("rb"), ["run_id", "rb"]).where((key == F.col("best_ra")) & (key == F.col("best_rb")))
        of = lambda r, p, groups=groups: groups.select("run_id", F.col("root").alias(r), F.col("us").alias(f"{p}u"), F.col("vs").alias(f"{p}v"))
        judged = first.join(of("ra", "a"), ["run_id", "ra"]).join(of("rb", "b"), ["run_id", "rb"])
        judged = judged.select("run_id", "a", "b", "tier", "ra", "rb", (~clash("au", "av", "bu", "bv")).alias("accepted"), F.concat("au", "bu").alias("us"), F.concat("av", "bv").alias("vs"))
        judged = write_table(judged, "judged")
        joined = judged.where("accepted")
        moved = write_table(joined.select("run_id", F.explode(F.array(F.struct(F.col("ra").alias("root"), F.col("us"), F.col("vs")), F.struct(F.col("rb").alias("root"), F.lit(None).cast("array<double>").alias("us"), F.lit(None).cast("array<double>").alias("vs")))).alias("g")).select("run_id", "g.*"), "moved")
        groups = write_table(groups.join(moved, ["run_id", "root"], "left_anti").unionByName(moved.where("us is not null")), "groups")
        to = joined.select("run_id", F.col("rb").alias("old"), F.col("ra").alias("new"))
        rest = left.join(judged.select("run_id", "a", "b", "tier"), ["run_id", "a", "b", "tier"], "left_anti")
        for r in ("ra", "rb"):
            rest = rest.join(to.select("run_id", F.col("old").alias(r), F.col("new").alias(f"new_{r}")), ["run_id", r], "left").withColumn(r, F.coalesce(f"new_{r}", r)).drop(f"new_{r}")
        rest = write_table(rest.select("run_id", "a", "b", "tier", "score", "ra", "rb"), "left")
        out = judged.select("run_id", "a", "b", "tier", "accepted").unionByName(rest.where("ra = rb").select("run_id", "a", "b", "tier", F.lit(None).cast("boolean").alias("accepted")))
        done = out if done is None else done.unionByName(out)
        left = rest.where("ra <> rb")
    return done if done is not None else edges.select("run_id", "a", "b", "tier", F.lit(None).cast("boolean").alias("accepted"))


def united(tracks: DataFrame, accepted: DataFrame) -> DataFrame:
    """run_id, track_id, canon: the earliest track (then the smallest id) of each group that accepted edges make."""
    t = grouped(tracks.select("run_id", "track_id", "t_first"), accepted.select("run_id", "a", "b"))
    first = t.groupBy("run_id", "part").agg(F.min(F.struct("t_first", "track_id"))["track_id"].alias("canon"))
    return t.join(first, ["run_id", "part"]).select("run_id", "track_id", "canon")


def face_veto(accepted: DataFrame, found: DataFrame, bar: float = 0.20, strong: float = 0.80) -> DataFrame:
    """accepted edges with what faces say: `vetoed` if both have faces that differ and the edge is weak, `flagged` if it is strong, else `kept`. (K7)

    accepted: run_id, a, b, score; found: run_id, a, b, face.
    """
    differs = F.coalesce(F.col("face") < bar, F.lit(False))
    j = accepted.join(found.select("run_id", "a", "b", "face"), ["run_id", "a", "b"])
    return j.withColumn("says", F.when(differs & (F.col("score") < strong), "vetoed").when(differs, "flagged").otherwise("kept"))


def fused(tracks: DataFrame, costs: DataFrame, cutoff: float = 0.45) -> DataFrame:
    """Groups by cheapest-first unions below the cutoff; a union is refused if any pair across the two groups is forbidden: run_id, track_id, part.

    costs: run_id, a, b, cost, null where a pair is forbidden. Pairs that are not listed are allowed but never start a union.
    """
    t = grouped(tracks.select("run_id", "track_id"), costs.where(F.col("cost") < cutoff).select("run_id", "a", "b"))
    part = t.select("run_id", F.col("track_id").alias("a"), "part")
    other = t.select("run_id", F.col("track_id").alias("b"), F.col("part").alias("part_b"))
    e = costs.join(part, ["run_id", "a"]).join(other, ["run_id", "b"]).where("part = part_b").select("run_id", "part", "a", "b", "cost")
    own = t.select("run_id", "part", F.col("track_id").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(None).cast("double").alias("cost"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf.loc[pdf["b"].isna(), "a"].tolist()
        e = pdf[pdf["b"].notna()]
        banned = {frozenset(p) for p in e.loc[e["cost"].isna(), ["a", "b"]].itertuples(index=False)}
        group = {i: [i] for i in ids}
        for r in e[e["cost"] < cutoff].sort_values(["cost", "a", "b"]).itertuples():
            x, y = group[r.a], group[r.b]
            if x is not y and not any(frozenset((p, q)) in banned for p in x for q in y):
                x += y
                for i in y:
                    group[i] = x
        return pd.DataFrame({"run_id": pdf["run_id"].iloc[0], "track_id": ids, "canon": [min(group[i]) for i in ids]})

    return own.unionByName(e).groupBy("run_id", "part").applyInPandas(fold, "run_id int, track_id string, canon string")
