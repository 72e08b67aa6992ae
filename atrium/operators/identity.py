"""Identity: joins fragments of tracks under constraints that hold for whole groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.functions.geometry import cosine


def candidates(tracks: DataFrame, max_gap: float = 480.0) -> DataFrame:
    """Pairs of one run's fragments of which b starts 0 to max_gap seconds after a ends.

    tracks: run_id, track_id, t_first, t_last, x0, y0 (birth), x1, y1 (death), vec.
    Joined by cells of max_gap seconds, so that only near fragments meet. (E6)
    """
    a = tracks.select("run_id", *[F.col(c).alias(f"a_{c}") for c in ("track_id", "t_first", "t_last", "x1", "y1", "vec")])
    b = tracks.select("run_id", *[F.col(c).alias(f"b_{c}") for c in ("track_id", "t_first", "t_last", "x0", "y0", "vec")])
    a = a.withColumn("_cell", F.explode(F.array(F.floor(F.col("a_t_last") / max_gap), F.floor(F.col("a_t_last") / max_gap) + 1)))
    b = b.withColumn("_cell", F.floor(F.col("b_t_first") / max_gap))
    gap = F.col("b_t_first") - F.col("a_t_last")
    p = a.join(b, ["run_id", "_cell"]).where((gap >= 0) & (gap <= max_gap) & (F.col("a_track_id") != F.col("b_track_id")))
    drift = F.sqrt((F.col("a_x1") - F.col("b_x0")) * (F.col("a_x1") - F.col("b_x0")) + (F.col("a_y1") - F.col("b_y0")) * (F.col("a_y1") - F.col("b_y0")))
    return p.select("run_id", F.col("a_track_id").alias("a"), F.col("b_track_id").alias("b"), gap.alias("gap"), drift.alias("drift"), cosine(F.col("a_vec"), F.col("b_vec")).alias("sim"))


def verdict(gap: Column, drift: Column, death_at_door: Column, birth_at_door: Column, diagonal: float) -> Column:
    """Whether a track can reappear: abstains without doors (null). Standing still explains a gap only away from all doors."""
    return (
        F.when(death_at_door.isNull() | birth_at_door.isNull(), "abstain")
        .when(gap <= 10, "continuous")
        .when(death_at_door & birth_at_door, "door_to_door")
        .when(~death_at_door & ~birth_at_door & (drift <= 0.06 * diagonal), "occlusion_recovery")
        .otherwise("impossible")
    )


def constrained_groups(tracks: DataFrame, edges: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Unites fragments along edges by falling score, refusing a union if any two members of the groups would be
    seen at once (by more than the tolerance) or differ in role: run_id, track_id, canon. (K1, K11, K12)

    Ties go by ids and tier. The canonical id is the earliest fragment's.
    Edges between roles can't count, and no union crosses components of the
    others, so each of these is folded alone.
    """
    from atrium.operators.evidence import replay

    role = tracks.select("run_id", F.col("track_id").alias("a"), F.col("role").alias("_ra"))
    other = tracks.select("run_id", F.col("track_id").alias("b"), F.col("role").alias("_rb"))
    same = edges.join(role, ["run_id", "a"]).join(other, ["run_id", "b"]).where("_ra = _rb").drop("_ra", "_rb")
    return replay(tracks, same, tolerance)[1]


def remap(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replaces track_id by the canonical id where there is one."""
    return rows.join(mapping, ["run_id", "track_id"], "left").withColumn("track_id", F.coalesce("canon", "track_id")).drop("canon")


def dossiers(mapping: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per identity: number and sorted list of fragments, span and seconds seen."""
    j = mapping.join(tracks, ["run_id", "track_id"])
    return j.groupBy("run_id", "canon").agg(
        F.count("*").alias("fragments"),
        F.concat_ws(",", F.array_sort(F.collect_list("track_id"))).alias("members"),
        F.min("t_first").alias("t_first"),
        F.max("t_last").alias("t_last"),
        F.sum(F.col("t_last") - F.col("t_first")).alias("seen_s"),
    )


def global_links(tracks: DataFrame, pairs: DataFrame, accept: float = 0.6, per_second: float = 0.001) -> DataFrame:
    """Links fragments of a run so that the total cost is least: each fragment has at most one successor and one
    predecessor, and going without costs 1. pairs: run_id, a, b, gap, sim, as `candidates` gives them. (E22, E24)

    Returns run_id, a, b. Only eligible pairs (sim >= accept) count, and each connected part of them is solved alone,
    in memory that grows with its pairs only.
    """
    import numpy as np

    from atrium.operators.scoring import sparse_assignment

    eligible = pairs.where(F.col("sim") >= accept).select("run_id", "a", "b", (1 - F.col("sim") + per_second * F.col("gap")).alias("cost")).where("cost < 1")
    known = tracks.select("run_id", "track_id")
    eligible = eligible.join(known.withColumnRenamed("track_id", "a"), ["run_id", "a"], "left_semi").join(known.withColumnRenamed("track_id", "b"), ["run_id", "b"], "left_semi")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["a", "b"])
        a, ai = np.unique(pdf["a"], return_inverse=True)
        b, bi = np.unique(pdf["b"], return_inverse=True)
        # Gains over going without.
        found = sparse_assignment(ai, bi, 1 - pdf["cost"].to_numpy())
        return pd.DataFrame([(pdf["run_id"].iloc[0], a[i], b[j]) for i, j in found], columns=["run_id", "a", "b"])

    from atrium.operators.evidence import grouped

    # What ends and what begins are different sides, though the same fragment may be on both.
    sides = eligible.select("run_id", F.concat(F.lit("a"), "a").alias("a"), F.concat(F.lit("b"), "b").alias("b"))
    ends = eligible.select("run_id", F.concat(F.lit("a"), "a").alias("track_id")).distinct()
    part = grouped(ends, sides).select("run_id", F.expr("substr(track_id, 2)").alias("a"), "part")
    return eligible.join(part, ["run_id", "a"]).groupBy("run_id", "part").applyInPandas(solve, "run_id int, a string, b string")


def link_groups(tracks: DataFrame, mapping: DataFrame, accept: float = 0.6, max_gap: float = 7200.0) -> DataFrame:
    """Takes each identity of a mapping (run_id, track_id, canon) as one fragment, from its first birth to its last death, and
    links these once more at the least total cost: run_id, track_id, canon. Identities are joined, never split. (E24)"""
    from atrium.operators.evidence import united

    j = tracks.join(mapping, ["run_id", "track_id"])
    first = F.min_by(F.struct("x0", "y0", "vec"), F.struct("t_first", "track_id")).alias("f")
    last = F.max_by(F.struct("x1", "y1"), F.struct("t_last", "track_id")).alias("l")
    whole = j.groupBy("run_id", F.col("canon").alias("track_id")).agg(F.min("t_first").alias("t_first"), F.max("t_last").alias("t_last"), first, last)
    whole = whole.select("run_id", "track_id", "t_first", "t_last", "f.x0", "f.y0", "l.x1", "l.y1", "f.vec")
    links = global_links(whole, candidates(whole, max_gap), accept)
    joined = united(whole, links).select("run_id", F.col("track_id").alias("canon"), F.col("canon").alias("_to"))
    return mapping.join(joined, ["run_id", "canon"]).select("run_id", "track_id", F.col("_to").alias("canon"))
