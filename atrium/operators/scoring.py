"""Scores against ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.operators.intervals import range_join


def windows_scored(events: DataFrame, truth: list[tuple[float, float, int, bool]], slack: float = 3.0) -> DataFrame:
    """Events per run and truth window (w0, w1, expected, tuned), widened by slack on both sides: got, hits and extra events.

    Truth is a handful of hand-made windows, so it is a constant of the plan.
    """
    names = ("w0", "w1", "expected", "tuned")
    windows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in truth])
    each = events.select("run_id").distinct().select("run_id", F.explode(windows).alias("w")).select("run_id", "w.*")
    wide = each.select("run_id", "w0", (F.col("w0") - slack).alias("_lo"), (F.col("w1") + slack).alias("_hi"))
    counts = range_join(events.select("run_id", "t"), wide, ["run_id"], "t", "_lo", "_hi", 20.0).groupBy("run_id", "w0").agg(F.count("*").alias("got"))
    out = each.join(counts, ["run_id", "w0"], "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return out.select("run_id", "w0", "expected", "tuned", "got", F.least(F.col("got"), F.col("expected").cast("long")).alias("hits"), F.greatest(F.col("got") - F.col("expected"), F.lit(0)).alias("extra"))


ALPHAS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def assignment(score):
    """Rows and columns of the assignment of greatest total score, by shortest augmenting paths.

    score: a matrix of numbers >= 0; the shorter side is fully assigned.
    """
    import numpy as np

    turned = score.shape[0] > score.shape[1]
    cost = -(score.T if turned else score)
    n, m = cost.shape
    u, v, match = np.zeros(n), np.zeros(m), np.full(m, -1)
    for i in range(n):
        row, used, best, back = i, np.zeros(m, bool), np.full(m, np.inf), np.full(m, -1)
        path, at = -1, -1
        while True:
            reduced = cost[row] - u[row] - v
            if at >= 0:
                reduced = reduced + shift
            better = ~used & (reduced < best)
            best[better], back[better] = reduced[better], at
            open_best = np.where(used, np.inf, best)
            at = int(open_best.argmin())
            shift = open_best[at]
            used[at] = True
            if match[at] < 0:
                path = at
                break
            row = int(match[at])
        done = used.copy()
        done[path] = False
        u[i] += shift
        for j in np.flatnonzero(done):
            u[match[j]] += shift - best[j]
            v[j] -= shift - best[j]
        while path >= 0:
            previous = int(back[path])
            match[path] = i if previous < 0 else match[previous]
            path = previous
    columns = np.flatnonzero(match >= 0)
    rows = match[columns]
    return (columns, rows) if turned else (rows, columns)


def sparse_assignment(rows, columns, gain) -> list[tuple[int, int]]:
    """Pairs of the matching of greatest total gain, given the pairs that are possible and their gains (> 0); any side may stay alone.

    Shortest augmenting paths with prices: the search from a row looks at
    pairs near it only, and nothing of the size rows x columns is ever made.
    """
    import heapq

    n, m = max(rows, default=-1) + 1, max(columns, default=-1) + 1
    top = max((float(g) for g in gain), default=0.0)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for r, c, g in zip(rows, columns, gain, strict=True):
        near[int(r)].append((int(c), top - float(g)))
    for r in range(n):
        near[r].append((m + r, top))  # alone, in a column of its own
    u, v, match, held = [0.0] * n, [0.0] * (m + n), [-1] * (m + n), [-1] * n
    for start in range(n):
        far: dict[int, float] = {}
        came: dict[int, int] = {}
        done: dict[int, float] = {}
        heap: list[tuple[float, int]] = []
        row, base = start, 0.0
        while True:
            for c, cost in near[row]:
                d = base + cost - u[row] - v[c]
                if c not in done and d < far.get(c, float("inf")):
                    far[c], came[c] = d, row
                    heapq.heappush(heap, (d, c))
            while (at := heapq.heappop(heap))[1] in done or at[0] > far[at[1]]:
                pass
            base, column = at
            if match[column] < 0:
                break
            done[column] = base
            row = match[column]
        u[start] += base
        for c, d in done.items():
            u[match[c]] += base - d
            v[c] -= base - d
        while column >= 0:  # each row on the path moves to the column that was reached from it
            r = came[column]
            match[column] = r
            held[r], column = column, held[r]
    return [(r, c) for c, r in enumerate(match[:m]) if r >= 0]


def best_pairs(truth: DataFrame, found: DataFrame, kind: str = "int") -> DataFrame:
    """Per frame the pairs of the alignment-weighted assignment, with their overlap: run_id, frame_idx, gt, pr, iou.

    Pairs and alignments are joins and aggregates; a pair whose boxes meet
    nothing else is taken as it is, and only the rest of a frame, whose boxes
    are few, is solved as a function. kind: the type of run_id.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql import Window

    from atrium.functions.geometry import box, iou
    from atrium.scratch import write_table

    t = truth.select("run_id", "frame_idx", F.col("track_id").alias("gt"), "x1", "y1", "x2", "y2")
    p = found.select("run_id", "frame_idx", F.col("track_id").alias("pr"), *[F.col(c).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")])
    # How often a track is seen comes from the same pass as the pairs.
    t = t.withColumn("n_gt", F.count("*").over(Window.partitionBy("run_id", "gt")))
    p = p.withColumn("n_pr", F.count("*").over(Window.partitionBy("run_id", "pr")))
    sims = t.join(p, ["run_id", "frame_idx"]).withColumn("iou", iou(box(), box("o_"))).where("iou > 0").select("run_id", "frame_idx", "gt", "pr", "n_gt", "n_pr", "iou")
    row, col = Window.partitionBy("run_id", "frame_idx", "gt"), Window.partitionBy("run_id", "frame_idx", "pr")
    sims = sims.select("*", F.sum("iou").over(row).alias("s1"), F.count("*").over(row).alias("n1"))
    sims = sims.select("*", F.sum("iou").over(col).alias("s2"), F.count("*").over(col).alias("n2"))
    weight = F.col("iou") / (F.col("s1") + F.col("s2") - F.col("iou"))
    sims = write_table(sims.select("run_id", "frame_idx", "gt", "pr", "n_gt", "n_pr", "iou", "n1", "n2", weight.alias("weight")), "overlaps")
    simple = sims.where("n1 = 1 and n2 = 1").select("run_id", "frame_idx", "gt", "pr", "iou")
    hard = sims.where("n1 > 1 or n2 > 1")
    # Alignments are needed for contested pairs only, from all frames.
    contested = hard.select("run_id", "gt", "pr").distinct()
    shares = sims.join(contested, ["run_id", "gt", "pr"], "left_semi").groupBy("run_id", "gt", "pr", "n_gt", "n_pr").agg(F.sum("weight").alias("potential"))
    shares = shares.select("run_id", "gt", "pr", (F.col("potential") / (F.col("n_gt") + F.col("n_pr") - F.col("potential"))).alias("alignment"))
    hard = hard.join(shares, ["run_id", "gt", "pr"]).select("run_id", F.expr("frame_idx div 64").alias("part"), "frame_idx", "gt", "pr", "iou", "alignment")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["frame_idx", "gt", "pr"])
        frames, gts, prs, ious = pdf["frame_idx"].to_numpy(), pdf["gt"].to_numpy(), pdf["pr"].to_numpy(), pdf["iou"].to_numpy()
        scores, run = ious * pdf["alignment"].to_numpy(), pdf["run_id"].iloc[0]
        edges = [0, *(np.flatnonzero(frames[1:] != frames[:-1]) + 1), len(frames)]
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            g, gi = np.unique(gts[a:b], return_inverse=True)
            q, qi = np.unique(prs[a:b], return_inverse=True)
            similar, score = np.zeros((len(g), len(q))), np.zeros((len(g), len(q)))
            similar[gi, qi], score[gi, qi] = ious[a:b], scores[a:b]
            out += [(run, frames[a], g[i], q[j], similar[i, j]) for i, j in zip(*assignment(score), strict=True) if similar[i, j] > 0]
        return pd.DataFrame(out, columns=["run_id", "frame_idx", "gt", "pr", "iou"])

    solved = hard.groupBy("run_id", "part").applyInPandas(assign, f"run_id {kind}, frame_idx int, gt string, pr string, iou double")
    return simple.unionByName(solved)


def frame_matches(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Per frame and threshold the matched pairs: run_id, frame_idx, alpha, gt, pr."""
    bars = F.filter(F.array(*map(F.lit, ALPHAS)), lambda a: F.col("iou") >= a - 1e-12)
    return best_pairs(truth, found).select("run_id", "frame_idx", F.explode(bars).alias("alpha"), "gt", "pr")


def hota(truth: DataFrame, found: DataFrame, kind: str = "int") -> DataFrame:
    """Per run: HOTA, DetA and AssA (means over the thresholds).

    A match counts at all thresholds up to its overlap, so each pair of tracks
    keeps one count per threshold in one row, and matches are never multiplied.
    """
    matches = best_pairs(truth, found, kind)
    n_gt, n_pr = (d.groupBy("run_id").agg(F.count("*").alias(c)) for d, c in ((truth, "n_gt"), (found, "n_pr")))
    at = [F.count_if(F.col("iou") >= a - 1e-12).alias(f"m{i}") for i, a in enumerate(ALPHAS)]
    each = matches.groupBy("run_id", "gt", "pr").agg(*at)
    t_gt = truth.groupBy("run_id", F.col("track_id").alias("gt")).agg(F.count("*").alias("t_gt"))
    t_pr = found.groupBy("run_id", F.col("track_id").alias("pr")).agg(F.count("*").alias("t_pr"))
    each = each.join(t_gt, ["run_id", "gt"]).join(t_pr, ["run_id", "pr"])
    seen = F.col("t_gt") + F.col("t_pr")
    sums = []
    for i in range(len(ALPHAS)):
        m = F.col(f"m{i}")
        sums += [F.sum(m).alias(f"tp{i}"), F.sum(m * m / (seen - m)).alias(f"w{i}")]
    per = n_gt.join(n_pr, "run_id", "full").join(each.groupBy("run_id").agg(*sums), "run_id", "left").na.fill(0)
    det = [F.col(f"tp{i}") / (F.col("n_gt") + F.col("n_pr") - F.col(f"tp{i}")) for i in range(len(ALPHAS))]
    ass = [F.when(F.col(f"tp{i}") > 0, F.col(f"w{i}") / F.col(f"tp{i}")).otherwise(0.0) for i in range(len(ALPHAS))]
    mean = lambda cs: F.round(sum(cs, F.lit(0.0)) / len(ALPHAS), 6)
    return per.select("run_id", mean([F.sqrt(d * a) for d, a in zip(det, ass, strict=True)]).alias("hota"), mean(det).alias("deta"), mean(ass).alias("assa"))


def mota(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Per run at IoU 0.5: matches, misses, false positives, identity switches and MOTA."""
    from pyspark.sql import Window

    m = frame_matches(truth, found).where(F.abs(F.col("alpha") - 0.5) < 1e-9)
    before = F.lag("pr").over(Window.partitionBy("run_id", "gt").orderBy("frame_idx"))
    m = m.withColumn("switch", (before.isNotNull() & (before != F.col("pr"))).cast("int"))
    n_gt, n_pr = (d.groupBy("run_id").agg(F.count("*").alias(c)) for d, c in ((truth, "n_gt"), (found, "n_pr")))
    s = n_gt.join(n_pr, "run_id", "left").join(m.groupBy("run_id").agg(F.count("*").alias("tp"), F.sum("switch").alias("idsw")), "run_id", "left").na.fill(0)
    fn, fp = F.col("n_gt") - F.col("tp"), F.col("n_pr") - F.col("tp")
    return s.select("run_id", "tp", fn.alias("fn"), fp.alias("fp"), "idsw", F.round(1 - (fn + fp + F.col("idsw")) / F.col("n_gt"), 6).alias("mota"))


def errors(truth: DataFrame, found: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Misses (`FN`) and false findings (`FP`) at an overlap: run_id, frame_idx, kind, track_id, x1, y1, x2, y2 to a tenth."""
    m = frame_matches(truth, found).where(F.abs(F.col("alpha") - alpha) < 1e-9)
    keys, tenths = ["run_id", "frame_idx", "track_id"], [F.round(c, 1).alias(c) for c in ("x1", "y1", "x2", "y2")]
    lost = truth.join(m.select("run_id", "frame_idx", F.col("gt").alias("track_id")), keys, "left_anti").select("run_id", "frame_idx", F.lit("FN").alias("kind"), "track_id", *tenths)
    wrong = found.join(m.select("run_id", "frame_idx", F.col("pr").alias("track_id")), keys, "left_anti").select("run_id", "frame_idx", F.lit("FP").alias("kind"), "track_id", *tenths)
    return lost.unionByName(wrong)


def by_condition(truth: DataFrame, found: DataFrame) -> DataFrame:
    """HOTA, DetA and AssA per run and condition (a column of both), and whether it is the run's weakest."""
    from pyspark.sql import Window

    conditions = truth.select("run_id", "condition").distinct()
    ids = conditions.withColumn("id", F.xxhash64("run_id", "condition"))
    swap = lambda d: d.join(ids, ["run_id", "condition"]).drop("run_id").withColumnRenamed("id", "run_id")
    s = hota(swap(truth), swap(found), kind="long").withColumnRenamed("run_id", "id").join(ids, "id").drop("id")
    least = F.row_number().over(Window.partitionBy("run_id").orderBy("hota", "condition")) == 1
    return s.withColumn("weakest", least)


def rule_scores(events: DataFrame, false_at: tuple[float, ...], tolerance: float, windows: list[tuple[float, float, int, bool]], reversals: tuple[tuple[float, float], ...]) -> DataFrame:
    """Per run of events (run_id, t): events, false_present, held_emitted, held_truth, tuned_emitted, tuned_truth, reversals.

    Times, windows (w0, w1, expected, tuned) and reversals are a handful of labels, so they are constants of the plan.
    """
    t = F.col("t")
    near = lambda a: F.coalesce(F.bool_or(F.abs(t - a) <= tolerance), F.lit(False))
    number = lambda flags: sum((f.cast("long") for f in flags), F.lit(0).cast("long"))
    inside = lambda tuned: number([F.count_if(t.between(a, b)) for a, b, _, k in windows if k == tuned])
    expected = lambda tuned: F.lit(sum(n for *_, n, k in windows if k == tuned)).cast("long")
    return events.groupBy("run_id").agg(
        F.count("*").alias("events"),
        number([near(a) for a in false_at]).alias("false_present"),
        inside(False).alias("held_emitted"),
        expected(False).alias("held_truth"),
        inside(True).alias("tuned_emitted"),
        expected(True).alias("tuned_truth"),
        number([near(a) & near(b) for a, b in reversals]).alias("reversals"),
    )
