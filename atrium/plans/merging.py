"""Queries on evidence, vetoes, doors and unions of fragments, and their calibration (tables E, G, K and P of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from atrium.operators import evidence as V
from atrium.operators import identity as I
from atrium.plans.identity import TRACK
from atrium.plans.identity import tracks as fragments
from atrium.plans.quality import RATES, SIMS, _sims, _sweep
from atrium.plans.registry import query
from atrium.sources.adapters import boxes, crossings, sightings, sql, table

#: Parts of the vector stand for the other kinds of evidence; every third fragment and most of staff show a face, and only those of staff may be compared.
MORE = "mt AS (SELECT *, vec[1:8] AS anchor, vec[9:16] AS hsv, vec[3:6] AS face, (CAST(track_id AS INT) % 3 = 0 OR CAST(track_id AS INT) % 7 > 1) AND role = 'staff' AS seen, CAST(track_id AS INT) % 5 = 4 AS infrared FROM trk)"
_COS = "list_cosine_similarity(a.{0}, b.{0}) AS {0}"
PAIRS = f"""pr AS (SELECT a.run_id, a.track_id AS a, b.track_id AS b, b.t_first - a.t_last AS gap, sqrt((a.x1 - b.x0) * (a.x1 - b.x0) + (a.y1 - b.y0) * (a.y1 - b.y0)) AS drift, list_cosine_similarity(a.vec, b.vec) AS sim, {', '.join(_COS.format(c) for c in ('anchor', 'hsv'))}, CASE WHEN a.seen AND b.seen THEN list_cosine_similarity(a.face, b.face) END AS face, a.infrared <> b.infrared AS other_light, a.role = b.role AS same_role
FROM mt a JOIN mt b ON a.run_id = b.run_id AND a.track_id <> b.track_id AND b.t_first - a.t_last >= 0 AND b.t_first - a.t_last <= 480)"""
TIERS = """ti AS (SELECT run_id, a, b, x.tier, x.score FROM pr, LATERAL (VALUES
('handoff', gap <= 2.5 AND drift <= 90.0 AND coalesce(anchor >= 0.3, true) AND (other_light OR NOT coalesce(hsv < 0.5, false)), 0.90 + 0.09 * (1 - drift / 90.0)),
('stationary', drift <= 30.0 AND coalesce(anchor >= 0.3, true) AND (other_light OR NOT coalesce(hsv < 0.5, false)), 0.85 + 0.09 * (1 - drift / 30.0)),
('gallery', sim >= 0.65 + 0.09 * least(greatest((gap - 15.0) / 165.0, 0.0), 1.0) AND NOT other_light AND NOT coalesce(hsv < 0.45, false), sim),
('anchor', coalesce(anchor, 0.0) >= 0.75 AND NOT other_light AND NOT coalesce(hsv < 0.45, false), 0.80 + 0.09 * least((anchor - 0.75) / 0.25, 1.0)),
('attire', hsv >= 0.75 AND NOT other_light, 0.76 + 0.06 * least((hsv - 0.75) / 0.25, 1.0)),
('face', face >= 0.35, 0.92 + 0.07 * least((face - 0.35) / 0.65, 1.0))) x(tier, ok, score) WHERE same_role AND coalesce(x.ok, false))"""
DOORS = [(0.0, 240.0), (640.0, 240.0)]
DIAGONAL = 800.0
_DOOR = "least(sqrt({x} * {x} + ({y} - 240.0) * ({y} - 240.0)), sqrt(({x} - 640.0) * ({x} - 640.0) + ({y} - 240.0) * ({y} - 240.0))) <= 80.0"
VERDICTS = f"""vd AS (SELECT p.*, CASE WHEN gap <= 10 THEN 'continuous' WHEN dead AND born THEN 'door_to_door' WHEN NOT dead AND NOT born AND drift <= 48.0 THEN 'occlusion_recovery' ELSE 'impossible' END AS verdict FROM (SELECT pr.*, {_DOOR.format(x='a.x1', y='a.y1')} AS dead, {_DOOR.format(x='b.x0', y='b.y0')} AS born FROM pr JOIN trk a ON a.run_id = pr.run_id AND a.track_id = pr.a JOIN trk b ON b.run_id = pr.run_id AND b.track_id = pr.b) p)"""


def tracks(spark, sf):
    n = F.col("track_id").cast("int")
    t = fragments(spark, sf)
    return t.withColumn("anchor", F.slice("vec", 1, 8)).withColumn("hsv", F.slice("vec", 9, 8)).withColumn("face", F.when((n % 3 == 0) | (n % 7 > 1), F.slice("vec", 3, 4))).withColumn("infrared", n % 5 == 4)


def _pairs(spark, sf):
    return V.pairs(tracks(spark, sf))


@query("k1_all_tiers", sql("SELECT run_id, a, b, tier, round(score, 6) AS score FROM ti", TRACK, MORE, PAIRS, TIERS))
def k1(spark, sf):
    """All six tiers with their vetoes."""
    return V.tiers(_pairs(spark, sf)).withColumn("score", F.round("score", 6))


@query("k1_candidate_tiers", sql("SELECT run_id, a, b, arg_max(tier, {'s': score, 't': tier}) AS tier, round(max(score), 5) AS score FROM ti GROUP BY ALL", TRACK, MORE, PAIRS, TIERS))
def k1_best(spark, sf):
    """The tier that says most for a pair."""
    best = V.tiers(_pairs(spark, sf)).groupBy("run_id", "a", "b").agg(F.max(F.struct("score", "tier")).alias("e"))
    return best.select("run_id", "a", "b", "e.tier", F.round("e.score", 5).alias("score"))


def merged(spark, sf):
    """Fragments to identities, on all six tiers."""
    t = tracks(spark, sf)
    return I.constrained_groups(t, V.tiers(_pairs(spark, sf)))


@query("k1_constrained_merge")
def k1_merge(spark, sf):
    return merged(spark, sf)


@query("k20_dossiers")
def k20(spark, sf):
    return I.dossiers(merged(spark, sf), tracks(spark, sf))


@query("o2_sql_functions", sql("SELECT a.run_id, a.track_id AS a, b.track_id AS b, round(list_cosine_similarity(a.vec, b.vec), 6) AS likeness FROM trk a JOIN trk b ON b.run_id = a.run_id AND CAST(b.track_id AS INT) = CAST(a.track_id AS INT) + 1", TRACK))
def o2(spark, sf):
    """A likeness that SQL text calls by its name."""
    from atrium.functions.sql import register

    register(spark)
    text = "SELECT a.run_id, a.track_id AS a, b.track_id AS b, round(likeness(a.vec, b.vec), 6) AS likeness FROM {t} a JOIN {t} b ON b.run_id = a.run_id AND int(b.track_id) = int(a.track_id) + 1"
    return spark.sql(text, t=fragments(spark, sf))


@query("o1_table_function", sql("SELECT run_id, track_id, min(t) AS t_in, max(t) AS t_out, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR t - p > 15.0 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, track_id ORDER BY t) AS g FROM (SELECT *, lag(t) OVER (PARTITION BY run_id, track_id ORDER BY t) AS p FROM v_sighting)) GROUP BY run_id, track_id, g"))
def o1(spark, sf):
    """Stretches by a table function that SQL text calls on a partitioned and ordered table."""
    from atrium.functions.sql import register

    register(spark)
    rows = sightings(spark, sf).select(F.concat_ws("|", F.col("run_id").cast("string"), "track_id").alias("key"), "t")
    out = spark.sql("SELECT * FROM stretches(TABLE(SELECT key, t FROM {rows}) PARTITION BY (key) ORDER BY (t), 15.0D)", rows=rows)
    return out.select(F.substring_index("key", "|", 1).cast("int").alias("run_id"), F.substring_index("key", "|", -1).alias("track_id"), "t_in", "t_out", "n")


@query("k3_colour_galleries", "SELECT a.vec_id // 6 AS g, round(max(list_cosine_similarity(CAST(a.embedding AS DOUBLE[])[9:16], CAST(b.embedding AS DOUBLE[])[9:16])), 5) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id // 6 = a.vec_id // 6 + 1 GROUP BY 1")
def k3(spark, sf):
    """Best colour likeness between a gallery and the next one; six crops are a gallery."""
    from atrium.functions.geometry import cosine

    g = table(spark, sf, "embeddings").groupBy(F.expr("vec_id div 6").alias("g")).agg(F.collect_list(F.slice("embedding", 9, 8)).alias("v"))
    p = g.join(g.select((F.col("g") - 1).alias("g"), F.col("v").alias("w")), "g")
    return p.select("g", F.round(F.array_max(F.transform("v", lambda x: F.array_max(F.transform("w", lambda y: cosine(x, y))))), 5).alias("sim"))


@query("k5_colour_veto", sql("SELECT run_id, a, b FROM pr WHERE hsv < 0.45", TRACK, MORE, PAIRS))
def k5(spark, sf):
    return _pairs(spark, sf).where(V.colour_contradicts(F.col("hsv"))).select("run_id", "a", "b")


@query("k6_handoff_colour_veto", sql("SELECT run_id, a, b FROM pr WHERE gap <= 2.5 AND hsv < 0.5 AND NOT other_light", TRACK, MORE, PAIRS))
def k6(spark, sf):
    p = _pairs(spark, sf).where((F.col("gap") <= V.HANDOFF_GAP) & ~F.col("other_light"))
    return p.where(V.colour_contradicts(F.col("hsv"), V.HANDOFF_HSV_VETO)).select("run_id", "a", "b")


@query("k9_colour_check", sql("SELECT run_id, a, b, CASE WHEN canon AND (hsv >= 0.6 OR anchor >= 0.75) THEN 'agree' WHEN canon THEN 'disagree' ELSE 'colour_only' END AS says FROM (SELECT *, CAST(a AS INT) // 10 = CAST(b AS INT) // 10 AS canon FROM pr) WHERE canon OR hsv >= 0.6 OR anchor >= 0.75", TRACK, MORE, PAIRS))
def k9(spark, sf):
    """Pairs of one identity that colours confirm or not, and pairs of two that only colours would join; tens of ids stand for identities."""
    like = (F.col("hsv") >= 0.6) | (F.col("anchor") >= 0.75)
    one = F.floor(F.col("a").cast("int") / 10) == F.floor(F.col("b").cast("int") / 10)
    says = F.when(one & like, "agree").when(one, "disagree").when(like, "colour_only")
    return _pairs(spark, sf).select("run_id", "a", "b", says.alias("says")).where("says is not null")


def _judged(spark, sf):
    return V.with_verdicts(_pairs(spark, sf), tracks(spark, sf), DOORS, DIAGONAL)


@query("k14_topology_veto", sql("SELECT t.run_id, t.a, t.b, t.tier, v.verdict <> 'impossible' AS allowed FROM ti t JOIN vd v USING (run_id, a, b)", TRACK, MORE, PAIRS, TIERS, VERDICTS))
def k14(spark, sf):
    """Accepted pairs, and whether doors and places allow them."""
    p = _judged(spark, sf)
    return V.tiers(p).join(p.select("run_id", "a", "b", "verdict"), ["run_id", "a", "b"]).select("run_id", "a", "b", "tier", (F.col("verdict") != "impossible").alias("allowed"))


@query("k16_vetoed_pairs", sql("SELECT run_id, verdict, count(*) AS n FROM vd GROUP BY ALL", TRACK, MORE, PAIRS, VERDICTS))
def k16(spark, sf):
    return _judged(spark, sf).groupBy("run_id", "verdict").agg(F.count("*").alias("n"))


@query("k18_doors_from_endpoints", sql("SELECT run_id, gx, gy, n, gx * 96.0::DOUBLE + 48.0 AS x, gy * 96.0::DOUBLE + 48.0 AS y FROM (SELECT run_id, CAST(floor(x0 / 96) AS INT) AS gx, CAST(floor(y0 / 96) AS INT) AS gy, count(*) AS n FROM trk GROUP BY ALL) WHERE n >= 3", TRACK))
def k18(spark, sf):
    """Centres of the cells in which fragments begin often."""
    g = tracks(spark, sf).groupBy("run_id", F.floor(F.col("x0") / 96).cast("int").alias("gx"), F.floor(F.col("y0") / 96).cast("int").alias("gy")).agg(F.count("*").alias("n")).where("n >= 3")
    return g.select("run_id", "gx", "gy", "n", (F.col("gx") * 96.0 + 48.0).alias("x"), (F.col("gy") * 96.0 + 48.0).alias("y"))


@query("k12_greedy_replay")
def k12(spark, sf):
    """What becomes of each accepted pair when unions are replayed; its brute-force version is a test."""
    return V.replay(tracks(spark, sf), V.tiers(_pairs(spark, sf)))[0]


@query("k13_topology_comparison")
def k13(spark, sf):
    """Unions with and without pairs that doors forbid: accepted, blocked and identities of each, per run."""
    t, p = tracks(spark, sf), _judged(spark, sf)

    def outcome(edges, name):
        done, mapping = V.replay(t, edges)
        n = done.groupBy("run_id").agg(F.count_if("accepted").alias(f"accepted_{name}"), F.count_if(~F.col("accepted")).alias(f"blocked_{name}"))
        ids = mapping.groupBy("run_id").agg(F.count_distinct("canon").alias(f"identities_{name}"))
        return ids.join(n, "run_id", "left").na.fill(0)

    return outcome(V.tiers(p), "without").join(outcome(V.tiers(p.where("verdict <> 'impossible'")), "with"), "run_id")


@query("k7_face_veto")
def k7(spark, sf):
    """Identities after weak unions that faces contradict are taken back."""
    t, p = tracks(spark, sf), _pairs(spark, sf)
    e = V.tiers(p)
    done = V.replay(t, e)[0].where("accepted").join(e, ["run_id", "a", "b", "tier"]).select("run_id", "a", "b", "score")
    return V.united(t, V.face_veto(done, p).where("says <> 'vetoed'"))


@query("k11_fused_graph")
def k11(spark, sf):
    """Cheapest unions first; pairs of different roles, or in other light and far apart, are forbidden."""
    p = _pairs(spark, sf)
    cost = 0.45 * (1 - F.col("sim")) + 0.25 * F.least(F.col("drift") / DIAGONAL, F.lit(1.0)) + 0.3 * 0.5
    banned = ~F.col("same_role") | (F.col("other_light") & (F.col("drift") > 400))
    return V.fused(tracks(spark, sf), p.select("run_id", "a", "b", F.when(~banned, F.round(cost, 9)).alias("cost")))


@query("k19_resolved_identities")
def k19(spark, sf):
    """From fragments to identities: candidates, veto by doors, tiers, replay."""
    t = tracks(spark, sf)
    e = V.tiers(_judged(spark, sf).where("verdict <> 'impossible'"))
    return V.replay(t, e)[1]


COMPONENTS = """un AS (SELECT run_id, a, b FROM ti WHERE tier = 'face' UNION SELECT run_id, b, a FROM ti WHERE tier = 'face'),
reach AS (WITH RECURSIVE r AS (SELECT run_id, track_id, CAST(track_id AS INT) AS o FROM trk UNION SELECT r.run_id, u.b, r.o FROM r JOIN un u ON u.run_id = r.run_id AND u.a = r.track_id) SELECT * FROM r)"""


@query("k23_union_find", sql("SELECT run_id, o AS least, count(*) AS members FROM (SELECT run_id, track_id, min(o) AS o FROM reach GROUP BY ALL) GROUP BY ALL", TRACK, MORE, PAIRS, TIERS, COMPONENTS))
def k23(spark, sf):
    """Groups that faces alone make, without constraints."""
    t = tracks(spark, sf)
    g = V.grouped(t.select("run_id", "track_id"), V.tiers(_pairs(spark, sf)).where("tier = 'face'"))
    n = g.groupBy("run_id", "part").agg(F.min(F.col("track_id").cast("int")).alias("least"), F.count("*").alias("members"))
    return n.drop("part")


@query("p71_unmerged_near_pairs", sql("SELECT run_id, a, b, round(drift, 5) AS drift FROM (SELECT p.*, CAST(a AS INT) // 10 <> CAST(b AS INT) // 10 AS apart FROM pr p JOIN (SELECT run_id, track_id, row_number() OVER (PARTITION BY run_id ORDER BY t_first, track_id) AS n FROM trk) f ON f.run_id = p.run_id AND f.track_id = p.a AND f.n <= 400) WHERE apart AND drift <= 150.0", TRACK, MORE, PAIRS))
def p71(spark, sf):
    """Of each run's first 400 fragments, those that another identity's birth follows nearby: a report of at most so many."""
    t = tracks(spark, sf)
    n = F.row_number().over(Window.partitionBy("run_id").orderBy("t_first", "track_id"))
    first = t.select("run_id", F.col("track_id").alias("a"), n.alias("n")).where("n <= 400")
    apart = F.floor(F.col("a").cast("int") / 10) != F.floor(F.col("b").cast("int") / 10)
    p = I.candidates(t).join(first, ["run_id", "a"]).where(apart & (F.col("drift") <= 150.0))
    return p.select("run_id", "a", "b", F.round("drift", 5).alias("drift"))


@query("e3_remapped_tables", sql("SELECT 'box' AS source, run_id, CASE WHEN track_id LIKE 'm%' THEN substr(track_id, 2) ELSE track_id END AS track_id, count(*) AS n FROM v_box GROUP BY ALL UNION ALL SELECT 'crossing', run_id, track_id, count(*) FROM v_crossing GROUP BY ALL UNION ALL SELECT 'sighting', run_id, track_id, count(*) FROM v_sighting GROUP BY ALL"))
def e3(spark, sf):
    """One mapping over boxes, crossings and sightings."""
    b = boxes(spark, sf)
    mapping = b.where("track_id like 'm%'").select("run_id", "track_id").distinct().withColumn("canon", F.expr("substr(track_id, 2)"))
    out = None
    for name, rows in (("box", b), ("crossing", crossings(spark, sf)), ("sighting", sightings(spark, sf))):
        n = I.remap(rows.select("run_id", "track_id"), mapping).groupBy("run_id", "track_id").agg(F.count("*").alias("n")).withColumn("source", F.lit(name))
        out = n if out is None else out.unionByName(n)
    return out


# Calibration.

CAL = """sm AS (SELECT run_id, gap, drift, sim, CASE WHEN gap <= 20.0 AND drift <= 260.0 OR gap <= 60.0 AND drift <= 30.0 THEN 'same' WHEN gap <= 2.0 AND drift > 400.0 THEN 'different' END AS kind FROM pr WHERE same_role)"""


def _calibration(spark, sf):
    kind = F.when(((F.col("gap") <= 20.0) & (F.col("drift") <= 260.0)) | ((F.col("gap") <= 60.0) & (F.col("drift") <= 30.0)), "same").when((F.col("gap") <= 2.0) & (F.col("drift") > 400.0), "different")
    return _pairs(spark, sf).where("same_role").withColumn("kind", kind).where("kind is not null")


@query("g60_calibration_samples", sql("SELECT kind, count(*) AS n, round(quantile_cont(sim, 0.1), 6) AS p10, round(quantile_cont(sim, 0.5), 6) AS p50, round(quantile_cont(sim, 0.9), 6) AS p90 FROM sm WHERE kind IS NOT NULL GROUP BY kind", TRACK, MORE, PAIRS, CAL))
def g60(spark, sf):
    """Likeness of pairs that movement proves to be one person or two, whatever they look like."""
    q = lambda p: F.round(F.percentile("sim", p), 6)
    return _calibration(spark, sf).groupBy("kind").agg(F.count("*").alias("n"), q(0.1).alias("p10"), q(0.5).alias("p50"), q(0.9).alias("p90"))


@query("g61_calibrations_compared", sql("SELECT kind, count(*) AS n_all, count(*) FILTER (sim >= 0.3) AS n_vetoed_out, round(avg(sim), 6) AS mean_all, round(avg(sim) FILTER (sim >= 0.3), 6) AS mean_vetoed_out FROM sm WHERE kind IS NOT NULL GROUP BY kind", TRACK, MORE, PAIRS, CAL))
def g61(spark, sf):
    """With and without the older rule's appearance veto, which flatters the separation."""
    seen = F.when(F.col("sim") >= 0.3, F.col("sim"))
    return _calibration(spark, sf).groupBy("kind").agg(F.count("*").alias("n_all"), F.count(seen).alias("n_vetoed_out"), F.round(F.avg("sim"), 6).alias("mean_all"), F.round(F.avg(seen), 6).alias("mean_vetoed_out"))


@query("g62_suggested_thresholds", sql(
    "SELECT la AS label, round(least(greatest(s, 0.35), 0.85), 3) AS threshold, round(least(greatest(s + CASE WHEN p10 > p90 THEN 0.08 ELSE 0.10 END, 0.35), 0.85), 3) AS anchor FROM (SELECT *, CASE WHEN p10 > p90 THEN (p10 + p90) / 2 ELSE p90 + 0.02 END AS s FROM (SELECT la, quantile_cont(s, 0.1) FILTER (la = lb) AS p10, quantile_cont(s, 0.9) FILTER (la <> lb) AS p90 FROM sims GROUP BY la)) WHERE s IS NOT NULL", SIMS))
def g62(spark, sf):
    """From the tails of both kinds of pairs, per label: between them if they are apart, just above the different ones if not."""
    from atrium.functions.geometry import cosine

    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    far = e.select(F.explode(F.array(F.lit(1), F.lit(7))).alias("d"), F.col("vec_id").alias("v"), F.col("label").alias("lb"), F.col("embedding").alias("other")).withColumn("vec_id", F.col("v") - F.col("d"))
    s = e.join(far, "vec_id").withColumn("s", cosine(F.col("embedding"), F.col("other")))
    same = F.col("label") == F.col("lb")
    q = s.groupBy("label").agg(F.percentile(F.when(same, F.col("s")), 0.1).alias("p10"), F.percentile(F.when(~same, F.col("s")), 0.9).alias("p90"))
    apart = F.col("p10") > F.col("p90")
    q = q.withColumn("s", F.when(apart, (F.col("p10") + F.col("p90")) / 2).otherwise(F.col("p90") + 0.02)).where("s is not null and p10 is not null")
    bound = lambda c: F.round(F.least(F.greatest(c, F.lit(0.35)), F.lit(0.85)), 3)
    return q.select("label", bound(F.col("s")).alias("threshold"), bound(F.col("s") + F.when(apart, 0.08).otherwise(0.10)).alias("anchor"))


@query("p10_thresholds_compared", sql(
    "SELECT round(c.fa, 6) AS fa_now, round(c.fr, 6) AS fr_now, round(8 * c.fa + c.fr, 6) AS cost_now, b.th AS suggested, round(8 * b.fa + b.fr, 6) AS cost, CASE WHEN b.th > 0.62 THEN 'more conservative' WHEN b.th < 0.62 THEN 'more aggressive' ELSE 'unchanged' END AS direction FROM (SELECT * FROM rates WHERE abs(th - 0.62) < 1e-9) c, (SELECT * FROM rates ORDER BY round(8 * fa + fr, 9), th DESC LIMIT 1) b", SIMS, RATES))
def p10(spark, sf):
    """What the bar in use costs, and what the cheapest one would."""
    r = _sweep(spark, sf, 100).withColumn("cost", 8 * F.col("fa") + F.col("fr"))
    now = F.max(F.when(F.abs(F.col("th") - 0.62) < 1e-9, F.struct("fa", "fr", "cost"))).alias("now")
    best = F.min(F.struct(F.round("cost", 9).alias("c"), (-F.col("th")).alias("less"), "th", "cost")).alias("best")
    o = r.agg(now, best)
    th = F.col("best.th")
    return o.select(F.round("now.fa", 6).alias("fa_now"), F.round("now.fr", 6).alias("fr_now"), F.round("now.cost", 6).alias("cost_now"), th.alias("suggested"), F.round("best.cost", 6).alias("cost"), F.when(th > 0.62, "more conservative").when(th < 0.62, "more aggressive").otherwise("unchanged").alias("direction"))


@query("p24_staff_gallery", sql("SELECT t.run_id, t.track_id, CASE WHEN t.track_id LIKE '%9' THEN -1.0 ELSE round(coalesce(max(list_cosine_similarity(t.vec, s.vec)), -1.0), 6) END AS sim FROM trk t LEFT JOIN trk s ON s.run_id = t.run_id AND s.role = 'staff' AND s.track_id <> t.track_id GROUP BY t.run_id, t.track_id", TRACK))
def p24(spark, sf):
    """Best likeness to any enrolled shot of staff; -1 where there is nothing to compare."""
    from atrium.functions.geometry import cosine

    t = tracks(spark, sf)
    shots = t.where("role = 'staff'").select("run_id", F.col("track_id").alias("s"), F.col("vec").alias("w"))
    j = t.join(shots, "run_id", "left")
    best = F.max(F.when(F.col("s") != F.col("track_id"), cosine(F.col("vec"), F.col("w"))))
    g = j.groupBy("run_id", "track_id").agg(F.round(F.coalesce(best, F.lit(-1.0)), 6).alias("sim"))
    return g.withColumn("sim", F.when(F.col("track_id").endswith("9"), -1.0).otherwise(F.col("sim")))
