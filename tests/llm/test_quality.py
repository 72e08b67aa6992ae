import numpy as np

from atrium.llm import quality_classifier as Q


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r["keep"] for r in rows if r["quality"] == 1], [r["keep"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_odd_rows(odd_docs):
    rows = Q.quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and len(r["votes"]) == len(Q.LABELLERS)
        if r["doc_id"] in (0, 1, 2):
            assert r["score"] == 0 and not r["keep"]
    assert len({r["score"] for r in rows if r["doc_id"] == 15}) == 1


def test_empty(no_docs):
    assert Q.quality(no_docs).count() == 0


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.8
    hit = rng.random((20000, len(Q.LABELLERS))) < 0.6
    votes = np.where(~good[:, None] & hit, Q.BAD, Q.GOOD)
    patterns = ["".join(v) for v in votes]
    counts = {p: patterns.count(p) for p in set(patterns)}
    posterior = Q.estimate(counts)
    wrong = np.mean([(posterior[p] >= 0.5) != g for p, g in zip(patterns, good)])
    assert wrong < 0.01


def test_statistics():
    s = Q.statistics([b"a a a a", b"one two three", b"", b"x\nx\nx", b"AB ## | !!"])
    assert s["stutter"].round(3).tolist() == [0.75, 0, 0, 0.667, 0]
    assert s["words"].tolist() == [4, 3, 0, 3, 4]
    assert s["lines"].round(3).tolist() == [0, 0, 0, 0.667, 0]
    assert s["separators"].tolist()[-1] == 0.25 and s["symbols"].tolist()[-1] == 0.5
