import itertools
import zlib

import numpy as np

from atrium.llm import language_id as L


def test_best_path_is_the_best_of_all():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(0, 7, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(size=(first[-1], 3)) * 3
        path = L.best_path(scores, first, 2.0)
        for a, b in zip(first[:-1], first[1:]):
            value = lambda q: sum(scores[a + i, x] for i, x in enumerate(q)) - 2.0 * sum(x != y for x, y in zip(q, q[1:]))
            if b > a:
                assert abs(value(path[a:b]) - max(map(value, itertools.product(range(3), repeat=b - a)))) < 1e-9


def test_long_text_across_blocks():
    scores = np.random.default_rng(1).normal(size=(1000, 4))
    path = L.best_path(scores, np.array([0, 1000]), 1.5)
    v = scores[0].copy()
    for s in scores[1:]:
        v = np.maximum(v, v.max() - 1.5) + s
    assert abs(v.max() - (scores[np.arange(1000), path].sum() - 1.5 * (np.diff(path) != 0).sum())) < 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98


def test_mixed_text_has_spans_and_scripts_narrow(spark):
    rows = [("the house on the hill and the road to the town with the man", "en"), ("der mann und das haus auf dem berg und die stadt mit der frau", "de"), ("дом на горе и дорога к городу с человеком", "ru")] * 5
    model = L.train(spark.createDataFrame(rows, "text string, lang string"))
    text = "the road to the town on the hill und die frau mit der stadt auf dem berg дорога"
    (_, share, spans), (other, *_), (und, score, none) = model.label([text, "город", "123 ?!"], penalty=4.0)
    assert [s[2] for s in spans] == ["en", "de", "ru"] and 0 < share < 1
    assert text[spans[1][0] : spans[1][1]].startswith("und") and text[spans[2][0] :] == "дорога"
    assert other == "ru" and (und, score, none) == ("und", 0.0, [])


def test_odd_rows(odd_docs):
    rows = L.language_id(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (0, 1, 2, 11))


def test_empty_and_nothing_to_learn(no_docs, odd_docs):
    assert L.language_id(no_docs).count() == 0
    only = odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 1)).where("doc_id = 3").selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert [r["lang_pred"] for r in L.language_id(only).collect()] == ["und"]
