from pyspark.sql import functions as F

import corpus_pipeline as C
from atrium.llm import language_id, quality_classifier
from tests.llm.test_minhash_dedup import brute
from tests.llm.test_packing import check


def test_stages_against_plain_python(spark, sf, docs):
    rows = docs.collect()
    stage = {name: f for name, f in C.STAGES}
    kept = stage["quality"](spark, docs, sf)
    assert kept.columns == docs.columns
    decided = {r["doc_id"]: r["keep"] for r in quality_classifier.quality(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k in decided.items() if k)
    named = stage["language"](spark, kept, sf)
    assert named.columns == docs.columns
    model = language_id.train(kept)
    texts = kept.collect()
    found = model.label([r["text"] for r in texts])
    assert sorted(r["doc_id"] for r in named.collect()) == sorted(r["doc_id"] for r, f in zip(texts, found) if f[0] != "und" and f[1] >= C.MIN_SHARE)
    single = stage["near_dedup"](spark, named, sf)
    assert single.columns == docs.columns
    component, _ = brute([(r["doc_id"], r["text"]) for r in named.collect()], 5)
    left = single.collect()
    assert sorted(r["doc_id"] for r in left) == sorted({*component.values()})
    out = C.run(spark, sf).collect()
    check(out, [(r["doc_id"], r["text"]) for r in left])
    assert len({r["doc_id"] for r in out}) < len(rows)


def test_odd_rows(spark, odd_docs, no_docs, sf):
    for name, f in C.STAGES:
        assert f(spark, no_docs, sf).count() == 0
        f(spark, odd_docs, sf).count()
    kept = C.dedup_stage(spark, odd_docs, sf).collect()
    assert any(r["doc_id"] is None for r in kept)


def test_odd_rows_keep_their_columns(spark, odd_docs, sf):
    """Columns named like those that the stages use inside, nulls, blanks and repeated rows: what each stage keeps is defined."""
    docs = odd_docs
    for name in ("_language", "_row", "key", "language", "component_id"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = [tuple(r) for r in docs.collect()]
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, sf)
        assert out.columns == docs.columns
        assert set(map(tuple, out.collect())) <= set(rows)
    texts = {r["text"] for r in C.quality_stage(spark, docs, sf).collect()}
    assert not texts & {None, "", "  \n\t "}
    assert "!!! ### $$$ ???" not in {r["text"] for r in C.language_stage(spark, docs, sf).collect()}
    assert sum(r["doc_id"] == 15 for r in C.dedup_stage(spark, docs, sf).collect()) == 1


def test_dedup_decides_per_row(spark, sf):
    text = "The house on the hill is old and the road to it is long."
    other = "Nobody else has ever written about seven green boats under that bridge."
    # Repeated rows leave one; a text of its own stays although its doc_id is on a dropped text too.
    rows = [(4, text), (4, text), (7, text), (7, other), (9, None), (9, None)]
    kept = C.dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), sf).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(4, text), (7, other), (9, ""), (9, "")]
