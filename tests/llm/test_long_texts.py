"""Texts longer than the pieces that are worked on together, with the pieces made small, and one of three megabytes."""

import public_tokenizers
import pytest

from atrium.llm import best_fit_packing, bpe_lexicon, language_id, phrase_fingerprints, quality_classifier, shingles
from atrium.llm.minhash_dedup import near_duplicates
from tests.llm.test_packing import check

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_small_pieces_give_the_same(monkeypatch, odd_docs):
    some = odd_docs.select("doc_id", "text", "lang").where("doc_id is null or doc_id <> 15")
    own = [r["text"] or "" for r in some.collect()]
    whole = phrase_fingerprints.fingerprints(own), shingles.shingle_sets(shingles.as_bytes(own), 2), language_id.train(some).label(own)
    for module in (best_fit_packing, bpe_lexicon, language_id, phrase_fingerprints):
        monkeypatch.setattr(module, "_CHUNK", 50)
    single = [phrase_fingerprints.fingerprints([t])[0] for t in own]
    assert single == whole[0]
    sets = [s for a, b in shingles.chunks(shingles.as_bytes(own), 50) for s in shingles.shingle_sets(shingles.as_bytes(own)[a:b], 2)]
    assert [s.tolist() for s in sets] == [s.tolist() for s in whole[1]]
    model = language_id.train(some)
    assert [r for a, b in language_id._chunks(own) for r in model.label(own[a:b])] == whole[2]


@pytest.fixture(scope="module")
def long_docs(spark):
    words = [f"w{i * 7919 % 5003} der{i % 17} the" for i in range(170_000)]
    text = " ".join(words)
    assert len(text) > 2_500_000
    return spark.createDataFrame([(1, text), (2, text + " end"), (3, "short text of a few words"), (4, None), (5, text[::-1])], "doc_id long, text string").repartition(2)


def test_three_megabytes(spark, long_docs):
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(long_docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    rows = [(r["doc_id"], r["text"]) for r in long_docs.collect()]
    check(best_fit_packing.packed(long_docs, BYTE).collect(), rows)
    got = {r["doc_id"]: r for r in phrase_fingerprints.compared(long_docs).collect()}
    assert got[2]["near_next"] > 0.9 and got[5]["near_next"] < 0.1 and got[1]["n_chars"] == len(dict(rows)[1])
    from tests.llm.test_bpe_lexicon import _want

    small = long_docs.where("doc_id in (1, 4)")
    assert {tuple(r) for r in bpe_lexicon.bpe_round_trip(small, WORD).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == set(_want([(i, t) for i, t in rows if i in (1, 4)]))
    assert len(quality_classifier.quality(long_docs).collect()) == 5
