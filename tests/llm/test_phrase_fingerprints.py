import hashlib
import random

from atrium.llm import phrase_fingerprints as P


def test_equal_substrings_share_names_at_any_offset():
    random.seed(1)
    part = "".join(random.choice("abcdefgh ijklmnop") for _ in range(600))
    a, b = P.phrases(["xyz" + part + "123"]), P.phrases(["q" * 17 + part + "ww"])
    for (_, x, _), (_, y, _) in list(zip(a, b))[:4]:
        assert len(set(x.tolist()) & set(y.tolist())) > 0.6 * len(y) - 4


def test_texts_do_not_depend_on_their_neighbours():
    texts = ["abc", "a", "aaaaaaa", "the quick brown fox " * 30, "ü漢" * 50, "", "abababab"]
    together = P.fingerprints(texts)
    assert together == [P.fingerprints([t])[0] for t in texts]
    assert together[5] == "." * 256 and len(set(together)) == len(texts)


def _expected(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (-r[0] if r[0] is not None else float("inf")))
    prints = dict(zip(range(len(order)), P.fingerprints([t for _, t in order])))
    out = {}
    for k, (i, t) in enumerate(order):
        n = (k + 1) % len(order)
        edited = t[: len(t) - len(t) // 2] + order[n][1][: len(t) // 2]
        e = P.fingerprints([edited])[0]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[k], e, P.likeness(prints[k], e), P.likeness(prints[k], prints[n]))
    return out


def _got(df):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in P.compared(df).collect()}


def test_against_a_plain_loop(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _got(docs) == _expected(rows)
    near = [(v[4], v[5]) for v in _got(docs).values()]
    assert sum(a > b for a, b in near) > 0.97 * len(near)


def test_odd_rows(odd_docs):
    some = odd_docs.where("doc_id is null or doc_id <> 15")
    assert _got(some) == _expected([(r["doc_id"], r["text"]) for r in some.collect()])
    assert P.compared(odd_docs).count() == odd_docs.count()


def test_one_and_none(odd_docs, no_docs):
    one = P.compared(odd_docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert P.compared(no_docs).count() == 0
