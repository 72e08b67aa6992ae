import random
import re

import pytest

from atrium.llm import minhash_dedup as M
from atrium.llm.shingles import shingle_sets


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _set(t, k):
    w = _words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    """Components by comparing all pairs."""
    sets = [(i, _set(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}, sets


@pytest.mark.parametrize("k", [2, 5])
def test_against_all_pairs(docs, k):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, sets = brute(rows, k)
    got = {r["doc_id"]: r for r in M.near_duplicates(docs, shingle=k).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(s) for i, s in sets)
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_families_whose_members_do_not_all_match_the_first(spark, monkeypatch):
    """Chains of drifting copies: a bucket's first member is unlike its last ones."""
    monkeypatch.setattr(M, "BLOCK", 8)
    random.seed(4)
    rows = []
    for f in range(6):
        words = [f"w{random.randrange(400)}" for _ in range(120)]
        for _ in range(30):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(3):
                words[random.randrange(len(words))] = f"n{random.randrange(10**6)}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(df).collect()}
    assert got == brute(rows, 2)[0]


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want, _ = brute(rows, 2)
    got = M.near_duplicates(odd_docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]]
    assert want[5] == 3 and want[10] == 9 and want[7] == 6


def test_empty(no_docs):
    assert M.near_duplicates(no_docs).count() == 0


def test_sets():
    a, b, c, d, e = shingle_sets([b"A b c", b"a\tB\n c ", b"a", b"", b"a b"], 2)
    assert a.tolist() == b.tolist() and len(a) == 2 and len(c) == 1 and len(d) == 0 and len(e) == 1 and e[0] in a
