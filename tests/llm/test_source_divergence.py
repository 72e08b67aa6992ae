"""Stripes against dicts of dicts."""

import random
import re
from collections import Counter, defaultdict

from atrium.llm import source_divergence
from atrium.llm.source_divergence import divergences, terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, top=200):
    """rows: text, lang, source."""
    docs, counts, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter)), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        docs[lang].update(set(found))
        counts[lang][source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        v = len(kept)

        def shares(count, kept=kept, v=v):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + v) for t in kept}

        p = {s: shares(counts[lang][s]) for s in sources}
        q = shares(sum(counts[lang].values(), Counter()))
        for s in sources:
            pair = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            term = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang][s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(sorted(items))]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def test_against_dicts(spark, docs):
    some = docs.repartition(5)
    want = plain([tuple(r) for r in some.select("text", "lang", "source").collect()])
    assert got(divergences(some)) == want
    assert got(divergences(some, entries=50)) == want  # spills often


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(None, None, None), ("", "en", "a"), ("a B a Ä-ä é", None, "a"), ("b a", "", None), ("A ä b", "", "b"), ("x" * 30 + " a", "", "b"), ("1 2 !", "de", "a"), ("1", "de", "b"), ("z", "fr", "a")]
    df = spark.createDataFrame([(*r, "v") for r in rows * 2], "text string, lang string, source string, value string")
    assert got(divergences(df)) == plain(rows * 2)
    odd = odd_docs.select("text", "lang", "source")
    assert got(divergences(odd_docs)) == plain([tuple(r) for r in odd.collect()])
    assert got(divergences(no_docs)) == []


def test_many_sources_and_large_counts(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choices("abcdefghij", [2**k for k in range(10)], k=rng.randint(1, 60))) + " q" * rng.choice([0, 0, 9000]), rng.choice("xy"), f"s{rng.randint(0, 30)}") for _ in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert got(divergences(df)) == plain(rows)


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(source_divergence, "PART", 7)
    text = "Abc déf" + " x" * 20 + "LONGWORDLONGWORD end"
    assert [t.decode() for part in terms(text) for t in part] == TERM.findall("abc déf" + " x" * 20 + "longwordlongword end")
