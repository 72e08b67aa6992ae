import numpy as np

from atrium.llm import quality_classifier as Q


def test_planted_rates_are_recovered():
    """Under a wide prior, EM finds the rates of independent labellers, one of which has 5 % false alarms."""
    rng = np.random.default_rng(1)
    n = 60_000
    bad = rng.random(n) < 0.15
    said = np.where(rng.random((n, len(Q.LABELLERS))) < np.where(bad[:, None], 0.5, 0.0005), Q.BAD, Q.GOOD)
    said[:, 0] = np.where(~bad & (rng.random(n) < 0.05), Q.BAD, said[:, 0])
    counts = {}
    for row in said:
        p = "".join(row)
        counts[p] = counts.get(p, 0) + 1
    posterior, rates = Q.fitted(counts, false_alarms=0.5)
    assert abs(rates[1, 0, 0] - 0.05) < 0.01 and abs(rates[0, 1, 0] - 0.5) < 0.02
    assert posterior[Q.BAD + Q.GOOD * 7] > 0.5 and posterior[Q.BAD * 3 + Q.GOOD * 5] < 0.01


def test_estimate_against_plain_loops():
    counts = {"11111111": 500, "01111111": 12, "00111111": 20, "1111111-": 40, "--------": 3}
    good = {p: 0.1 if "0" in p else 0.9 for p in counts}
    for _ in range(100):
        n_good = sum(c * good[p] for p, c in counts.items())
        n_bad = sum(c * (1 - good[p]) for p, c in counts.items())
        total = n_good + n_bad
        rate = {}
        for k, weight in ((0, lambda p: 1 - good[p]), (1, lambda p: good[p])):
            for at in range(8):
                votes = {v: 0.1 + sum(c * weight(p) for p, c in counts.items() if p[at] == v) for v in "01-"}
                for v in "01-":
                    rate[k, at, v] = votes[v] / sum(votes.values())
                if k:
                    rate[k, at, "0"] = min(rate[k, at, "0"], Q.FALSE_ALARMS)
        new = {}
        for p in counts:
            a, b = np.log((n_bad + 1) / (total + 2)), np.log((n_good + 1) / (total + 2))
            for at, v in enumerate(p):
                a, b = a + np.log(rate[0, at, v]), b + np.log(rate[1, at, v])
            new[p] = 1 / (1 + np.exp(a - b))
        good = new
    got = Q.estimate(counts)
    assert all(abs(got[p] - good[p]) < 1e-9 for p in counts)


def test_model_does_not_depend_on_partitions(spark, docs):
    rows = docs.unionByName(docs.where("doc_id < 5"))
    a, b = Q.train(rows.repartition(3), 50), Q.train(rows.repartition(17), 50)
    assert a.posterior == b.posterior and np.array_equal(a.weights, b.weights) and a.bias == b.bias
