import numpy as np

from atrium.llm import embedding_dedup as E


def _brute(rows, threshold=0.93):
    by = {}
    for i, v, lab in rows:
        x = None if v is None or lab is None or i is None or any(y is None for y in v) else np.array(v, float)
        if x is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0:
            by.setdefault((lab, len(x)), []).append((i, x / np.linalg.norm(x)))
    links = {}
    for some in by.values():
        for a, x in some:
            for b, y in some:
                if a != b and x @ y >= threshold:
                    links.setdefault(a, set()).add(b)
    label = {i: i for i, *_ in rows if i is not None}
    while True:
        new = {i: min([label[i], *(label[j] for j in links.get(i, ()))]) for i in label}
        if new == label:
            return {i: (len(links.get(i, ())), label[i]) for i in label}
        label = new


def test_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        base = rng.normal(size=16)
        for noise in (0, 0, 0.02, 0.1, 0.3, 0.36, 0.4):
            rows.append((len(rows), [float(v) for v in np.float32(base + noise * rng.normal(size=16))], c % 3))
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [None, *[1.0] * 15], 1), (204, rows[0][1], None), (205, [], 1), (206, [float("inf"), *[1.0] * 15], 1), (207, [1e-30] * 16, 2), (208, [3.0, 4.0], 2), (209, [6.0, 8.0], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(None, rows[0][1], 0, "x")], "vec_id long, embedding array<float>, label int, codes string").repartition(4)
    got = E.near_vectors(df).collect()
    assert len(got) == len(rows) + 1
    want = _brute([(i, None if v is None else [None if y is None else float(np.float32(y)) for y in v], lab) for i, v, lab in rows])
    named = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None}
    # Hashing may miss a pair at the limit, with probability 0.002.
    assert sum(named[i] != want[i] for i in want) <= 2
    assert all(named[i][0] <= want[i][0] for i in want) and named[209] == (1, 208)
    nameless = [r for r in got if r["vec_id"] is None]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in nameless] == [(0, None, True)]


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(7)
    base = rng.normal(size=8)
    rows = [(i, [float(v) for v in base + 0.01 * rng.normal(size=8)], 0) for i in range(70)]
    got = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(69, 0)}


def test_empty(spark):
    assert E.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
