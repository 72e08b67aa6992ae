import zlib

from atrium.llm import slot_sharding as S


def _check(rows, texts):
    assert len(rows) == len(texts)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    by = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        by.setdefault(r["shard"], []).append(r)
    for some in by.values():
        assert sorted(r["slot"] for r in some) == list(range(len(some)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_shards_are_near_equal(docs):
    rows = S.sharded(docs).collect()
    loads = _check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert max(loads.values()) - min(loads.values()) <= max(r["size"] for r in rows)


def test_odd_rows(odd_docs):
    _check(S.sharded(odd_docs).collect(), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])


def test_empty(no_docs):
    assert S.sharded(no_docs).count() == 0


def test_growing_edits_the_map_as_a_new_version(docs, spark, tmp_path):
    rows = S.slotted(docs)
    first = S.first_map(rows, 8)
    second = S.rebalanced(first, 8)
    third = S.rebalanced(second, 9)
    for m in (first, second, third):
        S.store(m, str(tmp_path / "map"))
    stored = spark.read.parquet(str(tmp_path / "map"))
    assert sorted(r["version"] for r in stored.select("version").distinct().collect()) == [1, 2, 3]
    before = {r["virtual_slot"]: r["shard"] for r in second.collect()}
    after = {r["virtual_slot"]: r["shard"] for r in third.collect()}
    moved = {k for k in before if before[k] != after[k]}
    assert before.keys() == after.keys() and set(after.values()) == set(range(9))
    # About a ninth moves, nearly all of it to the new shard.
    assert len(moved) < 0.35 * len(before) and sum(after[k] == 8 for k in moved) > 0.6 * len(moved)
