import zlib
from collections import Counter

from atrium.llm import slot_sharding as S


def test_stored_map_is_edited(spark, docs, tmp_path):
    path = str(tmp_path / "map")
    first = {r["virtual_slot"]: r["shard"] for r in S.sharded(docs, 4, 64, path).collect()}
    assert {r["version"] for r in spark.read.parquet(path).select("version").distinct().collect()} == {1, 2}
    again = S.sharded(docs, 4, 64, path)
    # On the same rows only what is above a fair share moves, which is next to nothing.
    same = {r["virtual_slot"]: r["shard"] for r in again.collect()}
    assert sum(same[v] != first[v] for v in first) <= 3 and again.first()["map_version"] == 3
    grown = S.sharded(docs, 5, 64, path).collect()
    # A fifth of the bytes moves, nearly all of it to the new shard.
    moved = [r for r in grown if r["shard"] != same[r["virtual_slot"]]]
    share = sum(r["size"] for r in moved) / sum(r["size"] for r in grown)
    assert 0.15 < share < 0.3 and sum(r["size"] for r in moved if r["shard"] == 4) >= 0.8 * sum(r["size"] for r in moved)


def test_equal_rows_and_sizes(spark):
    rows = [(7, "same")] * 500 + [(None, None)] * 20 + [(i, "x" * (i % 50)) for i in range(400)] + [(9, "y" * 300_000)]
    got = S.sharded(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, shard string").repartition(5), 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for shard in range(4):
        places = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert places == list(range(len(places)))
