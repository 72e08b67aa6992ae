import pytest
from pyspark.sql import functions as F

from atrium.scratch import settings, shared_dir, write_table
from atrium.sources import readers as R
from atrium.sources import sinks as S


def test_mot_sets_bad_lines_aside(spark):
    lines = ["1,2,3,4,5,6,1", "", "# note", "1,2,x,4,5,6", "1,2,3,4,0,6,1", "3\t4\t1\t1\t2\t2", "1,2,3,4,5,6,0,-1,-1", "1,2,3,4,5,6,0", "1,2"]
    good, bad = R.mot(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted((r["frame"], r["id"], r["w"]) for r in good.collect()) == [(1, 2, 5.0), (1, 2, 5.0), (3, 4, 2.0)]
    assert sorted(r["line"] for r in bad.collect()) == ["1,2", "1,2,3,4,0,6,1", "1,2,x,4,5,6"]  # a box without extent is bad as well


def test_frame_log_keeps_empty_frames(spark):
    df = spark.createDataFrame([("[[0,0.0,[[7,1,2,3,4],[8,0,0,1,1]]],[1,0.125,[]]]",)], "value string")
    rows = R.frame_log(df).collect()
    assert sorted((r["frame_idx"], r["track_id"] or "") for r in rows) == [(0, "7"), (0, "8"), (1, "")]


def test_start_in_name(spark):
    names = ["CAM 8-14-2026, 1.05.09PM - 8-14-2026, 2.00.00PM.mp4", "1-1-2026, 12.00.00am", "13-41-2026, 1.00.00am", "x", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in names], "n string").select(R.start_in_name(F.col("n")).cast("string")).collect()]
    assert got == ["2026-08-14 13:05:09", "2026-01-01 00:00:00", None, None, None]


def test_a_rerun_with_fewer_rows_leaves_none_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_runs(spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "run_id int, v int"), path)
    S.replace_runs(spark.createDataFrame([(0, 9)], "run_id int, v int"), path)
    assert sorted((r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(0, 9), (1, 3)]


def test_unmeasured_is_empty_in_csv(spark, tmp_path):
    path = str(tmp_path / "run7")
    S.people_csv(spark.createDataFrame([("1", None), ("2", 0.0)], "id string, wait double"), path, ["id", "wait"])
    rows = {r["id"]: (r["wait"], r["run"]) for r in R.people_csv(spark, f"{path}/*.csv").collect()}
    assert rows == {"1": (None, "run7"), "2": ("0.0", "run7")}


def test_scratch(spark):
    df = write_table(spark.range(3).where("id > 5"), "none")
    assert df.count() == 0 and df.columns == ["id"] and shared_dir(spark) == shared_dir(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, spark__sql__shuffle__partitions=7):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize("spaced", [False, True])
def test_frame_records_read_a_log_frame_by_frame(spark, tmp_path, spaced):
    import gzip
    import json

    from atrium.sources.readers import frame_log, frame_records

    frames = [[i, i / 8, [[j, i + 0.5, 1.0, 2.0, 3.0] for j in range(i % 4)]] for i in range(50)]
    text = json.dumps(frames, separators=None if spaced else (",", ":"))
    for run, write in ((0, lambda p: p.write_text(text + "\n")), (1, lambda p: p.with_suffix(".gz").write_bytes(gzip.compress(text.encode())))):
        (tmp_path / f"run_id={run}").mkdir()
        write(tmp_path / f"run_id={run}" / "log.json")
    got = frame_records(spark, str(tmp_path), between=", " if spaced else ",")
    want = frame_log(spark.createDataFrame([(text, r) for r in (0, 1)], "value string, run_id int"), extra=["run_id"])
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    plan = got.where("run_id = 1 and frame_idx > 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan  # the other run's files are not read
    # A record is a frame, not a file.
    records = spark.read.option("lineSep", "]], [" if spaced else "]],[").text(str(tmp_path))
    assert records.count() == 100


def test_likenesses_in_sql(spark):
    from atrium.functions.sql import register

    register(spark, {"first": lambda a, b: a[:, 0] - b[:, 0]})
    rows = [([3.0, 4.0], [3.0, 4.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0]), ([1.0], [1.0, 2.0]), ([2.0], [5.0])]
    t = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = [tuple(r) for r in spark.sql("SELECT likeness(a, b), nearness(a, b), first(a, b) FROM {t}", t=t).collect()]
    assert got[0] == (1.0, 1.0, 0.0) and got[1][0] == 0.0 and got[2][0] == 0.0
    assert got[3] == got[4] == (None, None, None) and got[5] == (1.0, 0.25, -3.0)


def test_funnel_shares_are_printed_as_c_prints_them(spark, tmp_path):
    """Of 400 boxes 49 are dropped, 12.25 %, which is 12.2 with one decimal."""
    from atrium.plans.registry import ORACLE_SQL, QUERIES
    from tests import oracle

    # A box's conf is 0.3 + (event_id % 70) / 100; each event of a user and frame of its own is a box.
    low = [i for i in range(5000) if i % 70 < 5][:49]
    high = [i for i in range(5000) if 10 <= i % 70][:351]
    rows = [(i, 500 + 25 * (i % 5), "view", 1.0, '{"k": 5}') for i in sorted(low + high)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").coalesce(1).toPandas().to_parquet(f"{tmp_path}/events.parquet")
    q = "a16_funnel_in_logs"
    got = {r["stage"]: r["drop_pct"] for r in QUERIES[q](spark, str(tmp_path)).collect()}
    assert got["confidence"] == 12.2
    assert oracle.difference(spark, oracle.connect(str(tmp_path)), QUERIES[q], ORACLE_SQL[q], str(tmp_path)) == ""


@pytest.mark.parametrize("bytes_a_part", ["128m", "1k"])
def test_no_frame_is_lost_where_a_buffer_or_a_part_ends(spark, tmp_path, bytes_a_part):
    """Files whose separators lie at every place around the end of the reader's buffer of 64 KB, and at the ends of parts of 1 KB."""
    import json

    from atrium.sources.readers import frame_records

    want = []
    for run in range(45 if bytes_a_part == "128m" else 8):
        frames = [[i, i / 8, [[i, 1.5, 2.5, 3.5, 4.5]] if i % 7 else []] for i in range(2200 if bytes_a_part == "128m" else 200)]
        (tmp_path / f"run_id={run}").mkdir()
        (tmp_path / f"run_id={run}" / "log.json").write_text(" " * run + json.dumps(frames, separators=(",", ":")))
        want += [(run, f[0], str(f[0]) if f[2] else None) for f in frames]
    with settings(spark, spark__sql__files__maxPartitionBytes=bytes_a_part, spark__sql__files__openCostInBytes="1"):
        got = [(r["run_id"], r["frame_idx"], r["track_id"]) for r in frame_records(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_vectors_are_printed_as_c_prints_them(spark):
    """Halves that doubles hold exactly go to the even neighbour, others to where the number itself lies."""
    rows = [[-0.0703125, 0.0703125, 0.5, -0.0], [0.1234565], [], [float("nan"), float("inf"), None, 1e22], None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in rows], "v array<double>").coalesce(1).select(S.vector_text(F.col("v"))).collect()]
    assert got == ["[-0.070312,0.070312,0.500000,-0.000000]", "[" + "%.6f" % 0.1234565 + "]", "[]", "[nan,inf,10000000000000000000000.000000]", None]
