"""The chained loop against plain loops, stage by stage, over a restart in the middle; the sink under a forced retry."""

import statistics

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from atrium.plans import streams
from atrium.streaming import sinks
from atrium.streaming.loop import frame_loop
from tests.test_memory import plain as plain_identities

SF = "/root/testdata/sf0.001"


def plain_kept(rows, hits=4, quiet=12.0, jitter=0.02, size=0.06, ring=20):
    cells, kept = {}, []
    for r in sorted(rows, key=lambda r: (r.t, r.raw)):
        c = cells.setdefault((r.run_id, r.x // 16, r.y // 16), {"boxes": [], "last": None, "proven": False})
        if not c["proven"]:
            if c["last"] is None or r.t - c["last"] > quiet:
                c["boxes"], c["first"] = [], r.t
            c["last"] = r.t
            c["boxes"] = [*c["boxes"], (r.x, r.y, r.w, r.h)][-ring:]
            if len(c["boxes"]) >= hits and r.t - c["first"] >= r.patience:
                x, y, w, h = zip(*c["boxes"], strict=True)
                mw, mh = statistics.median(w), statistics.median(h)
                c["proven"] = max(statistics.pstdev(x), statistics.pstdev(y)) / mh <= jitter and max(statistics.pstdev(w) / mw, statistics.pstdev(h) / mh) <= size
        if not c["proven"]:
            kept.append(r)
    return kept


def plain_loop(rows, gap=15.0):
    kept = plain_kept(rows)
    named = [(r[0], r[1], r[2], r[3]) for r in plain_identities([(r.run_id, r.t, r.raw, r.x, r.y, r.score, r.frozen, r.vec) for r in kept])]
    visits, times = [], {}
    for run, t, _, canon in named:
        times.setdefault((run, canon), []).append(t)
    for (run, canon), ts in times.items():
        held = []
        for t in [*sorted(ts), None]:
            if held and (t is None or t - held[-1] >= gap):
                visits.append((run, canon, held[0], held[-1], len(held)))
                held = []
            held.append(t)
    minutes = {}
    for run, _, a, b, _ in visits:
        m = minutes.setdefault((run, int((b + gap - 1e-6) // 60)), [0, 0.0])
        m[0], m[1] = m[0] + 1, m[1] + b - a
    return {"kept": sorted((r.run_id, r.t, r.raw) for r in kept), "identities": sorted(named), "visits": sorted(visits), "minutes": sorted((*k, n, round(s, 6)) for k, (n, s) in minutes.items())}


@pytest.fixture(scope="module")
def frames(spark):
    return streams._frames(spark, SF).persist()


@pytest.fixture(scope="module")
def want(frames):
    found = plain_loop(frames.collect())
    assert len(found["kept"]) < frames.count() and len(found["visits"]) > 5
    return found


@pytest.mark.parametrize("stage", ["kept", "identities", "visits", "minutes"])
def test_each_stage_is_the_plain_version(spark, frames, want, stage):
    end = frames.limit(1).withColumn("run_id", F.lit(-1)).withColumn("t", F.lit(1e9)).withColumn("raw", F.lit("end")).withColumn("ts", F.timestamp_seconds(F.lit(2_800_000_000)))
    out = streams.fed(spark, frames, lambda s: frame_loop(s, until=stage, still=streams.STILL), 2, end).where("run_id >= 0")
    if stage == "minutes":
        first = 60 * F.floor((F.unix_timestamp("start") - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))) / 60)
        out = out.select("run_id", (first / 60).cast("int").alias("m"), "visits", F.round("seconds", 6).alias("s"))
    out = {"kept": out.select("run_id", "t", "raw") if stage == "kept" else out, "identities": out.select("run_id", "t", "raw", "canon") if stage == "identities" else out}.get(stage, out)
    assert sorted(map(tuple, out.collect())) == want[stage]


def test_a_retried_batch_is_written_once(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("value"))
    rows.repartition(4, "k").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen, monitor = [], sinks.Progress()
    spark.streams.addListener(monitor)

    def broken(number):
        seen.append(number)
        if seen.count(1) == 1 and number == 1:
            raise RuntimeError("between writing and committing")

    args = (stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), F.col("value").isNotNull(), broken)
    with pytest.raises(StreamingQueryException):
        sinks.append_once(*args).awaitTermination()
    assert sinks.counts(spark, args[1]).count() == 2  # the second batch is written, but not committed
    sinks.append_once(*args).awaitTermination()
    assert seen.count(1) == 2
    n = sinks.counts(spark, args[1]).agg(F.sum("submitted"), F.sum("written"), F.sum("lost")).first()
    assert tuple(n) == (100, 85, 15)
    got = sinks.lines(spark, args[1]).select(F.from_json("value", "id long").alias("r")).select("r.id").collect()
    assert sorted(r.id for r in got) == [i for i in range(100) if i % 7]
    assert sinks.lines(spark, args[1], "lost").count() == 15
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    assert sum(monitor.rows.values()) == 100  # only committed batches are reported
    spark.streams.removeListener(monitor)


class Entries:
    """A map state in memory that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def exists(self):
        self.calls += 1
        return bool(self.held)

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.held.pop(key, None)

    def iterator(self):
        return iter(list(self.held.items()))


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Entries())

    def listTimers(self):
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return 0


def test_a_batch_of_a_camera_costs_few_calls_of_the_state():
    """1,000 names and 200 cells of a block: calls go with parts and rows of cells, also where a second batch meets the state."""
    import numpy as np
    import pandas as pd

    from atrium.operators.memory import Identities
    from atrium.streaming.occupancy import Stillness

    handle, rng = Handle(), np.random.default_rng(1)
    n = 1000
    d = pd.DataFrame({"run_id": 0, "t": np.arange(n) / 8, "raw": [str(i) for i in range(n)], "x": rng.uniform(0, 1900, n), "y": rng.uniform(0, 1000, n), "score": 1.0, "frozen": False, "vec": list(rng.normal(size=(n, 4)))})
    d["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(d["t"], unit="s")
    whole, halves = Identities(), Identities()
    whole.init(Handle())
    want = pd.concat(list(whole.handleInputRows((0,), [d], handle)))
    halves.init(handle)
    got = pd.concat([x for half in (d[:500], d[500:]) for x in halves.handleInputRows((0,), [half], handle)])
    assert got.reset_index(drop=True).equals(want.reset_index(drop=True)) and "matched" in set(got["how"])
    assert sum(s.calls for s in handle.states.values()) < 700
    handle = Handle()
    one = Stillness(4, 12.0, 0.02, 0.06, 20, ["t", "track_id"])
    one.init(handle)
    b = pd.DataFrame({"t": np.arange(n) / 8, "track_id": "a", "gx": np.arange(n) % 16, "gy": np.arange(n) // 16 % 13, "x": 1.0, "y": 1.0, "w": 40.0, "h": 90.0, "patience": 30.0})
    b["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(b["t"], unit="s")
    b.loc[7, ["gx", "x"]] = np.nan
    for half in (b[:500], b[500:]):
        assert [len(x) for x in one.handleInputRows((0,), [half], handle)] == [500]
    assert handle.states["strips"].calls < 60 and len(handle.timers) == 1
    list(one.handleExpiredTimer((0,), handle, None))
    assert not handle.states["strips"].held  # nothing was proven
