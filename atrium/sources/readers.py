"""Readers of the formats that venue data comes in. All return typed rows; what can't be read is set aside, never dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FRAME_LOG = "array<struct<frame_idx:int,t:double,boxes:array<array<double>>>>"
OBSERVATION = "kind string, run_id string, frame_idx int, raw_track_id string, zone string, det_conf double, emb_id string, vec array<float>, camera_id string, started_at string"


def mot(lines: DataFrame, column: str = "value", extra: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """`frame,id,x,y,w,h[,conf,...]` lines (commas or tabs): good rows, and bad lines.

    Blank lines and lines that begin with # are skipped. Unreadable lines and
    boxes without extent are bad; rows whose seventh value is 0, if there are
    nine or more, are marked to be ignored and left out. extra: columns to keep.
    """
    extra = extra or []
    line = F.trim(F.col(column))
    parts = F.split(line, r"[,\t]")
    rows = lines.where((line != "") & ~line.startswith("#")).select(*extra, line.alias("line"), parts.alias("p"))
    number = lambda i: F.get("p", F.lit(i)).try_cast("double")
    named = ["frame", "id", "x", "y", "w", "h"]
    rows = rows.select(*extra, "line", F.size("p").alias("n"), *[number(i).alias(c) for i, c in enumerate(named)], number(6).alias("conf"))
    good = F.coalesce((F.col("w") > 0) & (F.col("h") > 0), F.lit(False))
    for c in named:
        good = good & F.col(c).isNotNull()
    kept = rows.where(good & ~F.coalesce((F.col("n") >= 9) & (F.col("conf") == 0), F.lit(False)))
    return kept.select(*extra, F.col("frame").cast("int").alias("frame"), F.col("id").cast("int").alias("id"), "x", "y", "w", "h", "conf"), rows.where(~good).select(*extra, "line")


def points(lines: DataFrame, extra: list[str] | None = None, column: str = "value") -> DataFrame:
    """`frame,x,y` lines; others are left out."""
    p = F.split(F.trim(F.col(column)), ",")
    n = lambda i, kind: F.get(p, F.lit(i)).try_cast(kind)
    return lines.select(*(extra or []), n(0, "int").alias("frame"), n(1, "double").alias("x"), n(2, "double").alias("y")).where("frame is not null and x is not null and y is not null")


def frame_log(texts: DataFrame, column: str = "value", extra: list[str] | None = None) -> DataFrame:
    """Nested JSON arrays [[frame_idx, t, [[id, x1, y1, x2, y2], ...]], ...], one document per row, as boxes. (A3, A4)

    Frames without boxes give one row with null boxes.
    """
    extra = extra or []
    frames = texts.select(*extra, F.explode(F.from_json(F.col(column), "array<array<string>>")).alias("f"))
    f = frames.select(*extra, F.get("f", F.lit(0)).cast("int").alias("frame_idx"), F.get("f", F.lit(1)).cast("double").alias("t"), F.from_json(F.get("f", F.lit(2)), "array<array<double>>").alias("boxes"))
    b = f.select(*extra, "frame_idx", "t", F.explode_outer("boxes").alias("b"))
    return b.select(*extra, "frame_idx", "t", F.get("b", F.lit(0)).cast("long").cast("string").alias("track_id"), *[F.get("b", F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"), 1)])


def run_frame_logs(spark: SparkSession, path: str, run: str = r"run_id=([^/]+)/") -> DataFrame:
    """Frame logs of several runs, compressed or not; the run is what the pattern finds in the path. (A4)"""
    texts = spark.read.option("recursiveFileLookup", True).text(path)
    return frame_log(texts.select("value", F.regexp_extract(F.col("_metadata.file_path"), run, 1).alias("run")), extra=["run"])


def frame_records(spark: SparkSession, path: str, columns: str = "run_id int", between: str = ",") -> DataFrame:
    """The same logs, a frame at a time: a file of any size is read as a stream of frames, and split where it is not compressed. (A3, A4)

    The end of a frame with boxes and the start of the next, `]]],[`, separates
    the reader's records, so a record is one frame, after those without boxes
    before it, and never the file. A bracket less would do for these too, but
    behind another bracket the reader misses a separator that its buffer or its
    part of the file ends in. between: what stands between two lists, `, ` in
    spaced files. columns: the folders (name=value) that path holds; a filter
    on them leaves files unread.
    """
    rows = spark.read.schema(f"value string, {columns}").option("lineSep", f"]]]{between}[").text(path)
    keep = [c for c in rows.columns if c != "value"]
    rows = rows.select(*keep, F.explode(F.split("value", r"(?<=\[\])\],\s*\[")).alias("value"))
    # What remains are a frame's number, its time and its boxes without the brackets around them.
    body = F.regexp_replace(F.regexp_replace("value", r"^[\s\[]+", ""), r"[\s\]]+$", "")
    # A frame's number and time stand before its boxes, so that a filter on them is decided before those are parsed.
    head = F.split(F.substring_index(body, "[", 1), ",")
    boxes = F.regexp_replace(body, r"^[^\[]*\[\s*", "")
    f = rows.where(F.trim("value").rlike(r"\d")).select(*keep, head.alias("h"), F.when(boxes == "", "[]").otherwise(F.concat(F.lit("["), boxes, F.lit("]]"))).alias("b"))
    f = f.select(*keep, F.get("h", F.lit(0)).cast("int").alias("frame_idx"), F.get("h", F.lit(1)).cast("double").alias("t"), F.explode_outer(F.from_json("b", "array<array<double>>")).alias("b"))
    return f.select(*keep, "frame_idx", "t", F.get("b", F.lit(0)).cast("long").cast("string").alias("track_id"), *[F.get("b", F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"), 1)])


def observations(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """JSON lines told apart by kind: observations, embeddings and runs."""
    rows = lines.select(F.from_json(F.col(column), OBSERVATION).alias("r")).select("r.*")
    obs = rows.where("kind = 'obs'").select("run_id", "frame_idx", "raw_track_id", "zone", "det_conf")
    return obs, rows.where("kind = 'emb'").select("emb_id", "run_id", "vec"), rows.where("kind = 'run'").select("run_id", "camera_id", "started_at")


def start_in_name(name: Column) -> Column:
    """The first `M-D-YYYY, H.MM.SSam` of a file name, as a timestamp without zone; null if there is none or it is no date."""
    pattern = r"(\d{1,2})-(\d{1,2})-(\d{4}), (\d{1,2})\.(\d{2})\.(\d{2}) ?([aApP])[mM]"
    part = lambda i: F.regexp_extract(name, pattern, i).try_cast("int")
    afternoon = F.lower(F.regexp_extract(name, pattern, 7)) == "p"
    hour = part(4) % 12 + F.when(afternoon, 12).otherwise(0)
    return F.try_make_timestamp_ntz(part(3), part(1), part(2), hour, part(5), part(6).cast("decimal(16,6)"))


def counts_in_text(text: Column) -> Column:
    """All `LINE IN n | OUT m` of a log as array<struct<n_in,n_out>>."""
    n = lambda i: F.regexp_extract_all(text, F.lit(r"LINE IN (\d+) \| OUT (\d+)"), F.lit(i))
    return F.zip_with(n(1), n(2), lambda a, b: F.struct(a.cast("int").alias("n_in"), b.cast("int").alias("n_out")))


def funnel_in_text(text: Column) -> Column:
    """All `STAGE dropped N P%` of a log as array<struct<stage,drop_pct>>."""
    of = lambda i: F.regexp_extract_all(text, F.lit(r"([a-z]+) +dropped +\d+ +([0-9.]+)%"), F.lit(i))
    return F.zip_with(of(1), of(2), lambda a, b: F.struct(a.alias("stage"), b.cast("double").alias("drop_pct")))


def people_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """people.csv files of several runs; the run is the name of the folder."""
    rows = spark.read.option("header", True).csv(pattern)
    return rows.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def carried_forward(boxes: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Frames (run_id, frame_idx) all of whose boxes are within the tolerance of the frame's before, box by box in order."""
    f = boxes.groupBy("run_id", "frame_idx").agg(F.sort_array(F.collect_list(F.struct("x1", "y1", "x2", "y2"))).alias("c"))
    before = F.lag("c").over(Window.partitionBy("run_id").orderBy("frame_idx"))
    far = lambda a, b: F.greatest(*[F.abs(a[k] - b[k]) for k in ("x1", "y1", "x2", "y2")]) > tolerance
    f = f.withColumn("p", before).where(F.size("c") == F.size("p"))
    return f.where(~F.exists(F.zip_with("c", "p", far), lambda m: m)).select("run_id", "frame_idx")


def truth_windows(docs: DataFrame, keep: list[str], column: str = "value") -> DataFrame:
    """JSON label files as windows: keep, w0, w1, expected. A count that is not stated is the number of entries."""
    d = docs.select(*keep, F.from_json(F.col(column), "window_s array<double>, truth_count int, entries array<double>").alias("d"))
    return d.select(*keep, F.get("d.window_s", F.lit(0)).alias("w0"), F.get("d.window_s", F.lit(1)).alias("w1"), F.coalesce("d.truth_count", F.size("d.entries")).alias("expected"))
