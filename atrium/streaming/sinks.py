"""A sink of lines that writes each batch once and counts what it was given, wrote and lost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTS = "batch long, submitted long, written long, lost long"


def append_once(stream: DataFrame, path: str, checkpoint: str, good: Column, after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Appends a stream's good rows as JSON lines below path/lines, and its others below path/lost.

    A batch has folders of its own that it overwrites, so one that is tried
    again after a failure (between writing and committing, too) leaves nothing
    twice. Its counts are observed while it is written and stored beside it.
    `after` is called with the batch's number when all is written and before
    the batch counts as done.
    """
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns])).alias("value")
    fine = F.coalesce(good, F.lit(False))

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        batch = batch.withColumn("_good", fine).observe(seen, F.count("*").alias("submitted"), F.count_if("_good").alias("written"))
        # One pass: a partition column sends a line to its folder.
        to = F.when(F.col("_good"), "lines").otherwise("lost").alias("to")
        batch.select(line, to).write.mode("overwrite").partitionBy("to").text(f"{path}/rows/batch={number}")
        n = seen.get
        row = (number, n["submitted"], n["written"], n["submitted"] - n["written"])
        batch.sparkSession.createDataFrame([row], COUNTS).write.mode("overwrite").json(f"{path}/counts/batch={number}")
        if after:
            after(number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def lines(spark, path: str, to: str = "lines") -> DataFrame:
    """What was written (or lost): batch, value."""
    return spark.read.schema("value string, batch long, to string").text(f"{path}/rows").where(F.col("to") == to).select("batch", "value")


def counts(spark, path: str) -> DataFrame:
    return spark.read.schema(COUNTS).json(f"{path}/counts")


class Progress(StreamingQueryListener):
    """Adds up rows of finished batches, by query: what a monitor sees while a stream runs."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            key = str(p.id)
            self.rows[key] = self.rows.get(key, 0) + p.numInputRows
            self.batches[key] = self.batches.get(key, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
