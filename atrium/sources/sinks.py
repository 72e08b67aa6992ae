"""Writers of results."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from atrium.scratch import settings


def mot_line(frame: Column, track: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """`frame,id,x,y,w,h,1,-1,-1,-1` with two decimals. (B1)"""
    return F.format_string("%d,%d,%.2f,%.2f,%.2f,%.2f,1,-1,-1,-1", frame, track, x, y, w, h)


def printed(numbers: Column, digits: int) -> Column:
    """An array of doubles as texts with so many decimals, as C's printf has them; nulls stay.

    format_string rounds the shortest decimal that stands for a number, half up:
    0.0703125 becomes 0.070313. Here the number itself is rounded, half to even.
    """
    form = f"%.{digits}f"

    def texts(a: pa.Array) -> pa.Array:
        return pa.array([None if row is None else [None if v is None else form % v for v in row] for row in a.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(texts, ArrayType(StringType()))(numbers.cast("array<double>"))


def vector_text(vec: Column) -> Column:
    """`[0.123456,...]`; null elements are left out."""
    return F.concat(F.lit("["), F.array_join(printed(vec, 6), ","), F.lit("]"))


def replace_runs(rows: DataFrame, path: str, key: str = "run_id") -> None:
    """Writes whole runs: each run in rows replaces what the table had of it, and only that.

    A re-run with fewer rows leaves none of the former ones behind.
    """
    with settings(rows.sparkSession, spark__sql__sources__partitionOverwriteMode="dynamic"):
        rows.write.mode("overwrite").partitionBy(key).parquet(path)


def people_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with fixed columns; what was not measured is empty, never 0."""
    rows.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)
