"""Intermediate tables in the folder that the driver and all executors share.

A table written there cuts lineage for good: a lost executor costs no
recomputation of what was already written.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder of its own; on
    a cluster a machine-local folder would be wrong, so this raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="atrium-")
    return _own[context.applicationId]


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and returns what was written."""
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, with the table's place."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/_atrium_tmp/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that nothing reads any more."""
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes one file into the shared folder and returns its place."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/_atrium_tmp/{name}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(path)
    for start in range(0, len(data), 1 << 20):
        out.write(bytearray(data[start : start + (1 << 20)]))
    out.close()
    return system.makeQualified(path).toString()


def clear(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this library; DataFrames that read them end here."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/_atrium_tmp")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Session settings for one block; names have __ for dots."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
