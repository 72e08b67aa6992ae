"""Settings as data: trees of any shape as rows of dotted paths, layers of them, and rules for their values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.scratch import write_table

#: Deepest mapping of an indented text.
DEPTH = 8


def flattened(trees: DataFrame, key: str, text: str) -> DataFrame:
    """Each leaf of the JSON in column text: key, path, kind (text, number, flag, null), value as text.

    Maps and lists are walked level by level, all trees at once, as variants,
    so no schema is needed; a path names a list's items as [0], [1], ...
    Empty maps and lists have no leaf. Text that is not JSON gives no rows, and
    neither does null.
    """
    spark = trees.sparkSession
    level = trees.select(key, F.lit("").alias("path"), F.try_parse_json(text).alias("v")).where("v is not null")
    out = None
    while True:
        level = write_table(level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)), "level")
        inner = F.col("kind").isin("OBJECT", "ARRAY")
        word = F.when(F.col("kind") == "STRING", "text").when(F.col("kind") == "BOOLEAN", "flag").when(F.col("kind") == "VOID", "null").otherwise("number")
        leaves = level.where(~inner).select(key, "path", word.alias("kind"), F.col("v").cast("string").alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        if level.where(inner).isEmpty():
            return out
        parts = level.where(inner).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("kind") == "ARRAY", F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat(F.lit("."), F.col("key")))
        level = parts.select(F.col(key), F.concat("path", step).alias("path"), F.col("value").alias("v"))


def indented(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Each `name: value` line of an indented text: key, line (from 0), path, value (null for a mapping).

    A line belongs to the nearest line above it that is indented less. Blank
    lines and comments don't count. At most DEPTH levels of two spaces.
    """
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line", "raw"))
    name = F.regexp_extract("raw", r"^ *([^:#\s][^:#]*):", 1)
    lines = lines.withColumn("name", name).where("name <> ''").withColumn("depth", F.least(F.length(F.regexp_extract("raw", "^( *)", 1)), F.lit(2 * DEPTH)))
    above = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    # The latest line of each lesser depth is on the path unless a still lesser one came after it.
    latest = [F.last(F.when(F.col("depth") == 2 * d, F.struct("line", "name")), ignorenulls=True).over(above).alias(f"d{d}") for d in range(DEPTH)]
    lines = lines.select("*", *latest)
    parts = [F.when((F.col("depth") > 2 * d) & F.col(f"d{d}.line").isNotNull() & (F.col(f"d{d}.line") > F.greatest(F.lit(-1), F.lit(-1), *[F.coalesce(f"d{e}.line", F.lit(-1)) for e in range(d)])), F.col(f"d{d}.name")) for d in range(DEPTH)]
    value = F.nullif(F.trim(F.regexp_replace("raw", r"^[^:]*:", "")), F.lit(""))
    return lines.select(key, "line", F.concat_ws(".", *parts, "name").alias("path"), value.alias("value"))


def resolved(layers: list[DataFrame], key: str) -> DataFrame:
    """Of layers (key, path, kind, value), later ones first, each path's value and the number of the layer that gave it."""
    every = None
    for number, rows in enumerate(layers):
        rows = rows.select(key, "path", "kind", "value", F.lit(number).alias("layer"))
        every = rows if every is None else every.unionByName(rows)
    top = F.max_by(F.struct("kind", "value", "layer"), "layer").alias("top")
    return every.groupBy(key, "path").agg(top).select(key, "path", "top.kind", "top.value", "top.layer")


def problems(settings: DataFrame, bounds: dict[str, tuple[float, float]], choices: dict[str, tuple[str, ...]]) -> DataFrame:
    """The settings that are no number within their bounds, or none of their choices, and what is wrong with each."""
    number, path = F.col("value").try_cast("double"), F.col("path")
    wrong: Column = F.lit(None).cast("string")
    for name, (low, high) in bounds.items():
        bad = (F.col("kind") != "number") | number.isNull() | (number < low) | (number > high)
        wrong = F.when((path == name) & bad, f"outside {low:g} to {high:g}").otherwise(wrong)
    for name, allowed in choices.items():
        wrong = F.when((path == name) & ~F.col("value").isin(*allowed), f"none of {', '.join(allowed)}").otherwise(wrong)
    return settings.withColumn("problem", wrong).where("problem is not null")
