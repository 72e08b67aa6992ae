"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Rows hash into thousands of slots, whose number never changes. The map from
slots to shards is small whatever the data's size: rebalancing edits it as a
new version, moving only slots from overfull to underfull shards, and rows
follow their slots. Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atrium.scratch import write_table

SLOTS = 4096


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of each row, and a number that tells equal rows of a written table apart.

    The slot is the hash of doc_id and text, so that rows without doc_id, or
    with the same one, still spread.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("tie"),
    )


def first_map(rows: DataFrame, shards: int) -> DataFrame:
    """Version 1: slots are dealt to shards in turn. bytes and rows are what each slot holds."""
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return held.select(F.lit(1).alias("version"), "virtual_slot", F.pmod("virtual_slot", F.lit(shards)).alias("shard"), "bytes", "rows")


def _plus(loads: Column, at: Column, more: Column) -> Column:
    return F.transform(loads, lambda v, i: F.when(i == at, v + more).otherwise(v))


def rebalanced(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, for this number of shards (which may be larger than before).

    Each shard keeps its largest slots up to its fair share of bytes and sheds
    the others, which go to the least loaded shard in turn, largest first. The
    map has at most SLOTS rows, so one task edits it.
    """
    slot = F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard", "rows")
    every = slot_map.groupBy().agg(F.sort_array(F.collect_list(slot)).alias("slots"), F.sum("bytes").alias("total"), F.max("version").alias("version"))
    fair = F.ceil(F.col("total") / F.lit(shards))
    none = F.slice("slots", 1, 0)
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), none.alias("kept"), none.alias("shed"))

    def keep(acc, x):
        fits = (x["shard"] < shards) & (F.try_element_at(acc["loads"], x["shard"] + 1) - x["less"] <= fair)
        fits = F.coalesce(fits, F.lit(False))
        return F.struct(
            F.when(fits, _plus(acc["loads"], x["shard"], -x["less"])).otherwise(acc["loads"]).alias("loads"),
            F.when(fits, F.concat(acc["kept"], F.array(x))).otherwise(acc["kept"]).alias("kept"),
            F.when(fits, acc["shed"]).otherwise(F.concat(acc["shed"], F.array(x))).alias("shed"),
        )

    def place(acc, x):
        least = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        moved = F.struct(x["less"].alias("less"), x["virtual_slot"].alias("virtual_slot"), least.alias("shard"), x["rows"].alias("rows"))
        return F.struct(_plus(acc["loads"], least, -x["less"]).alias("loads"), F.concat(acc["kept"], F.array(moved)).alias("kept"), acc["shed"].alias("shed"))

    kept = every.select("version", F.aggregate("slots", start, keep).alias("step"))
    placed = kept.select("version", F.aggregate(F.col("step.shed"), F.col("step"), place)["kept"].alias("slots"))
    return placed.select((F.col("version") + 1).alias("version"), F.explode("slots").alias("s")).select(
        "version", "s.virtual_slot", "s.shard", (-F.col("s.less")).alias("bytes"), "s.rows"
    )


def store(slot_map: DataFrame, path: str) -> None:
    """Adds a version to the stored map; earlier versions stay as they are."""
    slot_map.write.partitionBy("version").mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version of a stored map, or None if there is none."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    every = spark.read.parquet(path)
    last = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == last).select("version", "virtual_slot", "shard", "bytes", "rows")


def held_now(slot_map: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """A map with what its slots hold in these rows; slots that it doesn't know go where a first map would put them."""
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    known = slot_map.select("virtual_slot", "shard", F.max("version").over(Window.partitionBy()).alias("version"))
    j = held.join(F.broadcast(known), "virtual_slot", "left")
    version = F.coalesce(F.max("version").over(Window.partitionBy()), F.lit(1))
    return j.select(version.alias("version"), "virtual_slot", F.coalesce("shard", F.pmod("virtual_slot", F.lit(shards))).alias("shard"), "bytes", "rows")


def sharded(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    The law is `bytes`: shards are of near equal size. slot is the row's place
    in its shard, 0, 1, ... without gaps. grown_shard is null under this law.
    Null texts have size 1 and the crc of an empty text; null doc_ids and
    repeated rows are dealt like any others; very long texts count with all
    their bytes; rows that tie in every column have any order among
    themselves. An empty table gives an empty result. Other columns are
    ignored, whatever their names.

    map_path: where versions of the map are kept. The last one there is edited
    for these rows and the next one is added, so that only slots move that have
    to; without it the first two versions serve this call alone.
    """
    rows = write_table(slotted(docs, slots), "slotted")
    known = stored(docs.sparkSession, map_path) if map_path else None
    first = write_table(first_map(rows, shards) if known is None else held_now(known, rows, shards), "slot-map")
    current = write_table(rebalanced(first, shards), "slot-map")
    if map_path:
        if known is None:
            store(first, map_path)
        store(current, map_path)
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1))
    places = current.select("virtual_slot", "shard", F.col("version").alias("map_version"), F.coalesce(before, F.lit(0)).alias("before"))
    # The map has at most `slots` rows. A slot's rows are ranked in 64 parts, so that many equal rows are not one task's.
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "tie"), F.lit(64)).alias("part")
    rows = rows.select("*", part)
    sizes = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("virtual_slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("virtual_slot", "part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    own = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size", "tie"))
    placed = rows.withColumn("own", own).join(F.broadcast(sizes), ["virtual_slot", "part"]).join(F.broadcast(places), "virtual_slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("earlier") + F.col("own") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )
