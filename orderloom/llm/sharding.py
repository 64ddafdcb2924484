"""Sharding over fixed virtual slots.

A record's id is hashed into one of a few thousand slots, for ever. A small versioned table maps
slots to shards. Rebalancing adds up bytes per slot and edits that table; no record is hashed
anew, and only the slots that an edit names move.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.session import cut_lineage, work_folder

SLOTS = 4096
SHARDS = 16


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 32 bits of its MD5, modulo the number of slots."""
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return (head % slots).cast("int")


def sized_records(df: DataFrame, slots: int = SLOTS, key="doc_id", text="text") -> DataFrame:
    """`key`, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32 and
    virtual_slot of every row. A row without key is hashed by its text's checksum."""
    body = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(body)
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("crc32:"), crc.cast("string")))
    return df.select(
        F.col(key), (F.octet_length(body).cast("long") + 1).alias("size"),
        crc.alias("text_crc32"), slot_of(name, slots).alias("virtual_slot"))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and rows per used slot: at most one row for each slot, summed before the shuffle."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 1: slots dealt in turn."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, used: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of `slot_map`, with near equal bytes per shard.

    Each shard keeps its largest slots up to an equal share (one slot at least); the rest,
    largest first, go to the shard with the fewest bytes, ties to the lower number. The map has
    one row per slot, a fixed number, so that deal is one expression over one array. Shards from
    `shards` on lose all their slots. Empty slots stay where they are.
    """
    sized = slot_map.join(F.broadcast(used.select("virtual_slot", "bytes")), "virtual_slot",
                          "left").fillna(0, ["bytes"])
    largest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    everything = Window.partitionBy(F.lit(0))
    share = F.floor(F.sum("bytes").over(everything) / shards)
    ranked = sized.select(
        "version", "virtual_slot", "shard", "bytes",
        ((F.col("shard") < shards)
         & ((F.sum("bytes").over(largest) <= share) | (F.row_number().over(largest) == 1)
            | (F.col("bytes") == 0))).alias("stays"))
    slot = F.struct((-F.col("bytes")).alias("less"), "virtual_slot")
    state = ranked.groupBy("shard").agg(
        F.sum(F.when(F.col("stays"), F.col("bytes")).otherwise(0)).alias("load"),
        F.collect_list(F.when(~F.col("stays"), slot)).alias("moving"),
    ).agg(F.map_from_entries(F.collect_list(F.struct("shard", "load"))).alias("loads"),
          F.sort_array(F.flatten(F.collect_list("moving"))).alias("moving"))
    shard_list = F.sequence(F.lit(0), F.lit(shards - 1))
    dealt = state.select(F.aggregate(
        "moving",
        F.struct(
            F.transform(shard_list, lambda s: F.coalesce(
                F.element_at("loads", s), F.lit(0).cast("long"))).alias("loads"),
            F.expr("CAST(array() AS ARRAY<STRUCT<virtual_slot: INT, to_shard: INT>>)")
            .alias("moves")),
        lambda done, slot: _deal(done, slot),
        lambda done: done["moves"]).alias("moves")).select(F.inline("moves"))
    return ranked.join(F.broadcast(dealt), "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"), "virtual_slot",
        F.coalesce("to_shard", "shard").alias("shard"))


def _deal(done: Column, slot: Column) -> Column:
    """Adds one slot to the shard with the fewest bytes."""
    shard = (F.array_position(done["loads"], F.array_min(done["loads"])) - 1).cast("int")
    return F.struct(
        F.transform(done["loads"], lambda load, i: F.when(
            i == shard, load - slot["less"]).otherwise(load)).alias("loads"),
        F.concat(done["moves"], F.array(F.struct(
            slot["virtual_slot"].alias("virtual_slot"), shard.alias("to_shard"))))
        .alias("moves"))


def store_map(slot_map: DataFrame, folder: str) -> None:
    """Adds a version to the folder of maps; earlier versions stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(folder)


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest by default."""
    maps = spark.read.schema("virtual_slot INT, shard INT, version INT").parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def place(records: DataFrame, slot_map: DataFrame, key="doc_id") -> DataFrame:
    """Every record with its shard, and with `slot`, its place in the shard from 0 without gaps.

    A place is the number of records in the shard's earlier virtual slots plus the place among
    those of its own, so the largest sort is one of a virtual slot.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = slot_map.join(F.broadcast(slot_bytes(records)), "virtual_slot").select(
        "virtual_slot", "shard", "version",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("virtual_slot").orderBy(key, "size", "text_crc32")
    numbered = records.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(starts), "virtual_slot").select(
        key, "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("slot"),
        "virtual_slot", F.col("version").alias("map_version"))


def shard_documents(df: DataFrame, slots: int = SLOTS, shards: int = SHARDS,
                    key="doc_id", text="text") -> DataFrame:
    """Places the rows of `df` under a freshly balanced map (version 2 of a new folder).

    The broadcast tables have one row per virtual slot, so `slots` bounds them. Null texts count
    as empty. Repeated rows are separate records in the same slot, in any order among
    themselves. An empty table gives no rows. Columns other than `key` and `text` are ignored.
    """
    spark = df.sparkSession
    records = cut_lineage(sized_records(df, slots, key, text), "sharding-records")
    folder = work_folder(spark, "slot-maps")
    store_map(first_map(spark, slots, shards), folder)
    store_map(rebalance(read_map(spark, folder, 1), slot_bytes(records), shards), folder)
    return place(records, read_map(spark, folder, 2), key)
