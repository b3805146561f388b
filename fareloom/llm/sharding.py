"""Shards by fixed virtual slots.

Each record hashes into one of thousands of slots, whose number never changes. Bytes are added up per slot, and a
versioned map sends slots to shards. Version 0 deals the slots out in turn; rebalancing writes the next version, which
keeps most slots where they are and moves small ones until the shards are near equal in bytes.

Law: `bytes`. The slot is a hash of id, size, checksum of the text and copy number, so neither a row repeated any number
of times nor one id (or null) with many texts gathers in a slot. A null text has no bytes. An empty table gives no
rows (the map is still written). Columns other than the named ones are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.llm.common import shared_dir, stored, table

#: Virtual slots, whatever the size of the table: the map has that many rows, so it is always small.
SLOTS = 4096
#: A row's size besides its text.
ROW_BYTES = 8
#: Share of its fair size up to which a shard keeps the slots that it has; the rest of them is dealt anew.
KEEP_SHARE = 0.9
#: Copies of one row are numbered in runs of this many.
RUN = 65_536


def measured(docs: DataFrame) -> DataFrame:
    """(id, size, text_crc32, vslot), one row for each document; equal rows get different copy numbers."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col("doc_id").alias("id"), (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    counted = narrow.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN).cast("long"))))
    last = F.least(F.col("n") - 1, (F.col("run") + 1) * RUN - 1)
    copies = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN, last)))
    return copies.select(
        "id", "size", "text_crc32", F.pmod(F.xxhash64("id", "size", "text_crc32", "copy"), F.lit(SLOTS)).cast("int").alias("vslot")
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    """(vslot, bytes, rows) for every slot, empty ones included: SLOTS rows."""
    found = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = records.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("vslot"))
    return every.join(found, "vslot", "left").na.fill(0, ["bytes", "rows"])


def first_map(spark: SparkSession, shards: int) -> DataFrame:
    """Version 0 of the map: the slots in turn."""
    return spark.range(SLOTS).select(
        F.lit(0).alias("map_version"), F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")
    )


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map, near equal in bytes.

    A shard keeps its slots, largest first, up to KEEP_SHARE of the fair size. What is left over goes, largest first,
    to the shard with the fewest bytes; the slots of shards that no longer exist are dealt out like these. All of it
    works on SLOTS rows.
    """
    known = slot_map.join(F.broadcast(sizes), "vslot")
    before = W.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(W.unboundedPreceding, 0)
    fair = F.sum("bytes").over(W.partitionBy()) / shards
    ranked = known.withColumn("fair", fair).withColumn("upto", F.sum("bytes").over(before))
    ranked = ranked.withColumn("stays", (F.col("shard") < shards) & ((F.col("upto") <= F.col("fair") * KEEP_SHARE) | (F.col("bytes") == 0)))
    one = ranked.agg(
        F.max("map_version").alias("map_version"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
        F.sort_array(
            F.collect_list(F.when(~F.col("stays"), F.struct("bytes", "vslot"))), asc=False
        ).alias("loose"),
    )

    def load(s: Column) -> Column:
        mine = F.filter("kept", lambda k: k["shard"] == s)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, k: acc + k["bytes"])

    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), load)
    start = F.struct(F.col("loads").alias("loads"), F.array().cast("array<struct<vslot:int,shard:int>>").alias("moves"))

    def place(acc: Column, slot: Column) -> Column:
        to = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda x, i: F.when(i == to, x + slot["bytes"]).otherwise(x)).alias("loads"),
            F.concat(acc["moves"], F.array(F.struct(slot["vslot"].alias("vslot"), to.alias("shard")))).alias("moves"),
        )

    moves = (
        one.withColumn("loads", loads)
        .select((F.col("map_version") + 1).alias("map_version"), F.explode(F.aggregate("loose", start, place, lambda a: a["moves"])).alias("m"))
        .select("map_version", "m.vslot", "m.shard")
    )
    stay = ranked.filter("stays").select((F.col("map_version") + 1).alias("map_version"), "vslot", "shard")
    return stay.unionByName(moves)


def current_map(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the stored map."""
    rows = spark.read.parquet(f"{path}/version=*")
    newest = rows.agg(F.max("map_version").alias("map_version"))
    return rows.join(F.broadcast(newest), "map_version")


def assign(records: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """records with shard and slot: the place in the shard, gapless from 0.

    Places are numbered within virtual slots and shifted by the rows of the shard's earlier slots, so no task numbers
    a whole shard.
    """
    earlier = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    offsets = slot_map.join(F.broadcast(sizes.select("vslot", "rows")), "vslot").select(
        "map_version", "vslot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("shift")
    )
    within = W.partitionBy("vslot").orderBy("id", "size", "text_crc32")
    return (
        records.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), "vslot")  # SLOTS rows
        .withColumn("slot", (F.col("shift") + F.col("place")).cast("long"))
    )


def shard_records(docs: DataFrame, shards: int, map_path: str) -> DataFrame:
    """Measure, write map version 0 if there is none, rebalance into the next version, and assign."""
    spark = docs.sparkSession
    records = stored(measured(docs), "records")
    sizes = stored(slot_sizes(records), "slots")
    first_map(spark, shards).write.mode("ignore").parquet(f"{map_path}/version=0")
    newest = current_map(spark, map_path)
    version = newest.first()["map_version"] + 1
    rebalanced(newest, sizes, shards).coalesce(1).write.parquet(f"{map_path}/version={version}")  # SLOTS rows
    return assign(records, current_map(spark, map_path), sizes)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    placed = shard_records(table(spark, sf_dir, "documents"), 24, shared_dir(spark, "slot-map"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        "map_version",
    )
