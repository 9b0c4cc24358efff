"""Sharding by longest processing time: equal texts stay together, shards get near equal bytes."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave.llm.common import text_or_empty
from fieldweave.session import settle


@dataclass(frozen=True)
class Settings:
    shards: int = 16
    #: Groups of a shard's bytes divided by this, or more, are scheduled one by one; there are shards * grain at most.
    #: Smaller ones are scheduled in as many bundles by hash.
    grain: int = 64
    #: Slots are counted in ranges of about so many rows.
    range_rows: int = 2_000


def longest_first(sizes: dict, shards: int) -> dict:
    """The shard of each item: in order of size, largest first, each goes to the shard with the least so far."""
    loads = [(0, shard) for shard in range(shards)]
    out = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        out[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return out


def assign_shards(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    The size is the UTF-8 bytes of the text and 1; null texts are like empty ones. Rows with equal texts, known by their
    SHA-256, are one group and share a shard, so a shard is larger than others if one group is larger than a shard's
    part. Slots count a shard's rows from 0 in an order by hash of the id. Repeated rows have slots of their own; no
    rows give no rows.

    The heap schedules at most ``2 * shards * grain`` items whatever the number of rows: groups above a shard's bytes
    over ``grain``, and bundles of all others.
    """
    text = text_or_empty("text")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"),
    )
    rows = settle(rows, "shard-rows")
    bundles = settings.shards * settings.grain
    groups = rows.groupBy("same").agg(F.sum("size").alias("bytes"))
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    least = max(1, math.ceil((total or 0) / bundles))
    groups = settle(groups.withColumn("bundle", F.pmod(F.xxhash64("same"), F.lit(bundles)).cast("int")), "shard-groups")
    large = {r["same"]: r["bytes"] for r in groups.where(F.col("bytes") >= least).select("same", "bytes").collect()}
    small = groups.where(F.col("bytes") < least).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()
    placed = longest_first({("large", bytes(k)): v for k, v in large.items()} | {("small", r["bundle"]): r["bytes"] for r in small}, settings.shards)
    spark = docs.sparkSession
    by_group = spark.createDataFrame([(bytearray(k), s) for (kind, k), s in placed.items() if kind == "large"], "same binary, own int")
    by_bundle = spark.createDataFrame([(k, s) for (kind, k), s in placed.items() if kind == "small"], "bundle int, common int")
    rows = rows.withColumn("bundle", F.pmod(F.xxhash64("same"), F.lit(bundles)).cast("int"))
    rows = rows.join(F.broadcast(by_group), "same", "left").join(F.broadcast(by_bundle), "bundle", "left")
    rows = rows.select("doc_id", "size", "text_crc32", F.coalesce("own", "common").alias("shard"))
    ranges = max(64, math.ceil((count or 0) / (settings.shards * settings.range_rows)))
    return with_slots(rows, ranges)


def with_slots(rows: DataFrame, ranges: int) -> DataFrame:
    """Adds ``slot``, gapless within a shard: the rank within a range of the shard, after the rows of all ranges before."""
    rows = rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(ranges)).cast("int"))
    counts = rows.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")) - 1
    rows = rows.withColumn("rank", rank).join(counts, ["shard", "range"])
    return rows.withColumn("slot", (F.col("start") + F.col("rank")).cast("long")).drop("range", "rank", "start")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """The documents in a folder for each shard; ids must be unique."""
    joined = docs.drop("shard", "slot").join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    files = F.pmod(F.xxhash64("slot"), F.lit(64))
    joined.repartition("shard", files).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
