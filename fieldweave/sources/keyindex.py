"""Stored keys in hash buckets, with a signature for each bucket that tells which buckets a batch has to read.

A signature is a Bloom filter in bitmaps of 32,768 bits: a key it lacks is not in the bucket. So a batch of mostly new
keys reads the buckets of the few that may be known, not all keys; those are then compared themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.session import settle
from fieldweave.sources import buckets as B
from fieldweave.sources.versions import current, publish

_BITS = 32_768  # of a bitmap that Spark's bitmap functions make
_HASHES = 4


def create_key_index(keys: DataFrame, path: str, buckets: int, bitmaps: int = 1) -> None:
    """An index of the keys (one column; nulls are no keys), as of batch 0. A bucket has ``bitmaps`` bitmaps; with 3,000 keys
    for each, one new key in 100 is looked up in vain, with more keys more of them. A run that ended early can be run again."""
    [key] = keys.columns
    distinct = settle(keys.where(F.col(key).isNotNull()).distinct(), "index-keys")
    _publish(distinct, path, {"key": key, "buckets": buckets, "bitmaps": bitmaps})
    B.create_buckets(distinct, f"{path}/keys", key, buckets)


def add_keys(keys: DataFrame, path: str, batch: int) -> None:
    """Add a batch of keys; those in the index already, or a batch that is, change nothing. The signature has them first:
    a run that ends before the keys are there leaves one that lets more keys through, and nothing else."""
    state = _state(keys.sparkSession, path)
    key = state["key"]
    distinct = settle(keys.select(key).where(F.col(key).isNotNull()).distinct(), "index-keys")
    _publish(distinct, path, state)
    B.upsert_buckets(distinct, f"{path}/keys", batch, [key])


def known_keys(keys: DataFrame, path: str) -> DataFrame:
    """The distinct keys of a batch that are in the index."""
    key = _state(keys.sparkSession, path)["key"]
    stored = settle(possible_keys(keys, path), "possible-keys")
    return stored.join(B.read_buckets_of(stored, f"{path}/keys"), key, "left_semi")


def possible_keys(keys: DataFrame, path: str) -> DataFrame:
    """The distinct keys of a batch that the signatures do not rule out."""
    spark = keys.sparkSession
    state = _state(spark, path)
    key = state["key"]
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    found = _spots(distinct, state, F.col(key)).join(_signature(spark, state), ["bucket", "part"], "left")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("bit") % 8).cast("int")) > 0
    tested = found.select(key, F.coalesce(is_set, F.lit(False)).alias("set"))
    return tested.groupBy(key).agg(F.every("set").alias("all")).where("all").select(key)


def _state(spark: SparkSession, path: str) -> dict:
    state = current(spark, f"{path}/signature")
    if state is None:
        raise ValueError(f"no index at {path}")
    return state


def _spots(keys: DataFrame, state: dict, *kept: Column) -> DataFrame:
    """Where the keys are in the signatures: bucket, part (which of its bitmaps), bit."""
    key, size = state["key"], state["bitmaps"] * _BITS
    spots = F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(size)) for i in range(_HASHES)])
    rows = keys.select(*kept, B.bucket_of(key, state["buckets"]).alias("bucket"), F.explode(spots).alias("spot"))
    return rows.select(*kept, "bucket", F.shiftright("spot", 15).cast("int").alias("part"), F.col("spot").bitwiseAND(F.lit(_BITS - 1)).alias("bit"))


def _signature(spark: SparkSession, state: dict) -> DataFrame:
    return spark.read.schema("bucket int, part int, bits binary").parquet(state["folder"])


def _publish(keys: DataFrame, path: str, state: dict) -> None:
    spark = keys.sparkSession
    rows = _spots(keys, state).groupBy("bucket", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    if "folder" in state:
        rows = rows.unionByName(_signature(spark, state)).groupBy("bucket", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    folder = f"{path}/signature/bits-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    publish(spark, f"{path}/signature", state | {"folder": folder})
