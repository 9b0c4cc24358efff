"""A table in hash buckets, of which a batch of changes rewrites those it hits.

Each bucket is a folder of the version (the batch) that wrote it last; the table's pointer names the version of each.
A batch reads and writes the buckets of its keys and no others, so it costs what it touches and not the size of the table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.session import new_work_dir, remove, settle_at
from fieldweave.sources.versions import current, publish

_BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, batch: int, key: str, buckets: int, written: int) -> None:
    dealt = rows.withColumn(_BUCKET, bucket_of(key, buckets)).repartition(max(1, written), _BUCKET)
    dealt.sortWithinPartitions(_BUCKET, key).write.mode("overwrite").partitionBy(_BUCKET).parquet(_data(path, batch))


def _data(path: str, batch: int) -> str:
    return f"{path}/version={batch}"


def _held(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that rows have keys in; no more than there are buckets."""
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def create_buckets(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table of the rows, one for each key, as of batch 0. As many buckets as make one a fit size for a task."""
    if current(rows.sparkSession, path) is not None:
        raise ValueError(f"{path} is a table already")
    _write(rows, path, 0, key, buckets, buckets)
    written = rows.sparkSession.read.schema(rows.schema).parquet(_data(path, 0))
    state = {"key": key, "buckets": buckets, "batch": 0, "schema": rows.schema.json()}
    publish(rows.sparkSession, path, state | {"versions": {str(b): 0 for b in _held(written, key, buckets)}})


def _read(spark: SparkSession, path: str, state: dict, buckets: list[int]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    folders = [f"{_data(path, state['versions'][str(b)])}/{_BUCKET}={b}" for b in buckets if str(b) in state["versions"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last batch."""
    state = current(spark, path)
    if state is None:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, state, [int(b) for b in state["versions"]])


def read_buckets_of(keys: DataFrame, path: str) -> DataFrame:
    """Of the table, the buckets that the keys are in."""
    spark = keys.sparkSession
    state = current(spark, path)
    if state is None:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, state, _held(keys, state["key"], state["buckets"]))


def upsert_buckets(changes: DataFrame, path: str, batch: int, version: list[str], deleted: Column | None = None) -> list[int]:
    """Put changed rows in by key and take deleted ones out; gives the buckets that were rewritten.

    Batches are numbered upwards; one that is in the table already changes nothing, so a batch can be run again. Of
    several changes to a key that with the greatest version holds; they are reduced before they are shuffled. Rows have
    the columns of the table and those of the version.
    """
    spark = changes.sparkSession
    state = current(spark, path)
    if state is None:
        raise ValueError(f"no table at {path}")
    if batch <= state["batch"]:
        return []
    key, buckets = state["key"], state["buckets"]
    columns = T.StructType.fromJson(json.loads(state["schema"])).names
    gone = F.coalesce(F.lit(False) if deleted is None else deleted, F.lit(False)).alias("_gone")
    reduced = changes.groupBy(key).agg(F.max_by(F.struct(*columns, gone), F.struct(*version)).alias("row")).select("row.*")
    work = new_work_dir(spark, "bucket-changes")
    newest = settle_at(reduced, work)
    hit = _held(newest, key, buckets)
    old = _read(spark, path, state, hit).join(newest.select(key), key, "left_anti").select(columns)
    rows = old.unionByName(newest.where("not _gone").select(columns))
    _write(rows, path, batch, key, buckets, len(hit))
    written = _held(spark.read.schema(rows.schema).parquet(_data(path, batch)), key, buckets)
    versions = {b: v for b, v in state["versions"].items() if int(b) not in hit} | {str(b): batch for b in written}
    publish(spark, path, state | {"batch": batch, "versions": versions})
    remove(spark, work)
    return hit
