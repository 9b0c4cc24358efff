"""A table of sums that batches of signed rows change.

A batch adds a run of rows (keys, amounts), its amounts above or below zero; a reader adds up the runs. Runs are merged in
tiers, so a reader has fewer than ``fan`` of each tier, and all with the first run once they have as many rows as that: a
small batch does not have a large table written anew. Amounts that cancel out leave no row. The pointer names the runs in
force and the last batch, so a batch that is run again changes nothing.

A table can have a key that its batches come by (``by``), such as the id of the rows that the sums are derived from. Then a
reader takes rows of the first run as they are, if no other run has their value of it, and adds up only what is left.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.sources.versions import current, publish


#: The tier of the first run, which the others are merged with only once they are as large.
_FIRST = -1
_BITS = 2**23


def _added(rows: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """One row per key with its amounts; adding up begins where the rows are."""
    left = reduce(lambda a, b: a | b, [F.col(a) != 0 for a in amounts])
    return rows.groupBy(*keys).agg(*[F.sum(a).cast("long").alias(a) for a in amounts]).where(left)


def create_sums(
    rows: DataFrame, path: str, keys: Sequence[str], amounts: Sequence[str], by: str | None = None, added: bool = False
) -> None:
    """A table of the sums of the rows, as of batch 0. ``added`` rows have each key once and amounts that are not all 0."""
    spark = rows.sparkSession
    if current(spark, path) is not None:
        raise ValueError(f"{path} is a table already")
    sums = rows.select(*keys, *amounts) if added else _added(rows, keys, amounts)
    state = {"keys": list(keys), "amounts": list(amounts), "by": by, "schema": sums.schema.json(), "batch": 0}
    run = _write(spark, sums, path, state, "0-0", _FIRST)
    publish(spark, path, state | {"runs": [run]})


def _write(spark: SparkSession, sums: DataFrame, path: str, state: dict, name: str, tier: int) -> dict:
    """Write a run. Each of its files is sorted by the keys, so that a lookup reads few pages of it."""
    sums.sortWithinPartitions(*state["keys"]).write.mode("overwrite").parquet(f"{path}/run={name}")
    return {"name": name, "tier": tier, "rows": _read(spark, path, state, [name]).count()}


def _state(spark: SparkSession, path: str) -> dict:
    state = current(spark, path)
    if state is None:
        raise ValueError(f"no table at {path}")
    return state


def _read(spark: SparkSession, path: str, state: dict, names: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    return spark.read.schema(schema).parquet(*[f"{path}/run={n}" for n in names])


def _sum_of(spark: SparkSession, path: str, state: dict, runs: Sequence[dict]) -> DataFrame:
    keys, amounts, by = state["keys"], state["amounts"], state.get("by")
    names = [r["name"] for r in runs]
    first = [r["name"] for r in runs if r["tier"] == _FIRST]
    others = [r["name"] for r in runs if r["tier"] != _FIRST and r.get("rows") != 0]
    if first and not others:
        return _read(spark, path, state, first)
    if not first or not by:
        return _added(_read(spark, path, state, names), keys, amounts)
    rows, changes = _read(spark, path, state, first), _read(spark, path, state, others)
    hit = _hit(changes, by)
    return rows.where(~hit).unionByName(_added(rows.where(hit).unionByName(changes), keys, amounts))


def _hit(changes: DataFrame, by: str) -> Column:
    """Whether a row has a value that occurs in the changes, by one bit for each hash: false only if it does not. The bits are
    one value in the plan, so their number is fixed; the more values there are, the more others look like one of them."""
    bit = F.pmod(F.xxhash64(by), F.lit(_BITS))
    word, place = F.shiftright(bit, 6), bit.bitwiseAND(F.lit(63)).cast("int")
    of_word = changes.select(word.alias("id"), F.expr("1L").alias("one"), place.alias("place")).groupBy("id").agg(
        F.bit_or(F.call_function("shiftleft", "one", "place")).alias("bits")
    )
    words = changes.sparkSession.range(_BITS // 64).join(of_word, "id", "left")
    every = words.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("all"))
    return F.call_function("getbit", F.get(every.select(F.col("all.bits")).scalar(), word.cast("int")), place) == 1


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """The sums as of the last batch. A condition on keys reaches the files of every run, which are sorted by them."""
    state = _state(spark, path)
    return _sum_of(spark, path, state, state["runs"])


def add_to_sums(rows: DataFrame, path: str, batch: int, fan: int = 8) -> bool:
    """Add a batch of signed rows; false if the table has it already. Batches are numbered upwards."""
    spark = rows.sparkSession
    state = _state(spark, path)
    if batch <= state["batch"]:
        return False
    runs = [*state["runs"], _write(spark, _added(rows, state["keys"], state["amounts"]), path, state, f"{batch}-0", 0)]
    tier = 0
    while len(full := [r for r in runs if r["tier"] == tier]) >= fan:
        merged = _write(spark, _sum_of(spark, path, state, full), path, state, f"{batch}-{tier + 1}", tier + 1)
        runs = [r for r in runs if r["tier"] != tier] + [merged]
        tier += 1
    first, others = [r for r in runs if r["tier"] == _FIRST], [r for r in runs if r["tier"] != _FIRST]
    if first and sum(r["rows"] for r in others) > sum(r["rows"] for r in first):
        runs = [_write(spark, _sum_of(spark, path, state, runs), path, state, f"{batch}-first", _FIRST)]
    publish(spark, path, state | {"batch": batch, "runs": runs})
    return True
