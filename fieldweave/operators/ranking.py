"""Pages by rank and tops by threshold, from sorted keys that are stored in range partitions with their counts.

The counts are one number for each partition, so the place of any rank is known before anything is read, and a page
reads the partitions that hold it, however deep it lies.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.catalog import FieldCatalog
from fieldweave.operators.eav import matches
from fieldweave.operators.sorting import Sort

_PLACE = (1 << 33) - 1  # the part of a generated row number that counts within its partition


@dataclass(frozen=True)
class RankedKeys:
    """A stored table of keys in order: ``part`` (folder) and ``place`` say where a row stands."""

    rows: DataFrame
    parts: tuple[int, ...]
    counts: tuple[int, ...]
    #: Smallest and largest first key of each part.
    bounds: tuple[tuple[Any, Any], ...] = ()

    @property
    def total(self) -> int:
        return sum(self.counts)

    def between(self, low: int, high: int) -> DataFrame:
        """Rows of the ranks from low to below high, counted from 0, with their ``rank`` from 1."""
        starts = [0, *accumulate(self.counts)]
        high = min(high, self.total)
        if low >= high:
            return self.rows.where(F.lit(False)).drop("part", "place").withColumn("rank", F.lit(0).cast("long"))
        first, last = bisect_right(starts, low) - 1, bisect_right(starts, high - 1) - 1
        part, place = F.col("part"), F.col("place")
        wanted = (part >= self.parts[first]) & (part <= self.parts[last])
        wanted &= (part > self.parts[first]) | (place >= low - starts[first])
        wanted &= (part < self.parts[last]) | (place < high - starts[last])
        before = {self.parts[i]: starts[i] for i in range(first, last + 1)}
        start = F.lit(0)
        for at, n in before.items():
            start = F.when(part == at, n).otherwise(start)
        return self.rows.where(wanted).withColumn("rank", (start + place + 1).cast("long")).drop("part", "place")

    def page(self, page: int, size: int) -> DataFrame:
        return self.between((page - 1) * size, page * size).orderBy("rank")


def store_ranked(rows: DataFrame, order: Sequence[Column], path: str, first_key: str | None = None) -> RankedKeys:
    """Rows stored in an order that tells all of them apart (so it ends with an id, and many rows with one key are
    still dealt over partitions). ``first_key`` names the column whose bounds are kept for each part."""
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    place = F.col("_at").bitwiseAND(F.lit(_PLACE)).alias("place")
    parted = numbered.select(*rows.columns, F.shiftright("_at", 33).cast("int").alias("part"), place)
    parted.write.partitionBy("part").parquet(path)
    return open_ranked(rows.sparkSession, path, parted.schema, first_key)


def open_ranked(spark: SparkSession, path: str, schema: Any, first_key: str | None = None) -> RankedKeys:
    """Stored keys with their counts, which are read anew: one row for each partition."""
    stored = spark.read.schema(schema).parquet(path)
    kept = [] if first_key is None else [F.min(first_key).alias("low"), F.max(first_key).alias("high")]
    stats = sorted(stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *kept).collect(), key=lambda r: r["part"])
    bounds = tuple((r["low"], r["high"]) for r in stats) if kept else ()
    return RankedKeys(stored, tuple(r["part"] for r in stats), tuple(r["n"] for r in stats), bounds)


def beyond(keys: Sequence[tuple[Column, str]], last: Sequence[Any]) -> Column:
    """Rows after a known one in an order of several keys, missing values last both ways."""
    if len(keys) != len(last):
        raise ValueError("a cursor has a value for each key")
    after, equal = F.lit(False), F.lit(True)
    for (column, direction), value in zip(keys, last):
        if value is not None:
            known = F.lit(value)
            further = column < known if direction == "desc" else column > known
            after = after | (equal & (further | column.isNull()))
            equal = equal & (column == known)
        else:
            equal = equal & column.isNull()
    return F.coalesce(after, F.lit(False))


def page_after_keys(rows: DataFrame, keys: Sequence[tuple[Column, str]], last: Sequence[Any], size: int) -> DataFrame:
    """The page after a known last row at the cost of a top-k of one page: rows that can't come after it are dropped
    where they are read. The keys must tell rows apart, so they end with an id."""
    order = [c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last() for c, direction in keys]
    return rows.where(beyond(keys, last)).orderBy(*order).limit(size)


@dataclass(frozen=True)
class FieldIndex:
    """A field's values (id, value) in order, of contacts that exist."""

    name: str
    keys: RankedKeys

    def top(self, contacts: DataFrame, direction: str, size: int) -> DataFrame:
        """The first ``size`` contacts in the order of the field, missing values last, then id; with ``value``.

        Counts and bounds give the value that the last of them has or betters; only the parts that can hold such values are
        read, and only their rows meet the contacts. Contacts without the field are looked at only if fewer have it.
        """
        found = self.candidates(direction, size)
        rows = contacts.join(found, "id")
        missing = size - self.keys.total
        if missing > 0:
            without = contacts.join(self.keys.rows.select("id"), "id", "left_anti").orderBy("id").limit(missing)
            rows = rows.unionByName(without, allowMissingColumns=True)
        column = F.col("value")
        return rows.orderBy(column.desc_nulls_last() if direction == "desc" else column.asc_nulls_last(), "id").limit(size)

    def candidates(self, direction: str, size: int) -> DataFrame:
        """Few rows (id, value) that hold the first ``size`` of the order."""
        keys = self.keys
        if direction == "asc":
            return keys.between(0, size).select("id", "value")
        held, at = 0, len(keys.counts)
        while at > 0 and held < size:
            at -= 1
            held += keys.counts[at]
        if at == len(keys.counts):
            return keys.rows.where(F.lit(False)).select("id", "value")
        # Rows with the lowest value needed may lie in parts before this one, too.
        threshold = keys.bounds[at][0]
        parts = [p for p, (_, high) in zip(keys.parts, keys.bounds) if high >= threshold]
        near = keys.rows.where((F.col("part") >= min(parts)) & (F.col("value") >= F.lit(threshold)))
        return near.select("id", "value").orderBy(F.col("value").desc(), F.col("id")).limit(size)


def index_field(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, name: str, path: str) -> FieldIndex:
    """The index of a custom field, built once for many sorts: values typed, one for each contact."""
    found = matches(values, catalog, [], [name]).withColumnRenamed(name, "value").where("value is not null")
    found = found.join(contacts.select("id"), "id", "left_semi").select("id", "value")
    return FieldIndex(name, store_ranked(found, [F.col("value").asc(), F.col("id").asc()], path, "value"))


def cursor_keys(sorts: Sequence[Sort], column) -> list[tuple[Column, str]]:
    """The keys of a request's order with their directions: those of its sorts, newest first without any, then id."""
    keys = [(column(s.field), s.direction) for s in sorts]
    return [*(keys or [(F.col("created_at"), "desc")]), (F.col("id"), "asc")]
