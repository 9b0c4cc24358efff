"""Counts and postings that follow a change log.

A table of current rows is kept in hash buckets by id, with the version of each row and deleted ones as rows that are
gone. A batch of changes reads the buckets it hits, leaves out changes that are not newer than what is stored, and gives
the old and the new version of every row that it changes. What is derived from rows and adds up over them (counts of
values, postings, lengths) then gets the rows derived from the new versions, and those from the old ones below zero. So
replayed, repeated and late changes leave the sums as if counted anew.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.operators.changes import VERSION
from fieldweave.operators.textsearch import field_lengths, index_parts, ngram_index
from fieldweave.session import new_work_dir, remove, settle_at
from fieldweave.sources import buckets as B
from fieldweave.sources.sums import add_to_sums, create_sums, read_sums
from fieldweave.sources.versions import current

GONE = "gone"


@dataclass(frozen=True)
class Derived:
    """Rows (keys, amounts) that are derived from rows and add up over them. ``by`` names the key that is the id of the row
    that each is derived from, if there is one; then ``rows`` gives each key once, with amounts above 0."""

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    amounts: tuple[str, ...]
    by: str | None = None

    def signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return self.rows(rows).select(*self.keys, *[(F.col(a) * sign).cast("long").alias(a) for a in self.amounts])


def term_counts(fields: Sequence[str]) -> Derived:
    """(field, value, n): how many rows have a value, null one too."""

    def rows(docs: DataFrame) -> DataFrame:
        cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
        return docs.select(F.inline(F.array(*cells))).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))

    return Derived(rows, ("field", "value"), ("n",))


def postings(columns: Mapping[str, Column]) -> Derived:
    """The gram index (field, gram, id, tf, length)."""

    def rows(docs: DataFrame) -> DataFrame:
        return ngram_index(docs, columns, parts=index_parts(docs, columns))

    return Derived(rows, ("field", "gram", "id"), ("tf", "length"), "id")


def lengths(columns: Mapping[str, Column]) -> Derived:
    """(field, docs, length) of the searched fields."""
    return Derived(lambda docs: field_lengths(docs, columns), ("field",), ("docs", "length"))


def versioned(changes: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """Changes with their payload as a document, as rows of a maintained table: id, the fields, version, ``gone``."""
    gone = F.col("type") == S.DELETED
    kept = [F.when(~gone, c).alias(n) for n, c in fields.items()]
    return changes.select(F.col("contact_id").alias("id"), *kept, *VERSION, gone.alias(GONE))


def create_maintained(
    rows: DataFrame, derived: Mapping[str, Derived], path: str, buckets: int, event_id: str = "string"
) -> None:
    """A table of rows, one for each id, that all changes are newer than, with its sums. ``event_id`` is the type of the
    events' ids. A run that ended early can be run again."""
    spark = rows.sparkSession
    version = [F.lit(None).cast(kind).alias(name) for name, kind in zip(VERSION, ("timestamp_ntz", event_id))]
    work = new_work_dir(spark, "maintained")
    rows = settle_at(rows, work)
    first = rows.select("*", *version, F.lit(False).alias(GONE))
    for name, what in derived.items():
        if current(spark, f"{path}/{name}") is None:
            create_sums(what.signed(rows, 1), f"{path}/{name}", what.keys, what.amounts, what.by, what.by is not None)
    B.create_buckets(first, f"{path}/rows", "id", buckets)
    remove(spark, work)


def apply_to_maintained(changes: DataFrame, derived: Mapping[str, Derived], path: str, batch: int, fan: int = 8) -> bool:
    """Apply a batch of versioned rows; false if the table has it already.

    The rows get the batch after all sums have it: a run that ended in between finds the same old versions when it is run
    again, and sums that have the batch leave it out.
    """
    spark = changes.sparkSession
    table = f"{path}/rows"
    if batch <= current(spark, table)["batch"]:
        return False
    columns = B.read_buckets(spark, table).columns
    newest = changes.groupBy("id").agg(F.max_by(F.struct(*columns), F.struct(*_version())).alias("new"))
    work = new_work_dir(spark, "maintained")
    newest = settle_at(newest, f"{work}/newest")
    old = B.read_buckets_of(newest, table).select("id", F.struct(*columns).alias("old"))
    later = F.col("old").isNull() | (F.struct(*_version("new.")) > F.struct(*_version("old.")))
    pairs = settle_at(newest.join(old, "id", "left").where(later), f"{work}/pairs")
    before, after = pairs.where("old is not null and not old.gone").select("old.*"), pairs.where("not new.gone").select("new.*")
    for name, what in derived.items():
        add_to_sums(what.signed(after, 1).unionByName(what.signed(before, -1)), f"{path}/{name}", batch, fan)
    B.upsert_buckets(pairs.select("new.*"), table, batch, list(VERSION))
    remove(spark, work)
    return True


def _version(of: str = "") -> list[Column]:
    """What decides which of two versions holds: the first of a row, which has no time, is the oldest."""
    time, event = (F.col(of + name) for name in VERSION)
    return [time.isNotNull(), time, event]


def read_maintained(spark: SparkSession, path: str) -> DataFrame:
    """The current rows."""
    return B.read_buckets(spark, f"{path}/rows").where(~F.col(GONE)).drop(*VERSION, GONE)


def read_derived(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read_sums(spark, f"{path}/{name}")
