"""What the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space. Fixed value.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until the frame has no such column (names are compared without case)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Hand free memory to the system. A worker lives on between tasks, and its allocators keep the peak of the last one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A task over batches that keeps no free memory once it ends, and none of Arrow's after a batch."""

    def each(batches: Iterable) -> Iterator:
        for batch in batches:
            yield batch
            pa.default_memory_pool().release_unused()

    # Spark takes the kind of a pandas UDF from the annotations.
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(each(batches))
        finally:
            give_back()

    return tidied
