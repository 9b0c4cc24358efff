"""Which data folders of a table are in force.

Data folders are written once and then only read. A pointer file names those in force; it is put in place by one
rename, so a reader sees the table before a change or after it, and a run that ends before the rename changes nothing.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

_POINTERS = "_pointers"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _latest(spark: SparkSession, table: str) -> int:
    folder, files = _folder(spark, f"{table}/{_POINTERS}")
    if not files.exists(folder):
        return -1
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(n.removesuffix(".json")) for n in names if n[0].isdigit()), default=-1)


def current(spark: SparkSession, table: str) -> dict[str, Any] | None:
    """What the newest pointer says, None for a table without one."""
    number = _latest(spark, table)
    if number < 0:
        return None
    path, files = _folder(spark, f"{table}/{_POINTERS}/{number:012d}.json")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def publish(spark: SparkSession, table: str, state: dict[str, Any]) -> None:
    """Put a new pointer in force. Fails if another writer has put one there in the meantime."""
    number = _latest(spark, table) + 1
    draft, files = _folder(spark, f"{table}/{_POINTERS}/.draft-{uuid.uuid4().hex}")
    target, _ = _folder(spark, f"{table}/{_POINTERS}/{number:012d}.json")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another writer changed {table}")
