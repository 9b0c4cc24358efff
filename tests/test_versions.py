"""Tables in buckets, rebuilds with one swap, and runs merged in tiers."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.operators import changes as C
from fieldweave.sources import buckets as B
from fieldweave.sources import lens as L
from fieldweave.sources import rebuild as R
from fieldweave.sources import versions as V
from fieldweave.streaming import sync as Y


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/version=*/**/*.parquet", recursive=True)}


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/table"
    B.create_buckets(spark.range(400).selectExpr("id", "concat('a', id) as name"), path, "id", 16)
    return path


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, at long, gone boolean")


def test_an_upsert_writes_only_the_buckets_it_hits(spark, table):
    before = files(table)
    changes = batch(spark, [(7, "old", 1, False), (7, "new", 2, False), (8, "x", 1, True), (8, "y", 0, False), (1000, "in", 1, None)])
    hit = B.upsert_buckets(changes, table, 1, ["at"], F.col("gone"))
    assert 1 <= len(hit) <= 3
    after = files(table)
    assert {f: after[f] for f in before} == before and len(after) - len(before) <= len(hit)
    expected = {(i, f"a{i}") for i in range(400)} - {(7, "a7"), (8, "a8")} | {(7, "new"), (1000, "in")}
    assert set(rows_of(B.read_buckets(spark, table))) == expected
    read = {f.split("/version=")[1].split("/")[0] for f in B.read_buckets(spark, table).inputFiles()}
    assert read == {"0", "1"}
    assert B.upsert_buckets(changes, table, 1, ["at"], F.col("gone")) == [] and files(table) == after


def test_a_batch_that_fails_before_the_pointer_changes_nothing(spark, table, monkeypatch):
    before = rows_of(B.read_buckets(spark, table))
    changes = batch(spark, [(i, "z", 1, False) for i in range(50)])
    with monkeypatch.context() as patched:
        patched.setattr(B, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            B.upsert_buckets(changes, table, 1, ["at"])
    assert rows_of(B.read_buckets(spark, table)) == before
    assert B.upsert_buckets(changes, table, 1, ["at"]) and B.read_buckets(spark, table).where("name = 'z'").count() == 50


def test_buckets_may_become_empty_and_fill_again(spark, tmp_path):
    path = f"{tmp_path}/table"
    B.create_buckets(spark.range(3).selectExpr("id", "'a' as name"), path, "id", 4)
    B.upsert_buckets(batch(spark, [(i, None, 1, True) for i in range(3)]), path, 1, ["at"], F.col("gone"))
    assert B.read_buckets(spark, path).count() == 0
    B.upsert_buckets(batch(spark, [(2, "b", 2, False)]), path, 2, ["at"], F.col("gone"))
    B.upsert_buckets(batch(spark, []), path, 3, ["at"], F.col("gone"))
    assert rows_of(B.read_buckets(spark, path)) == [(2, "b")]
    with pytest.raises(ValueError):
        B.create_buckets(spark.range(3), path, "id", 4)
    with pytest.raises(ValueError):
        B.read_buckets(spark, f"{tmp_path}/nothing")


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    V.publish(spark, f"{tmp_path}/t", {"n": 1})
    seen = V._latest(spark, f"{tmp_path}/t")
    V.publish(spark, f"{tmp_path}/t", {"n": 2})
    monkeypatch.setattr(V, "_latest", lambda *a: seen)
    with pytest.raises(RuntimeError):
        V.publish(spark, f"{tmp_path}/t", {"n": 3})
    monkeypatch.undo()
    assert V.current(spark, f"{tmp_path}/t") == {"n": 2} and V.current(spark, f"{tmp_path}/none") is None


@pytest.fixture(scope="module")
def synced(spark, data_dir, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("synced"))
    L.documents(spark, data_dir).write.parquet(f"{work}/docs")
    L.outbox(spark, data_dir).write.parquet(f"{work}/log")
    return spark.read.parquet(f"{work}/docs"), spark.read.parquet(f"{work}/log")


def test_a_rebuild_is_served_whole_or_not_at_all(spark, synced, tmp_path, monkeypatch):
    docs, log = synced
    changes, path = C.to_change(log), f"{tmp_path}/served"
    times = sorted(r[0] for r in log.select("created_at").collect())
    middle = times[len(times) // 2]
    old = docs.withColumn("name", F.lit("old"))
    with pytest.raises(ValueError):
        R.read_served(spark, path)
    assert R.rebuild(old, path, "first", middle, changes.limit(0), L.CONTACT_CATALOG) == middle
    with monkeypatch.context() as patched:
        patched.setattr(R, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            R.rebuild(docs, path, "second", middle, changes, L.CONTACT_CATALOG)
    assert R.read_served(spark, path).where("name <> 'old'").count() == 0
    early = changes.where(F.col("event_time") <= F.lit(times[-20]))
    assert R.rebuild(docs, path, "second", middle, early, L.CONTACT_CATALOG) == times[-20]
    assert R.catch_up(spark, path, "third", changes, L.CONTACT_CATALOG) == times[-1] == R.served_until(spark, path)
    newer = changes.where(F.col("event_time") > F.lit(middle))
    expected = C.apply_changes(docs, newer, catalog=L.CONTACT_CATALOG).documents
    assert rows_of(R.read_served(spark, path).select("id", "name", "email")) == rows_of(expected.select("id", "name", "email"))
    assert R.catch_up(spark, path, "fourth", changes.limit(0), L.CONTACT_CATALOG) == dt.datetime.fromisoformat(times[-1].isoformat())


def test_tiers_keep_the_number_of_runs_small(spark, synced, tmp_path):
    docs, log = synced
    target, batches, fan = f"{tmp_path}/target", 14, 3
    document = C.widened_type(C.document_type(L.CONTACT_CATALOG, T.LongType()), L.CONTACT_CATALOG)
    part = lambda n: log.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == n)
    for n in range(batches):
        Y.write_batch(part(n), n, document, target, fan)
        runs = Y.live_runs(spark, target)
        assert len(runs) <= (fan - 1) * 3
        assert sorted((r["first"], r["last"]) for r in runs)[-1][1] == n
    Y.write_batch(part(batches - 1), batches - 1, document, target, fan)
    assert Y.live_runs(spark, target) == runs
    assert [r["tier"] for r in runs] == [2, 1, 0, 0]
    expected = C.apply_changes(docs, C.to_change(log), catalog=L.CONTACT_CATALOG).documents
    found = Y.synced_documents(spark, target, docs, catalog=L.CONTACT_CATALOG)
    shown = ["id", "name", "email", "updated_at", "custom_fields.score__c"]
    assert rows_of(found.where("custom_fields.score__c is not null").select(shown)) == rows_of(expected.where("custom_fields.score__c is not null").select(shown))
    assert found.count() == expected.count()
    folders = {f.split("/target/")[1].rsplit("/", 1)[0] for f in Y.written_changes(spark, target).inputFiles()}
    assert folders == {r["folder"] for r in runs}
    with pytest.raises(ValueError):
        Y.write_batch(part(0), 99, document, target, 1)
