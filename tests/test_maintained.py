"""Counts and postings kept from changes against counts and postings made anew."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import maintained as M
from fieldweave.sources import sums as U

SCHEMA = "id long, tier string, body string, event_time timestamp_ntz, event_id string, gone boolean"
START = dt.datetime(2024, 1, 1)
BODIES = ["gold client", "Gold GOLD", "", None, "홍길동 ana", "banana 42"]


def derived():
    columns = {"body": F.col("body"), "tier": F.col("tier")}
    return {"terms": M.term_counts(["tier"]), "postings": M.postings(columns), "lengths": M.lengths(columns)}


def first_rows():
    return [(i, "ab"[i % 2] if i % 5 else None, BODIES[i % 6]) for i in range(40)]


def events(seed, count=60):
    pick = random.Random(seed)
    rows = []
    for n in range(count):
        gone = pick.random() < 0.3
        body, tier = (None, None) if gone else (pick.choice(BODIES), pick.choice(["a", "b", "c", None]))
        rows.append((pick.randrange(50), tier, body, START + dt.timedelta(hours=pick.randrange(20)), f"{seed}-{n:03d}", gone))
    return rows


def expected(batches):
    state = {i: (None, t, b, False) for i, t, b in first_rows()}
    for row in (r for batch in batches for r in batch):
        version = row[3], row[4]
        if row[0] not in state or state[row[0]][0] is None or state[row[0]][0] < version:
            state[row[0]] = (version, row[1], row[2], row[5])
    return sorted((i, t, b) for i, (_, t, b, gone) in state.items() if not gone)


def check(spark, path, batches):
    rows = M.read_maintained(spark, path)
    by_id = lambda r: r[0]
    assert sorted(map(tuple, rows.collect()), key=by_id) == sorted(expected(batches), key=by_id)
    for name, what in derived().items():
        anew = what.rows(rows).select(*what.keys, *what.amounts)
        kept = M.read_derived(spark, path, name).select(*what.keys, *what.amounts)
        assert kept.exceptAll(anew).count() == 0 == anew.exceptAll(kept).count(), name


@pytest.fixture
def path(spark, tmp_path):
    path = f"{tmp_path}/kept"
    M.create_maintained(spark.createDataFrame(first_rows(), "id long, tier string, body string"), derived(), path, 8)
    return path


def test_replayed_and_late_changes(spark, path):
    batches = [events(1), events(2, 3), [], events(1)[::-1], events(3) + events(3)[:20]]
    for number, rows in enumerate(batches, 1):
        frame = spark.createDataFrame(rows, SCHEMA)
        assert M.apply_to_maintained(frame, derived(), path, number, fan=3)
        assert not M.apply_to_maintained(frame, derived(), path, number, fan=3)
    check(spark, path, batches)
    runs = U.current(spark, f"{path}/terms")["runs"]
    assert all(sum(r["tier"] == t for r in runs) < 3 for t in range(4)) and len(runs) < 5


def test_a_run_that_ends_between_sums_can_be_run_again(spark, path, monkeypatch):
    frame = spark.createDataFrame(events(4), SCHEMA)
    add, done = M.add_to_sums, []

    def lost(*args):
        if len(done) == 2:
            raise OSError("lost")
        done.append(add(*args))

    with monkeypatch.context() as patched:
        patched.setattr(M, "add_to_sums", lost)
        with pytest.raises(OSError):
            M.apply_to_maintained(frame, derived(), path, 1)
    assert M.apply_to_maintained(frame, derived(), path, 1)
    check(spark, path, [events(4)])


def test_a_small_batch_writes_little(spark, path):
    size = len(glob.glob(f"{path}/rows/version=*/**/*.parquet", recursive=True))
    M.apply_to_maintained(spark.createDataFrame([(7, "z", "tin", START, "e", False)], SCHEMA), derived(), path, 1)
    assert len(glob.glob(f"{path}/rows/version=*/**/*.parquet", recursive=True)) == size + 1
    run = spark.read.parquet(f"{path}/terms/run=1-0")
    assert {(r["value"], r["n"]) for r in run.collect()} == {("z", 1), ("b", -1)}


def test_a_table_without_rows(spark, tmp_path):
    path = f"{tmp_path}/kept"
    M.create_maintained(spark.createDataFrame([], "id long, tier string, body string"), derived(), path, 4)
    assert M.read_derived(spark, path, "terms").count() == 0 == M.read_maintained(spark, path).count()
    M.apply_to_maintained(spark.createDataFrame([(1, "a", "gold", START, "e", False), (2, None, None, START, "f", True)], SCHEMA), derived(), path, 1)
    assert [tuple(r) for r in M.read_derived(spark, path, "terms").collect()] == [("tier", "a", 1)]


def many(spark, count):
    return spark.range(count).select("id", F.lit("a").alias("tier"), F.concat(F.lit("client "), F.col("id")).alias("body"))


def test_small_batches_leave_the_first_run_as_it_is(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "_BITS", 64 * 64)
    path = f"{tmp_path}/kept"
    M.create_maintained(many(spark, 400), derived(), path, 4)
    for batch in range(1, 5):
        rows = [(batch * 3, None, None, START, f"{batch}", True), (1000 + batch, "b", "gold client", START, f"n{batch}", False)]
        M.apply_to_maintained(spark.createDataFrame(rows, SCHEMA), derived(), path, batch, fan=3)
    assert "0-0" in [r["name"] for r in U.current(spark, f"{path}/postings")["runs"]]
    state = U.current(spark, f"{path}/postings")
    hit = U._hit(U._read(spark, f"{path}/postings", state, [r["name"] for r in state["runs"] if r["name"] != "0-0"]), "id")
    first = U._read(spark, f"{path}/postings", state, ["0-0"])
    changed = {3, 6, 9, 12}
    assert changed <= {r[0] for r in first.where(hit).select("id").distinct().collect()} < set(range(40))
    rows = M.read_maintained(spark, path)
    for name, what in derived().items():
        anew = what.rows(rows).select(*what.keys, *what.amounts)
        kept = M.read_derived(spark, path, name).select(*what.keys, *what.amounts)
        assert kept.exceptAll(anew).count() == 0 == anew.exceptAll(kept).count(), name


def test_runs_as_large_as_the_first_are_merged_with_it(spark, tmp_path):
    path = f"{tmp_path}/sums"
    start = spark.createDataFrame([("a", 1, 5), ("b", 2, 1)], "word string, id long, n long")
    U.create_sums(start, path, ("word", "id"), ("n",), "id", added=True)
    for batch, rows in enumerate(([("a", 1, -5)], [("c", 3, 2)], [("c", 3, 1), ("b", None, 4)]), 1):
        U.add_to_sums(spark.createDataFrame(rows, start.schema), path, batch)
    assert [r["name"] for r in U.current(spark, path)["runs"]] == ["3-first"]
    assert sorted(tuple(r) for r in U.read_sums(spark, path).collect() if r[1]) == [("b", 2, 1), ("c", 3, 3)]
    assert U.read_sums(spark, path).count() == 3
