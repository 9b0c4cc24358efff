"""Top rows by impact against scores of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import textsearch as X
from fieldweave.operators import topk as K

def columns():
    return {"body": F.col("body"), "title": F.col("title")}



@pytest.fixture(scope="module")
def docs(spark):
    pick = random.Random(5)
    words = ["gold", "gold", "silver", "copper", "tin", "lead", "zinc", "rare1"]
    rows = []
    for n in range(6000):
        body = " ".join(pick.choices(words[:7], k=pick.randint(0, 12)))
        title = pick.choice([None, "", "gold", "gold silver", "lead"]) if n % 900 else "rare1 gold"
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=pick.randint(0, 9)) if n % 11 else None
        rows.append((n, body if n % 13 else None, title, at))
    return spark.createDataFrame(rows, "id long, body string, title string, created_at timestamp_ntz")


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    return K.write_impacts(docs, columns(), f"{tmp_path_factory.mktemp('impacts')}/index")


def by_all(docs, words, size):
    scored = X.with_score(docs, columns(), words).withColumn("score", F.round("score", K.DIGITS))
    return [(r["id"], r["score"]) for r in scored.orderBy(*X.by_relevance()).limit(size).collect()]


@pytest.mark.parametrize(
    "words, size",
    [(["gold"], 20), (["gold"], 1), (["rare1"], 20), (["gold", "silver"], 20), (["rare1", "gold"], 10), (["tin", "tin", "lead"], 30), (["zinc"], 6000), (["none"], 5), ([], 5)],
)
def test_top_rows_are_those_of_all_scores(docs, index, words, size):
    found = [(r["id"], r["score"]) for r in index.top(words, size).collect()]
    expected = by_all(docs, words, size)
    assert [i for i, _ in found] == [i for i, _ in expected]
    assert [s for _, s in found] == pytest.approx([s for _, s in expected], abs=2e-9)


@pytest.mark.parametrize("words, share", [(["gold"], 0.1), (["zinc"], 0.1), (["rare1", "gold"], 0.7)])
def test_postings_below_the_bound_are_not_read(index, words, share):
    lists = index.lists(words, 10)
    read = index.candidates(lists, index.threshold(lists, 10)).count()
    assert 10 <= read <= share * index.postings.where(F.col("gram").isin(words)).count()
    assert index.first_blocks(lists).count() <= len(lists) * 1024 * 2


def test_impact_reaches_the_scan(spark, index):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    lists = index.lists(["zinc"], 5)
    plan = index.candidates(lists, index.threshold(lists, 5))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(impact" in plan


def test_no_documents(docs, tmp_path):
    index = K.write_impacts(docs.limit(0), columns(), f"{tmp_path}/index")
    assert index.top(["gold"], 5).collect() == []


def test_postings_are_made_where_documents_are(docs):
    plan = X.ngram_index(docs, columns(), parts=4)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange" in line]
    assert dealt and all("hashpartitioning(id#" in line for line in dealt), plan


def test_several_parts_give_the_top_rows_of_all(docs, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "_TASK", 100_000)
    some = docs.where("id < 3000")
    index = K.write_impacts(some, columns(), f"{tmp_path}/index")
    parts = index.postings.select(F.shiftright("block", 23).alias("part"), "*")
    assert parts.select("part").distinct().count() > 3
    assert parts.groupBy("id").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0
    for words, size in ((["gold"], 20), (["rare1", "gold"], 10), (["tin", "lead"], 500)):
        assert [r["id"] for r in index.top(words, size).collect()] == [i for i, _ in by_all(some, words, size)]
    lists = index.lists(["zinc"], 10)
    assert index.candidates(lists, index.threshold(lists, 10)).count() < 300


def test_blocks_of_a_list_are_in_order(index):
    blocks = {}
    for r in index.postings.where("field = 'title' and gram = 'gold'").collect():
        place = -int(r["impact"] * 2**32), -(r["created_at"] or dt.datetime.min).toordinal(), r["id"]
        blocks.setdefault(r["block"], []).append(place)
    assert len(blocks) > 2
    in_order = sorted(blocks)
    for a, b in zip(in_order, in_order[1:]):
        assert a >> 23 < b >> 23 or max(blocks[a]) < min(blocks[b])
