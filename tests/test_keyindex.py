"""Known keys by signature and bucket."""

import pytest
from pyspark.sql import functions as F

from fieldweave.sources import buckets as B
from fieldweave.sources import keyindex as K


@pytest.fixture
def index(spark, tmp_path):
    path = f"{tmp_path}/index"
    keys = spark.range(5000).selectExpr("if(id % 1000 = 0, null, concat('k', id)) as name")
    K.create_key_index(keys.unionByName(keys.limit(50)), path, 32)
    return path


def names(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "name string")


def known(spark, rows, index):
    return sorted(r["name"] for r in K.known_keys(names(spark, rows), index).collect())


def test_known_keys_are_found(spark, index):
    every = [f"k{i}" for i in range(7000)]
    assert known(spark, [*every, *every[:9], None, "", "K1"], index) == sorted(f"k{i}" for i in range(5000) if i % 1000)
    assert known(spark, [], index) == [] and known(spark, [None], index) == []


def test_few_buckets_are_read(spark, index):
    batch = names(spark, [f"new{i}" for i in range(200)] + ["k7", "k8"])
    possible = K.possible_keys(batch, index)
    assert possible.count() < 10
    read = B.read_buckets_of(possible, f"{index}/keys")
    assert 1 <= len({f.rsplit("/", 2)[1] for f in read.inputFiles()}) < 10
    assert known(spark, ["k7", "k8", "new1"], index) == ["k7", "k8"]


def test_added_keys_are_known(spark, index):
    for _ in range(2):
        K.add_keys(names(spark, ["new1", "new1", "k7", None]), index, 1)
    assert known(spark, ["new1", "new2", "k7", "k8"], index) == ["k7", "k8", "new1"]
    assert B.read_buckets(spark, f"{index}/keys").count() == 4996


def test_a_full_signature_still_gives_right_keys(spark, tmp_path):
    path = f"{tmp_path}/index"
    K.create_key_index(spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("name")), path, 1)
    assert known(spark, [f"k{i}" for i in range(39_900, 40_100)], path) == sorted(f"k{i}" for i in range(39_900, 40_000))


def test_an_empty_index(spark, tmp_path):
    path = f"{tmp_path}/index"
    K.create_key_index(names(spark, []), path, 4)
    assert known(spark, ["a"], path) == []
    K.add_keys(names(spark, ["a"]), path, 1)
    assert known(spark, ["a", "b"], path) == ["a"]


def test_more_bitmaps(spark, tmp_path):
    path = f"{tmp_path}/index"
    K.create_key_index(spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("name")), path, 2, bitmaps=4)
    new = names(spark, [f"new{i}" for i in range(1000)])
    assert K.possible_keys(new, path).count() < 50
    assert len(known(spark, [f"k{i}" for i in range(0, 20_000, 7)], path)) == 2858
