"""Scoring in parts, and shuffle files that end with their step."""

import glob
import time
from collections import Counter
from dataclasses import replace

import pytest

from fieldweave.llm import wordlm
from fieldweave.session import short_shuffles

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SETTINGS = wordlm.Settings(chunk_bytes=900, shard_bytes=4_000, fan_in=3, cell_tokens=200, chunk_docs=11)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"w{i * j % 23}" for j in range(1, i % 40 + 2))) for i in range(150)]
    return spark.createDataFrame([*rows, rows[7], rows[7], (None, "w1 w2"), (None, None), (900, "")], "doc_id long, text string")


def shuffled(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_no_shuffle_files_are_left(spark, docs):
    """They stayed until the driver's collector met the plans, so that those of all steps were on disk at once."""
    before = shuffled(spark)
    wordlm.score(docs, wordlm.learn(docs, settings=SETTINGS))
    end = time.time() + 20
    while (left := shuffled(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("where", ["true", "doc_id is null or doc_id = 900"])
def test_parts_score_each_text_once(docs, where, parts):
    """Equal rows and null ids too, and where some parts have no text."""
    model, texts = wordlm.learn(docs, settings=SETTINGS), docs.where(where)
    found = []
    for n in (SETTINGS.parts, parts):
        rows = wordlm.score(texts, replace(model, settings=replace(SETTINGS, parts=n))).collect()
        found.append(Counter((*r[:5], round(r["base_score"], 9), round(r["score"], 9)) for r in rows))
    assert found[0] == found[1] and sum(found[0].values()) == texts.count()


def test_the_setting_is_given_back(spark):
    assert spark.conf.get(CLEANUP, None) is None
    with pytest.raises(ZeroDivisionError), short_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(CLEANUP, None) is None
    spark.conf.set(CLEANUP, "false")
    try:
        with short_shuffles(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)
