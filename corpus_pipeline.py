"""The pipeline: each stage works on what the one before it kept, through tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.llm import lines, mixing, neardup, toxicity
from fieldweave.llm.common import fresh, table
from fieldweave.llm.queries import SCHEDULES, WEIGHTS, token_digests, vocabulary_path
from fieldweave.session import settle


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The documents in one column ``row``, beside the columns that an operator reads, so that other columns of the
    documents may have any names."""
    return docs.select(F.struct(*docs.columns).alias("row"), *names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(packed(docs, "text"), lexicon)
    return scored.where("predicted = 0").select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.drop_shared_lines(packed(docs, "doc_id", "text"))
    row = F.col("row").withField("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return kept.select(row.alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.curriculum(docs, WEIGHTS, SCHEDULES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("near dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can't express the learned lexicon, the near duplicates or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; a row of the result has its ``position`` in the training order, which a table does not keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-2]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    [place] = fresh(docs, "position")
    mixed = settle(mixing.curriculum(docs, WEIGHTS, SCHEDULES, position=place), "pipeline-mixing")
    return token_digests(mixed, vocabulary_path(), [place]).withColumnRenamed(place, "position")
