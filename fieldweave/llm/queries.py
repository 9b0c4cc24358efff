"""The registered queries, one for each operator, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.llm import bpe, chat, exact, lines, mixing, neardup, quality, repair, search, sharding, toxicity, urls, wordlm
from fieldweave.llm.common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def token_digests(docs: DataFrame, path: str, keys: Sequence[str] = ()) -> DataFrame:
    tokenizer = bpe.Tokenizer(path)
    rows = tokenizer.decode(tokenizer.encode(docs.select("doc_id", *keys, "text")).select("doc_id", *keys, "ids"))
    return rows.select(
        "doc_id",
        *keys,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", (~toxicity.in_training()).alias("held_out"), "score", "predicted")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: Weights and schedules of the sources in order, from the first again after the last.
WEIGHTS, SCHEDULES = (3.0, 1.0, 2.0), (mixing.EARLY, mixing.LATE, mixing.EVEN)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan_mix(table(spark, sf_dir, "documents"), WEIGHTS, SCHEDULES)
    places = [F.get("positions", F.lit(i)).alias(name) for i, name in enumerate(("first_position", "second_position"))]
    return rows.select("doc_id", "size", "source_size", "target", "taken", *places)  # the cap of 2 gives two places at most


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup_exact(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.report(repair.edits(repair.damaged(conversations)), conversations)


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wordlm.score(docs, wordlm.learn(docs))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_bpe, op3_toxicity, op4_near_dedup, op5_url_filters, op6_quality_rules, op7_sharding,
        op8_line_dedup, op9_mixing, op10_exact_dedup, op11_ranked_search, op12_conversation_repair, op13_lm_scoring,
    )
}
ORACLES = {
    "op1_chat_formatting": chat.CHAT_SQL,
    "op5_url_filters": urls.URLS_SQL,
    "op8_line_dedup": lines.LINES_SQL,
    "op9_mixing": mixing.PLACES_SQL,
    "op10_exact_dedup": exact.DEDUP_SQL,
    "op11_ranked_search": search.SEARCH_SQL,
    "op12_conversation_repair": repair.REPAIR_SQL,
}
