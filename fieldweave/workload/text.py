"""Keyword search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.functions.text import query_terms as terms_of
from fieldweave.operators import textsearch as X
from fieldweave.operators import topk as K
from fieldweave.operators.sorting import page_of
from fieldweave.plans.search import search_columns, search_documents
from fieldweave.plans.spec import SearchSpec
from fieldweave.session import new_work_dir
from fieldweave.sources import lens as L
from fieldweave.workload.registry import query

CATALOG = L.CONTACT_CATALOG
RUN_RE = r"[\p{L}\p{Nd}]+"
GRAMS_OF_RUN = (
    "case when length(r) < 2 then 0 else (least(length(r), 10) - 1) * (length(r) + 1) "
    "- least(length(r), 10) * (least(length(r), 10) + 1) // 2 + 1 end"
)


def scores_sql(source: str, fields: list[str], words: list[str], where: str = "true") -> str:
    """CTEs down to ``scored`` (id, score): BM25 of the best field, for words
    that cannot overlap themselves."""
    long = " union all ".join(f"select id, '{f}' as field, lower({f}) as txt from {source}" for f in fields)
    lengths = (
        "select id, field, txt, coalesce(list_sum(list_transform(regexp_extract_all(txt, '"
        + RUN_RE
        + f"'), lambda r: {GRAMS_OF_RUN})), 0) as dl from long_text where txt is not null"
    )
    tf = " union all ".join(
        f"select id, field, dl, '{w}' as word, (length(txt) - length(replace(txt, '{w}', ''))) // {len(w)} as tf from lens"
        for w in words
    )
    return f"""long_text as ({long}),
    lens as ({lengths}),
    field_stats as (select field, count(*) as n, sum(dl) as total from lens where dl > 0 group by field),
    tfs as (select * from ({tf}) where tf > 0),
    dfs as (select field, word, count(*) as df from tfs group by field, word),
    parts as (select t.id, t.field, sum(ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * t.tf
        / (t.tf + 1.2 * (1 - 0.75 + 0.75 * t.dl / (s.total / s.n)))) as part
      from tfs t join dfs d on d.field = t.field and d.word = t.word join field_stats s on s.field = t.field
      group by t.id, t.field),
    scored as (select id, max(part) as score from parts where id in (select id from {source} where {where}) group by id)"""


FIELDS = list(S.SEARCH_FIELDS)


@query(
    "ngram_index",
    rf"""with long_text as ({" union all ".join(f"select id, '{f}' as field, lower({f}) as txt from docs" for f in FIELDS)}),
    run as (select id, field, unnest(regexp_extract_all(txt, '{RUN_RE}')) as r from long_text where txt is not null),
    start as (select id, field, r, unnest(range(1, length(r))) as pos from run where length(r) >= 2),
    gram as (select id, field, substr(r, pos, g) as gram from (select id, field, r, pos, unnest(range(2, 11)) as g from start)
      where pos + g - 1 <= length(r)),
    posting as (select field, gram, id, count(*) as tf from gram group by all)
    select field, gram, count(*) as n_docs, cast(sum(tf) as bigint) as total_tf, max(tf) as max_tf from posting group by field, gram""",
)
def ngram_index(spark: SparkSession, d: str) -> DataFrame:
    postings = X.ngram_index(L.documents(spark, d), search_columns(CATALOG))
    return postings.groupBy("field", "gram").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("total_tf"), F.max("tf").alias("max_tf")
    )


@query(
    "ngram_lengths",
    f"""with long_text as ({" union all ".join(f"select id, '{f}' as field, lower({f}) as txt from docs" for f in FIELDS)}),
    lens as (select id, field, coalesce(list_sum(list_transform(regexp_extract_all(txt, '{RUN_RE}'), lambda r: {GRAMS_OF_RUN})), 0) as dl
      from long_text where txt is not null)
    select field, count(*) as docs, cast(sum(dl) as bigint) as length from lens where dl > 0 group by field""",
)
def ngram_lengths(spark: SparkSession, d: str) -> DataFrame:
    return X.field_lengths(L.documents(spark, d), search_columns(CATALOG))


@query(
    "query_terms",
    rf"""with j as (select conv_id, turn, lower(text) as t from conversations),
    k as (select conv_id, turn, regexp_replace(regexp_replace(t, '(\p{{L}})[.:''’·](\p{{L}})', '\1_\2', 'g'), '(\p{{L}})[.:''’·](\p{{L}})', '\1_\2', 'g') as t from j),
    l as (select conv_id, turn, regexp_replace(regexp_replace(t, '(\p{{Nd}})[.,;''’](\p{{Nd}})', '\1_\2', 'g'), '(\p{{Nd}})[.,;''’](\p{{Nd}})', '\1_\2', 'g') as t from k)
    select conv_id, turn, array_to_string(list_filter(regexp_extract_all(t, '[\p{{L}}\p{{Nd}}\p{{M}}_]+'),
      lambda w: regexp_full_match(w, '[\p{{L}}\p{{Nd}}]{{2,10}}')), ' ') as words from l""",
)
def query_terms(spark: SparkSession, d: str) -> DataFrame:
    turns = L.table(spark, d, "conversations")
    return turns.select("conv_id", "turn", F.array_join(terms_of(F.col("text")), " ").alias("words"))


MATCH_SQL = " or ".join(f"contains(lower({f}), '{w}')" for f in FIELDS for w in ("plati", "manag"))


@query("keyword_match", f"select id, name, tier__c, job_title__c from docs where {MATCH_SQL}")
def keyword_match(spark: SparkSession, d: str) -> DataFrame:
    words = X.words_of(spark, "Plati, x manag incomprehensible")
    docs = L.documents(spark, d).where(X.keyword_condition(list(search_columns(CATALOG).values()), words))
    return docs.select("id", "name", "custom_fields.tier__c", "custom_fields.job_title__c")


@query(
    "keyword_score",
    f"with {scores_sql('docs', FIELDS, ['gold', 'building'])} select id, round(score, 6) as score from scored",
)
def keyword_score(spark: SparkSession, d: str) -> DataFrame:
    words = X.words_of(spark, "gold building")
    scored = X.with_score(L.documents(spark, d), search_columns(CATALOG), words)
    return scored.select("id", F.round("score", 6).alias("score"))


@query(
    "keyword_score_indexed",
    f"with {scores_sql('docs', FIELDS, ['gold', 'asia'])} select id, round(score, 6) as score from scored",
)
def keyword_score_indexed(spark: SparkSession, d: str) -> DataFrame:
    docs, columns = L.documents(spark, d), search_columns(CATALOG)
    scored = X.score_from_index(X.ngram_index(docs, columns), X.field_lengths(docs, columns), ["gold", "asia"])
    return scored.select("id", F.round("score", 6).alias("score"))


@query(
    "sort_relevance",
    f"""with {scores_sql('docs', FIELDS, ['silver', 'director'])}
    select d.id, round(s.score, 6) as score, d.created_at from scored s join docs d on d.id = s.id
    order by round(s.score, 6) desc, d.created_at desc nulls last, d.id limit 40""",
)
def sort_relevance(spark: SparkSession, d: str) -> DataFrame:
    words = X.words_of(spark, "silver director")
    scored = X.with_score(L.documents(spark, d), search_columns(CATALOG), words)
    rounded = scored.withColumn("score", F.round("score", 6))
    return page_of(rounded, X.by_relevance(), 1, 40).select("id", "score", "created_at")


@query(
    "keyword_page",
    f"""with {scores_sql('docs', FIELDS, ['machinery', 'gold'])}
    select d.id, d.name, (select count(*) from scored) as total from scored s join docs d on d.id = s.id
    order by round(s.score, 9) desc, d.created_at desc nulls last, d.id limit 20 offset 20""",
)
def keyword_page(spark: SparkSession, d: str) -> DataFrame:
    result = search_documents(L.documents(spark, d), CATALOG, SearchSpec(search="Machinery GOLD", page=2))
    return result.page.select("id", "name", result.total.scalar().alias("total"))


@query(
    "keyword_filtered",
    f"""with texts as (select doc_id as id, text, source from documents),
    {scores_sql('texts', ['text', 'source'], ['vel', 'tion'], "id in (select doc_id from documents where lang = 'en' and n_chars > 500)")}
    select id, round(score, 6) as score from scored order by round(score, 9) desc, id limit 100""",
)
def keyword_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts as the searched field; statistics of all languages, rows of one."""
    texts = L.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), "text", "source", "lang", "n_chars", F.lit(None).cast("timestamp_ntz").alias("created_at")
    )
    columns = {"text": F.col("text"), "source": F.col("source")}
    keep = (F.col("lang") == "en") & (F.col("n_chars") > 500)
    scored = X.with_score(texts, columns, X.words_of(spark, "vel tion"), keep)
    return page_of(scored, X.by_relevance(), 1, 100).select("id", F.round("score", 6).alias("score"))


@query(
    "keyword_documents",
    "select lang, count(*) as total from documents where contains(lower(text), 'license') or contains(lower(text), 'copyright') group by lang",
)
def keyword_documents(spark: SparkSession, d: str) -> DataFrame:
    words = X.words_of(spark, "license copyright")
    found = L.table(spark, d, "documents").where(X.keyword_condition([F.col("text")], words))
    return found.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))




def top_sql(part: str, words: list[str]) -> str:
    return f"""select '{part}' as part, * from (with {scores_sql('docs', FIELDS, words)}
    select d.id, round(s.score, 6) as score from scored s join docs d on d.id = s.id
    order by round(s.score, 9) desc, d.created_at desc nulls last, d.id limit 25)"""


@query(
    "keyword_top_k",
    " union all ".join(top_sql(part, words) for part, words in (("one", ["gold"]), ("two", ["machinery", "silver"]), ("rare", ["customer", "0042"]))),
)
def keyword_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Three requests on one index by impact: a word of very many ties, two words, a rare and a common one."""
    docs = L.documents(spark, d)
    index = K.write_impacts(docs, search_columns(CATALOG), new_work_dir(spark, "impacts"))

    def top(part: str, text: str) -> DataFrame:
        return index.top(X.words_of(spark, text), 25).select(F.lit(part).alias("part"), "id", F.round("score", 6).alias("score"))

    return top("one", "gold").unionByName(top("two", "Machinery SILVER")).unionByName(top("rare", "customer 0042"))
