"""Keyword match, BM25 score and the gram index.

BM25 as in Robertson and Zaragoza (2009). A row's score is that of its best
field; document counts and lengths are those of the whole table, whatever
filters the request has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave import schema as S
from fieldweave.functions import text as X


def words_of(spark: SparkSession, query: str) -> list[str]:
    """Usable words of a request's keyword text."""
    return spark.sql("select 1").select(X.query_terms(F.lit(query)).alias("words")).first()["words"]


def keyword_condition(columns: Sequence[Column], words: Sequence[str]) -> Column:
    """Any word in any field; no word at all matches nothing."""
    tests = [
        F.coalesce(F.contains(F.lower(c), F.lit(w)), F.lit(False)) for c in columns for w in dict.fromkeys(words)
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


# Column of a document table that holds the gram counts of its searched fields,
# in their order. With it no request has to cut texts into runs.
LENGTHS = "search_lengths"


def with_lengths(docs: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Documents with the lengths of their searched fields, to be stored with them."""
    return docs.withColumn(LENGTHS, F.transform(_texts(columns), X.gram_count))


def _texts(columns: Mapping[str, Column]) -> Column:
    return F.array(*[c.cast("string") for c in columns.values()])


def text_cells(docs: DataFrame, columns: Mapping[str, Column], *keep: Column) -> DataFrame:
    """One row per document and searched field: field, text, length."""
    cells = [F.struct(F.lit(name).alias("field"), c.cast("string").alias("text")) for name, c in columns.items()]
    return docs.select(*keep, F.inline(F.array(*cells))).withColumn("length", X.gram_count(F.col("text")))


def _statistics_row(
    docs: DataFrame, columns: Mapping[str, Column], words: Sequence[str], lengths: str | None = None
) -> DataFrame:
    """One row with ``stats``: per field, in their order, the documents that have it, its total length, and how many
    documents hold each word. One aggregate with a column for each of them: no row is made for a field of a document."""
    staged = {}
    for n, c in enumerate(columns.values()):
        text = c.cast("string")
        known = F.get(lengths, F.lit(n)) if lengths else F.lit(None).cast("long")
        staged[f"_length{n}"] = F.coalesce(known, X.gram_count(text))
        staged[f"_low{n}"] = F.lower(text)
    fields = []
    for n, name in enumerate(columns):
        length, low = F.col(f"_length{n}"), F.col(f"_low{n}")
        holding = F.array(*[F.count_if(F.contains(low, F.lit(w))) for w in words]).cast("array<bigint>")
        fields.append(
            F.struct(
                F.lit(name).alias("field"),
                F.count_if(length > 0).alias("docs"),
                F.coalesce(F.sum(length), F.lit(0)).alias("length"),
                holding.alias("dfs"),
            )
        )
    return docs.select(*[c.alias(n) for n, c in staged.items()]).agg(F.array(*fields).alias("stats"))


def bm25(tf: Column, df: Column, docs: Column, length: Column, average: Column) -> Column:
    idf = F.log(1 + (docs - df + 0.5) / (df + 0.5))
    weight = tf / (tf + S.BM25_K1 * (1 - S.BM25_B + S.BM25_B * length / average))
    return F.when(tf > 0, idf * weight).otherwise(0.0)


def with_score(
    docs: DataFrame,
    columns: Mapping[str, Column],
    words: Sequence[str],
    only: Column | None = None,
    lengths: str | None = None,
) -> DataFrame:
    """Rows that match the words, and meet ``only``, with their ``score``.
    ``lengths`` names the stored lengths of just these columns, if there are any.

    The statistics are a scalar subquery over all of ``docs``: one row, computed
    in a first pass with partial aggregates. Length and word counts of a field
    are computed for matching rows only.
    """
    counted = Counter(words)
    statistics = _statistics_row(docs, columns, list(counted), lengths)
    matching = docs.where(keyword_condition(list(columns.values()), words))
    if only is not None:
        matching = matching.where(only)

    def measured(low: Column, length: Column) -> Column:
        return F.struct(length.alias("length"), F.array(*[X.occurrences(low, w) for w in counted]).alias("tfs"))

    def of_field(cell: Column, field: Column) -> Column:
        average = field["length"] / field["docs"]
        parts = [
            bm25(cell["tfs"][m], field["dfs"][m], field["docs"], cell["length"], average) * F.lit(float(times))
            for m, times in enumerate(counted.values())
        ]
        return F.coalesce(reduce(lambda a, b: a + b, parts), F.lit(0.0))

    # Columns of their own, so that the subquery is planned once, and length and
    # word counts are computed once per row.
    texts = _texts(columns)
    if lengths:
        sizes = F.zip_with(texts, lengths, lambda text, known: F.coalesce(known, X.gram_count(text)))
    else:
        sizes = F.transform(texts, X.gram_count)
    staged = {
        "_cells": F.zip_with(F.transform(texts, F.lower), sizes, measured),
        "_stats": statistics.scalar(),
    }
    if not counted:
        return matching.withColumn("score", F.lit(0.0))
    scores = F.zip_with("_cells", "_stats", of_field)
    return matching.withColumns(staged).withColumn("score", F.array_max(scores)).drop(*staged)


def by_relevance() -> list[Column]:
    return [F.col("score").desc(), F.col("created_at").desc_nulls_last(), F.col("id").asc()]


#: Grams of a text of more characters than this are counted by an aggregate, not by looking for each in the text.
_SHORT = 200
#: Postings that one task makes, sorts and writes.
_TASK = 2**21


def index_parts(docs: DataFrame, columns: Mapping[str, Column]) -> int:
    """In how many parts to make the postings of the documents, from the number of grams."""
    grams = _statistics_row(docs, columns, []).select(F.inline("stats")).agg(F.sum("length")).first()[0] or 0
    return parts_for(docs.sparkSession, grams)


def parts_for(spark: SparkSession, grams: int) -> int:
    return max(1, -(-grams // _TASK), min(-(-grams * 8 // _TASK), spark.sparkContext.defaultParallelism))


def ngram_index(
    docs: DataFrame,
    columns: Mapping[str, Column],
    key: str = "id",
    carried: Sequence[str] = (),
    parts: int | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Postings (field, gram, id, tf, length): every gram of every field. ``carried`` columns of the document go along.

    Grams are counted by an aggregate, where the row is before any shuffle. With ``parts`` documents are dealt by id into as
    many, and an aggregate is needed only for rows that share an id, long texts, and texts whose lowercase letters are not
    those of their grams; they come after the others, which are in the ``order`` of documents, by id and carried columns,
    if one is given.
    """
    texts = {f"_text{n}": c.cast("string").alias(f"_text{n}") for n, c in enumerate(columns.values())}
    rows = docs.select(F.col(key).alias("id"), *map(F.col, carried), *texts.values())
    alike = F.count(F.lit(1)).over(Window.partitionBy("id")) if parts else F.lit(None).cast("long")
    rows = (rows.repartition(parts, "id") if parts else rows).withColumn("_alike", alike)
    if order:
        rows = rows.sortWithinPartitions(*order)
    cells = [F.struct(F.lit(name).alias("field"), F.col(t).alias("text")) for name, t in zip(columns, texts)]
    fields = rows.select("id", *carried, "_alike", F.inline(F.array(*cells))).where(F.col("text").isNotNull())
    if not parts:
        return _counted(fields.withColumn("length", X.gram_count(F.col("text"))), carried)
    apart = (F.col("_alike") == 1) & (F.length("text") <= _SHORT) & X.lowered_alike(F.col("text"))
    fields = fields.withColumn("length", X.gram_count(F.col("text")))
    return _counted_in_text(fields.where(apart), carried).unionByName(_counted(fields.where(~apart), carried))


def _counted_in_text(fields: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The postings of texts of which none shares id and field with another. A gram is taken where it occurs first."""
    low = fields.select("field", "id", "length", *carried, F.lower(X.only_runs(F.col("text"))).alias("_low"))
    size, at = F.length("_low"), F.when(F.length("_low") >= S.MIN_GRAM, F.sequence(F.lit(1), F.length("_low") - (S.MIN_GRAM - 1)))
    # With explode Spark would test what it explodes below, by making the text once more.
    start = low.select("*", F.explode_outer(at).alias("pos")).where(F.col("pos").isNotNull())
    end = F.position(F.lit(" "), F.col("_low"), F.col("pos"))
    room = F.least(F.lit(S.MAX_GRAM), F.when(end == 0, size + 1).otherwise(end) - F.col("pos"))
    start = start.withColumn("_room", room).where(F.col("_room") >= S.MIN_GRAM)
    grams = start.withColumn("size", F.explode(F.sequence(F.lit(S.MIN_GRAM), F.col("_room"))))
    grams = grams.withColumn("gram", F.substring("_low", F.col("pos"), F.col("size")))
    first = grams.where(F.position(F.col("gram"), F.col("_low")) == F.col("pos"))
    again = F.position(F.col("gram"), F.col("_low"), F.col("pos") + 1) > 0
    tf = F.when(again, F.regexp_count("_low", F.concat(F.lit("(?="), F.col("gram"), F.lit(")")))).otherwise(1)
    return first.select("field", "gram", "id", tf.cast("long").alias("tf"), "length", *carried)


def _counted(fields: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The postings of any texts. Grams of a row are counted where the row is."""
    run = fields.select("field", "id", "length", *carried, F.explode(X.runs(F.col("text"))).alias("run")).where(
        F.length("run") >= S.MIN_GRAM
    )
    start = run.withColumn("pos", F.explode(F.sequence(F.lit(1), F.length("run") - (S.MIN_GRAM - 1))))
    longest = F.least(F.lit(S.MAX_GRAM), F.length("run") - F.col("pos") + 1)
    grams = start.withColumn("size", F.explode(F.sequence(F.lit(S.MIN_GRAM), longest)))
    return (
        grams.select("field", F.lower(F.substring("run", F.col("pos"), F.col("size"))).alias("gram"), "id", "length", *carried)
        .groupBy("field", "gram", "id")
        .agg(F.count(F.lit(1)).alias("tf"), *[F.max(c).alias(c) for c in ("length", *carried)])
    )


def field_lengths(docs: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Per field the documents that have it and its total length."""
    fields = _statistics_row(docs, columns, []).select(F.inline("stats"))
    return fields.where("docs > 0").select("field", "docs", "length")


def write_index(postings: DataFrame, path: str) -> None:
    """One folder per field, files cut and sorted by gram, so that a lookup reads
    few row groups; a frequent gram may span files."""
    (
        postings.repartitionByRange("field", "gram", "id")
        .sortWithinPartitions("field", "gram", "id")
        .write.mode("overwrite")
        .partitionBy("field")
        .parquet(path)
    )


def score_from_index(postings: DataFrame, lengths: DataFrame, words: Sequence[str]) -> DataFrame:
    """(id, score) of the rows that hold any word, from a stored index."""
    counted = Counter(words)
    found = postings.where(F.col("gram").isin(list(counted)))
    weights = F.create_map(*[F.lit(x) for w, n in counted.items() for x in (w, float(n))])
    totals = lengths.select("field", "docs", F.col("length").alias("total_length"))
    # One row per field and word, however many postings there are.
    holding = found.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("df")).join(totals, "field")
    parts = (
        found.join(holding, ["field", "gram"])
        .withColumn(
            "part",
            bm25(F.col("tf"), F.col("df"), F.col("docs"), F.col("length"), F.col("total_length") / F.col("docs"))
            * weights[F.col("gram")],
        )
    )
    per_field = parts.groupBy("id", "field").agg(F.sum("part").alias("part"))
    return per_field.groupBy("id").agg(F.max("part").alias("score"))
