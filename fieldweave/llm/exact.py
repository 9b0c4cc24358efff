"""Exact dedup by deterministic block naming; DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave.llm.common import SPACE, text_or_empty
from fieldweave.session import settle


@dataclass(frozen=True)
class Settings:
    #: Code points of a block.
    block_chars: int = 4096
    #: Values of each of a block's two hashes; few of them only in tests, to see blocks that share their hashes.
    hash_values: int = 2**62


def _numbered(rows: DataFrame, content: list[str], name: str) -> DataFrame:
    """The rows with ``name``, an integer for their content: the same for the same, different for different.

    The distinct contents are partitioned by hash, sorted and numbered, and written before they are joined: numbers
    can't change when a task is run again, and the join can be split at a frequent content.
    """
    distinct = rows.select(*content).distinct().sortWithinPartitions(*content)
    numbers = settle(distinct.withColumn(name, F.monotonically_increasing_id()), "exact-numbers")
    return rows.join(numbers, content)


def _blocks(text: str, size: int) -> Column:
    """The text's blocks of ``size`` code points, in one pass over it; one empty block for the empty text."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}+"), F.lit(0))
    return F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(found)


def name_texts(rows: DataFrame, key: list[str], text: str, settings: Settings = Settings()) -> DataFrame:
    """key columns, ``steps`` and ``name``: equal for equal texts, different for different ones. Rows with the same key
    must have the same text.

    Texts are cut into blocks and blocks get integer names, then pairs of neighbouring names get names, until each text
    has one; the number of steps goes with it. A block's first sign is a pair of hashes; where a pair occurs more than
    once, the blocks themselves are sorted, and each further content under it counts as another variant. So no two
    contents share a name, whatever the hashes.
    """
    cut = rows.select(*key, F.posexplode(_blocks(text, settings.block_chars)).alias("at", "block"))
    sign = lambda *values: F.pmod(F.xxhash64(*values), F.lit(settings.hash_values))
    cut = cut.withColumn("h1", sign("block")).withColumn("h2", sign(F.lit("block"), F.col("block")))
    signs = settle(cut.select(*key, "at", "h1", "h2"), "exact-signs")
    repeated = settle(signs.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "exact-repeated")
    # The same plan at any size: the blocks are shuffled once, also where the signs could be broadcast.
    contents = cut.select("h1", "h2", "block").join(repeated.hint("merge"), ["h1", "h2"], "left_semi").distinct()
    order = Window.partitionBy("h1", "h2").orderBy("block")
    contents = contents.withColumn("variant", F.row_number().over(order) - 1)
    others = settle(contents.where("variant > 0"), "exact-variants")
    clashes = cut.join(others.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").join(others, ["h1", "h2", "block"])
    clashes = clashes.select(*key, "at", "variant").distinct()
    signs = signs.distinct().join(clashes, [*key, "at"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))
    named = settle(_numbered(signs, ["h1", "h2", "variant"], "name").select(*key, "at", "name"), "exact-names")
    done: DataFrame | None = None
    steps = 0
    while True:
        ends = named.groupBy(*key).agg(F.max("at").alias("last"), F.min("name").alias("name"))
        whole = ends.where("last = 0").select(*key, F.lit(steps).alias("steps"), "name")
        done = whole if done is None else done.unionByName(whole)
        longer = settle(ends.where("last > 0").select(*key), "exact-longer")
        if longer.isEmpty():
            return settle(done, "exact-identities")
        steps += 1
        open_ = named.join(longer, key, "left_semi").withColumn("pair", F.floor(F.col("at") / 2).cast("int"))
        side = lambda i: F.max(F.when(F.col("at") % 2 == i, F.col("name")))  # noqa: E731, B023
        pairs = open_.groupBy(*key, "pair").agg(side(0).alias("first"), F.coalesce(side(1), F.lit(-1)).alias("second"))
        named = _numbered(settle(pairs, "exact-pairs"), ["first", "second"], "name").select(*key, F.col("pair").alias("at"), "name")
        named = settle(named, "exact-names")


def dedup_exact(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without ASCII white space; null counts as empty. Of equal texts the row
    with the most code points stays, then the one with the smallest id, null before all others; of rows alike in both
    exactly one. Other columns are not read. A long text is only more blocks, cut in one pass. No rows give no rows.
    """
    raw = docs.select("doc_id", text_or_empty("text").alias("raw")).withColumn("own", F.translate("raw", SPACE, ""))
    # A row's key. Rows with one id and one text have the same.
    key = ["k1", "k2"]
    raw = raw.withColumn("k1", F.xxhash64("doc_id", "own")).withColumn("k2", F.xxhash64(F.lit("row"), F.col("own"), F.col("doc_id")))
    rows = raw.select(*key, "doc_id", F.length("raw").cast("long").alias("chars"), F.sha2(F.col("own").cast("binary"), 256).alias("text_sha256"))
    identities = name_texts(raw.select(*key, "own"), key, "own", settings)
    alike = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("chars")))
    rows = rows.withColumn("alike", alike).join(identities, key)
    rows = settle(rows.drop(*key), "exact-rows")
    best = F.min(F.struct((-F.col("chars")).alias("less"), "doc_id", "alike")).alias("best")
    groups = settle(rows.groupBy("steps", "name").agg(best, F.count("*").alias("group_size")), "exact-groups")
    joined = rows.join(groups, ["steps", "name"])
    same = (F.col("best.less") == -F.col("chars")) & F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.alike") == F.col("alike"))
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", same.alias("kept"), "text_sha256")


DEDUP_SQL = r"""
with texts as (
    select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as own from documents
)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by own) as group_size,
    doc_id = first_value(doc_id) over w as kept, sha256(own) as text_sha256
from texts window w as (partition by own order by chars desc, doc_id)
"""
