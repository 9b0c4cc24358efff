"""The best rows of a keyword request from postings in order of their impact.

A posting's impact is the part of its BM25 score that does not depend on the word. Documents are dealt into parts by id.
In each part every posting list, the documents that hold one gram in one field, is stored by impact, newest first, and cut
into blocks. A request reads blocks of its lists with the largest impact, which gives a score that as many documents as it
wants reach at least, and then only those postings whose document can still reach it: their own part and the largest part
of each other word are not less.

All postings of a wanted document in its best field meet that bound, as each of them is a part of its score. So what is
read gives the wanted documents their whole score, and others at most theirs.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave import schema as S
from fieldweave.operators.textsearch import field_lengths, ngram_index, parts_for

#: Scores that differ by less are ties.
DIGITS = 9
_SLACK = 2 * 10.0**-DIGITS
_BLOCK_BITS = 10  # 1,024 postings


@dataclass(frozen=True)
class PostingList:
    """One gram in one field, for one request: what a posting's impact is multiplied by, its largest part, and the blocks to
    begin with."""

    field: str
    gram: str
    weight: float
    largest: float
    blocks: tuple[int, ...]


@dataclass(frozen=True)
class Threshold:
    """Score and time (as text) that the last wanted row has or betters."""

    score: float
    created_at: str | None


@dataclass(frozen=True)
class ImpactIndex:
    """Stored postings (term, field, gram, impact, created_at, id, block), their blocks, and the lengths of the fields."""

    postings: DataFrame
    blocks: DataFrame
    fields: DataFrame

    def lists(self, words: Sequence[str], size: int) -> list[PostingList]:
        """The lists of the words, one for each word and field at most."""
        if not words:
            return []
        counted = Counter(words)
        fields = [r[0] for r in self.fields.select("field").collect()]
        of_words = [_of_list(f, w) for f in fields for w in counted]
        blocks = self.blocks.where(reduce(lambda a, b: a | b, of_words, F.lit(False)))
        times = F.create_map(*[F.lit(x) for w, n in counted.items() for x in (w, float(n))])
        totals = blocks.groupBy("field", "gram").agg(F.sum("n").alias("df"), F.max("high").alias("high"))
        # A block has a row at least, so the first `size` hold `size` rows of the list; of these, as many as it takes.
        in_order = Window.partitionBy("field", "gram").orderBy(F.col("high").desc(), F.col("newest").desc_nulls_last(), "block")
        first = blocks.withColumn("at", F.row_number().over(in_order)).where(F.col("at") <= size)
        before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first = first.withColumn("before", before).where(F.col("before") < size)
        begin = first.groupBy("field", "gram").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
        idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        rows = totals.join(begin, ["field", "gram"]).join(self.fields, "field")
        rows = rows.withColumn("weight", idf * times[F.col("gram")])
        found = rows.select("field", "gram", "weight", (F.col("weight") * F.col("high")).alias("largest"), "blocks")
        return [PostingList(*r[:-1], tuple(r["blocks"])) for r in sorted(found.collect())]

    def first_blocks(self, lists: Sequence[PostingList]) -> DataFrame:
        return self._parts(lists, lambda l: F.col("block").isin(*l.blocks))

    def threshold(self, lists: Sequence[PostingList], size: int) -> Threshold | None:
        """From the first blocks; none if fewer than ``size`` documents hold a word."""
        best = ranked(self.first_blocks(lists)).limit(size).select("score", F.col("created_at").cast("string")).collect()
        return Threshold(*best[-1]) if len(best) == size else None

    def candidates(self, lists: Sequence[PostingList], threshold: Threshold | None) -> DataFrame:
        """The postings, with their part of the score, of documents that can be among the wanted ones."""
        if threshold is None:
            return self._parts(lists, lambda _: F.lit(True))
        together: dict[str, float] = defaultdict(float)
        for l in lists:
            together[l.field] += l.largest
        alone = Counter(l.field for l in lists)
        created = self.postings.schema["created_at"].dataType

        def of_others(l: PostingList) -> float:
            return together[l.field] - l.largest + _SLACK if alone[l.field] > 1 else 0.0

        def near(l: PostingList) -> Column:
            bound = F.round(F.lit(l.weight) * F.col("impact") + of_others(l), DIGITS)
            tie = bound == threshold.score
            if threshold.created_at is not None:
                tie &= F.coalesce(F.col("created_at") >= F.lit(threshold.created_at).cast(created), F.lit(False))
            return (bound > threshold.score) | tie

        return self._parts(lists, lambda l: F.col("impact") >= (threshold.score - of_others(l)) / l.weight - 1e-6, near)

    def _parts(self, lists: Sequence[PostingList], read, wanted=None) -> DataFrame:
        """``read`` is a condition that files and pages are left out by; for that it stands alone, beside ``wanted``."""
        each = [(_of_list(l.field, l.gram), l) for l in lists]
        found = self.postings
        for condition in [read, wanted] if wanted else [read]:
            found = found.where(reduce(lambda a, b: a | b, [of & condition(l) for of, l in each], F.lit(False)))
        weight = F.lit(0.0)
        for of, l in each:
            weight = F.when(of, F.lit(l.weight)).otherwise(weight)
        return found.select("id", "field", "created_at", (weight * F.col("impact")).alias("part"))

    def top(self, words: Sequence[str], size: int) -> DataFrame:
        """The first ``size`` rows (id, score, created_at) by score of the best field, newest first, then id. No usable word
        gives none. What the driver sees is one row for each list, with ``size`` blocks at most, and ``size`` scores."""
        lists = self.lists(words, size)
        return ranked(self.candidates(lists, self.threshold(lists, size))).limit(size)


def _term(field: Column, gram: Column) -> Column:
    """What the lists are stored in order of: 32 bits, so that two of a part may share a place."""
    return F.shiftright(F.xxhash64(field, gram), 32).cast("int")


def _of_list(field: str, gram: str) -> Column:
    return (F.col("term") == _term(F.lit(field), F.lit(gram))) & (F.col("field") == field) & (F.col("gram") == gram)


def ranked(parts: DataFrame) -> DataFrame:
    per_field = parts.groupBy("id", "field").agg(F.sum("part").alias("part"), F.max("created_at").alias("created_at"))
    scored = per_field.groupBy("id").agg(F.round(F.max("part"), DIGITS).alias("score"), F.max("created_at").alias("created_at"))
    return scored.orderBy(F.col("score").desc(), F.col("created_at").desc_nulls_last(), F.col("id"))


def write_impacts(docs: DataFrame, columns: Mapping[str, Column], path: str) -> ImpactIndex:
    """The index of documents (``id``, ``created_at`` and the columns), below ``path``. Documents are dealt by id into parts of
    about as many postings as a task can sort; a gram that very many documents hold is in all of them."""
    spark = docs.sparkSession
    field_lengths(docs, columns).write.parquet(f"{path}/fields")
    fields = spark.read.parquet(f"{path}/fields").collect()
    parts = parts_for(spark, sum(f["length"] for f in fields))
    average = F.lit(None).cast("double")
    for f in fields:
        average = F.when(F.col("field") == f["field"], f["length"] / f["docs"]).otherwise(average)
    shape = F.col("tf") + S.BM25_K1 * (1 - S.BM25_B + S.BM25_B * F.col("length") / average)
    newest_first = [F.col("created_at").desc_nulls_last(), F.col("id")]
    postings = ngram_index(docs, columns, carried=["created_at"], parts=parts, order=newest_first)
    term = _term(F.col("field"), F.col("gram")).alias("term")
    postings = postings.select(term, "field", "gram", (F.col("tf") / shape).alias("impact"), "created_at", "id")
    # One number, as Spark sorts by one without comparing rows: the list, then its impacts from the largest. They are below 1
    # and differ by more than 2 ** -32 or tie. The sort keeps the order of what ties, newest first.
    place = F.shiftleft(F.col("term").cast("long"), 32) + (2**32 - 1 - F.floor(F.col("impact") * 2**32))
    placed = postings.withColumn("_place", place).sortWithinPartitions("_place").drop("_place")
    block = F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS).alias("block")
    placed.select("*", block).write.parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    blocks = stored.groupBy("term", "field", "gram", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("impact").alias("high"), F.max("created_at").alias("newest")
    )
    blocks.sortWithinPartitions("term").write.parquet(f"{path}/blocks")
    return open_impacts(spark, path)


def open_impacts(spark: SparkSession, path: str) -> ImpactIndex:
    return ImpactIndex(*[spark.read.parquet(f"{path}/{name}") for name in ("postings", "blocks", "fields")])
