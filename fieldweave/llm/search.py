"""Ranked lexical search: best-first document intervals, bounded by range-maximum sparse tables over posting lists."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave.llm.common import text_or_empty
from fieldweave.session import settle

#: A term: a run of ASCII letters and digits and of all characters beyond ASCII. Fixed value.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    top: int = 20
    #: A segment of the index: so many documents and bytes of text at most, one document at least.
    segment_docs: int = 8_192
    segment_bytes: int = 8_000_000
    #: Items of a block, on average at most; a segment is searched for one block at a time.
    block_items: int = 1_024
    #: Items that are searched together, and intervals of each that are split at once.
    batch_items: int = 64
    width: int = 8
    #: Parts in which the segments' results of an item are ranked before they are ranked together.
    merge_parts: int = 64


_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str | bytes) -> list[bytes]:
    """The terms of a text in order, with A-Z lower-cased, as UTF-8."""
    data = text.encode() if isinstance(text, str) else text
    return _TERM_BYTES.findall(data.translate(_ASCII_LOWER))


class _Segment:
    """Documents of one segment while it is filled."""

    def __init__(self):
        self.names: dict[bytes, int] = {}
        self.tokens: list[np.ndarray] = []
        self.doc_ids: list[pa.Array] = []
        self.bytes = 0

    def add(self, doc_id: pa.Array, text: bytes) -> None:
        names = self.names
        found = terms_of(text)
        self.tokens.append(np.fromiter((names.setdefault(t, len(names)) for t in found), np.int64, len(found)))
        self.doc_ids.append(doc_id)
        self.bytes += len(text)

    def rows(self, segment: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row of the documents in order of their ids, and a row for each term with its documents and counts."""
        ids = pa.concat_arrays(self.doc_ids)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array([len(t) for t in self.tokens])
        pairs = np.concatenate(self.tokens) << 32 | np.repeat(place, lengths)
        pairs, counts = np.unique(pairs, return_counts=True)
        bounds = np.searchsorted(pairs >> 32, np.arange(len(self.names) + 1))
        n = len(self.names)

        def blobs(values: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(values.astype(np.int32))])

        one = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), ids.take(pa.array(order)))
        own = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), pa.array(lengths[order], pa.int64()))
        number = lambda values: pa.array(values, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [number([segment]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), number([int((lengths > 0).sum())]),
             number([int(lengths.sum())]), one, own], _INDEX
        )
        for at in range(0, n, 50_000):
            part = slice(at, min(n, at + 50_000))
            size = part.stop - at
            yield pa.RecordBatch.from_arrays(
                [number(np.full(size, segment)), pa.array(list(self.names)[part], pa.binary()), blobs(pairs & 0xFFFFFFFF)[part], blobs(counts)[part],
                 number(np.diff(bounds)[part]), pa.nulls(size, pa.int64()), pa.nulls(size, pa.list_(kind)), pa.nulls(size, pa.list_(pa.int64()))], _INDEX
            )


_INDEX = ["segment", "term", "docs", "counts", "n", "n_terms", "doc_ids", "lengths"]


def _build(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = _Segment(), None
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for i, text in enumerate(batch["text"].cast(pa.binary())):
                text = text.as_py()
                if held.doc_ids and (len(held.doc_ids) == settings.segment_docs or held.bytes + len(text) > settings.segment_bytes):
                    yield from held.rows(number, kind)
                    held, number = _Segment(), number + 1
                held.add(batch["doc_id"][i : i + 1], text)
        if held.doc_ids:
            yield from held.rows(number, kind)

    return run


def build_index(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The index as a table: for each segment a row of its documents (``doc_ids``, ``lengths``; ``n`` of them have
    terms, ``n_terms`` in all) and a row for each ``term`` with the places of its documents and its counts in them.

    Segments are filled where the documents are read, so building shuffles nothing; a term of all documents has a list
    of at most ``segment_docs`` in each segment. All documents are in it, whole; null texts have no terms.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"segment long, term binary, docs binary, counts binary, n long, n_terms long, doc_ids array<{kind}>, lengths array<long>"
    return settle(docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(_build(settings), columns), "search-index")


class RangeMaxima:
    """Posting lists one after another with sparse tables of the largest impact in any range, and its document."""

    def __init__(self, bounds: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.bounds, self.docs, self.impacts, self.n_docs = bounds, docs, impacts, n_docs
        self.keys = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * n_docs + docs
        level = impacts << 32 | (0xFFFFFFFF - docs)
        longest = int(np.diff(bounds).max(initial=1))
        self.levels = [level]
        while 2 ** len(self.levels) <= longest:
            half = 2 ** (len(self.levels) - 1)
            wider = level.copy()
            np.maximum(level[:-half], level[half:], out=wider[:-half])
            self.levels.append(level := wider)
        self.table = np.stack(self.levels)
        self.log = np.zeros(longest + 1, np.int8)
        for n in range(1, len(self.levels)):
            self.log[2**n :] = n

    def of(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact in each range of places (low, high), 0 if it is empty, and the first document that has it."""
        length = high - low
        some = length > 0
        level = self.log[np.where(some, length, 1)]
        first = np.where(some, low, 0)
        last = np.where(some, high - (1 << level.astype(np.int64)), 0)
        best = np.where(some, np.maximum(self.table[level, first], self.table[level, last]), 0)
        return best >> 32, 0xFFFFFFFF - (best & 0xFFFFFFFF)

    def place(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Place of each document, or of the next one, in its list, by binary search."""
        return np.searchsorted(self.keys, lists * self.n_docs + docs)


def best_first(lists: RangeMaxima, items: list[tuple[np.ndarray, np.ndarray]], top: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(item, document, score) of the highest-scoring documents of each item, which is (lists, weights); and the number
    of documents that were scored.

    An interval of documents can't hold a score above the sum of its weighted range maxima. The intervals with the
    highest bounds are split first, each at the document that has the largest weighted impact in it, which is scored;
    its two sides are intervals again. Intervals that can't better the lowest of the top results are left, where of equal scores
    the first document counts as better. ``width`` intervals of each item are split in one step.
    """
    terms = max(len(own) for own, _ in items)
    own = np.zeros((len(items), terms), np.int64)
    weights = np.zeros((len(items), terms), np.int64)
    for i, (names, factors) in enumerate(items):
        own[i, : len(names)], weights[i, : len(names)] = names, factors
    padded = np.arange(terms) >= np.array([len(names) for names, _ in items])[:, None]
    low, high = lists.bounds[own], np.where(padded, lists.bounds[own], lists.bounds[own + 1])

    def bounded(item: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        impact, doc = lists.of(low, high)
        part = weights[item] * impact
        return part.sum(axis=1), doc[np.arange(len(item)), part.argmax(axis=1)]

    item, first = np.arange(len(items)), np.zeros(len(items), np.int64)
    bound, split = bounded(item, low, high)
    limit, limit_doc = np.zeros(len(items), np.int64), np.full(len(items), -1)
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    scored = 0
    while True:
        open_ = np.flatnonzero((bound > limit[item]) | ((bound == limit[item]) & (first < limit_doc[item])))
        if not len(open_):
            return *found, scored
        order = open_[np.lexsort((first[open_], -bound[open_], item[open_]))]
        starts = np.flatnonzero(np.diff(item[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        chosen, rest = order[rank < width], order[rank >= width]
        who, doc = item[chosen], split[chosen]
        at = np.clip(lists.place(own[who], doc[:, None]), low[chosen], high[chosen])
        inside = at < high[chosen]
        there = inside & (lists.docs[np.where(inside, at, 0)] == doc[:, None])
        score = (weights[who] * np.where(there, lists.impacts[np.where(there, at, 0)], 0)).sum(axis=1)
        scored += len(chosen)

        both = tuple(np.concatenate(pair) for pair in zip(found, (who, doc, score)))
        order = np.lexsort((both[1], -both[2], both[0]))
        starts = np.flatnonzero(np.diff(both[0][order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        found = tuple(x[order[rank < top]] for x in both)
        full = order[rank == top - 1]
        limit[both[0][full]], limit_doc[both[0][full]] = both[2][full], both[1][full]

        new_item = np.concatenate([who, who])
        new_low, new_high = np.concatenate([low[chosen], at + there]), np.concatenate([at, high[chosen]])
        new_bound, new_split = bounded(new_item, new_low, new_high)
        new_first = np.concatenate([first[chosen], doc + 1])
        keep = new_bound > 0
        item, first, bound, split, low, high = (
            np.concatenate([old[rest], new[keep]])
            for old, new in zip((item, first, bound, split, low, high), (new_item, new_first, new_bound, new_split, new_low, new_high))
        )


def impact(counts: np.ndarray, lengths: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Impact of a term's occurrences in documents of these lengths, where so many documents have so many terms."""
    m = 100 - 25 + (25 * lengths * docs) // terms
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


def _search(settings: Settings, docs: int, terms: int, kind: pa.DataType):
    names = ["item", "doc_id", "score"]

    def run(rows: pa.Table) -> pa.Table:
        is_list = pc.is_valid(rows["term"])
        own, lists = rows.filter(pc.invert(is_list)), rows.filter(is_list)
        out = [pa.table([pa.array([], pa.int64()), pa.array([], kind), pa.array([], pa.int64())], names)]
        if len(lists):
            ids = own["doc_ids"].combine_chunks().flatten()
            lengths = own["lengths"].combine_chunks().flatten().to_numpy()
            places = [np.frombuffer(x, np.int32) for x in lists["docs"].to_pylist()]
            counts = np.concatenate([np.frombuffer(x, np.int32) for x in lists["counts"].to_pylist()]).astype(np.int64)
            bounds = np.cumsum([0, *map(len, places)])
            at = np.concatenate(places).astype(np.int64)
            maxima = RangeMaxima(bounds, at, impact(counts, lengths[at], docs, terms), len(ids))
            wanted: dict[int, list[tuple[int, int]]] = {}
            for i, asked in enumerate(lists["asked"].to_pylist()):
                for entry in asked:
                    wanted.setdefault(entry["item"], []).append((i, entry["weight"]))
            items = sorted(wanted.items(), key=lambda x: len(x[1]))
            for k in range(0, len(items), settings.batch_items):
                part = items[k : k + settings.batch_items]
                asked = [tuple(np.array(x, np.int64) for x in zip(*entries)) for _, entries in part]
                who, doc, score, _ = best_first(maxima, asked, settings.top, settings.width)
                keys = np.array([key for key, _ in part])
                out.append(pa.table([pa.array(keys[who]), ids.take(pa.array(doc)), pa.array(score)], names))
        return pa.concat_tables(out)

    return run


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def search(index: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the ``top`` documents with the highest
    scores above 0, equal scores by ascending doc_id with null last.

    Each segment is searched by itself for each block of items; its best are ranked with those of the others. Document
    frequencies and lengths are those of the whole index. Rows of items with the same id are items of their own, each
    with its ranks; an item without known terms, or null, has no rows. Documents with the same id are told apart.
    """
    spark = index.sparkSession
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    item_kind = items.schema["item_id"].dataType
    own = index.where("term is null")
    docs, terms = own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    named = settle(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items")
    blocks = max(1, -(-named.count() // settings.block_items))
    if not terms:
        return spark.createDataFrame([], "rank int, score long").select(F.lit(None).cast(item_kind).alias("item_id"), "rank", F.lit(None).cast(kind).alias("doc_id"), "score")
    asked = named.select("item", F.explode(_terms(text_or_empty("text"))).alias("term"))
    asked = settle(asked.groupBy("item", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("times")), "search-terms")
    lists = index.where("term is not null").select("segment", "term", "docs", "counts", "n")
    lists = settle(lists.join(asked.select("term").distinct(), "term", "left_semi"), "search-lists")
    share = F.floor(1000 * F.log((2 * F.lit(docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weights = lists.groupBy("term").agg(F.sum("n").alias("df")).select("term", share.cast("long").alias("w"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    entry = F.struct("item", (F.col("times") * F.col("w")).alias("weight"))
    wanted = asked.join(weights, "term").groupBy("term", block).agg(F.collect_list(entry).alias("asked"))
    hits = lists.join(wanted, "term").select("segment", "block", "term", "docs", "counts", "asked")
    own = own.select("segment", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "doc_ids", "lengths")
    rows = hits.unionByName(own, allowMissingColumns=True)
    arrow = pa.schema([("x", _arrow(spark, kind))]).field("x").type
    found = rows.groupBy("segment", "block").applyInArrow(_search(settings, docs, terms, arrow), f"item long, doc_id {kind}, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(settings.merge_parts)))
    for keys in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= settings.top)
    return found.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _arrow(spark, kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(f"x {kind}")["x"].dataType)


SEARCH_SQL = r"""
with split_docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
), totals as (
    select count(*) as docs, sum(len(terms)) as all_terms from split_docs where len(terms) > 0
), posting as (
    select r, any_value(doc_id) as doc_id, term, any_value(n) as n, count(*) as tf
    from (select r, doc_id, len(terms) as n, unnest(terms) as term from split_docs) group by r, term
), frequency as (
    select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
    from (select term, count(*) as df from posting group by term), totals
), item as (
    select row_number() over () as q, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), asked as (
    select q, item_id, term, count(*) as times from item group by q, item_id, term
), scored as (
    select q, item_id, r, doc_id, cast(sum(times * w * ((1000000000 * tf)
        // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // cast(all_terms as bigint))))) as bigint) as score
    from asked join frequency using (term) join posting using (term), totals
    group by q, item_id, r, doc_id
), ranked as (
    select item_id, doc_id, score, row_number() over (partition by q order by score desc, doc_id nulls last) as place
    from scored where score > 0
)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 20
"""
