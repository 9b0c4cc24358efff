"""Language model scores: a hierarchical Pitman-Yor model, seated by Gibbs sweeps over shards of words."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import text_or_empty
from fieldweave.llm.neardup import mixed
from fieldweave.session import new_work_dir, remove, settle, settle_at

#: Contexts: the last two bytes of the word before (the first is 0 for a word of one), or two spaces at the start of a
#: text. Their parents: the last byte. Both have a fixed number, however large the input is.
START, CONTEXTS, PARENTS = 0x2020, 65_536, 256
#: The token after the last word of a text.
END = (0x3C2F733E9E3779B9, 0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Settings:
    #: Sweeps before seatings count, and seatings that are averaged.
    burn_in: int = 2
    samples: int = 3
    #: Strength of each level: all words, by last byte, by last two bytes.
    strengths: tuple[float, float, float] = (1.0, 1.0, 1.0)
    seed: int = 1
    #: Bytes of text of a chunk at most, one text at least; bytes of text for each shard of words; chunks that are
    #: merged at once; tokens of a cell (a shard, or a copy of a hot one) on average.
    chunk_bytes: int = 4_000_000
    chunk_docs: int = 65_536
    shard_bytes: int = 16_000_000
    fan_in: int = 64
    cell_tokens: int = 4_000_000


#: Bytes that are hashed at once.
PIECE = 500_000
_ODD = np.uint64(0x100000001B3)


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """The texts in order, in groups of about ``PIECE`` bytes; a longer one is cut between words."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            to = at + PIECE
            while to < len(text) and text[to] not in b" \t\n\x0b\x0c\r":
                to += 1
            held.append(text[at:to])
            owners.append(i)
            size += len(held[-1])
            at = to
            if size >= PIECE:
                yield held, owners
                held, owners, size = [], [], 0
    if held:
        yield held, owners


@functools.cache
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _ODD, np.uint64))


def _hashed(held: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes, the last two bytes and the piece of each word; A-Z are lower-cased."""
    data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in held])
    inside = (data != 32) & ((data < 9) | (data > 13))
    change = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    chars = data[inside].astype(np.uint64)
    offset = np.arange(len(chars)) - np.repeat(before, lengths)
    longest = 1 << int(lengths.max() - 1).bit_length()
    h1 = mixed(np.add.reduceat((chars + np.uint64(1)) * _powers(longest)[offset], before))
    h2 = mixed(np.add.reduceat(mixed(chars + (offset.astype(np.uint64) << np.uint64(8))), before), 1)
    last = data[ends - 1].astype(np.int32)
    second = np.where(lengths > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int32)
    return h1, h2, second << 8 | last, np.searchsorted(bounds, starts, side="right")


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, context, owner) of all tokens of the texts in order: each word, then one end for each text."""
    parts = []
    for held, owners in _pieces(texts):
        h1, h2, tail, piece = _hashed(held)
        parts.append((h1, h2, tail, np.array(owners)[piece]))
    h1, h2, tail, owner = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))
    counts = np.bincount(owner, minlength=len(texts)) + 1
    ends = np.cumsum(counts) - 1
    at = np.arange(len(owner)) + owner
    out1, out2 = (np.full(len(owner) + len(texts), e, np.uint64) for e in END)
    out1[at], out2[at] = h1, h2
    context = np.full(len(out1), START, np.int32)
    context[at + 1] = tail
    first = ends + 1 - counts
    context[first] = START
    return out1, out2, context, np.repeat(np.arange(len(texts)), counts)


def _word_order(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the tokens by word, and the number of each ordered token's word."""
    order = np.argsort(h1, kind="stable")
    same = h1[order][1:] == h1[order][:-1]
    if (same & (h2[order][1:] != h2[order][:-1])).any():
        order = np.lexsort((h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    return order, np.cumsum(new) - 1


#: Added to the width of numbers whose bytes are compressed.
_SMALLER = 16


def pack(values: np.ndarray) -> bytes:
    """An array of numbers of 0 or more as bytes: how many each takes, then the first bytes of all numbers first, which
    compresses well where they are sorted. Compressed, after their length, if that is less: Spark's own codec only finds
    what is repeated, not that some bytes are more frequent."""
    values = np.ascontiguousarray(values).ravel()
    largest = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if largest < 1 << 8 * w)
    raw = values.astype(f"u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    less = pa.compress(raw, "zstd", asbytes=True)
    if len(less) + 4 < len(raw):
        return bytes([width + _SMALLER]) + len(raw).to_bytes(4, "little") + less
    return bytes([width]) + raw


def unpack(blob: bytes, kind: type = np.int64) -> np.ndarray:
    width, at = blob[0], 1
    if width > _SMALLER:
        width, at, blob = width - _SMALLER, 0, pa.decompress(memoryview(blob)[5:], int.from_bytes(blob[1:5], "little"), "zstd")
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8, offset=at).reshape(width, -1).T).view(f"u{width}").ravel().astype(kind)


def pack_rising(values: np.ndarray) -> bytes:
    """Numbers of 64 bits by what each is above the one before, which is little where they are sorted; others wrap."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_rising(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the first hash, so what is sorted by word is sorted by shard."""
    return ((h1 >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _chunked(batches: Iterable[pa.RecordBatch], settings: Settings) -> Iterator[tuple[int, list[bytes], pa.Array, np.ndarray]]:
    """(chunk, texts, ids, whether held out) of so many texts as a chunk takes."""
    number = TaskContext.get().partitionId() << 32
    texts, ids, held, size = [], [], [], 0
    for batch in batches:
        out = batch["held_out"].to_numpy(zero_copy_only=False)
        for i, text in enumerate(batch["text"].cast(pa.binary())):
            text = text.as_py()
            if texts and (size + len(text) > settings.chunk_bytes or len(texts) == settings.chunk_docs):
                yield number, texts, pa.concat_arrays(ids), np.array(held)
                texts, ids, held, size, number = [], [], [], 0, number + 1
            texts.append(text)
            ids.append(batch["doc_id"][i : i + 1])
            held.append(out[i])
            size += len(text)
    if texts:
        yield number, texts, pa.concat_arrays(ids), np.array(held)


def _counts(settings: Settings, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each chunk and shard: its tokens, and the words and contexts of the training texts with their counts."""
        for chunk, texts, _, held in _chunked(batches, settings):
            h1, h2, context, owner = tokens(texts)
            load = np.bincount(shard_of(h1, shards), minlength=shards)
            train = ~held[owner]
            h1, h2, context = h1[train], h2[train], context[train]
            order, word = _word_order(h1, h2)
            entries, counts = np.unique(word << 16 | context[order], return_counts=True)
            firsts = order[np.searchsorted(word, np.arange(word[-1] + 1 if len(word) else 0))]
            h1, h2 = h1[firsts], h2[firsts]
            yield _entry_rows(chunk, h1, h2, entries >> 16, entries & 0xFFFF, counts, load, shards)

    return run


_ENTRIES = "chunk long, shard long, load long, words binary, sizes binary, contexts binary, counts binary"


def _entry_rows(chunk: int, h1, h2, word, context, counts, load, shards: int) -> pa.RecordBatch:
    shard = shard_of(h1, shards)
    starts = np.searchsorted(shard, np.arange(shards + 1))
    edges = np.searchsorted(word, starts)
    sizes = np.bincount(word, minlength=len(h1)).astype(np.int32)
    words = np.stack([h1, h2], axis=1)
    used = np.flatnonzero(load)
    cut = lambda values, at: pa.array([pack(values[at[s] : at[s + 1]]) for s in used], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(used), chunk)), pa.array(used), pa.array(load[used].astype(np.int64)), cut(words, starts), cut(sizes, starts),
            cut(context.astype(np.uint16), edges), cut(counts.astype(np.int64), edges),
        ],
        ["chunk", "shard", "load", "words", "sizes", "contexts", "counts"],
    )


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    """One row of the entries of several."""
    blob = lambda name, kind: np.concatenate([unpack(b, kind) for b in rows[name].to_pylist()])
    words, sizes, context, counts = blob("words", np.uint64).reshape(-1, 2), blob("sizes", np.int32), blob("contexts", np.uint16), blob("counts", np.int64)
    order, word = _word_order(words[:, 0], words[:, 1])
    number = np.empty(len(order), np.int64)
    number[order] = word
    entries, at = np.unique(np.repeat(number, sizes) << 16 | context, return_inverse=True)
    sums = np.bincount(at, counts, len(entries)).astype(np.int64)
    firsts = order[np.searchsorted(word, np.arange(word[-1] + 1 if len(word) else 0))]
    sizes = np.bincount(entries >> 16, minlength=len(firsts)).astype(np.int32)
    load = int(np.sum(rows["load"].to_numpy()))
    parts = [pack(x) for x in (words[firsts], sizes, (entries & 0xFFFF).astype(np.uint16), sums)]
    return pa.table([[key[1].as_py()], [key[0].as_py()], [load], *([p] for p in parts)], schema=_ENTRY_SCHEMA)


_ENTRY_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("shard", pa.int64()), ("load", pa.int64()), *((n, pa.binary()) for n in ("words", "sizes", "contexts", "counts"))]
)


@dataclass
class Level:
    """What all shards know of a level: discount and strength; customers and tables of each restaurant."""

    discount: float
    strength: float
    customers: np.ndarray
    tables: np.ndarray

    @property
    def rest(self) -> np.ndarray:
        """Share of each restaurant that is left to its parent; all of it where no one sits."""
        return (self.strength + self.discount * self.tables) / (self.strength + self.customers)

    def own(self, customers: np.ndarray, tables: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        return (customers - self.discount * tables) / (self.strength + self.customers[at])


@dataclass
class Levels:
    words: int
    train_tokens: int
    all: Level
    byte: Level
    pair: Level


class Shard:
    """Entries of a shard: its words, their contexts with counts, and the restaurants above."""

    def __init__(self, words: bytes, sizes: bytes, contexts: bytes, counts: bytes):
        self.words = unpack(words, np.uint64).reshape(-1, 2)
        sizes = unpack(sizes, np.int32)
        self.context, self.counts = unpack(contexts, np.uint16).astype(np.int64), unpack(counts, np.int64)
        self.word = np.repeat(np.arange(len(sizes)), sizes)
        parent = self.word << 8 | self.context & 255
        self.parents, self.up = np.unique(parent, return_inverse=True)
        self.parent_word, self.parent_byte = self.parents >> 8, self.parents & 255

    def above(self, pair_tables: np.ndarray) -> np.ndarray:
        """Customers of the restaurants by last byte: a table of one by two bytes is one."""
        return np.bincount(self.up, pair_tables, len(self.parents))

    def top(self, byte_tables: np.ndarray) -> np.ndarray:
        return np.bincount(self.parent_word, byte_tables, len(self.words))

    def probabilities(self, levels: Levels, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word; of each word after each last byte; and after each context."""
        zero, one, two = tables
        by_all = levels.all.own(self.top(one), zero, 0) + levels.all.rest[0] / (levels.words + 1)
        by_byte = levels.byte.own(self.above(two), one, self.parent_byte) + levels.byte.rest[self.parent_byte] * by_all[self.parent_word]
        by_pair = levels.pair.own(self.counts, two, self.context) + levels.pair.rest[self.context] * by_byte[self.up]
        return by_all, by_byte, by_pair


def seated(customers: np.ndarray, others: np.ndarray, base: np.ndarray, strength: float, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables that the customers of each dish take when all of them leave and come in again one after another.

    A customer takes a new table with a chance in proportion to (strength + discount * tables of the restaurant) *
    chance of the dish at the parent, and an old one of the dish in proportion to its customers less the discount of
    each of its tables. From the 65th customer on the chance is held for a 64th of those who sit already.
    ``others``: tables of other dishes.
    """
    order = np.argsort(-customers, kind="stable")
    left, others, base = customers[order], others[order], base[order]
    tables, down = (left > 0).astype(np.int64), -left
    sitting = 1
    while (n := int(np.searchsorted(down, -sitting, side="left"))) > 0:
        some = np.minimum(max(1, sitting // 64), left[:n] - sitting)
        new = (strength + discount * (others[:n] + tables[:n])) * base[:n]
        chance = new / (new + sitting - discount * tables[:n])
        tables[:n] += random.random(n) < chance if sitting < 128 else random.binomial(some.astype(np.int64), chance)
        sitting += max(1, sitting // 64)
    out = np.empty_like(tables)
    out[order] = tables
    return out


_SPARSE = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int64())]))
_TOTALS = "totals array<struct<at:int,n:long>>"


def _sparse(totals: np.ndarray) -> pa.Array:
    """The numbers other than 0 with their places, as one list."""
    at = np.flatnonzero(totals)
    pairs = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at].astype(np.int64))], ["at", "n"])
    return pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pairs)


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, as each holds a shard."""
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


_STATE = "shard long, load long, words binary, sizes binary, contexts binary, counts binary, tables array<binary>, sums array<binary>, totals array<struct<at:int,n:long>>"


def _state_rows(row: dict, shard: Shard, tables: list[np.ndarray], sums: list[np.ndarray]) -> pa.Table:
    one = np.bincount(shard.parent_byte, tables[1], PARENTS)
    two = np.bincount(shard.context, tables[2], CONTEXTS)
    parts = {**{n: [row[n]] for n in ("shard", "load", *_BLOBS)}, "tables": [[pack(t) for t in tables]], "sums": [[pack(t) for t in sums]]}
    return pa.table({**parts, "totals": _sparse(np.concatenate([[tables[0].sum()], one, two]))}).cast(_STATE_SCHEMA)


_STATE_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("load", pa.int64()), *((n, pa.binary()) for n in ("words", "sizes", "contexts", "counts")),
     ("tables", pa.list_(pa.binary())), ("sums", pa.list_(pa.binary())), ("totals", _SPARSE)]
)
_BLOBS = ("words", "sizes", "contexts", "counts")


def _first_seating(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table for each dish of each restaurant."""
    for row in _each(batches):
        shard = Shard(*(row[n] for n in _BLOBS))
        tables = [np.ones(len(x), np.int64) for x in (shard.words, shard.parents, shard.counts)]
        yield from _state_rows(row, shard, tables, [np.zeros(len(t), np.int64) for t in tables]).to_batches()


def _frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard: its words; training tokens by context; dishes with one and with two customers on each level."""
    for row in _each(batches):
        shard = Shard(*(row[n] for n in _BLOBS))
        few = []
        for customers in (shard.top(np.ones(len(shard.parents))), shard.above(np.ones(len(shard.counts))), shard.counts):
            few += [(customers == 1).sum(), (customers == 2).sum()]
        totals = np.concatenate([[len(shard.words), *few], np.bincount(shard.context, shard.counts, CONTEXTS)])
        yield pa.RecordBatch.from_arrays([_sparse(totals)], ["totals"])


def _sweep(levels: Levels, settings: Settings, sweep: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            shard = Shard(*(row[n] for n in _BLOBS))
            zero, one, two = (unpack(t) for t in row["tables"])
            random = np.random.default_rng([settings.seed, sweep, row["shard"]])
            by_all, by_byte, _ = shard.probabilities(levels, [zero, one, two])
            place = shard.context
            two = seated(shard.counts, levels.pair.tables[place] - two, by_byte[shard.up], levels.pair.strength, levels.pair.discount, random)
            place = shard.parent_byte
            one = seated(shard.above(two).astype(np.int64), levels.byte.tables[place] - one, by_all[shard.parent_word], levels.byte.strength, levels.byte.discount, random)
            base = np.full(len(zero), 1 / (levels.words + 1))
            zero = seated(shard.top(one).astype(np.int64), levels.all.tables[0] - zero, base, levels.all.strength, levels.all.discount, random)
            tables, sums = [zero, one, two], [unpack(t) for t in row["sums"]]
            if sweep >= settings.burn_in:
                sums = [s + t for s, t in zip(sums, tables)]
            yield from _state_rows(row, shard, tables, sums).to_batches()

    return run


def _totals(rows: DataFrame, size: int) -> np.ndarray:
    """Sums of the shards' numbers, of which there is a fixed count."""
    summed = rows.select(F.inline("totals")).groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[summed["at"].to_numpy()] = summed["n"].to_numpy()
    return out


def _split_totals(totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return totals[:1], totals[1 : 1 + PARENTS], totals[1 + PARENTS :]


def _level_customers(pair_tables: np.ndarray, byte_tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    contexts = np.arange(CONTEXTS)
    byte = np.bincount(contexts & 255, pair_tables, PARENTS)
    return np.array([byte_tables.sum()]), byte


@dataclass
class Model:
    """The trained model: a row for each shard of words, with the tables of the averaged seatings, and what is known of
    all restaurants."""

    shards: DataFrame
    levels: Levels
    n_shards: int
    settings: Settings = field(default_factory=Settings)


def in_training(remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != remainder


def _prepared(docs: DataFrame, train: Column) -> DataFrame:
    return docs.select("doc_id", text_or_empty("text").alias("text"), (~train).alias("held_out"))


def learn(docs: DataFrame, train: Column | None = None, settings: Settings = Settings()) -> Model:
    """The model of the training texts (those of which ``train`` holds), whole, with all their words and contexts.

    Each context, the last two bytes of the word before or the start, is a restaurant; those with the same last byte
    share a parent, and all of these share one. A word's customers in all restaurants are in one shard, so its parent
    chances are at hand; what other words take there is known by totals, of which there are 65,793 at any size of
    input, brought up to date after each sweep. A sweep seats the customers of each word again, from the contexts
    upwards, given the totals before. Discounts are n1 / (n1 + 2 n2) of the first seating of each level.
    The same input gives the same model.
    """
    train = in_training() if train is None else train
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // settings.shard_bytes))
    chunks = max(1, -(-size // settings.chunk_bytes))
    entries = _prepared(docs, train).mapInArrow(_counts(settings, shards), _ENTRIES)
    while chunks > settings.fan_in:
        # Of a word that each chunk has, no task sees more than so many chunks at once.
        chunks = -(-chunks // settings.fan_in)
        group = F.pmod(F.xxhash64("chunk"), F.lit(chunks)).alias("chunk")
        entries = entries.withColumn("chunk", group).groupBy("shard", "chunk").applyInArrow(_merge, _ENTRIES)
    spark = docs.sparkSession
    path = new_work_dir(spark, "lm-entries")
    merged = settle_at(entries.withColumn("chunk", F.lit(0).cast("long")).groupBy("shard", "chunk").applyInArrow(_merge, _ENTRIES), path)
    found = _totals(merged.mapInArrow(_frequent, _TOTALS), 7 + CONTEXTS)
    few, by_context = found[1:7].reshape(3, 2), found[7:]
    discounts = [min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5 for n1, n2 in few]

    def next_state(rows: DataFrame, step) -> DataFrame:
        """The state is written, then the one before it, which nothing reads any more, is removed."""
        nonlocal path
        old, path = path, new_work_dir(spark, "lm-state")
        rows = settle_at(rows.mapInArrow(step, _STATE), path)
        remove(spark, old)
        return rows

    state = next_state(merged, _first_seating)

    def levels(rows: DataFrame, times: int = 1) -> Levels:
        zero, one, two = (t / times for t in _split_totals(_totals(rows, 1 + PARENTS + CONTEXTS)))
        top, byte = _level_customers(two, one)
        parts = zip(discounts, settings.strengths, (top, byte, by_context), (zero, one, two))
        return Levels(int(found[0]), int(by_context.sum()), *(Level(*p) for p in parts))

    for sweep in range(settings.burn_in + settings.samples):
        state = next_state(state, _sweep(levels(state), settings, sweep))
    averaged = levels(state.select("shard", *_BLOBS, "sums").mapInArrow(_sum_totals, _TOTALS), times=settings.samples)
    return Model(state.select("shard", "load", *_BLOBS, "sums"), averaged, shards, settings)


def _sum_totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _each(batches):
        shard = Shard(*(row[n] for n in _BLOBS))
        sums = [unpack(t) for t in row["sums"]]
        totals = np.concatenate([[sums[0].sum()], np.bincount(shard.parent_byte, sums[1], PARENTS), np.bincount(shard.context, sums[2], CONTEXTS)])
        yield pa.RecordBatch.from_arrays([_sparse(totals)], ["totals"])


class Scorer:
    """Chances of tokens whose words are in one shard."""

    def __init__(self, row: dict | None, levels: Levels, samples: int):
        self.levels = levels
        self.shard = Shard(*(row[n] if row else b"\x01" for n in _BLOBS))
        tables = [unpack(t) / samples for t in row["sums"]] if row else [np.zeros(0)] * 3
        self.by_all, self.by_byte, self.by_pair = self.shard.probabilities(levels, tables)
        self.counts = np.bincount(self.shard.word, self.shard.counts, len(self.shard.words))

    @staticmethod
    def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)

    def word_numbers(self, words: np.ndarray) -> np.ndarray:
        """Place of each word, -1 for unknown ones. Words with the same first hash follow each other."""
        own = self.shard.words
        at = np.searchsorted(own[:, 0], words[:, 0])
        out = np.full(len(words), -1)
        open_ = np.arange(len(words))
        while len(open_):
            place = at[open_]
            inside = place < len(own)
            open_, place = open_[inside], place[inside]
            same = own[place, 0] == words[open_, 0]
            open_, place = open_[same], place[same]
            hit = own[place, 1] == words[open_, 1]
            out[open_[hit]] = place[hit]
            open_ = open_[~hit]
            at[open_] += 1
        return out

    def __call__(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance and training count of tokens: word number (-1: unknown) and context."""
        levels, known = self.levels, word >= 0
        at = np.maximum(word, 0)
        chance = np.full(len(word), levels.all.rest[0] / (levels.words + 1))
        counts = np.zeros(len(word))
        if len(self.by_all):
            chance[known], counts[known] = self.by_all[at[known]], self.counts[at[known]]
        byte = context & 255
        place, seen = self._found(self.shard.parents, at << 8 | byte)
        seen &= known
        chance = levels.byte.rest[byte] * chance
        chance[seen] = self.by_byte[place[seen]]
        place, seen = self._found(self.shard.word << 16 | self.shard.context, at << 16 | context)
        seen &= known
        chance = levels.pair.rest[context] * chance
        chance[seen] = self.by_pair[place[seen]]
        return chance, counts


_PROBES = ["chunk", "shard", "words", "sizes", "contexts", "times", "docs", "ids", "held_out", "n_tokens"]


def _probe_rows(settings: Settings, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk a row of its texts, and one for each shard: words, their contexts, and the texts of each."""
        for chunk, texts, ids, held in _chunked(batches, settings):
            h1, h2, context, owner = tokens(texts)
            own = np.bincount(owner, minlength=len(texts))
            order, word = _word_order(h1, h2)
            keys = word << 16 | context[order]
            again = np.argsort(keys, kind="stable")
            keys, docs = keys[again], owner[order[again]].astype(np.uint16)
            starts = np.flatnonzero(np.diff(keys, prepend=-1))
            entries, times = keys[starts], np.diff(np.append(starts, len(keys)))
            firsts = order[np.searchsorted(word, np.arange(word[-1] + 1))]
            words = np.stack([h1[firsts], h2[firsts]], axis=1)
            at_word = np.searchsorted(shard_of(words[:, 0], shards), np.arange(shards + 1))
            at_entry = np.searchsorted(entries >> 16, at_word)
            at_token = np.append(starts, len(keys))[at_entry]
            sizes = np.bincount(entries >> 16, minlength=len(words)).astype(np.int32)
            contexts, times = (entries & 0xFFFF).astype(np.uint16), times.astype(np.int32)
            used = np.flatnonzero(np.diff(at_word))
            n = len(used)
            cut = lambda values, at: pa.array([pack(values[at[s] : at[s + 1]]) for s in used], pa.binary())
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            empty = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([int(mixed(np.array([chunk], np.uint64))[0] % np.uint64(shards))]), *[empty] * 5, whole(ids), whole(pa.array(held)), whole(pa.array(own))], _PROBES
            )
            nulls = [pa.nulls(n, pa.list_(t)) for t in (ids.type, pa.bool_(), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk)), pa.array(used), cut(words, at_word), cut(sizes, at_word), cut(contexts, at_entry), cut(times, at_entry), cut(docs, at_token), *nulls], _PROBES
            )

    return run


def _probe(levels: Levels, samples: int):
    def run(probes: pa.Table, shard: pa.Table) -> pa.Table:
        """For each chunk what its texts get from the words of this shard; rows of texts pass."""
        scorer = Scorer(shard.to_pylist()[0] if len(shard) else None, levels, samples)
        out = []
        for batch in probes.to_batches(max_chunksize=64):
            for i, row in enumerate(batch.select(["chunk", "words", "sizes", "contexts", "times", "docs"]).to_pylist()):
                if row["words"] is None:
                    keep = batch.slice(i, 1)
                    out.append(pa.table([keep["chunk"], *[pa.nulls(1, pa.binary())] * 2, keep["ids"], keep["held_out"], keep["n_tokens"]], _SUMS))
                    continue
                words = unpack(row["words"], np.uint64).reshape(-1, 2)
                sizes, contexts, times, docs = (unpack(row[n], k) for n, k in (("sizes", np.int32), ("contexts", np.uint16), ("times", np.int32), ("docs", np.uint16)))
                chance, counts = scorer(np.repeat(scorer.word_numbers(words), sizes), contexts.astype(np.int64))
                base = np.log10((counts + 1) / (levels.train_tokens + levels.words + 1))
                values = np.repeat(np.stack([np.log10(chance), base, counts > 0], axis=1), times, axis=0)
                kinds = [probes.schema.field(n).type for n in ("ids", "held_out", "n_tokens")]
                out.append(pa.table([pa.array([row["chunk"]]), *(pa.array([b], pa.binary()) for b in _summed(docs, values)), *(pa.nulls(1, k) for k in kinds)], _SUMS))
        return pa.concat_tables(out)

    return run


_SUMS = ["chunk", "docs", "sums", "ids", "held_out", "n_tokens"]


def _summed(docs: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    """The texts that tokens are of, and the sums of their three values for each."""
    texts, at = np.unique(docs.astype(np.uint64), return_inverse=True)
    sums = np.stack([np.bincount(at, values[:, k], len(texts)) for k in range(3)])
    return pack_rising(texts), pack(sums.view(np.uint64))


def _gather(rows: pa.Table) -> pa.Table:
    """The texts of one chunk with what the shards gave."""
    head = rows.filter(pc.is_valid(rows["ids"]))
    ids, held, own = (head[n].combine_chunks().flatten() for n in ("ids", "held_out", "n_tokens"))
    sums = np.zeros((len(ids), 3))
    # Summed in order of the parts, so that reruns agree to the last bit.
    parts = sorted((d, s) for d, s in zip(rows["docs"].to_pylist(), rows["sums"].to_pylist()) if d is not None)
    for docs, values in parts:
        sums[unpack_rising(docs).astype(np.int64)] += unpack(values, np.uint64).view(np.float64).reshape(3, -1).T
    return pa.table([ids, held, own, pa.array(sums[:, 2].round().astype(np.int64)), pa.array(sums[:, 1]), pa.array(sums[:, 0])], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, model: Model, train: Column | None = None) -> DataFrame:
    """A row for each text: doc_id, held_out, n_tokens, n_known (tokens of words in training), train_tokens,
    base_score (log10 with counts plus one), score (the model's log10 probability) and perplexity.

    Null texts are empty: one end. Rows alike are scored each; a null doc_id is kept. An unknown word has the chance of
    the one word beyond the vocabulary. Texts are read in chunks; what a chunk holds of a shard's words meets that shard, of
    which hot ones have copies.
    """
    settings, levels = model.settings, model.levels
    train = in_training() if train is None else train
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = f"ids array<{kind}>, held_out array<boolean>, n_tokens array<long>"
    probes = _prepared(docs, train).mapInArrow(
        _probe_rows(settings, model.n_shards), f"chunk long, shard long, words binary, sizes binary, contexts binary, times binary, docs binary, {lists}"
    )
    copies = F.greatest(F.lit(1), F.ceil(F.col("load") / settings.cell_tokens)).cast("int")
    # One small row for each shard, written so that its size is known to the optimizer.
    probes = probes.join(settle(model.shards.select("shard", copies.alias("copies")), "lm-copies"), "shard", "left")
    probes = probes.withColumn("copy", F.pmod(F.xxhash64("chunk"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    shards = model.shards.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    sums = probes.groupBy("shard", "copy").cogroup(shards.groupBy("shard", "copy")).applyInArrow(
        _cell(_probe(levels, settings.samples)), f"chunk long, docs binary, sums binary, {lists}"
    )
    out = sums.groupBy("chunk").applyInArrow(
        _gather, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(levels.train_tokens).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity")
    )


def _cell(run):
    def cell(probes: pa.Table, shard: pa.Table) -> pa.Table:
        # A shard that no text asks of gives nothing.
        if not len(probes):
            kinds = [probes.schema.field(n).type for n in ("ids", "held_out", "n_tokens")]
            return pa.table([pa.array([], pa.int64()), *[pa.array([], pa.binary())] * 2, *(pa.array([], k) for k in kinds)], _SUMS)
        return run(probes, shard)

    return cell
