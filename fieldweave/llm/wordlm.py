"""Language model scores: a hierarchical Pitman-Yor model of words after whole words, seated by Gibbs sweeps over shards."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm import lm
from fieldweave.llm.common import give_back, tidy
from fieldweave.llm.lm import pack, pack_rising, seated, shard_of, unpack, unpack_rising
from fieldweave.llm.neardup import mixed
from fieldweave.session import new_work_dir, remove, settle, settle_at, short_shuffles


@dataclass(frozen=True)
class Settings:
    #: Sweeps before seatings count, and seatings that are averaged.
    burn_in: int = 2
    samples: int = 3
    #: Strength of each level: all words, and words after a word.
    strengths: tuple[float, float] = (1.0, 1.0)
    seed: int = 1
    #: The texts are scored in so many parts, one after another: what a part asks of the shards and gets from them is on
    #: disk only while it is scored.
    parts: int = 2
    #: As in ``lm.Settings``.
    chunk_bytes: int = 6_000_000
    chunk_docs: int = 65_536
    shard_bytes: int = 16_000_000
    fan_in: int = 256
    cell_tokens: int = 4_000_000


_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), 0xFFFFFFFF


def names(words: np.ndarray) -> np.ndarray:
    """Words as contexts: 64 bits of their two hashes, in the same shard. Of n words two are alike with a chance of
    n * n / 2 ** 65; these would share a restaurant."""
    h1, h2 = words[:, 0], words[:, 1]
    return h1 & _HIGH | mixed(h1 ^ mixed(h2, 3), 4) >> np.uint64(32)


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words of the texts in order; and of each token its word, the word before it and its text. Before
    a text stands the end of another."""
    h1, h2, _, owner = lm.tokens(texts)
    words, word = _different(h1, h2)
    return words, word, np.concatenate([word[-1:], word[:-1]]), owner


def _different(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different words in order, and the number of each word."""
    order = np.argsort(h1)
    a, b = h1[order], h2[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return np.stack([a[new], b[new]], axis=1), number


def _by_shard(at: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Order by the word's shard, then context, then word. at: the shard of each word, which grows with its number."""
    n = len(at)
    if int(at[-1] + 1) * n * n < 1 << 63:
        return np.argsort((at[word] * n + before) * n + word)
    return np.lexsort((word, before, at[word]))


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


#: What a row has of words and the contexts they follow: first and second hashes of the words, and names of the contexts,
#: each in order; how many entries each context has; the number of each entry's word.
_PAIRS = ("firsts", "seconds", "contexts", "sizes", "word")
_BLOBS = (*_PAIRS, "counts")
_FIELDS = ", ".join(f"{n} binary" for n in _BLOBS)
_ENTRIES = f"chunk long, shard long, load long, {_FIELDS}"
_FOUND = ("n_words", "n_tokens", "one0", "two0", "one1", "two1")
_SEATS = ("all_tables", "all_customers")
_KINDS = dict.fromkeys(("chunk", "shard", "to", "load", *_FOUND, *_SEATS), pa.int64())


def _packed(words: np.ndarray, contexts: np.ndarray, sizes: np.ndarray, word: np.ndarray) -> dict[str, bytes]:
    parts = pack_rising(words[:, 0]), pack(words[:, 1]), pack_rising(contexts), pack(sizes), pack(word)
    return dict(zip(_PAIRS, parts))


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = np.stack([unpack_rising(row["firsts"]), unpack(row["seconds"], np.uint64)], axis=1)
    return words, unpack_rising(row["contexts"]), unpack(row["sizes"]), unpack(row["word"])


def _row(**values) -> pa.RecordBatch:
    """One row; all columns that are no numbers are bytes."""
    arrays = [pa.array([v], _KINDS.get(n, pa.binary())) for n, v in values.items()]
    return pa.RecordBatch.from_arrays(arrays, list(values))


def _counts(settings: Settings, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each chunk and shard: its tokens, the words of the training texts, and by context how often each follows."""
        for chunk, texts, _, held in lm._chunked(batches, settings):
            words, word, before, owner = numbered(texts)
            load = np.bincount(shard_of(words[:, 0], shards), np.bincount(word, minlength=len(words)), shards)
            train = ~held[owner]
            entries, counts = np.unique(before[train] << 32 | word[train], return_counts=True)
            contexts, at = names(words), shard_of(words[:, 0], shards)
            before, word = entries >> 32, entries & _LOW
            order = _by_shard(at, before, word)
            word, before, counts = word[order], before[order], counts[order]
            known = np.zeros(len(words), bool)
            known[word] = True
            words, at, word = words[known], at[known], (np.cumsum(known) - 1)[word]
            at_word = np.searchsorted(at, np.arange(shards + 1))
            at_entry = np.searchsorted(at[word], np.arange(shards + 1))
            for s in np.flatnonzero(load).tolist():
                own = slice(at_entry[s], at_entry[s + 1])
                starts = _starts(before[own])
                parts = words[at_word[s] : at_word[s + 1]], contexts[before[own][starts]], np.diff(np.append(starts, own.stop - own.start)), word[own] - at_word[s]
                yield _row(chunk=chunk, shard=s, load=int(load[s]), **_packed(*parts), counts=pack(counts[own]))

    return run


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    """One row of the entries of several, in order of contexts."""
    words, contexts, sizes, word = zip(*map(_unpacked, rows.select(_PAIRS).to_pylist()))
    offsets = np.cumsum([0] + [len(w) for w in words])
    words, number = _different(*np.concatenate(words).T)
    word = number[np.concatenate([w + o for w, o in zip(word, offsets)])]
    contexts, context = np.unique(np.concatenate(contexts), return_inverse=True)
    keys = np.repeat(context, np.concatenate(sizes)) << 32 | word
    order = np.argsort(keys)
    keys = keys[order]
    starts = _starts(keys)
    counts, keys = _sums(np.concatenate([unpack(b) for b in rows["counts"].to_pylist()])[order], starts), keys[starts]
    parts = words, contexts, np.bincount(keys >> 32, minlength=len(contexts)), keys & _LOW
    load = int(np.sum(rows["load"].to_numpy()))
    give_back()
    return pa.Table.from_batches([_row(chunk=key[1].as_py(), shard=key[0].as_py(), load=load, **_packed(*parts), counts=pack(counts))])


class Shard:
    """Entries of a shard: its words, the contexts they follow, and how often each word follows each."""

    def __init__(self, row: dict):
        self.words, self.contexts, sizes, self.word = _unpacked(row)
        self.counts = unpack(row["counts"])
        self.at = np.repeat(np.arange(len(sizes)), sizes)
        self.starts = np.cumsum(sizes) - sizes

    def top(self, tables: np.ndarray) -> np.ndarray:
        """Customers of the restaurant of all words: a table after a word is one."""
        return np.bincount(self.word, tables, len(self.words))


@dataclass
class Levels:
    """What all shards know: words and tokens of training, discounts and strengths, tables and customers of the
    restaurant of all words."""

    words: int
    train_tokens: int
    discounts: tuple[float, float]
    strengths: tuple[float, float]
    tables: float
    customers: float

    @property
    def unseen(self) -> float:
        """The chance of a word that training does not have."""
        return (self.strengths[0] + self.discounts[0] * self.tables) / (self.strengths[0] + self.customers) / (self.words + 1)

    def by_all(self, shard: Shard, zero: np.ndarray, one: np.ndarray) -> np.ndarray:
        return (shard.top(one) - self.discounts[0] * zero) / (self.strengths[0] + self.customers) + self.unseen

    def rest(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Share of restaurants that is left to that of all words; all of it where no one sits."""
        return (self.strengths[1] + self.discounts[1] * tables) / (self.strengths[1] + customers)


_ASKS = ("ask_contexts", "ask_customers", "ask_tables")
_SEATINGS = ("zero", "one", "zero_sum", "one_sum")
_STATE = ", ".join(
    [f"{n} long" for n in ("shard", "to", "load", *_FOUND, *_SEATS)] + [f"{n} binary" for n in (*_BLOBS, *_SEATINGS, *_ASKS)]
)
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]


def _state(row: dict, shard: Shard, shards: int, seatings: tuple, last: bool = False, found: dict | None = None) -> pa.Table:
    """A row of the state of a shard, and below it what it asks of the shards of its contexts: their totals, of which it
    gives its part. Last, the parts are those of the summed seatings."""
    zero, one, zero_sum, one_sum = seatings
    zero, one = (zero_sum, one_sum) if last else (zero, one)
    numbers = {"shard": row["shard"], "load": row["load"], "all_tables": int(zero.sum()), "all_customers": int(one.sum()), **(found or {})}
    full = numbers | {n: row[n] for n in _BLOBS} | {n: pack(x) for n, x in zip(_SEATINGS, seatings)}
    rows = [_row(**{n: full.get(n) for n in _STATE_NAMES})]
    customers, seats = _sums(shard.counts, shard.starts), _sums(one, shard.starts)
    bounds = np.searchsorted(shard_of(shard.contexts, shards), np.arange(shards + 1))
    for to in np.flatnonzero(np.diff(bounds)).tolist():
        own = slice(bounds[to], bounds[to + 1])
        parts = pack_rising(shard.contexts[own]), pack(customers[own]), pack(seats[own])
        ask = {"shard": row["shard"], "to": to} | dict(zip(_ASKS, parts))
        rows.append(_row(**{n: ask.get(n) for n in _STATE_NAMES}))
    return pa.Table.from_batches(rows)


def _begin(shards: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """The first state of a shard: one table for each dish of each restaurant; its words, training tokens, and dishes
        with one and with two customers on each level."""
        [row] = _merge(key, rows).to_pylist()
        shard = Shard(row)
        zero, one = np.ones(len(shard.words), np.int64), np.ones(len(shard.counts), np.int64)
        few = [int((c == k).sum()) for c in (shard.top(one), shard.counts) for k in (1, 2)]
        found = dict(zip(_FOUND, (len(shard.words), int(shard.counts.sum()), *few)))
        out = _state(row, shard, shards, (zero, one, 0 * zero, 0 * one), found=found)
        give_back()
        return out

    return run


_ANSWERS = "shard long, to long, customers binary, tables binary"


def _answers(own: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """The sums over all shards, for each shard that asked in the order it asked in; and for the context's own shard."""
        asked = [unpack_rising(b) for b in rows["ask_contexts"].to_pylist()]
        contexts, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([unpack(b) for b in rows[n].to_pylist()]), len(contexts)).astype(np.int64) for n in _ASKS[1:]]
        to, out, end = key[0].as_py(), [], 0
        for shard, names_ in zip(rows["shard"].to_pylist(), asked):
            part = at[end : (end := end + len(names_))]
            out.append(_row(shard=shard, to=to, customers=pack(sums[0][part]), tables=pack(sums[1][part])))
        if own:
            out.append(_row(shard=to, to=-1, customers=None, tables=pack(sums[1])))
        give_back()
        return pa.Table.from_batches(out)

    return run


def _around(answers: pa.Table) -> list[np.ndarray]:
    """Customers and tables of a shard's contexts, which are in order of shards."""
    rows = sorted((r for r in answers.select(["to", "customers", "tables"]).to_pylist() if r["to"] >= 0), key=lambda r: r["to"])
    return [np.concatenate([np.zeros(0, np.int64), *(unpack(r[n]) for r in rows)]) for n in ("customers", "tables")]


def _sweep(levels: Levels, settings: Settings, shards: int, sweep: int):
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        [row] = state.to_pylist()
        shard = Shard(row)
        zero, one, zero_sum, one_sum = (unpack(row[n]) for n in _SEATINGS)
        _, tables = _around(answers)
        random = np.random.default_rng([settings.seed, sweep, row["shard"]])
        by_all = levels.by_all(shard, zero, one)
        (d0, d1), (s0, s1) = levels.discounts, levels.strengths
        one = seated(shard.counts, tables[shard.at] - one, by_all[shard.word], s1, d1, random)
        base = np.full(len(zero), 1 / (levels.words + 1))
        zero = seated(shard.top(one).astype(np.int64), levels.tables - zero, base, s0, d0, random)
        if sweep >= settings.burn_in:
            zero_sum, one_sum = zero_sum + zero, one_sum + one
        last = sweep == settings.burn_in + settings.samples - 1
        out = _state(row, shard, shards, (zero, one, zero_sum, one_sum), last)
        give_back()
        return out

    return run


_TRAINED = f"shard long, load long, {_FIELDS}, zero_sum binary, one_sum binary, customers binary, tables binary, own_tables binary"


def _trained(state: pa.Table, answers: pa.Table) -> pa.Table:
    """A shard with the totals of its contexts, and of its words as contexts."""
    [row] = state.to_pylist()
    customers, tables = _around(answers)
    own = next((r["tables"] for r in answers.to_pylist() if r["to"] < 0), pack(np.zeros(0, np.int64)))
    blobs = {n: row[n] for n in (*_BLOBS, "zero_sum", "one_sum")} | {"customers": pack(customers), "tables": pack(tables)}
    return pa.Table.from_batches([_row(shard=row["shard"], load=row["load"], **blobs, own_tables=own)])


@dataclass
class Model:
    """The trained model: a row for each shard of words with the sums of its seatings, and what all shards know."""

    shards: DataFrame
    levels: Levels
    n_shards: int
    settings: Settings = field(default_factory=Settings)


def learn(docs: DataFrame, train: Column | None = None, settings: Settings = Settings()) -> Model:
    """The model of the training texts (those of which ``train`` holds), whole, with all their words and pairs of words.

    Each word, and the end of a text as the start of the next, is a context with a restaurant of its own; their common
    parent is the restaurant of all words, above which all words are alike. A word's customers in all restaurants are
    in one shard, so its parent chances are at hand. The totals of a restaurant are summed in the shard of its context
    before each sweep and sent to the shards that ask for it. A sweep seats the customers of each word again, from the
    contexts upwards, given the totals before. Discounts are n1 / (n1 + 2 n2) of the first seating of each level.
    The same input gives the same model.
    """
    with short_shuffles(docs.sparkSession):
        return _learnt(docs, lm.in_training() if train is None else train, settings)


def _learnt(docs: DataFrame, train: Column, settings: Settings) -> Model:
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // settings.shard_bytes))
    chunks = max(1, -(-size // settings.chunk_bytes))
    entries = lm._prepared(docs, train).mapInArrow(tidy(_counts(settings, shards)), _ENTRIES)
    while chunks > settings.fan_in:
        # Of a word that each chunk has, no task sees more than so many chunks at once.
        chunks = -(-chunks // settings.fan_in)
        group = F.pmod(F.xxhash64("chunk"), F.lit(chunks)).alias("chunk")
        entries = entries.withColumn("chunk", group).groupBy("shard", "chunk").applyInArrow(_merge, _ENTRIES)
    path = new_work_dir(spark, "lm-state")
    entries = entries.withColumn("chunk", F.lit(0).cast("long"))
    state = settle_at(entries.groupBy("shard", "chunk").applyInArrow(_begin(shards), _STATE), path)
    found = state.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _FOUND)).first()
    few = (found["one0"], found["two0"]), (found["one1"], found["two1"])
    discounts = tuple(min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5 for n1, n2 in few)

    def met(state: DataFrame, run, columns: tuple, schema: str, own: bool = False) -> DataFrame:
        """Each shard with the totals of its contexts. The state is written, then the one before it, which nothing reads any
        more, is removed."""
        nonlocal path
        asks = state.where("to is not null").select("shard", "to", *_ASKS)
        answers = asks.groupBy("to").applyInArrow(_answers(own), _ANSWERS)
        rows = state.where("to is null").select("shard", "load", *_BLOBS, *columns).groupBy("shard")
        old, path = path, new_work_dir(spark, "lm-state")
        out = settle_at(rows.cogroup(answers.groupBy("shard")).applyInArrow(_whole(run, schema), schema), path)
        remove(spark, old)
        return out

    def levels(state: DataFrame, times: int = 1) -> Levels:
        seats = state.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in _SEATS)).first()
        return Levels(found["n_words"], found["n_tokens"], discounts, settings.strengths, seats[0] / times, seats[1] / times)

    for sweep in range(settings.burn_in + settings.samples):
        state = met(state, _sweep(levels(state), settings, shards, sweep), _SEATINGS, _STATE)
    averaged = levels(state, settings.samples)
    return Model(met(state, _trained, _SEATINGS[2:], _TRAINED, own=True), averaged, shards, settings)


def _whole(run, schema: str):
    """A shard that has no words may get answers of none."""
    columns = [c.split() for c in schema.split(", ")]

    def cell(state: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(state):
            return pa.table({n: pa.array([], pa.int64() if k == "long" else pa.binary()) for n, k in columns})
        return run(state, answers)

    return cell


class Scorer:
    """Logarithms of chances of tokens whose words are in one shard."""

    def __init__(self, row: dict | None, levels: Levels, samples: int):
        self.levels = levels
        row = row or dict.fromkeys((*_BLOBS, "zero_sum", "one_sum", "customers", "tables", "own_tables"), pack(np.zeros(0, np.int64)))
        self.shard = shard = Shard(row)
        zero, one, tables, own_tables = (unpack(row[n]) / samples for n in ("zero_sum", "one_sum", "tables", "own_tables"))
        customers = unpack(row["customers"])
        by_all = levels.by_all(shard, zero, one)
        self.by_all = np.append(np.log10(by_all), np.log10(levels.unseen))
        self.counts = np.append(np.bincount(shard.word, shard.counts, len(shard.words)), 0)
        # What its own customers in a restaurant add to the chance that a word has there from the parent.
        own = (shard.counts - levels.discounts[1] * one) / (levels.strengths[1] + customers)[shard.at]
        self.more = np.append(np.log10(1 + own / (levels.rest(customers, tables)[shard.at] * by_all[shard.word])), 0)
        self.keys = shard.at << 32 | shard.word
        # Each token of training is the context of one, so its words are its contexts, with as many customers.
        self.own_contexts, at = np.unique(names(shard.words), return_inverse=True)
        own_customers = np.bincount(at, self.counts[:-1], len(self.own_contexts))
        self.own_rest = np.append(np.log10(levels.rest(own_customers, own_tables)), 0)

    @staticmethod
    def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The place of each, or -1."""
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = -1
        return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)

    word_numbers = lm.Scorer.word_numbers

    def __call__(self, words: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of each entry, a context and the number of a word: log10 of the word's chance by the model, but for the share that
        its context leaves to the parent and with the share that it leaves as a context itself; by counts plus one; is it known.
        Each token of a text is the context of one, if the end is that of the first: so the sums over a text are right."""
        number = self.word_numbers(words)
        counts = self.counts[number]
        alone = self.by_all[number] + self.own_rest[self._place(self.own_contexts, names(words))]
        base = np.log10((counts + 1) / (self.levels.train_tokens + self.levels.words + 1))
        values = np.stack([alone, base, counts > 0], axis=1)[word]
        place = self._place(self.shard.contexts, context)
        entry = self._place(self.keys, np.maximum(place, 0) << 32 | np.maximum(number[word], 0))
        values[:, 0] += self.more[np.where((place >= 0) & (number[word] >= 0), entry, -1)]
        return values


_ASKED = (*_PAIRS, "times", "docs")


def _probe_rows(settings: Settings, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk a row of its texts, and one for each shard: words, their contexts, and the texts of each."""
        for chunk, texts, ids, held in lm._chunked(batches, settings):
            words, word, before, owner = numbered(texts)
            own = np.bincount(owner, minlength=len(texts))
            # The longest texts have the lowest numbers, so most tokens have low ones, which take less room.
            longest = np.argsort(-own, kind="stable")
            ids, held, own, owner = ids.take(pa.array(longest)), held[longest], own[longest], np.argsort(longest)[owner]
            at = shard_of(words[:, 0], shards)
            order = _by_shard(at, before, word)
            keys, docs = before[order] << 32 | word[order], owner[order].astype(np.uint16)
            starts = _starts(keys)
            entries, times = keys[starts], np.diff(np.append(starts, len(keys)))
            before, word = entries >> 32, entries & _LOW
            contexts, bounds = names(words), np.arange(shards + 1)
            at_word, at_entry = np.searchsorted(at, bounds), np.searchsorted(at[word], bounds)
            at_token = np.append(starts, len(keys))[at_entry]
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            head = [pa.array([chunk]), pa.array([int(mixed(np.array([chunk], np.uint64))[0] % np.uint64(shards))])]
            lists = [whole(ids), whole(pa.array(held)), whole(pa.array(own))]
            yield pa.RecordBatch.from_arrays([*head, *[pa.nulls(1, pa.binary())] * len(_ASKED), *lists], _PROBES)
            for s in np.flatnonzero(np.diff(at_word)).tolist():
                part = slice(at_entry[s], at_entry[s + 1])
                runs = _starts(before[part])
                parts = (
                    words[at_word[s] : at_word[s + 1]], contexts[before[part][runs]], np.diff(np.append(runs, part.stop - part.start)),
                    word[part] - at_word[s],
                )
                packed = *_packed(*parts).values(), pack(times[part]), pack(docs[at_token[s] : at_token[s + 1]])
                blobs = [pa.array([p], pa.binary()) for p in packed]
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([s]), *blobs, *(pa.nulls(1, x.type) for x in lists)], _PROBES)

    return run


_PROBES = ["chunk", "shard", *_ASKED, "ids", "held_out", "n_tokens"]


def _probe(levels: Levels, samples: int):
    def run(probes: pa.Table, shard: pa.Table) -> pa.Table:
        """For each chunk what its texts get from the words of this shard; rows of texts pass."""
        scorer = Scorer(shard.to_pylist()[0] if len(shard) else None, levels, samples)
        kinds = [probes.schema.field(n).type for n in ("ids", "held_out", "n_tokens")]
        out = []
        for batch in probes.to_batches(max_chunksize=64):
            for i, row in enumerate(batch.select(["chunk", *_ASKED]).to_pylist()):
                if row["docs"] is None:
                    keep = batch.slice(i, 1)
                    out.append(pa.table([keep["chunk"], *[pa.nulls(1, pa.binary())] * 2, keep["ids"], keep["held_out"], keep["n_tokens"]], lm._SUMS))
                    continue
                words, contexts, sizes, word = _unpacked(row)
                values = np.repeat(scorer(words, np.repeat(contexts, sizes), word), unpack(row["times"]), axis=0)
                sums = lm._summed(unpack(row["docs"]), values)
                out.append(pa.table([pa.array([row["chunk"]]), *(pa.array([b], pa.binary()) for b in sums), *(pa.nulls(1, k) for k in kinds)], lm._SUMS))
        give_back()
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, model: Model, train: Column | None = None) -> DataFrame:
    """A row for each text, as of ``lm.score``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity.

    An unknown word has the chance of the one word beyond the vocabulary, and leaves all to the parent as a context.
    The texts are read once for each part, so a source whose rows change between reads is to be written first. The scores are
    written to the shared folder.
    """
    settings, levels = model.settings, model.levels
    spark = docs.sparkSession
    train = lm.in_training() if train is None else train
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = f"ids array<{kind}>, held_out array<boolean>, n_tokens array<long>"
    asked = ", ".join(f"{n} binary" for n in _ASKED)
    copies = F.greatest(F.lit(1), F.ceil(F.col("load") / settings.cell_tokens)).cast("int")
    # One small row for each shard, written so that its size is known to the optimizer.
    known = settle(model.shards.select("shard", copies.alias("copies")), "lm-copies")
    shards = model.shards.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))

    def scored(texts: DataFrame) -> DataFrame:
        probes = texts.mapInArrow(tidy(_probe_rows(settings, model.n_shards)), f"chunk long, shard long, {asked}, {lists}").join(known, "shard", "left")
        probes = probes.withColumn("copy", F.pmod(F.xxhash64("chunk"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
        sums = probes.groupBy("shard", "copy").cogroup(shards.groupBy("shard", "copy")).applyInArrow(
            lm._cell(_probe(levels, settings.samples)), f"chunk long, docs binary, sums binary, {lists}"
        )
        return sums.groupBy("chunk").applyInArrow(
            lm._gather, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        )

    texts, paths = lm._prepared(docs, train), []
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(settings.parts))
    with short_shuffles(spark):
        for i in range(settings.parts):
            paths.append(new_work_dir(spark, "lm-scores"))
            out = settle_at(scored(texts.where(part == i)), paths[-1])
    out = spark.read.schema(out.schema).parquet(*paths)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(levels.train_tokens).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity")
    )
