"""Conversation structure repair: cheapest edits by parallel Viterbi over chunks of turns, joined by rank convergence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave.llm.common import fresh
from fieldweave.session import settle

#: What a row can be: the initial of its role, and its first fault.
INITIALS, OTHER = "sua", 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Edits in the order of their initials in ASCII.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"
#: Where a conversation stands: nothing yet, after system, after user, after assistant. It may end at the first and last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next user or assistant turn leads.
AHEAD = np.array([USER, USER, ASSISTANT, USER])
#: Costs. Fixed values.
COST_DELETE, COST_INSERT, COST_REROLE, COST_TRUNCATED = 3, 2, 2, 1
FAR = 1 << 40
#: Cheapest cost of ending where a conversation stands, by inserts alone.
END = np.array([0, 4, 2, 0], np.int64)


@dataclass(frozen=True)
class Settings:
    #: Rows of a chunk at most; a power of two.
    chunk_rows: int = 4_096
    #: Rows of the chunks that a task holds at once.
    batch_rows: int = 200_000


def code(symbol: int, fault: int) -> int:
    return symbol * 4 + fault


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """For each kind of row, where one stands and edit: where it leads (-1: not allowed) and what it costs."""
    leads = np.full((16, 4, 4), -1)
    costs = np.full((16, 4, 4), FAR)
    for symbol in range(4):
        for fault in range(4):
            at, extra = code(symbol, fault), COST_TRUNCATED * (fault == TRUNCATED)
            for state in range(4):
                leads[at, state, DELETE], costs[at, state, DELETE] = state, COST_DELETE
                if fault in (BLANK, DUPLICATE):
                    continue
                leads[at, state, REROLE], costs[at, state, REROLE] = AHEAD[state], COST_REROLE + extra
                kept = {0: SYSTEM if state == EMPTY else -1, 1: USER if state != USER else -1, 2: ASSISTANT if state == USER else -1}.get(symbol, -1)
                if kept >= 0:
                    leads[at, state, KEEP], costs[at, state, KEEP] = kept, extra
    return leads, costs


LEADS, COSTS = _steps()


def _shortest(direct: dict[tuple[int, int], int]) -> np.ndarray:
    out = np.full((4, 4), FAR)
    np.fill_diagonal(out, 0)
    for (a, b), cost in direct.items():
        out[a, b] = cost
    for k in range(4):
        out = np.minimum(out, out[:, k : k + 1] + out[k : k + 1])
    return np.minimum(out, FAR)


INSERTS = {(state, int(AHEAD[state])): COST_INSERT for state in range(4)}


def _matrices() -> np.ndarray:
    """For each kind of row the cheapest cost between any two places, inserts before the row included."""
    between = _shortest(INSERTS)
    out = np.full((16, 4, 4), FAR)
    for kind in range(16):
        for state in range(4):
            for edit in (DELETE, KEEP, REROLE):
                if (to := LEADS[kind, state, edit]) >= 0:
                    out[kind, :, to] = np.minimum(out[kind, :, to], between[:, state] + COSTS[kind, state, edit])
    return np.minimum(out, FAR)


MATRICES = _matrices()
#: How much dearer than one place another can be, whatever follows: inserts lead on; nothing yet allows all that the
#: others do, after assistant all that after system does, and what only nothing yet allows, keeping system, is made up for by a
#: delete. The columns are the cost vectors that chunks start from: any true vector is a minimum of them plus constants.
SPECULATIVE = _shortest(INSERTS | {(EMPTY, ASSISTANT): 0, (ASSISTANT, SYSTEM): 0, (ASSISTANT, EMPTY): COST_DELETE})


class Chunks:
    """Chunks of rows side by side, the longest first, worked on step by step."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        self.codes = codes
        self.longest = int(self.lengths.max(initial=0))
        self.open = np.searchsorted(-self.lengths, -np.arange(1, self.longest + 1), side="right")

    def rows(self, step: int) -> np.ndarray:
        """Places of the rows of that number from the front, of the chunks that have one."""
        return self.starts[: self.open[step]] + step

    def backward(self, ends: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Cost vectors at the chunks' fronts from those at their ends, one for each vector given; and those before each
        row if wanted. ends: (chunk, vector, place)."""
        vectors = ends[self.order].copy()
        before = np.empty((len(self.codes), 4), np.int64) if keep else None
        for back in range(self.longest):
            n = self.open[back]
            at = self.starts[:n] + self.lengths[:n] - 1 - back
            step = MATRICES[self.codes[at]]
            vectors[:n] = (step[:, None] + vectors[:n, :, None, :]).min(axis=3)
            if keep:
                before[at] = vectors[:n, 0]
        out = np.empty_like(vectors)
        out[self.order] = vectors
        return out, before

    def trace(self, before: np.ndarray, ends: np.ndarray, states: np.ndarray, write: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The edits of least audit from the places where the chunks begin: where they end, and for each row the number
        of inserts before it, its edit and the place before both."""
        state = states[self.order].copy()
        ends = ends[self.order]
        inserts, edits, stands = (np.zeros(len(self.codes) if write else 0, np.int64) for _ in range(3))
        for step in range(self.longest):
            at = self.rows(step)
            n = len(at)
            now, kind = state[:n].copy(), self.codes[at]
            after = np.where((self.lengths[:n] == step + 1)[:, None], ends[:n], before[np.minimum(at + 1, len(self.codes) - 1)])
            if write:
                stands[at] = now
            open_ = np.arange(n)
            while len(open_):
                s, k = now[open_], kind[open_]
                left = before[at[open_], s]
                # Delete, insert, keep, rerole: the first that is on a cheapest way is the least.
                good = np.zeros((len(open_), 4), bool)
                for edit in (DELETE, KEEP, REROLE):
                    to = LEADS[k, s, edit]
                    good[:, edit] = (to >= 0) & (COSTS[k, s, edit] + after[open_, np.maximum(to, 0)] == left)
                good[:, INSERT] = COST_INSERT + before[at[open_], AHEAD[s]] == left
                edit = good.argmax(axis=1)
                put = edit == INSERT
                if write:
                    inserts[at[open_[put]]] += 1
                    edits[at[open_[~put]]] = edit[~put]
                now[open_] = np.where(put, AHEAD[s], LEADS[k, s, edit])
                open_ = open_[put]
            state[:n] = now
        out = np.empty_like(state)
        out[self.order] = state
        return out, inserts, np.stack([edits, stands]) if write else edits


def is_rank_one(matrix: np.ndarray) -> np.ndarray:
    """Whether all start vectors (chunk, vector, place) of a chunk differ only by constants."""
    relative = matrix - matrix.min(axis=2, keepdims=True)
    return (relative == relative[:, :1]).all(axis=(1, 2))


def _lists(rows: pa.RecordBatch, settings: Settings) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    codes = rows["codes"]
    flat, offsets = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64), codes.offsets.to_numpy()
    offsets = offsets - offsets[0]
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + settings.batch_rows, side="right")) - 1)
        yield slice(at, to), flat[offsets[at] : offsets[to]], np.diff(offsets[at : to + 1])
        at = to


def _numbers(values: np.ndarray) -> pa.Array:
    """A list of numbers for each row of the array."""
    width = int(np.prod(values.shape[1:]))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), pa.array(values.reshape(-1), pa.int64()))


def _speculate(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, codes, lengths in _lists(batch, settings):
                rows = batch.slice(part.start, part.stop - part.start)
                final = ~rows["next"].is_valid().to_numpy(zero_copy_only=False)
                fronts, _ = Chunks(codes, lengths).backward(np.where(final[:, None, None], END, SPECULATIVE.T), keep=False)
                yield pa.RecordBatch.from_arrays([rows["chunk"], rows["next"], _numbers(fronts), pa.array(is_rank_one(fronts))], ["chunk", "next", "fronts", "done"])

    return run


def _square(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(-1, 4, 4)


def _extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks run again from the vectors of the chunks after them."""
    for batch in batches:
        own, other = _square(batch["fronts"]), _square(batch["other"])
        # own[v, place]: cost from place to end v; other likewise, so that end v of the own is a place of the other.
        fronts = (own[:, None, :, :] + other[:, :, :, None]).min(axis=2)
        fronts -= fronts.min(axis=(1, 2), keepdims=True)
        yield pa.RecordBatch.from_arrays([batch["chunk"], batch["onward"], _numbers(fronts), pa.array(is_rank_one(fronts))], ["chunk", "next", "fronts", "done"])


def _ends(rows: pa.RecordBatch, part: slice) -> np.ndarray:
    """Cost vectors at the chunks' ends up to a constant: those at the front of what follows, or of the end."""
    out = np.empty((part.stop - part.start, 4), np.int64)
    for i, vector in enumerate(rows["end"][part].to_pylist()):
        out[i] = END if vector is None else vector
    return out


def _maps(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where each chunk ends for each place where it may begin."""
        for batch in batches:
            for part, codes, lengths in _lists(batch, settings):
                chunks, ends = Chunks(codes, lengths), _ends(batch, part)
                _, before = chunks.backward(ends[:, None], keep=True)
                leads = np.stack([chunks.trace(before, ends, np.full(len(lengths), s), False)[0] for s in range(4)], axis=1)
                rows = batch.slice(part.start, len(lengths))
                yield pa.RecordBatch.from_arrays([rows["chunk"], _numbers(leads)], ["chunk", "leads"])

    return run


def _edit(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, codes, lengths in _lists(batch, settings):
                chunks, ends = Chunks(codes, lengths), _ends(batch, part)
                _, before = chunks.backward(ends[:, None], keep=True)
                state, inserts, (edits, stands) = chunks.trace(before, ends, batch["begin"][part].to_numpy(), True)
                # A chunk's last row has what is inserted after the last row of its conversation.
                last = np.cumsum(lengths) - 1
                trailing = np.zeros(len(codes), np.int64)
                final = ~batch["next"][part].is_valid().to_numpy(zero_copy_only=False)
                trailing[last[final]] = END[state[final]] // COST_INSERT
                rows = batch["rows"][part].flatten()
                names = ["row", "kind", "inserts", "edit", "stands", "trailing"]
                yield pa.RecordBatch.from_arrays([rows, *(pa.array(x.astype(np.int32)) for x in (codes, inserts, edits, stands, trailing))], names)

    return run


_WORD_SIGN = r"[^\x20\x09-\x0D]"


def ordered(turns: DataFrame) -> DataFrame:
    """The turns with their number ``row`` over all conversations: by conversation, turn (null first), role and text.
    Null roles and texts are one space. The order is made by range partitions, so a conversation may lie in many of
    them; rows alike in all columns are told apart by where they are read."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    by = ["conv_id", "turn", "role", "text", "tie"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    return settle(rows.withColumn("row", F.monotonically_increasing_id()), "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """(row, conv_id, fault, symbol). A duplicate is told by the first row of its conversation, role and text, which is
    reduced before it is shuffled; whether a row is that one is looked up by its number, so that neither a conversation
    nor a text is a hot key."""
    last = F.regexp_extract("text", rf"(?s)({_WORD_SIGN})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~F.col("text").rlike(_WORD_SIGN), BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    symbol = F.lit(OTHER)
    for i, initial in enumerate(INITIALS):
        symbol = F.when(F.col("role").startswith(initial), i).otherwise(symbol)
    pair = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("pair"), "text", "role").alias("h2")]
    first = rows.groupBy("conv_id", *pair).agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    known = rows.select("row", "conv_id", fault.alias("own"), symbol.alias("symbol")).join(first, "row", "left")
    fault = F.when((F.col("own") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("own"))
    return known.select("row", "conv_id", fault.alias("fault"), "symbol")


def chunked(known: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Chunks (conv_id, chunk, rows, codes) of at most ``chunk_rows`` rows of one conversation in order, named by their
    first row; and links (chunk, next) where a conversation goes on. Row numbers have no gaps within a partition, so a
    chunk that goes on does so at the next number, or at the first of the next partition."""
    shift = settings.chunk_rows.bit_length() - 1
    item = F.struct("row", (F.col("symbol") * 4 + F.col("fault")).cast("byte").alias("code"))
    grouped = known.groupBy("conv_id", F.shiftright("row", shift).alias("stretch")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    grouped = grouped.select("conv_id", F.col("items.row").alias("rows"), F.col("items.code").alias("codes"))
    ends = {"chunk": F.element_at("rows", 1), "last": F.element_at("rows", -1)}
    chunks = settle(grouped.withColumns(ends), "repair-chunks")
    # One row for each partition of the sort, however many rows there are.
    borders = chunks.groupBy(F.shiftright("chunk", 33).alias("part")).agg(F.max("last").alias("last"), F.min("chunk").alias("first"))
    borders = borders.select("last", F.lead("first").over(Window.orderBy("part")).alias("over")).where("over is not null")
    ahead = F.when((F.col("last") + 1) % settings.chunk_rows == 0, F.col("last") + 1)
    going = chunks.select("conv_id", "chunk", "last").join(borders, "last", "left").withColumn("next", F.coalesce("over", ahead))
    onto = chunks.select(F.col("chunk").alias("next"), F.col("conv_id").alias("other"))
    going = going.where("next is not null").join(onto, "next").where("conv_id <=> other")
    return chunks, settle(going.select("chunk", "next"), "repair-links")


def _begins_and_ends(chunks: DataFrame, links: DataFrame, settings: Settings) -> DataFrame:
    """(chunk, next, end, begin) of the chunks of conversations that have several: the cost vector at the chunk's end
    up to a constant (null at the end of the conversation), and the place where the chunk begins.

    Each chunk is first run from speculative vectors. Where these don't end in vectors that differ only by constants,
    passes run it on over what follows, twice as far each time, until they do or the conversation ends; so the number
    of passes is the logarithm of the number of chunks at most. Where the edits of a chunk end is traced for each place where it may
    begin; chunks that lead to different places are followed back in the same way.
    """
    ids = links.select("chunk").union(links.select("next")).distinct()
    long = settle(chunks.select("chunk", "codes").join(ids, "chunk").join(links, "chunk", "left"), "repair-long")
    fields = "chunk long, next long, fronts array<long>, done boolean"
    fronts = settle(long.mapInArrow(_speculate(settings), fields), "repair-fronts")
    while not fronts.where("not done").isEmpty():
        other = fronts.select(F.col("chunk").alias("next"), F.col("fronts").alias("other"), F.col("next").alias("onward"))
        again = fronts.where("not done").join(other, "next").select("chunk", "onward", "fronts", "other").mapInArrow(_extend, fields)
        fronts = settle(fronts.where("done").unionByName(again), "repair-fronts")
    ends = fronts.select(F.col("chunk").alias("next"), F.slice("fronts", 1, 4).alias("end"))
    long = settle(long.join(ends, "next", "left"), "repair-ends")

    maps = long.mapInArrow(_maps(settings), "chunk long, leads array<long>").withColumnRenamed("chunk", "previous")
    heads = links.select("chunk").join(links.select(F.col("next").alias("chunk")), "chunk", "left_anti")
    known = links.select(F.col("chunk").alias("previous"), F.col("next").alias("chunk")).join(maps, "previous")
    known = known.join(heads.select(F.col("chunk").alias("previous"), F.lit(True).alias("head")), "previous", "left")
    leads = F.when(F.col("head"), F.array_repeat(F.col("leads")[EMPTY], 4)).otherwise(F.col("leads"))
    done = F.size(F.array_distinct("leads")) == 1
    known = settle(known.select("chunk", "previous", leads.alias("leads")).withColumn("done", done), "repair-leads")
    while not known.where("not done").isEmpty():
        other = known.select(F.col("chunk").alias("previous"), F.col("leads").alias("other"), F.col("previous").alias("back"))
        again = known.where("not done").join(other, "previous")
        again = again.select("chunk", F.col("back").alias("previous"), F.expr("transform(other, x -> leads[int(x)])").alias("leads"))
        known = settle(known.where("done").unionByName(again.withColumn("done", done)), "repair-leads")
    return long.join(known.select("chunk", F.col("leads")[0].alias("begin")), "chunk", "left").select("chunk", "next", "end", "begin")


def edits(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The turns with their edits of least cost, of these the least audit: conv_id, turn, role, text, ``row`` (their
    order: by turn, null first, then role and text), ``fault``, ``symbol``, ``inserts`` (turns put in before), ``edit``
    (D, K or R), ``stands`` (the place before both) and ``trailing`` (turns put in after the last of a conversation).

    The roles of what is left are nothing, or user and assistant in turns with one system turn before them or none.
    Null roles and texts are one space; a role with another initial, or none, can't be kept. A null conv_id is a
    conversation. Rows alike in all columns are rows of their own, the later ones duplicates. A conversation of any
    length is cut into chunks, so none is held whole in a task.
    """
    rows = ordered(turns)
    chunks, links = chunked(settle(faults(rows), "repair-faults"), settings)
    around = _begins_and_ends(chunks, links, settings)
    placed = chunks.select("chunk", "rows", "codes").join(around, "chunk", "left").withColumn("begin", F.coalesce("begin", F.lit(EMPTY)))
    fields = "row long, kind int, inserts int, edit int, stands int, trailing int"
    found = placed.mapInArrow(_edit(settings), fields)
    letter = F.substring(F.lit(LETTERS), F.col("edit") + 1, 1)
    split = {"fault": F.col("kind") % 4, "symbol": F.floor(F.col("kind") / 4).cast("int"), "edit": letter}
    return settle(rows.join(found, "row").withColumns(split).drop("kind"), "repair-edits")


def _turn(role: Column, text: Column, edit: Column) -> Column:
    return F.struct(edit.alias("edit"), role.alias("role"), text.alias("text"))


def _result(edited: DataFrame) -> Column:
    """The turns that come of a row, in order: those put in before it, itself unless deleted, those put in after it."""
    empty, put_in = F.lit(""), F.lit("I")
    after_user = F.col("stands") == USER
    alternate = lambda n: F.when((n % 2 == 1) != after_user, F.lit("user")).otherwise(F.lit("assistant"))
    before = F.transform(F.sequence(F.lit(1), F.col("inserts") + 1), lambda n: _turn(alternate(n), empty, put_in))
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(alternate(F.col("inserts") + 1))
    own = F.when(F.col("edit") != "D", F.array(_turn(role, F.col("text"), F.col("edit"))))
    after = F.array(*(_turn(F.lit(r), empty, put_in) for r in ("user", "assistant")))
    none = F.array().cast(after_type := "array<struct<edit:string,role:string,text:string>>")
    return F.concat(F.slice(before, F.lit(1), F.col("inserts")).cast(after_type), F.coalesce(own.cast(after_type), none), F.slice(after.cast(after_type), F.lit(3) - F.col("trailing"), F.col("trailing")))


def repaired(edited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, row, place (order within the row), edit, role, text."""
    return edited.select("conv_id", "row", F.posexplode(_result(edited)).alias("place", "turn")).select("conv_id", "row", "place", "turn.*")


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations one after another, their rows in order: hashed and counted as they pass."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    held, out, kind = None, [], pa.int64()

    def finish() -> None:
        if held is not None:
            low, high, turns = held["turns"]
            out.append((held["conv_id"], high - low + 1 - turns if turns else 0, *held["faults"][1:], held["illegal"], held["cost"], "".join(held["audit"]), held["sha"].hexdigest()))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * len(names)
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for rows in batches:
        kind = rows.schema.field("conv_id").type
        for conv, turn, fault, symbol, edit, inserts, trailing, result in zip(*(rows[n].to_pylist() for n in ("conv_id", "turn", "fault", "symbol", "edit", "inserts", "trailing", "result"))):
            if held is None or held["conv_id"] != conv:
                finish()
                held = {"conv_id": conv, "turns": (None, None, 0), "faults": [0] * 4, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False, "symbol": None}
            low, high, n = held["turns"]
            if turn is not None and turn != high:
                held["turns"] = (turn if low is None else low, turn, n + 1)
            held["faults"][fault] += 1
            if held["symbol"] is not None and (held["symbol"], symbol) not in ((0, 1), (1, 2), (2, 1)):
                held["illegal"] += 1
            held["symbol"] = symbol
            held["cost"] += COST_INSERT * (inserts + trailing) + {"D": COST_DELETE, "K": 0, "R": COST_REROLE}[edit] + COST_TRUNCATED * (edit != "D" and fault == TRUNCATED)
            held["audit"].append("I" * inserts + edit + "I" * trailing)
            for made in result:
                held["sha"].update((f"\n{made}" if held["any"] else made).encode())
                held["any"] = True
        if len(out) >= 1000:
            yield batch()
            out.clear()
    finish()
    yield batch()


def report(edited: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each conv_id of ``conversations``: conv_id, gaps (turns missing between the first and the last), the
    numbers of faults (blank, duplicate, truncated), of neighbours whose roles may not follow each other (illegal), the
    cost and the audit of the edits, and the hash of the repaired turns.

    A hash is of all turns in order, so a conversation passes through one task, row by row; none is held whole."""
    kind = edited.schema["conv_id"].dataType.simpleString()
    lines = F.transform(_result(edited), lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    rows = edited.select("conv_id", "row", "turn", "fault", "symbol", "edit", "inserts", "trailing", lines.alias("result"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "row")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = rows.mapInArrow(_digest, f"conv_id {kind}, {', '.join(f'{n} long' for n in numbers)}, audit string, repaired_sha256 string")
    [own] = fresh(found, "own")
    ids = conversations.select(F.col("conv_id").alias(own)).distinct()
    joined = ids.join(found, ids[own].eqNullSafe(found["conv_id"]), "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return joined.select(
        F.col(own).alias("conv_id"),
        *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of ``conv_id:turn``: rows dropped, emptied, without sentence
    ends, repeated, or given to the user. Nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.where("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time"))
    return rows.drop("time")


REPAIR_SQL = r"""
with recursive raw as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
    from conversations
), harm as (
    select key, xor(list_reduce(
        list_prepend(4294967295::bigint, flatten([[ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(key, '')])),
        lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295) % 20 as h
    from (select distinct key from raw)
), damaged as (
    select conv_id, turn, case when h = 4 then 'user' else role end as role,
        case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when h = 3 then [1, 2] else [1] end) as time
    from raw join harm using (key) where h <> 0
), placed as (
    select dense_rank() over (order by conv_id nulls first) as c, conv_id, turn, role, text,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as i
    from damaged
), faulty as (
    select *, case
            when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1
            when row_number() over (partition by c, role, text order by i) > 1 then 2
            when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) in ('.', '!', '?') then 0
            else 3 end as fault,
        case left(role, 1) when 's' then 's' when 'u' then 'u' when 'a' then 'a' else '-' end as symbol,
        count(*) over (partition by c) as n
    from placed
), step(state, symbol, letter, cost, onward) as (
    select s.state, x.symbol, 'D', 3, s.state from (values ('0'), ('s'), ('u'), ('a')) s(state), (values ('s'), ('u'), ('a'), ('-')) x(symbol)
    union all
    select s.state, x.symbol, 'R', 2, case when s.state = 'u' then 'a' else 'u' end
    from (values ('0'), ('s'), ('u'), ('a')) s(state), (values ('s'), ('u'), ('a'), ('-')) x(symbol)
    union all
    select * from (values ('0', 's', 'K', 0, 's'), ('0', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('a', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'))
), put(state, letters, cost, onward) as (
    select * from (values ('0', '', 0, '0'), ('s', '', 0, 's'), ('u', '', 0, 'u'), ('a', '', 0, 'a'),
        ('0', 'I', 2, 'u'), ('s', 'I', 2, 'u'), ('u', 'I', 2, 'a'), ('a', 'I', 2, 'u'),
        ('0', 'II', 4, 'a'), ('s', 'II', 4, 'a'), ('u', 'II', 4, 'u'), ('a', 'II', 4, 'a'))
), move as (
    select put.state, step.symbol, put.letters || step.letter as letters, step.letter, put.cost + step.cost as cost, step.onward
    from put join step on step.state = put.onward
), way(c, i, state, best) as (
    select c, n + 1, state, ending from faulty, (values ('0', '000000000'), ('s', '000000004II'), ('u', '000000002I'), ('a', '000000000')) e(state, ending)
    where i = 1
    union all
    select f.c, f.i, m.state, min(lpad(cast(cast(left(w.best, 9) as bigint) + m.cost + case when f.fault = 3 and m.letter <> 'D' then 1 else 0 end as varchar), 9, '0')
        || m.letters || substr(w.best, 10))
    from way w join faulty f on f.c = w.c and f.i = w.i - 1
        join move m on m.onward = w.state and m.symbol = f.symbol and (m.letter = 'D' or f.fault not in (1, 2))
    group by f.c, f.i, m.state
), cheapest as (
    select c, cast(left(best, 9) as bigint) as cost, substr(best, 10) as audit from way where i = 1 and state = '0'
), letter as (
    select c, audit, unnest(range(1, length(audit) + 1)) as place, unnest(string_split(audit, '')) as edit from cheapest where audit <> ''
), traced as (
    select c, place, edit, sum(case when edit <> 'I' then 1 else 0 end) over (partition by c order by place) as i,
        sum(case when edit <> 'D' then 1 else 0 end) over (partition by c order by place) as k
    from letter
), made as (
    select t.c, t.place, t.edit, t.k - max(case when t.k = 1 and t.edit = 'K' and f.symbol = 's' then 1 else 0 end) over (partition by t.c) as k, f.role, f.text
    from traced t left join faulty f on f.c = t.c and f.i = t.i and t.edit <> 'I' where t.edit <> 'D'
), joined as (
    select c, string_agg(case when edit = 'K' then role when k % 2 = 1 then 'user' else 'assistant' end || ':'
        || case when edit = 'I' then '' else text end, chr(10) order by place) as repaired
    from made group by c
), neighbours as (
    select c, conv_id, turn, fault, lag(symbol) over (partition by c order by i) || symbol as pair from faulty
), counted as (
    select c, any_value(conv_id) as conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (where fault = 1) as blank, count(*) filter (where fault = 2) as duplicate,
        count(*) filter (where fault = 3) as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
    from neighbours group by c
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
    coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
    left join counted on counted.conv_id is not distinct from o.conv_id
    left join cheapest using (c) left join joined using (c)
"""
