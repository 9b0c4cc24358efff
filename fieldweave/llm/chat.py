"""Chat formatting: conversations become one text each, with the spans that count for the loss."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Strings that mean something to chat templates and must not come out of a text as such. Fixed values.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_RESTS = "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
_ESCAPE = rf"([<\[])(\\*)({_RESTS})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_RESTS})")


@dataclass(frozen=True)
class Template:
    """A turn is ``start role newline text end newline``; texts of the loss roles are learned."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: A chunk of conversations is assembled in one buffer of about so many bytes; a longer conversation has its own.
    chunk_bytes: int = 32 << 20


def escape(texts: pa.Array) -> pa.Array:
    """A backslash goes behind the first character of each control string, and one more where such a string
    already has some; so no control string is left and ``unescape`` gives the text back."""
    return pc.replace_substring_regex(texts, pattern=_ESCAPE, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def escape_role(roles: pa.Array) -> pa.Array:
    """Roles stand on one line, so line ends (and the backslash that marks them) are written as two characters."""
    roles = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    return escape(roles)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the bounds of its values."""
    strings = strings.cast(pa.large_string())
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = strings.buffers()
    bounds = np.frombuffer(bounds, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> None:
    """Copy value i of data to out[at[i]:]."""
    if len(data):
        out[np.repeat(at - bounds[:-1], np.diff(bounds)) + np.arange(len(data))] = data


def assemble(ids: pa.Array, roles: pa.Array, texts: pa.Array, first: np.ndarray, template: Template) -> pa.RecordBatch:
    """Conversations in order of their turns, the turn numbers in ``first`` beginning one each."""
    head, head_at = _bytes(pc.binary_join_element_wise(pa.scalar(template.start), escape_role(roles), pa.scalar("\n"), pa.scalar("")))
    body, body_at = _bytes(escape(texts))
    tail = np.frombuffer(f"{template.end}\n".encode(), np.uint8)
    lengths = np.stack([np.diff(head_at), np.diff(body_at), np.full(len(ids), len(tail))], axis=1)
    bounds = np.concatenate([[0], np.cumsum(lengths.ravel())])
    starts = bounds[:-1].reshape(-1, 3)
    out = np.empty(bounds[-1], np.uint8)
    _scatter(out, starts[:, 0], head, head_at)
    _scatter(out, starts[:, 1], body, body_at)
    out[starts[:, 2][:, None] + np.arange(len(tail))] = tail
    # Code points before each byte: all bytes but those that continue one.
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    conv_at = starts[first, 0]
    loss = np.flatnonzero(pc.is_in(roles, pa.array(template.loss_roles, roles.type)).to_numpy(zero_copy_only=False))
    owner = np.searchsorted(first, loss, side="right") - 1
    loss_start = points[starts[loss, 1]] - points[conv_at[owner]]
    loss_length = points[starts[loss, 2]] - points[starts[loss, 1]]
    ends = np.concatenate([conv_at, [bounds[-1]]])
    per_conv = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(first)))]).astype(np.int32)
    if bounds[-1] >= 2**31:
        raise ValueError("a conversation of 2 GiB or more can't be one text")
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(first)),
            formatted,
            pa.ListArray.from_arrays(per_conv, pa.array(loss_start, pa.int64())),
            pa.ListArray.from_arrays(per_conv, pa.array(loss_length, pa.int64())),
            pa.array(np.diff(np.concatenate([first, [len(ids)]])), pa.int64()),
        ],
        ["conv_id", "formatted", "loss_starts", "loss_lengths", "n_turns"],
    )


def _firsts(ids: pa.Array) -> np.ndarray:
    """Where the id differs from the one before; null is an id."""
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])


def _formatter(template: Template):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def emit(rows: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
            size = pc.add(pc.binary_length(rows["text"]), pc.binary_length(rows["role"])).to_numpy() + 64
            after = np.concatenate([[0], np.cumsum(size)])
            at = 0
            while at < len(first):
                end = max(at + 1, int(np.searchsorted(after[first], after[first[at]] + template.chunk_bytes)))
                stop = first[end] if end < len(first) else len(rows)
                part = rows.slice(first[at], stop - first[at]).combine_chunks()
                columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in part.columns]
                yield assemble(*columns, first[at:end] - first[at], template)
                at = end

        for batch in batches:
            if not len(batch):
                continue
            rows = pa.table(
                [batch["conv_id"], pc.fill_null(batch["role"], ""), pc.fill_null(batch["text"], "")], ["conv_id", "role", "text"]
            )
            if held is not None:
                rows = pa.concat_tables([held, rows])
            first = _firsts(rows["conv_id"].combine_chunks() if rows["conv_id"].num_chunks == 1 else pa.concat_arrays(rows["conv_id"].chunks))
            if len(first) > 1:
                yield from emit(rows.slice(0, first[-1]), first[:-1])
            held = rows.slice(first[-1])
        if held is not None:
            yield from emit(held, np.zeros(1, np.int64))

    return run


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_starts and loss_lengths (spans in code points), n_turns.

    Turns are in order of ``turn`` (null first), then role and text; repeated rows are turns of their own. Null texts
    and roles are empty; the null conv_id is one conversation; no rows give no rows. Other columns are not read. A
    conversation is one output value, so its turns meet in one task; all else is split by conversation.
    """
    kind = conversations.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss_starts", T.ArrayType(T.LongType())),
            T.StructField("loss_lengths", T.ArrayType(T.LongType())),
            T.StructField("n_turns", T.LongType()),
        ]
    )
    turns = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(_formatter(template), schema)


def read_turns(formatted: str, template: Template = Template()) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for piece in formatted.split(f"{template.end}\n")[:-1]:
        role, text = piece.removeprefix(template.start).split("\n", 1)
        turns.append((unescape_role(role), unescape(text)))
    return turns


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Lengths and hashes of what is read back from the formatted texts and spans."""
    import hashlib

    schema = T.StructType(
        [formatted.schema["conv_id"]]
        + [T.StructField(n, T.LongType() if n.startswith("n_") or n.endswith("chars") else T.StringType()) for n in _DIGESTS]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts, lengths in zip(*(batch[n].to_pylist() for n in ("formatted", "loss_starts", "loss_lengths"))):
                turns = read_turns(text, template)
                learned = "".join(unescape(text[s : s + n]) for s, n in zip(starts, lengths))
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append(
                    (
                        len(turns),
                        hashlib.sha256(whole.encode()).hexdigest(),
                        len(learned),
                        hashlib.sha256(learned.encode()).hexdigest(),
                        len(text),
                    )
                )
            columns = [pa.array(c, pa.string() if isinstance(c[0], str) else pa.int64()) for c in zip(*out)] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays([batch["conv_id"], *columns], ["conv_id", *_DIGESTS])

    return formatted.mapInArrow(run, schema)


_DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

#: The two turns that say control strings.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    probe = conversations.sparkSession.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


_SQL_RESTS = _RESTS.replace("'", "''")
CHAT_SQL = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select {PROBE_ID}, 0, 'user', '{PROBE_TEXT}' union all select {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}'
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum({len("<|im_start|>") + 1 + len("<|im_end|>") + 1} + length(role) + length(regexp_replace(text, '{_ESCAPE}', '\1\\\2\3', 'g')))::bigint as formatted_chars
from turns group by conv_id
"""
