"""Line dedup: lines that many documents share go, found in a sharded minimal perfect hash index."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import SPACE, fresh, tidy
from fieldweave.session import settle

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Settings:
    #: Keys of so many code points, in so many documents, lose their lines.
    min_chars: int = 1
    min_docs: int = 10
    #: Keys of one shard of the index, and probes of one cell (a shard, or a copy of a hot one), on average at most.
    shard_keys: int = 8_192
    cell_probes: int = 4_000


def line_key(line: str) -> str:
    line = line.strip(SPACE)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def _hash(key: str) -> bytes:
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """Another 64 bits of a key's 128 for each level."""
    x = h1 ^ (h2 * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level * 0xD1B54A32D192ED03 + 1) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by levels: a key that is alone at its place of a level stays there, the others go on to
    the next. Its index is the number of taken places before its own."""

    def __init__(self, sizes: np.ndarray, taken: np.ndarray):
        self.sizes, self.taken = sizes, taken
        self.before = np.concatenate([[0], np.cumsum(taken)])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        """Keys must differ in their 128 bits."""
        sizes, taken = [], []
        while len(h1):
            size = max(2, int(1.5 * len(h1)))
            place = (_mixed(h1, h2, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            left = ~alone[place]
            h1, h2 = h1[left], h2[left]
        return cls(np.array(sizes, np.int64), np.concatenate(taken) if taken else np.zeros(0, bool))

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Of each key; any number or -1 for keys that weren't built in."""
        out, open_ = np.full(len(h1), -1), np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            place = (_mixed(h1[open_], h2[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            here = self.taken[place]
            out[open_[here]] = self.before[place[here]]
            open_ = open_[~here]
        return out


_INDEX = "shard long, sizes binary, taken binary, fingerprints binary, counts binary"


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (rows[n].to_numpy(np.int64).view(np.uint64) for n in ("h1", "h2"))
    index = PerfectHash.build(h1, h2)
    at = index.index(h1, h2)
    fingerprints, counts = np.empty(len(at), np.uint64), np.empty(len(at), np.int64)
    fingerprints[at], counts[at] = h2, rows["n"]
    parts = index.sizes.tobytes(), np.packbits(index.taken).tobytes(), fingerprints.tobytes(), counts.tobytes()
    return pd.DataFrame([(key[0], *parts)], columns=["shard", "sizes", "taken", "fingerprints", "counts"])


def _probe(min_docs: int):
    def run(probes: pa.Table, index: pa.Table) -> pa.Table:
        """Probes whose key is in the index with count enough. A foreign key falls on any place, where its 64-bit
        fingerprint differs."""
        h1, h2 = (probes[n].to_numpy().view(np.uint64) for n in ("h1", "h2"))
        good = np.zeros(len(probes), bool)
        if len(index) and len(probes):
            row = {n: index[n][0].as_py() for n in ("sizes", "taken", "fingerprints", "counts")}
            sizes = np.frombuffer(row["sizes"], np.int64)
            taken = np.unpackbits(np.frombuffer(row["taken"], np.uint8), count=int(sizes.sum())).astype(bool)
            at = PerfectHash(sizes, taken).index(h1, h2)
            prints, counts = np.frombuffer(row["fingerprints"], np.uint64), np.frombuffer(row["counts"], np.int64)
            good = (at >= 0) & (prints[at] == h2) & (counts[at] >= min_docs)
        found = probes.filter(pa.array(good))
        keys = np.stack([found[n].to_numpy() for n in ("h1", "h2")], axis=1).tobytes()
        return pa.table([found["k1"], found["k2"], pa.array([keys[i : i + 16] for i in range(0, len(keys), 16)], pa.binary())], ["k1", "k2", "key"])

    return run


def _marks(min_chars: int):
    """A row for each different key of a document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch[n].to_numpy() for n in ("k1", "k2"))
            held, owners = [], []

            def out() -> pa.RecordBatch:
                hashes = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
                own = np.array(owners, np.int64)
                return pa.RecordBatch.from_arrays([pa.array(a) for a in (k1[own], k2[own], hashes[:, 0], hashes[:, 1])], ["k1", "k2", "h1", "h2"])

            for i, text in enumerate(batch["text"]):
                keys = {line_key(x) for x in text.as_py().split("\n")}
                held += [_hash(k) for k in keys if len(k) >= min_chars]
                owners += [i] * (len(held) - len(owners))
                if len(held) > 100_000:
                    yield out()
                    held, owners = [], []
            if held:
                yield out()

    return run


def build_index(marks: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(index, load): a row of arrays for each shard, and the number of probes and copies of each.

    Of all distinct line hashes, those of two documents or more are indexed. A shard with more probes than
    ``cell_probes``, as one with a very frequent line, gets copies so that each has its share of the probes.
    """
    counts = marks.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    counts = settle(counts, "line-counts")
    size = counts.agg(F.count(F.when(F.col("n") > 1, 1)).alias("repeated"), F.count(F.when(F.col("n") == 1, 1)).alias("single")).first()
    probes = marks.count()
    shards = max(1, math.ceil(size["repeated"] / settings.shard_keys), math.ceil(probes / (8 * settings.cell_probes)))
    repeated = counts.where("n > 1").withColumn("shard", F.pmod("h1", F.lit(shards)))
    index = settle(repeated.groupBy("shard").applyInPandas(_build, _INDEX), "line-index")
    load = repeated.groupBy("shard").agg((F.sum("n") + size["single"] / shards).alias("probes"))
    return index, load.select("shard", F.ceil(F.col("probes") / settings.cell_probes).cast("int").alias("copies"), F.lit(shards).alias("shards"))


def shared_keys(marks: DataFrame, settings: Settings) -> DataFrame:
    """The marks whose key is in ``min_docs`` documents at least."""
    index, load = build_index(marks, settings)
    load = settle(load, "line-load")
    shards = load.agg(F.max("shards")).first()[0] or 1
    probes = marks.withColumn("shard", F.pmod("h1", F.lit(shards))).join(load.select("shard", "copies"), "shard")
    probes = probes.withColumn("copy", F.pmod(F.col("k2"), F.col("copies")).cast("int")).drop("copies")
    copies = index.join(load.select("shard", "copies"), "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    pairs = probes.groupBy("shard", "copy").cogroup(copies.drop("copies").groupBy("shard", "copy"))
    return pairs.applyInArrow(_probe(settings.min_docs), "k1 long, k2 long, key binary")


def _kept(min_chars: int):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            kept, counts = [], []
            for text, drop in zip(texts, drops):
                lines = text.split("\n")
                left = lines
                if drop is not None and len(drop):
                    gone = {bytes(d) for d in drop}
                    left = [x for x in lines if len(k := line_key(x)) < min_chars or _hash(k) not in gone]
                kept.append("\n".join(left))
                counts.append((len(lines), len(lines) - len(left)))
            numbers = np.array(counts, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"kept_text": pd.Series(kept, dtype=object), "n_lines": numbers[:, 0], "n_dropped": numbers[:, 1]})

    return run


def drop_shared_lines(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """All rows and columns of the documents with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, in ASCII lower case. Null and empty texts are one
    empty line, whose empty key is too short to be shared. Each row is a document, also if it is repeated. A document
    that loses all lines has an empty text. Input columns with the names of the new ones are replaced.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    k1, k2, drops, whole = fresh(docs, "k1", "k2", "drops", "whole")
    columns = docs.columns
    # A row's key: rows with the same key have the same text, and so lose the same lines.
    rows = docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    first = F.col("doc_id") if "doc_id" in columns else F.lit(0)
    rows = rows.withColumn(k1, F.xxhash64(first, whole)).withColumn(k2, F.xxhash64(F.lit("row"), whole, first))
    marked = rows.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(whole).alias("text"))
    marks = settle(marked.mapInArrow(tidy(_marks(settings.min_chars)), "k1 long, k2 long, h1 long, h2 long"), "line-marks")
    shared = shared_keys(marks, settings)
    hits = shared.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.collect_set("key").alias(drops))
    rows = rows.join(hits, [k1, k2], "left")
    kept = F.pandas_udf(tidy(_kept(settings.min_chars)), "kept_text string, n_lines long, n_dropped long")
    return rows.withColumn(drops, kept(F.col(whole), F.col(drops))).select(*columns, f"{drops}.*")


LINES_SQL = """
with lines as (
    select doc_id, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as n,
        unnest(string_split(coalesce(text, ''), chr(10))) as line
    from documents
),
keyed as (
    select *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
),
shared as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, count(s.key)::bigint as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by n) filter (s.key is null), '')) as kept_sha256
from keyed left join shared s using (key) group by doc_id
"""
