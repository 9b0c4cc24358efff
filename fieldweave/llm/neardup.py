"""Near-dedup by ProbMinHash over weighted word shingles, with banding and verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldweave.llm.common import fresh, give_back, text_or_empty, tidy
from fieldweave.llm.graph import carried, components
from fieldweave.session import settle


@dataclass(frozen=True)
class Settings:
    shingle_words: int = 5
    similarity: float = 0.8
    #: Pairs of the least similarity share no band with a chance of (1 - 0.8 ** 7) ** 48, about 1 in 80,000; pairs of
    #: similarity 0.3 share one with a chance of 1 in 100.
    bands: int = 48
    band_values: int = 7
    #: Leaders of a bucket in the first rounds, and documents of a block in the last.
    leaders: tuple[int, ...] = (1, 2)
    block_rows: int = 256

    @property
    def values(self) -> int:
        return self.bands * self.band_values


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1) - 1, base, np.uint64))]).astype(np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each word's text. Words lie between ASCII white space."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    inside = (data != 32) & ((data < 9) | (data > 13))
    change = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = ends - starts
    at = np.flatnonzero(inside)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (data[at].astype(np.uint64) + np.uint64(1)) * _powers(np.uint64(0x100000001B3), int(lengths.max()))[offset]
    hashes = mixed(np.add.reduceat(values, np.cumsum(lengths) - lengths))
    return hashes, np.searchsorted(bounds, starts, side="right")


def weighted_shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight, content): the different shingles of each text in order, with the number of times they
    occur; and two hashes for each text's sequence of words. A text of fewer than n words is one shingle."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    starts = np.cumsum(counts) - counts
    rank = np.arange(len(words)) - starts[owner]
    content = np.zeros((len(texts), 2), np.uint64)
    some = counts > 0
    for k, base in enumerate((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
        if some.any():
            sums = np.add.reduceat(mixed(words, k + 1) * _powers(np.uint64(base), int(counts.max()))[rank], starts[some])
            content[some, k] = mixed(sums + counts[some].astype(np.uint64))
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    left = counts[owner] - rank
    sums = np.zeros(len(words), np.uint64)
    for k, power in enumerate(_powers(_ODD, n + 1)[1:]):
        sums += np.where(left > k, padded[k : k + len(words)] * power, np.uint64(0))
    whole = (left >= n) | (rank == 0)
    shingles, owner = mixed(sums[whole]), owner[whole]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    weights = np.diff(np.concatenate([first, [len(owner)]])).astype(np.float64)
    return owner[first], shingles[first], weights, content


def prob_min_hash(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, values: int) -> np.ndarray:
    """For each text, the elements that arrive first at each of its registers.

    Each element is a Poisson process with its weight as rate; each arrival goes to a register by hash. An element's
    arrivals are drawn until one is later than the latest first arrival of its text, as nothing after that can count;
    so most elements of long texts end with their first. Two texts agree in a register with the chance of their
    probability Jaccard similarity. Texts without elements have zeros.
    """
    first = np.full(texts * values, np.inf)
    winner = np.zeros(texts * values, np.uint64)
    time = np.zeros(len(elements))
    drawn, block = 0, 1
    while len(elements):
        for k in range(drawn, drawn + block):
            random = mixed(elements, 2 * k + 1)
            time = time - np.log((random >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weights
            place = owner * values + (mixed(elements, 2 * k + 2) % np.uint64(values)).astype(np.int64)
            sooner = time < first[place]
            near, when, who = place[sooner], time[sooner], elements[sooner]
            np.minimum.at(first, near, when)
            own = first[near] == when
            winner[near[own]] = who[own]
        drawn += block
        latest = first.reshape(texts, values).max(axis=1)
        open_ = time < latest[owner]
        owner, elements, weights, time = owner[open_], elements[open_], weights[open_], time[open_]
        block = 1 if len(elements) > 20_000 else 8
    return winner.reshape(texts, values)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets, each (elements in order, weights), exactly: the sum over
    common elements d of 1 / sum over all e of max(a_e / a_d, b_e / b_d)."""
    common, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][at_a], b[1][at_b]
    if (wa == wb).all() and (wa == wa[0]).all() and a[1].max() == b[1].max() == wa[0] and a[1].min() == b[1].min() == wa[0]:
        return len(common) / (len(a[0]) + len(b[0]) - len(common))
    # An element counts by a's weights if its ratio a : b is not below that of d, else by b's.
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    ratio = wa / wb
    below = np.searchsorted(ratio, ratio, side="left")
    sums_a, sums_b = np.concatenate([[0], np.cumsum(wa)]), np.concatenate([[0], np.cumsum(wb)])
    by_a = a[1].sum() - sums_a[below]
    by_b = b[1].sum() - wb.sum() + sums_b[below]
    return float((1 / (by_a / wa + by_b / wb)).sum())


#: Texts that are worked on at once: so many bytes at most, one text at least.
CHUNK_BYTES = 1_000_000


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > CHUNK_BYTES:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, texts[at:]


def _sign(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch["text"].cast(pa.binary()).to_pylist()):
                owner, shingles, weights, content = weighted_shingles(texts, settings.shingle_words)
                winners = prob_min_hash(owner, shingles, weights, len(texts), settings.values)
                keys = np.zeros((len(texts), settings.bands), np.uint64)
                for k in range(settings.band_values):
                    keys = mixed(keys + winners[:, k :: settings.band_values] * _ODD, k)
                keys = mixed(keys + np.arange(settings.bands, dtype=np.uint64))
                some = np.bincount(owner, minlength=len(texts)) > 0
                node = pa.array([c.tobytes() if s else None for c, s in zip(content, some)], pa.binary())
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(texts) + 1) * settings.bands, pa.int32()), pa.array(keys.view(np.int64).ravel())
                )
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part["k1"], part["k2"], part["doc_id"], node, bands], ["k1", "k2", "doc_id", "node", "bands"])

    return run


def _verify(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch["a_text"].cast(pa.binary()).to_pylist(), batch["b_text"].cast(pa.binary()).to_pylist()))
            good = np.zeros(len(pairs), bool)
            for at, left in _chunks([a + b for a, b in pairs]):
                texts = list(dict.fromkeys(t for pair in pairs[at : at + len(left)] for t in pair))
                owner, shingles, weights, _ = weighted_shingles(texts, settings.shingle_words)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                sets = {t: (shingles[i:j], weights[i:j]) for t, i, j in zip(texts, bounds[:-1], bounds[1:])}
                for k in range(at, at + len(left)):
                    a, b = pairs[k]
                    good[k] = similarity(sets[a], sets[b]) >= settings.similarity - 1e-12
            yield pa.RecordBatch.from_arrays([batch["ca"], batch["cb"], pa.array(good)], ["a", "b", "similar"])

    return run


def _root(parents: list[int], i: int) -> int:
    while parents[i] != i:
        parents[i] = i = parents[parents[i]]
    return i


def _block_links(settings: Settings):
    """Links between the two blocks of a group's pair of blocks, or within one: as many as connect what is linked."""

    def run(rows: pa.Table) -> pa.Table:
        texts, nodes = rows["text"].cast(pa.binary()).to_pylist(), rows["node"].to_pylist()
        block, low = rows["block"].to_numpy(), int(rows["low"][0].as_py())
        owner, shingles, weights, _ = weighted_shingles(texts, settings.shingle_words)
        part = weights / np.bincount(owner, weights, len(texts))[owner]
        names, at = np.unique(shingles, return_inverse=True)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        found, parents = [], list(range(len(texts)))
        share = np.zeros(len(names))
        alone = bool((block == low).all())
        for i in np.flatnonzero(block == low):
            own = slice(bounds[i], bounds[i + 1])
            share[at[own]] = part[own]
            # Two texts can't be more similar than their distributions overlap.
            overlap = np.bincount(owner, np.minimum(share[at], part), len(texts))
            share[at[own]] = 0
            for j in np.flatnonzero(overlap >= settings.similarity - 1e-9):
                if (j > i if alone else block[j] != low) and (a := _root(parents, i)) != (b := _root(parents, int(j))):
                    other = slice(bounds[j], bounds[j + 1])
                    if similarity((shingles[own], weights[own]), (shingles[other], weights[other])) >= settings.similarity - 1e-12:
                        found.append((nodes[i], nodes[j]))
                        parents[a] = b
        give_back()
        return pa.table([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return run


def _compared_in_blocks(members: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links between all nodes that share a bucket, directly or through others: such a group is dealt into blocks, and
    each pair of blocks is compared in a task of its own, which gives links only."""
    first = members.groupBy("band").agg(F.min("node").alias("first"))
    nodes = components(members.join(first, "band").select(F.col("first").alias("a"), F.col("node").alias("b")))
    sizes = nodes.groupBy("component").agg(F.ceil(F.count("*") / settings.block_rows).cast("int").alias("blocks"))
    rows = nodes.join(settle(sizes, "near-groups"), "component")
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
    rows = rows.join(texts, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "text")
    return settle(rows.groupBy("component", "low", "high").applyInArrow(_block_links(settings), "a binary, b binary"), "near-block-links")


def _keyed(docs: DataFrame, k1: str, k2: str) -> DataFrame:
    """A row's key: rows with the same key have the same id and text."""
    text = text_or_empty("text")
    return docs.withColumn(k1, F.xxhash64("doc_id", text)).withColumn(k2, F.xxhash64(F.lit("row"), text, "doc_id"))


def similar_labels(rows: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(node, component): the classes of the word sequences that are similar to others.

    rows: k1, k2, node, bands. texts: k1, k2, text. A bucket is the nodes that share a band. In each of a few rounds
    its leaders are compared with all its other nodes that are not in their class yet, and are then done; a bucket is
    done when all that is left of it is in one class. So a bucket of n nodes of one class costs n comparisons. What is
    left of the others is compared in blocks, all with all. So any two nodes of a bucket are compared, or known to be
    in one class. Members know their class so far, so that what a round finds are links between classes, and only these
    are joined anew.
    """
    first = rows.where("node is not null").groupBy("node").agg(F.min(F.struct("k1", "k2", "bands")).alias("first"))
    nodes = settle(first.select("node", "first.*"), "near-nodes")
    every = nodes.select("node", F.explode("bands").alias("band"))
    shared = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = settle(every.join(shared, "band").withColumn("component", F.col("node")), "near-members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "k1", "k2")
    # Of rows alike one is enough; they differ in nothing.
    texts = texts.join(wanted, ["k1", "k2"]).select("node", "text")
    texts = settle(texts, "near-texts")
    alone = texts.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    if not alone.isEmpty():
        texts = settle(texts.dropDuplicates(["node"]), "near-texts")
    labels = tested = None
    for leaders_wanted in settings.leaders:
        slot = F.pmod(F.xxhash64(F.lit(leaders_wanted), F.col("node")), F.lit(leaders_wanted))
        first = F.min(F.struct("node", "component")).alias("first")
        leaders = members.groupBy("band", slot.alias("slot")).agg(first).select("band", F.col("first.node").alias("leader"), F.col("first.component").alias("known"))
        leaders = settle(leaders, "near-leaders")
        pairs = members.join(leaders, "band").where("node <> leader and component <> known")
        own, other = F.struct("node", "component"), F.struct(F.col("leader").alias("node"), F.col("known").alias("component"))
        pairs = pairs.select(F.least(own, other).alias("x"), F.greatest(own, other).alias("y"))
        pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        tested = settle(pairs, "near-pairs")
        both = tested.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
        both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        judged = both.select("ca", "cb", "a_text", "b_text").mapInArrow(tidy(_verify(settings)), "a binary, b binary, similar boolean")
        found = components(judged.where("similar"))
        labels = carried(labels, found)
        members = members.join(leaders.select("band", F.col("leader").alias("node")), ["band", "node"], "left_anti")
        later = found.select(F.col("node").alias("component"), F.col("component").alias("later"))
        members = members.join(later, "component", "left").select("band", "node", F.coalesce("later", "component").alias("component"))
        spread = members.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        members = settle(members.join(spread.where("low <> high").select("band"), "band", "left_semi"), "near-members")
        if members.isEmpty():
            return labels
    found = _compared_in_blocks(members.select("band", "node"), texts, settings)
    known = settle(members.select("node", "component").distinct(), "near-known")
    at = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    return carried(labels, components(found.join(at("a"), "a").join(at("b"), "b"), "ca", "cb"))


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: k1, k2 (the row's key), doc_id, class_id, class_size, kept.

    Two documents are linked if the probability Jaccard similarity of their shingles, weighted by how often they occur,
    is ``similarity`` or more, and a class is what links connect. Documents with the same words in the same order are
    one node from the start, so that large groups of copies cost one comparison. The row with the smallest id (null
    last) of a class is kept and names it. Null, empty and blank texts have no shingles and are classes of their own.
    Texts are taken whole. Of rows alike in id and text one at most is kept. No rows give no rows.
    """
    keyed = _keyed(docs.select("doc_id", "text"), "k1", "k2").withColumn("text", text_or_empty("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = keyed.select("k1", "k2", "doc_id", "text").mapInArrow(tidy(_sign(settings)), f"k1 long, k2 long, doc_id {kind}, node binary, bands array<long>")
    rows = settle(signed, "near-rows")
    labels = similar_labels(rows.select("k1", "k2", "node", "bands"), keyed.select("k1", "k2", "text"), settings)
    alike = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("doc_id"))
    rows = rows.drop("bands").withColumn("alike", alike).join(labels, "node", "left")
    own = F.concat(F.lit("row"), F.hex("k1"), F.hex("k2"), F.lit("-"), F.col("alike").cast("string")).cast("binary")
    rows = settle(rows.withColumn("component", F.coalesce("component", "node", own)).drop("node"), "near-labelled")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "alike")
    best = settle(rows.groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("class_size")), "near-classes")
    joined = rows.join(best, "component")
    kept = (F.col("best.k1") == F.col("k1")) & (F.col("best.k2") == F.col("k2")) & (F.col("best.alike") == F.col("alike"))
    return joined.select("k1", "k2", "doc_id", F.col("best.doc_id").alias("class_id"), "class_size", kept.alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, with all their columns, of which one of each class stays."""
    k1, k2 = fresh(docs, "k1", "k2")
    found = classes(docs, settings).groupBy("k1", "k2").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    found = settle(found.where("kept").select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("n").alias("_alike")), "near-kept")
    rows = _keyed(docs, k1, k2).join(found, [k1, k2])
    rows = rows.where("_alike = 1").unionByName(rows.where("_alike > 1").dropDuplicates([k1, k2]))
    return rows.select(*docs.columns)
