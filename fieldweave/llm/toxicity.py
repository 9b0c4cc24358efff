"""Toxicity: a weighted lexicon learned from labels, matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import tidy
from fieldweave.session import settle

# Characters that look like Latin letters, and what they are read as. Fixed values.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "β": "b",
    "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a",
    "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}
# Digits and signs that stand for letters. Fixed values.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# Characters without a width. Fixed values.
_UNSEEN = "­​‌‍⁠﻿"


def _folds() -> dict[int, str | None]:
    wide = {chr(0xFF41 + i): chr(ord("a") + i) for i in range(26)} | {chr(0xFF10 + i): _DIGITS.get(str(i), str(i)) for i in range(10)}
    signs = {c: " " for c in map(chr, range(128)) if not c.isalnum()}
    return {ord(a): b for a, b in (signs | _LOOKALIKES | wide | _DIGITS).items()} | {ord(c): None for c in _UNSEEN}


_FOLDS = _folds()


_MARKS = re.compile("[\u0300-\u036f]+")
_SPELLED = re.compile(r"(?<![^\W_])(?:[^\W_][.*_-]){2,}[^\W_](?![^\W_])")


def fold(text: str) -> str:
    """Compatibility forms read as what they stand for and without accents, in lower case; letters with a sign between each
    two joined; look-alikes and digit substitutions read as letters, ASCII signs as spaces; a space before and after."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = _SPELLED.sub(lambda m: m[0][::2], text.lower())
    return f" {text.translate(_FOLDS)} "


@dataclass(frozen=True)
class Settings:
    #: Labelled rows that the lexicon and the scale are fitted on, at most; those with the lowest hash of their id.
    max_labelled: int = 10_000
    #: Lengths of the beginnings of words that can be entries. Words of any length can be entries whole.
    min_length: int = 3
    max_length: int = 8
    #: An entry is this much likelier in toxic documents (natural logarithm), at least.
    min_log_odds: float = 2.0


@dataclass(frozen=True)
class Lexicon:
    """Beginnings of words, and whole words (with a space at their end), with weights; phrases that are no matches, and the scale from matches to a score."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    scale: tuple[float, ...]  # intercept, then one factor for each value of ``features``

    def matcher(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            automaton.add_word(f" {term}", (len(term) + 1, weight))
        for phrase in self.exceptions:
            automaton.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        if len(automaton):
            automaton.make_automaton()
        return automaton

    def features(self, automaton, text: str) -> tuple[float, float, float]:
        """Is there a match; the weight of all matches; the same for the length in words."""
        if not len(automaton):
            return 0.0, 0.0, 0.0
        folded = fold(text)
        found = [(end - length + 1, end, weight) for end, (length, weight) in automaton.iter(folded)]
        if not found:
            return 0.0, 0.0, 0.0
        spared = [(start, end) for start, end, weight in found if not weight]
        if spared:  # a match is no match if it lies within an exception
            starts, ends = np.array(sorted(spared)).T
            ends = np.maximum.accumulate(ends)
            at = np.searchsorted(starts, [start for start, _, _ in found], side="right") - 1
            found = [f for f, i in zip(found, at) if f[2] and (i < 0 or ends[i] < f[1])]
        total = sum(weight for _, _, weight in found)
        words = max(1, len(folded.split()))
        return float(bool(found)), math.log1p(total), math.log1p(100 * total / words)


def features(frame: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The frame with a column ``features``, array of three."""
    @F.pandas_udf("array<double>")
    @tidy
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.matcher()
        for batch in batches:
            yield pd.Series([np.array(lexicon.features(automaton, t)) for t in batch], dtype=object)

    return frame.withColumn("features", match(F.coalesce(F.col(text), F.lit(""))))


def in_training(doc_id: str = "doc_id"):
    """Rows whose labels may be learned."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Texts with their labels: the training rows with the lowest hashes. An id with several labels has the highest;
    null ids and labels are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & in_training())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_labelled)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")


_WORD = re.compile(r"\S+")


def _count(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts):
            names = list({*counts[0], *counts[1]})
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)]
            return pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                terms = set()
                for word in set(_WORD.findall(fold(text))):
                    terms.add(f"{word} ")
                    terms.update(word[:n] for n in range(settings.min_length, min(settings.max_length, len(word)) + 1))
                terms.add("")  # the number of documents
                counts[toxic > 0].update(terms)
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield out(counts)
                    counts = (Counter(), Counter())
        yield out(counts)

    return run


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Lexicon:
    """The lexicon of what is significantly likelier in documents labelled toxic, and a logistic scale.

    Entries are beginnings of words, or whole words whose beginning does not do: for each, the documents of either label that have it are counted. In each round
    the strongest are chosen whose share of toxic documents can't be chance among so many candidates; the next round
    counts only the toxic documents in which nothing chosen is found, so what merely stands beside an entry, as in
    copies of one text, is not taken for one. Rounds go on while there is evidence: each chosen entry is found in a document
    that is left, so there are no more than toxic rows in the sample, and rounds, entries and exceptions have no other limit. Exceptions are whole words that begin like an entry but are not likelier
    in toxic documents. Without toxic or without clean rows the lexicon is empty and all scores are alike.
    """
    sample = settle(labelled(docs, labels, settings), "toxicity-sample")

    def counted(rows: DataFrame) -> DataFrame:
        counts = rows.mapInArrow(tidy(_count(settings)), "term string, clean long, toxic long")
        return settle(counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-terms")

    everything = counted(sample)
    totals = everything.where("term = ''").first()
    clean, toxic = (totals["clean"], totals["toxic"]) if totals else (0, 0)
    if not clean or not toxic:
        base = (toxic + 0.5) / (clean + toxic + 1)
        return Lexicon({}, (), (math.log(base / (1 - base)), 0.0, 0.0, 0.0))
    candidates = everything.count()
    log_odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    everything = everything.where("term <> ''").withColumn("weight", log_odds)
    terms: dict[str, float] = {}
    left, left_toxic, rest = sample.where("toxic > 0"), toxic, everything.select("term", F.col("toxic").alias("left"))
    while left_toxic:
        new = _strongest(everything.join(rest, "term"), clean, left_toxic, candidates, terms, settings)
        if not new:
            break
        terms |= new
        unmatched = features(left, Lexicon(terms, (), (0.0,) * 4)).where("features[0] = 0").drop("features")
        left = settle(unmatched, "toxicity-left")
        left_toxic = left.count()
        rest = counted(left).select("term", F.col("toxic").alias("left"))
    begins = F.lit(False)
    for n in sorted({len(t) for t in terms}):
        begins = begins | F.substring("term", 1, n).isin([t for t in terms if len(t) == n])
    spared = everything.where(F.col("term").endswith(" ") & begins & (F.col("weight") <= 0) & (F.col("clean") >= 3))
    exceptions = tuple(r["term"].strip() for r in spared.orderBy(F.desc("clean"), "term").collect())  # words of the sample
    matched = features(sample, Lexicon(terms, exceptions, (0.0,) * 4))
    fitted = matched.select("features", "toxic").toPandas()  # max_labelled rows at most
    return Lexicon(terms, exceptions, _logistic(np.stack(fitted["features"]), fitted["toxic"].to_numpy() > 0))


def _strongest(counts: DataFrame, clean: int, toxic: int, candidates: int, chosen: dict, settings: Settings) -> dict[str, float]:
    """New entries by the documents left: the strongest, and all at least half as strong. Of those that begin alike the
    strongest counts, or else the longest; a whole word only if no beginning of it is among them."""
    seen = F.col("left") + F.col("clean")
    share, p = F.col("left") / seen, toxic / (clean + toxic)
    # Logarithm of the chance to see such a share at random (Chernoff bound).
    surprise = seen * (share * F.log(share / p) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - p))).otherwise(0.0))
    log_odds = F.log((F.col("left") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    good = (F.col("left") > 0) & (log_odds >= settings.min_log_odds) & (surprise >= math.log(candidates) + 3)
    strong = counts.where(good).withColumn("strength", F.col("left") * log_odds)
    strong = settle(strong.select("term", "weight", "strength"), "toxicity-strong")
    most = strong.agg(F.max("strength")).first()[0]
    if most is None:
        return {}
    whole = F.col("term").endswith(" ")
    rows = strong.where(F.col("strength") * 2 >= most).orderBy(whole, F.desc("strength"), F.desc(F.length("term")), "term").collect()
    # A beginning of a chosen entry, or what begins with one, is no entry: by the lengths there are, not entry by entry.
    new: dict[str, float] = {}
    entries = set(chosen)
    begun = {t[:n] for t in entries for n in range(1, len(t) + 1)}
    for row in rows:
        term = row["term"]
        if term not in begun and not any(term[:n] in entries for n in range(1, len(term) + 1)):
            new[term] = row["weight"]
            entries.add(term)
            begun.update(term[:n] for n in range(1, len(term) + 1))
    return new


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method; all factors but the intercept are drawn to 0."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    pull = ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull + 1e-9 * np.eye(len(w)), x.T @ (y - p) - pull @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, exceptions: Sequence[str] = ()) -> DataFrame:
    """All rows and columns of the documents with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Only the text is read. Null and empty texts have no match and the score that goes with it. Input columns named
    score, predicted or features are replaced. ``exceptions`` adds phrases within which nothing matches.
    """
    if exceptions:
        more = tuple(" ".join(fold(e).split()) for e in exceptions)
        lexicon = Lexicon(lexicon.terms, lexicon.exceptions + tuple(e for e in more if e), lexicon.scale)
    intercept, *factors = lexicon.scale
    rows = features(docs.drop("features", "score", "predicted"), lexicon)
    logit = F.lit(intercept)
    for i, factor in enumerate(factors):
        logit = logit + F.lit(factor) * F.col("features")[i]
    rows = rows.withColumn("score", 1 / (1 + F.exp(-logit))).drop("features")
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
