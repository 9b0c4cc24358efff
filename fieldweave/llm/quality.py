"""Quality rules, and an isolation forest on their statistics with a threshold from labelled rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.common import SPACE
from fieldweave.session import settle

#: Signs that count as symbols. Fixed value.
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Settings:
    #: Labelled rows that the forest is grown on, at most; those with the lowest hash of their id.
    max_labelled: int = 25_600
    trees: int = 100
    tree_rows: int = 256
    seed: int = 7
    #: Share of the labelled good rows that may be rejected as anomalies, at most, if no bad rows are labelled.
    max_clean_loss: float = 0.005
    #: Steps of the scores between which the threshold is sought, over all labelled rows.
    score_steps: int = 2_000


def statistics(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(SPACE):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, reach = Counter(windows), 0
        for i, window in enumerate(windows):  # positions in any repeated window, each once
            if counts[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, again, repeated


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the five statistics (long), in place of columns of those names. Null texts have no words."""

    @F.pandas_udf(", ".join(f"{n} long" for n in STATISTICS))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([statistics(t) for t in batch], columns=list(STATISTICS), dtype="int64")

    rows = docs.drop(*[n for n in STATISTICS if n != text])
    columns = rows.columns
    return rows.withColumn("_statistics", measure(F.coalesce(F.col(text), F.lit("")))).select(*columns, "_statistics.*")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shape(statistics: np.ndarray) -> np.ndarray:
    """What the forest sees: length, and rates that don't grow with it. Repeated lines are left out: they are rare in
    good documents too, and line dedup is about them."""
    words = np.maximum(statistics[:, 0], 1)
    return np.stack([np.log1p(statistics[:, 0]), *(statistics[:, i] / words for i in (1, 2, 4))], axis=1)


def usual_path(n: float) -> float:
    """Mean path length of a search in a random tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def separation(rows: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """How far the values of good and bad rows lie apart, for each column: the largest difference of their cumulative
    shares (0 to 1). All 1 if either label is missing, or if no column tells them apart."""
    good, bad = rows[quality > 0], rows[quality <= 0]
    if not len(good) or not len(bad):
        return np.ones(rows.shape[1])
    out = np.zeros(rows.shape[1])
    for i, values in enumerate(rows.T):
        below = [np.searchsorted(np.sort(x[:, i]), values, side="right") / len(x) for x in (good, bad)]
        out[i] = np.abs(below[0] - below[1]).max()
    return out if out.any() else np.ones(rows.shape[1])


class Forest:
    """Trees of random splits, on a column as often as its weight says. Nodes of all trees in flat arrays; a leaf's children are itself and its ``path`` is its
    depth and what rows that share it would need."""

    def __init__(self, rows: np.ndarray, weights: np.ndarray, settings: Settings):
        random = np.random.default_rng(settings.seed)
        self.weights = weights
        self.feature, self.split, self.left, self.right, self.path, self.roots = [], [], [], [], [], []
        self.size = min(settings.tree_rows, len(rows))
        self.depth = max(1, math.ceil(math.log2(max(2, self.size))))
        for _ in range(settings.trees):
            chosen = rows[random.choice(len(rows), self.size, replace=False)]
            self.roots.append(self._grow(chosen, 0, random))
        for name in ("feature", "split", "left", "right", "path"):
            setattr(self, name, np.array(getattr(self, name)))

    def _grow(self, rows: np.ndarray, depth: int, random: np.random.Generator) -> int:
        at = len(self.feature)
        for values, value in ((self.feature, 0), (self.split, 0.0), (self.left, at), (self.right, at), (self.path, depth + usual_path(len(rows)))):
            values.append(value)
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero((high > low) & (self.weights > 0))
        if depth < self.depth and len(open_):
            feature = int(random.choice(open_, p=self.weights[open_] / self.weights[open_].sum()))
            split = random.uniform(low[feature], high[feature])
            below = rows[:, feature] <= split
            if below.any() and not below.all():
                self.feature[at], self.split[at] = feature, split
                self.left[at] = self._grow(rows[below], depth + 1, random)
                self.right[at] = self._grow(rows[~below], depth + 1, random)
        return at

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; rows that few splits set apart are near 1."""
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                at = np.where(rows[each, self.feature[at]] <= self.split[at], self.left[at], self.right[at])
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / max(usual_path(self.size), 1e-9))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their quality; an id with several labels has the lowest."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    return rows.join(known, "doc_id")


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, the five statistics, base_failed, score, kept.

    A document is kept if no base rule fails and its anomaly score is not above the threshold: the one for which the
    shares of the labelled bad and good rows that it rejects differ most, of those that pass the base rules. If none of
    them is bad, ``max_clean_loss`` of the good ones at most are lost; if none is good, all of the bad ones are rejected.
    The forest splits more often on statistics that set the labels apart, so good rows that are merely long stay. Without labelled rows there is no forest, the score is 0 and the base rules decide. Null and empty texts have no
    words and fail. Repeated rows are judged alike; no rows give no rows.
    """
    rows = settle(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality-rows").withColumn("base_failed", base_failed())
    known = labelled(rows.where(~F.col("base_failed")), labels)
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(settings.max_labelled)
    sample = sample.select(*STATISTICS, "quality").toPandas().to_numpy(np.float64)  # max_labelled rows at most
    if not len(sample):
        return rows.withColumn("score", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    seen = shape(sample[:, :-1])
    forest = Forest(seen, separation(seen, sample[:, -1]), settings)  # trees * 2 * tree_rows nodes at most

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series) -> pd.Series:
        return pd.Series(forest.score(shape(np.stack([a, b, c, d, e], axis=1).astype(np.float64))))

    scored = rows.withColumn("score", score(*STATISTICS))
    step = F.ceil(F.col("score") * settings.score_steps).cast("int").alias("step")
    counts = labelled(scored.where(~F.col("base_failed")), labels).groupBy(step, "quality").agg(F.count("*").alias("n")).collect()
    threshold = _threshold({(r["step"], r["quality"]): r["n"] for r in counts}, settings)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") <= threshold))


def _threshold(counts: dict[tuple[int, int], int], settings: Settings) -> float:
    """The highest threshold with the largest difference of the shares of bad and good rows that are rejected."""
    good, bad = (sum(n for (_, q), n in counts.items() if (q > 0) == kind) for kind in (True, False))
    lost, caught, found, most = 0, 0, settings.score_steps, 0.0
    for step in range(settings.score_steps, -1, -1):  # rows above the step are rejected
        gain = caught / max(1, bad) - lost / max(1, good)
        if gain > most or not bad and lost <= settings.max_clean_loss * good:
            found, most = step, max(gain, most)
        lost += sum(n for (s, q), n in counts.items() if s == step and q > 0)
        caught += sum(n for (s, q), n in counts.items() if s == step and q <= 0)
    return found / settings.score_steps
