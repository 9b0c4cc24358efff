"""The language model with whole words as contexts, against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldweave.llm import lm, queries, wordlm

SMALL = wordlm.Settings(chunk_bytes=900, shard_bytes=4_000, fan_in=3, cell_tokens=200, chunk_docs=11)


@pytest.fixture(scope="module")
def texts():
    random = np.random.default_rng(5)
    word = lambda: f"w{int(random.zipf(1.3)) % 200}"
    rows = [(i, " ".join(word() for _ in range(int(random.integers(1, 60))))) for i in range(120)]
    rows += [(None, "w1 W2, w3"), (None, None), (500, ""), (501, " \t\n"), (502, "w1 " * 30_000), (503, "Été w1-w2 é東京"), rows[3], rows[3]]
    return rows + [(600 + i, rows[7][1]) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string")


def tokens(text):
    """Each word, then the end, after the one before; the end stands before a text."""
    h1, h2, _, _ = lm.tokens([(text or "").encode()])
    own = list(zip(h1.tolist(), h2.tolist()))
    return list(zip([own[-1], *own[:-1]], own))


class Plain:
    """The chances of tokens from the averaged tables, one at a time."""

    def __init__(self, model):
        self.model, self.pairs, self.zero, self.tables = model, {}, {}, {}
        for row in model.shards.collect():
            shard = wordlm.Shard(row.asDict())
            zero, one = (lm.unpack(row[n]) / model.settings.samples for n in ("zero_sum", "one_sum"))
            names = [tuple(w) for w in shard.words.tolist()]
            self.zero.update(zip(names, zero))
            for at, w, n, t in zip(shard.at, shard.word, shard.counts, one):
                self.pairs[int(shard.contexts[at]), names[w]] = (int(n), t)
        self.customers, self.seats, self.top = Counter(), defaultdict(float), defaultdict(float)
        for (u, w), (n, t) in self.pairs.items():
            self.customers[u] += n
            self.seats[u] += t
            self.top[w] += t

    @staticmethod
    def name(word):
        return int(wordlm.names(np.array([word], np.uint64))[0])

    def chance(self, before, word):
        (d0, d1), u = self.model.levels.discounts, self.name(before)
        everyone = 1 + sum(self.top.values())
        p = (self.top[word] - d0 * self.zero.get(word, 0)) / everyone + (1 + d0 * sum(self.zero.values())) / everyone / (len(self.zero) + 1)
        n, t = self.pairs.get((u, word), (0, 0))
        return (n - d1 * t + (1 + d1 * self.seats.get(u, 0)) * p) / (1 + self.customers[u])


@pytest.mark.parametrize("settings", [wordlm.Settings(), SMALL])
def test_scores_equal_brute_force(spark, texts, docs, settings):
    model = wordlm.learn(docs, settings=settings)
    there, found = Plain(model), wordlm.score(docs, model).collect()
    trained = [r["text"] for r in docs.where(lm.in_training()).collect()]
    pairs = Counter(p for t in trained for p in tokens(t))
    assert {(there.name(u), w): n for (u, w), n in pairs.items()} == {k: n for k, (n, _) in there.pairs.items()}
    counts = Counter()
    for (_, w), n in pairs.items():
        counts[w] += n
    total = sum(counts.values())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == Counter((i, len((t or "").split()) + 1) for i, t in texts)
    chances = {}
    for doc_id, text in texts:
        own = tokens(text)
        row = next(r for r in found if r["doc_id"] == doc_id and r["n_tokens"] == len(own))
        assert row["n_known"] == sum(w in counts for _, w in own) and row["train_tokens"] == total
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for _, w in own))
        for pair in set(own) - set(chances):
            chances[pair] = math.log10(there.chance(*pair))
        assert row["score"] == pytest.approx(sum(chances[p] for p in own))
    for before in (lm.END, tokens("w1")[0][1], tokens("zz")[0][1]):
        assert sum(there.chance(before, w) for w in [*there.zero, (0, 0)]) == pytest.approx(1)
    again = wordlm.score(docs, wordlm.learn(docs, settings=settings)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_a_word_follows_a_whole_word(spark, tmp_path):
    """Contexts that end alike were one: what follows xab and what follows yab had the same chance."""
    rows = [(i, "xab one" if i % 2 else "yab two") for i in range(200)] + [(1000 + i, "xab one") for i in range(40)] + [(2000 + i, "xab two") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").where("doc_id < 1000 or crc32(cast(doc_id as string)) % 7 = 2").write.parquet(f"{tmp_path}/documents.parquet")
    held = queries.op13_lm_scoring(spark, str(tmp_path)).where("doc_id >= 1000").collect()
    right, wrong = ([r["score"] for r in held if (r["doc_id"] < 2000) == first] for first in (True, False))
    assert right and wrong and min(right) > max(wrong) + 1


def test_scores_of_no_texts(spark, docs):
    model = wordlm.learn(docs.limit(0))
    assert wordlm.score(docs.limit(0), model).count() == 0
    rows = wordlm.score(docs, model).collect()
    assert len(rows) == docs.count() and all(r["n_known"] == 0 and np.isfinite(r["score"]) for r in rows)
