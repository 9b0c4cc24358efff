"""Ranked search, conversation repair and language model scores against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldweave.llm import lm, queries, repair, search

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id string, segment string, score string"


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and long texts, ties, repeated rows and ids, other scripts."""
    random = np.random.default_rng(5)
    word = lambda: f"w{int(random.zipf(1.3)) % 200}"
    rows = [(i, " ".join(word() for _ in range(int(random.integers(1, 60))))) for i in range(120)]
    rows += [(None, "w1 W2, w3"), (None, None), (500, ""), (501, " \t\n"), (502, "w1 " * 30_000), (503, "Été w1-w2 é東京"), rows[3], rows[3]]
    return rows + [(600 + i, rows[7][1]) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "x", None) for i, t in texts], DOCS)


ITEMS = [(1, "w1 w2 w2 W3 nowhere"), (1, "w5 w7 w1"), (None, "été w2"), (3, None), (4, ""), (5, "nowhere"), (6, "w1 w1 w2 w4 w9 w11")]


@pytest.mark.parametrize("settings", [search.Settings(), search.Settings(top=7, segment_docs=9, block_items=2, batch_items=2, width=2, merge_parts=3)])
def test_search_equals_brute_force(spark, texts, docs, settings):
    lists = [search.terms_of(t or "") for _, t in texts]
    n_docs, n_terms = sum(1 for x in lists if x), sum(map(len, lists))
    frequency = Counter(t for x in lists for t in set(x))
    expected = Counter()
    for item_id, text in ITEMS:
        scored = []
        for (doc_id, _), terms in zip(texts, lists):
            counts, m = Counter(terms), 75 + (25 * len(terms) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in search.terms_of(text or "") if counts[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        expected.update((item_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[: settings.top]))
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, item string")
    found = search.search(search.build_index(docs, settings), items, settings)
    assert Counter(map(tuple, found.collect())) == expected and dict(found.dtypes)["rank"] == "int"
    assert search.search(search.build_index(docs.limit(0), settings), items, settings).count() == 0
    assert search.search(search.build_index(docs, settings), items.limit(0), settings).count() == 0


def test_search_leaves_most_documents():
    random = np.random.default_rng(0)
    places = [np.sort(random.choice(5000, n, replace=False)) for n in (2500, 900, 40, 3)]
    impacts = np.concatenate([random.integers(1, 900, len(p)) for p in places])
    maxima = search.RangeMaxima(np.cumsum([0, *map(len, places)]), np.concatenate(places), impacts, 5000)
    weights = np.array([100, 900, 3000, 7000])
    full = np.zeros(5000, np.int64)
    for k, p in enumerate(places):
        full[p] += weights[k] * impacts[maxima.bounds[k] : maxima.bounds[k + 1]]
    _, doc, score, scored = search.best_first(maxima, [(np.arange(4), weights)], 20, 1)
    best = np.lexsort((np.arange(5000), -full))[:20]
    assert sorted(zip(-score, doc)) == [(-full[d], d) for d in best] and scored < 400
    low, high = np.array([[0, 2510, 5]]), np.array([[2500, 2900, 5]])
    assert maxima.of(low, high)[0].tolist() == [[impacts[0:2500].max(), impacts[2510:2900].max(), 0]]


def least(codes):
    """Cheapest cost and least audit by going through all places from the end."""
    ways = {s: (c, a) for s, c, a in ((0, 0, ""), (1, 4, "II"), (2, 2, "I"), (3, 0, ""))}
    for symbol, fault in reversed(codes):
        new = {}
        for state in range(4):
            options, at, put = [], state, ""
            for _ in range(4):
                cost = 2 * len(put)
                late = 1 if fault == repair.TRUNCATED else 0
                options.append((cost + 3 + ways[at][0], put + "D" + ways[at][1]))
                if fault not in (repair.BLANK, repair.DUPLICATE):
                    options.append((cost + 2 + late + ways[2 if at != 2 else 3][0], put + "R" + ways[2 if at != 2 else 3][1]))
                    kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((at, symbol))
                    if kept:
                        options.append((cost + late + ways[kept][0], put + "K" + ways[kept][1]))
                at, put = (2 if at != 2 else 3), put + "I"
            new[state] = min(options)
        ways = new
    return ways[0]


def plain(rows):
    """The report of one conversation: its rows are (turn, role, text)."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = repair.BLANK if not body else repair.DUPLICATE if (role, text) in seen else repair.SOUND if body[-1] in ".!?" else repair.TRUNCATED
        seen.add((role, text))
        codes.append(("sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3, fault))
    cost, audit = least(codes)
    out, i, users = [], 0, 0
    for edit in audit:
        if edit != "D":
            if edit == "K" and codes[i][0] == 0:
                out.append(f"{rows[i][1]}:{rows[i][2]}")
            else:
                role = rows[i][1] if edit == "K" else ("user", "assistant")[users % 2]
                out.append(f"{role}:{'' if edit == 'I' else rows[i][2]}")
                users += 1
        i += edit != "I"
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(1 for a, b in zip(codes, codes[1:]) if (a[0], b[0]) not in ((0, 1), (1, 2), (2, 1)))
    kinds = Counter(f for _, f in codes)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, kinds[1], kinds[2], kinds[3], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("chunk_rows", [4096, 2, 8])
def test_repair_equals_brute_force(spark, chunk_rows):
    random = np.random.default_rng(9)
    talks = {None: [(None, None, None), (1, "assistant", "a.")], 1: [], 2: [(t, "tool", f"x{t}.") for t in range(90)], 3: [(t, "user", "same.") for t in range(70)]}
    talks[4] = [(t, "tool", f"x{t}") for t in range(41)] + [(9, "", "b")]
    talks[5] = [(t, ("user", "assistant")[t % 2], f"x{t}!") for t in range(64)]
    for c in range(6, 40):
        talks[c] = [
            (int(random.integers(0, 12)) if random.random() < 0.9 else None, ["system", "user", "assistant", "tool", None][random.integers(0, 5)], ["", "a.", "b", " c? ", "d\n"][random.integers(0, 5)] + "e" * int(random.integers(0, 2)))
            for _ in range(int(random.integers(1, 14)))
        ]
    rows = [(c, *r, "x") for c, talk in talks.items() for r in talk]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, row string")
    ids = spark.createDataFrame([(c,) for c in talks] * 2, "conv_id long")
    edited = repair.edits(frame, repair.Settings(chunk_rows=chunk_rows, batch_rows=50))
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.report(edited, ids).collect()}
    assert found == {c: plain(talk) for c, talk in talks.items()}
    kept = [(r["conv_id"], f"{r['role']}:{r['text']}") for r in repair.repaired(edited).orderBy("row", "place").collect()]
    for c in talks:
        assert hashlib.sha256("\n".join(t for own, t in kept if own == c).encode()).hexdigest() == found[c][-1]
    assert repair.report(repair.edits(frame.limit(0)), ids).where("audit = ''").count() == len(talks)


def test_chunks_end_alike_after_few_rows():
    usual = np.array([repair.code(1, 0), repair.code(2, 0)] * 3)
    fronts, _ = repair.Chunks(usual, np.array([6])).backward(repair.SPECULATIVE.T[None], keep=False)
    assert repair.is_rank_one(fronts).all()
    gone = np.full(6, repair.code(1, repair.DUPLICATE))
    fronts, _ = repair.Chunks(gone, np.array([6])).backward(repair.SPECULATIVE.T[None], keep=False)
    assert not repair.is_rank_one(fronts).any()


def tables_of(model):
    """The model's averaged seatings as plain dictionaries: {(h1, h2): {context: (count, tables)}} and those above."""
    pair, byte, word = defaultdict(dict), defaultdict(dict), {}
    for row in model.shards.collect():
        shard = lm.Shard(*(row[n] for n in ("words", "sizes", "contexts", "counts")))
        zero, one, two = (lm.unpack(t, np.int64) / model.settings.samples for t in row["sums"])
        names = [tuple(w) for w in shard.words.tolist()]
        for w, context, n, t in zip(shard.word, shard.context, shard.counts, two):
            pair[names[w]][int(context)] = (int(n), t)
        for w, b, t in zip(shard.parent_word, shard.parent_byte, one):
            byte[names[w]][int(b)] = t
        word.update(zip(names, zero))
    return pair, byte, word


class Plain:
    """The chances of tokens from the tables, one at a time."""

    def __init__(self, model):
        self.pair, self.byte, self.word = tables_of(model)
        self.discounts = [level.discount for level in (model.levels.all, model.levels.byte, model.levels.pair)]
        self.totals = defaultdict(lambda: [0, 0.0])
        for word, contexts in self.pair.items():
            for context, (n, t) in contexts.items():
                self.add(("pair", context), n, t)
                self.add(("byte", self.parent(context)), t, 0)
            for b, t in self.byte[word].items():
                self.add(("byte", b), 0, t)
                self.add("all", t, 0)
            self.add("all", 0, self.word[word])

    def add(self, key, n, t):
        self.totals[key][0] += n
        self.totals[key][1] += t

    @staticmethod
    def parent(context):
        return context & 255

    def step(self, level, key, n, t, above):
        customers, tables = self.totals[key]
        d = self.discounts[level]
        return (n - d * t + (1 + d * tables) * above) / (1 + customers)

    def chance(self, word, context):
        b = self.parent(context)
        own = self.pair.get(word, {})
        p = self.step(0, "all", sum(self.byte.get(word, {}).values()), self.word.get(word, 0), 1 / (len(self.word) + 1))
        p = self.step(1, ("byte", b), sum(t for c, (_, t) in own.items() if self.parent(c) == b), self.byte.get(word, {}).get(b, 0), p)
        return self.step(2, ("pair", context), *own.get(context, (0, 0)), p)


SMALL = lm.Settings(chunk_bytes=900, shard_bytes=4_000, fan_in=3, cell_tokens=200, chunk_docs=11)


@pytest.mark.parametrize("settings", [lm.Settings(), SMALL])
def test_scores_equal_brute_force(spark, texts, docs, settings):
    model = lm.learn(docs, settings=settings)
    there = Plain(model)
    found = lm.score(docs, model).collect()
    assert sum(map(len, there.pair.values())) > 500
    trained = docs.where(lm.in_training()).collect()
    tokens = lambda text: [*zip(*(x.tolist() for x in lm.tokens([(text or "").encode()])[:3]))]
    counts = Counter((h1, h2) for r in trained for h1, h2, _ in tokens(r["text"]))
    assert counts == {w: sum(n for n, _ in c.values()) for w, c in there.pair.items()}
    total, seen = sum(counts.values()), Counter((r["doc_id"], r["n_tokens"]) for r in found)
    assert seen == Counter((i, len((t or "").split()) + 1) for i, t in texts)
    by_row = defaultdict(list)
    for r in found:
        by_row[r["doc_id"]].append(r)
    for doc_id, text in texts:
        own = [(h1, h2, c) for h1, h2, c in tokens(text)]
        row = next(r for r in by_row[doc_id] if r["n_tokens"] == len(own))
        assert row["n_known"] == sum((h1, h2) in counts for h1, h2, _ in own) and row["train_tokens"] == total
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[h1, h2] + 1) / (total + len(counts) + 1)) for h1, h2, _ in own))
        if len(own) < 5000:
            assert row["score"] == pytest.approx(sum(math.log10(there.chance((h1, h2), c)) for h1, h2, c in own))
            assert row["perplexity"] == pytest.approx(10 ** (-row["score"] / len(own)))
    for context in [lm.START, int.from_bytes(b"w1", "big"), int.from_bytes(b"zz", "big")]:
        chances = [there.chance(w, context) for w in there.word] + [there.chance((0, 0), context)]
        assert sum(chances) == pytest.approx(1)
    again = lm.score(docs, lm.learn(docs, settings=settings)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_words_and_contexts():
    texts = [b"Ab c\xc3\xa9 AB\n", b"", b" \t", b"x" * 1_500_000 + b" y " * 10]
    h1, h2, context, owner = lm.tokens(texts)
    assert np.bincount(owner).tolist() == [4, 1, 1, 12]
    assert (h1[0], h2[0]) == (h1[2], h2[2]) != (h1[1], h2[1]) and h1[3] == h1[4] == lm.END[0]
    assert context[:6].tolist() == [lm.START, ord("a") << 8 | ord("b"), 0xC3 << 8 | 0xA9, ord("a") << 8 | ord("b"), lm.START, lm.START]
    assert context[8] == ord("y") and context[7] == ord("x") << 8 | ord("x")


def test_seating_has_the_expected_tables():
    """The mean number of tables against the exact chances of each number, by going through all customers."""
    random = np.random.default_rng(1)
    for n, others, base in ((1, 5, 0.1), (7, 3, 0.2), (300, 10, 0.01)):
        chances = np.zeros(n + 2)
        chances[1] = 1
        k = np.arange(n + 2)
        for sitting in range(1, n):
            new = (1 + 0.7 * (others + k)) * base
            new = np.where(k > 0, new / (new + sitting - 0.7 * k), 0)
            chances = chances * (1 - new) + np.concatenate([[0], (chances * new)[:-1]])
        mean = (chances * k).sum()
        tables = lm.seated(np.full(4000, n), np.full(4000, others), np.full(4000, base), 1.0, 0.7, random)
        assert tables.min() >= 1 and tables.max() <= n and tables.mean() == pytest.approx(mean, rel=0.03)
    assert lm.seated(np.array([0, 2]), np.zeros(2, np.int64), np.ones(2), 1.0, 0.5, random)[0] == 0


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = queries.op13_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert len(rows) > 50 and rows["score"].sum() > 0.97 * rows["base_score"].sum()


def test_scores_of_no_texts(spark, docs):
    model = lm.learn(docs.limit(0))
    assert lm.score(docs.limit(0), model).count() == 0
    rows = lm.score(docs, model).collect()
    assert len(rows) == docs.count() and all(r["n_known"] == 0 and np.isfinite(r["score"]) for r in rows)
