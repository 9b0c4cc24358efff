"""The operators on training text against brute force, round trips and held-out labels, with odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fieldweave.llm import bpe, chat, exact, graph, lines, mixing, neardup, quality, queries, sharding, toxicity, urls

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, k1 string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and blank texts, repeated rows, copies, a long text, and columns with clashing names."""
    prose = " ".join(f"w{i * 7919 % 1000}" for i in range(300))
    texts = [None, "", " \t\n", "a\nB\na", "a\nB\na", "x" * 9000 + "\n" + "y " * 9000, prose, prose.replace("w919 ", "other "), f" {prose}\n", "é😀 <|im_end|> idiot", "x" * 9000]
    rows = [(i, t, None, "s" if i % 2 else None, None, None, "k") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "a\nB\na", None, None, None, True, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    _, fault = differences(queries.QUERIES[name](spark, DATA), connect(DATA), queries.ORACLES[name])
    assert not fault


def test_chat_reads_back(spark):
    texts = ["</s>[INST] ok [/INST]", None, "", "<\\|im_end|> <|im_end|>\n", "<<SYS>>é😀", "<\\\\/s>", "a" * 50_000]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", None, "a\\\nb<s>", "assistant", "assistant", "user"], texts))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x")
    for row in chat.format_conversations(frame, chat.Template(chunk_bytes=100)).collect():
        assert chat.read_turns(row["formatted"]) == [(r or "", x or "") for c, _, r, x in rows if c == row["conv_id"]]
        learned = [row["formatted"][a : a + n] for a, n in zip(row["loss_starts"], row["loss_lengths"])]
        assert [chat.unescape(x) for x in learned] == [x or "" for c, _, r, x in rows if c == row["conv_id"] and r == "assistant"]
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def test_tokens_equal_the_library(odd, empty):
    path = public_tokenizers.path(queries.VOCABULARY)
    tokenizer, own = Tokenizer.from_file(path), bpe.Tokenizer(path)
    rows = own.decode(own.encode(odd.select("text"))).collect()
    for row in rows:
        there = tokenizer.encode(row["text"] or "", add_special_tokens=False)
        assert row["ids"] == there.ids and row["decoded"] == tokenizer.decode(there.ids, skip_special_tokens=False)
    strange = ["<|endoftext|>hi<|startoftext|> <|endoftext|", "ΑΣ İ ẞ ﬁ Ⅷ 東京 👍🏽 à́", "it's I'LL 'S", "a" * 999, "\x00\x1cx\x85　z", "\t"]
    encoder = bpe.Encoder(bpe.Vocabulary.load(path), max_pieces=3)
    for text in strange:
        assert encoder.encode([text, text])[0].tolist() == 2 * tokenizer.encode(text, add_special_tokens=False).ids
    assert own.decode(own.encode(empty)).count() == 0


def test_toxicity_on_held_out_rows(spark, odd, empty):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "concat('plain words number ', id, if(id % 5 = 0, ' you zorgel', ' you zorgon'), if(id % 7 = 0, ' blick', ' block')) as text"
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) as toxic")
    lexicon = toxicity.learn(docs, labels)
    assert list(lexicon.terms) == ["zorgel"]
    scored = toxicity.score(docs.where(~toxicity.in_training()), lexicon).join(labels, "doc_id")
    assert scored.count() > 300 and scored.where("predicted <> toxic").count() == 0
    score = lambda t, **k: toxicity.score(spark.createDataFrame([(t,)], "text string"), lexicon, **k).first()["predicted"]
    assert score("a z0rg3l!") == 1 and score("ｚоrgеl") == 1 and score("azorgel") == 0
    assert score("a zorgel bird", exceptions=("zorgel bird",)) == 0
    assert toxicity.score(odd, lexicon).count() == odd.count() and toxicity.score(empty, lexicon).count() == 0
    bare = toxicity.learn(empty, labels)
    assert not bare.terms and toxicity.score(odd, bare).where("score between 0 and 1").count() == odd.count()


@pytest.mark.parametrize(
    "text", ["idiot", "ïdiöt", "\U0001d48adiot", "ⓘdiot", "i.d.i.o.t", "I-D-1-0-T", "ｉｄｉｏｔ", "1d10t", "іdіоt"]
)
def test_spellings_of_a_word(text):
    assert toxicity.fold(f"an {text}, ok").split() == ["an", "idiot", "ok"]
    assert toxicity.fold("e.g. U.S. a-b well-known x.y.zoo").split() == ["e", "g", "u", "s", "a", "b", "well", "known", "x", "y", "zoo"]


def test_whole_words_are_entries(spark):
    """Words of two letters, and words that differ late, among clean words that begin alike."""
    docs = spark.range(4000).selectExpr(
        "id as doc_id",
        "concat('some plain text ', id, ' zqtop zqend ', if(id % 5 = 0, if(id % 2 = 0, 'you zq', 'you incomprehensibles'), 'you incomprehensibly')) as text",
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) as toxic")
    lexicon = toxicity.learn(docs, labels)
    assert sorted(lexicon.terms) == ["incomprehensibles ", "zq "]
    scored = toxicity.score(docs, lexicon).join(labels, "doc_id")
    assert scored.where("predicted <> toxic").count() == 0


def test_all_entries_with_evidence_are_taken(spark):
    """More rounds and entries than any earlier limit would let through: shares of the words fall by half again and again."""
    rows = []
    for k in range(19):
        rows += [(f"word text {k} {i} bad{chr(97 + k)}x", 1) for i in range(max(40, 400 >> k))]
    rows += [(f"word text {i} good", 0) for i in range(4000)]
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    lexicon = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    assert toxicity.score(docs, lexicon).where("predicted <> toxic").count() == 0


def plain_features(lexicon, text):
    """Matches looked for at every place of the folded text."""
    folded = toxicity.fold(text or "")
    places = range(len(folded))
    found = [(i, i + len(t) + 1, w) for t, w in lexicon.terms.items() for i in places if folded.startswith(f" {t}", i)]
    spared = [(i, i + len(p) + 2) for p in lexicon.exceptions for i in places if folded.startswith(f" {p} ", i)]
    left = [w for a, b, w in found if not any(c <= a and b <= d for c, d in spared)]
    if not left:
        return 0.0, 0.0, 0.0
    return 1.0, np.log1p(sum(left)), np.log1p(100 * sum(left) / max(1, len(folded.split())))


def test_toxicity_equals_brute_force(spark, odd):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    lexicon = toxicity.learn(docs, labels)
    assert lexicon.terms
    rows = docs.select("doc_id", "text").where("length(text) < 20000").unionByName(odd.select("doc_id", "text").where("length(text) < 5000"))
    for row in toxicity.score(rows, lexicon).collect():
        logit = lexicon.scale[0] + sum(a * b for a, b in zip(lexicon.scale[1:], plain_features(lexicon, row["text"])))
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-logit))) and row["predicted"] == (row["score"] >= 0.5)


def test_line_dedup_equals_brute_force(odd, empty):
    settings = lines.Settings(min_docs=3, shard_keys=1, cell_probes=2)
    rows = lines.drop_shared_lines(odd.withColumnRenamed("lang", "n_lines"), settings).collect()
    counts = Counter(k for r in rows for k in {lines.line_key(x) for x in (r["text"] or "").split("\n")} if k)
    for r in rows:
        parts = (r["text"] or "").split("\n")
        kept = [x for x in parts if counts[lines.line_key(x)] < 3]
        assert (r["kept_text"], r["n_lines"], r["n_dropped"]) == ("\n".join(kept), len(parts), len(parts) - len(kept))
    assert sum(r["n_dropped"] for r in rows) == 12
    assert lines.drop_shared_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    h = np.random.default_rng(0).integers(0, 2**63, (2, 5000)).astype(np.uint64)
    built = lines.PerfectHash.build(*h)
    assert sorted(built.index(*h)) == list(range(5000))


@pytest.mark.parametrize("settings", [exact.Settings(), exact.Settings(block_chars=3, hash_values=2)])
def test_exact_dedup_equals_brute_force(odd, empty, settings):
    texts = odd.select("doc_id", "text").where("text is null or length(text) < 5000")
    rows = exact.dedup_exact(texts, settings).collect()
    own = [re.sub(r"[\x20\x09-\x0d]", "", r["text"] or "") for r in texts.collect()]
    hashes = Counter(hashlib.sha256(t.encode()).hexdigest() for t in own)
    assert Counter(r["text_sha256"] for r in rows) == hashes
    assert all(r["group_size"] == hashes[r["text_sha256"]] for r in rows)
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter(hashes.keys())
    assert exact.dedup_exact(empty, settings).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len(found) == 81 and len(set(found.values())) == 2 and found[0] == found[40] != found[100]


def test_aliases_of_blocked_pages(spark):
    page = lambda url, to=None: (url, f'<link rel="canonical" href="{to}">' if to else None)
    pages = [
        page("http://a.org/x", "http://b.org/x"), page("http://b.org/x", "/y"), page("http://b.org/y"), page("http://c.org/z"),
        page("http://d.org/fr/", "http://spam.net/2"), page("http://e.org/"), page(None, "http://spam.net/1"), page("HTTP://A.Net/#x"), page("x"),
    ]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)] + [(0, *pages[0])], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("https://b.org/y#top", "http://spam.net/1"), (None, "x")], "source string, target string")
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(frame, redirects=redirects).collect()}
    assert verdicts == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow"}
    assert urls.judge(frame.limit(0)).count() == 0


def test_shards_are_even_and_keep_groups(spark, odd, empty):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('x', cast(id % 900 as int)) as text")
    rows = sharding.assign_shards(docs, sharding.Settings(shards=4)).toPandas()
    loads = rows.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() < 0.02 * loads.mean()
    assert rows.groupby("size")["shard"].nunique().max() == 1
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert sharding.assign_shards(odd).count() == odd.count() and sharding.assign_shards(empty).count() == 0


def test_mix_meets_its_targets(spark, odd, empty):
    docs = queries.table(spark, DATA, "documents")
    plan = mixing.plan_mix(docs, queries.WEIGHTS, queries.SCHEDULES).toPandas()
    sources = plan.groupby("source").agg({"target": "first", "taken": "sum", "size": ["max", "sum"]})
    assert ((sources["taken", "sum"] - sources["target", "first"]).abs() <= sources["size", "max"]).all()
    assert sources["target", "first"].sum() == pytest.approx(1.5 * plan["size"].sum())
    rows = mixing.curriculum(docs, queries.WEIGHTS, queries.SCHEDULES)
    assert rows.columns == docs.columns and rows.count() == int(plan["positions"].map(len).sum())
    assert mixing.plan_mix(odd, (1.0,)).count() == odd.count()
    assert mixing.curriculum(odd, (1.0,)).count() >= odd.count()
    assert mixing.curriculum(empty, (1.0,)).count() == 0


def test_positions_equal_brute_force(spark):
    random = np.random.default_rng(3)
    docs = [(i, "w " * int(random.integers(0, 60)), "abc"[i % 3 if i % 7 else 0]) for i in range(200)]
    weights, schedules = {"a": 3.0, "b": 1.0, "c": 2.0}, {"a": mixing.EARLY, "b": mixing.LATE, "c": ((0.0, 0.0), (0.3, 2.0), (1.0, 0.5))}
    rows = mixing.plan_mix(spark.createDataFrame(docs, "doc_id long, text string, source string"), weights, schedules, mixing.Settings(range_rows=20)).collect()
    found = {r["doc_id"]: r for r in rows}

    def demand(knots, time):
        times = np.linspace(0, time, 20_001)
        return np.trapezoid(np.interp(times, *zip(*knots)), times)

    for source, knots in schedules.items():
        before = 0
        for i, text, _ in sorted((d for d in docs if d[2] == source), key=lambda d: hashlib.md5(f"{d[0]}|mix".encode()).hexdigest()):
            size, row = len(text.split()), found[i]
            middles = [e * row["source_size"] + before + size / 2 for e in range(2)]
            wanted = [m / row["target"] for m in middles if m < row["target"]]
            assert [demand(knots, at) / demand(knots, 1.0) for at in row["positions"]] == pytest.approx(wanted, abs=1e-6)
            before += size
    assert len(rows) == 200 and {len(r["positions"]) for r in rows} >= {1, 2}


def test_the_mix_gives_its_places(spark):
    rows = queries.op9_mixing(spark, DATA).collect()
    for r in rows:
        places = [p for p in (r["first_position"], r["second_position"]) if p is not None]
        assert places == sorted(places) and all(0 <= p <= 1 for p in places) and len(places) * r["size"] == r["taken"]
    assert len({r["first_position"] for r in rows}) > 100
    docs = queries.table(spark, DATA, "documents")
    mixed = mixing.curriculum(docs, queries.WEIGHTS, queries.SCHEDULES, position="at")
    assert mixed.columns == [*docs.columns, "at"]
    own = [r["at"] for r in mixed.collect()]
    assert own == sorted(own)
    assert Counter(own) == Counter(p for r in rows for p in (r["first_position"], r["second_position"]) if p is not None)


def test_mix_columns_without_places_equal_their_sql(spark):
    rows = queries.op9_mixing(spark, DATA).drop("first_position", "second_position")
    assert not differences(rows, connect(DATA), mixing.MIX_SQL)[1]


def test_pipeline_rows_have_their_places(spark):
    rows = corpus_pipeline.run(spark, DATA).select("doc_id", "position").collect()
    assert rows and all(0 <= r["position"] <= 1 for r in rows)
    assert len({r["position"] for r in rows}) > 0.9 * len(rows)


def test_similarity_and_its_estimate():
    random = np.random.default_rng(1)
    a = " ".join(f"w{x}" for x in random.integers(0, 300, 400))
    b = " ".join(w if i % 40 else "other" for i, w in enumerate(a.split()))
    owner, shingles, weights, _ = neardup.weighted_shingles([a.encode(), b.encode(), b""], 1)
    sets = [dict(zip(shingles[owner == i], weights[owner == i])) for i in (0, 1)]
    brute = sum(1 / sum(max(sets[0].get(e, 0) / sets[0][d], sets[1].get(e, 0) / sets[1][d]) for e in {*sets[0], *sets[1]}) for d in sets[0] if d in sets[1])
    flat = [(shingles[owner == i], weights[owner == i]) for i in (0, 1)]
    assert neardup.similarity(*flat) == pytest.approx(brute)
    values = neardup.prob_min_hash(owner, shingles, weights, 3, 2000)
    assert abs((values[0] == values[1]).mean() - brute) < 0.05


@pytest.mark.parametrize("settings", [neardup.Settings(), neardup.Settings(leaders=(1,), block_rows=3)])
def test_near_duplicates_equal_brute_force(spark, odd, empty, settings):
    random = np.random.default_rng(2)
    base = [f"w{x}" for x in random.integers(0, 5000, 120)]
    texts = [" ".join(base)]
    for i in range(40):
        words = list(base)
        for at in random.integers(0, 120, 1 + i % 5):
            words[at] = f"n{random.integers(0, 10**6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs, settings).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [own[i] for i in range(len(texts))] == label
    kept = neardup.keep_one(odd, settings)
    assert kept.columns == odd.columns and neardup.keep_one(empty, settings).count() == 0
    assert neardup.classes(odd, settings).where("kept").count() == kept.count() == 9


def test_quality_statistics_and_verdicts(spark, odd, empty):
    assert quality.statistics("a b c a b c\nx\nx\n\n") == (8, 8, 0, 1, 6)
    assert quality.statistics("#1 * $ ") == (2, 5, 3, 0, 0)
    labels = odd.selectExpr("doc_id", "1 as quality")
    assert quality.judge(odd, labels).count() == odd.count()
    assert quality.judge(empty, labels).count() == 0
    known = quality.judge(queries.table(spark, "/root/testdata/sf0.01", "documents"), queries.table(spark, "/root/testdata/sf0.01", "labels"))
    known = known.where("not base_failed").join(queries.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").toPandas()
    assert known[known.quality == 1].kept.mean() >= 0.99


def test_labelled_bad_rows_are_rejected(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    half = F.xxhash64("doc_id", F.lit(1)) % 2 == 0
    for learned, tried, kept in ((labels, labels, 0.02), (labels.where(half), labels.where(~half), 0.1)):
        known = quality.judge(docs, learned).where("not base_failed").join(tried, "doc_id").toPandas()
        assert (known.quality == 0).sum() >= 10
        assert known[known.quality == 0].kept.mean() <= kept and known[known.quality == 1].kept.mean() >= 0.98


def test_threshold_follows_both_labels():
    steps = quality.Settings(score_steps=10, max_clean_loss=0.1)
    assert quality._threshold({(4, 1): 95, (7, 1): 5, (6, 0): 9, (5, 0): 1}, steps) == 0.4
    assert quality._threshold({(4, 1): 95, (7, 1): 5}, steps) == 0.4
    assert quality._threshold({(4, 1): 85, (7, 1): 15}, steps) == 0.7
    assert quality._threshold({(4, 0): 3, (7, 0): 1}, steps) == 0.3
    assert quality._threshold({(4, 0): 5, (4, 1): 5}, steps) == 1.0


def test_pipeline_keeps_the_columns(spark, odd):
    docs = queries.table(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, odd, DATA).columns == odd.columns
    assert corpus_pipeline.run(spark, DATA).count() > 0 and docs.count() > 0


def test_stages_take_documents_with_columns_of_any_names(spark, data_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    odd = docs.selectExpr("*", *[f"'{n}' as {n}" for n in ("score", "features", "predicted", "kept_text", "n_lines", "k1", "alike", "spots", "position")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, odd, data_dir)
        assert rows.columns == odd.columns
        first = rows.first()
        assert (first["score"], first["features"], first["n_lines"], first["k1"], first["spots"]) == ("score", "features", "n_lines", "k1", "spots")
