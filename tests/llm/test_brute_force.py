"""Quality scores, shards and the whole pipeline against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from fieldweave.llm import mixing, quality, queries, sharding

SF = "/root/testdata/sf0.01"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_statistics(text):
    words = [w for w in re.split(f"[{SPACE}]+", text or "") if w]
    lines, seen, again = (text or "").split("\n"), [], 0
    for line in lines:
        if line.strip(SPACE):
            again += line in seen
            seen.append(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated)


def plain_path(forest, root, row):
    at, depth = root, 0
    while forest.left[at] != at:
        at = forest.left[at] if row[forest.feature[at]] <= forest.split[at] else forest.right[at]
        depth += 1
    return forest.path[at]


def test_quality_statistics_equal_brute_force(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n\n x\nx\nx \n#"), (-4, "a b " * 40)], "doc_id long, text string")
    rows = docs.unionByName(odd)
    found = {r["doc_id"]: r for r in quality.judge(rows, queries.table(spark, SF, "labels")).collect()}
    for row in rows.collect():
        expected, got = plain_statistics(row["text"]), found[row["doc_id"]]
        assert tuple(got[n] for n in quality.STATISTICS) == expected
        assert got["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (got["kept"] and got["base_failed"])


def test_quality_verdicts_equal_brute_force(spark):
    """Scores by walking each tree row by row, and the threshold by trying all of them."""
    docs, labels = (queries.table(spark, SF, n) for n in ("documents", "labels"))
    settings = quality.Settings(trees=12, tree_rows=64, score_steps=200)
    judged = quality.judge(docs, labels, settings).toPandas().set_index("doc_id")
    known = labels.where("quality is not null").toPandas().groupby("doc_id")["quality"].min()
    passed = judged[~judged.base_failed]
    order = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    fitted = sorted((d for d in passed.index if d in known), key=lambda d: (order[d], d))
    seen = quality.shape(passed.loc[fitted, list(quality.STATISTICS)].to_numpy(np.float64))
    forest = quality.Forest(seen, quality.separation(seen, known[fitted].to_numpy()), settings)
    rows = quality.shape(judged[list(quality.STATISTICS)].to_numpy(np.float64))
    for row, score in zip(rows, judged["score"]):
        mean = np.mean([plain_path(forest, root, row) for root in forest.roots])
        assert score == pytest.approx(2 ** (-mean / quality.usual_path(forest.size)))
    steps = np.ceil(passed.loc[fitted, "score"] * 200)
    bad, good = steps[known[fitted].to_numpy() <= 0], steps[known[fitted].to_numpy() > 0]
    gains = {t: (bad > t).mean() - (good > t).mean() for t in range(201)}
    threshold = max(t for t, g in gains.items() if g == pytest.approx(max(gains.values()), abs=1e-12)) / 200
    assert ((~judged.base_failed & (judged["score"] <= threshold)) == judged["kept"]).all()


@pytest.mark.parametrize("settings", [sharding.Settings(), sharding.Settings(shards=3, grain=4, range_rows=7)])
def test_shards_equal_brute_force(spark, settings):
    """Groups above a part of a shard one by one, the others in bundles by hash, largest first to the least loaded."""
    base = queries.table(spark, SF, "documents").select("doc_id", "text").collect()
    texts = [(r["doc_id"], r["text"]) for r in base] + [(-1, None), (-2, ""), (None, "x"), (None, None)]
    texts += [(10**6 + i, base[3]["text"]) for i in range(300)] + [(base[5]["doc_id"], base[5]["text"])] * 2
    rows = sharding.assign_shards(spark.createDataFrame(texts, "doc_id long, text string"), settings).collect()
    groups, total = Counter(), 0
    for _, text in texts:
        data = (text or "").encode()
        groups[data] += len(data) + 1
        total += len(data) + 1
    bundles = settings.shards * settings.grain
    least = max(1, -(-total // bundles))

    def item(data):
        if groups[data] >= least:
            return "large", hashlib.sha256(data).digest()
        hashed = xxhash.xxh64(hashlib.sha256(data).digest(), seed=42).intdigest()
        return "small", (hashed - 2**64 if hashed >= 2**63 else hashed) % bundles

    items = Counter()
    for data, size in groups.items():
        items[item(data)] += size
    loads, place = [0] * settings.shards, {}
    for key, size in sorted(items.items(), key=lambda x: (-x[1], x[0])):
        shard = min(range(settings.shards), key=lambda s: (loads[s], s))
        place[key] = shard
        loads[shard] += size
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    expected = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), place[item((t or "").encode())]) for d, t in texts]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in rows), key=key) == sorted(expected, key=key)
    for shard in range(settings.shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """Clean documents, toxic ones, near and exact copies, lines that many share; by id what each should come to."""
    pick = np.random.default_rng(11)
    prose = lambda n: " ".join(f"w{x}" for x in pick.integers(0, 30000, n))
    texts = [prose(80) + "\n" + prose(40) for _ in range(400)]
    toxic = set(range(0, 400, 8))
    texts = [t + (" you zorgel" if i in toxic else "") for i, t in enumerate(texts)]
    shared = "Share this  page"
    texts = [f"{t}\n {shared.upper() if i % 2 else shared}\t" if 100 <= i < 130 else t for i, t in enumerate(texts)]
    near = texts[1].split(" ")
    near[50] = "other"
    texts += [texts[1]] * 3 + [" ".join(near), texts[2] + " more", prose(90)]
    sources = [["web", "book", "code", None][i % 4] for i in range(len(texts))]
    path = tmp_path_factory.mktemp("corpus")
    return path, texts, sources, toxic


def test_pipeline_equals_brute_force(spark, corpus):
    path, texts, sources, toxic = corpus
    docs = spark.createDataFrame(
        [(i, t, "en", s, len(t)) for i, (t, s) in enumerate(zip(texts, sources))], "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i in toxic), 1) for i in range(len(texts))]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")

    left = {i: t for i, t in enumerate(texts) if i not in toxic}
    key = lambda line: line.strip(SPACE).lower()
    holding = Counter(k for t in left.values() for k in {key(line) for line in t.split("\n")} if k)
    dropped = {k for k, n in holding.items() if n >= 10}
    assert dropped == {"share this  page"}
    left = {i: "\n".join(line for line in t.split("\n") if key(line) not in dropped) for i, t in left.items()}
    sets, kept = {i: shingles(t) for i, t in left.items()}, []
    root = {i: i for i in left}
    for i in left:
        for j in left:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    kept = sorted(set(root.values()))
    assert len(left) - len(kept) == 5

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(i, left[i], sources[i]) for i in kept])
    places = con.execute(f"select doc_id, first_position, second_position from ({mixing.PLACES_SQL})").fetchall()
    tokenizer = Tokenizer.from_file(queries.vocabulary_path())
    expected = []
    for i, *positions in places:
        ids = tokenizer.encode(left[i], add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))]
        expected += [(i, len(ids), *digests, round(p, 9)) for p in positions if p is not None]
    found = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], round(r["position"], 9)) for r in corpus_pipeline.run(spark, str(path)).collect()]
    assert len(expected) >= len(kept) and sorted(found) == sorted(expected)
