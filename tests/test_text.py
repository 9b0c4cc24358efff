"""Keyword search against brute force in plain Python."""

import math
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldweave.functions import text as X
from fieldweave.operators import textsearch as K

TEXTS = [
    "Gold client from ASIA",
    "banana bananas ana",
    "x",
    "",
    None,
    "customer.000000123@nation-7.example.com",
    "aaaa aaa",
    "Überraschung für 홍길동 홍길동님",
    "abcdefghijklmnop",
    "gold GOLD golden marigold",
]


def is_part(char):
    return unicodedata.category(char)[0] == "L" or unicodedata.category(char) == "Nd"


def runs_of(text):
    found, run = [], ""
    for char in text or "":
        if is_part(char):
            run += char
        elif run:
            found.append(run)
            run = ""
    return found + [run] if run else found


def grams_of(text):
    return [r[i : i + g].lower() for r in runs_of(text) for g in range(2, 11) for i in range(len(r) - g + 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(n, t, (TEXTS[-1 - n] or "")[:12]) for n, t in enumerate(TEXTS)], "id int, body string, title string"
    )


def columns():
    return {"body": F.col("body"), "title": F.col("title")}


def brute_scores(words):
    fields = {"body": TEXTS, "title": [(TEXTS[-1 - n] or "")[:12] for n in range(len(TEXTS))]}
    best = {}
    for texts in fields.values():
        grams = [grams_of(t) for t in texts]
        having = [g for g in grams if g]
        average = sum(map(len, having)) / len(having)
        for n, g in enumerate(grams):
            score = 0.0
            for word in words:
                tf = g.count(word)
                df = sum(word in other for other in grams)
                if tf:
                    idf = math.log(1 + (len(having) - df + 0.5) / (df + 0.5))
                    score += idf * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * len(g) / average))
            if score:
                best[n] = max(best.get(n, 0.0), score)
    return best


@pytest.mark.parametrize("words", [["gold"], ["ana", "aa"], ["gold", "client", "nation"], ["홍길"], ["gold", "gold"], ["zz"]])
def test_scores_equal_brute_force(spark, docs, words):
    expected = brute_scores(words)
    scored = {r["id"]: r["score"] for r in K.with_score(docs, columns(), words).collect()}
    stored = K.with_lengths(docs, columns())
    with_stored = {r["id"]: r["score"] for r in K.with_score(stored, columns(), words, lengths=K.LENGTHS).collect()}
    index, lengths = K.ngram_index(docs, columns()), K.field_lengths(docs, columns())
    indexed = {r["id"]: r["score"] for r in K.score_from_index(index, lengths, words).collect()}
    assert scored == pytest.approx(expected) == with_stored == pytest.approx(indexed)


def test_index_equals_brute_force(docs, tmp_path, spark):
    expected = {}
    for n, text in enumerate(TEXTS):
        for gram in grams_of(text):
            expected[("body", gram, n)] = expected.get(("body", gram, n), 0) + 1
    K.write_index(K.ngram_index(docs, {"body": F.col("body")}), str(tmp_path / "index"))
    rows = spark.read.parquet(str(tmp_path / "index")).collect()
    assert {(r["field"], r["gram"], r["id"]): r["tf"] for r in rows} == expected
    assert all(r["length"] == len(grams_of(TEXTS[r["id"]])) for r in rows)


def test_index_of_repeated_and_missing_ids_and_long_texts(spark):
    rows = [(1, "banana anana", 5), (1, "Banana", 7), (None, "aa aa", 1), (None, "aa", 2), (2, "aaaaaaaa" * 9, 3), (3, "İstanbul ΟΔΟΣ " * 60, 4), (4, "", 1), (5, None, 1)]
    docs = spark.createDataFrame(rows, "id long, body string, at int")
    expected = {}
    for n, text, at in rows:
        grams = grams_of(text)
        for gram in grams:
            tf, length, last = expected.get((gram, n), (0, 0, 0))
            expected[gram, n] = tf + 1, max(length, len(grams)), max(last, at)
    for parts in (None, 3):
        found = K.ngram_index(docs, {"body": F.col("body")}, carried=["at"], parts=parts).collect()
        assert {(r["gram"], r["id"]): (r["tf"], r["length"], r["at"]) for r in found} == expected
        assert len(found) == len(expected)


def test_filter_does_not_change_scores(docs):
    all_rows = {r["id"]: r["score"] for r in K.with_score(docs, columns(), ["gold"]).collect()}
    kept = {r["id"]: r["score"] for r in K.with_score(docs, columns(), ["gold"], F.col("id") > 4).collect()}
    assert kept and kept == {n: s for n, s in all_rows.items() if n > 4}


def test_no_usable_word_matches_nothing(spark, docs):
    assert K.words_of(spark, "x !! incomprehensible") == []
    assert K.with_score(docs, columns(), []).count() == 0
    assert docs.where(K.keyword_condition(list(columns().values()), [])).count() == 0


@pytest.mark.parametrize(
    "query, words",
    [
        ("Gold CLIENT", ["gold", "client"]),
        ("a bb ccc", ["bb", "ccc"]),
        ("abcdefghij abcdefghijk", ["abcdefghij"]),
        ("o'neil can't x.y.z", []),
        ("3.14 1,000 42", ["42"]),
        ("snake_case word", ["word"]),
        ("customer.000123 a-bc", ["customer", "000123", "bc"]),
        ("홍길동 漢字 test", ["홍길동", "test"]),
        ("", []),
    ],
)
def test_query_words(spark, query, words):
    assert K.words_of(spark, query) == words


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(alphabet="aAbé1 .-홍", max_size=30), min_size=1, max_size=5),
    word=st.text(alphabet="abé1홍", min_size=2, max_size=4),
)
def test_counts_equal_brute_force(spark, texts, word):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    found = rows.select("n", X.gram_count(F.col("t")), X.occurrences(F.lower("t"), word)).collect()
    for n, grams, times in found:
        assert grams == len(grams_of(texts[n]))
        assert times == len(re.findall(f"(?={re.escape(word)})", texts[n].lower()))
