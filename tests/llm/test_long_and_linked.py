"""Exact dedup on very long texts, and aliases of pages over all their links, against plain Python."""

import html
import re
import time
from urllib.parse import urljoin, urlsplit

import pytest

from fieldweave.llm import exact, urls

RULES = (urls.Rule("block", "bad.net"), urls.Rule("allow", "good.org", "/fr/"))


def test_blocks_are_the_text(spark):
    texts = ["", "a", "é😀" * 5, "😀a" * 9000, "ab\nc\r\n d" * 1000, "x" * 4096, "x" * 4097]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for size in (1, 3, 4096):
        for text, blocks in rows.select("text", exact._blocks("text", size)).collect():
            assert blocks == ([text[i : i + size] for i in range(0, len(text), size)] or [""])


def test_long_texts_take_linear_time(spark):
    def seconds(megabytes):
        rows = spark.range(1).selectExpr(f"repeat('0123456789abcdef', {megabytes * 65536}) as text").repartition(1)
        rows.select(exact._blocks("text", 4096)).write.format("noop").mode("overwrite").save()
        start = time.monotonic()
        rows.select(exact._blocks("text", 4096)).write.format("noop").mode("overwrite").save()
        return time.monotonic() - start

    seconds(1)
    assert seconds(32) < 0.5 + 6 * max(seconds(8), 0.1)


def test_exact_dedup_of_long_texts(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(2_000_000))
    texts = [long, long[:1000] + " " + long[1000:], long[:-1] + "!", "!" + long[1:], long * 4]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.dedup_exact(rows).collect()}
    assert kept == {0: (1, 2), 1: (1, 2), 2: (2, 1), 3: (3, 1), 4: (4, 1)}


def _verdicts(pages, redirects):
    """Links by regular expressions and the standard library's url functions, components by search."""
    def node(url):
        parts = urlsplit(re.sub("^[^:]*", "http", urljoin(url, urlsplit(url).path + ("?" + urlsplit(url).query if urlsplit(url).query else ""))))
        return parts.netloc.lower() + parts.path + ("?" + parts.query if parts.query else "")

    def ruled(host, path):
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.text)).verdict if fits else None

    near = {}
    edges = [(s, t) for s, t in redirects]
    for url, text in pages:
        base = re.search(r'<base href="([^"]*)"', text or "")
        base = urljoin(url, html.unescape(base[1])) if base else url
        found = re.findall(r'<link rel="(?:\w+ )?canonical" href="([^"]*)"', text or "") + re.findall(r'http-equiv="refresh" content="0; url=([^"]*)"', text or "")
        edges += [(url, urljoin(base, html.unescape(t))) for t in found]
    for s, t in edges:
        near.setdefault(node(s), set()).add(node(t))
        near.setdefault(node(t), set()).add(node(s))
    out = []
    for url, _ in pages:
        own = ruled(urlsplit(url).netloc.lower(), urlsplit(url).path)
        seen, todo = set(), [node(url)]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += near.get(at, ())
        said = {ruled(n.split("/")[0].split("?")[0], "/" + n.partition("/")[2]) for n in seen} if near.get(node(url)) else set()
        out.append(own or ("block" if "block" in said and "allow" not in said else "allow"))
    return out


@pytest.fixture(scope="module")
def linked():
    link = lambda *to: "".join(f'<link rel="canonical" href="{t}">' for t in to)
    moved = lambda to: f'<meta http-equiv="refresh" content="0; url={to}">'
    pages = [
        ("http://a.com/1", link("http://a.com/other", "http://bad.net/x")),
        ("http://a.com/2", moved("/other2") + moved("http://bad.net/y")),
        ("http://a.com/p/q/3", link("../../up/b")),
        ("http://a.com/up/b", link("./../go?x=1&amp;y=2")),
        ("http://a.com/go?x=1&y=2", link("//bad.net/z")),
        ("http://a.com/5", '<base href="http://bad.net/dir/">' + link("file")),
        ("http://a.com/6", '<link rel="alternate canonical" href="HTTP://BAD.net&#47;w">'),
        ("http://a.com/7", '<link rel="stylesheet" href="http://bad.net/style">'),
        ("http://b.com/c1", link("c2")), ("http://b.com/c2", link("c3")), ("http://b.com/c3", link("c1")),
        ("http://B.com/self", link("http://b.com/self")),
        ("http://c.com/both", link("http://bad.net/k", "http://good.org/fr/k")),
        ("http://good.org/fr/k", None), ("http://good.org/de/k", None), ("http://bad.net/plain", ""),
    ]
    pages += [(f"http://chain.com/{i}", link(f"{i + 1}")) for i in range(60)] + [("http://chain.com/60", link("http://bad.net/end"))]
    pages += [(f"http://star.com/{i}", link("http://hub.com/", f"http://star.com/alt/{i}")) for i in range(200)]
    return pages, [("http://hub.com/", "http://sub.bad.net/hub"), ("http://r.com/1", "http://r.com/2")]


def test_blocks_reach_all_aliases(spark, linked):
    pages, redirects = linked
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    moves = spark.createDataFrame(redirects + [(None, "http://bad.net/"), ("http://a.com/7", None)], "source string, target string")
    found = {r["page_id"]: r["verdict"] for r in urls.judge(frame, RULES, moves).collect()}
    expected = _verdicts(pages, redirects)
    assert {p[0]: found[i] for i, p in enumerate(pages)} == {p[0]: v for p, v in zip(pages, expected)}
    blocked = {pages[i][0] for i, v in found.items() if v == "block"}
    assert {f"http://a.com/{n}" for n in (1, 2, 5, 6)} | {"http://a.com/p/q/3", "http://chain.com/0", "http://star.com/199"} <= blocked
    assert not blocked & {"http://a.com/7", "http://b.com/c1", "http://c.com/both", "http://good.org/fr/k"}
