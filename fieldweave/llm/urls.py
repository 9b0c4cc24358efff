"""URL filters: rules on hosts and paths, and block decisions that reach a page's aliases; DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldweave.llm.graph import components
from fieldweave.session import settle


@dataclass(frozen=True)
class Rule:
    """Fits a host, all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host.lower(), slash + path)


#: The rules of the registered query.
RULES = tuple(Rule.parse(*r.split()) for r in ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits, an allow before a block of the same text; else null. The rules
    are a parameter and become one column expression."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


# Where a page says what it is an alias of, and what its links are relative to. Fixed patterns of HTML.
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*(?:["'][^"'>]*\bcanonical\b|canonical\b))[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["'][^"'>]*?\burl\s*=\s*([^"'\s>]+)"""
_BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""

# The named characters of HTML that a link needs; the ampersand last, as it may be part of the others.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def node_of(url: Column) -> Column:
    """A page as a node of the alias graph: host, path without dot segments, and query; no scheme and no fragment."""
    rest = F.regexp_replace(_after_scheme(url), r"(?s)#.*$", "")
    path = F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(rest, r"(?s)(\?.*)$", 1)
    return F.concat(host_of(url), _without_dots(path), query)


def _without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` taken as steps, as in RFC 3986."""
    parts = F.split(path, "/", -1)

    def step(seen: Column, part: Column) -> Column:
        back = F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(1)))
        return F.when(part == ".", seen).when(part == "..", back).otherwise(F.concat(seen, F.array(part)))

    walked = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends_in_step = path.rlike(r"(?s)/\.\.?$")
    short = F.concat(F.concat_ws("/", walked), F.when(ends_in_step, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(?s)/\.\.?(?:/|$)"), short).otherwise(path)


def _unescaped(link: Column) -> Column:
    """A link with the entities of HTML read: numbers of ASCII characters and the named ones above."""
    def one(text: Column, number: Column) -> Column:
        hexadecimal = F.lower(number).startswith("x")
        code = F.when(hexadecimal, F.conv(F.substring(number, 2, 8), 16, 10)).otherwise(F.substring(number, 1, 8)).cast("int")
        sign = F.when(code.between(1, 127), F.char(code))
        return F.coalesce(F.replace(text, F.concat(F.lit("&#"), number, F.lit(";")), sign), text)

    numbers = F.array_distinct(F.regexp_extract_all(link, F.lit(r"(?i)&#(x[0-9a-f]{1,8}|[0-9]{1,8});"), F.lit(1)))
    plain = F.aggregate(numbers, link, one)
    for name, character in _ENTITIES:
        plain = F.replace(plain, F.lit(name), F.lit(character))
    return plain


def _resolved(link: Column, url: Column) -> Column:
    """A link as an absolute url: with a scheme, from ``//``, from ``/``, a query only, or beside the page."""
    host = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^([^#]*)", 1), link))
        .otherwise(F.concat(folder, link))
    )


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(a, b) of nodes that are the same page: all canonical links and refreshes in the HTML, relative to the page or
    its ``<base>``, and a table of redirects with the columns source and target."""
    html = F.coalesce(F.col("html"), F.lit("")) if "html" in pages.columns else F.lit("")
    found = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)])
    links = pages.select(
        F.col("url").alias("source"), F.regexp_extract(html, _BASE, 1).alias("base"), F.explode(F.array_distinct(found)).alias("target")
    )
    base = F.when(F.col("base") == "", F.col("source")).otherwise(_resolved(_unescaped(F.col("base")), F.col("source")))
    links = links.select("source", base.alias("base"), _unescaped(F.col("target")).alias("target"))
    if redirects is not None:
        links = links.unionByName(redirects.select("source", F.col("source").alias("base"), "target"))
    links = links.where("source is not null and target is not null")
    links = links.select(node_of(F.col("source")).alias("a"), node_of(_resolved(F.col("target"), F.col("base"))).alias("b"))
    return links.where("a <> '' and b <> ''")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A page's own rule decides, so an explicit allow stands whatever its aliases are. A page without a rule is blocked
    if an alias of it is blocked by a rule, over any number of redirects and canonical links, unless one of its aliases
    is explicitly allowed; all others are allowed. A target that is no page itself is judged by the rules too. Null urls and urls without a scheme have
    neither host nor path, no rule and no alias. Repeated rows are judged alike; no rows give no rows.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(F.coalesce(url, F.lit(""))).alias("node"))
    rows = rows.withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    nodes = components(alias_links(pages, redirects))
    as_url = F.concat(F.lit("http://"), F.col("node"))
    ruled = nodes.withColumn("own", rule_for(host_of(as_url), path_of(as_url), rules))
    said = lambda v: F.coalesce(F.max(F.col("own.verdict") == v), F.lit(False))
    blocked = settle(ruled.groupBy("component").agg(said("block").alias("block"), said("allow").alias("allow")).where("block and not allow"), "url-blocked")
    nodes = nodes.join(blocked, "component", "left_semi").select("node").distinct()
    rows = rows.join(nodes.withColumn("alias_blocked", F.lit(True)), "node", "left")
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("alias_blocked"), F.lit("block")), F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("own.text").alias("rule"), verdict.alias("verdict"))


URLS_SQL = r"""
with parts as (
    select page_id, case when contains(coalesce(url, ''), '://') then regexp_replace(url, '(?s)^.*?://', '') else '' end as rest from pages
),
named as (
    select page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path
    from parts
),
rules(verdict, host, path) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
select n.page_id, n.host, n.path, (
        select r.host || r.path from rules r where (n.host = r.host or n.host like '%.' || r.host) and starts_with(n.path, r.path)
        order by length(r.host || r.path) desc limit 1) as rule,
    coalesce((select r.verdict from rules r where (n.host = r.host or n.host like '%.' || r.host) and starts_with(n.path, r.path)
        order by length(r.host || r.path) desc limit 1), 'allow') as verdict
from named n
"""
