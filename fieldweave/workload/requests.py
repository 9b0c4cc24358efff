"""Whole search requests on both layouts."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.functions.values import value_to_text
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import Sort
from fieldweave.operators.ranking import index_field
from fieldweave.plans.search import SearchResult, layout_parity, rank_contacts, rank_documents, search, search_documents, search_eav
from fieldweave.plans.spec import SearchSpec
from fieldweave.session import new_work_dir, settle
from fieldweave.sources import lens as L
from fieldweave.sources.layout import build_documents
from fieldweave.workload.registry import query
from fieldweave.workload.text import FIELDS, scores_sql

CATALOG = L.CONTACT_CATALOG

BASIC = SearchSpec(
    search="nation-1",
    filters=(Filter("tier__c", "eq", "GOLD"), Filter("status", "eq", "active")),
    sort=(Sort("createdAt", "desc"),),
    page=2,
    page_size=15,
)
PIVOT = SearchSpec(
    filters=(Filter("tier__c", "eq", "GOLD"),),
    sort=(Sort("score__c", "desc"),),
    group_by="region__c",
)
TYPED = SearchSpec.from_request(
    {
        "filter": '[{"field": "score__c", "operator": "between", "value": [20, 80]},'
        ' {"field": "region__c", "operator": "eq", "value": "EUROPE"},'
        ' {"field": "email", "operator": "contains", "value": "nation-1"}]',
        "sort": '[{"field": "annual_revenue__c", "direction": "asc"}, {"field": "name", "direction": "desc"}]',
        "page": "1",
        "pageSize": "30",
        "groupBy": "tier__c",
    }
)
KEYWORD = SearchSpec(search="platinum vp", filters=(Filter("score__c", "lt", 75),), page_size=25)
SIMPLE = SearchSpec.from_query(
    {"keyword": "gold", "filter[region__c]": "AFRICA", "sort[score__c]": "desc", "page": "1", "size": "10"}
)


def eav(spark: SparkSession, d: str, spec: SearchSpec) -> SearchResult:
    return search("eav", spec, CATALOG, contacts=L.contacts(spark, d), values=L.values(spark, d))


def doc(spark: SparkSession, d: str, spec: SearchSpec) -> SearchResult:
    return search("doc", spec, CATALOG, documents=L.documents(spark, d))


def map_page(result: SearchResult) -> DataFrame:
    """An EAV page with its total and the map of fields as sorted text."""
    entries = F.array_sort(F.map_entries("custom_fields"))
    text = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("null")))), ";")
    return result.page.select("id", "email", "name", text.alias("fields"), "created_at", result.total.scalar().alias("total"))


def struct_page(result: SearchResult) -> DataFrame:
    """A document page with its total and each field as text."""
    fields = [value_to_text(F.col(f"custom_fields.{f.api_name}"), f.kind).alias(f.api_name) for f in CATALOG.fields]
    return result.page.select("id", "email", "name", *fields, result.total.scalar().alias("total"))


def text_fields(prefix: str = "") -> str:
    """Each document field as text; numbers here are whole."""
    shown = []
    for f in CATALOG.fields:
        column = f"{prefix}{f.api_name}"
        if f.kind == S.NUMBER:
            column = f"cast(cast({column} as bigint) as varchar)"
        elif f.kind == S.DATE:
            column = f"cast({column} as varchar)"
        shown.append(f"{column} as {f.api_name}")
    return ", ".join(shown)


PRESENT_SQL = "coalesce(string_agg(e.api_name || '=' || e.value, ';' order by e.api_name), '')"


@query(
    "search_eav_basic",
    f"""with m as (select c.* from contacts c where c.status = 'active'
      and (contains(lower(concat(c.first_name, ' ', c.last_name)), 'nation-1') or contains(lower(c.email), 'nation-1'))
      and exists (select 1 from eav e where e.record_id = c.id and e.api_name = 'tier__c' and e.value = 'GOLD')),
    p as (select * from m order by created_at desc nulls last, id limit 15 offset 15)
    select p.id, coalesce(p.email, '') as email, trim(concat(p.first_name, ' ', p.last_name)) as name,
      {PRESENT_SQL} as fields, p.created_at, (select count(*) from m) as total
    from p left join eav e on e.record_id = p.id group by all""",
)
def search_eav_basic(spark: SparkSession, d: str) -> DataFrame:
    return map_page(eav(spark, d, BASIC))


@query(
    "search_eav_pivot",
    """with m as (select c.id, c.email, c.first_name, c.last_name, c.created_at,
        max(case when e.api_name = 'score__c' then cast(e.value as double) end) as score
      from contacts c left join eav e on e.record_id = c.id group by all
      having max(case when e.api_name = 'tier__c' then e.value end) = 'GOLD'),
    p as (select * from m order by score desc nulls last, id limit 20)
    select p.id, coalesce(p.email, '') as email, trim(concat(p.first_name, ' ', p.last_name)) as name,
      string_agg(concat(d.api_name, '=', coalesce(e.value, 'null')), ';' order by d.api_name) as fields,
      p.created_at, (select count(*) from m) as total
    from p cross join defs d left join eav e on e.record_id = p.id and e.api_name = d.api_name group by all""",
)
def search_eav_pivot(spark: SparkSession, d: str) -> DataFrame:
    return map_page(eav(spark, d, PIVOT))


@query(
    "search_eav_groups",
    """select coalesce(e.value, 'null') as key, count(*) as cnt from contacts c
    left join eav e on e.record_id = c.id and e.api_name = 'region__c' group by 1 order by cnt desc, key limit 50""",
)
def search_eav_groups(spark: SparkSession, d: str) -> DataFrame:
    return eav(spark, d, PIVOT).groups


@query(
    "search_eav_unsorted_fields",
    """with m as (select c.id, c.email, c.first_name, c.last_name, c.created_at, t.value as tier from contacts c
      left join eav t on t.record_id = c.id and t.api_name = 'tier__c'),
    p as (select * from m order by tier asc nulls last, created_at desc nulls last, id limit 40 offset 1240)
    select p.id, coalesce(p.email, '') as email, trim(concat(p.first_name, ' ', p.last_name)) as name,
      string_agg(concat(d.api_name, '=', coalesce(e.value, 'null')), ';' order by d.api_name) as fields,
      p.created_at, (select count(*) from m) as total
    from p cross join defs d left join eav e on e.record_id = p.id and e.api_name = d.api_name group by all""",
)
def search_eav_unsorted_fields(spark: SparkSession, d: str) -> DataFrame:
    spec = SearchSpec(sort=(Sort("tier__c"), Sort("created_at", "desc")), page=32, page_size=40)
    return map_page(eav(spark, d, spec))


TYPED_WHERE = "score__c between 20 and 80 and region__c = 'EUROPE' and contains(email, 'nation-1')"


@query(
    "search_doc",
    f"""select id, email, name, {text_fields()}, (select count(*) from docs where {TYPED_WHERE}) as total
    from docs where {TYPED_WHERE} order by docs.annual_revenue__c asc nulls last, name desc, id limit 30""",
)
def search_doc(spark: SparkSession, d: str) -> DataFrame:
    return struct_page(doc(spark, d, TYPED))


@query(
    "search_doc_groups",
    "select tier__c as key, count(*) as cnt from docs where tier__c is not null group by 1 order by cnt desc, key limit 50",
)
def search_doc_groups(spark: SparkSession, d: str) -> DataFrame:
    return doc(spark, d, TYPED).groups


@query(
    "search_doc_keyword",
    f"""with {scores_sql('docs', FIELDS, ['platinum', 'vp'], 'score__c < 75')}
    select d.id, d.email, d.name, {text_fields('d.')}, (select count(*) from scored) as total
    from scored s join docs d on d.id = s.id order by round(s.score, 9) desc, d.created_at desc nulls last, d.id limit 25""",
)
def search_doc_keyword(spark: SparkSession, d: str) -> DataFrame:
    return struct_page(doc(spark, d, KEYWORD))


SIMPLE_WHERE = "region__c = 'AFRICA' and (" + " or ".join(f"contains(lower({f}), 'gold')" for f in FIELDS) + ")"


@query(
    "search_doc_simple",
    f"""select id, email, name, {text_fields()}, (select count(*) from docs where {SIMPLE_WHERE}) as total
    from docs where {SIMPLE_WHERE} order by docs.score__c desc nulls last, id limit 10""",
)
def search_doc_simple(spark: SparkSession, d: str) -> DataFrame:
    return struct_page(search_documents(L.documents(spark, d), CATALOG, SIMPLE))


ROUTED = SearchSpec(
    filters=(Filter("region__c", "eq", "ASIA"), Filter("score__c", "gte", 30)), sort=(Sort("score__c"),), page_size=25
)
ROUTED_WHERE = "region__c = 'ASIA' and score__c >= 30"


@query(
    "search",
    f"""with p as (select id, email, name from docs where {ROUTED_WHERE} order by score__c asc nulls last, id limit 25),
    t as (select count(*) as total, cast(ceil(count(*) / 25) as bigint) as total_pages from docs where {ROUTED_WHERE})
    select l.layout, p.id, coalesce(p.email, '') as email, p.name, t.total, t.total_pages
    from p cross join t cross join (values ('doc'), ('eav')) l(layout)""",
)
def routed_search(spark: SparkSession, d: str) -> DataFrame:
    def shown(layout: str) -> DataFrame:
        result = search(
            layout,
            ROUTED,
            CATALOG,
            documents=L.documents(spark, d),
            contacts=L.contacts(spark, d),
            values=L.values(spark, d),
        )
        return result.page.select(
            F.lit(layout).alias("layout"),
            "id",
            F.coalesce("email", F.lit("")).alias("email"),
            "name",
            result.total.scalar().alias("total"),
            result.info.select("total_pages").scalar().alias("total_pages"),
        )

    return shown("doc").unionByName(shown("eav"))


PARITY = SearchSpec(filters=(Filter("tier__c", "contains", "L"), Filter("score__c", "lte", 60)))


@query(
    "layout_parity",
    """select 'matched' as part, count(*) as cnt from docs where contains(tier__c, 'L') and score__c <= 60
    union all select 'only_in_eav', 0 union all select 'only_in_doc', 0""",
)
def parity(spark: SparkSession, d: str) -> DataFrame:
    docs, contacts, values = L.documents(spark, d), L.contacts(spark, d), L.values(spark, d)
    differing = layout_parity(PARITY, CATALOG, docs, contacts, values)
    counts = differing.agg(
        F.count_if(F.col("only_in") == "eav").alias("only_in_eav"), F.count_if(F.col("only_in") == "doc").alias("only_in_doc")
    ).unpivot([], ["only_in_eav", "only_in_doc"], "part", "cnt")
    matched = search_documents(docs, CATALOG, PARITY).total.select(F.lit("matched").alias("part"), F.col("total").alias("cnt"))
    return matched.unionByName(counts)


# Requests whose answers the layouts must share: typed filters and sorts over unclean numbers, base fields, unknown names.
SHARED = {
    "number": SearchSpec(filters=(Filter("score__c", "gte", 0), Filter("status", "eq", "active"))),
    "number_sort": SearchSpec(sort=(Sort("score__c", "desc"),)),
    "base_sort": SearchSpec(sort=(Sort("firstName", "desc"), Sort("status"))),
    "unknown_sort": SearchSpec(sort=(Sort("nobody__c", "desc"),)),
    "unknown_filter": SearchSpec(filters=(Filter("nobody__c", "eq", "1"),)),
    "base_group": SearchSpec(group_by="status"),
    "unknown_group": SearchSpec(group_by="nobody__c"),
}


def unclean_values(spark: SparkSession, d: str) -> DataFrame:
    """The value rows, with scores that only begin like a number and empty ones."""
    score = F.col("field_id") == CATALOG.by_name["score__c"].id
    damaged = F.when(F.col("record_id") % 7 == 0, F.concat("value", F.lit("abc"))).when(F.col("record_id") % 11 == 3, F.lit(""))
    return L.values(spark, d).withColumn("value", F.when(score, F.coalesce(damaged, "value")).otherwise(F.col("value")))


@query(
    "stored_layout_parity",
    """with u as (select p.id, p.status, p.first_name, p.created_at,
      case when p.id % 7 = 0 or p.id % 11 = 3 then null else d.score__c end as score from docs d join profile p on p.id = d.id),
    r as (select *, row_number() over (order by score desc nulls last, id) as by_score,
      row_number() over (order by first_name desc nulls last, status nulls last, id) as by_name,
      row_number() over (order by created_at desc nulls last, id) as by_time from u),
    x as (select 'number' as part, cast(id as varchar) as key, 1 as cnt from u where score >= 0 and status = 'active'
      union all select 'number_sort', cast(id as varchar), 1 from r where by_score <= 20
      union all select 'base_sort', cast(id as varchar), 1 from r where by_name <= 20
      union all select 'unknown_sort', cast(id as varchar), 1 from r where by_time <= 20
      union all select 'base_group', status, count(*) from u group by status
      union all select 'unknown_group', 'null', count(*) from u)
    select l.layout, x.part, x.key, cast(x.cnt as bigint) as cnt from x cross join (values ('doc'), ('eav')) l(layout)""",
)
def stored_parity(spark: SparkSession, d: str) -> DataFrame:
    """The shared requests on both layouts, over value rows with unclean numbers and documents that were built from them and written."""
    contacts, values = L.contacts(spark, d), settle(unclean_values(spark, d), "unclean-values")
    docs = settle(build_documents(contacts, values, CATALOG, base_fields=True), "stored-documents")
    parts = []
    for part, spec in SHARED.items():
        for layout in ("doc", "eav"):
            found = search(layout, spec, CATALOG, documents=docs, contacts=contacts, values=values)
            if spec.group_by:
                rows = found.groups.select("key", F.col("cnt").cast("long").alias("cnt"))
            else:
                rows = found.page if spec.sort else found.matched
                rows = rows.select(F.col("id").cast("string").alias("key"), F.lit(1).cast("long").alias("cnt"))
            parts.append(rows.select(F.lit(layout).alias("layout"), F.lit(part).alias("part"), "key", "cnt"))
    return reduce(DataFrame.unionByName, parts)


LAST = SearchSpec(filters=(Filter("tier__c", "contains", "L"),), sort=(Sort("region__c"), Sort("score__c", "desc")), page_size=15)


@query(
    "page_deep",
    """with r as (select id, row_number() over (order by region__c nulls last, score__c desc nulls last, id) as rank,
      count(*) over () as n from docs where contains(tier__c, 'L')),
    p as (select id, rank, n from r where rank > (n - 1) // 15 * 15)
    select 'doc' as layout, id, n as total from p union all select 'eav', id, n from p""",
)
def page_deep(spark: SparkSession, d: str) -> DataFrame:
    """The last page of all matches, by rank, on both layouts."""
    ranked = {
        "doc": rank_documents(L.documents(spark, d), CATALOG, LAST, new_work_dir(spark, "ranked-documents")),
        "eav": rank_contacts(L.contacts(spark, d), L.values(spark, d), CATALOG, LAST, new_work_dir(spark, "ranked-contacts")),
    }
    doc_rows, eav_rows = (
        r.page(r.last_page).select(F.lit(name).alias("layout"), "id", F.lit(r.total).cast("long").alias("total")) for name, r in ranked.items()
    )
    return doc_rows.unionByName(eav_rows)


@query(
    "page_after_multi",
    """with r as (select id, region__c, score__c, row_number() over (order by region__c nulls last, score__c desc nulls last, id) as rank
      from docs where contains(tier__c, 'L'))
    select 'doc' as layout, id from r where rank between 46 and 60 union all select 'eav', id from r where rank between 46 and 60""",
)
def page_after_multi(spark: SparkSession, d: str) -> DataFrame:
    """The page after the last row of the third one, by the values of its two sort fields and its id."""
    row = doc(spark, d, replace(LAST, page=3)).page.select("custom_fields.region__c", "custom_fields.score__c", "id").collect()[-1]
    onward = replace(LAST, after=tuple(row))
    pages = [f(spark, d, onward).page.select(F.lit(name).alias("layout"), "id") for name, f in (("doc", doc), ("eav", eav))]
    return pages[0].unionByName(pages[1])


@query(
    "eav_sort_indexed",
    """with r as (select id, row_number() over (order by score__c nulls last, id) as up,
      row_number() over (order by score__c desc nulls last, id) as down from docs),
    n as (select count(*) as n from docs where score__c is not null)
    select 'asc' as part, id from r where up <= 20 union all select 'desc', id from r where down <= 20
    union all select 'missing', id from r, n where down > (n - 1) // 20 * 20 + 20 and down <= (n - 1) // 20 * 20 + 40
    union all select 'edge', id from r, n where down > (n - 1) // 20 * 20 and down <= (n - 1) // 20 * 20 + 20""",
)
def eav_sort_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Pages sorted by a field from its index: the first of both ways, the one where present values end, and the next."""
    contacts, values = L.contacts(spark, d), L.values(spark, d)
    index = index_field(contacts, values, CATALOG, "score__c", new_work_dir(spark, "field-index"))

    def page(part: str, direction: str, number: int) -> DataFrame:
        spec = SearchSpec(sort=(Sort("score__c", direction),), page=number)
        found = search_eav(contacts, values, CATALOG, spec, {"score__c": index})
        return found.page.select(F.lit(part).alias("part"), "id")

    edge = (index.keys.total - 1) // 20 + 1
    pages = [page("asc", "asc", 1), page("desc", "desc", 1), page("edge", "desc", edge), page("missing", "desc", edge + 1)]
    return reduce(DataFrame.unionByName, pages)
