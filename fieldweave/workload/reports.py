"""Aggregations, sorts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.operators import aggregates as A
from fieldweave.operators import changes as C
from fieldweave.operators import eav as E
from fieldweave.operators import predicates as P
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import (
    Sort,
    last_direction_wins,
    missing_lowest,
    order_of,
    page_after,
    page_of,
)
from fieldweave.sources import lens as L
from fieldweave.workload.registry import query

CATALOG = L.CONTACT_CATALOG

PIVOT_SQL = ", ".join(
    f"max(case when e.api_name = '{n}' then e.value end) as {n}" for n in CATALOG.names
)
GROUP_SQL = "order by cnt desc, key limit"


def doc_column(name: str):
    return P.document_column(name, CATALOG)


@query("eav_pivot", f"select e.record_id, {PIVOT_SQL} from eav e group by e.record_id")
def eav_pivot(spark: SparkSession, d: str) -> DataFrame:
    return E.pivot(L.values(spark, d), CATALOG)


@query(
    "eav_pivot_orders",
    """select v.record_id, max(case when v.field_id = 'f01' then v.value end) as status__c,
    max(case when v.field_id = 'f02' then v.value end) as priority__c,
    max(case when v.field_id = 'f03' then v.value end) as total__c,
    max(case when v.field_id = 'f04' then v.value end) as order_date__c,
    max(case when v.field_id = 'f05' then v.value end) as items__c,
    max(case when v.field_id = 'f06' then v.value end) as quantity__c
    from order_vals v group by v.record_id""",
)
def eav_pivot_orders(spark: SparkSession, d: str) -> DataFrame:
    return E.pivot(L.order_values(spark, d), L.ORDER_CATALOG)


@query("total_count", "select count(*) as total from docs where region__c = 'ASIA' and score__c > 10")
def total_count(spark: SparkSession, d: str) -> DataFrame:
    filters = [Filter("region__c", "eq", "ASIA"), Filter("score__c", "gt", 10)]
    return A.total(L.documents(spark, d).where(P.document_condition(filters, CATALOG)))


@query(
    "total_count_pivot",
    """select count(*) as total from (select c.id from contacts c left join eav e on e.record_id = c.id group by c.id
    having max(case when e.api_name = 'tier__c' then e.value end) = 'GOLD'
    and max(case when e.api_name = 'department__c' then e.value end) = 'BUILDING')""",
)
def total_count_pivot(spark: SparkSession, d: str) -> DataFrame:
    filters = [Filter("tier__c", "eq", "GOLD"), Filter("department__c", "eq", "BUILDING")]
    found = E.matches(L.values(spark, d), CATALOG, filters)
    return A.total(L.contacts(spark, d).select("id").join(found, "id", "left_semi"))


@query(
    "group_counts_eav",
    f"""select coalesce(nullif(e.value, ''), 'null') as key, count(*) as cnt from contacts c
    left join eav e on e.record_id = c.id and e.api_name = 'tier__c'
    where contains(lower(concat(c.first_name, ' ', c.last_name)), 'nation-1') or contains(lower(c.email), 'nation-1')
    group by 1 {GROUP_SQL} 50""",
)
def group_counts_eav(spark: SparkSession, d: str) -> DataFrame:
    contacts = L.contacts(spark, d).where(P.text_contains("nation-1"))
    return A.group_counts_eav(contacts, L.values(spark, d), CATALOG, "tier__c")


@query(
    "group_counts_orders",
    f"select value as key, count(*) as cnt from order_vals where field_id = 'f04' group by 1 {GROUP_SQL} 50",
)
def group_counts_orders(spark: SparkSession, d: str) -> DataFrame:
    values = L.order_values(spark, d)
    return A.group_counts_eav(L.order_records(spark, d), values, L.ORDER_CATALOG, "order_date__c")


@query("group_counts_base", f"select cast(account_id as varchar) as key, count(*) as cnt from contacts group by 1 {GROUP_SQL} 50")
def group_counts_base(spark: SparkSession, d: str) -> DataFrame:
    return A.group_counts(L.contacts(spark, d), P.contact_column("account_id"))


@query("terms_top_n", f"select tier__c as key, count(*) as cnt from docs where tier__c is not null group by 1 {GROUP_SQL} 10")
def terms_top_n(spark: SparkSession, d: str) -> DataFrame:
    return A.terms(L.documents(spark, d), doc_column("tier__c"))


@query(
    "terms_top_n_filtered",
    f"""select job_title__c as key, count(*) as cnt from docs where region__c = 'EUROPE' and score__c < 70
    group by 1 {GROUP_SQL} 10""",
)
def terms_top_n_filtered(spark: SparkSession, d: str) -> DataFrame:
    filters = [Filter("region__c", "eq", "EUROPE"), Filter("score__c", "lt", 70)]
    return A.terms(L.documents(spark, d).where(P.document_condition(filters, CATALOG)), doc_column("job_title__c"))


@query(
    "terms_share",
    f"""with g as (select department__c as key, count(*) as cnt from docs group by 1 {GROUP_SQL} 10)
    select key, cnt, round(cnt * 100 / sum(cnt) over (), 1) as percent, round(cnt * 100 / max(cnt) over (), 1) as bar,
    cast(sum(cnt) over () as bigint) as shown_total from g""",
)
def terms_share(spark: SparkSession, d: str) -> DataFrame:
    return A.terms_share(A.terms(L.documents(spark, d), doc_column("department__c")))


@query(
    "status_counts",
    """select s.status, count(o.id) as cnt from (values ('PENDING'), ('PROCESSING'), ('DONE'), ('FAILED')) s(status)
    left join outbox o on o.status = s.status group by 1""",
)
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.status_counts(L.outbox(spark, d))


@query(
    "page_info",
    """with t as (select count(*) as total from docs where tier__c = 'GOLD')
    select total, cast(ceil(total / 15) as bigint) as total_pages, least(31, total) as first_row, least(45, total) as last_row from t""",
)
def page_info(spark: SparkSession, d: str) -> DataFrame:
    gold = L.documents(spark, d).where(P.document_condition([Filter("tier__c", "eq", "GOLD")], CATALOG))
    return A.page_info(A.total(gold), 3, 15)


@query("active_field_count", "select count(*) as total from tenant_defs where is_active")
def active_field_count(spark: SparkSession, d: str) -> DataFrame:
    return A.total(L.tenant_fields(spark, d).where("is_active"))


@query(
    "sort_base",
    "select id, status, email from contacts order by status desc, email asc nulls last, id limit 25 offset 25",
)
def sort_base(spark: SparkSession, d: str) -> DataFrame:
    order = order_of([Sort("status", "desc"), Sort("email")], P.contact_column)
    return page_of(L.contacts(spark, d).select("id", "status", "email"), order, 2, 25)


@query(
    "sort_name",
    """select id, email, trim(concat(first_name, ' ', last_name)) as name from contacts
    order by name desc, id limit 20 offset 40""",
)
def sort_name(spark: SparkSession, d: str) -> DataFrame:
    rows = L.contacts(spark, d)
    page = page_of(rows, order_of([Sort("name", "desc")], P.contact_column), 3, 20)
    return page.select("id", "email", P.contact_column("name").alias("name"))


@query(
    "sort_eav_text",
    """select c.id, e.value as annual_revenue__c from contacts c
    left join eav e on e.record_id = c.id and e.api_name = 'annual_revenue__c'
    order by e.value desc nulls last, c.id limit 40 offset 80""",
)
def sort_eav_text(spark: SparkSession, d: str) -> DataFrame:
    name = "annual_revenue__c"
    wide = E.wide_contacts(L.contacts(spark, d).select("id"), L.values(spark, d), CATALOG, [name])
    return page_of(wide, order_of([Sort(name, "desc")], F.col, missing_lowest), 3, 40)


@query(
    "sort_eav_text_missing_first",
    """select c.id, e.value as tier__c from contacts c
    left join eav e on e.record_id = c.id and e.api_name = 'tier__c'
    order by e.value asc nulls first, c.id limit 300""",
)
def sort_eav_text_missing_first(spark: SparkSession, d: str) -> DataFrame:
    wide = E.wide_contacts(L.contacts(spark, d).select("id"), L.values(spark, d), CATALOG, ["tier__c"])
    return page_of(wide, order_of([Sort("tier__c")], F.col, missing_lowest), 1, 300)


@query(
    "sort_doc_typed",
    "select id, annual_revenue__c from docs order by annual_revenue__c desc nulls last, id limit 30",
)
def sort_doc_typed(spark: SparkSession, d: str) -> DataFrame:
    order = order_of([Sort("annual_revenue__c", "desc")], doc_column)
    return page_of(L.documents(spark, d), order, 1, 30).select("id", "custom_fields.annual_revenue__c")


@query(
    "sort_multi",
    """select id, tier__c, region__c, score__c from docs
    order by tier__c desc nulls last, score__c asc nulls last, name desc, id limit 50 offset 50""",
)
def sort_multi(spark: SparkSession, d: str) -> DataFrame:
    sorts = last_direction_wins(
        [Sort("tier__c", "asc"), Sort("score__c", "asc"), Sort("name", "desc"), Sort("tier__c", "desc")]
    )
    page = page_of(L.documents(spark, d), order_of(sorts, doc_column), 2, 50)
    return page.select("id", "custom_fields.tier__c", "custom_fields.region__c", "custom_fields.score__c")


@query("sort_default", "select id, created_at from contacts order by created_at desc nulls last, id limit 20")
def sort_default(spark: SparkSession, d: str) -> DataFrame:
    return page_of(L.contacts(spark, d).select("id", "created_at"), order_of([], P.contact_column))


@query(
    "page",
    """select id, name, created_at from docs where region__c = 'AMERICA'
    order by created_at desc nulls last, id limit 15 offset 45""",
)
def page(spark: SparkSession, d: str) -> DataFrame:
    docs = L.documents(spark, d).where(P.document_condition([Filter("region__c", "eq", "AMERICA")], CATALOG))
    return page_of(docs, order_of([], doc_column), 4, 15).select("id", "name", "created_at")


@query(
    "page_after",
    "select id, score__c from docs where (score__c, id) > (60, 500) order by score__c, id limit 25",
)
def page_after_key(spark: SparkSession, d: str) -> DataFrame:
    rows = L.documents(spark, d).select("id", "custom_fields.score__c").where("score__c is not null")
    return page_after(rows, "score__c", F.lit(60.0), F.lit(500), 25)


@query(
    "oldest_first_batch",
    "select id, aggregate_id, event_type, created_at from outbox where status = 'PENDING' order by created_at, id limit 100",
)
def oldest_first_batch(spark: SparkSession, d: str) -> DataFrame:
    return C.oldest_waiting(L.outbox(spark, d)).select("id", "aggregate_id", "event_type", "created_at")


@query(
    "top_n_groups",
    f"""select priority__c as key, count(*) as cnt from order_profile where priority__c is not null
    group by 1 {GROUP_SQL} 3""",
)
def top_n_groups(spark: SparkSession, d: str) -> DataFrame:
    return A.terms(L.order_profile(spark, d), F.col("priority__c"), 3)

