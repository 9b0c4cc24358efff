"""Filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.operators import eav as E
from fieldweave.operators import predicates as P
from fieldweave.operators import textsearch as X
from fieldweave.operators import validation as Q
from fieldweave.operators.lookups import by_column, by_ids, contact_by_id
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import order_of, page_of
from fieldweave.plans.search import search_columns
from fieldweave.session import new_work_dir
from fieldweave.sources import keyindex as K
from fieldweave.sources import layout
from fieldweave.sources import lens as L
from fieldweave.workload.registry import query

CATALOG = L.CONTACT_CATALOG
CONTACT = ["id", "first_name", "last_name", "email", "status"]


def doc_filter(name: str, flt: list[Filter], condition: str) -> None:
    """Register a filter of the document layout."""
    fields = list(dict.fromkeys(f.field for f in flt if f.field.endswith("__c") and CATALOG.get(f.field)))
    dates = {f for f in fields if CATALOG.by_name[f].kind == "DATE"}
    shown = "".join(f", cast({f} as varchar) as {f}" if f in dates else f", {f}" for f in fields)

    @query(name, f"select id, name{shown} from docs where {condition}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        docs = L.documents(spark, d).where(P.document_condition(flt, CATALOG))
        columns = [
            (F.col(f"custom_fields.{f}").cast("string") if f in dates else F.col(f"custom_fields.{f}")).alias(f)
            for f in fields
        ]
        return docs.select("id", "name", *columns)


doc_filter("doc_eq", [Filter("tier__c", "eq", "GOLD")], "tier__c = 'GOLD'")
doc_filter("doc_eq_unknown_field", [Filter("memo__c", "eq", "x"), Filter("tier__c", "eq", "GOLD")], "false and tier__c = 'GOLD'")
doc_filter("doc_contains", [Filter("notes__c", "contains", "client from A")], "contains(notes__c, 'client from A')")
doc_filter("doc_contains_wildcard", [Filter("notes__c", "contains", "BUILD?NG*A*A")], "notes__c like '%BUILD_NG%A%A%'")
doc_filter("doc_gt", [Filter("score__c", "gt", 90)], "score__c > 90")
doc_filter("doc_lt", [Filter("annual_revenue__c", "lt", "2000000")], "annual_revenue__c < 2000000")
doc_filter("doc_gte", [Filter("contract_start__c", "gte", "1996-01-01")], "contract_start__c >= date '1996-01-01'")
doc_filter("doc_lte", [Filter("last_contact_date__c", "lte", "2000-12-31")], "last_contact_date__c <= date '2000-12-31'")
doc_filter("doc_between", [Filter("score__c", "between", [20, 30])], "score__c between 20 and 30")
doc_filter(
    "doc_between_time",
    [Filter("createdAt", "between", ["1996-01-01", "1996-06-30"])],
    "created_at between timestamp '1996-01-01' and timestamp '1996-06-30'",
)
doc_filter("doc_text_range", [Filter("department__c", "gt", "BUILDING")], "department__c > 'BUILDING'")
doc_filter("match_all", [], "true")
doc_filter("kv_filters", P.equalities({"score__c": "46", "region__c": "ASIA"}), "score__c = 46 and region__c = 'ASIA'")


@query(
    "and_all",
    """select id, name, tier__c, score__c from docs where tier__c = 'GOLD' and score__c >= 40
    and contract_start__c < date '1999-01-01' and (contains(lower(email), 'nation') or contains(lower(name), 'nation')
      or contains(lower(job_title__c), 'nation') or contains(lower(department__c), 'nation')
      or contains(lower(region__c), 'nation') or contains(lower(tier__c), 'nation')
      or contains(lower(lead_source__c), 'nation') or contains(lower(notes__c), 'nation'))""",
)
def and_all(spark: SparkSession, d: str) -> DataFrame:
    filters = [
        Filter("tier__c", "eq", "GOLD"),
        Filter("score__c", "gte", 40),
        Filter("contract_start__c", "lt", "1999-01-01"),
    ]
    keyword = X.keyword_condition(list(search_columns(CATALOG).values()), X.words_of(spark, "Nation"))
    docs = L.documents(spark, d).where(P.document_condition(filters, CATALOG) & keyword)
    return docs.select("id", "name", "custom_fields.tier__c", "custom_fields.score__c")


@query(
    "filter_like",
    """select id, first_name, last_name, email, status from contacts
    where contains(lower(concat(first_name, ' ', last_name)), 'r 0000001') or contains(lower(email), 'r 0000001')
    union all
    select id, first_name, last_name, email, status from contacts
    where contains(lower(concat(first_name, ' ', last_name)), 'nation-7.') or contains(lower(email), 'nation-7.')""",
)
def filter_like(spark: SparkSession, d: str) -> DataFrame:
    rows = L.contacts(spark, d).select(CONTACT)
    return rows.where(P.text_contains("R 0000001")).unionByName(rows.where(P.text_contains("Nation-7.")))


@query(
    "filter_like_ignoring_accents",
    """select id, first_name, last_name, email, status from contacts
    where contains(lower(concat(first_name, ' ', last_name)), 'tomer 00') or contains(lower(email), 'tomer 00')""",
)
def filter_like_ignoring_accents(spark: SparkSession, d: str) -> DataFrame:
    return L.contacts(spark, d).select(CONTACT).where(P.text_contains("TÔMER 00", ignore_accents=True))


@query("text_eq_ignoring_case", "select id, name, tier__c from docs where lower(tier__c) = 'gold'")
def text_eq_ignoring_case(spark: SparkSession, d: str) -> DataFrame:
    docs = L.documents(spark, d).select("id", "name", "custom_fields.tier__c")
    return docs.where(P.equal_ignoring_case(F.col("tier__c"), "Göld "))


EXISTS = "exists (select 1 from eav e where e.record_id = c.id and e.api_name = '{}' and {})"


@query(
    "eav_eq",
    f"""select id, first_name, last_name, email, status from contacts c
    where {EXISTS.format('tier__c', "e.value = 'GOLD'")} and {EXISTS.format('region__c', "e.value = 'ASIA'")}""",
)
def eav_eq(spark: SparkSession, d: str) -> DataFrame:
    filters = [Filter("tier__c", "eq", "GOLD"), Filter("region__c", "eq", "ASIA")]
    values = L.values(spark, d)
    return E.having_values(L.contacts(spark, d).select(CONTACT), values, CATALOG, filters)


@query(
    "eav_match_once",
    f"""select id, first_name, last_name, email, status from contacts c
    where {EXISTS.format('tier__c', "e.value = 'GOLD'")} and {EXISTS.format('score__c', "try_cast(e.value as double) = 95")}
    union all
    select id, first_name, last_name, email, status from contacts c
    where {EXISTS.format('tier__c', "contains(e.value, 'R')")} and {EXISTS.format('score__c', "try_cast(e.value as double) between 10 and 60")}
      and {EXISTS.format('contract_start__c', "try_cast(e.value as date) > date '1996-03-01'")}""",
)
def eav_match_once(spark: SparkSession, d: str) -> DataFrame:
    contacts = L.contacts(spark, d).select(CONTACT)
    values = L.values(spark, d)
    exact = [Filter("tier__c", "eq", "GOLD"), Filter("score__c", "eq", 95)]
    ranges = [
        Filter("tier__c", "contains", "R"),
        Filter("score__c", "between", [10, 60]),
        Filter("contract_start__c", "gt", "1996-03-01"),
    ]
    parts = [contacts.join(E.matches(values, CATALOG, f), "id", "left_semi") for f in (exact, ranges)]
    return parts[0].unionByName(parts[1])


@query(
    "eav_has_field",
    f"select id, first_name, last_name, email, status from contacts c where {EXISTS.format('notes__c', 'true')}",
)
def eav_has_field(spark: SparkSession, d: str) -> DataFrame:
    values = L.values(spark, d)
    return E.having_field(L.contacts(spark, d).select(CONTACT), values, CATALOG, "notes__c")


@query(
    "pivot_eq",
    """select c.id, c.email, max(case when e.api_name = 'tier__c' then e.value end) as tier__c
    from contacts c left join eav e on e.record_id = c.id group by c.id, c.email
    having max(case when e.api_name = 'tier__c' then e.value end) = 'SILVER'""",
)
def pivot_eq(spark: SparkSession, d: str) -> DataFrame:
    contacts = L.contacts(spark, d).select("id", "email")
    return E.pivot_equal(contacts, L.values(spark, d), CATALOG, "tier__c", "SILVER")


@query("base_eq", "select id, first_name, last_name, email, status from contacts where status = 'inactive'")
def base_eq(spark: SparkSession, d: str) -> DataFrame:
    return L.contacts(spark, d).select(CONTACT).where(P.contact_condition([Filter("status", "eq", "inactive")]))


@query(
    "by_id",
    """select c.id, c.email, e.api_name, e.value from contacts c left join eav e on e.record_id = c.id where c.id = 42""",
)
def by_id(spark: SparkSession, d: str) -> DataFrame:
    contacts = L.contacts(spark, d).select("id", "email")
    rows = contact_by_id(contacts, L.values(spark, d), CATALOG.to_dataframe(spark), 42)
    return rows.select("id", "email", "api_name", "value")


@query(
    "by_email",
    "select id, first_name, last_name, email, status from contacts where email = 'customer.000000042@nation-17.example.com' or email = 'customer.000000636@nation-5.example.com' or email = 'customer.000000232@nation-0.example.com'",
)
def by_email(spark: SparkSession, d: str) -> DataFrame:
    rows = L.contacts(spark, d).select(CONTACT)
    addresses = [
        "customer.000000042@nation-17.example.com",
        "customer.000000636@nation-5.example.com",
        "customer.000000232@nation-0.example.com",
    ]
    found = [by_column(rows, "email", a) for a in addresses]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "def_by_api_name",
    "select id, label, api_name, data_type from tenant_defs where api_name = 'hot_rod_brand16__c' or api_name = 'red_ring_brand9__c'",
)
def def_by_api_name(spark: SparkSession, d: str) -> DataFrame:
    fields = L.tenant_fields(spark, d).select("id", "label", "api_name", "data_type")
    names = ("hot_rod_brand16__c", "red_ring_brand9__c")
    return by_column(fields, "api_name", names[0]).unionByName(by_column(fields, "api_name", names[1]))


@query(
    "by_id_list",
    """select id, first_name, last_name, email, status from contacts
    where id in (select user_id from events where event_type = 'purchase')""",
)
def by_id_list(spark: SparkSession, d: str) -> DataFrame:
    buyers = L.table(spark, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("id"))
    return by_ids(L.contacts(spark, d).select(CONTACT), buyers)


@query(
    "semi_exists",
    """select p.id, p.created_at from order_profile p where p.status__c = 'P'
    and exists (select 1 from order_vals v where v.record_id = p.id and v.field_id = 'f05' and cast(v.value as double) >= 5)""",
)
def semi_exists(spark: SparkSession, d: str) -> DataFrame:
    filters = [Filter("status__c", "eq", "P"), Filter("items__c", "gte", 5)]
    values = L.order_values(spark, d)
    return E.having_values(L.order_records(spark, d), values, L.ORDER_CATALOG, filters)


@query(
    "left_eav",
    """select c.id, c.email, d.api_name, v.value from contacts c
    left join vals v on v.record_id = c.id
    left join defs d on d.id = v.field_id""",
)
def left_eav(spark: SparkSession, d: str) -> DataFrame:
    rows = E.left_values(L.contacts(spark, d).select("id", "email"), L.values(spark, d), CATALOG.to_dataframe(spark))
    return rows.select("id", "email", "api_name", "value")


@query(
    "inner_value_def",
    """select v.id, v.record_id, d.api_name, d.data_type, v.value from tenant_vals v
    join tenant_defs d on d.id = v.field_id where d.is_active""",
)
def inner_value_def(spark: SparkSession, d: str) -> DataFrame:
    fields = L.tenant_fields(spark, d).where("is_active")
    rows = E.with_definitions(L.tenant_values(spark, d), fields)
    return rows.select("id", "record_id", "api_name", "data_type", "value")


@query(
    "page_then_fetch",
    """select e.record_id, e.api_name, e.value from eav e where e.record_id in
    (select id from contacts order by created_at desc nulls last, id limit 20 offset 20)""",
)
def page_then_fetch(spark: SparkSession, d: str) -> DataFrame:
    page = page_of(L.contacts(spark, d).select("id", "created_at"), order_of([], F.col), 2, 20)
    rows = E.values_of_page(L.values(spark, d), page)
    return E.with_definitions(rows, CATALOG.to_dataframe(spark)).select("record_id", "api_name", "value")


@query(
    "group_rows_by_id",
    """select c.id, count(e.api_name) as n_fields,
    coalesce(string_agg(e.api_name || '=' || e.value, ';' order by e.api_name), '') as fields
    from contacts c left join eav e on e.record_id = c.id
    group by c.id""",
)
def group_rows_by_id(spark: SparkSession, d: str) -> DataFrame:
    rows = E.values_per_contact(L.contacts(spark, d).select("id"), L.values(spark, d), CATALOG)
    entries = F.array_sort(F.transform("entries", lambda e: F.struct(e["api_name"], e["value"])))
    text = F.transform(entries, lambda e: F.concat_ws("=", e["api_name"], e["value"]))
    return rows.select("id", F.size("entries").cast("long").alias("n_fields"), F.array_join(text, ";").alias("fields"))


@query(
    "cross_fields",
    """select c.id as record_id, d.id as field_id, d.api_name, v.value from contacts c cross join defs d
    left join vals v on v.record_id = c.id and v.field_id = d.id""",
)
def cross_fields(spark: SparkSession, d: str) -> DataFrame:
    return E.field_grid(L.contacts(spark, d), L.values(spark, d), CATALOG)


@query(
    "new_email_only",
    """select n.request_id, n.email, case when n.email in (select email from contacts where email is not null)
      then 'known_email' when n.request_id > min(n.request_id) over (partition by n.email) then 'repeated_email' end as reason
    from new_contacts n""",
)
def new_email_only(spark: SparkSession, d: str) -> DataFrame:
    batch = L.new_contacts(spark, d).select("request_id", "email")
    return Q.new_only(batch, L.contacts(spark, d).where("email is not null"), "email", "request_id")


@query(
    "new_email_indexed",
    """select n.request_id, n.email, case when n.email in (select email from contacts where email is not null)
      then 'known_email' when n.request_id > min(n.request_id) over (partition by n.email) then 'repeated_email' end as reason
    from new_contacts n
    union all select concat('again-', n.request_id), n.email, case when n.email is not null then 'known_email' end from new_contacts n""",
)
def new_email_indexed(spark: SparkSession, d: str) -> DataFrame:
    """A batch against the index of addresses, and once more after its own addresses were added."""
    batch = L.new_contacts(spark, d).select("request_id", "email")
    path = new_work_dir(spark, "addresses")
    K.create_key_index(L.contacts(spark, d).select("email"), path, 16)
    first = Q.new_only(batch, K.known_keys(batch.select("email"), path), "email", "request_id")
    K.add_keys(batch.select("email"), path, 1)
    again = batch.withColumn("request_id", F.concat(F.lit("again-"), "request_id"))
    return first.unionByName(Q.new_only(again, K.known_keys(again.select("email"), path), "email", "request_id"))


@query(
    "new_api_name_only",
    """with b as (select id, api_name from tenant_defs where not is_active)
    select b.id, b.api_name, case when b.api_name in (select api_name from tenant_defs where is_active)
      then 'known_api_name' when b.id > min(b.id) over (partition by b.api_name) then 'repeated_api_name' end as reason
    from b""",
)
def new_api_name_only(spark: SparkSession, d: str) -> DataFrame:
    fields = L.tenant_fields(spark, d)
    batch = fields.where("not is_active").select("id", "api_name")
    return Q.new_only(batch, fields.where("is_active"), "api_name", "id")


@query(
    "known_active_fields",
    """select p.record_id, p.api_name, p.value, case when p.api_name = 'lead_source__c' then 'inactive_field'
    when p.api_name not in (select api_name from defs) then 'unknown_field' end as reason from patches p""",
)
def known_active_fields(spark: SparkSession, d: str) -> DataFrame:
    fields = CATALOG.to_dataframe(spark)
    fields = Q.set_active(fields, fields.where("api_name = 'lead_source__c'"), False)
    rows = Q.known_active_fields(L.patches(spark, d), fields)
    return rows.select("record_id", "api_name", "value", "reason")


@query(
    "missing_documents",
    """select id, first_name, last_name, email, status from contacts where id not in
    (select id from docs where created_at < timestamp '1996-01-01 00:00:00')""",
)
def missing_documents(spark: SparkSession, d: str) -> DataFrame:
    loaded = L.documents(spark, d).where("created_at < timestamp_ntz '1996-01-01 00:00:00'")
    return layout.missing_documents(L.contacts(spark, d).select(CONTACT), loaded)
