"""Sources, sinks and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.functions import values as V
from fieldweave.operators import changes as C
from fieldweave.operators import eav as E
from fieldweave.operators import validation as Q
from fieldweave.session import new_work_dir
from fieldweave.sources import layout
from fieldweave.sources import lens as L
from fieldweave.workload.registry import query

CATALOG = L.CONTACT_CATALOG

DOC_SQL = """id, email, name, department__c, job_title__c, annual_revenue__c,
  cast(contract_start__c as varchar) as contract_start__c, lead_source__c,
  cast(last_contact_date__c as varchar) as last_contact_date__c, score__c, notes__c, region__c, tier__c,
  created_at, updated_at"""


def flat(docs: DataFrame) -> DataFrame:
    """Documents with one column per field, dates as text."""
    fields = []
    for f in CATALOG.fields:
        column = F.col(f"custom_fields.{f.api_name}")
        fields.append((V.day_to_text(column) if f.kind == S.DATE else column).alias(f.api_name))
    return docs.select("id", "email", "name", *fields, "created_at", "updated_at")


def text_options(definitions: DataFrame) -> DataFrame:
    return definitions.withColumn("options", F.array_join("options", ","))


@query("scan_contacts", "select id, first_name, last_name, email, status, account_id, created_at, updated_at from contacts")
def scan_contacts(spark: SparkSession, d: str) -> DataFrame:
    return L.contacts(spark, d).orderBy(F.col("created_at").desc(), "id")


@query(
    "scan_definitions",
    """select id, label, api_name, data_type, array_to_string(options, ',') as options, is_required, is_active,
    display_order, created_at from tenant_defs""",
)
def scan_definitions(spark: SparkSession, d: str) -> DataFrame:
    return text_options(L.tenant_fields(spark, d)).orderBy("created_at", "id")


@query(
    "scan_values",
    """select v.id, v.record_id, v.field_id, v.value from vals v
    where v.record_id in (select id from contacts where status = 'inactive')""",
)
def scan_values(spark: SparkSession, d: str) -> DataFrame:
    ids = L.contacts(spark, d).where("status = 'inactive'").select(F.col("id").alias("record_id"))
    rows = L.values(spark, d).join(ids, "record_id", "left_semi")
    return rows.select("id", "record_id", "field_id", "value")


@query(
    "scan_outbox",
    """select id, aggregate_type, aggregate_id, event_type, payload_value is not null as has_payload, status,
    retry_count, created_at, processed_at from outbox""",
)
def scan_outbox(spark: SparkSession, d: str) -> DataFrame:
    return L.outbox(spark, d).select(
        "id",
        "aggregate_type",
        "aggregate_id",
        "event_type",
        F.col("payload").isNotNull().alias("has_payload"),
        "status",
        "retry_count",
        "created_at",
        "processed_at",
    )


@query("scan_documents", f"select {DOC_SQL} from docs")
def scan_documents(spark: SparkSession, d: str) -> DataFrame:
    return flat(L.documents(spark, d))


@query("build_documents", f"select {DOC_SQL} from docs")
def build_documents(spark: SparkSession, d: str) -> DataFrame:
    return flat(layout.build_documents(L.contacts(spark, d), L.values(spark, d), CATALOG))


@query("melt_to_eav", "select id, record_id, field_id, value from vals")
def melt_to_eav(spark: SparkSession, d: str) -> DataFrame:
    return layout.melt(L.profile(spark, d), CATALOG).select("id", "record_id", "field_id", "value")


@query("melt_orders", "select id, record_id, field_id, value from order_vals")
def melt_orders(spark: SparkSession, d: str) -> DataFrame:
    return layout.melt(L.order_profile(spark, d), L.ORDER_CATALOG).select("id", "record_id", "field_id", "value")


@query(
    "write_upsert",
    """with last as (
      select aggregate_id as id, arg_max(event_type, (created_at, id)) as event_type, max(created_at) as updated_at
      from outbox where event_type <> 'CONTACT_DELETED' group by 1)
    select c.id, c.email, c.status, c.updated_at from contacts c where c.id not in (select id from last)
    union all
    select id, concat('user', id, '@example.com') as email,
      case when event_type = 'CONTACT_CREATED' then 'active' else 'inactive' end as status, updated_at from last""",
)
def write_upsert(spark: SparkSession, d: str) -> DataFrame:
    target = L.contacts(spark, d).select("id", "email", "status", "updated_at")
    events = L.outbox(spark, d).where(F.col("event_type") != S.DELETED)
    changes = events.select(
        F.col("aggregate_id").alias("id"),
        F.concat(F.lit("user"), F.col("aggregate_id"), F.lit("@example.com")).alias("email"),
        F.when(F.col("event_type") == S.CREATED, "active").otherwise("inactive").alias("status"),
        F.col("created_at").alias("updated_at"),
        F.col("id").alias("event_id"),
    )
    path = new_work_dir(spark, "upsert")
    layout.upsert(target, changes, "id", ["updated_at", "event_id"]).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "reconcile_counts",
    """with loaded as (select id from docs where created_at < timestamp '1996-01-01 00:00:00')
    select 'contacts' as measure, count(*) as n_rows from contacts
    union all select 'definitions', count(*) from defs
    union all select 'values', count(*) from vals
    union all select 'documents', count(*) from loaded
    union all select 'contacts_without_document', count(*) from contacts where id not in (select id from loaded)
    union all select 'documents_without_contact', count(*) from loaded where id not in (select id from contacts)""",
)
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    loaded = L.documents(spark, d).where("created_at < timestamp_ntz '1996-01-01 00:00:00'")
    return layout.reconcile_counts(
        L.contacts(spark, d), CATALOG.to_dataframe(spark), L.values(spark, d), loaded
    )


@query("full_name", "select id, trim(concat(first_name, ' ', last_name)) as name from contacts")
def full_name(spark: SparkSession, d: str) -> DataFrame:
    return L.contacts(spark, d).select("id", V.full_name(F.col("first_name"), F.col("last_name")).alias("name"))


@query(
    "split_name",
    """select request_id, split_part(trim(name), ' ', 1) as first_name,
    case when strpos(trim(name), ' ') > 0 then substr(trim(name), strpos(trim(name), ' ') + 1) else '' end as last_name
    from new_contacts""",
)
def split_name(spark: SparkSession, d: str) -> DataFrame:
    name = F.trim("name")
    return L.new_contacts(spark, d).select(
        "request_id", V.first_name(name).alias("first_name"), V.last_name(name).alias("last_name")
    )


@query("custom_map_present", "select record_id, api_name, value from eav")
def custom_map_present(spark: SparkSession, d: str) -> DataFrame:
    maps = E.custom_map(L.values(spark, d), CATALOG)
    return maps.select("record_id", F.explode("custom_fields").alias("api_name", "value"))


@query(
    "custom_map_full",
    """select c.id, d.api_name, e.value from contacts c cross join defs d
    left join eav e on e.record_id = c.id and e.api_name = d.api_name""",
)
def custom_map_full(spark: SparkSession, d: str) -> DataFrame:
    wide = E.wide_contacts(L.contacts(spark, d), L.values(spark, d), CATALOG)
    return wide.select("id", F.explode(E.full_map(CATALOG)).alias("api_name", "value"))


NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
KIND_SQL = """case data_type when 'text' then 'TEXT' when 'number' then 'NUMBER' when 'date' then 'DATE'
  when 'select' then 'SELECT' when 'multi_select' then 'SELECT' else 'TEXT' end"""


@query(
    "typed_values",
    rf"""with t as (select v.id, v.value, {KIND_SQL} as kind
      from tenant_vals v join tenant_defs d on d.id = v.field_id)
    select id, kind,
      case when kind = 'NUMBER' and regexp_matches(value, '{NUMBER_RE}') then try_cast(value as double) end as number_value,
      case when kind = 'NUMBER' then try_cast(regexp_extract(value, '^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)', 1) as double) end as number_prefix,
      case when kind = 'DATE' and regexp_matches(value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then cast(try_cast(value as date) as varchar) end as date_value,
      case when kind in ('TEXT', 'SELECT') then value end as text_value
    from t""",
)
def typed_values(spark: SparkSession, d: str) -> DataFrame:
    rows = E.with_definitions(L.tenant_values(spark, d), L.tenant_fields(spark, d))
    kind = V.kind_of_data_type(F.col("data_type"))
    typed = V.typed_columns(F.col("value"), kind)
    return rows.select(
        "id",
        kind.alias("kind"),
        typed["number_value"].alias("number_value"),
        F.when(kind == S.NUMBER, V.to_number(F.col("value"), lenient=True)).alias("number_prefix"),
        V.day_to_text(typed["date_value"]).alias("date_value"),
        typed["text_value"].alias("text_value"),
    )


@query(
    "serialize_values",
    r"""select o_orderkey as id, regexp_replace(cast(o_totalprice as varchar), '\.0$', '') as total,
    cast(cast(o_orderdate as date) as varchar) as order_date, o_orderstatus as status from orders""",
)
def serialize_values(spark: SparkSession, d: str) -> DataFrame:
    return L.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        V.value_to_text(F.col("o_totalprice"), S.NUMBER).alias("total"),
        V.value_to_text(F.col("o_orderdate").cast("date"), S.DATE).alias("order_date"),
        V.value_to_text(F.col("o_orderstatus"), S.TEXT).alias("status"),
    )


@query("email_default", "select id, coalesce(email, '') as email from contacts")
def email_default(spark: SparkSession, d: str) -> DataFrame:
    return L.contacts(spark, d).select("id", V.email_or_empty(F.col("email")).alias("email"))


@query(
    "pack_values",
    """select record_id, string_agg(concat(api_name, ':', data_type, ':', value), '||' order by api_name) as packed
    from eav group by record_id""",
)
def pack_values(spark: SparkSession, d: str) -> DataFrame:
    return E.pack_values(L.values(spark, d), CATALOG)


@query("unpack_values", "select record_id, api_name, data_type, value from eav")
def unpack_values(spark: SparkSession, d: str) -> DataFrame:
    return E.unpack_values(E.pack_values(L.values(spark, d), CATALOG))


@query(
    "field_type_map",
    f"""with k as (select id, data_type, {KIND_SQL} as field_type from tenant_defs)
    select id, data_type, field_type, lower(field_type) as stored_type from k""",
)
def field_type_map(spark: SparkSession, d: str) -> DataFrame:
    kind = V.kind_of_data_type(F.col("data_type"))
    return L.tenant_fields(spark, d).select(
        "id", "data_type", kind.alias("field_type"), V.data_type_of_kind(kind).alias("stored_type")
    )


@query("route_fields", "select distinct api_name, api_name like '%\\_\\_c' escape '\\' as is_custom from tenant_defs")
def route_fields(spark: SparkSession, d: str) -> DataFrame:
    return Q.route_fields(L.tenant_fields(spark, d))


@query(
    "event_to_change",
    """select id as event_id, event_type as type, aggregate_id as contact_id, created_at as event_time,
    case when payload_value is not null then concat('User ', aggregate_id) end as payload_name,
    payload_value as payload_score,
    case when payload_value is not null then created_at end as payload_updated_at
    from outbox""",
)
def event_to_change(spark: SparkSession, d: str) -> DataFrame:
    log = L.outbox(spark, d)
    document = C.document_type(L.PAYLOAD_CATALOG, log.schema["aggregate_id"].dataType)
    changes = C.read_payload(C.to_change(log), document)
    return changes.select(
        "event_id",
        "type",
        "contact_id",
        "event_time",
        F.col("payload.name").alias("payload_name"),
        F.col("payload.custom_fields.score__c").alias("payload_score"),
        F.col("payload.updated_at").alias("payload_updated_at"),
    )


@query(
    "contact_payload",
    """select c.id, coalesce(c.email, '') as email, trim(concat(c.first_name, ' ', c.last_name)) as name, c.created_at,
    coalesce(string_agg(e.api_name || '=' || e.value, ';' order by e.api_name), '') as fields
    from contacts c left join eav e on e.record_id = c.id group by all""",
)
def contact_payload(spark: SparkSession, d: str) -> DataFrame:
    payloads = C.contact_payload(L.contacts(spark, d), L.values(spark, d), CATALOG)
    document = C.document_type(CATALOG, payloads.schema["id"].dataType)
    parsed = payloads.select(F.from_json("payload", document, {"timestampNTZFormat": C.JSON_TIME}).alias("p")).select("p.*")
    entries = [
        F.concat(F.lit(f"{f.api_name}="), V.value_to_text(F.col("custom_fields")[f.api_name], f.kind))
        for f in sorted(CATALOG.fields, key=lambda f: f.api_name)
    ]
    text = F.concat_ws(";", *entries)
    return parsed.select("id", "email", "name", "created_at", text.alias("fields"))


@query(
    "definition_view",
    f"""select id, label, api_name, {KIND_SQL} as field_type, array_to_string(options, ',') as options, is_required,
    is_active, display_order from tenant_defs where is_active""",
)
def definition_view(spark: SparkSession, d: str) -> DataFrame:
    return text_options(Q.definition_view(L.tenant_fields(spark, d)))
