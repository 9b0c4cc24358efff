"""Validation and integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.operators import validation as Q
from fieldweave.sources import lens as L
from fieldweave.workload.registry import query
from fieldweave.workload.tables import KIND_SQL, NUMBER_RE, text_options

CATALOG = L.CONTACT_CATALOG

REASON_SQL = f"""case when value is null then case when is_required then 'required_missing' end
  when kind = 'NUMBER' and not regexp_matches(value, '{NUMBER_RE}') then 'not_number'
  when kind = 'DATE' and not regexp_matches(value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then 'bad_date'
  when kind = 'DATE' and try_cast(value as date) is null then 'no_such_day'
  when kind = 'SELECT' and not coalesce(list_contains(options, value), false) then 'not_in_options' end"""


@query(
    "validate_values",
    f"""with t as (select v.id, v.value, {KIND_SQL} as kind, d.options, d.is_required
      from tenant_vals v join tenant_defs d on d.id = v.field_id)
    select id, value, {REASON_SQL} as reason, {REASON_SQL} is null as is_valid from t""",
)
def validate_values(spark: SparkSession, d: str) -> DataFrame:
    rows = Q.validate_values(L.tenant_values(spark, d), L.tenant_fields(spark, d))
    return rows.select("id", "value", "reason", "is_valid")


@query(
    "validate_contact_values",
    f"""with t as (select v.id, v.value, {KIND_SQL} as kind, d.options, d.is_required from vals v join defs d on d.id = v.field_id)
    select id, {REASON_SQL} as reason from t where {REASON_SQL} is not null""",
)
def validate_contact_values(spark: SparkSession, d: str) -> DataFrame:
    rows = Q.validate_values(L.values(spark, d), CATALOG.to_dataframe(spark))
    return rows.where("not is_valid").select("id", "reason")


@query(
    "validate_definitions",
    f"""with t as (select *, case when not regexp_matches(api_name, '^[a-z][a-z0-9_]*__c$') then 'bad_api_name'
      when {KIND_SQL} = 'SELECT' and coalesce(len(options), 0) = 0 then 'options_missing' end as reason from tenant_defs)
    select id, api_name, data_type, reason, reason is null as is_valid from t""",
)
def validate_definitions(spark: SparkSession, d: str) -> DataFrame:
    return Q.validate_definitions(L.tenant_fields(spark, d)).select("id", "api_name", "data_type", "reason", "is_valid")


@query(
    "validate_contacts",
    r"""with t as (select *, case when email is null or not regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$') then 'bad_email'
      when trim(name) = '' then 'blank_name' end as reason from new_contacts)
    select request_id as id, email, name, reason, reason is null as is_valid from t
    union all
    select cast(id as varchar), email, concat(first_name, ' ', last_name),
      case when email is null or not regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$') then 'bad_email' end,
      email is not null and regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$') from contacts""",
)
def validate_contacts(spark: SparkSession, d: str) -> DataFrame:
    requests = L.new_contacts(spark, d).withColumnRenamed("request_id", "id")
    stored = L.contacts(spark, d).select(
        F.col("id").cast("string").alias("id"), "email", F.concat_ws(" ", "first_name", "last_name").alias("name")
    )
    return Q.validate_contacts(requests.unionByName(stored), F.col("name"))


@query(
    "duplicate_values",
    """select l_orderkey as record_id, cast(l_linenumber as varchar) as field, 'line' as what, count(*) as cnt
    from lineitem group by 1, 2 having count(*) > 1
    union all select record_id, field_id, 'value', count(*) from tenant_vals group by 1, 2 having count(*) > 1
    union all select null, api_name, 'api_name', count(*) from tenant_defs group by 2 having count(*) > 1
    union all select null, email, 'email', count(*) from new_contacts group by 2 having count(*) > 1""",
)
def duplicate_values(spark: SparkSession, d: str) -> DataFrame:
    lines = Q.duplicate_keys(L.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    values = Q.duplicate_keys(L.tenant_values(spark, d), ["record_id", "field_id"])
    names = Q.duplicate_keys(L.tenant_fields(spark, d), ["api_name"])
    emails = Q.duplicate_keys(L.new_contacts(spark, d), ["email"])

    def part(rows: DataFrame, record, field, what: str) -> DataFrame:
        return rows.select(
            record.cast("bigint").alias("record_id"), field.cast("string").alias("field"), F.lit(what).alias("what"), "cnt"
        )

    return (
        part(lines, F.col("l_orderkey"), F.col("l_linenumber"), "line")
        .unionByName(part(values, F.col("record_id"), F.col("field_id"), "value"))
        .unionByName(part(names, F.lit(None), F.col("api_name"), "api_name"))
        .unionByName(part(emails, F.lit(None), F.col("email"), "email"))
    )


@query(
    "orphan_values",
    """select v.id, v.record_id, v.field_id, case when o.o_orderkey is null then 'no_record' else 'no_definition' end as reason
    from tenant_vals v left join (select o_orderkey from orders where o_orderstatus <> 'P') o on o.o_orderkey = v.record_id
    left join (select id from tenant_defs where is_active) t on t.id = v.field_id
    where o.o_orderkey is null or t.id is null""",
)
def orphan_values(spark: SparkSession, d: str) -> DataFrame:
    kept = L.table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    fields = L.tenant_fields(spark, d).where("is_active")
    return Q.orphan_values(L.tenant_values(spark, d), kept, fields).select("id", "record_id", "field_id", "reason")


@query(
    "restricted_definitions",
    """select t.id, t.api_name, count(v.id) as n_values, count(v.id) = 0 as deletable
    from tenant_defs t left join tenant_vals v on v.field_id = t.id
    group by t.id, t.api_name""",
)
def restricted_definitions(spark: SparkSession, d: str) -> DataFrame:
    return Q.definition_use(L.tenant_fields(spark, d), L.tenant_values(spark, d))


@query(
    "null_out_parent",
    """select id, status, case when account_id in (select n_nationkey from nation join region on r_regionkey = n_regionkey
      where r_name = 'ASIA') then null else account_id end as account_id from contacts""",
)
def null_out_parent(spark: SparkSession, d: str) -> DataFrame:
    nation, region = L.table(spark, d, "nation"), L.table(spark, d, "region").where("r_name = 'ASIA'")
    removed = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("id"))
    return Q.null_out_parent(L.contacts(spark, d).select("id", "status", "account_id"), removed)


@query(
    "missing_required",
    """select c.id as record_id, r.api_name from contacts c
    cross join (select api_name from defs where api_name in ('tier__c', 'notes__c', 'contract_start__c')) r
    where not exists (select 1 from eav e where e.record_id = c.id and e.api_name = r.api_name)""",
)
def missing_required(spark: SparkSession, d: str) -> DataFrame:
    names = ["tier__c", "notes__c", "contract_start__c"]
    return Q.missing_required(L.contacts(spark, d), L.values(spark, d), CATALOG.with_required(*names))


@query(
    "upsert_definitions",
    """with b as (select id, concat(label, ' (new)') as label, not is_required as is_required, 'text' as data_type
        from tenant_defs where display_order > 30
      union all select concat('n', cast(s_suppkey as varchar)), s_name, false, 'number' from supplier)
    select coalesce(t.id, b.id) as id, coalesce(b.label, t.label) as label,
      coalesce(t.api_name, concat('field_', b.id, '__c')) as api_name, coalesce(t.data_type, b.data_type) as data_type,
      array_to_string(t.options, ',') as options, coalesce(b.is_required, t.is_required) as is_required
    from tenant_defs t full join b on b.id = t.id""",
)
def upsert_definitions(spark: SparkSession, d: str) -> DataFrame:
    fields = L.tenant_fields(spark, d)
    known = fields.where("display_order > 30").select(
        "id",
        F.concat("label", F.lit(" (new)")).alias("label"),
        (~F.col("is_required")).alias("is_required"),
        F.lit("text").alias("data_type"),
        F.lit("renamed__c").alias("api_name"),
    )
    fresh_id = F.concat(F.lit("n"), F.col("s_suppkey").cast("string"))
    fresh = L.table(spark, d, "supplier").select(
        fresh_id.alias("id"),
        F.col("s_name").alias("label"),
        F.lit(False).alias("is_required"),
        F.lit("number").alias("data_type"),
        F.concat(F.lit("field_"), fresh_id, F.lit("__c")).alias("api_name"),
    )
    batch = known.unionByName(fresh).select(
        "*",
        F.lit(None).cast("array<string>").alias("options"),
        F.lit(True).alias("is_active"),
        F.lit(0).alias("display_order"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
    )
    after = text_options(Q.upsert_definitions(fields, batch))
    return after.select("id", "label", "api_name", "data_type", "options", "is_required")


BY_NAME_SQL = """select min(id) as id, api_name, arg_min(label, id) as label, arg_min(data_type, id) as data_type,
    bool_or(is_required) as is_required from tenant_defs where {} group by api_name"""


@query(
    "upsert_definitions_by_name",
    f"""with t as ({BY_NAME_SQL.format('is_active')}), b as ({BY_NAME_SQL.format('not is_active')})
    select coalesce(t.id, b.id) as id, coalesce(t.api_name, b.api_name) as api_name, coalesce(b.label, t.label) as label,
      coalesce(b.data_type, t.data_type) as data_type, coalesce(t.is_required, b.is_required) as is_required
    from t full join b on b.api_name = t.api_name""",
)
def upsert_definitions_by_name(spark: SparkSession, d: str) -> DataFrame:
    def by_name(rows: DataFrame) -> DataFrame:
        return rows.groupBy("api_name").agg(
            F.min("id").alias("id"),
            F.min_by("label", "id").alias("label"),
            F.min_by("data_type", "id").alias("data_type"),
            F.bool_or("is_required").alias("is_required"),
        )

    fields = L.tenant_fields(spark, d)
    after = Q.upsert_definitions(by_name(fields.where("is_active")), by_name(fields.where("not is_active")), True)
    return after.select("id", "api_name", "label", "data_type", "is_required")


@query(
    "set_active",
    """select id, api_name, case when id in (select concat('p', cast(l_partkey as varchar)) from lineitem where l_quantity = 50)
      then false else is_active end as is_active from tenant_defs""",
)
def set_active(spark: SparkSession, d: str) -> DataFrame:
    bulk = L.table(spark, d, "lineitem").where("l_quantity = 50")
    ids = bulk.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("id"))
    return Q.set_active(L.tenant_fields(spark, d), ids, False).select("id", "api_name", "is_active")


@query("list_active", "select id, label, api_name, created_at from tenant_defs where is_active")
def list_active(spark: SparkSession, d: str) -> DataFrame:
    return Q.list_active(L.tenant_fields(spark, d)).select("id", "label", "api_name", "created_at")
