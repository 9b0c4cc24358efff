"""The library's tables as seen through the star-schema test tables.

Customers with their orders act as contacts with ten custom fields, orders as a
larger second record type, parts as a large table of field definitions, line
items as its values, events as the change log. Each SQL text is valid in Spark
and in DuckDB; ``{name}`` stands for a base table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave.catalog import FieldCatalog, FieldDef
from fieldweave.functions.values import typed_value
from fieldweave.sources.layout import melt

_EPOCH = dt.datetime(2020, 1, 1)


def _catalog(*rows: tuple) -> FieldCatalog:
    return FieldCatalog(
        FieldDef(
            id=f"f{n:02d}",
            api_name=name,
            data_type=data_type,
            label=label,
            options=options,
            display_order=n,
            created_at=_EPOCH + dt.timedelta(days=n),
        )
        for n, (name, label, data_type, options) in enumerate(rows, start=1)
    )


# The ten contact fields. One market segment is left out of the
# department options, so that validation has something to find.
CONTACT_CATALOG = _catalog(
    ("department__c", "Department", "select", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")),
    ("job_title__c", "Job title", "select", ("Intern", "Associate", "Manager", "Director", "VP", "C-Level")),
    ("annual_revenue__c", "Annual revenue", "number", ()),
    ("contract_start__c", "Contract start", "date", ()),
    ("lead_source__c", "Lead source", "text", ()),
    ("last_contact_date__c", "Last contact", "date", ()),
    ("score__c", "Score", "number", ()),
    ("notes__c", "Notes", "text", ()),
    ("region__c", "Region", "select", ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")),
    ("tier__c", "Tier", "select", ("BRONZE", "SILVER", "GOLD", "PLATINUM")),
)

ORDER_CATALOG = _catalog(
    ("status__c", "Status", "select", ("F", "O", "P")),
    ("priority__c", "Priority", "text", ()),
    ("total__c", "Total", "number", ()),
    ("order_date__c", "Order date", "date", ()),
    ("items__c", "Items", "number", ()),
    ("quantity__c", "Quantity", "number", ()),
)

PROFILE_SQL = """
select c.c_custkey as id,
  'Customer' as first_name,
  substring(c.c_name, 10) as last_name,
  case when c.c_custkey % 11 = 10 then null
    else concat(lower(replace(c.c_name, '#', '.')), '@', lower(replace(n.n_name, '_', '-')), '.example.com') end as email,
  case when c.c_acctbal < 0 then 'inactive' else 'active' end as status,
  n.n_nationkey as account_id,
  o.first_o as created_at,
  o.last_o as updated_at,
  c.c_mktsegment as department__c,
  case c.c_custkey % 6 when 0 then 'Intern' when 1 then 'Associate' when 2 then 'Manager'
    when 3 then 'Director' when 4 then 'VP' else 'C-Level' end as job_title__c,
  cast(o.revenue as varchar(40)) as annual_revenue__c,
  cast(cast(o.first_o as date) as varchar(10)) as contract_start__c,
  o.prio as lead_source__c,
  cast(cast(o.last_o as date) as varchar(10)) as last_contact_date__c,
  cast((c.c_custkey * 37) % 101 as varchar(10)) as score__c,
  case when c.c_custkey % 3 = 0 then concat(c.c_mktsegment, ' client from ', r.r_name) end as notes__c,
  r.r_name as region__c,
  case when c.c_custkey % 7 = 0 then null when c.c_acctbal < 2000 then 'BRONZE'
    when c.c_acctbal < 5000 then 'SILVER' when c.c_acctbal < 8000 then 'GOLD' else 'PLATINUM' end as tier__c
from {customer} c
join {nation} n on n.n_nationkey = c.c_nationkey
join {region} r on r.r_regionkey = n.n_regionkey
left join (
  select o_custkey, min(o_orderdate) as first_o, max(o_orderdate) as last_o,
    sum(cast(round(o_totalprice) as bigint)) as revenue, min(o_orderpriority) as prio
  from {orders} group by o_custkey) o on o.o_custkey = c.c_custkey
"""

ORDER_SQL = """
select o.o_orderkey as id, o.o_orderdate as created_at,
  o.o_orderstatus as status__c,
  substring(o.o_orderpriority, 3) as priority__c,
  cast(cast(round(o.o_totalprice) as bigint) as varchar(20)) as total__c,
  cast(cast(o.o_orderdate as date) as varchar(10)) as order_date__c,
  cast(l.items as varchar(10)) as items__c,
  cast(l.qty as varchar(20)) as quantity__c
from {orders} o
left join (select l_orderkey, count(*) as items, sum(cast(l_quantity as bigint)) as qty
  from {lineitem} group by l_orderkey) l on l.l_orderkey = o.o_orderkey
"""

# An event without a payload although its type needs one is a broken event.
OUTBOX_SQL = """
select event_id as id, 'Contact' as aggregate_type, user_id as aggregate_id,
  case event_type when 'signup' then 'CONTACT_CREATED' when 'error' then 'CONTACT_DELETED'
    else 'CONTACT_UPDATED' end as event_type,
  case when event_type <> 'error' and value >= 1 then value end as payload_value,
  case event_id % 10 when 0 then 'FAILED' when 1 then 'PROCESSING' when 2 then 'PENDING'
    when 3 then 'PENDING' else 'DONE' end as status,
  cast(case when event_id % 10 = 0 then cast(floor(event_id / 10.0) as bigint) % 7 else 0 end as int) as retry_count,
  ts as created_at,
  case when event_id % 10 > 3 then ts + interval 1 hour end as processed_at
from {events}
"""

TENANT_FIELDS_SQL = """
select concat('p', cast(p_partkey as varchar(20))) as id, p_name as label,
  concat(case when p_type = 'PROMO' then 'Promo_' else '' end, replace(p_name, ' ', '_'), '_',
    lower(replace(p_brand, '#', '')), case when p_type = 'SMALL' and p_size > 40 then '' else '__c' end) as api_name,
  case p_type when 'LARGE' then 'text' when 'ECONOMY' then 'number' when 'STANDARD' then 'date'
    when 'PROMO' then 'select' when 'MEDIUM' then 'multi_select' else 'currency' end as data_type,
  case when p_type in ('PROMO', 'MEDIUM') and p_size > 5 then {options} end as options,
  p_size > 45 as is_required,
  p_size % 10 <> 0 as is_active,
  p_size as display_order,
  {created_at} as created_at
from {part}
"""

TENANT_VALUES_SQL = """
select concat_ws(':', cast(l_orderkey as varchar(20)), cast(l_linenumber as varchar(20)),
    cast(l_partkey as varchar(20)), cast(l_suppkey as varchar(20))) as id,
  l_orderkey as record_id,
  concat('p', cast(l_partkey as varchar(20))) as field_id,
  case when l_discount = 0 then null
    when l_returnflag = 'R' then cast(cast(l_shipdate as date) as varchar(10))
    when l_returnflag = 'A' then cast(cast(l_quantity as bigint) as varchar(10))
    else l_linestatus end as value
from {lineitem}
"""

# Requests to create contacts: good ones, bad addresses, blank names, addresses
# that exist already, and the same address twice in one batch.
NEW_CONTACTS_SQL = """
select concat('a', cast(s_suppkey as varchar(20))) as request_id,
  case when s_acctbal < 0 then replace(lower(s_name), '#', '.')
    else concat(replace(lower(s_name), '#', '.'), '@example.com') end as email,
  s_name as name
from {supplier}
union all
select concat('b', cast(s_suppkey as varchar(20))),
  concat(replace(lower(s_name), '#', '.'), '@example.com'),
  case when s_acctbal > 9000 then '   ' else concat(' Second ', s_name) end
from {supplier} where s_nationkey < 12
union all
select concat('c', cast(c_custkey as varchar(20))),
  concat(lower(replace(c_name, '#', '.')), '@', lower(replace(n_name, '_', '-')), '.example.com'), c_name
from {customer} join {nation} on n_nationkey = c_nationkey where c_acctbal < 0
"""

NEW_VALUES_SQL = """
select concat('a', cast(s_suppkey as varchar(20))) as request_id, 'score__c' as api_name,
  cast(cast(s_acctbal as bigint) as varchar(20)) as value
from {supplier}
union all
select concat('a', cast(s_suppkey as varchar(20))), 'tier__c',
  case when s_acctbal > 8000 then 'DIAMOND' when s_acctbal > 3000 then 'GOLD' end
from {supplier}
union all
select concat('b', cast(s_suppkey as varchar(20))), 'memo__c', s_name from {supplier} where s_nationkey < 6
"""

UPDATES_SQL = """
select c_custkey as id,
  case when c_acctbal < 0 then '  ' when c_mktsegment = 'BUILDING' then concat(' Builder ', c_mktsegment, ' ') end as name
from {customer} where c_acctbal < 3000
union all
select -1 - s_suppkey, s_name from {supplier}
"""

PATCHES_SQL = """
select c_custkey as record_id, 'tier__c' as api_name,
  case when c_acctbal < 1000 then null else 'GOLD' end as value
from {customer} where c_acctbal < 3000
union all
select c_custkey, 'lead_source__c', 'Referral' from {customer} where c_mktsegment = 'BUILDING'
union all
select c_custkey, 'memo__c', c_name from {customer} where c_acctbal < 0
"""


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table. Its schema is read from the files once, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _sql(spark: SparkSession, sf_dir: str, text: str, *tables: str, **texts: str) -> DataFrame:
    for key, value in texts.items():
        text = text.replace("{" + key + "}", value)
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in tables})


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts with their ten fields as text columns."""
    return _sql(spark, sf_dir, PROFILE_SQL, "customer", "nation", "region", "orders")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir).select(
        "id", "first_name", "last_name", "email", "status", "account_id", "created_at", "updated_at"
    )


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt(profile(spark, sf_dir), CONTACT_CATALOG)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table, typed from the wide table. ``build_documents`` gives
    the same rows from the EAV tables."""
    fields = [typed_value(F.col(f.api_name), f.kind).alias(f.api_name) for f in CONTACT_CATALOG.fields]
    return profile(spark, sf_dir).select(
        "id",
        "email",
        F.concat_ws(" ", "first_name", "last_name").alias("name"),
        F.struct(*fields).alias("custom_fields"),
        "created_at",
        "updated_at",
    )


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, ORDER_SQL, "orders", "lineitem")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at")
    )


def order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = order_profile(spark, sf_dir).withColumn("updated_at", F.col("created_at"))
    return melt(wide, ORDER_CATALOG)


# The document a change event carries; its custom fields are the two the events have.
PAYLOAD_CATALOG = CONTACT_CATALOG.subset(["lead_source__c", "score__c"])


def outbox_of_events(events: DataFrame) -> DataFrame:
    """Change log rows of an event table or event stream."""
    from fieldweave.operators.changes import payload_json

    log = events.sparkSession.sql(OUTBOX_SQL, events=events)
    document = payload_json(
        id=F.col("aggregate_id"),
        email=F.concat(F.lit("user"), F.col("aggregate_id"), F.lit("@example.com")),
        name=F.concat(F.lit("User "), F.col("aggregate_id")),
        custom_fields=F.struct(
            F.col("event_type").alias("lead_source__c"), F.col("payload_value").alias("score__c")
        ),
        created_at=F.col("created_at"),
        updated_at=F.col("created_at"),
    )
    return log.select(
        "id",
        "aggregate_type",
        "aggregate_id",
        "event_type",
        F.when(F.col("payload_value").isNotNull(), document).alias("payload"),
        "status",
        "retry_count",
        F.lit(None).cast("string").alias("error_message"),
        "created_at",
        "processed_at",
    )


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox_of_events(table(spark, sf_dir, "events"))


def outbox_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as a file stream over the event table, one file or a folder."""
    schema = table(spark, sf_dir, "events").schema
    return outbox_of_events(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"))


def tenant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition table that grows with the data."""
    return _sql(
        spark,
        sf_dir,
        TENANT_FIELDS_SQL,
        "part",
        options="array('F', p_brand)",
        created_at="cast(date_add(date '2020-01-01', p_size) as timestamp_ntz)",
    )


def tenant_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, TENANT_VALUES_SQL, "lineitem")


def new_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, NEW_CONTACTS_SQL, "supplier", "customer", "nation")


def new_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, NEW_VALUES_SQL, "supplier")


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, UPDATES_SQL, "customer", "supplier")


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PATCHES_SQL, "customer")




