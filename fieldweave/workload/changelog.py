"""Change log, batch writes and sync."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.operators import changes as C
from fieldweave.operators import maintained as M
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import Sort
from fieldweave.plans.search import search_columns, search_documents
from fieldweave.plans.spec import SearchSpec
from fieldweave.session import new_work_dir, settle
from fieldweave.sources import lens as L
from fieldweave.sources.buckets import create_buckets, read_buckets, upsert_buckets
from fieldweave.sources.rebuild import catch_up, read_served, rebuild
from fieldweave.streaming.sync import stream_sync, synced_documents, write_batch
from fieldweave.workload.registry import query
from fieldweave.workload.tables import DOC_SQL, flat

CATALOG = L.CONTACT_CATALOG
AS_OF = "2024-02-01 00:00:00"
CUTOFF = "2024-01-27 00:00:00"


def as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp_ntz")


def event_sql(batch: str, kind: str) -> str:
    return f"md5(concat_ws('|', '{batch}', {kind}, cast(id as varchar)))"


@query(
    "append_outbox",
    f"""with c as (select id, case when status = 'inactive' then 'CONTACT_DELETED' else 'CONTACT_CREATED' end as event_type from contacts)
    select {event_sql('b1', 'event_type')} as id, id as aggregate_id, event_type, 'PENDING' as status, 0 as retry_count,
    case when event_type = 'CONTACT_DELETED' then concat('{{"id":', id, '}}') end as deleted, timestamp '{AS_OF}' as created_at from c""",
)
def append_outbox(spark: SparkSession, d: str) -> DataFrame:
    contacts = L.contacts(spark, d)
    payloads = C.contact_payload(contacts, L.values(spark, d), CATALOG)
    kind = F.when(F.col("status") == "inactive", S.DELETED).otherwise(S.CREATED)
    rows = payloads.join(contacts.select("id", kind.alias("event_type")), "id")
    log = C.emit(rows, "b1", as_of())
    deleted = F.when(F.col("event_type") == S.DELETED, F.col("payload"))
    return log.select("id", "aggregate_id", "event_type", "status", "retry_count", deleted.alias("deleted"), "created_at")


TAKEN_SQL = """select request_id, email, name,
      case when email is null or not regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') then 'bad_email'
        when trim(name) = '' then 'blank_name' end as formal from new_contacts"""
FIELD_SQL = """select n.request_id, n.api_name, case when d.api_name is null then 'unknown_field'
        when n.value is not null and d.data_type = 'number' and try_cast(n.value as double) is null then 'not_number'
        when n.value is not null and d.data_type = 'select' and not list_contains(d.options, n.value) then 'not_in_options' end as reason
      from new_vals n left join defs d on d.api_name = n.api_name"""


@query(
    "apply_create",
    f"""with f as ({TAKEN_SQL}),
    b as (select request_id, arg_min(reason, api_name) as bad from ({FIELD_SQL}) where reason is not null group by 1),
    g as (select f.*, coalesce(f.formal, b.bad) as fault from f left join b on b.request_id = f.request_id),
    t as (select *, coalesce(fault, case when email in (select email from contacts where email is not null) then 'known_email'
      when request_id > min(case when fault is null then request_id end) over (partition by email) then 'repeated_email' end) as reason from g),
    n as (select request_id, count(distinct api_name) as n from new_vals where value is not null group by 1)
    select t.request_id, t.reason,
      case when t.reason is null then md5(concat('contact:b1|', t.request_id)) end as id,
      case when t.reason is null then split_part(trim(t.name), ' ', 1) end as first_name,
      case when t.reason is null then coalesce(n.n, 0) end as n_values,
      case when t.reason is null then 'CONTACT_CREATED' end as event_type
    from t left join n on n.request_id = t.request_id""",
)
def apply_create(spark: SparkSession, d: str) -> DataFrame:
    made = C.create_contacts(
        L.new_contacts(spark, d),
        L.new_values(spark, d),
        L.contacts(spark, d),
        CATALOG.to_dataframe(spark),
        CATALOG,
        "b1",
        as_of(),
    )
    requests = L.new_contacts(spark, d).select("request_id", C.contact_id("b1", F.col("request_id")).alias("id"))
    counts = made.values.groupBy(F.col("record_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    accepted = (
        made.contacts.select("id", "first_name")
        .join(made.events.select(F.col("aggregate_id").alias("id"), "event_type"), "id")
        .join(counts, "id", "left")
        .join(requests, "id")
        .select(
            "request_id",
            F.lit(None).cast("string").alias("reason"),
            "id",
            "first_name",
            F.coalesce("n", F.lit(0)).alias("n_values"),
            "event_type",
        )
    )
    return accepted.unionByName(made.rejected.select("request_id", "reason"), allowMissingColumns=True)


PATCH_REASON_SQL = """select p.record_id, arg_min(case when d.api_name is null then 'unknown_field'
        when d.data_type = 'select' and not list_contains(d.options, p.value) then 'not_in_options' end, p.api_name) as bad
      from patches p left join defs d on d.api_name = p.api_name
      where d.api_name is null or (p.value is not null and d.data_type = 'select' and not list_contains(d.options, p.value))
      group by 1"""
UPDATE_SQL = f"""judged as (select u.id, u.name, coalesce(case when c.id is null then 'unknown_contact' when trim(u.name) = '' then 'blank_name' end, b.bad) as reason
      from (select id, max(name) as name from (select id, name from upd union all select record_id, null from patches) group by id) u
      left join contacts c on c.id = u.id left join ({PATCH_REASON_SQL}) b on b.record_id = u.id)"""


def updated(spark: SparkSession, d: str) -> C.Written:
    return C.update_contacts(
        L.updates(spark, d),
        L.patches(spark, d),
        L.contacts(spark, d),
        L.values(spark, d),
        CATALOG,
        CATALOG.to_dataframe(spark),
        "b1",
        as_of(),
    )


@query(
    "apply_update",
    f"""with {UPDATE_SQL}, good as (select id, trim(name) as name from judged where reason is null)
    select c.id, case when g.name is not null then split_part(g.name, ' ', 1) else c.first_name end as first_name,
      case when g.name is not null then substr(g.name, strpos(g.name, ' ') + 1) else c.last_name end as last_name,
      c.email, c.status, case when g.id is not null then timestamp '{AS_OF}' else c.updated_at end as updated_at,
      cast(null as varchar) as reason
    from contacts c left join good g on g.id = c.id
    union all select id, null, null, null, null, null, reason from judged where reason is not null""",
)
def apply_update(spark: SparkSession, d: str) -> DataFrame:
    done = updated(spark, d)
    after = done.contacts.select("id", "first_name", "last_name", "email", "status", "updated_at")
    return after.withColumn("reason", F.lit(None).cast("string")).unionByName(
        done.rejected.select("id", "reason"), allowMissingColumns=True
    )


@query(
    "apply_update_values",
    f"""with {UPDATE_SQL}, p as (select p.record_id, d.id as field_id, p.value from patches p join defs d on d.api_name = p.api_name
      where p.record_id in (select id from judged where reason is null))
    select coalesce(v.id, md5(concat('value:', p.record_id, '|', p.field_id))) as id,
      coalesce(v.record_id, p.record_id) as record_id, coalesce(v.field_id, p.field_id) as field_id,
      case when v.id is null then timestamp '{AS_OF}' else v.created_at end as created_at,
      case when p.record_id is not null then timestamp '{AS_OF}' else v.updated_at end as updated_at,
      case when p.record_id is not null then p.value else v.value end as value
    from vals v full join p on p.record_id = v.record_id and p.field_id = v.field_id
    where case when p.record_id is not null then p.value else v.value end is not null""",
)
def apply_update_values(spark: SparkSession, d: str) -> DataFrame:
    return updated(spark, d).values


@query(
    "merge_custom_fields",
    """with p as (select p.record_id, d.id as field_id, p.value from patches p join defs d on d.api_name = p.api_name)
    select coalesce(v.record_id, p.record_id) as record_id, coalesce(v.field_id, p.field_id) as field_id,
      case when p.record_id is not null then p.value else v.value end as value
    from vals v full join p on p.record_id = v.record_id and p.field_id = v.field_id
    where case when p.record_id is not null then p.value else v.value end is not null""",
)
def merge_custom_fields(spark: SparkSession, d: str) -> DataFrame:
    ids = CATALOG.to_dataframe(spark).select("api_name", F.col("id").alias("field_id"))
    patches = L.patches(spark, d).join(ids, "api_name").select("record_id", "field_id", "value")
    return C.merge_fields(L.values(spark, d).select("record_id", "field_id", "value"), patches)


@query(
    "replace_values",
    """with touched as (select id, status from contacts where status = 'inactive')
    select record_id, field_id, value from vals where record_id not in (select id from touched)
    union all select id, 'f07', '0' from touched union all select id, 'f08', status from touched""",
)
def replace_values(spark: SparkSession, d: str) -> DataFrame:
    touched = L.contacts(spark, d).where("status = 'inactive'").select("id", "status")
    fresh = touched.select(
        F.col("id").alias("record_id"),
        F.inline(
            F.array(
                F.struct(F.lit("f07").alias("field_id"), F.lit("0").alias("value")),
                F.struct(F.lit("f08").alias("field_id"), F.col("status").alias("value")),
            )
        ),
    )
    return C.replace_values(L.values(spark, d), fresh, touched)


@query(
    "apply_delete",
    f"""with ids as (select distinct user_id as id from events where event_type = 'error' union select -1 - s_suppkey from supplier),
    left_over as (select id from contacts where id not in (select id from ids))
    select 'contact' as part, cast(id as varchar) as id, 1 as n from left_over
    union all select 'values', cast(record_id as varchar), count(*) from vals where record_id in (select id from left_over) group by record_id
    union all select 'event', {event_sql('b1', "'CONTACT_DELETED'")}, 1 from ids where id in (select id from contacts)
    union all select 'refused', cast(id as varchar), 1 from ids where id not in (select id from contacts)""",
)
def apply_delete(spark: SparkSession, d: str) -> DataFrame:
    erring = L.table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").alias("id"))
    unknown = L.table(spark, d, "supplier").select((-1 - F.col("s_suppkey")).alias("id"))
    done = C.delete_contacts(erring.unionByName(unknown), L.contacts(spark, d), L.values(spark, d), "b1", as_of())

    def part(name: str, rows: DataFrame, key: str) -> DataFrame:
        counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return counted.select(F.lit(name).alias("part"), F.col(key).cast("string").alias("id"), "n")

    return (
        part("contact", done.contacts, "id")
        .unionByName(part("values", done.values, "record_id"))
        .unionByName(part("event", done.events, "id"))
        .unionByName(part("refused", done.rejected, "id"))
    )


APPLIED_SQL = """good as (select * from outbox where event_type = 'CONTACT_DELETED' or payload_value is not null),
    last as (select aggregate_id as id, arg_max(event_type, (created_at, id)) as event_type,
      arg_max(payload_value, (created_at, id)) as score, max(created_at) as ts from good group by 1),
    written as (select id, concat('user', id, '@example.com') as email, concat('User ', id) as name,
      event_type as lead_source__c, cast(null as varchar) as tier__c, score as score__c, ts as updated_at
      from last where event_type <> 'CONTACT_DELETED')"""
DOC_NAMES = "id, email, name, lead_source__c, tier__c, score__c, updated_at"


def shown(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id", "email", "name", "custom_fields.lead_source__c", "custom_fields.tier__c", "custom_fields.score__c", "updated_at"
    )


@query(
    "apply_changes",
    f"""with {APPLIED_SQL}
    select {DOC_NAMES}, 'document' as part from docs where id not in (select id from last)
    union all select {DOC_NAMES}, 'document' from written
    union all select id, event_type, null, null, null, null, created_at, 'rejected' from outbox
      where event_type <> 'CONTACT_DELETED' and payload_value is null""",
)
def apply_changes(spark: SparkSession, d: str) -> DataFrame:
    applied = C.apply_changes(L.documents(spark, d), C.to_change(L.outbox(spark, d)), catalog=CATALOG)
    rejected = applied.rejected.select(
        F.col("event_id").alias("id"), F.col("type").alias("email"), F.col("event_time").alias("updated_at"), F.lit("rejected").alias("part")
    )
    return shown(applied.documents).withColumn("part", F.lit("document")).unionByName(rejected, allowMissingColumns=True)


@query(
    "stream_sync",
    f"""with {APPLIED_SQL}
    select {DOC_NAMES} from docs where id not in (select id from last) union all select {DOC_NAMES} from written""",
)
def stream(spark: SparkSession, d: str) -> DataFrame:
    log = L.outbox_stream(spark, d)
    work = new_work_dir(spark, "sync")
    docs = L.documents(spark, d)
    document = C.document_type(CATALOG, log.schema["aggregate_id"].dataType)
    stream_sync(log, document, f"{work}/target", f"{work}/checkpoint", catalog=CATALOG).awaitTermination()
    return shown(synced_documents(spark, f"{work}/target", docs, catalog=CATALOG))


@query(
    "claim_pending",
    f"""with c as (select id from outbox where status = 'PENDING' order by created_at, id limit 100)
    select id, aggregate_id, event_type, case when id in (select id from c) then 'PROCESSING' else status end as status,
    retry_count, created_at, case when id in (select id from c) then timestamp '{AS_OF}' end as claimed_at from outbox""",
)
def claim_pending(spark: SparkSession, d: str) -> DataFrame:
    log = C.claim_pending(L.outbox(spark, d), as_of())
    return log.select("id", "aggregate_id", "event_type", "status", "retry_count", "created_at", "claimed_at")


@query(
    "claim_retryable",
    f"""with c as (select id from outbox where status = 'FAILED' and retry_count < 5 order by created_at, id limit 50)
    select id, aggregate_id, event_type, case when id in (select id from c) then 'PROCESSING' else status end as status,
    retry_count, created_at, case when id in (select id from c) then timestamp '{AS_OF}' end as claimed_at from outbox""",
)
def claim_retryable(spark: SparkSession, d: str) -> DataFrame:
    log = C.claim_retryable(L.outbox(spark, d), as_of())
    return log.select("id", "aggregate_id", "event_type", "status", "retry_count", "created_at", "claimed_at")


@query(
    "stale_claims",
    f"""select id, created_at, cast(null as timestamp) as claimed_at from outbox
    where status = 'PROCESSING' and created_at < timestamp '{CUTOFF}'""",
)
def stale_claims(spark: SparkSession, d: str) -> DataFrame:
    """Of a log after a claim: what was claimed just now is not stale, however old it is."""
    log = C.claim_pending(L.outbox(spark, d), as_of())
    return C.stale_claims(log, as_of(CUTOFF)).select("id", "created_at", "claimed_at")


@query(
    "finish_event",
    f"""with r as (select id, case when event_type = 'CONTACT_CREATED' then 'PENDING'
        when event_type = 'CONTACT_UPDATED' and payload_value is null then 'FAILED' else 'DONE' end as outcome
      from outbox where status = 'PROCESSING')
    select o.id, coalesce(r.outcome, o.status) as status,
      o.retry_count + case when r.outcome = 'FAILED' then 1 else 0 end as retry_count,
      case when r.outcome = 'FAILED' then 'no payload' end as error_message,
      case when r.outcome = 'DONE' then timestamp '{AS_OF}' else o.processed_at end as processed_at
    from outbox o left join r on r.id = o.id""",
)
def finish_event(spark: SparkSession, d: str) -> DataFrame:
    log = L.outbox(spark, d)
    broken = (F.col("event_type") == S.UPDATED) & F.col("payload").isNull()
    outcome = F.when(F.col("event_type") == S.CREATED, S.PENDING).when(broken, S.FAILED).otherwise(S.DONE)
    results = log.where(F.col("status") == S.PROCESSING).select(
        "id", outcome.alias("status"), F.lit("no payload").alias("error")
    )
    done = C.finish_events(log, results, as_of())
    return done.select("id", "status", "retry_count", "error_message", "processed_at")


@query(
    "purge_done",
    f"""select cast(id as varchar) as id, status, processed_at from outbox
    where not (status = 'DONE' and processed_at < timestamp '{CUTOFF}' - interval 7 day)
    union all select 'purged', cast(count(*) as varchar), null from outbox
    where status = 'DONE' and processed_at < timestamp '{CUTOFF}' - interval 7 day""",
)
def purge_done(spark: SparkSession, d: str) -> DataFrame:
    kept, purged = C.purge_done(L.outbox(spark, d), as_of(CUTOFF))
    rows = kept.select(F.col("id").cast("string").alias("id"), "status", "processed_at")
    report = purged.select(
        F.lit("purged").alias("id"), F.col("purged").cast("string").alias("status"), F.lit(None).cast("timestamp_ntz").alias("processed_at")
    )
    return rows.unionByName(report)


REINDEX_SQL = f"{event_sql('r1', chr(39) + 'CONTACT_UPDATED' + chr(39))} as id, id as aggregate_id, 'CONTACT_UPDATED' as event_type"


@query("reindex_all", f"select {REINDEX_SQL}, trim(concat(first_name, ' ', last_name)) as name from contacts")
def reindex_all(spark: SparkSession, d: str) -> DataFrame:
    log = C.reindex(L.contacts(spark, d), L.values(spark, d), CATALOG, "r1", as_of())
    return log.select("id", "aggregate_id", "event_type", F.get_json_object("payload", "$.name").alias("name"))


# A missing address is empty text in a payload.
@query("reindex_apply", f"select * replace (coalesce(email, '') as email) from (select {DOC_SQL} from docs)")
def reindex_apply(spark: SparkSession, d: str) -> DataFrame:
    """Older documents, all reindexed: every field comes through the log as it is built."""
    log = C.reindex(L.contacts(spark, d), L.values(spark, d), CATALOG, "r1", as_of())
    older = L.documents(spark, d).withColumn("name", F.lit("old"))
    older = older.withColumn("custom_fields", F.col("custom_fields").withField("score__c", F.lit(None).cast("double")))
    return flat(C.apply_changes(older, C.to_change(log)).documents)


@query(
    "document_new_field",
    """with m as (select c.id, max(case when e.api_name = 'score__c' then cast(e.value as double) end) as score,
        max(case when e.api_name = 'tier__c' then e.value end) as tier
      from contacts c left join eav e on e.record_id = c.id where c.status = 'active' group by c.id),
    p as (select id, score from m where score > 40 order by score desc, id limit 50)
    select 'page' as part, cast(id as varchar) as key, score, (select count(*) from m where score > 40) as n from p
    union all select 'group', tier, null, count(*) from m where tier is not null group by tier""",
)
def document_new_field(spark: SparkSession, d: str) -> DataFrame:
    """Fields that were defined after the document table was built, filled by the log
    for active contacts only: filter, sort and groups on them."""
    contacts = L.contacts(spark, d).where("status = 'active'")
    values = L.values(spark, d).join(contacts.select(F.col("id").alias("record_id")), "record_id", "left_semi")
    log = C.reindex(contacts, values, CATALOG, "r1", as_of())
    older = L.documents(spark, d)
    older = older.withColumn("custom_fields", F.col("custom_fields").dropFields("score__c", "tier__c"))
    documents = C.apply_changes(older, C.to_change(log), catalog=CATALOG).documents
    spec = SearchSpec(filters=(Filter("score__c", "gt", 40),), sort=(Sort("score__c", "desc"),), page_size=50, group_by="tier__c")
    found = search_documents(documents, CATALOG, spec)
    rows = found.page.select(
        F.lit("page").alias("part"), F.col("id").cast("string").alias("key"), F.col("custom_fields.score__c").alias("score"),
        found.total.scalar().alias("n"),
    )
    groups = found.groups.select(F.lit("group").alias("part"), "key", F.lit(None).cast("double").alias("score"), F.col("cnt").alias("n"))
    return rows.unionByName(groups)


@query(
    "reindex_some",
    f"""with ids as (select distinct user_id as id from events where event_type = 'signup' union select -1 - s_suppkey from supplier)
    select {REINDEX_SQL} from ids where id in (select id from contacts)
    union all select 'unknown', id, null from ids where id not in (select id from contacts)""",
)
def reindex_some(spark: SparkSession, d: str) -> DataFrame:
    signed = L.table(spark, d, "events").where("event_type = 'signup'").select(F.col("user_id").alias("id"))
    unknown = L.table(spark, d, "supplier").select((-1 - F.col("s_suppkey")).alias("id"))
    log, refused = C.reindex_some(
        signed.unionByName(unknown), L.contacts(spark, d), L.values(spark, d), CATALOG, "r1", as_of()
    )
    return log.select("id", "aggregate_id", "event_type").unionByName(
        refused.select(
            F.lit("unknown").alias("id"), F.col("id").alias("aggregate_id"), F.lit(None).cast("string").alias("event_type")
        )
    )


@query("dedupe_events", "select id as event_id, event_type as type, aggregate_id as contact_id, created_at as event_time from outbox")
def dedupe_events(spark: SparkSession, d: str) -> DataFrame:
    changes = C.to_change(L.outbox(spark, d))
    twice = changes.unionByName(C.to_change(L.outbox(spark, d).where(F.col("status") != S.DONE)))
    return C.dedupe_events(twice).select("event_id", "type", "contact_id", "event_time")




@query(
    "write_upsert_buckets",
    """with last as (
      select aggregate_id as id, arg_max(event_type, (created_at, id)) as event_type, max(created_at) as updated_at
      from outbox where event_type <> 'CONTACT_CREATED' group by 1)
    select c.id, c.email, c.status, c.updated_at from contacts c where c.id not in (select id from last)
    union all select id, concat('user', id, '@example.com'), 'inactive', updated_at from last where event_type <> 'CONTACT_DELETED'""",
)
def write_upsert_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Changes and deletes in two batches, split by time, on a table in buckets; then the first batch once more."""
    target = L.contacts(spark, d).select("id", "email", "status", "updated_at")
    events = L.outbox(spark, d).where(F.col("event_type") != S.CREATED)
    changes = events.select(
        F.col("aggregate_id").alias("id"),
        F.concat(F.lit("user"), F.col("aggregate_id"), F.lit("@example.com")).alias("email"),
        F.lit("inactive").alias("status"),
        F.col("created_at").alias("updated_at"),
        F.col("id").alias("event_id"),
        (F.col("event_type") == S.DELETED).alias("gone"),
    )
    path = new_work_dir(spark, "bucket-table")
    create_buckets(target, path, "id", 8)
    middle = changes.agg(F.median(F.unix_timestamp(F.col("updated_at").cast("timestamp")))).first()[0]
    early = F.unix_timestamp(F.col("updated_at").cast("timestamp")) <= F.lit(middle)
    for batch, part in ((1, changes.where(early)), (2, changes.where(~early)), (1, changes.where(early))):
        upsert_buckets(part, path, batch, ["updated_at", "event_id"], F.col("gone"))
    return read_buckets(spark, path)


MIDDLE_SQL = "(select quantile_disc(created_at, 0.5) from outbox)"


@query(
    "reindex_swap",
    f"""with good as (select * from outbox where created_at > {MIDDLE_SQL} and (event_type = 'CONTACT_DELETED' or payload_value is not null)),
    last as (select aggregate_id as id, arg_max(event_type, (created_at, id)) as event_type,
      arg_max(payload_value, (created_at, id)) as score, max(created_at) as ts from good group by 1)
    select 'before' as part, id, 'old' as name, null::double as score from docs
    union all select 'after', id, name, score__c from docs where id not in (select id from last)
    union all select 'after', id, concat('User ', id), score from last where event_type <> 'CONTACT_DELETED'""",
)
def reindex_swap(spark: SparkSession, d: str) -> DataFrame:
    """A rebuild as of the middle of the log, while old documents are served; later events reach it before the swap and,
    the last twentieth of the log after it."""
    path = new_work_dir(spark, "served")
    log = L.outbox(spark, d)
    changes = C.to_change(log)
    micros = F.unix_micros(F.col("created_at").cast("timestamp"))
    times = log.select(micros.alias("at")).agg(*(F.expr(f"percentile_disc({p}) within group (order by at)").cast("long") for p in (0.5, 0.95))).first()
    middle, late = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t) for t in times)
    older = L.documents(spark, d).withColumn("name", F.lit("old")).withColumn("custom_fields", F.col("custom_fields").withField("score__c", F.lit(None).cast("double")))
    rebuild(older, path, "first", middle, changes.limit(0), CATALOG)
    before = read_served(spark, path)
    rebuild(L.documents(spark, d), path, "second", middle, changes.where(F.col("event_time") <= F.lit(late.isoformat(sep=" ")).cast("timestamp_ntz")), CATALOG)
    catch_up(spark, path, "third", changes, CATALOG)
    parts = (("before", before), ("after", read_served(spark, path)))
    shown_parts = [rows.select(F.lit(name).alias("part"), "id", "name", F.col("custom_fields.score__c").alias("score")) for name, rows in parts]
    return shown_parts[0].unionByName(shown_parts[1])


@query(
    "sync_tiers",
    f"""with {APPLIED_SQL}
    select {DOC_NAMES} from docs where id not in (select id from last) union all select {DOC_NAMES} from written""",
)
def sync_tiers(spark: SparkSession, d: str) -> DataFrame:
    """The log in nine batches out of order, whose runs are merged in tiers of two."""
    log, docs = L.outbox(spark, d), L.documents(spark, d)
    target = f"{new_work_dir(spark, 'tiers')}/target"
    document = C.widened_type(C.document_type(CATALOG, log.schema["aggregate_id"].dataType), CATALOG)
    for batch in range(9):
        write_batch(log.where(F.pmod(F.xxhash64("id"), F.lit(9)) == batch), batch, document, target, fan=2)
    return shown(synced_documents(spark, target, docs, catalog=CATALOG))


AFTER_SQL = f"""{APPLIED_SQL},
    after as (select id, email, name, job_title__c, department__c, region__c, tier__c, lead_source__c, notes__c from docs
      where id not in (select id from last)
      union all select id, email, name, null, null, null, tier__c, lead_source__c, null from written)"""


def maintained(spark: SparkSession, d: str, derived: dict[str, M.Derived]) -> str:
    """The path of a table of documents that all events of the log were applied to, in three batches that do not go by time,
    the first of them twice."""
    docs, log = L.documents(spark, d), L.outbox(spark, d)
    fields = search_columns(CATALOG)
    path = new_work_dir(spark, "maintained-documents")
    M.create_maintained(docs.select("id", *[c.alias(n) for n, c in fields.items()]), derived, path, 16, log.schema["id"].dataType.simpleString())
    good, _ = C.split_changes(C.to_change(log), C.document_type(CATALOG, log.schema["aggregate_id"].dataType))
    read = good.select("type", "contact_id", "event_time", "event_id", "payload.*")
    changes = settle(M.versioned(read, fields), "versioned-changes")
    for batch, part in enumerate((2, 0, 1, 2), 1):
        M.apply_to_maintained(changes.where(F.pmod("event_id", F.lit(3)) == part), derived, path, batch, fan=3)
    return path


@query(
    "terms_from_changes",
    f"""with {AFTER_SQL}
    select 'lead_source__c' as field, lead_source__c as value, count(*) as n from after group by lead_source__c
    union all select 'tier__c', tier__c, count(*) from after group by tier__c""",
)
def terms_from_changes(spark: SparkSession, d: str) -> DataFrame:
    derived = {"terms": M.term_counts(["lead_source__c", "tier__c"])}
    return M.read_derived(spark, maintained(spark, d, derived), "terms")


@query(
    "ngram_index_apply",
    rf"""with {AFTER_SQL},
    long_text as ({" union all ".join(f"select id, '{f}' as field, lower({f}) as txt from after" for f in S.SEARCH_FIELDS)}),
    run as (select id, field, unnest(regexp_extract_all(txt, '[\p{{L}}\p{{Nd}}]+')) as r from long_text where txt is not null),
    start as (select id, field, r, unnest(range(1, length(r))) as pos from run where length(r) >= 2),
    gram as (select id, field, substr(r, pos, g) as gram from (select id, field, r, pos, unnest(range(2, 11)) as g from start)
      where pos + g - 1 <= length(r))
    select field, gram, count(distinct id) as n_docs, count(*) as total_tf from gram group by field, gram""",
)
def ngram_index_apply(spark: SparkSession, d: str) -> DataFrame:
    derived = {"postings": M.postings({n: F.col(n) for n in S.SEARCH_FIELDS})}
    postings = M.read_derived(spark, maintained(spark, d, derived), "postings")
    return postings.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("total_tf"))
