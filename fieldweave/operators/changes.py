"""The change log: writing it, claiming from it and applying it to both layouts.

Ids are hashes of what they name, not random: a task that runs again after an
executor is lost writes the same ids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog
from fieldweave.functions.values import first_name, full_name, last_name, typed_value
from fieldweave.operators import validation as V
from fieldweave.operators.eav import pivot
from fieldweave.operators.keys import listed, spread
from fieldweave.operators.predicates import base_columns
from fieldweave.session import settle

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_KIND_TYPES = {S.NUMBER: T.DoubleType(), S.DATE: T.DateType()}

DOCUMENT_COLUMNS = ("id", "email", "name", "custom_fields", "created_at", "updated_at")
#: Column of documents with the text of custom fields that their struct does not have.
OTHER_FIELDS = "other_fields"
_OTHER_TYPE = T.MapType(T.StringType(), T.StringType())
VERSION = ("event_time", "event_id")
_CORRUPT = "_corrupt"


def payload_json(**parts: Column) -> Column:
    """A document as the JSON text of a change event."""
    return F.to_json(
        F.struct(*[c.alias(name) for name, c in parts.items()]), {"timestampNTZFormat": JSON_TIME}
    )


def document_type(catalog: FieldCatalog, key_type: T.DataType | None = None) -> T.StructType:
    """Type of a document whose custom fields are the catalog's."""
    fields = [T.StructField(f.api_name, _KIND_TYPES.get(f.kind, T.StringType())) for f in catalog.fields]
    return T.StructType(
        [
            T.StructField("id", key_type or T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("custom_fields", T.StructType(fields)),
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("updated_at", T.TimestampNTZType()),
        ]
    )


def merged_type(*types: T.StructType) -> T.StructType:
    """The fields of all types; of one name the first holds."""
    fields: dict[str, T.StructField] = {}
    for type_ in types:
        for f in type_.fields:
            fields.setdefault(f.name, f)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def widened_type(document: T.StructType, catalog: FieldCatalog | None) -> T.StructType:
    """A document's type with the fields of the catalog that it does not have."""
    custom = document["custom_fields"].dataType
    if catalog is None or not isinstance(custom, T.StructType):
        return document
    wide = merged_type(custom, document_type(catalog)["custom_fields"].dataType)
    return T.StructType([T.StructField(f.name, wide if f.name == "custom_fields" else f.dataType) for f in document.fields])


def widened(documents: DataFrame, custom: T.DataType) -> DataFrame:
    """Documents whose custom fields are those of the type, and then any others they
    have. A field that is null in a document is read from its ``other_fields``, as
    the document may be from before the field was defined; text that is not of the
    field's type stays there."""
    stored = documents.schema["custom_fields"].dataType
    kept = F.col(OTHER_FIELDS) if OTHER_FIELDS in documents.columns else F.lit(None).cast(_OTHER_TYPE)
    if not isinstance(stored, T.StructType) or not isinstance(custom, T.StructType):
        return documents.withColumn(OTHER_FIELDS, kept)
    old, fields, moved = F.col("custom_fields"), [], [F.lit(None).cast("string")]
    for f in merged_type(custom, stored).fields:
        kind = next((k for k, t in _KIND_TYPES.items() if t == f.dataType), S.TEXT)
        value = typed_value(F.try_element_at(kept, F.lit(f.name)), kind).try_cast(f.dataType)
        moved.append(F.when(value.isNotNull(), F.lit(f.name)))
        fields.append((F.coalesce(old[f.name], value) if f.name in stored.fieldNames() else value).alias(f.name))
    names = F.array_compact(F.array(*moved))
    rest = F.map_filter(kept, lambda k, v: ~F.array_contains(names, k))
    return documents.withColumns(
        {
            "custom_fields": F.when(old.isNotNull() | (F.size(names) > 0), F.struct(*fields)),
            OTHER_FIELDS: F.when(F.size(rest) > 0, rest),
        }
    )


def contact_payload(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, base_fields: bool = False) -> DataFrame:
    """(id, payload): the full contact as event payload, present fields only, numbers
    and dates typed as in the documents. A value that breaks its type is left out, as
    it is null in a built document; ``validate_values`` reports it. ``base_fields``
    goes with documents that store them."""
    wide = pivot(values, catalog).withColumnRenamed("record_id", "_record")
    fields = [typed_value(F.col(f.api_name), f.kind).alias(f.api_name) for f in catalog.fields]
    custom = F.struct(*fields) if fields else F.create_map().cast("map<string,string>")
    payload = payload_json(
        id=F.col("id"),
        email=F.coalesce("email", F.lit("")),
        name=full_name(F.col("first_name"), F.col("last_name")),
        custom_fields=custom,
        created_at=F.col("created_at"),
        updated_at=F.col("updated_at"),
        **{c: F.col(c) for c in (base_columns(contacts) if base_fields else [])},
    )
    return contacts.join(wide, F.col("id") == F.col("_record"), "left").select("id", payload.alias("payload"))


def emit(changes: DataFrame, batch: str, as_of: Column) -> DataFrame:
    """New change log rows for (id, event_type, payload) rows: waiting, not yet
    tried. A delete carries the id alone."""
    only_id = F.to_json(F.struct("id"))
    return changes.select(
        F.md5(F.concat_ws("|", F.lit(batch), "event_type", F.col("id").cast("string"))).alias("id"),
        F.lit("Contact").alias("aggregate_type"),
        F.col("id").alias("aggregate_id"),
        "event_type",
        F.when(F.col("event_type") == S.DELETED, only_id).otherwise(F.col("payload")).alias("payload"),
        F.lit(S.PENDING).alias("status"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("error_message"),
        as_of.alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
    )


def to_change(outbox: DataFrame) -> DataFrame:
    """Log rows as changes; a delete has no payload."""
    return outbox.select(
        F.col("event_type").alias("type"),
        F.col("aggregate_id").alias("contact_id"),
        F.when(F.col("event_type") != S.DELETED, F.col("payload")).alias("payload"),
        F.col("created_at").alias("event_time"),
        F.col("id").alias("event_id"),
    )


def read_payload(changes: DataFrame, document: T.StructType) -> DataFrame:
    """Changes with their payload text as a document of the given type."""
    return changes.withColumn("payload", F.from_json("payload", document, {"timestampNTZFormat": JSON_TIME}))


def dedupe_events(changes: DataFrame) -> DataFrame:
    """An event delivered more than once counts once."""
    return changes.dropDuplicates(["event_id"])


def change_reason(type_: Column, contact_id: Column, text: Column, parsed: Column) -> Column:
    """Why a change cannot be applied, null if it can. The parsed payload has what
    could not be read, JSON or a typed field, in ``_corrupt``."""
    same = parsed["id"].cast("string").eqNullSafe(contact_id.cast("string"))
    broken = (
        F.when(text.isNull(), "payload_missing")
        .when(parsed.isNull() | parsed[_CORRUPT].isNotNull(), "payload_unreadable")
        .when(~same, "payload_of_another")
    )
    return (
        F.when(~F.coalesce(type_.isin(S.CREATED, S.UPDATED, S.DELETED), F.lit(False)), "unknown_type")
        .when(contact_id.isNull(), "contact_missing")
        .when(type_ != S.DELETED, broken)
    )


def _other_fields(document: T.StructType) -> Column:
    custom = document["custom_fields"].dataType
    if not isinstance(custom, T.StructType):  # a map has them all
        return F.lit(None).cast(_OTHER_TYPE)
    text = T.StructType([T.StructField("custom_fields", _OTHER_TYPE)])
    others = F.map_filter(
        F.from_json("payload", text)["custom_fields"], lambda k, v: v.isNotNull() & ~k.isin(custom.fieldNames())
    )
    # An empty map becomes null without a second mention of the parser.
    return F.try_element_at(F.filter(F.array(others), lambda m: F.size(m) > 0), F.lit(1))


def split_changes(changes: DataFrame, document: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(changes to apply, with their payload as a document; changes to set aside as
    they came, with their reason). Custom fields that the document type does not
    have are in ``other_fields``, as text. Payloads are read before any change is dropped
    for a newer one, so a broken change never hides a good one."""
    return divided(read_once(changes, document), document)


def divided(judged: DataFrame, document: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Changes that ``read_once`` has read, as ``split_changes`` gives them."""
    fields = [F.col("_parsed")[f.name].alias(f.name) for f in document.fields]
    read = F.when(F.col("type") != S.DELETED, F.struct(*fields, F.col("_others").alias(OTHER_FIELDS)))
    good = F.col("reason").isNull() & (F.col("_seq") >= 0)
    apply = judged.where(good).withColumn("payload", read)
    return apply.drop("_parsed", "_others", "reason", "_seq"), judged.where(~good).drop("_parsed", "_others", "_seq")


def read_once(changes: DataFrame, document: T.StructType) -> DataFrame:
    """The changes with ``_parsed`` (their payload as a document), ``_others``
    (custom fields the document type does not have, as text), and ``reason`` (why a change can't be applied, null if it
    can). A payload is parsed once for each of the two, however often they are used:
    a condition that has the row number stays above the reading, where below it
    the optimizer would put a copy of the parser into each use of its result."""
    shape = T.StructType([*document.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("payload", shape, {"timestampNTZFormat": JSON_TIME, "columnNameOfCorruptRecord": _CORRUPT})
    read = changes.select("*", parsed.alias("_parsed"), _other_fields(document).alias("_others"), F.monotonically_increasing_id().alias("_seq"))
    return read.withColumn("reason", change_reason(F.col("type"), F.col("contact_id"), F.col("payload"), F.col("_parsed")))


def newest_changes(changes: DataFrame) -> DataFrame:
    """The last change per contact by event time, then event id. The order of
    arrival does not matter, and a repeated event changes nothing. A contact with
    very many changes is reduced where its changes are read."""
    state = F.struct("type", "payload", "event_time", "event_id")
    return (
        changes.groupBy("contact_id")
        .agg(F.max_by(state, F.struct(*VERSION)).alias("last"))
        .select("last.type", "contact_id", "last.payload", "last.event_time", "last.event_id")
    )


@dataclass(frozen=True)
class Applied:
    documents: DataFrame
    rejected: DataFrame


def apply_changes(
    documents: DataFrame,
    changes: DataFrame,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    catalog: FieldCatalog | None = None,
) -> Applied:
    """Documents after the changes: created and updated ones replaced whole,
    deleted ones gone. Deleting what is not there is no error.

    Every payload is read and checked first; of the good changes of a contact the
    last holds. ``derive`` adds the columns that are stored with documents but
    computed from them. Fields of the catalog that the documents do not have are
    added, null for old rows; names that neither has are kept in ``other_fields``.
    Base fields that the documents store are read from the payloads as well.
    """
    stored = [*DOCUMENT_COLUMNS, *base_columns(documents)]
    document = widened_type(T.StructType([documents.schema[c] for c in stored]), catalog)
    documents = widened(documents, document["custom_fields"].dataType)
    good, rejected = split_changes(changes, document)
    # Written once: it is read for the rows and for the ids that they replace.
    last = settle(newest_changes(good), "newest-changes")
    written = last.where(F.col("type") != S.DELETED).select("payload.*")
    if derive is not None:
        written = derive(written)
    untouched = documents.join(last.select(F.col("contact_id").alias("id")), "id", "left_anti")
    return Applied(untouched.unionByName(written), rejected)


def _claimed(outbox: DataFrame, eligible: Column, limit: int) -> DataFrame:
    return outbox.where(eligible).orderBy("created_at", "id").limit(limit)


def oldest_waiting(outbox: DataFrame, limit: int = S.CLAIM_BATCH) -> DataFrame:
    """The oldest waiting events, as many as one claim takes."""
    return _claimed(outbox, F.col("status") == S.PENDING, limit)


def _with_claim_time(outbox: DataFrame) -> DataFrame:
    if "claimed_at" in outbox.columns:
        return outbox
    return outbox.withColumn("claimed_at", F.lit(None).cast("timestamp_ntz"))


def _marked(outbox: DataFrame, taken: DataFrame, as_of: Column) -> DataFrame:
    """The log with the taken events in processing. ``claimed_at`` has the time of
    the last claim; a log without that column gets it."""
    log, claimed = _with_claim_time(outbox), F.col("_claimed")
    marks = taken.select("id", F.lit(True).alias("_claimed"))
    changed = {
        "status": F.when(claimed, S.PROCESSING).otherwise(F.col("status")),
        "claimed_at": F.when(claimed, as_of).otherwise(F.col("claimed_at")),
    }
    return log.join(marks, "id", "left").withColumns(changed).select(log.columns)


def claim_pending(outbox: DataFrame, as_of: Column, limit: int = S.CLAIM_BATCH) -> DataFrame:
    """The log with its oldest waiting events claimed."""
    return _marked(outbox, oldest_waiting(outbox, limit), as_of)


def retryable(max_retries: int = S.MAX_RETRIES) -> Column:
    return (F.col("status") == S.FAILED) & (F.col("retry_count") < max_retries)


def oldest_retryable(outbox: DataFrame, limit: int = S.RETRY_BATCH) -> DataFrame:
    """The oldest failed events that have tries left, as many as one claim takes."""
    return _claimed(outbox, retryable(), limit)


def claim_retryable(outbox: DataFrame, as_of: Column, limit: int = S.RETRY_BATCH) -> DataFrame:
    """The log with its oldest failed events that have tries left claimed again."""
    return _marked(outbox, oldest_retryable(outbox, limit), as_of)


def stale_claims(outbox: DataFrame, before: Column) -> DataFrame:
    """Events in processing that were claimed before a moment; they may be claimed
    again. Without a claim time the creation time counts."""
    since = F.coalesce("claimed_at", "created_at")
    stale = _with_claim_time(outbox).where((F.col("status") == S.PROCESSING) & (since < before))
    return stale.select(outbox.columns)


def finish_events(outbox: DataFrame, results: DataFrame, as_of: Column) -> DataFrame:
    """The log after results (id, status, error): done events get their time,
    failed ones one more try and the message, others the status alone. Of several
    results of one event a failure holds before a success, and both before others."""
    rank = F.when(F.col("status") == S.FAILED, 2).when(F.col("status") == S.DONE, 1).otherwise(0)
    last = results.groupBy("id").agg(F.max(F.struct(rank.alias("rank"), "status", "error")).alias("_last"))
    outcome = last.select("id", F.col("_last.status").alias("_status"), F.col("_last.error").alias("_error"))
    row = outbox.join(outcome, "id", "left")
    done, failed = F.col("_status") == S.DONE, F.col("_status") == S.FAILED
    return row.withColumns(
        {
            "status": F.coalesce("_status", "status"),
            "processed_at": F.when(done, as_of).otherwise(F.col("processed_at")),
            "retry_count": F.when(failed, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
            "error_message": F.when(failed, F.col("_error")).otherwise(F.col("error_message")),
        }
    ).select(outbox.columns)


def purgeable(as_of: Column, days: int = S.KEEP_DONE_DAYS) -> Column:
    old = F.col("processed_at") < as_of - F.make_dt_interval(days=F.lit(days))
    return F.coalesce((F.col("status") == S.DONE) & old, F.lit(False))


def purge_done(outbox: DataFrame, as_of: Column, days: int = S.KEEP_DONE_DAYS) -> tuple[DataFrame, DataFrame]:
    """(log without done events processed longer ago, number of those)."""
    old = purgeable(as_of, days)
    return outbox.where(~old), outbox.agg(F.count_if(old).alias("purged"))


def reindex(contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, batch: str, as_of: Column) -> DataFrame:
    """An update event for every contact."""
    payload = contact_payload(contacts, values, catalog)
    return emit(payload.withColumn("event_type", F.lit(S.UPDATED)), batch, as_of)


def reindex_some(
    ids: DataFrame, contacts: DataFrame, values: DataFrame, catalog: FieldCatalog, batch: str, as_of: Column
) -> tuple[DataFrame, DataFrame]:
    """(update events for the listed contacts, listed ids no contact has)."""
    wanted = ids.select("id").distinct()
    chosen = contacts.join(wanted, "id", "left_semi")
    theirs = values.join(listed(ids, "id", "record_id"), "record_id", "left_semi")
    return (
        reindex(chosen, theirs, catalog, batch, as_of),
        wanted.join(contacts.select("id"), "id", "left_anti"),
    )


def last_values(patches: DataFrame, *keys: str) -> DataFrame:
    """(keys, value): the one value per field that holds, that with the greatest
    (seq, value), or the greatest value without a ``seq`` column."""
    order = F.struct("seq", "value") if "seq" in patches.columns else F.struct("value")
    return patches.groupBy(*keys).agg(F.max_by(F.struct("value"), order)["value"].alias("value"))


def merge_fields(values: DataFrame, patches: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Value rows after patches (record_id, field_id, value): a patch value
    replaces, a null removes, what is not named stays, of several patches to one
    field one holds (``last_values``). The columns are those of the values: a
    replaced row keeps its id and creation time, a new one gets both. The value
    rows are only ever the large side of a join that can be broadcast or split."""
    keys = ["record_id", "field_id"]
    patch = last_values(patches, *keys)
    marks = patch.select(*keys, F.col("value").alias("_value"), F.lit(True).alias("_patched"))
    now = F.lit(None).cast("timestamp_ntz") if as_of is None else as_of
    changed = {"value": F.when(F.col("_patched"), F.col("_value")).otherwise(F.col("value"))}
    if "updated_at" in values.columns:
        changed["updated_at"] = F.when(F.col("_patched"), now).otherwise(F.col("updated_at"))
    stored = values.join(marks, keys, "left").withColumns(changed).where("value is not null").select(values.columns)
    found = spread(values.join(patch, keys, "left_semi").select(keys))
    given = {"id": value_id(), "created_at": now, "updated_at": now}
    fresh = patch.where("value is not null").join(found, keys, "left_anti")
    fresh = fresh.withColumns({c: given[c].cast(values.schema[c].dataType) for c in given if c in values.columns})
    return stored.unionByName(fresh, allowMissingColumns=True)


def replace_values(values: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Values with all rows of the touched contacts exchanged for fresh ones."""
    return values.join(listed(touched, "id", "record_id"), "record_id", "left_anti").select(fresh.columns).unionByName(fresh)


@dataclass(frozen=True)
class Written:
    """What a batch writes: new table rows, its events, and what it refused."""

    contacts: DataFrame
    values: DataFrame
    events: DataFrame
    rejected: DataFrame


def judge_new_contacts(
    requests: DataFrame, fields: DataFrame, contacts: DataFrame, definitions: DataFrame
) -> DataFrame:
    """Create requests (request_id, email, name) with the ``reason`` to refuse
    them, null if none. Checked in this order: address and name, unknown or
    inactive field, value that breaks its definition, address taken by a contact
    or by an earlier request that is good otherwise."""
    formal = V.validate_contacts(requests, F.col("name")).drop("is_valid").withColumnRenamed("reason", "_formal")
    bad_fields = judge_fields(fields, definitions, "request_id").withColumnRenamed("reason", "_field")
    checked = formal.join(bad_fields, "request_id", "left").withColumn("_fault", F.coalesce("_formal", "_field"))
    taken = V.new_only(
        checked.where("_fault is null and email is not null").select("request_id", "email"),
        contacts.select("email"),
        "email",
        "request_id",
    ).select("request_id", F.col("reason").alias("_taken"))
    return (
        checked.join(taken, "request_id", "left")
        .withColumn("reason", F.coalesce("_fault", "_taken"))
        .select(*requests.columns, "reason")
    )


def judge_fields(fields: DataFrame, definitions: DataFrame, key: str) -> DataFrame:
    """(key, reason): the first reason by field name that a key's field values
    are refused for. A null value removes a field and is never invalid."""
    rules = definitions.select("api_name", "is_active", "data_type", "options")
    broken = V.value_reason(F.col("value"), F.col("data_type"), F.col("options"), F.lit(False))
    return (
        fields.join(rules, "api_name", "left")
        .withColumn("reason", F.coalesce(V.field_reason(F.col("is_active")), broken))
        .where("reason is not null")
        .groupBy(key)
        .agg(F.min_by("reason", F.struct("api_name", "reason")).alias("reason"))
    )


def create_contacts(
    requests: DataFrame,
    fields: DataFrame,
    contacts: DataFrame,
    definitions: DataFrame,
    catalog: FieldCatalog,
    batch: str,
    as_of: Column,
) -> Written:
    """Good requests as contacts, values and events; the others with a reason.
    Request ids need to be distinct within a batch only. Of several values for
    one field of a request one is stored (``last_values``). The judged requests
    are written once, as four tables are built on them."""
    judged = settle(judge_new_contacts(requests, fields, contacts, definitions), "create")
    accepted = judged.where("reason is null").withColumn("id", contact_id(batch, F.col("request_id")))
    clean = F.trim("name")
    made = accepted.select(
        "id",
        first_name(clean).alias("first_name"),
        last_name(clean).alias("last_name"),
        "email",
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("account_id"),
        F.lit("active").alias("status"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )
    ids = definitions.select("api_name", F.col("id").alias("field_id"))
    rows = (
        last_values(fields, "request_id", "api_name")
        .where("value is not null")
        .join(accepted.select("request_id", F.col("id").alias("record_id")), "request_id")
        .join(ids, "api_name")
        .select(
            value_id().alias("id"),
            "record_id",
            "field_id",
            "value",
            as_of.alias("created_at"),
            as_of.alias("updated_at"),
        )
    )
    payload = contact_payload(made, rows, catalog).withColumn("event_type", F.lit(S.CREATED))
    return Written(made, rows, emit(payload, batch, as_of), judged.where("reason is not null"))


def new_id(what: str, name: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(what), name.cast("string")))


def contact_id(batch: str, request_id: Column) -> Column:
    return new_id("contact", F.concat_ws("|", F.lit(batch), request_id.cast("string")))


def value_id() -> Column:
    return new_id("value", F.concat_ws("|", F.col("record_id").cast("string"), "field_id"))


def judge_updates(updates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Update requests (id, name) with the ``reason`` to refuse them: no such
    contact, or a name given that is blank. A null name leaves the name. Of
    several requests for one contact that with the greatest ``seq`` holds, or
    the greatest name without such a column."""
    newest = F.max_by("name", "seq") if "seq" in updates.columns else F.max("name")
    updates = updates.groupBy("id").agg(newest.alias("name"))
    known = contacts.select("id", F.lit(True).alias("_known"))
    reason = F.when(F.col("_known").isNull(), "unknown_contact").when(F.trim("name") == "", "blank_name")
    return updates.join(known, "id", "left").withColumn("reason", reason).drop("_known")


def update_contacts(
    updates: DataFrame,
    fields: DataFrame,
    contacts: DataFrame,
    values: DataFrame,
    catalog: FieldCatalog,
    definitions: DataFrame,
    batch: str,
    as_of: Column,
) -> Written:
    """Contacts and values after updates (id, name) and field patches
    (record_id, api_name, value). Patches alone are an update that leaves the
    name. A refused update changes nothing. Address, phone, account and status
    stay as they are."""
    patched = fields.select(F.col("record_id").alias("id")).distinct()
    updates = updates.unionByName(patched, allowMissingColumns=True)
    by_id = fields.withColumnRenamed("record_id", "id")
    bad = judge_fields(by_id, definitions, "id").withColumnRenamed("reason", "_field")
    judged = settle(
        judge_updates(updates, contacts)
        .join(bad, "id", "left")
        .withColumn("reason", F.coalesce("reason", "_field"))
        .drop("_field"),
        "update",
    )
    good = judged.where("reason is null").select("id", F.trim("name").alias("_name"), F.lit(True).alias("_touched"))
    row = contacts.join(good, "id", "left")
    renamed = F.col("_name").isNotNull()
    after = row.select(
        *[
            F.when(renamed, first_name(F.col("_name"))).otherwise(F.col(c)).alias(c)
            if c == "first_name"
            else F.when(renamed, last_name(F.col("_name"))).otherwise(F.col(c)).alias(c)
            if c == "last_name"
            else F.when(F.col("_touched"), as_of).otherwise(F.col(c)).alias(c)
            if c == "updated_at"
            else F.col(c)
            for c in contacts.columns
        ]
    )
    touched = good.select("id")
    names = definitions.select("api_name", F.col("id").alias("field_id"))
    patch = (
        by_id.join(touched, "id", "left_semi")
        .join(names, "api_name")
        .withColumnRenamed("id", "record_id")
        .drop("api_name")
    )
    merged = merge_fields(values, patch, as_of)
    changed = after.join(touched, "id", "left_semi")
    theirs = merged.join(touched.withColumnRenamed("id", "record_id"), "record_id", "left_semi")
    payload = contact_payload(changed, theirs, catalog).withColumn("event_type", F.lit(S.UPDATED))
    return Written(after, merged, emit(payload, batch, as_of), judged.where("reason is not null"))


def delete_contacts(
    ids: DataFrame, contacts: DataFrame, values: DataFrame, batch: str, as_of: Column
) -> Written:
    """Tables without the listed contacts and their values, a delete event each;
    ids that no contact has are refused."""
    wanted = ids.select("id").distinct()
    found = wanted.join(contacts.select("id"), "id", "left_semi")
    left = contacts.join(wanted, "id", "left_anti")
    kept = values.join(listed(ids, "id", "record_id"), "record_id", "left_anti")
    events = found.withColumn("event_type", F.lit(S.DELETED)).withColumn("payload", F.lit(None).cast("string"))
    missing = wanted.join(contacts.select("id"), "id", "left_anti").withColumn("reason", F.lit("unknown_contact"))
    return Written(left, kept, emit(events, batch, as_of), missing)
