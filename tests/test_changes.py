"""Change log, batch writes and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldweave import schema as S
from fieldweave.operators import changes as C
from fieldweave.sources import lens as L
from fieldweave.sources.layout import append_batch, read_table, stream_outbox
from fieldweave.streaming.sync import compact, stream_sync, synced_documents

CATALOG = L.CONTACT_CATALOG
T0 = dt.datetime(2024, 1, 1)


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


def event(n, contact, kind, minute, score=None, status="PENDING", retries=0, payload=True, done=None):
    document = {
        "id": str(contact),
        "email": f"{contact}@x.org",
        "name": f"N{n}",
        "custom_fields": {"score__c": score},
        "created_at": at(0).isoformat() + ".000000",
        "updated_at": at(minute).isoformat() + ".000000",
    }
    text = json.dumps(document) if payload else None
    return (f"e{n:03}", "Contact", str(contact), f"CONTACT_{kind}", text, status, retries, None, at(minute), done)


@pytest.fixture
def log(spark):
    def make(*events):
        return spark.createDataFrame(list(events), S.OUTBOX)

    return make


@pytest.fixture
def documents(spark):
    rows = [("1", "a@x.org", "A", None, at(0), at(0)), ("2", "b@x.org", "B", None, at(0), at(0))]
    return spark.createDataFrame(rows, C.document_type(CATALOG))


def names(frame):
    return {r["id"]: r["name"] for r in frame.collect()}


def test_changes_apply_by_time_and_not_by_arrival(documents, log):
    changes = log(
        event(5, 1, "UPDATED", 9, 5.0),
        event(1, 1, "UPDATED", 3, 1.0),
        event(2, 2, "DELETED", 4),
        event(3, 3, "CREATED", 5, 7.0),
        event(4, 9, "DELETED", 5),
        event(6, 3, "VIEWED", 8, 9.0),
        event(7, 3, "UPDATED", 9, payload=False),
    )
    applied = C.apply_changes(documents, C.to_change(changes))
    assert names(applied.documents) == {"1": "N5", "3": "N3"}
    scores = {r["id"]: r["custom_fields"]["score__c"] for r in applied.documents.collect()}
    assert scores == {"1": 5.0, "3": 7.0}
    rejected = {r["event_id"]: r["reason"] for r in applied.rejected.collect()}
    assert rejected == {"e006": "unknown_type", "e007": "payload_missing"}


def test_fields_defined_later_are_kept(spark, log, tmp_path):
    old, new = CATALOG.subset(["notes__c"]), CATALOG.subset(["notes__c", "score__c", "last_contact_date__c"])
    custom = {"notes__c": "n", "score__c": 5.5, "last_contact_date__c": "2024-01-02", "memo__c": "m", "deep__c": {"a": [1]}, "none__c": None}
    text = json.dumps({"id": "1", "email": "1@x.org", "name": "N1", "custom_fields": custom})
    outbox = log(("e1", "Contact", "1", "CONTACT_UPDATED", text, "PENDING", 0, None, at(1), None))
    rows = [(i, "a@x.org", "A", ("old",), at(0), at(0)) for i in ("1", "2")]
    documents = spark.createDataFrame(rows, C.document_type(old))

    def fields(frame):
        return {r["id"]: (r["custom_fields"].asDict(), r[C.OTHER_FIELDS]) for r in frame.collect()}

    day, deep = dt.date(2024, 1, 2), {"memo__c": "m", "deep__c": '{"a":[1]}'}
    wide = {"notes__c": "n", "score__c": 5.5, "last_contact_date__c": day}
    nothing = {"notes__c": "old", "score__c": None, "last_contact_date__c": None}
    expected = {"1": (wide, deep), "2": (nothing, None)}
    applied = C.apply_changes(documents, C.to_change(outbox), catalog=new)
    assert fields(applied.documents) == expected and applied.rejected.count() == 0
    narrow = C.apply_changes(documents, C.to_change(outbox)).documents
    assert fields(narrow)["1"] == ({"notes__c": "n"}, deep | {"score__c": "5.5", "last_contact_date__c": "2024-01-02"})
    assert fields(C.apply_changes(narrow, C.to_change(outbox.limit(0)), catalog=new).documents) == expected

    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    outbox.write.parquet(f"{source}/a")
    for catalog in (None, new):  # the first batch is from before the fields were defined
        stream = stream_outbox(spark, f"{source}/*")
        stream_sync(stream, C.document_type(old), target, checkpoint, catalog=catalog).awaitTermination()
        assert fields(synced_documents(spark, target, documents, catalog=new)) == expected
        later = text.replace('"1"', '"3"')
        log(("e3", "Contact", "3", "CONTACT_CREATED", later, "PENDING", 0, None, at(3), None)).write.mode("overwrite").parquet(f"{source}/b")
        expected["3"] = (wide, deep)
    assert fields(synced_documents(spark, target, documents)) == fields(synced_documents(spark, target, documents, catalog=new)) == expected


def test_equal_times_are_decided_by_event_id(documents, log):
    changes = C.to_change(log(event(2, 1, "UPDATED", 3), event(1, 1, "UPDATED", 3), event(2, 1, "UPDATED", 3)))
    assert names(C.apply_changes(documents, changes).documents) == {"1": "N2", "2": "B"}
    assert C.dedupe_events(changes).count() == 2


def test_claims_and_results(log):
    rows = [event(n, n, "UPDATED", 100 - n) for n in range(1, 8)]
    rows += [event(20 + n, n, "UPDATED", n, status="FAILED", retries=n) for n in range(8)]
    table = log(*rows)
    claimed = C.claim_pending(table, F.lit(at(90)).cast("timestamp_ntz"), 3)
    assert claimed.columns == [*table.columns, "claimed_at"] and claimed.count() == table.count()
    assert {r["id"] for r in claimed.where("status = 'PROCESSING'").collect()} == {"e005", "e006", "e007"}
    assert [r["id"] for r in C.oldest_retryable(table, 3).collect()] == ["e020", "e021", "e022"]
    assert C.oldest_retryable(table).count() == 5
    again = C.claim_retryable(claimed, F.lit(at(99)).cast("timestamp_ntz"), 3)
    times = {r["id"]: r["claimed_at"] for r in again.where("status = 'PROCESSING'").collect()}
    assert times == {i: at(99) for i in ("e020", "e021", "e022")} | {i: at(90) for i in ("e005", "e006", "e007")}
    results = claimed.sparkSession.createDataFrame(
        [("e005", "DONE", None), ("e006", "FAILED", "boom"), ("e006", "DONE", None), ("e007", "PENDING", None)],
        "id string, status string, error string",
    )
    after = {r["id"]: r for r in C.finish_events(claimed, results, F.lit(at(500))).collect()}
    assert (after["e005"]["status"], after["e005"]["processed_at"]) == ("DONE", at(500))
    assert (after["e006"]["status"], after["e006"]["retry_count"], after["e006"]["error_message"]) == ("FAILED", 1, "boom")
    assert (after["e007"]["status"], after["e007"]["processed_at"]) == ("PENDING", None)
    assert C.stale_claims(again, F.lit(at(90))).count() == 0
    assert {r["id"] for r in C.stale_claims(again, F.lit(at(95))).collect()} == {"e005", "e006", "e007"}
    unknown = claimed.drop("claimed_at")
    assert C.stale_claims(unknown, F.lit(at(95))).count() == 2


def test_purge_keeps_recent_and_unfinished(log):
    table = log(
        event(1, 1, "UPDATED", 1, status="DONE", done=T0 - dt.timedelta(days=8)),
        event(2, 1, "UPDATED", 1, status="DONE", done=T0 - dt.timedelta(days=7)),
        event(3, 1, "UPDATED", 1, status="FAILED", done=T0 - dt.timedelta(days=9)),
        event(4, 1, "UPDATED", 1, status="DONE"),
    )
    kept, purged = C.purge_done(table, F.lit(T0).cast("timestamp_ntz"))
    assert sorted(r["id"] for r in kept.collect()) == ["e002", "e003", "e004"]
    assert purged.first()["purged"] == 1


def test_patches_replace_remove_and_keep(spark):
    values = spark.createDataFrame(
        [(1, "f1", "a"), (1, "f2", "b"), (2, "f1", "c")], "record_id int, field_id string, value string"
    )
    patches = spark.createDataFrame(
        [(1, "f1", "old", 1), (1, "f1", "new", 2), (1, "f2", "x", 1), (1, "f2", None, 2), (3, "f1", "z", 1)],
        "record_id int, field_id string, value string, seq int",
    )
    after = C.merge_fields(values, patches)
    assert sorted(map(tuple, after.collect())) == [(1, "f1", "new"), (2, "f1", "c"), (3, "f1", "z")]


def test_a_merge_has_no_full_join_and_gives_new_rows_ids_and_times(spark, stored_values):
    patches = spark.createDataFrame(
        [("1", "f07", "6"), ("2", "f07", "9")], "record_id string, field_id string, value string"
    )
    after = C.merge_fields(stored_values, patches, F.lit(at(3)).cast("timestamp_ntz"))
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan
    rows = {(r["record_id"], r["field_id"]): r for r in after.collect()}
    shown = {k: (r["value"], r["created_at"], r["updated_at"]) for k, r in rows.items()}
    assert shown == {
        ("1", "f10"): ("GOLD", at(0), at(0)),
        ("1", "f07"): ("6", at(0), at(3)),
        ("2", "f07"): ("9", at(3), at(3)),
    }
    assert rows["1", "f07"]["id"] == "v2" and rows["2", "f07"]["id"] not in (None, "v1", "v2")


CONTACT_TYPE = (
    "id string, first_name string, last_name string, email string, phone string, account_id string, "
    "status string, created_at timestamp_ntz, updated_at timestamp_ntz"
)


@pytest.fixture
def contacts(spark):
    rows = [
        ("1", "Kim", "Min", "kim@x.org", "555", "acc", "inactive", at(0), at(0)),
        ("2", "Lee", "", "lee@x.org", None, None, "active", at(0), at(0)),
    ]
    return spark.createDataFrame(rows, CONTACT_TYPE)


@pytest.fixture
def stored_values(spark):
    rows = [("v1", "1", "f10", "GOLD", at(0), at(0)), ("v2", "1", "f07", "5", at(0), at(0))]
    return spark.createDataFrame(rows, S.VALUES)


def test_create(spark, contacts):
    requests = spark.createDataFrame(
        [
            ("r1", "new@x.org", "  Park Ji Sung "),
            ("r2", "new@x.org", "Twin"),
            ("r3", "kim@x.org", "Taken"),
            ("r4", "bad", "Bad"),
            ("r5", "ok@x.org", " "),
            ("r6", "six@x.org", "Six"),
            ("r7", "seven@x.org", "Seven"),
            ("r8", "eight@x.org", "Eight"),
        ],
        "request_id string, email string, name string",
    )
    fields = spark.createDataFrame(
        [
            ("r1", "tier__c", "GOLD"),
            ("r1", "notes__c", None),
            ("r6", "memo__c", "x"),
            ("r7", "tier__c", "TIN"),
            ("r8", "score__c", "ten"),
        ],
        "request_id string, api_name string, value string",
    )
    made = C.create_contacts(
        requests, fields, contacts, CATALOG.to_dataframe(spark), CATALOG, "b", F.lit(at(7)).cast("timestamp_ntz")
    )
    assert {r["request_id"]: r["reason"] for r in made.rejected.collect()} == {
        "r2": "repeated_email",
        "r3": "known_email",
        "r4": "bad_email",
        "r5": "blank_name",
        "r6": "unknown_field",
        "r7": "not_in_options",
        "r8": "not_number",
    }
    (contact,) = made.contacts.collect()
    assert (contact["first_name"], contact["last_name"], contact["status"]) == ("Park", "Ji Sung", "active")
    assert [(r["record_id"], r["field_id"], r["value"]) for r in made.values.collect()] == [(contact["id"], "f10", "GOLD")]
    (created,) = made.events.collect()
    assert (created["event_type"], created["status"], created["aggregate_id"]) == ("CONTACT_CREATED", "PENDING", contact["id"])
    payload = json.loads(created["payload"])
    assert payload["name"] == "Park Ji Sung" and payload["custom_fields"] == {"tier__c": "GOLD"}


def test_only_good_requests_hold_an_address(spark, contacts):
    requests = spark.createDataFrame(
        [("r1", "a@x.org", "One"), ("r2", "a@x.org", "Two"), ("r3", "a@x.org", "Three")],
        "request_id string, email string, name string",
    )
    fields = spark.createDataFrame(
        [("r1", "memo__c", "x"), ("r2", "tier__c", "SILVER"), ("r2", "tier__c", "GOLD"), ("r2", "tier__c", None)],
        "request_id string, api_name string, value string",
    )

    def made(batch):
        definitions, now = CATALOG.to_dataframe(spark), F.lit(at(7)).cast("timestamp_ntz")
        return C.create_contacts(requests, fields, contacts, definitions, CATALOG, batch, now)

    first, second = made("b1"), made("b2")
    assert {r["request_id"]: r["reason"] for r in first.rejected.collect()} == {"r1": "unknown_field", "r3": "repeated_email"}
    assert [(r["field_id"], r["value"]) for r in first.values.collect()] == [("f10", "SILVER")]
    (one,), (other,) = first.contacts.collect(), second.contacts.collect()
    assert one["id"] != other["id"]


def test_patches_alone_are_an_update_or_refused(spark, contacts, stored_values):
    updates = spark.createDataFrame([], "id string, name string, seq int")
    fields = spark.createDataFrame(
        [("2", "tier__c", "GOLD"), ("9", "tier__c", "GOLD"), ("1", "tier__c", "TIN")],
        "record_id string, api_name string, value string",
    )
    done = C.update_contacts(
        updates, fields, contacts, stored_values, CATALOG, CATALOG.to_dataframe(spark), "b", F.lit(at(9)).cast("timestamp_ntz")
    )
    assert {r["id"]: r["reason"] for r in done.rejected.collect()} == {"1": "not_in_options", "9": "unknown_contact"}
    values = {(r["record_id"], r["field_id"], r["value"]) for r in done.values.collect()}
    assert values == {("1", "f10", "GOLD"), ("1", "f07", "5"), ("2", "f10", "GOLD")}
    after = {r["id"]: (r["first_name"], r["updated_at"]) for r in done.contacts.collect()}
    assert after == {"1": ("Kim", at(0)), "2": ("Lee", at(9))}
    assert [r["aggregate_id"] for r in done.events.collect()] == ["2"]


def test_a_failure_holds_before_other_results(spark, log):
    table = log(event(1, 1, "UPDATED", 1, status="PROCESSING"), event(2, 1, "UPDATED", 1, status="PROCESSING"))
    results = spark.createDataFrame(
        [("e001", "PENDING", None), ("e001", "FAILED", "x"), ("e002", "PENDING", None), ("e002", "DONE", None)],
        "id string, status string, error string",
    )
    done = C.finish_events(table, results, F.lit(at(9)).cast("timestamp_ntz"))
    rows = {r["id"]: (r["status"], r["retry_count"], r["error_message"]) for r in done.collect()}
    assert rows == {"e001": ("FAILED", 1, "x"), "e002": ("DONE", 0, None)}


def test_update_changes_only_what_is_named(spark, contacts, stored_values):
    updates = spark.createDataFrame(
        [("1", " Kim New Name ", 2), ("1", "Zoe", 1), ("2", " ", 1), ("9", "X", 1)], "id string, name string, seq int"
    )
    fields = spark.createDataFrame(
        [("1", "tier__c", None), ("1", "score__c", "7"), ("2", "tier__c", "GOLD")],
        "record_id string, api_name string, value string",
    )
    done = C.update_contacts(
        updates, fields, contacts, stored_values, CATALOG, CATALOG.to_dataframe(spark), "b", F.lit(at(9)).cast("timestamp_ntz")
    )
    assert {r["id"]: r["reason"] for r in done.rejected.collect()} == {"2": "blank_name", "9": "unknown_contact"}
    after = {r["id"]: r for r in done.contacts.collect()}
    first = after["1"]
    assert (first["first_name"], first["last_name"], first["updated_at"]) == ("Kim", "New Name", at(9))
    assert (first["phone"], first["account_id"], first["status"]) == ("555", "acc", "inactive")
    assert after["2"]["updated_at"] == at(0)
    assert [tuple(r) for r in done.values.collect()] == [("v2", "1", "f07", "7", at(0), at(9))]
    (changed,) = done.events.collect()
    assert json.loads(changed["payload"])["custom_fields"] == {"score__c": 7.0}


def test_delete_cascades(spark, contacts, stored_values):
    ids = spark.createDataFrame([("1",), ("9",), ("1",)], "id string")
    done = C.delete_contacts(ids, contacts, stored_values, "b", F.lit(at(9)))
    assert [r["id"] for r in done.contacts.collect()] == ["2"]
    assert done.values.count() == 0
    assert [(r["event_type"], r["payload"]) for r in done.events.collect()] == [("CONTACT_DELETED", '{"id":"1"}')]
    assert [(r["id"], r["reason"]) for r in done.rejected.collect()] == [("9", "unknown_contact")]


def test_event_ids_do_not_change_when_a_task_runs_again(spark, contacts, stored_values):
    def ids():
        log = C.reindex(contacts, stored_values, CATALOG, "b", F.lit(at(1)))
        return sorted(r["id"] for r in log.collect())

    assert ids() == ids() and len(set(ids())) == 2


def run_stream(spark, source, target, checkpoint, files=1):
    stream = stream_outbox(spark, source, files_per_batch=files)
    stream_sync(stream, C.document_type(CATALOG), target, checkpoint).awaitTermination()


EVENTS = [
    event(1, 1, "UPDATED", 3, 1.0),
    event(2, 2, "DELETED", 4),
    event(3, 3, "CREATED", 5, 7.0),
    event(4, 3, "UPDATED", 6, 8.0),
    event(5, 2, "UPDATED", 2, 8.0),
    event(6, 4, "CREATED", 2, 8.0),
    event(7, 4, "DELETED", 8),
    event(8, 4, "UPDATED", 9, payload=False),
]


@pytest.mark.parametrize("order", [range(8), reversed(range(8)), [3, 0, 6, 1, 5, 2, 7, 4, 3, 0]])
def test_stream_equals_batch(spark, log, documents, tmp_path, order):
    for n, position in enumerate(order):
        log(EVENTS[position]).coalesce(1).write.parquet(f"{tmp_path}/source/part={n}")
    target = str(tmp_path / "target")
    run_stream(spark, f"{tmp_path}/source/*", target, str(tmp_path / "checkpoint"), files=3)
    synced = synced_documents(spark, target, documents)
    batch = C.apply_changes(documents, C.to_change(log(*EVENTS))).documents
    assert names(synced) == names(batch) == {"1": "N1", "3": "N4"}
    assert spark.read.parquet(f"{target}/rejected").select("event_id").distinct().count() == 1


def test_stream_goes_on_from_its_checkpoint(spark, log, documents, tmp_path):
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    source = f"{tmp_path}/source"
    log(*EVENTS[3:]).write.parquet(f"{source}/a")
    run_stream(spark, f"{source}/*", target, checkpoint)
    first = names(synced_documents(spark, target, documents))
    run_stream(spark, f"{source}/*", target, checkpoint)
    assert names(synced_documents(spark, target, documents)) == first == {"1": "A", "2": "N5", "3": "N4"}
    log(*EVENTS[:3]).write.parquet(f"{source}/b")
    run_stream(spark, f"{source}/*", target, checkpoint)
    assert names(synced_documents(spark, target, documents)) == {"1": "N1", "3": "N4"}
    compacted = str(tmp_path / "compacted")
    compact(spark, target, compacted)
    assert names(synced_documents(spark, compacted, documents)) == {"1": "N1", "3": "N4"}
    assert spark.read.parquet(f"{compacted}/changes").where("type = 'CONTACT_DELETED'").count() == 2


def test_a_batch_written_again_replaces_itself(spark, contacts, tmp_path):
    path = str(tmp_path / "contacts")
    append_batch(contacts, path, "a")
    append_batch(contacts, path, "b")
    append_batch(contacts.where("id = '1'"), path, "b")
    assert read_table(spark, path, S.CONTACTS).schema.fieldNames() == [*S.CONTACTS.fieldNames(), "batch"]
    rows = read_table(spark, path).groupBy("batch").count()
    assert {r["batch"]: r["count"] for r in rows.collect()} == {"a": 2, "b": 1}


def test_broken_payloads_are_set_aside_and_hide_nothing(documents, log):
    def broken(n, contact, text, kind="CONTACT_UPDATED"):
        return (f"e{n:03}", "Contact", contact, kind, text, "PENDING", 0, None, at(n), None)

    changes = C.to_change(
        log(
            event(1, 1, "UPDATED", 1, 5.0),
            broken(2, "1", '{"id":"1","name":'),
            broken(3, "1", "{}"),
            broken(4, "1", '{"id":"2","name":"X"}'),
            broken(5, "1", '{"id":"1","name":"X","custom_fields":{"score__c":"46"}}'),
            broken(6, "1", '{"id":"1","name":"X"}'),
            broken(7, "1", '{"id":"1","name":"X"}'),
        )
    )
    changes = changes.withColumn("contact_id", F.when(F.col("event_id") != "e006", F.col("contact_id")))
    changes = changes.withColumn("type", F.when(F.col("event_id") != "e007", F.col("type")))
    applied = C.apply_changes(documents, changes)
    rows = {r["id"]: (r["name"], r["custom_fields"] and r["custom_fields"]["score__c"]) for r in applied.documents.collect()}
    assert rows == {"1": ("N1", 5.0), "2": ("B", None)}
    assert {r["event_id"]: r["reason"] for r in applied.rejected.collect()} == {
        "e002": "payload_unreadable",
        "e003": "payload_of_another",
        "e004": "payload_of_another",
        "e005": "payload_unreadable",
        "e006": "contact_missing",
        "e007": "unknown_type",
    }


def test_payloads_are_parsed_once_for_each_use(spark):
    document = C.document_type(L.CONTACT_CATALOG, T.LongType())
    changes = C.to_change(L.outbox(spark, "/root/testdata/sf0.001"))
    for rows in C.split_changes(changes, document):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 2 and plan.count("Relation ") == 1
