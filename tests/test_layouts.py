"""The two layouts against each other, and plain properties of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from fieldweave.operators import aggregates as A
from fieldweave.operators import eav as E
from fieldweave.operators import predicates as P
from fieldweave.operators.changes import apply_changes, contact_payload, emit, to_change
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import Sort, missing_last, missing_lowest, order_of, page_after, page_of
from fieldweave.plans.search import layout_parity, search, search_documents, search_eav
from fieldweave.plans.spec import SearchSpec
from fieldweave.sources import layout
from fieldweave.sources import lens as L

CATALOG = L.CONTACT_CATALOG


@pytest.fixture(scope="module")
def tables(spark, data_dir, tmp_path_factory):
    """Both layouts stored on disk, as a job would find them."""
    root = tmp_path_factory.mktemp("tables")
    L.contacts(spark, data_dir).write.parquet(f"{root}/contacts")
    layout.write_values(L.values(spark, data_dir), f"{root}/values")
    contacts = spark.read.parquet(f"{root}/contacts")
    values = spark.read.parquet(f"{root}/values")
    layout.write_documents(layout.build_documents(contacts, values, CATALOG), f"{root}/documents")
    return contacts, values, spark.read.parquet(f"{root}/documents")


def test_melt_and_pivot_are_inverse(spark, data_dir, tables):
    contacts, values, _ = tables
    wide = L.profile(spark, data_dir).select("id", *CATALOG.names)
    back = E.wide_contacts(contacts.select("id"), values, CATALOG)
    assert wide.exceptAll(back).count() == 0 and back.exceptAll(wide).count() == 0


def test_built_documents_equal_typed_wide_rows(spark, data_dir, tables):
    built, direct = tables[2], L.documents(spark, data_dir)
    assert built.count() == direct.count()
    assert built.exceptAll(direct.select(built.columns)).count() == 0


def test_semi_join_equals_pivot_filter(tables):
    contacts, values, _ = tables
    flt = [Filter("tier__c", "eq", "GOLD")]
    semi = E.having_values(contacts, values, CATALOG, flt).select("id")
    once = contacts.join(E.matches(values, CATALOG, flt), "id", "left_semi").select("id")
    pivoted = E.pivot_equal(contacts, values, CATALOG, "tier__c", "GOLD").select("id")
    expected = sorted(r[0] for r in pivoted.collect())
    assert expected and sorted(r[0] for r in semi.collect()) == expected == sorted(r[0] for r in once.collect())


def random_spec(rng):
    options = [
        Filter("tier__c", "eq", rng.choice(["GOLD", "SILVER", "NONE"])),
        Filter("score__c", rng.choice(["gt", "gte", "lt", "lte", "eq"]), rng.randrange(0, 101)),
        Filter("score__c", "between", [rng.randrange(0, 50), rng.randrange(50, 101)]),
        Filter("contract_start__c", rng.choice(["gt", "lte"]), f"199{rng.randrange(5, 10)}-06-15"),
        Filter("annual_revenue__c", "gt", rng.randrange(0, 4_000_000)),
        Filter("notes__c", "contains", rng.choice(["client", "BUILD", "*ASIA", "zzz"])),
        Filter("region__c", "gte", "ASIA"),
        Filter("email", "contains", rng.choice(["nation-1", "customer.0"])),
        Filter("name", "gt", "Customer 000000050"),
        Filter("created_at", "lt", "1996-06-01"),
        Filter("unknown__c", "eq", "x"),
    ]
    return SearchSpec(filters=tuple(rng.sample(options, rng.randrange(0, 4))))


def test_base_fields_need_documents_that_store_them(tables):
    contacts, values, documents = tables
    asked = (
        SearchSpec(filters=(Filter("status", "eq", "active"),)), SearchSpec(sort=(Sort("firstName"),)), SearchSpec(group_by="status")
    )
    for spec in asked:
        with pytest.raises(ValueError, match="do not store"):
            search("doc", spec, CATALOG, documents=documents)
    stored = layout.build_documents(contacts, values, CATALOG, base_fields=True)
    for spec in asked:
        found = search("doc", spec, CATALOG, documents=stored)
        there = search("eav", spec, CATALOG, contacts=contacts, values=values)
        assert sorted(r["id"] for r in found.page.collect()) == sorted(r["id"] for r in there.page.collect())
    with pytest.raises(ValueError, match="unknown field"):
        search("doc", SearchSpec(sort=(Sort("nobody"),)), CATALOG, documents=stored)


def test_changes_keep_stored_base_fields(spark, tables):
    contacts, values, _ = tables
    stored = layout.build_documents(contacts, values, CATALOG, base_fields=True)
    payload = contact_payload(contacts, values, CATALOG, base_fields=True)
    log = emit(payload.withColumn("event_type", F.lit("CONTACT_UPDATED")), "b", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    applied = apply_changes(stored, to_change(log)).documents
    kept = lambda rows: sorted(tuple(r) for r in rows.select("id", "status", "first_name", "last_name").collect())
    assert kept(applied) == kept(stored)


@pytest.mark.parametrize("seed", range(12))
def test_layouts_agree(tables, seed):
    contacts, values, documents = tables
    spec = random_spec(random.Random(seed))
    assert layout_parity(spec, CATALOG, documents, contacts, values).count() == 0


@pytest.mark.parametrize(
    "sort",
    [
        (),
        (Sort("score__c", "desc"),),
        (Sort("annual_revenue__c"), Sort("name", "desc")),
        (Sort("tier__c", "desc"), Sort("contract_start__c"), Sort("createdAt")),
        (Sort("email", "desc"),),
    ],
)
def test_pages_agree_in_order(tables, sort):
    contacts, values, documents = tables
    for page in (1, 2, 4):
        spec = SearchSpec(sort=sort, page=page, page_size=40, filters=(Filter("score__c", "gte", 5),))
        doc = [r["id"] for r in search("doc", spec, CATALOG, documents=documents).page.collect()]
        eav = [r["id"] for r in search("eav", spec, CATALOG, contacts=contacts, values=values).page.collect()]
        assert doc == eav and len(doc) == len(set(doc))


def test_pages_of_any_length_agree(tables):
    contacts, values, _ = tables
    small = SearchSpec(sort=(Sort("score__c"),), page_size=150)
    large = SearchSpec(sort=(Sort("score__c"),), page_size=201)
    huge = SearchSpec(sort=(Sort("score__c"),), page_size=20_000)
    answers = [
        [(r["id"], r["custom_fields"]) for r in search_eav(contacts, values, CATALOG, s).page.collect()][:150]
        for s in (small, large, huge)
    ]
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) == 150


def test_pages_concatenate_to_the_full_sort(tables):
    documents = tables[2]
    order = order_of([Sort("region__c")], lambda n: P.document_column(n, CATALOG))
    full = [r["id"] for r in documents.orderBy(*order).collect()]
    pages = [r["id"] for n in range(1, 6) for r in page_of(documents, order, n, 37).collect()]
    assert pages == full


def test_keyset_pages_equal_offset_pages(tables):
    rows = tables[2].select("id", "custom_fields.score__c").where("score__c is not null")
    last = page_of(rows, [F.col("score__c").asc(), F.col("id").asc()], 2, 20).collect()[-1]
    after = page_after(rows, "score__c", F.lit(last["score__c"]), F.lit(last["id"]), 20)
    third = page_of(rows, [F.col("score__c").asc(), F.col("id").asc()], 3, 20)
    assert after.collect() == third.collect()


def test_missing_values_in_sorts(spark):
    rows = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "id int, k string")

    def ids(rule, direction):
        return [r["id"] for r in rows.orderBy(*order_of([Sort("k", direction)], F.col, rule)).collect()]

    assert ids(missing_last, "asc") == [3, 2, 1] and ids(missing_last, "desc") == [2, 3, 1]
    assert ids(missing_lowest, "asc") == [1, 3, 2] and ids(missing_lowest, "desc") == [2, 3, 1]


def test_terms_sum_to_present_rows(tables):
    documents = tables[2]
    counted = A.terms(documents, F.col("custom_fields.tier__c"), 50).agg(F.sum("cnt")).first()[0]
    assert counted == documents.where("custom_fields.tier__c is not null").count()


def test_missing_and_empty_keys_share_a_group(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, k string")
    assert {tuple(r) for r in A.group_counts(rows, F.col("k")).collect()} == {("null", 2), ("x", 1)}


def test_total_and_page_info(tables):
    result = search_documents(tables[2], CATALOG, SearchSpec(page=3, page_size=40))
    info = result.info.first()
    assert (info["total"], info["total_pages"], info["first_row"], info["last_row"]) == (150, 4, 81, 120)


def test_bucketed_values_need_no_shuffle(spark, tables, tmp_path):
    layout.write_values_by_record(tables[1], "values_by_record", str(tmp_path / "bucketed"), 4)
    stored = spark.table("values_by_record")
    wide = E.pivot(stored, CATALOG)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    expected = E.pivot(tables[1], CATALOG)
    assert wide.exceptAll(expected).count() == 0 and wide.count() == expected.count()


def test_upsert_takes_the_newest_change(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame(
        [(2, "old", 1, 7), (2, "new", 2, 1), (2, "tie", 2, 0), (3, "c", 1, 1)], "id int, v string, t int, e int"
    )
    after = layout.upsert(target, changes, "id", ["t", "e"])
    assert sorted(map(tuple, after.collect())) == [(1, "a"), (2, "new"), (3, "c")]
