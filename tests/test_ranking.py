"""Pages by rank, cursors over several keys and tops from a field index, with ties and missing values."""

import pytest
from pyspark.sql import functions as F

from fieldweave.catalog import FieldCatalog
from fieldweave.operators.predicates import Filter
from fieldweave.operators.ranking import FieldIndex, beyond, index_field, open_ranked, page_after_keys, store_ranked
from fieldweave.operators.sorting import Sort
from fieldweave.plans.search import rank_contacts, search_eav
from fieldweave.plans.spec import SearchSpec
from fieldweave.sources import lens as L

CATALOG = L.CONTACT_CATALOG


@pytest.fixture(scope="module")
def rows(spark):
    """Many ties, one value with a third of all rows, missing values."""
    value = F.expr("case when id % 3 = 0 then 5 when id % 11 = 0 then null else id % 40 end")
    return spark.range(5000).withColumn("value", value.cast("double")).withColumn("name", F.expr("if(id % 13 = 0, null, concat('n', id % 7))")).repartition(6)


def order():
    return [F.col("value").desc_nulls_last(), F.col("name").asc_nulls_last(), F.col("id").asc()]


def expected(rows):
    return [r["id"] for r in rows.orderBy(*order()).collect()]


def test_pages_by_rank_are_slices_of_the_sort(spark, rows, tmp_path):
    ranked = store_ranked(rows, order(), f"{tmp_path}/ranked")
    ids = expected(rows)
    assert ranked.total == len(ids) == 5000
    for page, size in ((1, 7), (3, 900), (715, 7), (1, 6000), (5, 1000), (6, 1000)):
        found = ranked.page(page, size).collect()
        assert [r["id"] for r in found] == ids[(page - 1) * size : page * size]
        assert [r["rank"] for r in found] == list(range((page - 1) * size + 1, min(page * size, 5000) + 1))
    again = open_ranked(spark, f"{tmp_path}/ranked", ranked.rows.schema)
    assert again.counts == ranked.counts and again.page(100, 10).count() == 10


def test_a_deep_page_reads_only_its_parts(spark, rows, tmp_path):
    ranked = store_ranked(rows.repartition(8), order(), f"{tmp_path}/ranked")
    page = ranked.page(400, 10)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Limit" not in plan and "TakeOrdered" not in plan
    # The files of one part at most two, where the page lies across.
    assert len(page.inputFiles()) >= 1
    assert page.select(F.input_file_name().alias("f")).distinct().count() <= 2


def test_no_rows_have_no_pages(rows, tmp_path):
    ranked = store_ranked(rows.limit(0), order(), f"{tmp_path}/ranked")
    assert ranked.total == 0 and ranked.page(1, 10).count() == 0


def test_cursors_walk_through_ties_and_missing_values(rows):
    keys = [(F.col("value"), "desc"), (F.col("name"), "asc"), (F.col("id"), "asc")]
    ids, found = expected(rows), []
    page = rows.orderBy(*order()).limit(617).collect()
    while page:
        found += [r["id"] for r in page]
        last = page[-1]
        page = page_after_keys(rows, keys, (last["value"], last["name"], last["id"]), 617).collect()
    assert found == ids
    with pytest.raises(ValueError):
        beyond(keys, (1,))


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    present = rows.where("value is not null").select("id", "value")
    by = [F.col("value").asc(), F.col("id").asc()]
    return FieldIndex("value", store_ranked(present, by, str(tmp_path_factory.mktemp("index") / "value"), "value"))


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("size", [1, 20, 1800, 4700, 4999, 6000])
def test_tops_of_an_index_equal_the_sort(rows, index, direction, size):
    column = F.col("value").desc_nulls_last() if direction == "desc" else F.col("value").asc_nulls_last()
    ids = [r["id"] for r in rows.orderBy(column, "id").limit(size).collect()]
    assert [r["id"] for r in index.top(rows.select("id", "name"), direction, size).collect()] == ids


def test_a_top_joins_no_more_than_its_candidates(index):
    for direction in ("asc", "desc"):
        candidates = index.candidates(direction, 20)
        assert candidates.count() == 20
        files = candidates.select(F.input_file_name().alias("f")) if direction == "asc" else None
        assert files is None or files.distinct().count() == 1


@pytest.fixture(scope="module")
def tables(spark, data_dir, tmp_path_factory):
    """Stored tables, in which some contacts are gone and their values are left."""
    work = str(tmp_path_factory.mktemp("tables"))
    L.contacts(spark, data_dir).where("id % 10 <> 3").write.parquet(f"{work}/contacts")
    L.values(spark, data_dir).write.parquet(f"{work}/values")
    return spark.read.parquet(f"{work}/contacts"), spark.read.parquet(f"{work}/values")


@pytest.mark.parametrize("name", ["score__c", "tier__c", "contract_start__c"])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_indexed_sorts_equal_sorts(spark, tables, tmp_path, name, direction):
    contacts, values = tables
    index = index_field(contacts, values, CATALOG, name, f"{tmp_path}/index")
    for page in (1, 2, 5):
        spec = SearchSpec(sort=(Sort(name, direction),), page=page, page_size=9)
        own, indexed = (search_eav(contacts, values, CATALOG, spec, i).page.collect() for i in (None, {name: index}))
        assert own == indexed
    filtered = SearchSpec(sort=(Sort(name, direction),), filters=(Filter("status", "eq", "active"),))
    assert search_eav(contacts, values, CATALOG, filtered, {name: index}).page.collect() == search_eav(contacts, values, CATALOG, filtered).page.collect()


def test_an_indexed_page_does_not_shuffle_the_values_of_the_field(tables, tmp_path):
    contacts, values = tables
    index = index_field(contacts, values, CATALOG, "score__c", f"{tmp_path}/index")
    spec = SearchSpec(sort=(Sort("score__c", "desc"),))
    plan = lambda i: search_eav(contacts, values, CATALOG, spec, i).page._jdf.queryExecution().optimizedPlan().toString()
    assert plan(None).count("max(") > plan({"score__c": index}).count("max(")


def test_ranked_contacts_give_all_pages_of_a_request(spark, tables, tmp_path):
    contacts, values = tables
    spec = SearchSpec(sort=(Sort("tier__c"), Sort("score__c", "desc")), filters=(Filter("score__c", "gt", 10),), page_size=11)
    ranked = rank_contacts(contacts, values, CATALOG, spec, f"{tmp_path}/ranked")
    assert ranked.total == search_eav(contacts, values, CATALOG, spec).total.first()[0]
    for number in (1, 3, ranked.last_page):
        paged = SearchSpec(sort=spec.sort, filters=spec.filters, page_size=11, page=number)
        assert ranked.page(number).collect() == search_eav(contacts, values, CATALOG, paged).page.collect()
    assert ranked.page(ranked.last_page + 1).count() == 0


def test_a_cursor_needs_an_order():
    with pytest.raises(ValueError):
        SearchSpec(after=(1,), page=2)
    with pytest.raises(ValueError):
        SearchSpec(after=(1,), search="gold")
    assert FieldCatalog([]).names == []
