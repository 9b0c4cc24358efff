"""Single-row rules: names, types, validation codes, request parsing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldweave import schema as S
from fieldweave.catalog import FieldCatalog, FieldDef
from fieldweave.functions import values as V
from fieldweave.operators import predicates as P
from fieldweave.operators import validation as Q
from fieldweave.operators.predicates import Filter
from fieldweave.operators.sorting import Sort, last_direction_wins, page_of
from fieldweave.plans.spec import SearchSpec
from fieldweave.sources.lens import CONTACT_CATALOG


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column).first()[0]


@pytest.mark.parametrize(
    "email, name, reason",
    [
        ("user@example.com", "홍길동", None),
        ("user@example.com", "  홍길동  ", None),
        ("invalid-email", "홍길동", "bad_email"),
        (None, "홍길동", "bad_email"),
        ("a b@example.com", "x", "bad_email"),
        ("user@example.com", "", "blank_name"),
        ("user@example.com", "   ", "blank_name"),
    ],
)
def test_contact_rules(spark, email, name, reason):
    rows = spark.createDataFrame([(email, name)], "email string, name string")
    assert rows.select(Q.contact_reason(F.col("email"), F.col("name"))).first()[0] == reason


@pytest.mark.parametrize(
    "api_name, data_type, options, reason",
    [
        ("memo__c", "text", None, None),
        ("memo", "text", None, "bad_api_name"),
        ("Memo__c", "text", None, "bad_api_name"),
        ("1memo__c", "text", None, "bad_api_name"),
        ("memo_2__c", "select", ["A"], None),
        ("memo__c", "select", None, "options_missing"),
        ("memo__c", "select", [], "options_missing"),
        ("memo__c", "multi_select", [], "options_missing"),
    ],
)
def test_definition_rules(spark, api_name, data_type, options, reason):
    rows = spark.createDataFrame(
        [(api_name, data_type, options)], "api_name string, data_type string, options array<string>"
    )
    assert Q.validate_definitions(rows).first()["reason"] == reason


TIERS = ["BRONZE", "SILVER", "GOLD"]


@pytest.mark.parametrize(
    "value, data_type, options, required, reason",
    [
        ("안녕하세요", "text", None, False, None),
        ("123", "text", None, False, None),
        ("25", "number", None, False, None),
        ("99.99", "number", None, False, None),
        ("-1e3", "number", None, False, None),
        ("abc", "number", None, False, "not_number"),
        ("12abc", "number", None, False, "not_number"),
        ("12d", "number", None, False, "not_number"),
        ("NaN", "number", None, False, "not_number"),
        ("", "number", None, False, "not_number"),
        ("1990-01-15", "date", None, False, None),
        ("01/15/1990", "date", None, False, "bad_date"),
        ("1990-1-5", "date", None, False, "bad_date"),
        ("1990-02-30", "date", None, False, "no_such_day"),
        ("GOLD", "select", TIERS, False, None),
        ("PLATINUM", "select", TIERS, False, "not_in_options"),
        ("PLATINUM", "select", [*TIERS, "PLATINUM"], False, None),
        ("GOLD", "select", None, False, "not_in_options"),
        (None, "text", None, True, "required_missing"),
        (None, "text", None, False, None),
    ],
)
def test_value_rules(spark, value, data_type, options, required, reason):
    values = spark.createDataFrame(
        [("v", 1, "f", value)], "id string, record_id bigint, field_id string, value string"
    )
    definitions = spark.createDataFrame(
        [("f", "L", "a__c", data_type, options, required, True, 0, None)], S.DEFINITIONS
    )
    row = Q.validate_values(values, definitions).first()
    assert (row["reason"], row["is_valid"]) == (reason, reason is None)


def test_names(spark):
    rows = spark.createDataFrame([("Kim",), ("Kim Min Su",), ("",)], "name string")
    parts = rows.select(V.first_name(F.col("name")), V.last_name(F.col("name"))).collect()
    assert [tuple(r) for r in parts] == [("Kim", ""), ("Kim", "Min Su"), ("", "")]
    assert one(spark, V.full_name(F.col("a"), F.col("b")), a="Kim", b="") == "Kim"


@pytest.mark.parametrize(
    "number, text",
    [
        (0.0, "0"),
        (100.0, "100"),
        (1e7, "10000000"),
        (12345678.5, "12345678.5"),
        (0.1, "0.1"),
        (-2.50, "-2.5"),
        (0.0001, "0.0001"),
        (123456789012.0, "123456789012"),
    ],
)
def test_number_text(spark, number, text):
    assert one(spark, V.number_to_text(F.col("x")), x=number) == text


def test_typed_values(spark):
    assert one(spark, V.to_number(F.col("x")), x="12abc") is None
    assert one(spark, V.to_number(F.col("x"), lenient=True), x="12abc") == 12.0
    assert one(spark, V.to_number(F.col("x"), lenient=True), x="abc") is None
    assert one(spark, V.to_day(F.col("x")), x="2024-02-29") == dt.date(2024, 2, 29)
    assert one(spark, V.to_day(F.col("x")), x="2023-02-29") is None
    assert one(spark, V.to_day(F.col("x")), x="2023") is None


def test_contains_wildcards(spark):
    def hit(text, part):
        return one(spark, P.contains(F.col("x"), part), x=text)

    assert hit("a.b+c", ".b+")
    assert not hit("aXb+c", ".b+")
    assert hit("BUILDING client", "B?ILD*cli")
    assert not hit("BUILDING client", "b?ild")
    assert hit("line\nbreak", "ne*br")


def test_filter_errors():
    with pytest.raises(ValueError):
        Filter("tier__c", "like", "x")
    with pytest.raises(ValueError):
        P.usable([Filter("score__c", "between", [1])])
    assert P.usable([Filter("score__c", "between", [1])], lenient=True) == []
    with pytest.raises(ValueError):
        P.condition(F.lit(1.0), S.NUMBER, Filter("score__c", "contains", "1"))
    with pytest.raises(ValueError):
        P.base_name("nickname")
    with pytest.raises(ValueError):
        SearchSpec(page=0)
    with pytest.raises(ValueError):
        Sort("x", "up")


def test_requests():
    spec = SearchSpec.from_request(
        {
            "search": "kim",
            "filter": '[{"field": "score__c", "operator": "between", "value": [1, 2]}]',
            "sort": '[{"field": "name", "direction": "desc"}]',
        }
    )
    assert spec.filters == (Filter("score__c", "between", [1, 2]),)
    assert (spec.sort, spec.page, spec.page_size, spec.needs_pivot) == ((Sort("name", "desc"),), 1, 20, False)
    simple = SearchSpec.from_query(
        {"keyword": "k", "filter[tier__c]": "GOLD", "sort[score__c]": "asc", "sort[name]": "up", "size": "5"}
    )
    assert simple.filters == (Filter("tier__c", "eq", "GOLD"),)
    assert (simple.sort, simple.page_size, simple.needs_pivot) == ((Sort("score__c", "asc"),), 5, True)
    assert SearchSpec(group_by="tier__c").needs_pivot
    assert not SearchSpec(group_by="status").needs_pivot


def test_last_direction_wins():
    sorts = [Sort("a"), Sort("b"), Sort("a", "desc")]
    assert last_direction_wins(sorts) == [Sort("a", "desc"), Sort("b")]


def test_page_bounds(spark):
    with pytest.raises(ValueError):
        page_of(spark.range(3), [F.col("id")], 0, 5)


def test_catalog_round_trip(spark):
    again = FieldCatalog.from_dataframe(CONTACT_CATALOG.to_dataframe(spark))
    assert {f.api_name: f for f in again.fields} == CONTACT_CATALOG.by_name
    with pytest.raises(ValueError):
        FieldCatalog([FieldDef("1", "a__c", "text"), FieldDef("2", "a__c", "text")])


def test_accents_and_case(spark):
    rows = spark.createDataFrame([("José", "Núñez", None)], "first_name string, last_name string, email string")
    assert rows.where(P.text_contains("jose nunez", ignore_accents=True)).count() == 1
    assert rows.where(P.text_contains("jose nunez")).count() == 0
    assert rows.where(P.text_contains("JOSÉ N")).count() == 1
    assert one(spark, P.equal_ignoring_case(F.col("x"), "GOLD"), x="Göld ")
