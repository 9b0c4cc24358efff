"""Column functions on names and on custom field values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldweave import schema as S

# Finite decimal text; keeps forms such as '1d' or 'NaN', which a cast accepts, out.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
NUMBER_PREFIX = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", first, last))


def first_name(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def last_name(name: Column) -> Column:
    """All after the first blank, empty if there is none."""
    return F.coalesce(F.try_element_at(F.split(name, " ", 2), F.lit(2)), F.lit(""))


def email_or_empty(email: Column) -> Column:
    return F.coalesce(email, F.lit(""))


def to_number(text: Column, lenient: bool = False) -> Column:
    """Text as double, null if unreadable. ``lenient`` reads a numeric prefix."""
    if lenient:
        return F.regexp_extract(text, NUMBER_PREFIX, 1).try_cast("double")
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def to_day(text: Column) -> Column:
    """``YYYY-MM-DD`` text as date, null for other shapes and impossible days."""
    return F.when(text.rlike(S.DATE_PATTERN), text.try_cast("date"))


def typed_value(text: Column, kind: str, lenient: bool = False) -> Column:
    if kind == S.NUMBER:
        return to_number(text, lenient)
    if kind == S.DATE:
        return to_day(text)
    return text


def number_to_text(number: Column) -> Column:
    """Shortest decimal text, without exponent and trailing zeros."""
    size = F.abs(number)
    plain = number.cast("string").try_cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(plain, r"\.?0+$", "")
    return (
        F.when(size == 0, "0")
        .when((size >= 1e-6) & (size < 1e20), plain)
        .otherwise(number.cast("string"))
    )


def day_to_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def value_to_text(value: Column, kind: str) -> Column:
    if kind == S.NUMBER:
        return number_to_text(value)
    if kind == S.DATE:
        return day_to_text(value)
    return value.cast("string")


def _map_value(column: Column, mapping: Mapping[str, str], default: str) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(column == key, value) if expr is None else expr.when(column == key, value)
    return expr.otherwise(default)


def kind_of_data_type(data_type: Column) -> Column:
    """Stored data type to field kind; an unknown type is text."""
    return _map_value(data_type, S.KIND_OF_DATA_TYPE, S.TEXT)


def data_type_of_kind(kind: Column) -> Column:
    return _map_value(kind, S.DATA_TYPE_OF_KIND, "text")


def typed_columns(value: Column, kind: Column, lenient: bool = False) -> dict[str, Column]:
    """One column per kind for rows of mixed kinds, the others null."""
    return {
        "number_value": F.when(kind == S.NUMBER, to_number(value, lenient)),
        "date_value": F.when(kind == S.DATE, to_day(value)),
        "text_value": F.when(kind.isin(S.TEXT, S.SELECT), value),
    }


def is_custom_name(name: Column) -> Column:
    return F.endswith(name, F.lit(S.CUSTOM_SUFFIX))
