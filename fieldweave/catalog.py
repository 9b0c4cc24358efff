"""Field definitions held on the driver: they are the schema of the custom fields."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from fieldweave import schema as S

# A catalog becomes columns of a plan, so it is bounded like a pivot is.
MAX_CATALOG_FIELDS = 10_000


def is_custom(name: str) -> bool:
    return name.endswith(S.CUSTOM_SUFFIX)


@dataclass(frozen=True)
class FieldDef:
    id: str
    api_name: str
    data_type: str
    label: str = ""
    options: tuple[str, ...] = ()
    is_required: bool = False
    is_active: bool = True
    display_order: int = 0
    created_at: dt.datetime | None = None

    @property
    def kind(self) -> str:
        return S.KIND_OF_DATA_TYPE.get(self.data_type, S.TEXT)


class FieldCatalog:
    """The definitions of one record type, by API name and by id."""

    def __init__(self, fields: Iterable[FieldDef]):
        self.fields = tuple(fields)
        if len(self.fields) > MAX_CATALOG_FIELDS:
            raise ValueError(f"more than {MAX_CATALOG_FIELDS} fields cannot become columns")
        self.by_name = {f.api_name: f for f in self.fields}
        self.by_id = {f.id: f for f in self.fields}
        if len(self.by_name) != len(self.fields) or len(self.by_id) != len(self.fields):
            raise ValueError("field ids and API names must be unique")

    @classmethod
    def from_dataframe(cls, definitions: DataFrame) -> FieldCatalog:
        """Read a definition table; refuses one too large to be a schema."""
        rows = definitions.select(*S.DEFINITIONS.fieldNames()).limit(MAX_CATALOG_FIELDS + 1).collect()
        return cls(
            FieldDef(
                id=r["id"],
                api_name=r["api_name"],
                data_type=r["data_type"],
                label=r["label"],
                options=tuple(r["options"] or ()),
                is_required=r["is_required"],
                is_active=r["is_active"],
                display_order=r["display_order"],
                created_at=r["created_at"],
            )
            for r in rows
        )

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                f.id,
                f.label,
                f.api_name,
                f.data_type,
                list(f.options) or None,
                f.is_required,
                f.is_active,
                f.display_order,
                f.created_at,
            )
            for f in self.fields
        ]
        return spark.createDataFrame(rows, S.DEFINITIONS)

    @property
    def names(self) -> list[str]:
        return [f.api_name for f in self.fields]

    def get(self, api_name: str) -> FieldDef | None:
        return self.by_name.get(api_name)

    def subset(self, names: Sequence[str]) -> FieldCatalog:
        return FieldCatalog(f for f in self.fields if f.api_name in set(names))

    def with_required(self, *names: str) -> FieldCatalog:
        return FieldCatalog(
            replace(f, is_required=True) if f.api_name in names else f for f in self.fields
        )
