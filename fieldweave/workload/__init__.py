"""The registered queries: every operator on the test tables, with the SQL that
gives the same rows."""

from __future__ import annotations

from importlib import import_module

from fieldweave.workload import registry

_MODULES = ("tables", "filters", "reports", "text", "changelog", "checks", "requests")


def _load() -> None:
    for name in _MODULES:
        import_module(f"fieldweave.workload.{name}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
