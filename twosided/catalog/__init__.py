"""Registered queries over the driver's tables, each with the SQL that gives the same rows."""

from importlib import import_module

_MODULES = ["feature_queries", "impute_queries", "parse_queries", "profile_queries", "page_queries", "model_queries"]


def _merged(name: str) -> dict:
    merged: dict = {}
    for module in _MODULES:
        entries = getattr(import_module(f"twosided.catalog.{module}"), name)
        repeated = merged.keys() & entries.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(entries)
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
