"""Every operator as a query over the given tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("rowwise", "grouped", "encoders", "builders", "scoring")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        out.update(getattr(import_module(f"{__name__}.{name}"), attribute))
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracles() -> dict[str, str]:
    return _merged("ORACLES")
