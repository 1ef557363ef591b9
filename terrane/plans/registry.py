"""All queries of the package by name, and the SQL that gives the same rows."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrane.plans import control, game, measures, records, rule_queries, scalars, series, sets_and_codes, shapes, stores, time_and_rules, upkeep

MODULES = (time_and_rules, measures, sets_and_codes, series, upkeep, shapes, scalars, rule_queries, game, records, stores, control)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for m in MODULES for n, f in vars(m).items() if inspect.isfunction(f) and f.__module__ == m.__name__ and n[0] != "_"}


def oracle_sql() -> dict[str, str]:
    return {n: s.strip() for m in MODULES for n, s in m.SQL.items()}
