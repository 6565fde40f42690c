"""Registered queries: name -> (Spark plan, equivalent SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``, with the SQL that gives the same rows."""

    def add(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return add
