"""Queries of this subpackage: name -> plan, and the SQL that gives the same rows."""

from __future__ import annotations

import importlib

PLANS: dict = {}
SQL: dict = {}
MODULES = ("exact_dedup", "token_output", "bpe", "mixing", "langid", "jaccard_join", "ann", "url_filter", "pii", "toxicity", "collocations", "byte_bpe", "hard_negatives")


def query(name: str, sql: str | None = None):
    """Register a plan (spark, sf_dir) -> DataFrame under ``name``."""

    def add(plan):
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return add


for _name in MODULES:
    importlib.import_module(f"{__package__}.{_name}")
