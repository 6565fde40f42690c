"""Plans: the catalog of registered queries and the modules that fill it."""

from __future__ import annotations

import importlib
from types import ModuleType

MODULES = ("breakdowns", "trends", "texts", "matches", "domain", "resolve", "records", "streams", "deep", "sinks")


def load() -> ModuleType:
    """The catalog, with every plan module imported."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}.catalog")
