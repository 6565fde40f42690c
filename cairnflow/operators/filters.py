"""Filters that callers compose: the list filter, text search, presence tests."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class FilterSpec:
    """What a list request may ask for; unset parts do not filter."""

    equal: dict[str, object] = field(default_factory=dict)
    any_of: dict[str, list] = field(default_factory=dict)
    at_least: dict[str, object] = field(default_factory=dict)
    at_most: dict[str, object] = field(default_factory=dict)
    present: dict[str, bool] = field(default_factory=dict)
    search: str | None = None
    search_in: tuple[str, ...] = ()

    def condition(self) -> Column:
        """One predicate, of parts that Catalyst can push to the scan."""
        parts = [F.col(c) == v for c, v in self.equal.items()]
        parts += [F.col(c).isin(v) for c, v in self.any_of.items()]
        parts += [F.col(c) >= v for c, v in self.at_least.items()]
        parts += [F.col(c) <= v for c, v in self.at_most.items()]
        parts += [F.col(c).isNotNull() if wanted else F.col(c).isNull() for c, wanted in self.present.items()]
        if self.search and self.search.strip():
            text = self.search.strip().lower()
            parts.append(reduce(Column.__or__, [F.coalesce(F.contains(F.lower(F.col(c)), F.lit(text)), F.lit(False)) for c in self.search_in]))
        return reduce(Column.__and__, parts, F.lit(True))


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    return df.where(spec.condition())


def live(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent exists."""
    return df.join(parents.select(key), key, "left_semi")


def orphans(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows without a parent; a null key is an orphan."""
    return df.join(parents.select(key), key, "left_anti")


def ranked(value: Column, ranks: dict[str, int], other: int = 0) -> Column:
    """The rank of a label, as for sorting by severity."""
    out = F.lit(other)
    for label, rank in ranks.items():
        out = F.when(F.lower(F.trim(value)) == label, F.lit(rank)).otherwise(out)
    return out
