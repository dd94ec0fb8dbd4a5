"""Row predicates as Column expressions, so that scans can push them down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_false(column: str) -> Column:
    """True only for TRUE: a nullable flag compared with FALSE also drops NULL."""
    return F.col(column) != F.lit(False)


def since_months(column: str, as_of: str, months: int = 12) -> Column:
    """On or after the date ``months`` before ``as_of`` (an ISO date, never the clock)."""
    return F.col(column) >= F.add_months(F.lit(as_of).cast("date"), -months)


def all_equal(expected: dict[str, object]) -> Column:
    """Conjunction of strict tests; ``None`` asks for NULL, and the result is never NULL."""
    tests = (
        F.col(name).isNull() if value is None else F.col(name).eqNullSafe(F.lit(value))
        for name, value in expected.items()
    )
    return reduce(Column.__and__, tests)


def contains(column: str, piece: str) -> Column:
    return F.col(column).like(f"%{piece}%")


def has(attribute: str, value: object) -> Column:
    """One ``attribute:value`` search term. Combine terms with ``|`` and ``&``."""
    return F.coalesce(F.col(attribute) == F.lit(value), F.lit(False))


def dimensions_match(dimensions: str, wanted: dict[str, str]) -> Column:
    """Every wanted entry is present in a map column."""
    tests = (
        F.coalesce(F.try_element_at(F.col(dimensions), F.lit(key)) == F.lit(value), F.lit(False))
        for key, value in wanted.items()
    )
    return reduce(Column.__and__, tests)


def event_schema(pattern: dict) -> str:
    """DDL of just the paths an event pattern names."""
    fields = (
        f"`{name}` STRUCT<{event_schema(wanted)}>" if isinstance(wanted, dict) else f"`{name}` STRING"
        for name, wanted in pattern.items()
    )
    return ", ".join(fields)


def event_matches(event: Column, pattern: dict) -> Column:
    """Each path of ``pattern`` must hold one of its listed values; ``event`` is a struct."""
    tests = (
        event_matches(event[name], wanted)
        if isinstance(wanted, dict)
        else F.coalesce(event[name].isin(list(wanted)), F.lit(False))
        for name, wanted in pattern.items()
    )
    return reduce(Column.__and__, tests)


def json_event_matches(column: str, pattern: dict) -> Column:
    """The same test on a JSON text column; only the named paths are parsed."""
    return event_matches(F.from_json(F.col(column), event_schema(pattern)), pattern)
