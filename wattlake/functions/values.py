"""Maps, strict lookups and required values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(value: Column, what: str) -> Column:
    """The value itself; a null fails the job and names what was missing."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"missing {what}")))


def key_union(left: Column, right: Column) -> Column:
    """All keys of two maps; a null map has none."""
    none = F.array().cast("array<string>")
    return F.array_union(
        F.coalesce(F.map_keys(left), none), F.coalesce(F.map_keys(right), none)
    )


def value_or(mapping: Column, key: Column, default: Column) -> Column:
    """Value of a key; the default only where the key is absent, so a stored null stays null."""
    return F.when(F.map_contains_key(mapping, key), mapping[key]).otherwise(default)


def strict_group(value: Column, groups: Mapping[str, Iterable[str]]) -> Column:
    """Name of the group listing the value; an unlisted value fails the job, null stays null."""
    entries = [F.lit(x) for group, members in groups.items() for m in members for x in (m, group)]
    group = F.create_map(*entries)[value]
    unknown = F.raise_error(F.concat(F.lit("no group lists the value: "), value))
    return F.when(value.isNull(), F.lit(None)).otherwise(F.coalesce(group, unknown))


def total(value: Column) -> Column:
    """A sum that is 0 where there is nothing but nulls to add."""
    return F.coalesce(F.sum(value), F.lit(0.0))
