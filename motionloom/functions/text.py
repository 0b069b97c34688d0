"""Small text rules: pipe lists, identifiers, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import floor_div


def lookup(value: Column, mapping: dict) -> Column:
    """Value of a fixed vocabulary, NULL when absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[value]


def listed_rate_hz(names: Column, periods_ms: Column, name: str) -> Column:
    """Rate of the stream ``name`` from two parallel pipe lists (names, periods in ms)."""
    position = F.array_position(F.split(names, r"\|"), name).cast("int")
    period = F.when(position > 0, F.try_element_at(F.split(periods_ms, r"\|"), position))
    ms = F.trim(period).try_cast("double")
    return F.when(ms > 0, F.lit(1000.0) / ms)


def session_key(start_ns: Column) -> Column:
    """16 hex digits standing for a start instant in Unix milliseconds."""
    return F.substring(F.sha2(floor_div(start_ns, 1_000_000).cast("string"), 256), 1, 16)


def natural_key(value: Column) -> Column:
    """Text that sorts numbers inside ids by value: ``P2`` before ``P10``.

    Leading zeros go, and the number of digits left stands before them, so numbers of any length compare by value.
    """
    parts = F.regexp_extract_all(F.lower(value), F.lit(r"(\d+|\D+)"), F.lit(1))

    def keyed(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+", "")
        return F.when(part.rlike(r"^\d"), F.concat(F.lpad(F.length(digits).cast("string"), 9, "0"), digits)).otherwise(part)

    return F.array_join(F.transform(parts, keyed), "")


def present(value: Column) -> Column:
    """Neither NULL nor blank."""
    return F.coalesce(F.trim(value) != "", F.lit(False))
