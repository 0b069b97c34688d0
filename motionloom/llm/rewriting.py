"""Replacing the matches of a pattern by an expression of the match, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def rebuilt(text: Column, pattern: str, found: Column, new: Callable[[Column], Column]) -> Column:
    """``text`` with element k of ``found`` (one for each match of ``pattern``) turned into text k by ``new``."""
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, m: F.concat(gap, new(m)))
    return F.when(F.size(found) > 0, F.concat(F.array_join(pairs, ""), F.element_at(gaps, -1))).otherwise(text)
