"""Municipality and department codes: always text, five characters, zero-padded."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad(code: Column, width: int = 5) -> Column:
    """Zero-pad on the left; longer codes stay whole (``lpad`` alone would cut them)."""
    return F.when(F.char_length(code) >= width, code).otherwise(F.lpad(code, width, "0"))


def is_present(code: Column) -> Column:
    return code.isNotNull() & (F.length(F.trim(code)) > 0)


def has_length(code: Column, n: int = 5) -> Column:
    return F.length(code) == n


def department(code: Column) -> Column:
    """Two characters, three for overseas codes (97x); Corsica keeps its letter."""
    return F.when(code.startswith("97"), F.substring(code, 1, 3)).otherwise(F.substring(code, 1, 2))


def from_url(url: Column) -> Column:
    """The code at the end of a path like /lutry_90101, else null."""
    return F.nullif(F.regexp_extract(url, "_([0-9AB]{5})$", 1), F.lit(""))


def any_prefix(code: Column, prefixes: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [code.startswith(p) for p in prefixes], F.lit(False))


def in_departments(code: Column, departments: Iterable[str]) -> Column:
    wanted = list(departments)
    return F.substring(code, 1, 2).isin(wanted) | F.substring(code, 1, 3).isin(wanted)


def first_present(*columns: Column) -> Column:
    """The first that is neither null nor blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])
