"""Dates in the forms the sources use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """Date from yyyy-MM-dd, dd/MM/yyyy or d/M/yyyy; null for other text and days that don't exist."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "dd/MM/yyyy"), F.try_to_date(text, "d/M/yyyy"))


def iso(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def label_to_iso(label: Column) -> Column:
    """ISO text from a label with dd-MM-yyyy and perhaps à HH:mm; null if there is no date."""
    words = F.split(F.trim(label), r"\s+")
    day = F.get(F.filter(words, lambda w: w.rlike("^[0-9]{2}-[0-9]{2}-[0-9]{4}$")), 0)
    hour = F.get(F.filter(words, lambda w: w.rlike("^[0-9]{2}:[0-9]{2}$")), 0)
    written = F.concat(F.right(day, F.lit(4)), F.substring(day, 3, 4), F.left(day, F.lit(2)))
    return F.concat(written, F.coalesce(F.concat(F.lit("T"), hour), F.lit("")))


def year_in_text(text: Column, default: int = 2024) -> Column:
    """The first year 20xx in a text, else the default."""
    return F.coalesce(F.regexp_extract(text, r"20\d{2}", 0).try_cast("int"), F.lit(default))


def is_fresh(date: Column, as_of: Column, days: int = 30) -> Column:
    """True if the date is at most ``days`` before ``as_of``; null dates are stale."""
    return F.coalesce(date >= F.date_sub(as_of, days), F.lit(False))
