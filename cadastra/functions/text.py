"""Text: tokens, similarity, labels and fields of review pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.schemas import LETTERS, STOP_WORDS

#: Characters of words in trigrams.
WORD = "a-z0-9à-ÿ"


def tokens(text: Column, least: int = 3) -> Column:
    """Lower-case runs of letters of at least ``least`` characters that are no stop words, in order."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[{LETTERS}]+"), 0)
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(found, lambda t: (F.length(t) >= least) & ~F.array_contains(stop, t))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the lower-cased words, each padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(text), f"[^{WORD}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(
        F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3)))))
    )


def similarity(a: Column, b: Column) -> Column:
    """Shared over all distinct trigrams, 0 for two texts without any."""
    x, y = trigrams(a), trigrams(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0))


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.lower(text).contains(part.lower())


def is_true(text: Column) -> Column:
    """True for true, 1 and oui in any case; null stays null."""
    return F.lower(F.trim(text.cast("string"))).isin("true", "1", "oui")


def clean_name(text: Column) -> Column:
    """No-break spaces become spaces, no-break hyphens hyphens; trimmed."""
    return F.trim(F.translate(text, " ‑", " -"))


def rank(text: Column) -> Column:
    """Text like 4/52 from '4ème / 52', else null."""
    part = lambda k: F.regexp_extract(text, r"(\d+)\s*ème\s*/\s*(\d+)", k)
    return F.when(part(1) != "", F.concat(part(1), F.lit("/"), part(2)))


def rank_parts(ranked: Column) -> Column:
    """struct(place, total) of a rank like 4/52."""
    part = lambda k: F.split_part(ranked, F.lit("/"), F.lit(k)).try_cast("int")
    return F.struct(part(1).alias("place"), part(2).alias("total"))


def ranked_cities(text: Column) -> Column:
    """The number before 'villes', written with blanks or no-break blanks."""
    digits = F.regexp_replace(F.regexp_extract(text, "([0-9][0-9   ]*)villes", 1), "[   ]", "")
    return digits.try_cast("int")


def page_count(text: Column) -> Column:
    """N of 'Page : i / N', 1 if absent."""
    return F.coalesce(F.regexp_extract(text, r"Page\s*:\s*\d+\s*/\s*(\d+)", 1).try_cast("int"), F.lit(1))


def numeric_token(items: Column, place: int) -> Column:
    """The place-th (from 0) purely numeric text of an array, as an integer."""
    return F.get(F.filter(items, lambda t: F.trim(t).rlike("^[0-9]+$")), place).try_cast("int")


def labelled_paragraph(block: Column, kind: str) -> Column:
    """Lines of the paragraph whose bold label holds 'points <kind>', without the label; null if empty."""
    body = F.regexp_extract(block, rf"(?s)<p[^>]*>\s*<b>[^<]*points {kind}[^<]*</b>(.*?)</p>", 1)
    lines = F.filter(F.transform(F.split(body, "<[^>]*>|\n"), lambda t: F.trim(t)), lambda t: t != "")
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def as_struct(values: Column, names: list[str], kind: str) -> Column:
    """Positional values as a struct; missing ones are null."""
    return F.struct(*[F.get(values, k).try_cast(kind).alias(n) for k, n in enumerate(names)])
