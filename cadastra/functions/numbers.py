"""Numbers from text, guarded ratios and one rounding rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(text: Column) -> Column:
    """Double from text with a decimal comma or point; null if it isn't a number."""
    return F.trim(F.replace(text, F.lit(","), F.lit("."))).try_cast("double")


def to_double(value: Column) -> Column:
    """Double, with null for what isn't a number and for NaN."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_int(value: Column) -> Column:
    """Integer; accepts text like 3.0, gives null for what isn't a number."""
    return to_double(value).try_cast("int")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value, so that 1.005 gives 1.01."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """Rounded quotient where the divisor is positive, else null."""
    return F.when(bottom > 0, rounded(F.try_divide(top, bottom), digits))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
