"""Exact medians by refining a histogram, so that no key's values are ever held together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.sources import writers

#: Different values of a key that a last window may order; bounds of a histogram.
BAND, PARTS = 1 << 16, 64


def exact(df: DataFrame, key: list[str], value: str, name: str = "median", band: int = BAND) -> DataFrame:
    """(key, name, n): the exact median (the mean of the middle two) and count of non-null values per key.

    Values are first counted by (key, value), which spreads a key with most rows over its values. Where a
    key has more than ``band`` different ones, rounds of a histogram follow: the bounds are approximate
    quantiles of the values still in question, the counts between them are exact, and only the parts
    that hold the two middle ranks stay. Each round leaves about 2 in PARTS of the values; how many
    are needed follows from the largest key. The last step orders at most about ``band`` values a key.
    Null keys group like any value; NaN is greater than any number.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*key, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    counts = writers.stored(counts, "counts")
    totals = counts.groupBy(*key).agg(F.sum("_n").alias("_total"), F.count("*").alias("_values"))
    most = totals.agg(F.max("_values")).first()[0] or 0
    # 0-based ranks of the two middle rows, and how many rows lie below the values still in question
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    columns = [*key, "_v", "_n", "_total", "_below"]
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key]
    left = counts.alias("c").join(totals.alias("t"), same("c", "t")).select("c.*", "_total", F.lit(0).cast("long").alias("_below"))
    while most > band:
        left, most = _refined(left, key, columns, low, high, band), -(-most * 3 // PARTS)
        left = writers.stored(left, "counts")
    place = Window.partitionBy(*key).orderBy("_v")
    upto = F.sum("_n").over(place.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_below")
    middle = left.withColumn("_upto", upto).where((F.col("_upto") > low) & (F.col("_upto") - F.col("_n") <= high))
    # one row if both ranks fall on one value, else the two
    return middle.groupBy(*key).agg((F.min("_v") * 0.5 + F.max("_v") * 0.5).alias(name), F.max("_total").alias("n"))


def _refined(left: DataFrame, key: list[str], columns: list[str], low, high, band: int) -> DataFrame:
    """Rows of ``left`` in the parts that hold the middle ranks; keys with few values stay as they are."""
    shares = [k / PARTS for k in range(1, PARTS)]
    bounds = left.groupBy(*key).agg(F.when(F.count("*") > band, F.percentile_approx("_v", shares, 100 * PARTS)).otherwise(F.array()).alias("_bounds"))
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key]
    dealt = left.alias("l").join(bounds.alias("b"), same("l", "b")).select(*[F.col(f"l.{c}") for c in columns], "_bounds")
    dealt = dealt.withColumn("_part", F.size(F.filter("_bounds", lambda b: b < F.col("_v")))).drop("_bounds")
    parts = dealt.groupBy(*key, "_part").agg(F.sum("_n").alias("_in"), F.max("_total").alias("_total"), F.max("_below").alias("_below"))
    # at most PARTS rows a key
    upto = F.sum("_in").over(Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_below")
    held = parts.withColumn("_to", upto).where((F.col("_to") > low) & (F.col("_to") - F.col("_in") <= high))
    spans = held.groupBy(*key).agg(F.min("_part").alias("_from_part"), F.max("_part").alias("_to_part"), F.min(F.col("_to") - F.col("_in")).alias("_start"))
    kept = dealt.alias("l").join(spans.alias("s"), same("l", "s")).where(F.col("_part").between(F.col("_from_part"), F.col("_to_part")))
    return kept.select(*[F.col(f"l.{c}") for c in columns if c != "_below"], F.col("_start").alias("_below"))
