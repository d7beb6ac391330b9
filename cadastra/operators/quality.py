"""Data-quality checks. Each gives rows (check, table, column, observed, threshold, passed)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _row(check: str, table: str, column: str, observed, threshold: float, passed):
    return (
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        observed.cast("double").alias("observed"), F.lit(float(threshold)).alias("threshold"), passed.alias("passed"),
    )


def required_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Missing columns, compared without case; a check of the schema, no job."""
    have = {c.lower() for c in df.columns}
    return [c for c in columns if c.lower() not in have]


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := required_columns(df, columns):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    """ValueError naming the paths that Spark can't find, in whatever store they are; called at job start."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException:
            missing.append(path)
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)}")


def volume_and_nulls(df: DataFrame, table: str, columns: list[str], least: int, ceiling: float = 0.1) -> DataFrame:
    """Row count against a minimum and each column's null rate against a ceiling, in one aggregate over all rows."""
    rates = [F.avg(F.col(c).isNull().cast("int")).alias(f"r{k}") for k, c in enumerate(columns)]
    one = df.agg(F.count("*").alias("n"), *rates)
    checks = [F.struct(*_row("volume", table, "*", F.col("n"), least, F.col("n") >= least))]
    for k, c in enumerate(columns):
        rate = F.coalesce(F.round(F.col(f"r{k}").cast("decimal(38,10)"), 6), F.lit(0))
        checks.append(F.struct(*_row("null_rate", table, c, rate, ceiling, rate <= ceiling)))
    return one.select(F.inline(F.array(*checks)))


def key_uniqueness(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """How many keys occur more than once."""
    repeated = df.groupBy(*key).count().agg(F.count_if(F.col("count") > 1).alias("n"))
    return repeated.select(*_row("key_unique", table, ",".join(key), F.col("n"), 0, F.col("n") == 0))


def references(df: DataFrame, table: str, reference: DataFrame, key: str = "code_commune") -> DataFrame:
    """How many rows have a key that the reference lacks."""
    n = df.select(key).join(reference.select(key), key, "left_anti").agg(F.count("*").alias("n"))
    return n.select(*_row("reference", table, key, F.col("n"), 0, F.col("n") == 0))


def item_drift(df: DataFrame, table: str, items: str, expected: int) -> DataFrame:
    """How many rows have another number of items than expected."""
    n = df.agg(F.count_if(F.size(items) != expected).alias("n"))
    return n.select(*_row("item_count", table, items, F.col("n"), 0, F.col("n") == 0))


def announced_but_absent(df: DataFrame, table: str, pages: str, items: str) -> DataFrame:
    """How many rows announce several pages (column ``pages``) but hold no item (array ``items``)."""
    n = df.agg(F.count_if((F.col(pages) > 1) & (F.size(items) <= 0)).alias("n"))
    return n.select(*_row("items_announced", table, items, F.col("n"), 0, F.col("n") == 0))
