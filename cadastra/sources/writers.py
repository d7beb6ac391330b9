"""Sinks: Parquet, CSV and JSON tables, and a folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a stored table up to which a join may broadcast it.
FEW_ROWS = 100_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (spark.checkpoint.dir), or a local one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-cadastra-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, so that all later uses see the same rows in the same partitions."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-cadastra-"))
    return df.checkpoint()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read from there: later uses evaluate nothing again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_rows(df: DataFrame, n: int) -> DataFrame:
    """``df``, of ``n`` rows at most, for the right side of a join: by a shuffle beyond FEW_ROWS.

    The planner goes by bytes on disk, and keys in Parquet are a small part of what a broadcast makes of them.
    """
    return df.hint("merge") if n > FEW_ROWS else df


def table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, overwritten as a whole; with partitions, only those that the rows touch."""
    writer = df.write.mode("overwrite")
    if partition_by:
        # rows of a partition value come together, and adaptive execution splits a value with many rows over tasks
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def small_table(df: DataFrame, path: str) -> None:
    """One file, for dimensions of some ten thousand rows."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def delimited(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", null: str = "") -> None:
    """CSV with a header and a fixed column order; ``null`` is what nulls are written as."""
    rows = df.select(*columns) if columns else df
    rows.write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", null).option("emptyValue", '""').csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sorted_table(df: DataFrame, path: str, key: str, rows_per_key: int = 1) -> None:
    """Parquet for lookups by ``key``: files cover ranges of it and hold Bloom filters of its values.

    A lookup skips row groups by their least and greatest value, and, where ranges overlap or the filter is
    a list, by the Bloom filter.
    """
    different = max(1, df.count() // rows_per_key)
    writer = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite")
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(min(different, 1 << 20))).parquet(path)


def split_by_type(df: DataFrame, column: str, path: str, kinds: list[str]) -> dict[str, str]:
    """One feed into one JSON table per record type, in one pass; returns each type's folder.

    A type without rows has no folder. Rows of other types, or none, go to folders that are not returned.
    """
    df.write.mode("overwrite").partitionBy(column).json(path)
    return {k: f"{path}/{column}={k}" for k in kinds}


def feature_collection(df: DataFrame, properties: list[str], limit: int, key: str) -> DataFrame:
    """(type, count, truncated, features): one GeoJSON-like row of at most ``limit`` features in key order.

    One row more than the limit is looked at, so truncated is exact.
    """
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.col("geometry")
    )
    rows = df.orderBy(key).limit(limit + 1).select(key, feature.alias("feature"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(key, F.to_json("feature").alias("f")))), lambda x: x["f"])
    one = rows.agg(ordered.alias("all"))
    return one.select(
        F.lit("FeatureCollection").alias("type"),
        F.least(F.size("all"), F.lit(limit)).alias("count"),
        (F.size("all") > limit).alias("truncated"),
        F.slice("all", 1, limit).alias("features"),
    )
