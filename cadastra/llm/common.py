"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Removes a query's shuffle files as soon as it ends; what it gave is in the stored table by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between jobs: the session's ``spark.checkpoint.dir``.

    Only where that is unset (tests, a single machine) a local one is made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-cut-"))
    return named or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the shared folder and go on from there, so lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from there.

    Like ``cut``, but compressed, by column, and without the shuffle files of the query. ``discard``
    removes the table when nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has written."""
    for found in tables:
        hadoop = found.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
        for folder in {f.rpartition("/")[0] for f in found.inputFiles()}:
            path = hadoop.Path(folder)
            path.getFileSystem(found.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows that a model must not learn from: crc32 of the id as text, by remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def labelled_sample(rows: DataFrame, label: str, per_class: int, seed: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` rows of each non-null label, chosen by a hash of the id.

    ``rows`` holds doc_id and the label. The bound is what makes it safe to fit a model from these
    rows on the driver. Two passes whatever the number of labels: counts give each label a hash
    threshold at twice its share, then a window orders only the rows below it.
    """
    keyed = rows.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).alias("label"), F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("order")
    )
    share = F.floor(F.lit(2.0 * per_class * (1 << 20)) / F.count("*")) + 1
    shares = keyed.groupBy("label").agg(share.alias("share"))
    few = keyed.join(shares, "label").where(F.pmod("order", F.lit(1 << 20)) < F.col("share"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("order", "doc_id"))
    return few.withColumn("place", place).where(F.col("place") <= per_class).select("doc_id", "label")


def ranked(df: DataFrame, order: list[str | Column], name: str = "place") -> DataFrame:
    """``df``, stored in the shared folder, with every row's place from 0 in the given order over all rows.

    One range partitioning: a row's place is that in its partition plus the sizes of the partitions
    before, of which only the sizes reach the driver. Rows alike in ``order`` follow in any order; let
    it end in a column that tells rows apart where many may be alike. ``df`` should be a stored table, as
    the ranges are found by sampling it first.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = stored(spread.withColumn(name, F.monotonically_increasing_id()))
    part, within = F.shiftright(name, 33), F.col(name).bitwiseAND((1 << 33) - 1)
    sizes = dict(fixed.groupBy(part.alias("part")).count().collect())
    # partitions without rows have no size
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    return fixed.withColumn(name, F.get(F.lit(before or [0]).cast("array<bigint>"), part.cast("int")) + within)
