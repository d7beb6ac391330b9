"""Loads into bucketed tables: a guarded load that counts as it stages, and numbers that survive reloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import keys
from cadastra.sources import writers
from cadastra.sources.buckets import BucketTable

STATUS = "_status"


@dataclass
class Loaded:
    """What a load did: counts of its rows, the rows without a known guard, the buckets it wrote."""

    counts: dict[str, int]
    rejects: DataFrame
    buckets: set[int]

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row (n_rows, n_inserted, n_updated, n_skipped)."""
        return spark.createDataFrame([tuple(self.counts.values())], ", ".join(f"{c} long" for c in self.counts))


def guarded(table: BucketTable, rows: DataFrame, reference: DataFrame, guard: str = "code_commune", order: str | None = None, mode: str = "upsert") -> Loaded:
    """Load ``rows`` into ``table``: those whose guard column is in ``reference``, the rest is refused.

    One pass marks the rows and stages them in a folder per mark; the load and the refused rows both read the
    stage. The write that puts rows in counts what it inserts and updates, from the old rows of the
    buckets it rewrites anyway. With ``mode="insert"`` rows whose key exists are skipped too. A row counts by
    whether its key was there before the load, so two new rows of one key are both inserted ones, and the
    last by ``order`` is what the table holds. A null guard is never known; null keys are keys.
    """
    if mode not in ("upsert", "insert"):
        raise ValueError("mode is upsert or insert")
    spark, own = rows.sparkSession, table.key
    ok = reference.select(F.col(guard).alias("_guard")).distinct()
    known = rows.join(ok, F.col(guard) == F.col("_guard"), "left")
    marked = known.withColumn(STATUS, F.when(F.col("_guard").isNull(), "refused").otherwise("known")).drop("_guard")
    staged, loaded = Observation(), Observation()
    path = writers.scratch(spark, "stage")
    marked.observe(staged, F.count(F.lit(1)).alias("n"), F.count_if(F.col(STATUS) == "refused").alias("refused")).write.partitionBy(STATUS).parquet(path)
    stage = spark.read.schema(marked.schema).parquet(path)

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        there = F.col("n_old") > 0
        return keys.upserted(old, new, own, order, keep_old=mode == "insert").observe(
            loaded, F.sum(F.when(~there, F.col("n_new")).otherwise(0)).alias("inserted"), F.sum(F.when(there, F.col("n_new")).otherwise(0)).alias("matched")
        )

    touched = table.rewrite(stage.where(F.col(STATUS) == "known").drop(STATUS), combine)
    put = loaded.get if touched else {}
    inserted, matched = int(put.get("inserted") or 0), int(put.get("matched") or 0)
    skipped = int(staged.get["refused"]) + (matched if mode == "insert" else 0)
    counts = {"n_rows": int(staged.get["n"]), "n_inserted": inserted, "n_updated": 0 if mode == "insert" else matched, "n_skipped": skipped}
    return Loaded(counts, stage.where(F.col(STATUS) == "refused").drop(STATUS), touched)


class KeyRegistry:
    """Numbers for natural keys that stay the same from load to load and are never given twice."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], name: str = "id", buckets: int = 64):
        self.table, self.key, self.name, self.buckets = BucketTable(spark, path), key, name, buckets

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each row's key; keys without one get the next numbers, in key order.

        Only the buckets that the keys of ``df`` fall into are read, and new keys are added beside them.
        Rows with a null in the key get no number.
        """
        whole = keys.all_of([F.col(c).isNotNull() for c in self.key])
        wanted = writers.stored(df.where(whole).select(*self.key).distinct())
        if not self.table.exists():
            none = wanted.where("false").withColumn(self.name, F.lit(0).cast("long"))
            self.table.create(none, self.key, self.buckets)
        n = wanted.count()
        fresh = writers.stored(wanted.join(writers.by_rows(self.table.lookup(wanted), n), self.key, "left_anti"))
        # the table's note is the last number given
        last, more = self.table.note, fresh.count()
        if more:
            given = keys.numbered(fresh, self.key, self.name).select(*self.key, (F.col(self.name) + last).cast("long").alias(self.name))
            self.table.append(given, last + more)
        return df.join(writers.by_rows(self.table.lookup(wanted), n), self.key, "left")
