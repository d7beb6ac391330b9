"""Keys: guards against unknown references, upserts and surrogate numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.sources import writers


def known(df: DataFrame, reference: DataFrame, key: str = "code_commune") -> DataFrame:
    """Rows whose key is in the reference."""
    return df.join(reference.select(key), key, "left_semi")


def unknown_keys(df: DataFrame, reference: DataFrame, key: str = "code_commune") -> DataFrame:
    """Distinct keys that are not in the reference, in order."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().join(reference.select(key), key, "left_anti").orderBy(key)


def guard_counts(df: DataFrame, reference: DataFrame, key: str = "code_commune") -> DataFrame:
    """One row (n_rows, n_kept, n_rejected, pct_rejected), from one pass over ``df``."""
    flags = df.select(key).join(reference.select(key).distinct().withColumn("ok", F.lit(True)), key, "left")
    kept = F.count_if(F.col("ok").isNotNull())
    share = F.round(F.try_divide(F.count("*") - kept, F.count("*")).cast("decimal(38,10)") * 100, 2).cast("double")
    return flags.agg(F.count("*").alias("n_rows"), kept.alias("n_kept"), (F.count("*") - kept).alias("n_rejected"), share.alias("pct_rejected"))


def load_counts(df: DataFrame, reference: DataFrame, existing: DataFrame, key: list[str], guard: str = "code_commune") -> DataFrame:
    """One row (n_rows, n_inserted, n_updated, n_skipped): what loading ``df`` into ``existing`` by key does.

    Rows whose guard column isn't in the reference are skipped; a row whose key exists updates it. A
    null key never exists. Both lookups are on distinct keys, so repeated ones count no row twice.
    """
    columns = list(dict.fromkeys([*key, guard]))
    ok = reference.select(guard).distinct().withColumn("_ok", F.lit(True))
    here = existing.select(*key).distinct().withColumn("_here", F.lit(True))
    flags = df.select(*columns).join(ok, guard, "left").join(here, key, "left")
    valid, present = F.col("_ok").isNotNull(), F.col("_here").isNotNull()
    return flags.agg(
        F.count("*").alias("n_rows"),
        F.count_if(valid & ~present).alias("n_inserted"),
        F.count_if(valid & present).alias("n_updated"),
        F.count_if(~valid).alias("n_skipped"),
    )


def upserted(existing: DataFrame, new: DataFrame, key: list[str], order: str | None = None, keep_old: bool = False) -> DataFrame:
    """As ``upsert``, with n_old and n_new: how many rows of either table had the key; ``keep_old`` lets old rows win."""
    columns = [c for c in existing.columns if c != order]
    rank = F.struct(F.lit(0) - F.col("_batch") if keep_old else F.col("_batch"), F.col(order) if order else F.lit(0))
    rows = existing.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    kept = F.max_by(F.struct(*columns), rank).alias("r")
    return rows.groupBy(*key).agg(kept, F.count_if(F.col("_batch") == 0).alias("n_old"), F.count_if(F.col("_batch") == 1).alias("n_new")).select("r.*", "n_old", "n_new")


def upsert(existing: DataFrame, new: DataFrame, key: list[str], order: str | None = None) -> DataFrame:
    """``existing`` with the rows of ``new`` put in by key; of several new rows the last by ``order`` counts.

    The result goes to a new table version: a table that is being read cannot be overwritten. Per key
    an aggregate keeps one row, so no key's rows are ever gathered.
    """
    return upserted(existing, new, key, order).drop("n_old", "n_new")


def placed(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """``df`` with the place (_nth, from 1) of each row among those of its key: with it, rows that share a key are told apart."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def merge(existing: DataFrame, new: DataFrame, key: str | list[str], policy: dict[str, str], how: str = "full_outer") -> DataFrame:
    """Upsert with a rule per column when a key exists: new, old or coalesce (new unless null).

    With ``how="right"`` the result lacks the old rows that no new one meets; a task then holds only the
    old rows of a key, where a full join holds those of both tables.
    """
    a, b = existing.alias("a"), new.alias("b")
    key = [key] if isinstance(key, str) else key

    def pick(c: str) -> Column:
        old, fresh = F.col(f"a.{c}"), F.col(f"b.{c}") if c in new.columns else F.lit(None)
        rule = policy.get(c, "old")
        matched = {"new": fresh, "old": old, "coalesce": F.coalesce(fresh, old)}[rule]
        both = all_of([F.col(f"{side}.{k}").isNotNull() for side in "ab" for k in key])
        return F.when(both, matched).otherwise(F.coalesce(old, fresh)).alias(c)

    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key], how)
    return joined.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key], *[pick(c) for c in existing.columns if c not in key])


def numbered(df: DataFrame, key: list[str], name: str = "id") -> DataFrame:
    """A stable number from 1 in key order, without a global window.

    Rows are range-partitioned by key; a row's number is its place in the partition plus the sizes of
    the partitions before, a table with a row per partition. The partitioning is checkpointed, as a
    second evaluation could cut it elsewhere. Rows with equal keys are numbered in any order.
    """
    ranged = writers.settled(df.repartitionByRange(*key).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*key))
    return ranged.withColumn("_place", place).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def all_of(conditions: list[Column]) -> Column:
    """The conjunction of optional predicates; true for none."""
    return reduce(lambda x, y: x & y, conditions, F.lit(True))
