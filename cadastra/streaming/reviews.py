"""Incremental review intake with Structured Streaming.

The stream's state remembers for every review which of its versions counts. A batch therefore reads
nothing of what came before: it writes the rows that change something, and the table is the log of
these, of which a reader takes the one that counts per review. The log can be merged into a bucketed
table on the way.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cadastra import schemas
from cadastra.operators import reviews
from cadastra.session import SETTINGS
from cadastra.sources.buckets import BucketTable

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Columns that tell reviews apart; one without an id is told apart by its seq.
KEY = ["code_commune", "review_id", "_own"]


def _decisive(keep: str) -> StatefulProcessor:
    """Passes on a review if its seq beats every one seen under its key; the state is that seq alone."""
    beats = operator.gt if _checked(keep) == "last" else operator.lt

    # a class of its own in here travels to the workers by value: they need not have this package
    class Decisive(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.best = handle.getValueState("best", "seq long")

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            found = None
            for row in rows:
                if found is None or beats(row["seq"], found["seq"]):
                    found = row
            known = self.best.get()
            # an equal seq is the same row delivered again
            if known is None or beats(found["seq"], known[0]):
                self.best.update((found["seq"],))
                yield Row(**{c: found[c] for c in found.__fields__ if c != "_own"})

        def close(self) -> None:
            pass

    return Decisive()


def _checked(keep: str) -> str:
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    return keep


def _own(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_own", F.when(F.col("review_id").isNull(), F.col("seq")))


def _version(root: str, n: int) -> str:
    return f"{root}/reviews/batch={n}"


def _session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream, as its state needs settings that the caller's shall not get."""
    own = spark.newSession()
    for name, value in SETTINGS.items():
        own.conf.set(name, spark.conf.get(name, value))
    # Spark's own default where nobody has set it
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return own


def table_at(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """The review table that intake can merge into, made empty if it isn't there."""
    table = BucketTable(spark, path)
    if not table.exists():
        table.create(spark.createDataFrame([], schemas.REVIEW + ", _own long"), KEY, buckets)
    return table


def ingest(
    spark: SparkSession, inbox: str, root: str, checkpoint: str, max_files: int = 1000, keep: str = "first", table: BucketTable | None = None
) -> None:
    """Take in the review files that are new in ``inbox`` (JSON lines) and stop when there are no more.

    Rows need a code of five characters and a seq. Of the rows of one review (code_commune, review_id)
    the one with the least seq counts, or the greatest with ``keep="last"`` (a review that changed), in
    whatever order they are delivered; rows without an id all count. The batch number names the folder,
    so a batch that runs again after a failure replaces itself; a file delivered twice changes nothing.
    With a ``table`` (of ``table_at``) each batch is also merged into it; only the buckets of its reviews
    are read and written, and merging a batch twice is as merging it once.
    """
    stream = _session(spark).readStream.schema(schemas.REVIEW).option("maxFilesPerTrigger", max_files).json(inbox)
    valid = _own(stream.where((F.length("code_commune") == 5) & F.col("seq").isNotNull()))
    decisive = valid.groupBy(*KEY).transformWithState(_decisive(keep), schemas.REVIEW, "Append", "None")

    def take(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(_version(root, n))
        if table is not None:
            changes = _own(spark.read.schema(schemas.REVIEW).parquet(_version(root, n)))
            table.rewrite(changes, lambda old, new: counting(old.unionByName(new), keep))

    query = decisive.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def log(spark: SparkSession, root: str) -> DataFrame:
    """Every row that once counted, with the number of its batch."""
    return spark.read.schema(schemas.REVIEW + ", batch int").option("basePath", f"{root}/reviews").parquet(f"{root}/reviews")


def counting(rows: DataFrame, keep: str = "first") -> DataFrame:
    """Of the rows of each review the one that counts: an aggregate, combined before it is shuffled."""
    best = F.min_by if _checked(keep) == "first" else F.max_by
    return (rows if "_own" in rows.columns else _own(rows)).groupBy(*KEY).agg(best(F.struct(*rows.columns), "seq").alias("r")).select("r.*")


def stored(spark: SparkSession, root: str, keep: str = "first") -> DataFrame:
    """The review table."""
    return counting(log(spark, root).drop("batch"), keep)


def touched(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Municipalities that a batch changed reviews of; only their summaries need refreshing."""
    return spark.read.schema(schemas.REVIEW).parquet(_version(root, batch)).select("code_commune").distinct()


def refreshed(spark: SparkSession, root: str, batch: int, cities: DataFrame, keep: str = "first") -> DataFrame:
    """The served summaries of the municipalities that a batch touched, from all of their stored reviews.

    The semi-join leaves only the touched municipalities' reviews before any aggregate.
    """
    codes = touched(spark, root, batch)
    rows = counting(log(spark, root).drop("batch").join(codes, "code_commune", "left_semi"), keep)
    own = cities.join(codes, "code_commune", "left_semi")
    return reviews.summary(reviews.counted(own, rows).join(reviews.word_cloud(rows), "code_commune", "left"))
