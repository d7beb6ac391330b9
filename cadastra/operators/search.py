"""Text search by an inverted index of trigrams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import text

BUCKET = "_bucket"


def required(query: str) -> list[str]:
    """Trigrams that every text containing ``query`` (in any case) has; none for very short words.

    Words at the ends of the query may go on in the text, so only the trigrams inside of them are sure;
    where a separator stands beside a word in the query, it does in the text.
    """
    low, found = query.lower(), []
    for m in re.finditer(f"[{text.WORD}]+", low):
        padded = ("  " if m.start() else "") + m.group() + (" " if m.end() < len(low) else "")
        found += [padded[i : i + 3] for i in range(len(padded) - 2)]
    return list(dict.fromkeys(found))


class TrigramIndex:
    """(trigram, key, n): a row for each trigram of a text, and how many different ones that text has.

    A key stands for one text; where none of the columns does, the text itself is the key, each one once.
    Written in folders by a hash of the trigram and sorted by it, so a search reads the folders of its
    own trigrams and skips row groups of others. A trigram that most texts have spans several files.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def build(self, df: DataFrame, column: str) -> None:
        found = df.select(self.key, text.trigrams(F.col(column)).alias("t")).where(F.size("t") > 0)
        rows = found.select(F.explode("t").alias("trigram"), self.key, F.size("t").alias("n"))
        dealt = rows.withColumn(BUCKET, F.pmod(F.xxhash64("trigram"), F.lit(self.buckets)).cast("int"))
        order = [BUCKET, "trigram", self.key]
        dealt.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def postings(self, trigrams: list[str]) -> DataFrame:
        """The rows of some trigrams; their folders and values are literals, so other files are not opened."""
        own = F.pmod(F.xxhash64("t"), F.lit(self.buckets)).cast("int")
        given = self.spark.createDataFrame([(t,) for t in trigrams], "t string")
        folders = [r[0] for r in given.select(own).distinct().collect()]
        return self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(folders) & F.col("trigram").isin(trigrams)).drop(BUCKET)

    def candidates(self, query: str) -> DataFrame | None:
        """(key, score): texts with all required trigrams and their similarity to ``query``; None if none is required."""
        sure = required(query)
        if not sure:
            return None
        asked = self.spark.createDataFrame([(query,)], "q string").select(text.trigrams(F.col("q"))).first()[0]
        # the similarity needs the query's own trigrams, the filter the sure ones; a trigram is read once
        every = list(dict.fromkeys([*asked, *sure]))
        hits = self.postings(every).groupBy(self.key).agg(
            F.count_if(F.col("trigram").isin(sure)).alias("held"), F.count_if(F.col("trigram").isin(asked)).alias("shared"), F.max("n").alias("n")
        )
        score = F.col("shared") / (F.col("n") + len(asked) - F.col("shared"))
        return hits.where(F.col("held") == len(sure)).select(self.key, score.alias("score"))
