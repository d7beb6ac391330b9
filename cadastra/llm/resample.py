"""Target-distribution importance resampling with segment deduplication.

Newlines, which separate words, cut the texts into lines. Equal lines are brought together and the bucket
counts of their words and word pairs are computed once, multiplied by occurrences for the corpus's
counts; pairs across a line end are added separately. Both meet again in a document's weight: every
distinct line's gain is computed once and joined to its occurrences.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import ranked, stored

BUCKETS = 10_000
#: Share of the documents with at least LEAST words that are drawn, and the seed of the draw.
PERCENT, LEAST, SEED = 25, 20, 7
#: Words whose checksums a task remembers at once.
REMEMBERED = 1 << 18
#: Every byte that is no part of a word becomes a blank, A-Z become small.
_WORDS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_NONE = np.zeros(0, dtype=np.uint16)


class _Words(dict):
    """Of each word: its checksum, and itself behind a blank."""

    def __missing__(self, word: bytes) -> tuple[int, bytes]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word), b" " + word
        return found


def line_buckets(line: bytes, known: dict) -> list[int]:
    """Buckets of the words of a line (in small letters, blanks between) and of its pairs, repeats included."""
    words = line.split()
    if not words:
        return []
    found = [known[w] for w in words]
    out = [c % BUCKETS for c, _ in found]
    # the checksum of a pair goes on from that of its first word
    out += [zlib.crc32(b, c) % BUCKETS for (c, _), (_, b) in zip(found, found[1:])]
    return out


def cross_buckets(lines: list[bytes]) -> list[int]:
    """Buckets of the pairs whose words lie in two lines; lines without a word do not part them."""
    solid = [x for x in lines if x and not x.isspace()]
    ends = [x.rsplit(None, 1)[-1] for x in solid[:-1]]
    return [zlib.crc32(b" " + b.split(None, 1)[0], zlib.crc32(a)) % BUCKETS for a, b in zip(ends, solid[1:])]


def segments(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, occurrences, n_words, buckets) of every distinct line; equal lines are combined before they are shuffled.

    ``key`` is the line's sha256, ``buckets`` an array of unsigned 16-bit numbers: its features, once.
    """
    schema = "key binary, occurrences long, n_words int, buckets binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            keys, words, buckets = [], [], []
            for line in batch.column(0):
                raw = line.as_py()
                found = line_buckets(raw.translate(_WORDS), known)
                keys.append(hashlib.sha256(raw).digest())
                words.append((len(found) + 1) // 2)
                buckets.append(array("H", found).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(1), pa.array(words, pa.int32()), pa.array(buckets, pa.binary())], ["key", "occurrences", "n_words", "buckets"])

    lines = texts.where(F.col(text_col).isNotNull()).select(F.explode(F.split(text_col, "\n")).alias("line"))
    once = lines.groupBy("line").agg(F.count("*").alias("occurrences"))
    return once.select(F.col("line").cast("binary").alias("line"), "occurrences").mapInArrow(run, schema)


def outlines(texts: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(row, id, lines, cross) of every row: a number of its own, the keys of its lines, the buckets across line ends."""
    names = ["row", "id", "lines", "cross"]
    schema = T.StructType([*map(T.StructField, names, [T.LongType(), texts.schema[id_col].dataType, T.ArrayType(T.BinaryType()), T.BinaryType()])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cross = [], []
            for text in batch.column(2):
                raw = text.as_py()
                lines = [] if raw is None else raw.split(b"\n")
                keys.append([hashlib.sha256(x).digest() for x in lines])
                cross.append(array("H", cross_buckets([x.translate(_WORDS) for x in lines])).tobytes())
            arrays = [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.binary())), pa.array(cross, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return texts.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def _counted(buckets: DataFrame) -> DataFrame:
    """(bucket, n) per task, of rows (occurrences, buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            own = [np.frombuffer(x.as_py(), dtype=np.uint16) for x in batch.column(1)]
            times = np.repeat(np.asarray(batch.column(0), dtype=np.int64), list(map(len, own)))
            # sums of a batch stay far below 2**53, where doubles are exact
            total += np.bincount(np.concatenate([_NONE, *own]), weights=times, minlength=BUCKETS).astype(np.int64)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full])], ["bucket", "n"])

    return buckets.mapInArrow(run, "bucket int, n long")


def totals(lines: DataFrame, rows: DataFrame) -> np.ndarray:
    """Count of every bucket over whole texts; one row per bucket reaches the driver."""
    parts = _counted(lines.select("occurrences", "buckets")).union(_counted(rows.select(F.lit(1).cast("long"), "cross")))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, in doubles."""
    s, t = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratio = ((target + 1.0) * s) / ((corpus + 1.0) * t)
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], dtype=np.int64)


def _gained(rows: DataFrame, column: str, gain: np.ndarray) -> DataFrame:
    """``rows`` with ``column``, an array of buckets, replaced by the sum of their gains."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    names = rows.columns
    place = names.index(column)
    schema = T.StructType([T.StructField("gain", T.LongType()) if c.name == column else c for c in rows.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_py(), dtype=np.uint16) for x in batch.column(place)]
            ends = np.cumsum([0, *map(len, own)])
            sums = np.concatenate([[0], np.cumsum(shared.value[np.concatenate([_NONE, *own])])])
            arrays = list(batch.columns)
            arrays[place] = pa.array((sums[ends[1:]] - sums[ends[:-1]]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(run, schema)


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row of ``docs``; weights favour what ``target`` has more of.

    Words are runs of ASCII digits, letters (A-Z in small ones) and non-ASCII characters; null texts have
    none and weigh 0. Null and repeated ids are kept, each row is weighed. Lines and outlines are stored
    in the shared folder; a line of very many documents is a hot key of one join against a table with one
    row per line, which adaptive execution splits.
    """
    lines, rows = stored(segments(docs, text_col)), stored(outlines(docs, id_col, text_col))
    other = target.select(F.lit(0).alias("id"), F.col(text_col).alias("text"))
    gain = gains(totals(lines, rows), totals(segments(other), outlines(other, "id")))
    per_line = _gained(lines.select("key", "n_words", "buckets"), "buckets", gain)
    across = _gained(rows.select("row", "id", "cross", (F.octet_length("cross") / 2).cast("long").alias("n")), "cross", gain)
    # a pair across a line end is a feature without a word of its own, so it counts as one feature and no word
    ends = across.select("row", "id", F.lit(0).cast("long").alias("n_words"), F.col("n").alias("n_features"), "gain")
    found = (
        rows.select("row", "id", F.explode("lines").alias("key"))
        .join(per_line, "key")
        .select("row", "id", F.col("n_words").cast("long"), F.greatest(2 * F.col("n_words") - 1, F.lit(0)).cast("long").alias("n_features"), "gain")
    )
    whole = found.union(ends).groupBy("row", "id").agg(*[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
    mean = F.expr("IF(n_features = 0, 0L, (gain - pmod(gain, n_features)) div n_features)")
    return whole.select(F.col("id").alias(id_col), "n_words", "n_features", mean.alias("weight"))


def noise(id_: Column, seed: int = SEED) -> Column:
    """What is added to a weight: Gumbel noise in thousandths from a hash of the id; a null id hashes as an empty one."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank is 1, 2, 3... for those drawn, else null.

    Of the N rows with at least ``least`` words, floor(percent * N / 100) with the highest scores are
    drawn: a sample without replacement by weight. Ties go to the smaller id, null ids last; rows alike
    in score and id in any order. An empty table gives an empty result, an empty target weighs all by
    rarity.
    """
    weighed = weigh(docs, target, id_col, text_col).withColumnRenamed(id_col, "id").withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    fixed = stored(weighed.withColumn("able", F.col("n_words") >= least))
    drawn = fixed.where("able").count() * percent // 100
    placed = ranked(fixed, [F.desc("able"), F.desc("score"), F.asc_nulls_last("id")])
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))


def keep_drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns kept; ids should be unique and not null."""
    drawn = resample(docs, target, id_col=id_col, **settings).where(F.col("rank").isNotNull())
    return docs.join(drawn.select(id_col), id_col, "left_semi").select(docs.columns)


#: crc32 by its shift register, eight steps a byte.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), CAST(2 * i + 1 AS INTEGER), 2))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""
_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, {_SQL_WORDS} AS w FROM documents UNION ALL SELECT 'b', NULL, {_SQL_WORDS} FROM benchmark
), rows AS MATERIALIZED (
  SELECT row_number() OVER () AS row, side, id, len(w) AS n_words, w || list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2]) AS f FROM texts
), feats AS MATERIALIZED (
  SELECT row, side, f, count(*) AS n FROM (SELECT row, side, unnest(f) AS f FROM rows) GROUP BY ALL
), known AS MATERIALIZED (
  SELECT f, xor({_CRC}, 4294967295) % {BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM feats)
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM feats JOIN known USING (f) GROUP BY bucket
), gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + {BUCKETS})) / ((s + 1) * (sum(t) OVER () + {BUCKETS}))))::BIGINT AS gain FROM counts
), summed AS (
  SELECT row, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS g FROM feats JOIN known USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), weighed AS (
  SELECT r.row, r.id AS doc_id, r.n_words, coalesce(n, 0) AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(CAST(r.id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM rows r LEFT JOIN summed USING (row) WHERE side = 'd'
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed
), able AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= {LEAST}
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= able * {PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (row)
"""
