"""Line deduplication by winnowing over line hashes, in DataFrame functions only.

A repeated run counts if it has LINES non-blank lines or WORDS words. Every window of LINES lines
selects its least line hash as a fingerprint (Schleimer et al., 2003), so two runs of that length with
the same lines always select the same places; lines that can make a shorter run long enough (half of
WORDS) are selected too. Only selected places are joined: by fingerprint, to find those that occur
again, with the lines around them. These matches are extended both ways to the shortest runs that
count; a run that is not the first of its kind is a later copy, and later copies that touch or overlap
merge into runs reaching as far as the match does. Their lines are deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import discard, stored, unused

LINES = 3
WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"


def _row_key() -> Column:
    """Rows with the same id and text are the same document."""
    return F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(5))


def _selected(docs: DataFrame, window: int, words: int) -> DataFrame:
    """(key, doc_id, place, fp, before, around): the selected places of each document.

    around holds the (h, n) of the lines next to the place, up to ``window`` - 1 on either side; before
    says how many of them precede it.
    """
    lines = docs.select("doc_id", _row_key().alias("key"), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    solid = lines.select(
        "doc_id",
        "key",
        F.transform(
            F.filter("lines", lambda x: F.trim(x) != ""), lambda x: F.struct(F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(_WORD)).alias("n"))
        ).alias("solid"),
    ).where(F.size("solid") > 0)
    # each of these is used several times in one projection, so it is computed in a step of its own
    split = solid.select("doc_id", "key", "solid", F.col("solid.h").alias("h"))
    last = F.size("h") - window
    least = lambda s: F.slice("h", s + 1, window)
    minima = F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda s: s + F.array_position(least(s), F.array_min(least(s))).cast("int") - 1)
    ).otherwise(F.array().cast("array<int>"))
    long_lines = F.filter(F.sequence(F.lit(0), F.size("solid") - 1), lambda i: F.get("solid", i)["n"] * 2 >= words)
    places = split.select("doc_id", "key", "solid", F.explode(F.array_distinct(F.concat(minima, long_lines))).alias("place"))
    start = F.greatest(F.col("place") - (window - 1), F.lit(0))
    return places.select(
        "doc_id",
        "key",
        "place",
        F.get("solid", F.col("place"))["h"].alias("fp"),
        (F.col("place") - start).alias("before"),
        F.slice("solid", start + 1, F.col("place") - start + window).alias("around"),
    )


def _extended(matches: DataFrame, window: int, words: int) -> DataFrame:
    """(key, doc_id, start, size, w1, w2): the shortest runs around the places that count, with hashes of their lines.

    A run of ``window`` lines belongs to the place that it selects; a shorter one has ``words`` words.
    """

    def runs(size: int) -> Column:
        own = lambda s: F.slice("around", s + 1, size)
        hashes = lambda s: F.transform(own(s), lambda x: x["h"])
        low, high = F.greatest(F.col("before") - (size - 1), F.lit(0)), F.least(F.col("before"), F.size("around") - size)
        starts = F.when(high >= low, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
        if size == window:
            counts = lambda s: s + F.array_position(hashes(s), F.array_min(hashes(s))).cast("int") - 1 == F.col("before")
            # a long line may be a place without being its window's least
        else:
            counts = lambda s: F.aggregate(own(s), F.lit(0), lambda n, x: n + x["n"]) >= words
        return F.transform(
            F.filter(starts, counts),
            lambda s: F.struct(
                (F.col("place") - F.col("before") + s).alias("start"),
                F.lit(size).alias("size"),
                F.xxhash64(hashes(s), F.lit(size)).alias("w1"),
                F.xxhash64(hashes(s), F.lit(-size)).alias("w2"),
            ),
        )

    every = reduce(F.concat, [runs(k) for k in range(1, window + 1)]) if window > 1 else runs(1)
    return matches.select("doc_id", "key", F.explode(every).alias("r")).select("doc_id", "key", "r.*")


def later_copies(docs: DataFrame, window: int = LINES, words: int = WORDS) -> DataFrame:
    """(key, removed): per document the numbers (from 0) of the non-blank lines that repeat an earlier run.

    Earlier means a smaller doc_id (null first), or a smaller line number in the same document. Copies
    with the same id and text are one document. The tables of repeated fingerprints and of first runs
    have a row for each, so joins with them split over tasks where one is very frequent.
    """
    found = stored(_selected(docs, window, words))
    repeated = stored(found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"))
    matched = stored(_extended(found.join(repeated, "fp", "left_semi"), window, words))
    discard(found, repeated)
    place = F.struct("doc_id", "key", "start")
    firsts = stored(matched.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = matched.join(firsts, ["w1", "w2"]).where(place > F.col("first"))
    covered = later.select("key", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("line"))
    result = stored(covered.groupBy("key").agg(F.collect_set("line").alias("removed")))
    discard(matched, firsts)
    return result


def deduplicate(docs: DataFrame, window: int = LINES, words: int = WORDS) -> DataFrame:
    """``docs`` with later repeated runs of ``window`` non-blank lines or ``words`` words deleted from the text.

    One more column, the last, named line_counts (with underscores if taken), holds n_lines and
    n_removed (non-blank lines). Blank lines neither match nor go. Null texts stay null, texts
    without a repeated run stay as they are, a text all of whose lines repeat becomes blank. Rows
    without an id take part, before all others. Other columns pass through.

    The removed lines of a corpus are in proportion to it, so they meet the documents by a shuffle at
    every size: a broadcast over small tables would hide what a large one takes.
    """
    name = unused("line_counts", docs)
    own = {c: unused(c, docs) for c in ("row_key", "line_array", "solid", "removed_lines")}
    key, lines, solid, removed = (F.col(c) for c in own.values())
    marks = later_copies(docs, window, words).withColumnsRenamed({"key": own["row_key"], "removed": own["removed_lines"]})
    joined = docs.withColumn(own["row_key"], _row_key()).join(marks.hint("merge"), own["row_key"], "left")
    split = joined.withColumn(own["line_array"], F.split(F.coalesce("text", F.lit("")), "\n"))
    indexed = split.withColumn(
        own["solid"], F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i)) != "")
    )
    gone = F.transform(removed, lambda k: F.get(solid, k))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.when(removed.isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    counts = F.struct(
        F.size(solid).cast("long").alias("n_lines"), F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed")
    )
    columns = [text.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return indexed.select(*columns, counts.alias(name))


def drop_repeats(docs: DataFrame, window: int = LINES, words: int = WORDS) -> DataFrame:
    """``deduplicate`` with the columns of ``docs``; documents that lose all of their lines go."""
    name = unused("line_counts", docs)
    found = deduplicate(docs, window, words)
    counts = F.col(name)
    return found.where((counts["n_removed"] == 0) | (counts["n_removed"] < counts["n_lines"])).drop(name)


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), solid AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines WHERE trim(line) <> ''
), counted AS (
  SELECT doc_id, k, line AS a, len(regexp_extract_all(line, '[^ \\t\\n\\v\\f\\r]+')) AS n FROM solid
), runs AS (
  SELECT doc_id, k, a, n,
         lead(a, 1) OVER (PARTITION BY doc_id ORDER BY k) AS b, lead(n, 1) OVER (PARTITION BY doc_id ORDER BY k) AS m,
         lead(a, 2) OVER (PARTITION BY doc_id ORDER BY k) AS c
  FROM counted
), sized AS (
  SELECT doc_id, k, 1 AS size, a, NULL AS b, NULL AS c FROM runs WHERE n >= 50
  UNION ALL SELECT doc_id, k, 2, a, b, NULL FROM runs WHERE b IS NOT NULL AND n + m >= 50
  UNION ALL SELECT doc_id, k, 3, a, b, c FROM runs WHERE c IS NOT NULL
), later AS (
  SELECT doc_id, k, size FROM (
    SELECT doc_id, k, size, row_number() OVER (PARTITION BY size, a, b, c ORDER BY doc_id, k) AS turn FROM sized
  ) WHERE turn > 1
), removed AS (
  SELECT DISTINCT doc_id, k + j AS k FROM later, (SELECT unnest([0, 1, 2]) AS j) WHERE j < size
), marked AS (
  SELECT s.doc_id, s.i, r.k IS NOT NULL AS gone FROM solid s LEFT JOIN removed r ON r.doc_id = s.doc_id AND r.k = s.k
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS body
  FROM lines l LEFT JOIN marked m ON m.doc_id = l.doc_id AND m.i = l.i WHERE NOT coalesce(m.gone, false)
  GROUP BY l.doc_id
), counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(c.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
