"""Near-duplicates by the Jaccard similarity of word shingles.

Candidates share a band of MinHash values (Broder, 1997): 20 bands of 4 values, so a pair at 0.8 is
missed with a chance of 3 in 100,000. Every candidate is decided by the exact similarity of the whole
texts. A band's texts first meet the band's least and greatest; components of what is linked follow.
Texts whose band holds several components are then joined by prefix filtering (Bayardo et al., 2007):
with shingles ordered from rare to frequent, two similar texts share one of their first fifth. Only
texts outside a shingle's largest component meet its others, so a large group of copies costs work in
proportion to its size, and a passage that many texts share joins only those that hold little else.
SimHash cannot serve here: at 0.8 fingerprints of 64 bits differ in about 10 bits and up to 20, where
no grid separates texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm import hashing
from cadastra.llm.common import discard, stored
from cadastra.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILAR = 0.8
BANDS = 20
BAND_VALUES = 4
_CHUNK = 1 << 11
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, BANDS * BAND_VALUES, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of a text's runs of ``width`` words in lower case, one of all words for shorter texts."""
    parts = []
    for piece in hashing.pieces(text):
        b = hashing.LOWER[np.frombuffer(piece, dtype=np.uint8)]
        parts.append(hashing.substring_hashes(hashing.prefix(b), *hashing.words(b, ~hashing.SPACE)))
    found = np.concatenate(parts)
    if not len(found):
        return found
    width = min(width, len(found))
    out = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = out * _STEP + found[k : k + len(out)]
    return np.unique(hashing.mix(out))


def bands(found: np.ndarray) -> np.ndarray:
    """A hash for each band of a set's MinHash values."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for s in range(0, len(found), _CHUNK):
        least = np.minimum(least, (found[s : s + _CHUNK, None] * _FACTORS).min(axis=0))
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_VALUES).T:
        out = hashing.mix(out * _STEP + column)
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, body, same, n, bands): hashes of every row's text and set of shingles, the set's size and bands."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("body", T.LongType()),
            T.StructField("same", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.zeros(batch.num_rows, dtype=np.uint64)
            sizes = np.zeros(batch.num_rows, dtype=np.int64)
            own = np.zeros((batch.num_rows, BANDS), dtype=np.uint64)
            for k, x in enumerate(batch.column(2)):
                found = shingles(x.as_py() or b"", width)
                ranks = np.arange(1, len(found) + 1, dtype=np.uint64)
                same[k] = hashing.mix(hashing.mix(found + ranks * _STEP).sum(keepdims=True))[0]
                own[k], sizes[k] = bands(found), len(found)
            lists = pa.ListArray.from_arrays(np.arange(0, own.size + 1, BANDS, dtype=np.int32), own.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same.view(np.int64)), pa.array(sizes), lists], schema.names)

    return _bodies(docs, text_col, F.col(id_col).alias("doc_id")).mapInArrow(run, schema)


def _bodies(docs: DataFrame, text_col: str, *columns) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(*columns, F.xxhash64(text).alias("body"), text.alias("text"))


def _texts(docs: DataFrame, text_col: str, points: DataFrame, used: DataFrame) -> DataFrame:
    """(same, text) of the points in ``used`` (column same, each once), the text of one of their rows."""
    named = stored(points.join(used, "same", "left_semi").select("same", "body"))
    texts = _bodies(docs, text_col).join(named.select("body"), "body", "left_semi").dropDuplicates(["body"])
    held = stored(texts.join(named, "body").select("same", "text"))
    discard(named)
    return held


def _prefixes(texts: DataFrame, roots: DataFrame, width: int, similar: float) -> DataFrame:
    """(token, place, same, n, root): the shingles of which two ``similar`` texts have one in common, place from 1.

    Of n shingles ordered by the number of ``texts`` (same, text) that hold them, those are the first
    n - similar * n + 1; shingles of one text only come first and are left out. ``roots`` has same, n, root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in enumerate(batch.column(1)):
                found = shingles(x.as_py(), width).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[k : k + 1], pa.array([found], pa.list_(pa.int64()))], ["same", "tokens"])

    sets = stored(texts.mapInArrow(run, "same long, tokens array<long>"))
    tokens = sets.select("same", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("texts")).where("texts > 1")
    own = Window.partitionBy("same")
    ranked = (
        tokens.join(shared, "token")
        .join(roots, "same")
        .withColumn("place", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("texts", "token")))
    )
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similar - 1e-9)) + 1
    found = stored(ranked.where(F.col("place") <= length).select("token", "place", "same", "n", "root"))
    discard(sets)
    return found


def _decided(pairs: DataFrame, docs: DataFrame, text_col: str, points: DataFrame, width: int, similar: float) -> DataFrame:
    """The ``pairs`` (a, b) whose whole texts are ``similar`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # each text of a batch is cut once; the sets take about as much room as the batch's texts
            sets: dict[int, np.ndarray] = {}
            keep = []
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                for k, text in ((a, x), (b, y)):
                    if k not in sets:
                        sets[k] = shingles(text.as_py(), width)
                keep.append(similarity(sets[a], sets[b]) >= similar - 1e-12)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    used = pairs.select(F.col("a").alias("same")).union(pairs.select("b")).distinct()
    held = _texts(docs, text_col, points, used)
    first = held.select(F.col("same").alias("a"), F.col("text").alias("text_a"))
    second = held.select(F.col("same").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    linked = stored(both.mapInArrow(run, "a long, b long"))
    discard(held)
    return linked


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, similar: float = SIMILAR
) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over pairs of texts that are ``similar`` or more, the
    row's own included. Texts with the same shingles are one point; a null text counts as empty.
    Rows with a null doc_id take part and get their component's id. Repeated rows each give a row.
    """
    prints = stored(_sketches(docs, id_col, text_col, width))
    points = stored(prints.groupBy("same").agg(F.min("doc_id").alias("least"), F.min("body").alias("body"), F.min("n").alias("n"), F.first("bands").alias("bands")))
    dealt = points.select("same", "n", F.explode("bands").alias("band"))
    ends = dealt.groupBy("band").agg(F.min("same").alias("low"), F.max("same").alias("high")).where("low < high")
    crowd = stored(dealt.join(ends, "band"))
    low, high = crowd.select(F.col("low").alias("a"), F.col("same").alias("b")), crowd.select(F.col("same").alias("a"), F.col("high").alias("b"))
    tried = stored(low.union(high).where("a < b").distinct())
    links = _decided(tried, docs, text_col, points, width, similar)
    # what links texts of different components in a band is still to be found
    roots = connected_components(links)
    placed = crowd.select("band", "same", "n").join(roots.withColumnRenamed("node", "same"), "same", "left")
    placed = stored(placed.select("band", "same", "n", F.coalesce("root", "same").alias("root")))
    discard(crowd)
    mixed = placed.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one < other")
    open_ = stored(placed.join(mixed, "band", "left_semi").select("same", "n", "root").distinct())
    held = _texts(docs, text_col, points, open_)
    prefixes = _prefixes(held, open_, width, similar)
    sizes = prefixes.groupBy("token", "root").agg(F.count("*").alias("texts"))
    mains = sizes.groupBy("token").agg(F.max_by("root", F.struct("texts", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    facing = stored(prefixes.join(mains.select("token", "main"), "token"))
    outside = facing.where("root <> main").select(
        "token", F.col("same").alias("x"), F.col("root").alias("root_x"), F.col("n").alias("n_x"), F.col("place").alias("place_x")
    )
    # the first shingle that two texts share and those behind it are all that they can share
    most = F.least(F.col("n") - F.col("place"), F.col("n_x") - F.col("place_x")) + 1
    alike = most * (1 + similar) >= (F.col("n") + F.col("n_x")) * F.lit(similar - 1e-9)
    met = outside.join(facing, "token").where("root <> root_x and (root = main or x < same)").where(alike)
    rest = met.select(F.least("x", "same").alias("a"), F.greatest("x", "same").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    first, second = (points.select(F.col("same").alias(c), F.col("bands").alias(f"bands_{c}")) for c in ("a", "b"))
    rest = rest.join(first, "a").join(second, "b").where(F.arrays_overlap("bands_a", "bands_b")).select("a", "b")
    links = links.union(_decided(stored(rest), docs, text_col, points, width, similar))
    discard(placed, held, prefixes, facing, open_)
    roots = connected_components(links)
    placed = points.join(roots.withColumnRenamed("node", "same"), "same", "left").select(
        "same", "least", F.coalesce("root", "same").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("doc_id", "same").join(placed.join(names, "root"), "same").select("doc_id", "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, similar: float = SIMILAR) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest doc_id stays.

    All columns stay. Rows that repeat the smallest doc_id are all kept, as are rows without an id.
    """
    firsts = near_duplicates(docs, width=width, similar=similar).where("doc_id = component_id").select("doc_id").distinct()
    nameless = docs.where("doc_id is null")
    return docs.join(firsts, "doc_id", "left_semi").unionByName(nameless)
