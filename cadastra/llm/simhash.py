"""SimHash near-duplicate detection with a segment-popcount embedding.

A text's fingerprint has 64 bits. Two fingerprints are linked at 3 or fewer differing bits.
The embedding counts the set bits in each of 32 two-bit segments; the Manhattan distance
between two such vectors is a lower bound of the Hamming distance. Links are found by a range
join on a unit grid in that space: with a distance of at most 3 over two halves (16 segments
each), one half differs by at most 1, so the pair shares a cell of that half or lies in
neighbouring cells. Candidates in the same or a neighbouring cell must pass the bound on the
whole vector and then the exact Hamming test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import cut
from cadastra.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
_CHUNK = 1 << 16
_LOW = 0x5555555555555555


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > width:
        spans = zip(starts[: -width + 1].tolist(), ends[width - 1 :].tolist())
        total = len(words) - width + 1
    else:
        spans = iter([(0, len(joined))])
        total = 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    while True:
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for (s, e), _ in zip(spans, range(_CHUNK))), dtype=">u8"
        )
        if not len(hashes):
            break
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        if len(hashes) < _CHUNK:
            break
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed long; null text counts as empty."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(x.as_py() or b"") for x in batch.column(1)), dtype=np.uint64, count=batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def _unary(x: Column) -> Column:
    """The two-bit segments' counts in unary (00, 01, 11): Manhattan distance becomes bit_count(xor)."""
    up = F.shiftrightunsigned(x, 1)
    both = x.bitwiseAND(up).bitwiseAND(F.lit(_LOW))
    some = x.bitwiseOR(up).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(both, 1).bitwiseOR(some)


def _neighbours(cell: Column) -> Column:
    """The cells at Manhattan distance 1: one segment's count up or down by one."""
    flipped = F.transform(F.array(*(F.lit(1 << i) for i in range(32))), lambda bit: cell.bitwiseXOR(bit.cast("long")))
    return F.filter(
        flipped, lambda c: F.shiftright(c, 1).bitwiseAND(F.bitwise_not(c)).bitwiseAND(F.lit(_LOW)) == 0
    )


def links(distinct_fps: DataFrame) -> DataFrame:
    """(a, b), a <> b: all pairs of different fingerprints within 3 bits, each once.

    Work and shuffle are in proportion to the number of different fingerprints; only true
    links leave the join.
    """
    points = distinct_fps.select("fp", _unary(F.col("fp")).alias("code"))
    sides = points.select(
        "fp",
        "code",
        F.posexplode(
            F.array(F.shiftrightunsigned("code", 32), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)))
        ).alias("side", "cell"),
    )
    # a step of 1 changes the parity of a cell's sum, so only even cells look at their neighbours
    own = F.array("cell")
    probes = sides.select(
        F.col("fp").alias("a"),
        F.col("code").alias("code_a"),
        F.col("cell").alias("home"),
        "side",
        F.explode(
            F.when(F.bit_count("cell") % 2 == 0, F.concat(own, _neighbours(F.col("cell")))).otherwise(own)
        ).alias("cell"),
    )
    index = sides.select(F.col("fp").alias("b"), F.col("code").alias("code_b"), "side", "cell")
    apart = F.col("code_a").bitwiseXOR(F.col("code_b"))
    near = (
        (F.bit_count(apart) <= RADIUS)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
        & ((F.col("home") != F.col("p.cell")) | (F.col("a") < F.col("b")))
        # a pair that the left half finds is not reported again by the right one
        & ((F.col("p.side") == 0) | (F.bit_count(F.shiftrightunsigned(apart, 32)) > 1))
    )
    same_cell = (F.col("p.side") == F.col("i.side")) & (F.col("p.cell") == F.col("i.cell"))
    return probes.alias("p").join(index.alias("i"), same_cell & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own included. Copies share
    a fingerprint and are handled as one point. A null text counts as empty (fingerprint 0, linked
    like any other). Rows with a null doc_id take part and get their component's id. Repeated rows
    each give a row. Extra columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(points))
    placed = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.join(names, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest doc_id stays.

    All columns stay. Rows that repeat the smallest doc_id are all kept, as are rows without an id.
    """
    firsts = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    nameless = docs.where("doc_id is null")
    return docs.join(firsts, "doc_id", "left_semi").unionByName(nameless)
