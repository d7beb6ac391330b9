"""Centroid clustering of integer vectors by subvector dictionaries.

Vectors are cut into blocks of dimensions. Once, every chunk of vectors is stored dictionary-encoded: for
each block the distinct subvectors and for each vector their numbers, without loss. A round computes
the exact squared distance of every distinct subvector to the same block of every centroid, once, and a
vector's distances are sums of these by its numbers. Only sums and counts of the clusters reach the
driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import stored

DIMENSIONS, CENTROIDS, ROUNDS, SEED = 64, 40, 5, 2
#: Components are floor(SCALE * x); beyond MOST either way a squared distance would not fit 64 bits.
SCALE, MOST = 256, 1 << 27
#: Dimensions of a block, vectors of a chunk (the bound of a task's memory) and rows summed at once.
BLOCK, CHUNK, ROWS = 2, 1 << 16, 4096


def usable(df: DataFrame, dimensions: int = DIMENSIONS, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector has exactly so many components, none null, NaN or infinite."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where((F.size(vector_col) == dimensions) & finite)


def _integers(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    whole = np.floor(flat * SCALE)
    if len(whole) and np.abs(whole).max() > MOST:
        raise ValueError(f"a component is beyond {MOST // SCALE} either way: its distances do not fit 64 bits")
    return whole.astype(np.int64).reshape(-1, dimensions)


def _blocks(dimensions: int, width: int) -> list[tuple[int, int]]:
    return [(at, min(at + width, dimensions)) for at in range(0, dimensions, width)]


def _encoded(vectors: np.ndarray, width: int) -> tuple[list[int], bytes, bytes]:
    """Sizes of the blocks' dictionaries, the dictionaries, and each vector's numbers, block by block."""
    sizes, entries, numbers = [], [], []
    for a, b in _blocks(vectors.shape[1], width):
        found, inverse = np.unique(vectors[:, a:b], axis=0, return_inverse=True)
        sizes.append(len(found))
        entries.append(found.astype("<i4").tobytes())
        numbers.append(inverse.reshape(-1).astype("<u4").tobytes())
    return sizes, b"".join(entries), b"".join(numbers)


def encode(df: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS, width: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(ids, sizes, entries, numbers): chunks of the vectors of ``df``, dictionary-encoded by block."""
    kind = df.schema[id_col].dataType
    names = ["ids", "sizes", "entries", "numbers"]
    schema = T.StructType([*map(T.StructField, names, [T.ArrayType(kind), T.ArrayType(T.IntegerType()), T.BinaryType(), T.BinaryType()])])

    def row(ids: list, vectors: list[np.ndarray]) -> pa.RecordBatch:
        joined = pa.concat_arrays(ids)
        sizes, entries, numbers = _encoded(np.concatenate(vectors), width)
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), pa.array([sizes], pa.list_(pa.int32())), pa.array([entries], pa.binary()), pa.array([numbers], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, n = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                if n and n + part.num_rows > chunk:
                    yield row(ids, vectors)
                    ids, vectors, n = [], [], 0
                ids.append(part.column(0))
                vectors.append(_integers(part.column(1), dimensions))
                n += part.num_rows
        if n:
            yield row(ids, vectors)

    return df.select(id_col, vector_col).mapInArrow(run, schema)


class Chunk:
    """A dictionary-encoded chunk, as stored."""

    def __init__(self, sizes: list[int], entries: bytes, numbers: bytes, dimensions: int, width: int) -> None:
        self.blocks = _blocks(dimensions, width)
        flat = np.frombuffer(entries, dtype="<i4").astype(np.int64)
        self.entries, at = [], 0
        for (a, b), size in zip(self.blocks, sizes):
            self.entries.append(flat[at : at + size * (b - a)].reshape(size, b - a))
            at += size * (b - a)
        self.numbers = np.frombuffer(numbers, dtype="<u4").reshape(len(self.blocks), -1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each vector's nearest centroid (the smaller of equals) and its squared distance."""
        tables = [((own[:, None, :] - centroids[None, :, a:b]) ** 2).sum(axis=2) for own, (a, b) in zip(self.entries, self.blocks)]
        n = self.numbers.shape[1]
        cluster, distance = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        for at in range(0, n, ROWS):
            part = slice(at, at + ROWS)
            total = np.zeros((len(self.numbers[0, part]), len(centroids)), dtype=np.int64)
            for table, numbers in zip(tables, self.numbers):
                total += table[numbers[part]]
            cluster[part] = total.argmin(axis=1)
            distance[part] = total[np.arange(len(total)), cluster[part]]
        return cluster, distance

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """(clusters, 1 + dimensions): each cluster's number of vectors and their componentwise sums."""
        out = np.zeros((k, 1 + self.blocks[-1][1]), dtype=np.int64)
        out[:, 0] = np.bincount(cluster, minlength=k)
        for own, numbers, (a, b) in zip(self.entries, self.numbers, self.blocks):
            for d in range(a, b):
                # whole numbers below 2**53: CHUNK components of at most MOST
                out[:, 1 + d] = np.bincount(cluster, weights=own[numbers, d - a], minlength=k)
        return out


def _chunks(batches: Iterator[pa.RecordBatch], dimensions: int, width: int) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for ids, *coded in zip(*(batch.column(c) for c in batch.schema.names)):
            yield ids.values, Chunk(*(x.as_py() for x in coded), dimensions, width)


def start(df: DataFrame, id_col: str, vector_col: str, k: int, seed: int, dimensions: int) -> np.ndarray:
    """The k vectors whose sha256 of ``seed:id`` is smallest; null ids last, equal hashes by components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)
    first = df.select(key.alias("key"), F.col(vector_col).alias("v")).orderBy(F.asc_nulls_last("key"), "v").limit(k).toArrow()
    return _integers(first["v"].combine_chunks(), dimensions) if len(first) else np.zeros((0, dimensions), dtype=np.int64)


def cluster(
    df: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, stored in the shared folder, and the final centroids.

    Vectors of another length, null ones and those with a null or non-finite component are left out; an
    id may be null or repeated, each row counts. Fewer than ``k`` usable vectors give as many
    centroids. A component beyond 524,288 either way raises ValueError. Every round is one job over the
    stored codes; what comes back is a row of sums per cluster.
    """
    kept = usable(df, dimensions, vector_col)
    centroids = start(kept, id_col, vector_col, k, seed, dimensions)
    coded = stored(encode(kept, id_col, vector_col, dimensions, width))
    context = df.sparkSession.sparkContext
    kind = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    for _ in range(rounds if len(centroids) else 0):
        shared = context.broadcast(centroids)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(shared.value), 1 + dimensions), dtype=np.int64)
            for _, chunk in _chunks(batches, dimensions, width):
                found, _ = chunk.nearest(shared.value)
                total += chunk.sums(found, len(total))
            full = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

        parts = coded.mapInArrow(partial, "cluster long, sums array<bigint>")
        totals = parts.groupBy("cluster").agg(F.array(*[F.sum(F.get("sums", i)) for i in range(1 + dimensions)]).alias("sums"))
        centroids = centroids.copy()
        for number, sums in totals.collect():
            centroids[number] = [x // sums[0] for x in sums[1:]]
    shared_last = context.broadcast(centroids)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches, dimensions, width):
            found, distance = chunk.nearest(shared_last.value)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int32()), pa.array(distance)], kind.names)

    return stored(coded.mapInArrow(label, kind)), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """sha256 of each centroid's components, in decimal, joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with cluster_inertia, inertia and centroid_sha256; the sums are one row per cluster."""
    sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    inertia = [int(sums.get(c, 0)) for c in range(len(centroids))]
    of = lambda values, kind: F.get(F.lit(values).cast(f"array<{kind}>"), F.col("cluster"))
    return found.withColumns(
        {
            "cluster_inertia": of(inertia or [0], "bigint"),
            "inertia": F.lit(sum(inertia)).cast("long"),
            "centroid_sha256": of(digests(centroids) or [""], "string"),
        }
    )


def _oracle() -> str:
    """The rounds as SQL, one after the other."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY key NULLS LAST, x) - 1 AS cluster, x
      FROM (SELECT sha256('{SEED}:' || vec_id) AS key, x FROM v ORDER BY 1 NULLS LAST, 2 LIMIT {CENTROIDS}))""",
    ]
    for r in range(ROUNDS + 1):
        near = f"a{r} AS MATERIALIZED (SELECT v.row, min(({square}, c.cluster)) AS best FROM v, c{r} c GROUP BY v.row)"
        mean = f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN
      (SELECT cluster, list(mean ORDER BY d) AS x FROM (SELECT best[2] AS cluster, d, CAST(floor(sum(v.x[d]) / count(*)) AS BIGINT) AS mean
        FROM a{r} JOIN v USING (row), range(1, {DIMENSIONS + 1}) t(d) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))"""
        steps += [near] if r == ROUNDS else [near, mean]
    return f"""WITH {', '.join(steps)},
    o AS (SELECT v.vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance FROM a{ROUNDS} JOIN v USING (row))
    SELECT o.vec_id, o.cluster, o.distance, CAST(sum(o.distance) OVER (PARTITION BY o.cluster) AS BIGINT) AS cluster_inertia,
      CAST(sum(o.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM o JOIN c{ROUNDS} c USING (cluster)"""


ORACLE = _oracle()
