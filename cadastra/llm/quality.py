"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

A text's features are its words, its pairs of neighbouring words (one feature for all pairs of equal words) and the character 3- to 5-grams of
its words (with word ends), each hashed to a bucket. A learned vector belongs to each bucket; the
average over a text's features goes through a softmax output. Texts are featurised on the executors,
training runs on a bounded sample of labelled rows, and scoring is one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm import hashing
from cadastra.llm.common import labelled_sample, unused

BITS = 18
GRAMS = (3, 4, 5)
#: Labelled rows of each class that training may use.
PER_CLASS = 3000
DIMENSION = 8
EPOCHS = 8
RATE = 3.0
BATCH = 64


def _piece_features(piece: bytes) -> Iterator[np.ndarray]:
    b = np.frombuffer(b" " + piece + b" ", dtype=np.uint8)
    gap = hashing.SPACE[b]
    b = np.where(gap, np.uint8(32), b)
    solid = ~gap
    inner = solid
    for n in range(3, max(GRAMS) + 1):
        if len(b) < n:
            return
        # the characters between the first and the last must all belong to one word
        inner = solid[1:-1] if n == 3 else inner[:-1] & solid[n - 2 : -1]
        if n in GRAMS:
            yield hashing.grams(b, n, BITS)[inner]
    starts, ends = hashing.words(b, ~hashing.SPACE)
    if len(starts):
        h = hashing.substring_hashes(hashing.prefix(b), starts, ends)
        shift = np.uint64(64 - BITS)
        yield (h >> shift).astype(np.uint32)
        # all pairs of equal words share a bucket: stuttering is the same sign whatever the word
        pairs = np.where(h[:-1] == h[1:], np.uint64(1), h[:-1] * np.uint64(3) + h[1:])
        yield (hashing.mix(pairs) >> shift).astype(np.uint32)


def features(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of a text's features, repeats included, in several arrays."""
    for piece in hashing.pieces(text):
        yield from _piece_features(piece)


def _pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted bucket ids as gaps, with their counts, compressed: about a byte for a feature."""
    both = np.stack([np.diff(ids, prepend=0), counts]).astype("<u4")
    return zlib.compress(both.tobytes(), 1)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids and their shares of the text's features."""
    gaps, counts = np.frombuffer(zlib.decompress(packed), dtype="<u4").reshape(2, -1)
    return np.cumsum(gaps, dtype=np.int32), (counts / max(int(counts.sum()), 1)).astype(np.float32)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, n, place, packed): number of different features, a hash to order the sample by, the features."""
    for batch in batches:
        packed, sizes = [], []
        for text in batch.column(1):
            found = list(features(text.as_py() or b"")) or [np.zeros(0, dtype=np.uint32)]
            ids, counts = np.unique(np.concatenate(found), return_counts=True)
            packed.append(_pack(ids, counts))
            sizes.append(len(ids))
        places = [zlib.crc32(x) for x in packed]
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, pa.int64()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["label", "n", "place", "packed"])


def train(labels: np.ndarray, sizes: np.ndarray, ids: np.ndarray, shares: np.ndarray, base_rate: float, seed: int = 11) -> dict:
    """Fit the vectors and the softmax output; ``base_rate`` is label 1's share among all labelled rows.

    Text k has sizes[k] features; buckets and shares of all texts stand one after the other. With no
    text, or one class only, every text scores ``base_rate``.
    """
    table = np.zeros(1 << BITS, dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return {"table": table, "bias": _logit(base_rate)}
    rng = np.random.default_rng(seed)
    # features that training never met must not move a score, so the vectors start near zero
    vectors = rng.normal(0, 1e-4, (1 << BITS, DIMENSION)).astype(np.float32)
    output = rng.normal(0, DIMENSION**-0.5, (DIMENSION, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    part = lambda k: slice(begin[k], begin[k + 1])
    lengths = np.array([max(float(shares[part(k)] @ shares[part(k)]), 1e-9) for k in range(len(sizes))], dtype=np.float32)
    steps = EPOCHS * ((len(sizes) + BATCH - 1) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            chosen = chosen[sizes[chosen] > 0]
            step += 1
            if not len(chosen):
                continue
            rate = RATE * (1 - (step - 1) / steps) / len(chosen)
            own = np.concatenate([ids[part(k)] for k in chosen])
            share = np.concatenate([shares[part(k)] for k in chosen])
            n = sizes[chosen]
            hidden = np.add.reduceat(vectors[own] * share[:, None], np.cumsum(n) - n)
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            # a text's step is divided by its squared length, so long and short texts learn alike
            back = (p @ output.T) / lengths[chosen, None]
            doc = np.repeat(np.arange(len(chosen)), n)
            rows, inverse = np.unique(own, return_inverse=True)
            for d in range(DIMENSION):
                vectors[rows, d] -= rate * np.bincount(inverse, weights=share * back[doc, d], minlength=len(rows))
            output -= 0.1 * rate * (hidden.T @ p)
            bias -= 0.1 * rate * p.sum(axis=0)
    # with two classes the softmax is the logistic of a difference, linear in the averaged vectors
    towards = output[:, 1] - output[:, 0]
    shift = _logit(base_rate) - _logit(labels.mean())
    return {"table": (vectors @ towards).astype(np.float32), "bias": float(bias[1] - bias[0] + shift)}


def _logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return float(np.log(p / (1 - p)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, seed: int = 1) -> dict:
    """A model from at most ``per_class`` labelled rows of each class (0 and 1), whole texts.

    ``labels`` holds doc_id and the label, only rows that may be learned from. Null labels and ids
    are ignored; ids without a text have no effect; a repeated row counts each time.
    """
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    n, ones = known.agg(F.count("*"), F.sum("label")).first()
    if not n:
        return train(*[np.zeros(0, dtype=np.int64)] * 4, 0.5)
    # at most 2 * per_class ids: small enough to broadcast at any size of the corpus
    chosen = labelled_sample(known, "label", per_class, seed)
    rows = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("label", "text")
        .mapInArrow(_featurise, "label int, n long, place long, packed binary")
        .toArrow()
    )
    # in an order that does not depend on which task ends first; few large arrays, so that memory is given back
    found, sizes, places = (np.asarray(rows[c], dtype=np.int64) for c in ("label", "n", "place"))
    order = np.lexsort([sizes, places, found])
    sizes = sizes[order]
    ids, shares = np.zeros(sizes.sum(), dtype=np.int32), np.zeros(sizes.sum(), dtype=np.float32)
    packed, ends = rows["packed"].combine_chunks() if len(rows) else [], np.cumsum(sizes)
    for k, end, size in zip(order.tolist(), ends.tolist(), sizes.tolist()):
        ids[end - size : end], shares[end - size : end] = _unpack(packed[k].as_py())
    return train(found[order], sizes, ids, shares, ones / n)


def score_text(text: bytes, model: dict) -> float:
    """Probability of label 1; a text without features gets what the output's bias says."""
    total, count = 0.0, 0
    table = model["table"]
    for found in features(text):
        total += float(table[found].sum(dtype=np.float64))
        count += len(found)
    z = total / max(count, 1) + model["bias"]
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score_column(docs: DataFrame) -> str:
    return unused("quality_score", docs)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column, the last: the probability of label 1, named by ``score_column``.

    Null texts count as empty. Other columns and repeated rows pass through untouched.
    """
    names = docs.columns
    place = names.index(text_col)
    name = score_column(docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary())
            scores = [score_text(x.as_py() or b"", shared.value) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, name])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns kept."""
    name = score_column(docs)
    return score(docs, model).where(F.col(name) >= threshold).drop(name)
