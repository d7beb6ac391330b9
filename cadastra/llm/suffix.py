"""Removal of long repeated byte strings with difference-cover suffix sorting.

Every byte covered by a string of LENGTH bytes that also starts anywhere else goes. Work is cut down
first, without losing a repeat: each window of LENGTH bytes selects its least K-gram as an anchor, and
a repeated window selects the same anchor in both places, so only windows whose anchor's K-gram
occurs again can repeat. Windows of one anchor form a stretch; stretches that agree byte for byte
repeat as a whole. What remains, mostly at the ends of repeated passages, is dealt to tasks by anchor,
where a suffix array (Karkkainen and Sanders, 2003: sort the triples at a difference cover, recurse on
their names, merge the rest) puts equal prefixes next to each other, and adjacent prefixes are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm import hashing
from cadastra.llm.common import discard, stored

LENGTH = 400
K = 200
#: Texts are scanned in segments of this many windows, so that a position fits into 16 bits.
SEGMENT = 60_000
#: An anchor with more different stretches than this is counted window by window, not in one task.
CROWD = 200
#: Bytes that one suffix array holds at most; more anchors go to the next one.
BATCH_BYTES = 1 << 20
_ROWS = 1 << 13


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, by prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(text: bytes, length: int = LENGTH, k: int = K) -> Iterator[tuple[np.ndarray, ...]]:
    """Per segment: first window, number of windows, anchor's distance, K-gram hash, hash of all bytes.

    A stretch is a run of windows (by their first byte) that select the same anchor.
    """
    for base in range(0, max(len(text) - length + 1, 0), SEGMENT):
        b = np.frombuffer(text[base : base + SEGMENT + length - 1], dtype=np.uint8)
        sums = hashing.prefix(b)
        at = np.arange(len(b) - k + 1)
        grams = hashing.mix((sums[k:] - sums[:-k]) * hashing.powers(len(sums))[1][: len(at)])
        keys = (grams & np.uint64(0xFFFFFFFFFFFF0000)) | at.astype(np.uint64)
        anchors = (_sliding_min(keys, length - k + 1) & np.uint64(0xFFFF)).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
        ends = np.concatenate([starts[1:], [len(anchors)]])
        own = anchors[starts]
        yield (
            starts + base,
            ends - starts,
            own - starts,
            grams[own],
            hashing.substring_hashes(sums, starts, ends - 1 + length),
        )


def suffix_array(x: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the non-negative integers ``x`` in the order of their suffixes' first ``depth`` values.

    Suffixes that agree so far come in any order. A value past the end counts as less than all others.
    """
    n = len(x)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: x[i:].tolist()), dtype=np.int64)
    t = np.concatenate([x.astype(np.int64) + 1, np.zeros(3, dtype=np.int64)])
    top = int(t.max()) + 1
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])

    def triples(i: np.ndarray) -> np.ndarray:
        return (t[i] * top + t[i + 1]) * top + t[i + 2]

    _, names = np.unique(triples(sample), return_inverse=True)
    names = names.ravel()
    if depth > 3 and int(names.max()) + 1 < len(sample):
        # a 0 keeps the two halves of the reduced text apart
        reduced = np.concatenate([names[: len(ones)] + 1, [0], names[len(ones) :] + 1])
        order = suffix_array(reduced, -(-depth // 3))
        order = order[order != len(ones)]
        order = order - (order > len(ones))
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 4, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    width = len(sample) + 2
    zeros = np.arange(0, n, 3)
    by_one = t[zeros] * width + rank[zeros + 1]
    own = np.argsort(by_one, kind="stable")
    zeros, by_one = zeros[own], by_one[own]
    by_two = (t[zeros] * top + t[zeros + 1]) * width + rank[zeros + 2]
    # in a text cut off at ``depth`` ties may break the order of the second key; its running maximum restores it
    by_two = np.maximum.accumulate(by_two)
    first = sorted_sample % 3 == 1
    smaller = np.empty(len(sorted_sample), dtype=np.int64)
    i = sorted_sample[first]
    smaller[first] = np.searchsorted(by_one, t[i] * width + rank[i + 1])
    i = sorted_sample[~first]
    smaller[~first] = np.searchsorted(by_two, (t[i] * top + t[i + 1]) * width + rank[i + 2])
    smaller = np.maximum.accumulate(smaller) if len(smaller) else smaller
    place = np.arange(len(sorted_sample)) + smaller
    out = np.full(n, -1, dtype=np.int64)
    out[place] = sorted_sample
    out[out < 0] = zeros
    return out


def _equal_neighbours(b: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours in the order of the suffixes, whether their first ``length`` bytes are equal.

    Hashes rule most pairs out; the bytes decide the rest.
    """
    prefixes = hashing.substring_hashes(hashing.prefix(b), order, order + length)
    same = prefixes[1:] == prefixes[:-1]
    heads = np.lib.stride_tricks.sliding_window_view(b, length) if len(b) >= length else None
    hits = np.flatnonzero(same)
    for s in range(0, len(hits), _ROWS):
        at = hits[s : s + _ROWS]
        same[at] = (heads[order[at]] == heads[order[at + 1]]).all(axis=1)
    return same


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per context: for each of its windows of ``length`` bytes, whether it starts anywhere else in the contexts."""
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    b = np.frombuffer(b"\0".join(contexts), dtype=np.uint8)
    x = b.astype(np.int64) + 1
    x[(begin + sizes)[:-1]] = 0
    order = suffix_array(x, length)
    which = np.searchsorted(begin, order, "right") - 1
    fits = order + length <= begin[which] + sizes[which]
    order = order[fits]
    same = _equal_neighbours(b, order, length)
    flags = np.zeros(len(b) + 1, dtype=bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return [flags[s : s + max(n - length + 1, 0)] for s, n in zip(begin.tolist(), sizes.tolist())]


def _document_keys() -> list[Column]:
    """Two hashes that name a document; rows with equal id and text are alike in every respect."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.col("doc_id"), text, F.lit(3)).alias("k2")]


_KEYS = ["k1", "k2"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["k1", "k2", "start", "windows", "anchor", "kind"]
    for batch in batches:
        found = []
        for row, text in enumerate(batch.column(2)):
            for starts, counts, reach, grams, whole in stretches(text.as_py()):
                shape = hashing.mix((reach * 1024 + counts).astype(np.uint64))
                found.append((np.full(len(starts), row), starts, counts, grams, hashing.mix(whole ^ shape)))
        if found:
            row, starts, counts, grams, kind = (np.concatenate(c) for c in zip(*found))
            k1, k2 = (batch.column(c).take(pa.array(row)) for c in (0, 1))
            columns = [pa.array(starts), pa.array(counts.astype(np.int32)), pa.array(grams.view(np.int64)), pa.array(kind.view(np.int64))]
            yield pa.RecordBatch.from_arrays([k1, k2, *columns], names)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted stretch, or the hashes of its windows where its anchor is crowded."""
    names = ["k1", "k2", "start", "single", "anchor", "context", "hashes"]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for k1, k2, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            for w in wanted:
                context: bytes | None = text[w["start"] : w["start"] + w["windows"] + LENGTH - 1]
                hashes = None
                if w["crowded"]:
                    sums = hashing.prefix(np.frombuffer(context, dtype=np.uint8))
                    at = np.arange(w["windows"])
                    hashes, context = hashing.substring_hashes(sums, at, at + LENGTH).view(np.int64), None
                for column, value in zip(rows, (k1, k2, w["start"], w["single"], w["anchor"], context, hashes)):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, first, last): runs of repeated windows; all stretches of an anchor come one after the other."""
    held: list[tuple] = []
    size, anchor, before = 0, None, None

    def flush() -> pa.RecordBatch:
        out: list[tuple] = []
        for (k1, k2, start, single, _), flags in zip(held, repeated_windows([h[4] for h in held])):
            if single:
                out += [(k1, k2, start + s, start + e - 1) for s, e in zip(*(x.tolist() for x in _runs(flags)))]
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "first", "last"])

    for batch in batches:
        for k1, k2, start, single, own, context in zip(*(c.to_pylist() for c in batch.columns)):
            if (own, k1, k2, start) == before:
                continue  # a repeated row: its strings are counted as copies already
            before = (own, k1, k2, start)
            if size >= BATCH_BYTES and own != anchor:
                yield flush()
                held, size = [], 0
            held.append((k1, k2, start, single, context))
            size += len(context)
            anchor = own
    if held:
        yield flush()


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(k1, k2, runs): per document the runs (first, last) of windows of LENGTH bytes that start elsewhere too.

    Documents without such a window are absent. Copies of a stretch meet as counts, so a passage in
    a third of all documents costs one row per task.
    """
    texts = docs.select(*_document_keys(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    long_ones = texts.where(F.octet_length("text") >= LENGTH)
    found = stored(long_ones.mapInArrow(_scan, "k1 long, k2 long, start long, windows int, anchor long, kind long"))
    seen = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("kind").alias("low"), F.max("kind").alias("high"))
    # a stretch that is the only one of its anchor cannot repeat; an anchor with one kind repeats as a whole
    repeated = stored(seen.where("n > 1").select("anchor", (F.col("low") < F.col("high")).alias("open")))
    marked = stored(found.join(repeated, "anchor"))
    discard(found, repeated)
    one = F.min(F.struct("k1", "k2", "start", "windows")).alias("one")
    kinds = stored(marked.where("open").groupBy("anchor", "kind").agg(F.count("*").alias("n"), one))
    crowds = kinds.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor", F.lit(True).alias("many"))
    wanted = (
        kinds.join(crowds, "anchor", "left")
        .select("one.*", "anchor", (F.col("n") == 1).alias("single"), F.coalesce("many", F.lit(False)).alias("crowded"))
        .groupBy(*_KEYS)
        .agg(F.collect_list(F.struct("start", "windows", "anchor", "single", "crowded")).alias("wanted"))
    )
    contexts = stored(
        long_ones.join(wanted, _KEYS).mapInArrow(
            _contexts, "k1 long, k2 long, start long, single boolean, anchor long, context binary, hashes array<long>"
        )
    )
    copied = marked.where("open").join(kinds.where("n > 1").select("anchor", "kind"), ["anchor", "kind"], "left_semi")
    whole = (
        marked.where("not open")
        .select(*_KEYS, "start", "windows")
        .union(copied.select(*_KEYS, "start", "windows"))
        .select(*_KEYS, F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last"))
    )
    dealt = contexts.where("context is not null").select(*_KEYS, "start", "single", "anchor", "context")
    sorted_runs = (
        dealt.repartition("anchor")
        .sortWithinPartitions("anchor", *_KEYS, "start")
        .mapInArrow(_sort_suffixes, "k1 long, k2 long, first long, last long")
    )
    crowded = (
        contexts.where("hashes is not null")
        .dropDuplicates([*_KEYS, "start"])
        .select(*_KEYS, "start", F.posexplode("hashes").alias("at", "hash"))
    )
    common = crowded.groupBy("hash").count().where("count > 1").select("hash")
    place = F.col("start") + F.col("at")
    counted = crowded.join(common, "hash", "left_semi").select(*_KEYS, place.alias("first"), place.alias("last"))
    runs = whole.union(sorted_runs).union(counted)
    result = stored(runs.groupBy(*_KEYS).agg(F.collect_set(F.struct("first", "last")).alias("runs")))
    discard(marked, kinds, contexts)
    return result


def _spans(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal byte ranges that runs of windows cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in runs or ()):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + LENGTH))
        else:
            out.append((first, last + LENGTH))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, spans = [], []
        for text, runs in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
            b, own, at = text.as_py(), _spans(runs.as_py()), 0
            parts = []
            for s, e in own:
                parts.append(b[at:s])
                at = e
            kept.append(b"".join([*parts, b[at:]]))
            spans.append([{"start": s, "end": e} for s, e in own])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(spans, span)], ["doc_id", "kept", "spans"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, spans) of every row: the bytes that stay, and the byte ranges removed.

    Null texts count as empty. A repeated row is another place, so the strings it shares with its
    twin go from both. Rows without an id take part. Extra columns are ignored. Matches never cross
    documents, may overlap, and are judged on the input.
    """
    runs = repeated_runs(docs)
    rows = docs.select("doc_id", *_document_keys(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        rows.join(runs, _KEYS, "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(_remove, f"doc_id {kind}, kept binary, spans array<struct<start: long, end: long>>")
    )


ORACLE = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
chunks AS (
  SELECT doc_id, c, substr(x, 4000 * c + 1, 4798) AS x FROM (SELECT doc_id, x, unnest(generate_series(0, (n - 400) // 2000)) AS c FROM t WHERE n >= 400)
), starts AS (
  SELECT doc_id, 2000 * c + i AS i, hash(substr(x, 2 * i + 1, 800)) AS h
  FROM (SELECT doc_id, c, x, unnest(generate_series(0, least(length(x) // 2 - 400, 1999))) AS i FROM chunks)
), repeated AS (
  SELECT doc_id, i FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)
), fresh AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM repeated
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM fresh) GROUP BY doc_id, span
), pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM spans
  UNION ALL SELECT t.doc_id, coalesce(max(b), 0), max(n) FROM t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id
), kept AS (
  SELECT t.doc_id, string_agg(substr(x, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS body FROM pieces p JOIN t ON t.doc_id = p.doc_id GROUP BY t.doc_id
), counts AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id
)
SELECT t.doc_id, CAST(t.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(body)) AS kept_sha256
FROM t JOIN kept k ON k.doc_id = t.doc_id LEFT JOIN counts c ON c.doc_id = t.doc_id
"""
