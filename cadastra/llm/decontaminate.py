"""Benchmark decontamination with suffix arrays over the training text.

Every Arrow batch of documents is a shard: its words become ids, its suffixes are sorted by their
first words into a suffix array, and every suffix of every benchmark item is binary-searched in it by
its first WINDOW words. The ranges found are all verbatim occurrences. Suffixes that cannot start a
window, because one of the words is in no benchmark item, are left out before the sort, which loses
nothing. ``locate`` gives the longest match from each place, by a suffix array of the items.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import unused

WINDOW = 10
#: Benchmark text that one broadcast may hold; a larger benchmark is searched block by block.
BLOCK_BYTES = 32 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LONG = 4 << 20
_LONGS = lambda *names: [T.StructField(n, T.LongType()) for n in names]
RESULT = T.StructType(
    [*_LONGS("n_words"), T.StructField("spans", T.ArrayType(T.StructType(_LONGS("start", "end")))), T.StructField("items", T.ArrayType(T.StringType()))]
)
PLACES = T.ArrayType(T.StructType([*_LONGS("start", "end"), T.StructField("item", T.StringType()), *_LONGS("item_start", "n_items", "n_places")]))


def _ids(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """Word ids of a text; 0 for words outside the vocabulary."""
    text = text.lower()
    words = _WORD.findall(text) if len(text) < _LONG else (m.group() for m in _WORD.finditer(text))
    return np.fromiter(map(vocabulary.get, words, repeat(0)), dtype=np.uint32)


def _keys(ids: np.ndarray) -> np.ndarray:
    """Rows of word ids as fixed-width byte strings that sort like the rows."""
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * ids.shape[1]}").ravel()


def build_index(items: list[tuple[str, bytes | None]], window: int = WINDOW) -> dict:
    """The distinct windows of the items in order, with the items that hold each."""
    texts = [(name, _WORD.findall((text or b"").lower())) for name, text in items]
    vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, words in texts for w in words}))}
    rows, owners = [], []
    for k, (_, words) in enumerate(texts):
        if not words:
            continue
        ids = np.zeros(max(window, len(words)), dtype=np.uint32)
        ids[: len(words)] = [vocabulary[w] for w in words]
        own = np.lib.stride_tricks.sliding_window_view(ids, window)
        rows.append(own)
        owners += [k] * len(own)
    if not rows:
        return {"empty": True, "vocabulary": {}}
    ids = np.concatenate(rows)
    _, first, inverse = np.unique(_keys(ids), return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([inverse.ravel(), np.array(owners)], axis=1), axis=0)
    ids = ids[first]
    lengths = (ids > 0).sum(axis=1)
    above = np.where(ids > 0, ids, np.uint32(0xFFFFFFFF))
    return {
        "empty": False,
        "vocabulary": vocabulary,
        "low": _keys(ids),
        "high": _keys(above),
        "lengths": lengths,
        "owner_starts": np.searchsorted(pairs[:, 0], np.arange(len(ids) + 1)),
        "owners": pairs[:, 1],
        "names": np.array([name for name, _ in texts], dtype=object),
        "window": window,
    }


def _suffix_array(ids: np.ndarray, window: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes' first ``window`` words, and those words as keys."""
    n = len(ids)
    at = np.arange(n)
    stop = np.minimum.accumulate(np.where(ids > 0, n, at)[::-1])[::-1]
    run = stop - at
    starts = np.flatnonzero(run >= shortest)
    head = np.zeros((len(starts), window), dtype=np.uint32)
    for j in range(window):
        inside = run[starts] > j
        head[inside, j] = ids[starts[inside] + j]
    keys = _keys(head) if len(starts) else np.zeros(0, dtype=f"S{4 * window}")
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order]


def _spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def search(texts: list[bytes | None], index: dict) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]], list[list[int]]]:
    """Per text: number of words, maximal covered word ranges, names of items found (each once), where windows start."""
    parts = [_ids(t or b"", index["vocabulary"]) for t in texts]
    n_words = np.array([len(p) for p in parts], dtype=np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    places: list[list[int]] = [[] for _ in texts]
    if index["empty"] or not n_words.sum():
        return n_words, spans, items, places
    gap = np.zeros(1, dtype=np.uint32)
    ids = np.concatenate([x for p in parts for x in (p, gap)])
    begin = np.concatenate([[0], np.cumsum(n_words + 1)])
    positions, keys = _suffix_array(ids, index["window"], int(index["lengths"].min()))
    low = np.searchsorted(keys, index["low"], "left")
    high = np.searchsorted(keys, index["high"], "right")
    found = np.flatnonzero(high > low)
    if not len(found):
        return n_words, spans, items, places
    counts = high[found] - low[found]
    windows = np.repeat(found, counts)
    starts = positions[np.repeat(low[found], counts) + _spread(counts)]
    step = np.bincount(starts, minlength=len(ids) + 1) - np.bincount(
        starts + index["lengths"][windows], minlength=len(ids) + 1
    )
    covered = np.concatenate([[0], np.cumsum(step)[:-1] > 0, [0]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(covered))
    for s, e in edges.reshape(-1, 2).tolist():
        k = int(np.searchsorted(begin, s, "right")) - 1
        spans[k].append((s - int(begin[k]), e - int(begin[k])))
    doc_of = np.searchsorted(begin, starts, "right") - 1
    seen = np.unique(np.stack([doc_of, windows], axis=1), axis=0)
    held = index["owner_starts"][seen[:, 1] + 1] - index["owner_starts"][seen[:, 1]]
    owner = index["owners"][np.repeat(index["owner_starts"][seen[:, 1]], held) + _spread(held)]
    for k, o in np.unique(np.stack([np.repeat(seen[:, 0], held), owner], axis=1), axis=0).tolist():
        items[k].append(index["names"][o])
    for k, names in enumerate(items):
        items[k] = sorted(set(names))
    for k, at in zip(doc_of.tolist(), (starts - begin[doc_of]).tolist()):
        places[k].append(at)
    return n_words, spans, items, places


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def match_column(docs: DataFrame) -> str:
    return unused("match", docs)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes | None]]]:
    """(item_id, text) of the benchmark in blocks of about BLOCK_BYTES at most, one after the other."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    dealt = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary"), F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"))
    for k in range(blocks):
        yield [(r[0], r[1]) for r in dealt.where(F.col("block") == k).select("item_id", "text").collect()]


def _passes(docs: DataFrame, benchmark: DataFrame, text_col: str, kind: T.DataType, prepare: Callable, results: Callable) -> DataFrame:
    """``docs`` with one more column, the last, from one pass per block: ``results(texts, prepared block, values so far)``."""
    place = docs.columns.index(text_col)
    out = docs.withColumn(match_column(docs), F.lit(None).cast(kind))
    schema = out.schema
    for items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(prepare(items))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [x.as_py() for x in batch.column(place).cast(pa.large_binary())]
                found = results(texts, shared.value, batch.column(batch.num_columns - 1).to_pylist())
                own = batch.schema.field(batch.num_columns - 1).type
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, own)], schema=batch.schema)

        out = out.mapInArrow(run, schema)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with one more column, the last: struct(n_words, spans, items), named by ``match_column``.

    spans are the maximal word ranges [start, end) that benchmark windows cover; items are the ids
    (as strings, each once, though several rows may have it) of the items with an occurring window. A
    window is ``window`` consecutive item words; a shorter item that has words is one window. Null and
    empty texts have no words; a null or empty item has no window; an empty benchmark matches nothing.
    Repeated rows each get their own result, other columns pass through untouched. There is no shuffle:
    the benchmark (of at most BLOCK_BYTES, else one block after the other) is broadcast.
    """

    def results(texts: list, index: dict, before: list) -> list[dict]:
        n_words, spans, items, _ = search(texts, index)
        return [
            {
                "n_words": int(n_words[i]),
                "spans": [{"start": s, "end": e} for s, e in (_merged(spans[i] + [(x["start"], x["end"]) for x in old["spans"]]) if old else spans[i])],
                "items": sorted({*items[i], *(old["items"] if old else ())}),
            }
            for i, old in enumerate(before)
        ]

    return _passes(docs, benchmark, text_col, RESULT, lambda items: build_index(items, window), results)


class Suffixes:
    """A suffix array of the items' words, by doubling the length that suffixes are sorted to."""

    def __init__(self, items: list[tuple[str, bytes | None]], vocabulary: dict[bytes, int]):
        parts = [_ids(text or b"", vocabulary) for _, text in items]
        self.names = [name for name, _ in items]
        # word number 0 parts the items
        self.ids = np.concatenate([x for p in parts for x in (p, np.zeros(1, dtype=np.uint32))]).astype(np.int64)
        lengths = np.array([len(p) + 1 for p in parts])
        self.owner = np.repeat(np.arange(len(parts)), lengths)
        self.begin = np.cumsum(lengths) - lengths
        rank, k = self.ids.copy(), 1
        while True:
            behind = np.concatenate([rank[k:], np.zeros(min(k, len(rank)), dtype=np.int64)])
            self.order = np.lexsort([behind, rank])
            if k >= lengths.max():
                break
            new = np.diff(rank[self.order], prepend=-1).astype(bool) | np.diff(behind[self.order], prepend=-1).astype(bool)
            rank[self.order] = np.cumsum(new)
            k *= 2
        self.known: dict[tuple[int, int], tuple] = {}

    def longest(self, ids: np.ndarray, s: int) -> tuple[int, int, int]:
        """Words from ``s`` on that some item has in a row, and the range of the suffixes that begin with them."""
        low, high, n = 0, len(self.order), 0
        while s + n < len(ids) and ids[s + n]:
            at = lambda i, n=n: self.ids[self.order[i] + n]
            first = bisect_left(range(len(self.order)), ids[s + n], low, high, key=at)
            last = bisect_right(range(len(self.order)), ids[s + n], first, high, key=at)
            if first == last:
                break
            low, high, n = first, last, n + 1
        return n, low, high

    def places(self, low: int, high: int) -> tuple[str, int, int, int]:
        """Of a range of suffixes: the first item by name, its first place there, numbers of items and of places."""
        if (low, high) not in self.known:
            at = self.order[low:high]
            names = {self.names[o] for o in np.unique(self.owner[at]).tolist()}
            first = min(names)
            start = min(int(p - self.begin[self.owner[p]]) for p in at.tolist() if self.names[self.owner[p]] == first)
            self.known[low, high] = first, start, len(names), high - low
        return self.known[low, high]


def locate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with one more column, the last: array of struct(start, end, item, item_start, n_items, n_places).

    The longest runs of a document's words that an item has verbatim, of those in which a window occurs, in
    order; a run inside another is left out. Each is given once however many items hold it: the first of
    them by id with its first place there, and how many items and places there are. The work follows
    the words matched and, once per run of a task, the places. A benchmark beyond BLOCK_BYTES is searched
    in blocks, which give their runs each.
    """

    def prepare(items: list) -> tuple[dict, Suffixes | None]:
        index = build_index(items, window)
        return index, None if index["empty"] else Suffixes(items, index["vocabulary"])

    def runs(text: bytes | None, starts: list[int], index: dict, suffixes: Suffixes) -> Iterator[tuple]:
        ids, reached = _ids(text or b"", index["vocabulary"]), 0
        for s in sorted(set(starts)):
            n, low, high = suffixes.longest(ids, s)
            if s + n > reached:
                reached = s + n
                yield s, reached, *suffixes.places(low, high)

    def results(texts: list, prepared: tuple, before: list) -> list[list[dict]]:
        index, suffixes = prepared
        places = search(texts, index)[3]
        names = PLACES.elementType.names
        own = [[dict(zip(names, r)) for r in runs(t, p, index, suffixes)] if p else [] for t, p in zip(texts, places)]
        return [sorted(a + (b or []), key=lambda m: tuple(m.values())) for a, b in zip(own, before)]

    return _passes(docs, benchmark, text_col, PLACES, prepare, results)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items): what ``scan`` finds, without the texts."""
    found = scan(docs.select("doc_id", "text"), benchmark).select("doc_id", "match.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all columns kept."""
    name = match_column(docs)
    return scan(docs, benchmark).where(F.size(F.col(name)["spans"]) == 0).drop(name)


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
  )
), hits AS (
  SELECT DISTINCT p.doc_id, p.k, p.n, i.item FROM places p JOIN windows i ON i.n = p.n AND i.s = p.s
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS word FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""
