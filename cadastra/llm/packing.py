"""Best-fit packing of tokenised documents into sequences, by large-item matching.

A document's tokens and one end token are an item; longer ones are cut into items of the capacity.
Items over a third of the capacity go at most two to a sequence: from the longest on, each takes the
longest other one that still fits. The others, longest first, go where the least room is left.

Which lengths meet is decided on the histogram of lengths, which has at most as many entries as the
capacity whatever the corpus. Its plan is a table of runs: the items of a length from one place to
another go to consecutive sequences at one offset. Every item then finds its run by its place among
the items of its length, so no item is ever handled on the driver.
"""

from __future__ import annotations

import json
import os
import re
import string
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm.common import ranked, stored, unused

CAPACITY = 4096
END = 1
#: A Python worker remembers at most twice as many parts of a text, and none longer than LONG characters.
REMEMBERED, LONG = 1 << 19, 64
#: A long text is taken in slices of about this many characters, cut at blanks.
SLICE = 1 << 20
#: Bytes of ids after which a batch of rows is handed on.
BATCH = 1 << 23
#: A word, of letters that every version of the letter tables agrees on and no normalisation changes, and punctuation.
_WORD = re.compile(f"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([{re.escape(string.punctuation)}]*)").fullmatch
#: How byte-level vocabularies spell bytes: visible characters as themselves, the others, in order, from 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELT = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
#: How a vocabulary's file states that it lower-cases, drops white space and splits letters from the rest.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTED = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_LOWERED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}


class Words(dict):
    """Ids of what stands between blanks, as little-endian bytes, remembered in two generations.

    Where a vocabulary's splitting drops white space, a text's ids are those of the parts between blanks
    one after the other. Where it also splits runs of letters from other characters and lower-cases, a
    word and the punctuation behind it are looked up apart, and upper case as lower case; a word of small
    letters goes straight to the merges.
    """

    def __init__(self, path: str) -> None:
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        form = json.loads(self.tokenizer.to_str())
        self.by_word = form["pre_tokenizer"] == _PARTED and form["normalizer"] == _LOWERED
        self.before: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(part) > LONG:
            return self.encode(part)
        found = self.before.get(part)
        if found is None:
            found = self._found(part)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[part] = found
        return found

    def _found(self, part: str) -> bytes:
        form = _WORD(part)
        if not form:
            return self.encode(part)
        word, behind = form.groups()
        small = word.lower()
        if behind:
            return self[small] + self[behind]
        if small != part:
            return self[small]
        spelt = small if small.isascii() else small.encode().decode("latin-1").translate(_SPELT)
        return np.array([t.id for t in self.merges(spelt)], dtype="<u4").tobytes()


words = cache(Words)


def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SLICE:
        end = text.find(" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def token_bytes(text: str, path: str) -> Iterator[bytes]:
    """The ids of a text as little-endian unsigned 32-bit numbers, in several parts if it can be cut at blanks."""
    known = words(path)
    if not known.by_word:
        yield known.encode(text)
        return
    for part in _slices(text.replace("\n", " ").replace("\r", " ").replace("\t", " ")):
        yield b"".join(map(known.__getitem__, part.split(" ")))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids) of every document, in pieces of at most ``capacity`` ids.

    ``tokenizer`` is the path of a file for the tokenizers library, the same on every machine. One that
    drops white space is applied in slices, any other to whole texts. ids are little-endian unsigned 32-bit numbers, the last of a document is
    ``end``. A null text is an empty one: one piece with the end alone. Null and repeated ids stay as they
    are; other columns are left out.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    names = ["piece", "start", "length", "ids"]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.BinaryType()]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *map(T.StructField, names, kinds)])
    step, last = 4 * capacity, np.array([end], dtype="<u4").tobytes()

    def rows(text: str) -> Iterator[tuple[int, int, bytes]]:
        piece, kept = 0, b""
        for part in token_bytes(text, tokenizer):
            kept += part
            # what is cut here is never the last piece, as the end is still to come
            whole = len(kept) // step * step
            for at in range(0, whole, step):
                yield piece, piece * capacity, kept[at : at + step]
                piece += 1
            kept = kept[whole:]
        yield piece, piece * capacity, kept + last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found, size = [], [], 0

            def flush(ids: pa.Array) -> pa.RecordBatch:
                piece, start, body = (list(x) for x in zip(*found)) if found else ([], [], [])
                length = pa.array([len(x) // 4 for x in body], pa.int64())
                arrays = [ids.take(pa.array(owners, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), length, pa.array(body, pa.binary())]
                return pa.RecordBatch.from_arrays(arrays, schema.names)

            for k, text in enumerate(batch.column(1)):
                for row in rows(text.as_py() or ""):
                    owners.append(k)
                    found.append(row)
                    size += len(row[2])
                    if size >= BATCH:
                        yield flush(batch.column(0))
                        owners, found, size = [], [], 0
            yield flush(batch.column(0))

    return docs.select(id_col, text_col).mapInArrow(run, schema)


Run = tuple[int, int, int, int, int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs (length, first, n, sequence, offset, per) and the number of sequences, from a histogram of lengths.

    The items of a length from place ``first`` on, ``n`` of them, go ``per`` to a sequence from
    ``sequence`` on, one behind the other from ``offset``.
    """
    left = {s: n for s, n in counts.items() if n}
    done = dict.fromkeys(left, 0)
    runs: list[Run] = []
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, how many)
    keys: list[int] = []
    sequences = 0

    def put(s: int, n: int, sequence: int, offset: int, per: int = 1) -> None:
        runs.append((s, done[s], n, sequence, offset, per))
        done[s] += n
        left[s] -= n

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                rooms[room] = []
                insort(keys, room)
            rooms[room].append((first, n))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        # the longest other item that fits beside it; those used up are dropped on the way
        at = bisect_left(large, capacity - a + 1) - 1
        while at >= 0 and (not left[large[at]] or large[at] == a and left[a] < 2):
            if not left[large[at]]:
                large.pop(at)
            at -= 1
        b = large[at] if at >= 0 else None
        if b is None:
            n, room = left[a], capacity - a
            put(a, n, sequences, 0)
        elif b == a:
            n, room = left[a] // 2, capacity - 2 * a
            put(a, 2 * n, sequences, 0, 2)
        else:
            n, room = min(left[a], left[b]), capacity - a - b
            put(a, n, sequences, 0)
            put(b, n, sequences, a)
        leave(room, sequences, n)
        sequences += n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(keys, s)
            if at < len(keys):
                room = keys[at]
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], keys[at]
            else:
                room, first, n = capacity, sequences, -(-left[s] // (capacity // s))
                sequences += n
            per = room // s
            full = min(n, left[s] // per)
            if full:
                put(s, full * per, first, capacity - room, per)
                leave(room - per * s, first, full)
            elif left[s]:
                few, full = left[s], 1
                put(s, few, first, capacity - room, few)
                leave(room - few * s, first, 1)
            leave(room, first + full, n - full)
    return runs, sequences


def place(items: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """``items`` with sequence_id and offset (long): a packing into sequences of at most ``capacity``.

    Lengths are whole numbers from 1 to the capacity. Other columns pass through, repeated rows each get
    a place; columns named sequence_id or offset are an error. Items are range-partitioned by length and
    a number, so one length may hold most of the rows.
    """
    if clash := {c.lower() for c in items.columns} & {"sequence_id", "offset"}:
        raise ValueError(f"the items already have {', '.join(sorted(clash))}")
    number, at = unused("number", items), unused("place", items)
    fixed = stored(items.withColumn(number, F.monotonically_increasing_id()))
    histogram = {int(s): int(n) for s, n in fixed.groupBy(length_col).count().collect()}
    if bad := [s for s in histogram if not 1 <= s <= capacity]:
        raise ValueError(f"lengths outside 1 to {capacity}: {sorted(bad)[:5]}")
    lengths = sorted(histogram)
    before = dict(zip(lengths, np.cumsum([0, *(histogram[s] for s in lengths)]).tolist()))
    runs, _ = plan(histogram, capacity)
    # the place of a run's first item among all items in order of length
    table = np.array(sorted((before[s] + first, sequence, offset, per, s) for s, first, _, sequence, offset, per in runs), dtype=np.int64).reshape(-1, 5)
    shared = items.sparkSession.sparkContext.broadcast(table)
    found = ranked(fixed, [length_col, number], at)
    names = [c for c in found.columns if c not in (number, at)]
    schema = T.StructType([*(found.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sequence, offset, per, length = shared.value.T
        for batch in batches:
            places = np.asarray(batch.column(at), dtype=np.int64)
            k = np.searchsorted(starts, places, side="right") - 1
            into, beside = np.divmod(places - starts[k], per[k])
            ends = [pa.array(sequence[k] + into), pa.array(offset[k] + beside * length[k])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *ends], schema.names)

    return found.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids, sequence_id, offset) of every piece of every document."""
    return place(pieces(docs, tokenizer, capacity, end, id_col, text_col), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences; each holds at most the capacity, so groups are small."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.transform(parts, lambda x: x["ids"]).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, b: F.concat(a, b))
    return whole.select("sequence_id", "length", joined.alias("ids"))
