"""Language identification of mixed-language text.

Script ranges narrow down the languages that a word can belong to; hashed character n-grams and the
word itself score the remaining ones (naive Bayes); Viterbi over a text's words, with a penalty for
switching, labels spans. The text's language is the one that labels most of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm import hashing
from cadastra.llm.common import labelled_sample

BITS = 17
GRAMS = (3, 4)
#: Rows of each language that the fit may use.
PER_LANGUAGE = 2000
SWITCH = 8.0
UNKNOWN = "und"
#: First and last code point of each script's blocks, and the script's number.
SCRIPTS = (
    (0x0041, 0x005A, 1), (0x0061, 0x007A, 1), (0x00C0, 0x024F, 1), (0x1E00, 0x1EFF, 1),  # Latin
    (0x0370, 0x03FF, 2), (0x1F00, 0x1FFF, 2),  # Greek
    (0x0400, 0x052F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5),  # Hebrew
    (0x0600, 0x06FF, 6), (0x0750, 0x077F, 6),  # Arabic
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x09FF, 8),  # Bengali
    (0x0E00, 0x0E7F, 9),  # Thai
    (0x10A0, 0x10FF, 10),  # Georgian
    (0x1100, 0x11FF, 11), (0xAC00, 0xD7AF, 11),  # Hangul
    (0x3040, 0x30FF, 12),  # Kana
    (0x3400, 0x4DBF, 13), (0x4E00, 0x9FFF, 13),  # Han
)
N_SCRIPTS = 14
_FIRST = np.array(sorted(s[0] for s in SCRIPTS))
_LAST = np.array([s[1] for s in sorted(SCRIPTS)])
_NUMBER = np.array([s[2] for s in sorted(SCRIPTS)], dtype=np.int8)
_INSIDE = hashing.WORDLIKE.copy()
_INSIDE[0x30:0x3A] = False


def _scripts(b: np.ndarray) -> np.ndarray:
    """Script number at the first byte of each character, 0 elsewhere and for characters of no script."""
    out = np.zeros(len(b), dtype=np.int8)
    out[(b | 0x20) - 0x61 < 26] = 1
    lead = np.flatnonzero(b >= 0xC2)
    if len(lead):
        padded = np.concatenate([b, np.zeros(3, dtype=np.uint8)]).astype(np.int64)
        c0, c1, c2, c3 = (padded[lead + j] for j in range(4))
        point = np.where(
            c0 < 0xE0,
            (c0 & 0x1F) << 6 | c1 & 0x3F,
            np.where(
                c0 < 0xF0,
                (c0 & 0x0F) << 12 | (c1 & 0x3F) << 6 | c2 & 0x3F,
                (c0 & 0x07) << 18 | (c1 & 0x3F) << 12 | (c2 & 0x3F) << 6 | c3 & 0x3F,
            ),
        )
        at = np.searchsorted(_FIRST, point, "right") - 1
        out[lead] = np.where((at >= 0) & (point <= _LAST[at]), _NUMBER[at], 0)
    return out


def _pieces(text: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: its offset, its bytes (lower-cased, non-words as spaces), word starts and ends."""
    at = 0
    for piece in hashing.pieces(text):
        b = hashing.LOWER[np.frombuffer(b" " + piece + b" ", dtype=np.uint8)]
        b = np.where(_INSIDE[b], b, np.uint8(32))
        starts, ends = hashing.words(b, _INSIDE)
        if len(starts):
            yield at - 1, b, starts, ends
        at += len(piece)


def _buckets(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Buckets of n-grams by start (with a mask of those inside one word), then those of whole words."""
    solid = b != 32
    for n in GRAMS:
        if len(b) >= n:
            inner = solid[1 : len(b) - n + 2].copy()
            for j in range(2, n - 1):
                inner &= solid[j : len(b) - n + 1 + j]
            yield hashing.grams(b, n, BITS), inner
    h = hashing.substring_hashes(hashing.prefix(b), starts, ends)
    yield (h >> np.uint64(64 - BITS)).astype(np.uint32), None


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of buckets by language; script numbers follow the buckets."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            own = counts.setdefault(lang.as_py(), np.zeros((1 << BITS) + N_SCRIPTS, dtype=np.int64))
            for _, b, starts, ends in _pieces(text.as_py() or b""):
                found = [h if inner is None else h[inner] for h, inner in _buckets(b, starts, ends)]
                own[: 1 << BITS] += np.bincount(np.concatenate(found), minlength=1 << BITS)
                own[1 << BITS :] += np.bincount(_scripts(b), minlength=N_SCRIPTS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict({"label": pa.array([lang] * len(at)), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(own[at])})


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 3) -> dict:
    """A model from at most ``per_language`` texts of each non-null language of ``docs`` (doc_id, text, lang).

    The counts are made on the executors; what reaches the driver is one row per language and bucket.
    """
    chosen = labelled_sample(docs.select("doc_id", "lang"), "lang", per_language, seed)
    rows = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("label", "text")
        .mapInArrow(_count, "label string, bucket int, n bigint")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = sorted(set(rows["label"].to_pylist()))
    counts = np.zeros((len(names), (1 << BITS) + N_SCRIPTS))
    counts[np.searchsorted(names, rows["label"].to_pylist()) if names else [], np.asarray(rows["bucket"])] = np.asarray(rows["n"])
    grams, scripts = counts[:, : 1 << BITS] + 0.1, counts[:, 1 << BITS :]
    scripts[:, 0] = 0
    log = np.log(grams / grams.sum(axis=1, keepdims=True)) if names else grams
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return {
        "names": names,
        # what all languages have in common is no evidence
        "table": np.ascontiguousarray((log - log.mean(axis=0)).T.astype(np.float32)) if names else None,
        "allowed": (share >= 0.005).T,
    }


def word_scores(text: bytes, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(words x languages) scores, and the words' first and last byte + 1 in the text."""
    languages = len(model["names"])
    scores, spans = [], []
    for offset, b, starts, ends in _pieces(text):
        s = np.zeros((len(starts), languages), dtype=np.float32)
        for h, inner in _buckets(b, starts, ends):
            if inner is None:
                s += model["table"][h]
                continue
            sums = np.zeros((len(h) + 1, languages))
            np.cumsum(model["table"][h] * inner[:, None], axis=0, out=sums[1:])
            # an n-gram belongs to the word that holds its second byte
            s += (sums[np.minimum(ends - 1, len(h))] - sums[np.minimum(starts - 1, len(h))]) / len(GRAMS)
        script = np.maximum.reduceat(_scripts(b), starts)
        allowed = model["allowed"][script]
        known = allowed.any(axis=1)
        s[~known] = 0
        s = np.where(known[:, None] & ~allowed, np.float32(-1e3), s)
        scores.append(s)
        spans.append(np.stack([starts + offset, ends + offset], axis=1))
    if not scores:
        return np.zeros((0, languages), dtype=np.float32), np.zeros((0, 2), dtype=np.int64)
    return np.concatenate(scores), np.concatenate(spans)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best language of each word, for many texts at once (their words stand one after the other)."""
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = begin[order], lengths[order]
    n, languages = scores.shape
    back = np.zeros((n, languages), dtype=np.int16)
    path = np.zeros(n, dtype=np.int16)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    own = np.arange(languages, dtype=np.int16)
    state = np.zeros((len(lengths), languages), dtype=np.float32)
    for t in range(longest):
        k = active[t]
        at = begin[:k] + t
        now = state[:k]
        if t:
            leader = now.argmax(axis=1)
            now = now - now[np.arange(k), leader, None]
            switch = now < -penalty
            back[at] = np.where(switch, leader[:, None], own)
            now = np.maximum(now, -penalty)
        state[:k] = now + scores[at]
    last = np.zeros(len(lengths), dtype=np.int64)
    full = lengths > 0
    last[full] = state[full].argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        path[at] = last[:k]
        if t:
            last[:k] = back[at, last[:k]]
    return path


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


_ASCII_LETTERS = np.zeros(256, dtype=bool)
_ASCII_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def label_texts(texts: list[bytes | None], model: dict) -> list[dict]:
    """Per text: lang, score (share of its words) and spans (start, end, lang; byte positions)."""
    nothing = {"lang": UNKNOWN, "score": 0.0, "spans": []}
    if not model["names"]:
        return [nothing] * len(texts)
    found = [word_scores(t or b"", model) for t in texts]
    lengths = np.array([len(s) for s, _ in found], dtype=np.int64)
    path = viterbi(np.concatenate([s for s, _ in found]), lengths) if len(found) else np.zeros(0, dtype=np.int16)
    out, at = [], 0
    for text, (_, spans), n in zip(texts, found, lengths.tolist()):
        own = path[at : at + n]
        at += n
        if not n or not (_ASCII_LETTERS[np.frombuffer(text, dtype=np.uint8)].any() or _has_letter(text)):
            out.append(nothing)
            continue
        votes = np.bincount(own, minlength=len(model["names"]))
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [n]])
        out.append(
            {
                "lang": model["names"][int(votes.argmax())],
                "score": float(votes.max() / n),
                "spans": [
                    {"start": int(spans[s, 0]), "end": int(spans[e - 1, 1]), "lang": model["names"][own[s]]}
                    for s, e in zip(cuts[:-1], cuts[1:])
                ],
            }
        )
    return out


def label(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, score, spans) of every row; a null text or one without a letter is ``und``, score 0."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("lang", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = label_texts([x.as_py() for x in part.column(1).cast(pa.large_binary())], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([x["lang"] for x in found], pa.string()),
                        pa.array([x["score"] for x in found], pa.float64()),
                        pa.array([x["spans"] for x in found], pa.list_(span)),
                    ],
                    ["doc_id", "lang", "score", "spans"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)
