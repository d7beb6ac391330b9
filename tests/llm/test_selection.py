"""Importance resampling, centroid clustering and packing against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import clusters, packing, queries, resample

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Importance resampling


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_resample(docs, target, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = defaultdict(int), defaultdict(int)
    for _, text in docs:
        for f in features(text)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text)[1]:
            t[bucket(f)] += 1
    n_s, n_t = float(sum(s.values())) + 10000, float(sum(t.values())) + 10000
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1.0) * n_s) / ((s[b] + 1.0) * n_t)))
    out = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, len(words) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


def some_docs(n=120, seed=1):
    random.seed(seed)
    lines = ["The quick Fox", "le CAFÉ noir, É", "", "a1-b2 c3", "  ", "licence text of many documents", "日本語 テキスト", "x"]
    docs = [(k, "\n".join(random.choice(lines) for _ in range(random.randint(0, 12)))) for k in range(n)]
    return [*docs, (1000, None), (1001, ""), (1002, "\n\n"), (1003, "word " * 5000), (1004, "one\r\ntwo\x0bthree\x1cfour")]


def test_resampling_equals_brute_force(spark):
    docs, target = some_docs(), ["the quick fox\njumps", None, "café noir", ""]
    found = resample.resample(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame([(x,) for x in target], "text string"))
    assert sorted(rows_of(found), key=str) == brute_resample(docs, target)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 5


def test_resampling_of_repeated_null_and_tied_rows(spark):
    docs = [(1, "a b " * 30)] * 3 + [(None, "a b " * 30), (None, None), (2, "q r " * 30)]
    found = resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([("a b",)], "text string"), percent=60)
    assert sorted(rows_of(found), key=str) == brute_resample(docs, ["a b"], 60)


def test_resampling_of_empty_tables(spark):
    docs, none = spark.createDataFrame(some_docs(9), DOCS), spark.createDataFrame([], "text string")
    assert resample.resample(spark.createDataFrame([], DOCS), none).count() == 0
    assert sorted(rows_of(resample.resample(docs, none)), key=str) == brute_resample(some_docs(9), [])


def test_resampling_with_clashing_columns(spark):
    docs = some_docs(40)
    df = spark.createDataFrame(docs, "row long, line string").withColumns({c: F.lit("x") for c in ("id", "text", "gain", "key", "weight", "score", "place", "able", "rank")})
    target = spark.createDataFrame([("the fox",)], "line string")
    found = resample.resample(df, target, id_col="row", text_col="line")
    assert sorted(rows_of(found), key=str) == brute_resample(docs, ["the fox"])
    kept = resample.keep_drawn(df, target, "row", text_col="line")
    assert kept.columns == df.columns and {r.row for r in kept.collect()} == {r[0] for r in brute_resample(docs, ["the fox"]) if r[4]}


def test_lines_are_counted_once_for_all_their_occurrences(spark):
    df = spark.createDataFrame([(1, "same line\nsame line\nother"), (2, "same line"), (3, None)], DOCS)
    found = {r.n_words: (r.occurrences, len(r.buckets) // 2) for r in resample.segments(df).collect()}
    assert found == {2: (3, 3), 1: (1, 1)}
    cross = {r.id: len(r.cross) // 2 for r in resample.outlines(df, "doc_id").collect()}
    assert cross == {1: 2, 2: 0, 3: 0}


# Centroid clustering

VECTORS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k, rounds, dimensions, seed=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        for n, vs in own.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    inertia = defaultdict(int)
    for _, c, d in found:
        inertia[c] += d
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha(centroids[c])) for i, c, d in found), key=str)


def vectors(n, dimensions, seed=3):
    random.seed(seed)
    rows = [(k, [random.choice([random.gauss(0, 1), -0.0, 0.25, float(random.randint(-2, 2))]) for _ in range(dimensions)]) for k in range(n)]
    same = [0.5] * dimensions
    # a vector that many rows have, repeated and missing ids, and rows that are left out
    rows += [(n + k, same) for k in range(n)] + [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1])]
    bad = [None, [], same[:-1], [*same, 1.0], [None, *same[1:]], [float("nan"), *same[1:]], [float("inf"), *same[1:]], [float("-inf"), *same[1:]]]
    return rows + [(9000 + k, v) for k, v in enumerate(bad)]


@pytest.mark.parametrize(("width", "dimensions"), [(1, 5), (2, 5), (2, 6), (8, 6)])
def test_clusters_equal_brute_force(spark, width, dimensions):
    rows = vectors(60, dimensions)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    found = clusters.with_inertia(*clusters.cluster(df, 7, 4, dimensions=dimensions, width=width))
    assert sorted(rows_of(found), key=str) == brute_clusters(rows, 7, 4, dimensions)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [-5.0, 7.0])]
    found = clusters.with_inertia(*clusters.cluster(spark.createDataFrame(rows, VECTORS), 40, 5, dimensions=2))
    assert sorted(rows_of(found), key=str) == brute_clusters(rows, 40, 5, 2)
    empty = clusters.with_inertia(*clusters.cluster(spark.createDataFrame([], VECTORS)))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_cluster_columns_and_limits(spark):
    rows = vectors(20, 3)
    df = spark.createDataFrame(rows, "k long, v array<double>").select(F.col("k").cast("string"), "v", *[F.lit("x").alias(c) for c in ("ids", "sizes", "cluster", "distance", "key")])
    found, centroids = clusters.cluster(df, 4, 2, dimensions=3, id_col="k", vector_col="v")
    assert found.columns == ["k", "cluster", "distance"] and len(centroids) == 4
    with pytest.raises(Exception, match="do not fit 64 bits"):
        clusters.cluster(spark.createDataFrame([(1, [1e9, 0.0])], VECTORS), dimensions=2)


def test_dictionaries_are_lossless():
    rng = np.random.default_rng(5)
    own = rng.integers(-3, 3, (500, 7))
    own[0, 0], own[1, 6] = 1 << 27, -(1 << 27)
    sizes, entries, numbers = clusters._encoded(own, 2)
    chunk = clusters.Chunk(sizes, entries, numbers, 7, 2)
    back = np.concatenate([e[n] for e, n in zip(chunk.entries, chunk.numbers)], axis=1)
    assert (back == own).all() and max(sizes) < 60
    centroids = own[:9]
    cluster, distance = chunk.nearest(centroids)
    whole = ((own[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (whole.argmin(axis=1) == cluster).all() and (whole.min(axis=1) == distance).all()


# Packing


def checked_plan(counts, capacity):
    runs, n = packing.plan(counts, capacity)
    used, seen = defaultdict(list), defaultdict(list)
    for s, first, m, sequence, offset, per in runs:
        for i in range(m):
            used[sequence + i // per].append((offset + i % per * s, s))
            seen[s].append(first + i)
    assert all(sorted(seen[s]) == list(range(c)) for s, c in counts.items())
    assert sorted(used) == list(range(n))
    for parts in used.values():
        at = 0
        for offset, s in sorted(parts):
            assert offset == at
            at += s
        assert at <= capacity and sum(3 * s > capacity for _, s in parts) <= 2
    return n


def first_fit_decreasing(counts, capacity):
    rooms = []
    for s in sorted((s for s, c in counts.items() for _ in range(c)), reverse=True):
        for k, room in enumerate(rooms):
            if room >= s:
                rooms[k] -= s
                break
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_plans_are_valid_and_no_worse_than_first_fit():
    random.seed(9)
    ours = theirs = 0
    for _ in range(600):
        capacity = random.choice([1, 5, 10, 30, 100])
        counts = {random.randint(1, capacity): random.randint(1, 12) for _ in range(random.randint(0, 14))}
        n = checked_plan(counts, capacity)
        assert n >= -(-sum(s * c for s, c in counts.items()) // capacity)
        ours, theirs = ours + n, theirs + first_fit_decreasing(counts, capacity)
    assert ours <= theirs * 1.01


def test_large_items_are_matched_as_often_as_possible():
    # greedy from the longest: 70+30 is no match (30 is small), 66+34, 60+40, 50+50
    assert checked_plan({66: 3, 34: 3, 60: 2, 40: 2, 50: 4}, 100) == 7
    assert checked_plan({51: 10}, 100) == 10 and checked_plan({50: 11}, 100) == 6


def tokens(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


TEXTS = ["", None, "Hello, World! It's 'sword.", "a\n\nb\tc\r\nd", "é" * 70 + " É,", "ǅ İstanbul Ça J̌ ΰς 日本語한글", "<|endoftext|> x<|startoftext|>", "word " * 9000, "x" * 3000, "don't (stop). [1] 3.14 😀  z", "ab\x1ccd\x85ef"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_equal_those_of_whole_texts(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    random.seed(10)
    pool = [*"abzAZéÉßñİıǰJ̌ȩ́ \n\t\r  \x1c'’.,-_123٣日本語한글ａＡ😀Ⱥǅŉΰς‍ͅ", "'s", "'S", "<|endoftext|>", "don't", "It's,", "(word)", "ABC.", "été,", "ÉTÉ!"]
    made = ["".join(random.choice(pool) for _ in range(random.randint(0, 20))) for _ in range(3000)]
    for text in [x or "" for x in TEXTS] + made:
        got = b"".join(packing.token_bytes(text, path))
        assert got == tokens(tokenizer, text)[:-1].tobytes(), repr(text)


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    monkeypatch.setattr(packing, "SLICE", 40)
    known = packing.Words(WORDS)
    monkeypatch.setattr(packing, "words", lambda path: known)
    from tokenizers import Tokenizer

    random.seed(11)
    text = " ".join("".join(random.choice("abcde,É") for _ in range(random.randint(1, 9))) for _ in range(2000))
    assert b"".join(packing.token_bytes(text, WORDS)) == tokens(Tokenizer.from_file(WORDS), text)[:-1].tobytes()
    assert len(known) <= 55 and len(known.before) <= 55


@pytest.mark.parametrize("capacity", [1, 7, 4096])
def test_packing_round_trip(spark, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    texts = [x if capacity > 7 or x is None else x[:60] for x in TEXTS]
    docs = [(k, x) for k, x in enumerate(texts)] + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("x") for c in ("piece", "length", "ids", "number", "place", "sequence_id")}).repartition(3)
    packed = packing.pack(df, WORDS, capacity)
    found = packed.collect()
    by = defaultdict(dict)
    for r in found:
        assert r.start == r.piece * capacity and r.length == len(r.ids) // 4 <= capacity
        if r.doc_id not in (None, 3):
            by[r.doc_id][r.piece] = r.ids
    for k, x in docs:
        if k not in (None, 3):
            assert b"".join(by[k][i] for i in range(len(by[k]))) == tokens(tokenizer, x).tobytes()
    assert sum(r.length for r in found) == sum(len(tokens(tokenizer, x)) for _, x in docs)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in found:
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    for r in whole.values():
        assert r.length == len(r.ids) // 4 <= capacity
    assert len(whole) == checked_plan(dict(zip(*map(list, np.unique([r.length for r in found], return_counts=True)))), capacity)


def test_one_length_may_hold_most_items(spark):
    items = spark.range(0, 3000, 1, 5).select("id", F.when(F.col("id") % 10 < 9, 3).otherwise(F.col("id") % 7 + 1).cast("long").alias("length"))
    found = packing.place(items, 10).collect()
    used = defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, s in sorted(parts):
            assert offset == at
            at += s
        assert at <= 10
    counts = dict(zip(*(x.tolist() for x in np.unique([r.length for r in found], return_counts=True))))
    assert len(found) == 3000 and len(used) <= first_fit_decreasing(counts, 10)


def test_packing_of_no_rows_and_wrong_ones(spark):
    empty = packing.pack(spark.createDataFrame([], DOCS), WORDS)
    assert empty.count() == 0 and empty.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    with pytest.raises(ValueError):
        packing.place(spark.createDataFrame([(1, 11)], "id int, length int"), 10)
    with pytest.raises(ValueError):
        packing.place(spark.createDataFrame([(1, 1, 1)], "id int, length int, Offset int"), 10)
    with pytest.raises(ValueError):
        packing.pieces(spark.createDataFrame([], DOCS), WORDS, 0)


def test_op13_query(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.QUERIES["op13_best_fit_packing"](spark, SF).collect()
    want = {}
    for k, text in docs.items():
        ids = tokens(tokenizer, text)
        want |= {(k, i): (4096 * i, len(p), zlib.crc32(p.tobytes())) for i, p in enumerate(np.split(ids, range(4096, len(ids), 4096)))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == want
    used = defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, s in sorted(parts):
            assert offset == at
            at += s
        assert at <= 4096
    assert len(used) == -(-sum(r.length for r in found) // 4096)
