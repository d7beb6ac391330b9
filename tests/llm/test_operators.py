"""The training-data operators against brute force, on small rows with awkward cases."""

import collections
import hashlib
import random
import time
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadastra.llm import components, decontaminate, fingerprint, html, langid, lines, mixing, quality, simhash, suffix, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, fp long, size string, mix string, match int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(spark, texts):
    """Documents with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 5 else None, 1, "x", "y", 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = [(i, words(rng, rng.randint(1, 120))) for i in range(40)]
    passage = words(rng, 120)
    out += [(100, f"alpha {passage} beta"), (101, f"gamma delta {passage}"), (102, passage), (103, passage), (103, passage)]
    out += [(200, None), (201, ""), (202, "  \n "), (None, passage), (None, None), (203, "é" * 500), (204, "é" * 500), (205, "a" * 900)]
    long = words(rng, 9000)
    out += [(300, long), (301, "x " + long), (302, "\n".join(words(rng, 3) for _ in range(50)))]
    return out


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_fingerprints_and_components(spark, texts):
    found = simhash.near_duplicates(corpus(spark, texts)).collect()
    assert len(found) == len(texts)
    expect = {i: brute_fingerprint(t) for i, t in texts if i is not None}
    assert all(r.fp % (1 << 64) == expect[r.doc_id] for r in found if r.doc_id is not None)
    ids = sorted(expect)
    reach = {i: {j for j in ids if (expect[i] ^ expect[j]).bit_count() <= 3} for i in ids}
    for r in found:
        if r.doc_id is None:
            continue
        seen, todo = {r.doc_id}, [r.doc_id]
        while todo:
            new = reach[todo.pop()] - seen
            seen |= new
            todo += new
        assert r.component_id == min(seen)


def test_simhash_links_find_every_near_pair(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(150)]
    points = set(base)
    for b in base:
        for _ in range(4):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            points.add(x)
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    got = {frozenset((r.a, r.b)) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()}
    want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert got == want and want


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(60))


def test_keep_one(spark, texts):
    kept = simhash.keep_one(corpus(spark, texts))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    ids = [r.doc_id for r in kept.collect()]
    firsts = {r.component_id for r in simhash.near_duplicates(corpus(spark, texts)).collect()}
    assert {i for i in ids if i is not None} == firsts and 103 not in ids and 200 in ids and 201 not in ids


def test_repeated_strings(spark, texts):
    bodies = [(i, (t or "").encode()) for i, t in texts]
    counts = collections.Counter(b[s : s + 400] for _, b in bodies for s in range(len(b) - 399))
    want = collections.Counter()
    for i, b in bodies:
        gone = bytearray(len(b))
        for s in range(len(b) - 399):
            if counts[b[s : s + 400]] > 1:
                gone[s : s + 400] = b"\1" * 400
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[(i, bytes(x for x, g in zip(b, gone) if not g), spans)] += 1
    got = collections.Counter((r.doc_id, bytes(r.kept), len(r.spans)) for r in suffix.remove_repeats(corpus(spark, texts)).collect())
    assert got == want


def test_repeated_string_across_a_segment(spark):
    rng = random.Random(21)
    body = words(rng, 14_000, 50_000)
    passage = body[59_700:60_700]
    rows = [(1, body), (2, f"{words(rng, 20)} {passage} {words(rng, 30)}")]
    got = {r.doc_id: r for r in suffix.remove_repeats(corpus(spark, rows)).collect()}
    assert len(body) > 70_000 and [(s.start <= 59_700, s["end"] >= 60_700) for s in got[1].spans] == [(True, True)]
    assert got[1].spans[0]["end"] - got[1].spans[0].start == got[2].spans[0]["end"] - got[2].spans[0].start


def test_repeated_strings_of_a_crowded_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", 3)
    rng = random.Random(8)
    passage = words(rng, 100)[:450]
    rows = [(i, words(rng, 5) + passage[: 400 + i * 5] + words(rng, 30)) for i in range(10)]
    bodies = {i: t.encode() for i, t in rows}
    counts = collections.Counter(b[s : s + 400] for b in bodies.values() for s in range(len(b) - 399))
    for r in suffix.remove_repeats(corpus(spark, rows)).collect():
        b = bodies[r.doc_id]
        gone = set()
        for s in range(len(b) - 399):
            if counts[b[s : s + 400]] > 1:
                gone |= set(range(s, s + 400))
        assert bytes(r.kept) == bytes(x for k, x in enumerate(b) if k not in gone)


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(200):
        x = np.array([rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 60))], dtype=np.int64)
        depth = rng.choice([1, 2, 4, 7, 100])
        order = suffix.suffix_array(x, depth)
        heads = [x[i : i + depth].tolist() for i in order]
        assert sorted(order.tolist()) == list(range(len(x))) and heads == sorted(heads)


def test_line_runs(spark):
    rng = random.Random(4)
    pool = [words(rng, 6) for _ in range(12)] + [words(rng, 30) for _ in range(4)] + [words(rng, 55) for _ in range(2)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.9 else "" for _ in range(rng.randint(0, 25)))) for i in range(30)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "one"), (54, rows[3][1]), (55, pool[-1]), (56, f"{pool[13]}\n{pool[14]}"), (57, f"x\n{pool[13]}\n{pool[14]}\ny")]
    rows += [(60 + i, f"{words(rng, 9)}\n{pool[0]}\n{words(rng, 9)}") for i in range(5)]
    seen, gone = set(), collections.defaultdict(set)
    for i, t in sorted(rows):
        solid = [(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(" ")]
        for s in range(len(solid)):
            for size in (1, 2, 3):
                body = tuple(x for _, x in solid[s : s + size])
                if len(body) < size or size < 3 and sum(len(x.split()) for x in body) < 50:
                    continue
                if body in seen:
                    gone[i] |= {k for k, _ in solid[s : s + size]}
                seen.add(body)
    got = {r.doc_id: r.text for r in lines.deduplicate(corpus(spark, rows)).collect()}
    assert gone[55] and gone[57] == {1, 2} and not gone[62]
    for i, t in rows:
        want = t if not gone[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        assert got[i] == want


def test_decontamination(spark, texts):
    rng = random.Random(9)
    base = dict(t for t in texts if t[0] is not None)
    items = [(1, " ".join(base[300].split()[50:75]).upper()), (2, "alpha"), (3, None), (4, ""), (5, words(rng, 40)), (None, "gamma delta"), (1, "beta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = token.findall((t or "").lower())
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[s : s + 10])].add("" if i is None else str(i))
    want = collections.Counter()
    for i, t in texts:
        w = token.findall((t or "").lower())
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    names |= own
        want[(i, len(w), len(hit), tuple(sorted(names)))] += 1
    docs = corpus(spark, texts)
    got = decontaminate.matches(docs, bench)
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == want
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in want.items() if not k[2])


def test_longest_matches(spark):
    rng = random.Random(12)
    item = [f"i{k}" for k in range(40)]
    rows = [(1, " ".join(["x", *item[5:30], "y", *item[0:12], *item[35:40]])), (2, " ".join(item)), (3, "a " * 60), (4, words(rng, 50))]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "a " * 25), (7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.matches(corpus(spark, rows), bench).collect()}
    found = {r.doc_id: r[-1] for r in decontaminate.locate(corpus(spark, rows), bench).collect()}
    assert {(m.start, m["end"], m["item"], m.item_start) for m in found[1]} == {(1, 26, "7", 5), (27, 39, "7", 0)}
    assert got[1]["items"] == got[2]["items"] == ["7"] and {(m.start, m["end"]) for m in found[2]} == {(0, 40)}
    assert got[3].n_hit == 60 and [(m.start, m["end"]) for m in found[3]] == [(k, k + 25) for k in range(36)] and found[4] == []


def test_a_passage_that_very_many_items_hold(spark):
    licence = " ".join(f"w{k}" for k in range(30))
    bench = spark.createDataFrame([(k, f"own{k} {licence} end{k}") for k in range(10_000)], "item_id long, text string")
    text = " and ".join([licence] * 200)
    docs = spark.createDataFrame([(1, text), (2, f"x {licence} end77 y")], "doc_id long, text string")
    began = time.time()
    one, two = decontaminate.locate(docs, bench).orderBy("doc_id").collect()
    assert time.time() - began < 60
    assert [(m.start, m["end"]) for m in one["match"]] == [(31 * k, 31 * k + 30) for k in range(200)]
    assert {(m["item"], m.item_start, m.n_items, m.n_places) for m in one["match"]} == {("0", 1, 10_000, 10_000)}
    assert [(m.start, m["end"], m["item"], m.item_start, m.n_items, m.n_places) for m in two["match"]] == [(1, 32, "77", 1, 1, 1)]
    found = decontaminate.matches(docs, bench).orderBy("doc_id").collect()
    assert [(r.n_hit, len(r["items"])) for r in found] == [(6000, 10_000), (31, 10_000)]


def test_located_runs_equal_brute_force(spark):
    rng = random.Random(31)
    word = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(str(k), word(rng.randint(1, 20))) for k in range(12)] + [("5", word(9)), (None, "a b a b a"), ("6", None), ("7", "")]
    rows = [(k, word(rng.randint(0, 60))) for k in range(40)]
    found = decontaminate.locate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), window=4).collect()
    own = [(i or "", (t or "").split()) for i, t in items]
    for (_, text), got in zip(rows, sorted(found, key=lambda r: r.doc_id)):
        w, want, reached = text.split(), [], 0
        for s in range(len(w)):
            starts = [(i, x, o) for i, x in own for o in range(len(x)) if x[o] == w[s]]
            size = lambda x, o, s=s: next((n for n in range(len(x) - o) if s + n >= len(w) or x[o + n] != w[s + n]), len(x) - o)
            if not any(size(x, o) >= min(4, len(x)) for i, x, o in starts if o == 0 or len(x) >= 4):
                continue
            n = max(size(x, o) for _, x, o in starts)
            places = [(i, o) for i, x, o in starts if size(x, o) == n]
            if s + n > reached:
                reached = s + n
                first = min(places)
                want.append((s, s + n, *first, len({i for i, _ in places}), len(places)))
        assert [tuple(m) for m in got["match"]] == want


def test_decontamination_in_blocks(spark, texts, monkeypatch):
    bench = spark.createDataFrame([(k, " ".join(t.split()[:15])) for k, (_, t) in enumerate(texts) if t], "item_id long, text string")
    docs = corpus(spark, texts)
    whole = sorted(map(repr, decontaminate.matches(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1000)
    assert sorted(map(repr, decontaminate.matches(docs, bench).collect())) == whole


def test_fingerprints_of_edits(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(words(rng, 8) + "." for _ in range(rng.randint(1, 60)))) for i in range(25)]
    rows += [(30, None), (31, ""), (32, rows[4][1]), (33, rows[4][1]), (None, "tail. end.")]
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    units = lambda t: {u for u in re.split(r"\n+|(?<=[.!?])\x20+", t) if u.strip(" ")}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r.doc_id: r for r in fingerprint.edit_and_compare(corpus(spark, rows)).collect()}
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(like(units(t), units(edited)))
        assert r.near_next == pytest.approx(like(units(t), units(after)))
    assert got[32].fingerprint == got[33].fingerprint == got[4].fingerprint != got[5].fingerprint


def test_likeness_follows_from_the_returned_fingerprints(spark):
    rng = random.Random(16)
    pool = [words(rng, 5) + "." for _ in range(14)]
    rows = [(f"d{i:02}", "\n".join(rng.sample(pool, rng.randint(1, 8)))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprint.edit_and_compare(docs).collect()}

    def cells(hexed):
        parts = [hexed[i : i + 30] for i in range(0, len(hexed), 30)]
        return {int(x[:2], 16): (int(x[2:6], 16), int(x[6:22], 16), int(x[22:], 16)) for x in parts}

    def recovered(a, b):
        """Digests of either side, by peeling the subtracted cells; a digest is in as many cells as there are subtables."""
        x, y = cells(a), cells(b)
        d = {k: (x.get(k, (0, 0, 0))[0] - y.get(k, (0, 0, 0))[0], *(p ^ q for p, q in zip(x.get(k, (0, 0, 0))[1:], y.get(k, (0, 0, 0))[1:]))) for k in x | y}
        where = collections.defaultdict(set)
        for side in (x, y):
            for k, (n, key, check) in side.items():
                if n == 1:
                    where[key, check].add(k)
        plus = minus = 0
        known = {kc: ks for kc, ks in where.items() if len(ks) == fingerprint.SUBTABLES}
        while hit := next(((k, v) for k, v in d.items() if abs(v[0]) == 1 and v[1:] in known), None):
            n, key, check = hit[1]
            plus, minus = plus + (n > 0), minus + (n < 0)
            for k in known[key, check]:
                d[k] = (d[k][0] - n, d[k][1] ^ key, d[k][2] ^ check)
        return None if any(v != (0, 0, 0) for v in d.values()) else (plus, minus)

    order, checked = sorted(got, reverse=True), 0
    for k, i in enumerate(order):
        own, after = got[i], got[order[(k + 1) % len(order)]]
        n = len(set(dict(rows)[i].split("\n")))
        for other, like in ((own.edited_fingerprint, own.near_edited), (after.fingerprint, own.near_next)):
            if found := recovered(own.fingerprint, other):
                checked += 1
                assert like == pytest.approx((n - found[0]) / (n + found[1]))
    assert checked > 3


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(0, 60))) for i in range(600)] + [(700, None)]
    docs = corpus(spark, rows)
    out = mixing.mix(docs.drop("mix"))
    found = out.select("doc_id", "source", "mix.*").collect()
    sizes = collections.Counter()
    for r in found:
        sizes[r.source] += r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while over := [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]:
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.discard(s)
        rest = sum(sizes.values()) - sum(target.values())
    total = sum(weight[x] for x in free)
    target |= {s: rest * weight[s] / total for s in free}
    taken = collections.Counter()
    for r in found:
        assert len(r.shards) <= 3 and r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += len(r.shards) * r.size
    assert all(abs(taken[s] - target[s]) <= 40 for s in names)
    again = mixing.mix(docs.drop("mix").repartition(7)).select("doc_id", "mix.*").collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in out.select("doc_id", "mix.*").collect())
    copies = mixing.spread(out).count()
    assert copies == sum(len(r.shards) for r in found)


def test_mix_closes_the_gap_that_a_huge_document_leaves(spark):
    # the huge document lies in the middle of the hash order, so the partial pass ends there
    share = F.shiftrightunsigned(F.xxhash64("id", F.lit(17)), 34) / F.lit(1 << 30)
    huge = spark.range(90_000, 90_500).where(share.between(0.47, 0.55)).first().id
    rng = random.Random(8)
    rows = [(i, "a", words(rng, rng.randint(1, 20))) for i in range(6000)] + [(huge, "a", words(rng, 20_000))]
    rows += [(20_000 + i, "b", words(rng, 20)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    taken, target = collections.Counter(), {}
    for r in mixing.mix(docs).select("doc_id", "source", "mix.*").collect():
        assert r.doc_id != huge or not r.shards
        taken[r.source] += len(r.shards) * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)


def test_mix_keeps_columns_of_any_name(spark):
    names = "doc_id long, source string, text string, key string, block int, b int, _key int, doc string, size int, order int, mix int"
    rows = [(i if i % 9 else None, f"s{i % 3}", "a b c " * (i % 7), "k", 1, 2, 77, "d", 5, 6, 7) for i in range(120)]
    docs = spark.createDataFrame(rows, names)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix_"]
    got = out.drop("mix_").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, docs.collect()))
    # rows without an id are not all taken or all left
    assert len({len(r.mix_.shards) for r in out.where("doc_id is null and source = 's0'").collect()}) > 1


def test_mix_without_broadcasts(spark, monkeypatch):
    rng = random.Random(5)
    docs = corpus(spark, [(i, words(rng, rng.randint(0, 60))) for i in range(200)]).drop("mix")
    whole = sorted(map(repr, mixing.mix(docs).select("doc_id", "mix.*").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    assert sorted(map(repr, mixing.mix(docs).select("doc_id", "mix.*").collect())) == whole


def test_evidence_of_passages():
    model = toxicity._model() | {"decay": 1.0, "log_k": 0.0}
    one = toxicity.evidence([12.0], 99, model)
    assert one == pytest.approx(-np.log(-np.expm1(-np.exp(-(12.0 - np.log(100))))))
    assert toxicity.evidence([12.0, 11.0], 99, model) > one == toxicity.evidence([12.0, 0.1], 99, model)
    assert toxicity.evidence([], 99, model) == 0 and toxicity.evidence([12.0], 9999, model) < one


def test_significant_tokens_match_brute_force(spark):
    rng = random.Random(3)
    stats = [(t, f, rng.choice([0, 0, 9, 30]), rng.choice([0, 5, 40]), rng.randint(0, 90)) for t in range(1, 40) for f in range(4)]
    rows = [(t, f, a * toxicity._VOTE, c * toxicity._VOTE, u * toxicity._VOTE) for t, f, a, c, u in stats]
    models = toxicity.significant(spark.createDataFrame(rows, "token long, fold int, toxic long, clean long, clean_uses long"))
    from statistics import NormalDist

    limit = NormalDist().inv_cdf(1 - toxicity.FALSE_TOKENS / (2 * 39 + 2))
    for k, model in enumerate(models):
        t, c = collections.Counter(), collections.Counter()
        for x, f, a, b, _ in stats:
            t[x] += a * (f != k)
            c[x] += b * (f != k)
        n1, n0 = sum(t.values()), sum(c.values())
        want = {}
        for x in range(1, 40):
            if not t[x] + c[x]:
                continue
            e = (t[x] + c[x]) * n1 / (n1 + n0)
            g = 2 * sum(o * np.log(o / w) for o, w in ((t[x], e), (c[x], t[x] + c[x] - e)) if o)
            p = toxicity.FLOOR + toxicity.PRIOR * (t[x] + c[x]) / (n1 + n0)
            m1, m0 = (n + toxicity.FLOOR * 39 + toxicity.PRIOR for n in (n1, n0))
            if np.sqrt(max(g, 0)) >= limit:
                want[x] = np.log((t[x] + p) / (m1 - t[x] - p)) - np.log((c[x] + p) / (m0 - c[x] - p))
        assert model["tokens"].tolist() == sorted(want)
        assert model["scores"].tolist() == pytest.approx([want[x] for x in sorted(want)])


def test_shard_quotas_are_exact():
    quotas = np.array([1000, 0, 7, 333])
    dealt = mixing.split_quotas(quotas, 16, 1)
    assert (dealt.sum(axis=0) == quotas).all() and dealt.sum(axis=1).max() - dealt.sum(axis=1).min() <= 4


def test_classifiers_on_held_out_rows(spark):
    rng = random.Random(7)
    texts, quality_labels, toxic_labels = [], [], []
    for i in range(400):
        bad, rude = i % 4 == 0, i % 5 == 0
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 120))]
        if rude:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["scum", "moron"]))
        texts.append((i, " ".join(x + "***" if bad else x for x in w)))
        quality_labels.append((i, int(not bad), int(rude)))
    docs = corpus(spark, [*texts, (900, None), (901, "")])
    labels = spark.createDataFrame([*quality_labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    train = labels.where("doc_id % 2 = 0 or doc_id is null")
    scored = quality.score(docs, quality.fit(docs, train))
    rows = {r.doc_id: r.quality_score for r in scored.collect()}
    assert len(rows) == 402 and all(0 <= v <= 1 for v in rows.values())
    good = [(rows[i] >= 0.3) == bool(q) for i, q, _ in quality_labels if i % 2]
    assert sum(good) / len(good) > 0.95
    found = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxicity.fit(docs, train)).collect()}
    good = [(found[i].score >= 0.3) == bool(x) for i, _, x in quality_labels if i % 2]
    assert sum(good) / len(good) > 0.95
    text = dict(texts)[5].encode()
    assert any(b"scum" in text[s.start : s.end] or b"moron" in text[s.start : s.end] for s in found[5].spans)


def test_models_without_labels(spark):
    docs = corpus(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.fit(docs, none)).count() == 2
    assert toxicity.score(docs, toxicity.fit(docs, none)).count() == 2
    assert {r.lang for r in langid.label(docs, langid.fit(docs.where("false"))).collect()} == {"und"}


def test_maximal_segments():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(-4, 5, rng.integers(1, 25)).astype(float)
        found = toxicity.maximal_segments(s)
        best = max((v for _, _, v in found), default=0.0)
        want = max([0.0, *(s[i:j].sum() for i in range(len(s)) for j in range(i + 1, len(s) + 1))])
        assert best == want == toxicity.best_segment(s)
        assert all(s[a:b].sum() == v > 0 for a, b, v in found)


def test_languages(spark):
    rng = random.Random(1)
    lexicon = {"aa": ["the", "thing", "with", "that", "there"], "bb": ["que", "los", "una", "para", "esta"], "ru": ["это", "как", "так", "что", "для"]}
    say = lambda lang, n: " ".join(rng.choice(lexicon[lang]) for _ in range(n))
    rows = [(i, say(lang, 30), lang) for i, lang in enumerate(list(lexicon) * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    mixed = say("aa", 20) + ". " + say("ru", 10)
    tests = spark.createDataFrame([(1, say("bb", 12)), (2, mixed), (3, None), (4, "123 ?!"), (5, ""), (6, "→ ½"), (7, "日本")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.label(tests, model).collect()}
    assert [got[i].lang for i in (1, 2, 3, 4, 5, 6)] == ["bb", "aa", "und", "und", "und", "und"]
    assert got[2].score == pytest.approx(20 / 30) and [s.lang for s in got[2].spans] == ["aa", "ru"]
    assert got[7].lang in model["names"] and got[3].score == 0


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(4)
    lengths = np.array([0, 1, 5, 3, 6])
    scores = rng.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    path = langid.viterbi(scores, lengths, 2.0)
    at = 0
    value = lambda s, p: sum(s[i][k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
    import itertools

    for n in lengths.tolist():
        s = scores[at : at + n]
        if n:
            assert value(s, path[at : at + n]) == pytest.approx(max(value(s, p) for p in itertools.product(range(3), repeat=n)), abs=1e-4)
        at += n


PAGE = """<!DOCTYPE html><html><head><title>{t}</title><script>var a="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/x">{n}</a></li></ul></nav><div class="cookie-notice">ok?</div><main><article><header><h1>{t} &amp; co</h1></header>
<p>One   <b>two</b><br>{b}</p><div class="ad">buy {n}</div><p>Written for the daily letter.</p><p>Four<span class="ads">no</span> {b}<ul><li>a{n}<li>b{n}</ul>
<form>f</form></article><section class="comments"><article class="comment"><p>first! {n}</p></article></section></main><aside>s</aside><footer>f</footer></body></html>"""


def test_main_text(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(t=f"Title {i}", n=f"n{i}", b=f"body {i}"), "x") for i in range(20)]
    rows += [(50, "http://h.example/50", None, "x"), (51, None, "<p>lone</p>", "x"), (52, "bad", "", "x"), (53, "http://o.example", "<div id=c>A<p>x &lt; y<p>z&am", "x")]
    rows += [rows[0]]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    texts = collections.defaultdict(list)
    for r in got.collect():
        texts[r.page_id].append(r.text)
    assert len(texts[0]) == 2
    for i in range(20):
        # the sentence that all pages of the host share is part of its template
        assert texts[i][0] == f"Title {i} & co\n\nOne two body {i}\n\nFour body {i}\n\nan{i}\n\nbn{i}"
    assert (texts[50], texts[51], texts[52], texts[53]) == ([""], ["lone"], [""], ["A\n\nx < y\n\nz&am"])


def test_tree_matching():
    a = html.parse("<div><p>a</p><p>b</p><ul><li>c</ul></div>")
    b = html.parse("<div><p>b</p><ul><li>c</ul></div>")
    same = html.match(a, b)
    # of two paragraphs the one with equal text is the partner
    assert [html._text(x.children[0]) for x, _ in same if x.tag == "p"] == ["b"]
    assert html.induce(["<p>a</p>", "<p>a</p>"]) == []


def test_alignment_matches_brute_force(monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(html, "TABLE", 12)
    for _ in range(150):
        table = rng.integers(0, 4, (rng.integers(0, 9), rng.integers(0, 9)))
        n, m = table.shape
        best = np.zeros((n + 1, m + 1), dtype=int)
        for i in range(n):
            for j in range(m):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + table[i, j])
        pairs = html.align(lambda i, t=table: t[i], n, m)
        assert sum(table[i, j] for i, j in pairs) == best[n, m]
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article class="post has-sidebar"><p>a</p></article>', "a"),
        ('<article><p id="alert-2">a</p><div class="share-price-story">b</div></article>', "a\n\nb"),
        ("<article><p>a <math><mi>x</mi></math> b</p></article>", "a x b"),
        ("<article><p>a <svg><path> b</p><p>c</p></article>", "a\n\nc"),
        ("<main><article><p>a</p></article><article><p>b</p></article></main>", "a\n\nb"),
        ("<h1>t</h1><main><p>a</p></main>", "t\n\na"),
        ('<form id="page"><h1>t</h1><p>a</p></form><form><p>mail</p></form>', "t\n\na"),
        ('<div class="site-footer">f</div><div class="cookie-notice">n</div><section class="comments"><article>c</article></section><p>a</p>', "a"),
        ("<p>1 < 2 <!-- c --><script>'</p>'</script>&amp;<unknown>x</unknown>", "1 < 2 &x"),
        ('<p title="open>a</p><p>b</p>', "a\n\nb"),
        ("", ""),
    ],
)
def test_awkward_pages(page, text):
    assert html.extract(page) == text


def test_deep_long_and_broken_pages(spark):
    deep = lambda x: "<div>" * 20_000 + f"<p>{x}</p>" + "</div>" * 20_000
    rows = [(k, "http://d.example/", deep(f"deep {k}")) for k in range(3)]
    rows += [(10, "http://e.example/", '<a "' * 50_000 + "x"), (11, "http://e.example/", "<p>" + "word " * 2_000_000), (12, "http://e.example/", "</div></p>" * 50_000 + "<p>y")]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(3)] == ["deep 0", "deep 1", "deep 2"]
    assert (got[10], len(got[11]), got[12]) == ("", 9_999_999, "y")
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_two_layouts_of_a_host():
    one = [f"<article><p>text {k}</p><p>Same note.</p></article>" for k in range(3)]
    two = [f"<main><section><p>other {k}</p></section></main>" for k in range(3)]
    template = frozenset(html.induce(one + two))
    assert [html.extract(x, template) for x in one + two] == ["text 0", "text 1", "text 2", "other 0", "other 1", "other 2"]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    docs = corpus(spark, rows)
    bench = spark.createDataFrame([], "item_id long, text string")
    n = len(rows)
    assert simhash.near_duplicates(docs).count() == n
    assert suffix.remove_repeats(docs).count() == n
    assert lines.deduplicate(docs).count() == n
    assert decontaminate.matches(docs, bench).count() == n
    assert fingerprint.edit_and_compare(docs).count() == n
    assert mixing.mix(docs).count() == n
    assert F.lit(1) is not None
