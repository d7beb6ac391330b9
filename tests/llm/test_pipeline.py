"""The pipeline against its stages' brute force, on the smallest tables."""

import collections
import os
import random
import re

import duckdb
import pytest

import corpus_pipeline
from cadastra.llm import queries
from cadastra.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert sorted(after.columns) == sorted(docs.columns)
        kept.append((name, {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}))
        docs = after
    for name, before, after in kept:
        assert set(after) <= set(before) and after, name
    # line stage: what is left of a text are lines of it, and n_chars follows
    _, before, after = kept[1]
    for i, r in after.items():
        assert r.n_chars == len(r.text) and not collections.Counter(r.text.split("\n")) - collections.Counter(before[i].text.split("\n"))
    # decontamination: no ten words in a row of an item are left
    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = token.findall(r.text.lower())
        windows |= {tuple(w[s : s + 10]) for s in range(max(len(w) - 9, 1))}
    hit = lambda t: any(tuple(w[s : s + 10]) in windows for w in [token.findall(t.lower())] for s in range(len(w)))
    _, before, after = kept[3]
    assert {i for i, r in before.items() if not hit(r.text)} == set(after)
    # mix: whole copies, three at most
    for r in kept[4][2].values():
        assert r.taken == len(r.shards) * r.size and 1 <= len(r.shards) <= 3


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(queries.ORACLES[name])
    assert columns == sorted(want.columns)
    rows = sorted(tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == rows


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_has_a_row_for_each_document(spark, name):
    n = table(spark, SF, "pages" if name.startswith("op10") else "documents").count()
    found = queries.QUERIES[name](spark, SF)
    # op13 has a row for each piece of a document
    assert (found.where("piece = 0") if "piece" in found.columns else found).count() == n


def near_components(bodies):
    """Of each id the least id reachable over pairs with a 5-word Jaccard similarity of 0.8 or more."""
    sets, holders, root = {}, collections.defaultdict(list), {}
    for i, t in bodies.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[s : s + 5]) for s in range(max(len(w) - 4, 1))}
    links = collections.defaultdict(set)
    for i, own in sets.items():
        for j, n in collections.Counter(j for x in own for j in holders[x]).items():
            if n >= 0.8 * len(own | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
        for x in own:
            holders[x].append(i)
    for i in sorted(sets):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in root:
                root[k] = i
                todo += links[k]
    return root


def test_near_duplicate_stage_keeps_one_of_each_edited_group(spark):
    rng = random.Random(9)
    bodies = {}
    for _ in range(40):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 400))]
        for k in range(4):
            edited = list(w)
            for _ in range(rng.randint(0, len(w) // 40 + 1) if k else 0):
                edited[rng.randrange(len(w))] = f"x{rng.randrange(3000)}"
            bodies[len(bodies)] = " ".join(edited)
    # each text of a chain is near the next only
    w = [f"c{k}" for k in range(300)]
    bodies |= {900 + k: " ".join(w[k * 20 : k * 20 + 200]) for k in range(6)}
    bodies |= {1000: "", 1001: None, 1002: " ", 1003: "one two", 1004: "One  two", 1005: "one three"}
    docs = spark.createDataFrame([(i, t) for i, t in bodies.items()], "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    assert kept == set(near_components(bodies).values())


def test_near_duplicate_stage_tells_texts_with_one_passage_apart(spark):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(100)]
    bodies = {}
    for k in range(80):
        # similarities on both sides of 0.8: tails of own words, some of them begun like another text's
        tail = [f"t{k}_{j}" for j in range(rng.randint(8, 40))]
        if k % 3 == 2:
            before = bodies[k - 1].split()[100:]
            tail = before[: len(before) - rng.randint(0, 6)] + tail[: rng.randint(0, 12)]
        bodies[k] = " ".join(passage + tail)
    docs = spark.createDataFrame([(i, t) for i, t in bodies.items()], "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()}
    expected = set(near_components(bodies).values())
    assert 1 < len(expected) < 80
    assert kept == expected
