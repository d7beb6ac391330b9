"""What round 3 found in the training-data operators."""

import contextlib
import hashlib
import io
import random
import re

import corpus_pipeline
from cadastra.llm import fingerprint, html, lines, simhash


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_removed_lines_meet_the_documents_by_a_shuffle_at_every_size(spark):
    docs = spark.createDataFrame([(k, "a\nb\nc\n" + str(k)) for k in range(4)], "doc_id long, text string")
    found = lines.deduplicate(docs)
    assert "BroadcastHashJoin" not in plan(found)
    assert {r.doc_id: r.text for r in found.collect()} == {0: "a\nb\nc\n0", 1: "1", 2: "2", 3: "3"}


def test_the_near_duplicate_stage_of_the_pipeline_is_op1(spark, tmp_path):
    rng = random.Random(5)
    bodies = {}
    for k in range(30):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(200, 2000))]
        bodies[3 * k] = " ".join(w)
        bodies[3 * k + 1] = " ".join(w).upper()
        # texts of equal shingles that stand in other numbers: similar by sets, not always by fingerprints
        bodies[3 * k + 2] = " ".join(w + w[: len(w) // 2])
    docs = spark.createDataFrame(list(bodies.items()), "doc_id long, text string").repartition(3)
    prints = {i: simhash.fingerprint(t.encode()) for i, t in bodies.items()}
    root = {}
    for i in sorted(prints):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in root:
                root[k] = i
                todo += [j for j in prints if (prints[k] ^ prints[j]).bit_count() <= 3]
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == set(root.values())
    assert len(set(root.values())) > 30


def test_templates_come_from_all_pages_of_a_host(spark):
    page = lambda k, note: f"<article><p>own text {k}</p><p>{note}</p><p>end {k}</p></article>"
    rows = []
    for h in range(8):
        # all pages of a host but one share a sentence, which is therefore no part of a template
        rows += [(100 * h + k, f"http://h{h}.example/{k}", page(100 * h + k, "Another one." if k == 7 else "Nearly all say this.")) for k in range(40)]
    # all pages of this one do, copies included
    rows += [(900 + k, f"http://all.example/{k}", page(k % 30, "All say this.")) for k in range(40)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for h in range(8):
        for k in range(40):
            i = 100 * h + k
            note = "Another one." if k == 7 else "Nearly all say this."
            assert got[i] == f"own text {i}\n\n{note}\n\nend {i}"
    for k in range(40):
        assert got[900 + k] == f"own text {k % 30}\n\nend {k % 30}"


def test_fingerprints_are_kept_as_bytes_between_steps(spark, monkeypatch):
    kinds = []
    keep = fingerprint.stored

    def seen(df):
        kinds.extend((f.name, f.dataType.simpleString()) for f in df.schema if f.name in ("fingerprint", "edited_fingerprint", "edited_sha256"))
        return keep(df)

    monkeypatch.setattr(fingerprint, "stored", seen)
    docs = spark.createDataFrame([(1, "One. Two. Three."), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.edit_and_compare(docs).collect()}
    assert {k for _, k in kinds} == {"binary"} and len({n for n, _ in kinds}) == 3
    assert got[3].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert re.fullmatch("([0-9a-f]{30})+", got[1].fingerprint) and got[2].fingerprint == got[3].fingerprint == ""
