"""Bucketed, clustered and indexed tables, guarded loads, registered numbers, medians and the review intake."""

import random
import re
from statistics import median

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cadastra.operators import keys, loads, medians, reviews, search
from cadastra.plans import jobs, serving
from cadastra.sources import grid, readers, writers
from cadastra.sources.buckets import BucketTable
from cadastra.sources.grid import GridTable
from cadastra.streaming import reviews as intake

REVIEW = "code_commune string, review_id string, seq long, points_positifs string, points_negatifs string, nb_accord int"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def metric(df, name):
    """Sum of a scan metric after the plan has run."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    executed = executed.executedPlan() if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else executed
    leaves = executed.collectLeaves()
    found = 0
    for k in range(leaves.size()):
        node = leaves.apply(k)
        while node.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            node = node.plan().collectLeaves().apply(0)
        if node.metrics().contains(name):
            found += node.metrics().apply(name).value()
    return found


@pytest.fixture
def table(spark, tmp_path):
    made = BucketTable(spark, str(tmp_path / "table"))
    made.create(spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("n")), ["k"], 16)
    return made


@pytest.fixture
def many_partitions(spark):
    """Small ranges stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Buckets


def test_upsert_leaves_other_files_alone(spark, table):
    before, rows = table.files(), table.read()
    delta = spark.createDataFrame([("7", "new", 2), ("900", "new", 2)], "k string, v string, n int")
    touched = table.upsert(delta)
    after = table.files()
    assert 1 <= len(touched) <= 2
    kept = {f: t for f, t in before.items() if int(re.search(r"_bucket=(\d+)", f)[1]) not in touched}
    assert len(kept) >= 14 and kept.items() <= after.items()
    full = sorted(map(tuple, keys.upsert(rows, delta, ["k"]).collect()))
    assert sorted(map(tuple, table.read().select("k", "v", "n").collect())) == full


def test_upsert_takes_the_last_row_of_a_key(spark, table):
    delta = spark.createDataFrame([("7", "b", 2, 2), ("7", "a", 2, 1), ("7", "c", 3, 3)], "k string, v string, n int, o int")
    table.upsert(delta, "o")
    assert [tuple(r) for r in table.read().where("k = '7'").collect()] == [("7", "c", 3)]


def test_empty_delta_writes_nothing(spark, table):
    before, version = table.files(), table.version
    assert table.upsert(table.read().where("false")) == set()
    assert table.files() == before and table.version == version


def test_merge_by_policy_and_null_keys(spark, tmp_path):
    made = BucketTable(spark, str(tmp_path / "t"))
    made.create(spark.createDataFrame([("a", "x", 1), (None, "n", 2)], "k string, v string, n int"), ["k"], 4)
    made.merge(spark.createDataFrame([("a", "y", None), ("b", "z", 5)], "k string, v string, n int"), {"v": "new", "n": "coalesce"})
    assert sorted(map(tuple, made.read().collect()), key=str) == [("a", "y", 1), ("b", "z", 5), (None, "n", 2)]


def test_readers_keep_their_version_until_vacuum(spark, table):
    seen = table.read()
    table.upsert(spark.createDataFrame([("7", "new", 2)], "k string, v string, n int"))
    assert seen.where("v = 'new'").count() == 0 and table.read().where("v = 'new'").count() == 1
    table.vacuum()
    assert table.read().count() == 200 and table.read().where("v = 'new'").count() == 1


def test_a_load_that_broke_off_is_not_seen(spark, table):
    # files and a manifest folder without its end mark, as a lost driver leaves them
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/manifest/version=1")
    assert table.version == 0 and table.read().count() == 200
    table.upsert(spark.createDataFrame([("7", "new", 2)], "k string, v string, n int"))
    assert table.version == 1 and table.read().where("v = 'new'").count() == 1


def test_lookup_reads_only_its_buckets(spark, table):
    found = table.lookup(spark.createDataFrame([("7",), ("8",), ("none",)], "k string"))
    assert sorted(r.k for r in found.collect()) == ["7", "8"]
    assert len({re.search(r"_bucket=(\d+)", f)[1] for f in found.inputFiles() if "_bucket=" in f}) <= 3


def test_table_without_rows(spark, tmp_path):
    made = BucketTable(spark, str(tmp_path / "t"))
    assert not made.exists()
    made.create(spark.createDataFrame([], "k string, v string"), ["k"], 4)
    assert made.exists() and made.read().count() == 0
    made.upsert(spark.createDataFrame([("a", "b")], "k string, v string"))
    assert made.read().count() == 1


# Guarded loads and numbers


def test_guarded_load_counts_in_the_pass_that_stages(spark, table):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(k):
        evaluated.add(1)
        return k

    rows = spark.createDataFrame([("1", "in"), ("2", "in"), ("300", "in"), ("300", "in"), ("5", "out"), ("6", None)], "k string, g string")
    rows = rows.select(F.udf(seen)("k").alias("k"), F.lit("new").alias("v"), F.lit(2).alias("n"), "g")
    reference = spark.createDataFrame([("in",), ("in",)], "g string")
    wide = BucketTable(spark, table.path + "-g")
    wide.create(table.read().withColumn("g", F.lit("in")), ["k"], 8)
    found = loads.guarded(wide, rows, reference, "g")
    assert found.counts == {"n_rows": 6, "n_inserted": 2, "n_updated": 2, "n_skipped": 2}
    assert sorted(r.k for r in found.rejects.collect()) == ["5", "6"]
    # the rows are evaluated once, and of the table only the buckets that are written
    assert evaluated.value == 6 and found.buckets < set(range(8)) and found.rejects.columns == rows.columns
    assert sorted(r.k for r in wide.read().where("v = 'new'").collect()) == ["1", "2", "300"] and wide.read().count() == 201


def test_guarded_insert_skips_what_exists(spark, table):
    wide = BucketTable(spark, table.path + "-g")
    wide.create(table.read().withColumn("code_commune", F.lit("x")), ["k"], 8)
    rows = spark.createDataFrame([("1", "new", 2, "x"), ("301", "new", 2, "x")], "k string, v string, n int, code_commune string")
    found = jobs.load_with_guard(wide, rows, rows, mode="insert")
    assert found.counts == {"n_rows": 2, "n_inserted": 1, "n_updated": 0, "n_skipped": 1}
    assert [r.k for r in wide.read().where("v = 'new'").collect()] == ["301"] and found.rejects.count() == 0
    none = jobs.load_with_guard(wide, rows, rows.limit(0))
    assert none.counts == {"n_rows": 2, "n_inserted": 0, "n_updated": 0, "n_skipped": 2} and none.buckets == set()
    replaced = jobs.load_with_guard(wide, rows, rows, mode="replace")
    assert replaced.counts["n_inserted"] == 2 and wide.read().count() == 2
    with pytest.raises(ValueError):
        loads.guarded(wide, rows, rows, mode="other")


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_numbers_survive_loads_in_any_order(spark, tmp_path, order):
    parts = [[("b", 1), ("d", 2), ("d", 3)], [("a", 1), ("b", 2), ("c", 3), (None, 4)]]
    registry = loads.KeyRegistry(spark, str(tmp_path / "r"), ["k"], buckets=4)
    given = {}
    for k in order:
        found = registry.assign(spark.createDataFrame(parts[k], "k string, x int")).collect()
        assert len(found) == len(parts[k])
        for r in found:
            assert given.setdefault(r.k, r.id) == r.id
    assert given.pop(None, None) is None
    assert sorted(given.values()) == [1, 2, 3, 4] and registry.table.note == 4
    again = {r.k: r.id for r in registry.assign(spark.createDataFrame(parts[0] + parts[1], "k string, x int")).collect() if r.k}
    assert again == given


# Search


def test_trigram_index_reads_only_the_querys_trigrams(spark, tmp_path):
    names = spark.createDataFrame([("1", "Saint-Lutry"), ("2", "Lutry"), ("3", "Vevey"), ("4", "Lutrive"), ("5", None), ("6", "Val-de-Lutry")], "code_commune string, nom string")
    index = search.TrigramIndex(spark, str(tmp_path / "i"), "code_commune", 8)
    index.build(names, "nom")
    read = index.postings(["lut", "utr"])
    shown = plan(read)
    assert re.search(r"PartitionFilters: .*_bucket#\d+ (IN|INSET|= )", shown) and re.search(r"PushedFilters: .*In\(trigram", shown)
    assert metric(read, "numFiles") < metric(spark.read.parquet(str(tmp_path / "i")), "numFiles")
    assert {r.code_commune for r in index.candidates("utry").collect()} == {"1", "2", "6"}
    assert index.candidates("ut") is None


def test_required_trigrams_are_in_every_text_that_contains_the_query(spark):
    random.seed(4)
    rows = []
    for _ in range(300):
        name = "".join(random.choice("abé -'") for _ in range(random.randint(3, 14)))
        at = random.randint(0, len(name) - 1)
        rows.append((name.upper() if random.random() < 0.3 else name, name[at : at + random.randint(1, 8)]))
    df = spark.createDataFrame([(a, search.required(b), b) for a, b in rows], "a string, t array<string>, b string")
    from cadastra.functions import text

    assert df.where(F.size(F.array_except("t", text.trigrams(F.col("a")))) > 0).count() == 0


@pytest.mark.parametrize("query", ["a", "ab", "aba", "ba a", "A-b"])
def test_indexed_search_equals_the_scan(spark, tmp_path, query):
    random.seed(5)
    names = [(str(k), "".join(random.choice("ab -") for _ in range(9)), k % 3 or None, None, None, "1") for k in range(300)]
    communes = spark.createDataFrame(names, "code_commune string, nom string, population int, code_departement string, code_region string, code_postal string")
    dep, reg = spark.createDataFrame([], "code_departement string, nom string"), spark.createDataFrame([], "code_region string, nom string")
    index = search.TrigramIndex(spark, str(tmp_path / "i"), "code_commune", 4)
    index.build(communes, "nom")
    scan = [(r.code_commune, r.score) for r in serving.search(communes, dep, reg, query, 50).collect()]
    assert [(r.code_commune, r.score) for r in serving.search(communes, dep, reg, query, 50, index).collect()] == scan


# Grid


def boxes(n, seed=6):
    random.seed(seed)
    out = []
    for k in range(n):
        x, y = random.choice([random.uniform(-3, 67), float(random.randint(0, 64))]), random.choice([random.uniform(-3, 67), float(random.randint(0, 64))])
        w, h = random.choice([0, 0.5, 8, 8.0000001, 30, 80]), random.choice([0, 0.5, 8, 16, 70])
        out.append((k, x, y, x + w, y + h))
    return [*out, (n, None, 1.0, 2.0, 3.0), (n + 1, float("nan"), 1.0, 2.0, 3.0)]


def test_boxes_across_cell_borders(spark, tmp_path):
    rows = boxes(400)
    made = GridTable(spark, str(tmp_path / "g"))
    made.write(spark.createDataFrame(rows, "id int, a double, b double, c double, d double"), ["a", "b", "c", "d"], "id", (0, 0, 64, 64), 3)
    assert made.read().count() == len(rows)
    for box in [(8, 8, 8, 8), (7.9, 15.9, 8.1, 16.1), (0, 0, 64, 64), (63, 63, 90, 90), (-9, -9, -1, -1), (31, 0, 33, 64), (20.5, 20.5, 20.6, 20.6)]:
        want = {r[0] for r in rows[:-2] if r[1] <= box[2] and r[3] >= box[0] and r[2] <= box[3] and r[4] >= box[1]}
        assert {r.id for r in made.read(box).collect()} == want


def test_box_query_prunes_folders(spark, tmp_path):
    points = spark.range(4096).select("id", (F.col("id") % 64).cast("double").alias("x"), F.floor(F.col("id") / 64).cast("double").alias("y"))
    made = GridTable(spark, str(tmp_path / "g"))
    made.write(points, ["x", "y", "x", "y"], "id", (0, 0, 64, 64), 3)
    near = made.read((1, 1, 6, 6))
    assert near.count() == 36 and "PartitionFilters: [" in plan(near)
    assert metric(near, "numFiles") <= 8 < 64 <= metric(made.read(), "numFiles")


def test_a_very_common_place_goes_to_several_files(spark, tmp_path, many_partitions):
    points = spark.range(0, 40_000, 1, 4).select("id", F.lit(5.0).alias("x"), F.lit(5.0).alias("y"))
    made = GridTable(spark, str(tmp_path / "g"))
    made.write(points, ["x", "y", "x", "y"], "id", (0, 0, 64, 64), 3)
    assert len(made.read().inputFiles()) > 1


def test_z_order(spark):
    rows = spark.createDataFrame([(3, 5), (0, 0), (65535, 65535), (1, 0), (0, 1)], "x int, y int")
    got = [r[0] for r in rows.select(grid.interleaved(F.col("x"), F.col("y"))).collect()]
    assert got == [0b100111, 0, (1 << 32) - 1, 1, 2]


# Medians


@pytest.mark.parametrize("band", [4, 50, 1 << 16])
def test_exact_medians_with_a_key_that_has_most_rows(spark, band):
    random.seed(7)
    rows = [("hot", random.choice([random.uniform(0, 9), 2.0**random.randint(-300, 300), float(random.randint(-5, 5))])) for _ in range(3000)]
    rows += [(f"k{random.randint(0, 40)}", float(random.randint(0, 9))) for _ in range(500)] + [("one", 3.5), (None, 1.0), (None, 2.0), ("hot", None), ("none", None)]
    got = {r.k: (r.m, r.n) for r in medians.exact(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m", band).collect()}
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k, []).append(v)
    assert got == {k: (median(v), len(v)) for k, v in values.items()}


def test_exact_medians_of_ties_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 1.0)] * 99 + [("a", float(k)) for k in range(2, 90)], "k string, v double")
    assert [tuple(r) for r in medians.exact(rows, ["k"], "v", "m", 2).collect()] == [("a", 1.0, 187)]
    assert medians.exact(rows.where("false"), ["k"], "v").count() == 0


def test_medians_equal_the_built_in_ones(spark):
    random.seed(8)
    rows = spark.createDataFrame([(random.randint(0, 3), random.gauss(0, 1)) for _ in range(4000)], "k int, v double")
    want = sorted(tuple(r) for r in rows.groupBy("k").agg(F.median("v"), F.count("v")).collect())
    assert sorted(tuple(r) for r in medians.exact(rows, ["k"], "v", "m", 16).collect()) == want


# Collections of features


def collection(features, gap="", tail="]}"):
    return '{"type":"FeatureCollection",' + gap + '"features":[' + f",{gap}".join(features) + gap + tail


def test_one_collection_is_read_by_many_tasks(spark, tmp_path):
    rows = [f'{{"type":"Feature","properties":{{"code":"{k:05d}","nom":"É \\"x\\" {{}}]"}},"geometry":{{"type":"Point","coordinates":[{k},{k % 7}.5]}}}}' for k in range(4000)]
    (tmp_path / "a.json").write_text(collection(rows))
    path = str(tmp_path / "a.json")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20001")
    try:
        found = readers.features(spark, path, by_line=False)
        assert found.rdd.getNumPartitions() > 10
        got = sorted(map(repr, found.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 4000 and got == sorted(map(repr, readers.whole_collections(spark, path).collect()))


def test_spaced_collections_with_other_members(spark, tmp_path):
    (tmp_path / "a.json").write_text(collection(['{ "type" : "Feature", "properties": {"a": 1}, "geometry": null }', '{"type":"Feature"}'], "\n  ", '], "crs": {"n": {}} }\n'))
    (tmp_path / "b.json").write_text(collection([]))
    (tmp_path / "c.json").write_text("\ufeff" + collection(['{"type":"Feature","geometry":{"type":"Point"},"properties":{"a":"2"}}']))
    got = sorted((r.properties or {}).get("a", "-") for r in readers.collections(spark, str(tmp_path)).collect())
    assert got == ["-", "1", "2"]


@pytest.mark.parametrize("odd", ['{"properties":{"a":"1"},"type":"Feature"}', '{"type":"Feature","properties":{"kind":"Feature"}}', '{"type":"Feature","properties":{"x":{"type":"Feature"}}}'])
def test_collections_that_cannot_be_cut_are_errors(spark, tmp_path, odd):
    (tmp_path / "a.json").write_text(collection([odd, odd]))
    with pytest.raises(Exception):
        readers.collections(spark, str(tmp_path / "a.json")).collect()
    assert readers.whole_collections(spark, str(tmp_path / "a.json")).count() == 2


# Feeds, lookups, chunks


def test_split_evaluates_its_feed_once(spark, tmp_path):
    feed = spark.createDataFrame([("city", 1), ("review", 2), ("review", 3), (None, 4)], "kind string, x int")
    seen = Observation()
    paths = writers.split_by_type(feed.observe(seen, F.count(F.lit(1)).alias("n")), "kind", str(tmp_path / "f"), ["city", "review", "absent"])
    assert seen.get["n"] == 4
    read = lambda k: sorted(r.x for r in readers.json_lines(spark, paths[k], "x int", must_exist=False).collect())
    assert (read("city"), read("review"), read("absent")) == ([1], [2, 3], [])


def test_lookup_skips_row_groups(spark, tmp_path, many_partitions):
    path = str(tmp_path / "s")
    writers.sorted_table(spark.range(0, 20_000).select(F.format_string("%05d", "id").alias("code"), "id"), path, "code")
    assert len(spark.read.parquet(path).inputFiles()) > 1
    one = spark.read.parquet(path).where("code = '00042'")
    assert [r.id for r in one.collect()] == [42] and metric(one, "numOutputRows") < 10_000


def test_chunks_of_a_commune_with_most_reviews(spark):
    rows = [("90101", str(k), k, "a", None, 1) for k in range(50)] + [("90102", None, 50, "b", None, 2)]
    cities = spark.createDataFrame([("90101", "A"), ("90102", "B"), ("90103", "C")], "code_commune string, nom_ville string")
    found = reviews.chunked_records(cities, spark.createDataFrame(rows, REVIEW), 8).collect()
    by = sorted((r for r in found if r.code_commune == "90101"), key=lambda r: r.chunk)
    assert [r.chunk for r in by] == list(range(len(by))) and max(len(r.avis) for r in by) <= 8
    assert [a.review_id for r in by for a in r.avis] == [str(k) for k in range(50)] and {r.nb_avis for r in by} == {50}
    assert [(r.nb_avis, r.chunk, r.avis) for r in found if r.code_commune == "90103"] == [(0, None, None)]


# Review intake


def deliver(spark, rows, seqs, inbox, root, state, keep):
    rows.where(F.col("seq").isin(seqs)).coalesce(1).write.mode("append").json(inbox)
    intake.ingest(spark, inbox, root, state, keep=keep)


@pytest.mark.parametrize(("keep", "want"), [("first", {"1": 1, "2": 3, "4": 7}), ("last", {"1": 6, "2": 3, "4": 8})])
def test_unordered_and_repeated_deliveries(spark, tmp_path, keep, want):
    rows = [("90101", "1", s, f"t{s}", None, 1) for s in (1, 2, 6)] + [("90101", "2", 3, "c", None, 3), ("bad", "3", 4, "c", None, 3)]
    rows += [("90102", None, 5, "x", None, 1), ("90102", None, 9, "x", None, 1), ("90102", "4", 7, "y", None, 1), ("90102", "4", 8, "z", None, 1), ("90102", "5", None, "z", None, 1)]
    df = spark.createDataFrame(rows, REVIEW)
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    for part in ([2, 3, 8], [1, 4, 5, 7], [6, 9], [2, 3, 8]):
        deliver(spark, df, part, inbox, root, state, keep)
    found = intake.stored(spark, root, keep).collect()
    assert {r.review_id: r.seq for r in found if r.review_id} == want
    assert sorted(r.seq for r in found if not r.review_id) == [5, 9]
    assert {r.points_positifs for r in found if r.review_id == "1"} == {f"t{want['1']}"}
    # the delivery that came again decided nothing
    assert intake.touched(spark, root, 3).count() == 0
    with pytest.raises(ValueError):
        intake.stored(spark, root, "other")


def test_a_batch_reads_nothing_of_earlier_ones(spark, tmp_path):
    df = spark.createDataFrame([("90101", "1", 1, "a", None, 1), ("90101", "1", 2, "b", None, 2)], REVIEW)
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    deliver(spark, df, [2], inbox, root, state, "first")
    # the log of the first batch is gone, yet the second one knows what it held
    path, system = BucketTable(spark, root)._system(f"{root}/reviews/batch=0")
    system.delete(path, True)
    deliver(spark, df, [1], inbox, root, state, "first")
    deliver(spark, df, [2], inbox, root, state, "first")
    assert [(r.batch, r.seq) for r in intake.log(spark, root).collect()] == [(1, 1)]


@pytest.mark.parametrize("keep", ["first", "last"])
def test_batches_merge_into_the_table(spark, tmp_path, keep):
    rows = [("90101", "1", s, f"t{s}", None, 1) for s in (2, 1, 3)] + [("90101", None, 4, "x", None, 1)]
    rows += [(f"9{k:04d}", "r", 10 + k, "y", None, 1) for k in range(40)]
    df = spark.createDataFrame(rows, REVIEW)
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    table = intake.table_at(spark, str(tmp_path / "table"), 16)
    for n, part in enumerate([[2, 4, *range(10, 50)], [1, 3], [2, 4]]):
        files = table.files()
        df.where(F.col("seq").isin(part)).coalesce(1).write.mode("append").json(inbox)
        intake.ingest(spark, inbox, root, state, keep=keep, table=table)
        kept = files.items() & table.files().items()
        assert len(kept) >= (0, len(files) - 1, len(files))[n]
    found = {(r.code_commune, r.review_id, r.seq) for r in table.read().collect()}
    assert found == {(r.code_commune, r.review_id, r.seq) for r in intake.stored(spark, root, keep).collect()}
    assert ("90101", "1", 1 if keep == "first" else 3) in found and ("90101", None, 4) in found and len(found) == 42


def test_rows_pass_whole(spark, tmp_path):
    full = spark.createDataFrame([("90101", "1", 1, "é\n\"q\"", None, None)], REVIEW)
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    deliver(spark, full, [1], inbox, root, state, "first")
    (row,) = intake.stored(spark, root).collect()
    assert (row.points_positifs, row.points_negatifs, row.nb_accord, row.notes) == ("é\n\"q\"", None, None, None)
