"""Faults that only showed on other settings or on larger tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cadastra.operators import loads, reviews
from cadastra.plans import adapters, catalog, jobs
from cadastra.sources.grid import GridTable
from cadastra.streaming import reviews as intake

SF = "/root/testdata/sf0.001"


def test_intake_needs_no_setting_of_the_callers_session(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        assert intake._session(spark).conf.get(name) == spark.conf.get(name)
    finally:
        spark.conf.set(name, before)


# Customer keys of more than five digits, cut to five as codes, stand several times: so it is on tables 60 times sf0.1.
SHARED_CODES = {
    "F4": "job_07_commune_geometry", "F5": "job_07_geometry_upsert", "F6": "job_11_risk_points", "F7": "job_15_load_counts", "F8": "job_15_load_with_fk_guard",
    "F9": "prj_07_guarded_ratio", "F10": "qry_02_commune_detail", "F11": "fn_18_similarity", "F12": "jn_01_left_outer", "F13": "jn_05_star", "F14": "jn_07_unpivot_flags",
    "F15": "jn_10_two_resolutions", "F16": "job_06_communes", "F17": "snk_07_upsert", "as F16": "src_13_population", "as F17": "snk_08_partial_upsert",
}


@pytest.fixture(scope="module")
def shared_codes(tmp_path_factory):
    out = tmp_path_factory.mktemp("shared")
    con = duckdb.connect()
    shifts = ["{0}", "{0} + 10000", "{0} + 100000", "{0} * 10 + 100000", "{0} * 10 + 100001"]

    def copies(table: str, **columns: list[str]) -> str:
        replaced = [", ".join(f"CAST({how[k].format(c)} AS BIGINT) AS {c}" for c, how in columns.items()) for k in range(len(shifts))]
        return " UNION ALL ".join(f"SELECT * REPLACE ({r}) FROM '{SF}/{table}.parquet'" for r in replaced)

    apart = [f"{{0}} + {k} * 1000000" for k in range(len(shifts))]
    made = {
        "customer": f"SELECT * FROM ({copies('customer', c_custkey=shifts)}) QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) = 1",
        "orders": copies("orders", o_orderkey=apart, o_custkey=shifts),
        "lineitem": copies("lineitem", l_orderkey=apart),
    }
    for t in adapters.TABLES:
        con.sql(f"COPY ({made.get(t, f'SELECT * FROM {chr(39)}{SF}/{t}.parquet{chr(39)}')}) TO '{out}/{t}.parquet'")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{out}/{t}.parquet'")
    return str(out), con


def _rows(rows, columns: list[str], order: list[str]) -> list[str]:
    places = [columns.index(c) for c in order]
    return sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in places]) for r in rows)


@pytest.mark.parametrize("name", SHARED_CODES.values(), ids=SHARED_CODES)
def test_codes_that_stand_several_times(spark, shared_codes, name):
    folder, con = shared_codes
    df, expected = catalog.queries()[name](spark, folder), con.sql(catalog.oracle_sql()[name])
    assert _rows(df.collect(), df.columns, sorted(df.columns)) == _rows(expected.fetchall(), expected.columns, sorted(df.columns))


def test_search_where_codes_stand_several_times(spark, shared_codes):
    folder, con = shared_codes
    df, expected = catalog.queries()["qry_01_indexed_search"](spark, folder), con.sql(catalog.oracle_sql()["qry_01_indexed_search"])
    # which of one code's rows comes last is open
    columns = ["code_commune", "nom", "score"]
    assert _rows(df.collect(), df.columns, columns) == _rows(expected.fetchall(), expected.columns, columns)


@pytest.mark.parametrize(
    "name, whole",
    [
        ("snk_05_json_lines", "src_09_json_lines"),
        ("ag_01_conditional_counts", "job_01_equipment_stats"),
        ("ag_03_pivot", "job_04_crime_by_category"),
        ("sl_05_truncation", "qry_05_districts_in_bbox"),
        ("so_02_union_points", "job_11_risk_points"),
        ("sp_06_centroids", "jn_07_unpivot_flags"),
    ],
    ids=["F18", "F19", "F20", "F21", "F22", "F23"],
)
def test_operator_queries_do_the_whole_job(name, whole):
    assert catalog.oracle_sql()[name] == catalog.oracle_sql()[whole]


def test_rows_at_one_place_are_parted_by_several_columns(spark, tmp_path):
    rows = spark.range(4000).select(F.lit(None).cast("double").alias("x"), F.lit(1).alias("line"), F.col("id").alias("part"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        grid = GridTable(spark, str(tmp_path / "grid"))
        grid.write(rows, ["x"] * 4, ["line", "part"])
    finally:
        spark.conf.set(name, before)
    per_file = [r["count"] for r in grid.read().groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 4000 and max(per_file) < 3000


def test_words_are_counted_in_a_hash_table(spark):
    rows = [("00001", 2, "zebra lune", "lune"), ("00001", 1, None, "soleil zebra"), ("00001", None, "lune", None)]
    found = reviews.word_counts(spark.createDataFrame(rows, "code_commune string, seq long, points_positifs string, points_negatifs string"))
    assert "SortAggregate" not in found._jdf.queryExecution().toString()
    assert [(r.mot, r.frequence) for r in found.orderBy("position").collect()] == [("lune", 3), ("soleil", 1), ("zebra", 2)]


def test_many_keys_reach_no_broadcast(spark, tmp_path):
    registry = loads.KeyRegistry(spark, str(tmp_path / "r"), ["k"], buckets=2)
    rows = spark.range(150_000).select(F.col("id").cast("string").alias("k"))
    found = registry.assign(rows)
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    assert found.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first()[:] == (150_000, 1, 150_000)
    assert registry.assign(rows.limit(3)).where("id is null").count() == 0 and registry.table.note == 150_000


def test_populations_reach_no_broadcast(spark, tmp_path):
    spark.createDataFrame([("00001", 4.0)], "codgeo string, p23_pop double").write.parquet(str(tmp_path / "p"))
    reference = spark.createDataFrame([("00001", 2.0)], "code_commune string, superficie double")
    found = jobs.communes(reference, spark.read.parquet(str(tmp_path / "p")))
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    assert [(r.population, r.densite) for r in found.collect()] == [(4, 2.0)]


def test_geometry_load_holds_only_existing_rows_and_shapes_of_a_code(spark):
    place = "code_commune string, nom string, code_departement string, code_region string"
    old = [(c, "old", "a", "b", None, "was") for c in ("1", "1", "7", None, "75101")]
    existing = spark.createDataFrame(old, place + ", geom string, geom_simplified string")
    places = spark.createDataFrame([(c, "place", "a", "b") for c in ("1", "1", "1", "2", "3")], place)
    codes = [("i", "1"), ("j", "1"), ("k", "2"), ("l", "75101"), ("m", "75102"), ("n", "9")]
    fine = spark.createDataFrame([(*c, "new", "75", "11", '{"type":"MultiPolygon","coordinates":[]}') for c in codes], "id string, code string, nom string, departement string, region string, geometry string")
    found = jobs.geometry_load(existing, places, fine, fine.where("id in ('i', 'm')").withColumn("geometry", F.replace("geometry", F.lit("[]"), F.lit("[[]]"))))
    assert "FullOuter" not in found._jdf.queryExecution().toString()
    simple = {"was": "was", None: None}
    got = sorted((r.code_commune or "", r.nom, r.geom is not None, simple.get(r.geom_simplified, "coarse")) for r in found.collect())
    # two existing rows by three places by two shapes, one of which has a coarse one
    assert [r for r in got if r[0] == "1"] == [("1", "old", True, "coarse")] * 6 + [("1", "old", True, "was")] * 6
    assert [r for r in got if r[0] != "1"] == [("", "old", False, "was"), ("2", "place", True, None), ("7", "old", False, "was"), ("75101", "old", True, "was"), ("75102", "new", True, "coarse")]
