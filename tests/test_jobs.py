"""Jobs and operators on small hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.operators import keys, quality, reviews, sales
from cadastra.plans import jobs, serving
from cadastra.sources import readers
from cadastra.streaming import reviews as intake

REVIEW = "code_commune string, review_id string, seq long, points_positifs string, points_negatifs string, nb_accord int"

MARKS = ["6,10", "5,25", "4,40", "9,15", "3,30", "2,75", "1,05", "7,60", "8,90"]


def city_page(pages, marks=MARKS):
    """A made-up town's page: rank, overall score, nine criteria and one opinion."""
    cells = "".join(f"<tr><th>{k}</th><td>{m}</td></tr>" for k, m in enumerate(marks))
    votes = "".join(f"<td>{n}</td>" for n in (1, 2, 3, 4, 5, 6, 7, 8, 10))
    return f"""<html><body><p id="classt"><strong>Lutry</strong> est <a>classée <b>4ème / 52</b></a> sur <b>1 204 villes notées</b>.</p>
    <p id="ng">5,35<span> / 10</span></p><table id="tablonotes">{cells}</table><h4>Page : 1 / {pages}</h4>
    <div class="comm"><p><span>Avis posté le 09-11-2031 à 07:05</span><br/>Par <strong>lecteur-3</strong></p>
    <strong class="moyenne">5.11</strong><table><tr><th>n</th></tr><tr>{votes}</tr></table>
    <p><b>Les points positifs : </b>Un lac.<br/>Des vignes.</p><p><b>Les points négatifs : </b>Le train.</p>
    <div class="interact" id="88"><p><strong>12</strong><strong>3</strong></p></div></div></body></html>"""


def test_review_page(spark):
    pages = spark.createDataFrame([("/lutry_90101", city_page(1)), ("/y_90102", city_page(4))], "url string, html string")
    one, many = reviews.parse_pages(pages).orderBy("code_commune").collect()
    assert one.note_globale == 5.35 and list(one.notes) == [float(m.replace(",", ".")) for m in MARKS]
    assert (one.rang, one.nb_villes_classees, one.avis_complets, one.nb_avis) == ("4/52", 1204, True, 1)
    assert (many.nb_pages_avis, many.avis_complets) == (4, False)
    review = one.avis[0]
    assert (review.review_id, review.pseudonyme, review.date_avis, review.note_moyenne) == ("88", "lecteur-3", "2031-11-09T07:05", 5.11)
    assert list(review.notes) == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert (review.points_positifs, review.points_negatifs) == ("Un lac.\nDes vignes.", "Le train.")
    assert (review.nb_accord, review.nb_pas_accord) == (12, 3)


def test_unrated_page_is_no_row(spark):
    html = '<html><body><p id="ng"><span>/ 10</span></p><table id="tablonotes"><tr><th>E</th><td>-</td></tr></table></body></html>'
    assert reviews.parse_pages(spark.createDataFrame([("/x_90101", html)], "url string, html string")).count() == 0


def test_duplicate_and_nameless_reviews(spark):
    rows = spark.createDataFrame([("90101", "1", 1, "a", None, 1), ("90101", "1", 2, "b", None, 2), ("90101", "2", 3, "c", None, 3), ("90101", None, 4, "d", None, 4), ("90101", None, 5, "d", None, 4)], REVIEW)
    kept = {r.seq for r in reviews.first_seen(rows).collect()}
    assert kept == {1, 3, 4, 5}


def test_records(spark):
    cities = spark.createDataFrame([("90101", "Lutry"), ("90102", "Vide"), ("90101", "Lutry")], "code_commune string, nom_ville string")
    rows = spark.createDataFrame([("90101", "1", 1, "a", None, 1), ("90999", "9", 2, "b", None, 2)], REVIEW)
    found = sorted((r.code_commune, r.nb_avis, len(r.avis)) for r in reviews.records(cities, rows).collect())
    assert found == [("90101", 1, 1), ("90101", 1, 1), ("90102", 0, 0)]
    assert "code_commune" not in reviews.records(cities, rows).schema["avis"].dataType.elementType.names


def test_word_cloud_order_and_ties(spark):
    rows = spark.createDataFrame([("1", "1", 1, "vergers fleuris", None, 1), ("1", "2", 2, "vergers anciens", "pentes raides", 1)], REVIEW)
    cloud = reviews.word_cloud(rows).first().word_cloud
    assert [(e.mot, e.frequence) for e in cloud] == [("vergers", 2), ("fleuris", 1), ("anciens", 1), ("pentes", 1), ("raides", 1)]


def test_known_and_unknown_keys(spark):
    df = spark.createDataFrame([("90101",), ("99999",)], "code_commune string")
    ref = spark.createDataFrame([("90101",)], "code_commune string")
    assert [r[0] for r in keys.known(df, ref).collect()] == ["90101"]
    assert [r[0] for r in keys.unknown_keys(df, ref).collect()] == ["99999"]
    assert keys.guard_counts(df.limit(0), ref).first().pct_rejected is None


def _sale(**kw):
    base = dict(id_mutation="m", date_mutation="2024-01-02", nature_mutation="Vente", valeur_fonciere=100000.0, code_commune="1004", type_local="Maison", surface_reelle_bati=50.0, nombre_pieces_principales=3, surface_terrain=None, longitude=1.0, latitude=2.0, source="geo", n=1)
    return tuple((base | kw).values())


_SALE = "id_mutation string, date_mutation string, nature_mutation string, valeur_fonciere double, code_commune string, type_local string, surface_reelle_bati double, nombre_pieces_principales int, surface_terrain double, longitude double, latitude double, source string, n int"


def _sales(spark, *rows):
    return spark.createDataFrame(list(rows), _SALE).withColumn("date_mutation", F.to_date("date_mutation"))


def test_lots_merge_and_bounds(spark):
    raw = _sales(
        spark,
        _sale(n=2, type_local="Appartement", surface_reelle_bati=30.0), _sale(n=1),
        _sale(id_mutation=None), _sale(id_mutation="dep", type_local="Dépendance"),
        _sale(id_mutation="zero", surface_reelle_bati=0.0), _sale(id_mutation="small", surface_reelle_bati=4.99),
        _sale(id_mutation="five", surface_reelle_bati=5.0), _sale(id_mutation="low", valeur_fonciere=5000.0, surface_reelle_bati=50.0),
        _sale(id_mutation=None, source="dgfip"), _sale(id_mutation=None, source="dgfip", surface_reelle_bati=10.0, n=2),
    )
    rows = {r.id_mutation: r for r in jobs.clean_sales(raw, F.col("n")).collect()}
    assert set(rows) == {"m", "five", "low", None}
    assert (rows["m"].type_local, rows["m"].surface_reelle_bati, rows["m"].prix_m2, rows["m"].code_commune) == ("Maison", 80.0, 1250.0, "01004")
    assert rows["low"].prix_m2 == 100.0
    assert rows[None].surface_reelle_bati == 60.0


def test_change_is_null_across_a_gap(spark):
    raw = _sales(spark, *[_sale(id_mutation=str(y), date_mutation=f"{y}-02-01", valeur_fonciere=v) for y, v in ((2020, 100000.0), (2021, 110000.0), (2023, 120000.0))])
    ref = spark.createDataFrame([("01004",)], "code_commune string")
    got = {r.annee: r.variation_annuelle_pct for r in jobs.price_trends(jobs.clean_sales(raw, F.col("n")), ref).collect()}
    assert got == {2020: None, 2021: 10.0, 2023: None}


def test_weighted_mean_with_null_rate(spark):
    rows = spark.createDataFrame([("90101", "2023", "10", "80,0"), ("90101", "2023", "10", None), ("90102", "2023", "0", "50,0")], "code_commune string, annee string, presents string, taux string")
    got = {r.code_commune: r.bac_taux_reussite for r in jobs.exam_results(rows).collect()}
    assert got == {"90101": 40.0, "90102": None}


def test_air_labels(spark):
    rows = spark.createDataFrame([("90101", x, "1") for x in ("Dégradé", "DEGRADE", "inconnu", None)], "code_commune string, lib_qualif string, indice_atmo string")
    got = jobs.air_quality(rows, 2024).first()
    assert (got.nb_jours_degrade, got.nb_jours_bon, got.indice_atmo) == (2, 0, 1.0)


def test_risk_codes(spark):
    rows = spark.createDataFrame([("1", "11"), ("1", "21"), ("1", "99"), ("2", None)], "code_commune string, num_risque string")
    got = {r.code_commune: r for r in jobs.risk_flags(rows).collect()}
    assert (got["1"].inondation, got["1"].icpe, got["1"].radon, got["2"].inondation) == (True, True, False, False)


def test_arguments(spark):
    df = spark.createDataFrame([], "code_commune string, nom string, code_postal string, code_departement string, code_region string, population int")
    with pytest.raises(ValueError):
        serving.search(df, df, df, "")
    with pytest.raises(ValueError):
        serving.checked(0, 100)
    with pytest.raises(ValueError):
        serving.communes_by_risk(df, unknown=True)
    with pytest.raises(ValueError):
        readers.union_available([None])
    with pytest.raises(ValueError):
        quality.require(df, ["absent"])
    with pytest.raises(ValueError):
        quality.require_inputs(spark, ["/nowhere/a.parquet"])


def test_search_puts_null_population_last(spark):
    rows = [("1", "Saint", "0", None, None, None), ("2", "Saint", "0", None, None, 5)]
    df = spark.createDataFrame(rows, "code_commune string, nom string, code_postal string, code_departement string, code_region string, population int")
    d = spark.createDataFrame([], "code_departement string, nom string")
    r = spark.createDataFrame([], "code_region string, nom string")
    assert [x.code_commune for x in serving.search(df, d, r, "saint").collect()] == ["2", "1"]


def test_search_order_survives_shuffled_joins(spark):
    rows = [(str(k), "Bourg" + "xyza"[: k % 5], "0", f"d{k % 3}", f"r{k % 2}", k) for k in range(40)]
    df = spark.createDataFrame(rows, "code_commune string, nom string, code_postal string, code_departement string, code_region string, population int")
    d = spark.createDataFrame([(f"d{k}", "x") for k in range(3)], "code_departement string, nom string")
    r = spark.createDataFrame([(f"r{k}", "x") for k in range(2)], "code_region string, nom string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [int(x.code_commune) for x in serving.search(df, d, r, "bourg", 40).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(range(40), key=lambda k: (k % 5, -k))


def test_repeated_reference_keys_count_once(spark):
    df = spark.createDataFrame([("90101",), ("90999",)], "code_commune string")
    ref = spark.createDataFrame([("90101",), ("90101",)], "code_commune string")
    counts = keys.guard_counts(df, ref).first()
    assert (counts.n_rows, counts.n_kept, counts.n_rejected) == (2, 1, 1)
    assert tuple(keys.load_counts(df, ref, ref.limit(0), ["code_commune"]).first()) == (2, 1, 0, 1)
    assert tuple(keys.load_counts(df, ref, ref, ["code_commune"]).first()) == (2, 0, 1, 1)


def test_pages_of_a_city(spark):
    rows = [("a", 1, 5, 2), ("a", 3, 5, 2), ("b", 1, 5, 2), ("b", 1, 5, 2), ("b", 2, 4, 2), ("c", 1, 3, 1)]
    pages = spark.createDataFrame(rows, "code_commune string, page int, nb_avis int, nb_pages_avis int")
    got = {r.code_commune: (r.nb_avis, r.avis_complets) for r in reviews.roll_up_pages(pages).collect()}
    assert got == {"a": (10, False), "b": (9, True), "c": (3, True)}


def test_category_counts_add_up(spark):
    rows = spark.createDataFrame([("75001", "A101"), ("1004", "C201"), ("75001", "G101"), (" ", "A101"), (None, "A104"), ("75001", None)], "code_commune string, typequ string")
    for r in jobs.equipment_stats(rows).collect():
        assert sum(r[f"nb_{c.lower()}"] for c in schemas.EQUIPMENT_CATEGORIES) == r.nb_equipements_total == 1


def test_intake_equals_batch_and_is_repeatable(spark, tmp_path):
    rows = spark.createDataFrame([("90101", "1", 1, "a", None, 1), ("90101", "1", 2, "b", None, 2), ("90101", "2", 3, "c", None, 3), ("bad", "3", 4, "c", None, 3)], REVIEW)
    inbox, root, state = (str(tmp_path / x) for x in ("inbox", "root", "state"))
    for lo, hi in ((0, 2), (2, 5)):
        rows.where(F.col("seq").between(lo + 1, hi)).coalesce(1).write.mode("append").json(inbox)
        intake.ingest(spark, inbox, root, state)
    intake.ingest(spark, inbox, root, state)
    got = sorted((r.code_commune, r.review_id) for r in intake.stored(spark, root).collect())
    assert got == [("90101", "1"), ("90101", "2")]
    assert [r[0] for r in intake.touched(spark, root, 1).collect()] == ["90101"]


def test_repeated_numbering_is_stable(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = keys.numbered(df, ["k"]).orderBy("k").collect()
    assert [r.id for r in got] == list(range(1, 1001))
    assert sales.plausible() is not None
