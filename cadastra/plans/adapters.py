"""Views that give the test tables the roles of the engine's inputs.

Each view is one SQL text that Spark and the checking database both understand. Edge cases (blank
codes, absent keys, decimal commas, unknown labels) are made from key arithmetic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents labels pages".split()

VIEWS: dict[str, str] = {
    "v_region": "SELECT lpad(CAST(r_regionkey AS STRING), 2, '0') AS code_region, r_name AS nom FROM region",
    "v_dept": (
        "SELECT lpad(CAST(n_nationkey AS STRING), 2, '0') AS code_departement, n_name AS nom, "
        "lpad(CAST(n_regionkey AS STRING), 2, '0') AS code_region FROM nation"
    ),
    "v_reference": """
        SELECT lpad(CAST(c_custkey AS STRING), 5, '0') AS code_insee, c_name AS nom_standard,
               CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 2, '0') END AS dep_code,
               lpad(CAST(n_regionkey AS STRING), 2, '0') AS reg_code,
               lpad(CAST(1000 + c_custkey % 95000 AS STRING), 5, '0') AS code_postal,
               CAST(CAST(c_custkey % 97 AS DOUBLE) / 2 AS STRING) AS superficie_km2,
               CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(41 + CAST(c_custkey % 1000 AS DOUBLE) / 128 AS STRING) END AS latitude_centre,
               CAST(-5 + CAST(c_custkey % 1500 AS DOUBLE) / 128 AS STRING) AS longitude_centre
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_population": """
        SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS codgeo,
               CASE WHEN c_custkey % 13 = 0 THEN 'n/a' ELSE CAST(CAST(floor(abs(c_acctbal) * 10) AS BIGINT) AS STRING) END AS p23_pop
        FROM customer""",
    "v_communes": """
        SELECT r.code_insee AS code_commune, nom_standard AS nom, dep_code AS code_departement, reg_code AS code_region, code_postal,
               CAST(superficie_km2 AS DOUBLE) AS superficie, CAST(latitude_centre AS DOUBLE) AS latitude,
               CAST(longitude_centre AS DOUBLE) AS longitude,
               CASE WHEN p23_pop <> 'n/a' THEN CAST(p23_pop AS INT) END AS population,
               CASE WHEN CAST(superficie_km2 AS DOUBLE) > 0 AND p23_pop <> 'n/a' THEN
                 CAST(round(CAST(CAST(p23_pop AS DOUBLE) / CAST(superficie_km2 AS DOUBLE) AS DECIMAL(38,10)), 2) AS DOUBLE) END AS densite
        FROM v_reference r LEFT JOIN v_population p ON r.code_insee = lpad(p.codgeo, 5, '0')""",
    "v_tx": """
        SELECT CASE WHEN l_orderkey % 4 = 0 OR l_orderkey % 101 = 1 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS id_mutation,
               CAST(o_orderdate AS DATE) AS date_mutation,
               CASE WHEN l_linestatus = 'F' THEN 'Vente' ELSE 'Adjudication' END AS nature_mutation,
               o_totalprice AS valeur_fonciere,
               CASE WHEN o_custkey % 37 = 5 THEN 'Z' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0')
                    ELSE CAST(o_custkey AS STRING) END AS code_commune,
               CASE l_returnflag WHEN 'R' THEN 'Maison' WHEN 'A' THEN 'Appartement' ELSE 'Dépendance' END AS type_local,
               l_quantity AS surface_reelle_bati,
               CAST(l_linenumber AS INT) AS nombre_pieces_principales,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity * 2 END AS surface_terrain,
               CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE -5 + CAST(o_custkey % 1500 AS DOUBLE) / 128 END AS longitude,
               CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 41 + CAST(o_custkey % 1000 AS DOUBLE) / 128 END AS latitude,
               CASE WHEN l_orderkey % 4 = 0 THEN 'dgfip' ELSE 'geo' END AS source,
               l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_equip": """
        SELECT CASE WHEN l_partkey % 29 = 0 THEN '  ' WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS code_commune,
               CASE WHEN l_partkey % 3 = 0 THEN CASE l_suppkey % 11 WHEN 0 THEN 'A101' WHEN 1 THEN 'A104' WHEN 2 THEN 'A111' WHEN 3 THEN 'A203'
                      WHEN 4 THEN 'A206' WHEN 5 THEN 'D201' WHEN 6 THEN 'D232' WHEN 7 THEN 'D101' WHEN 8 THEN 'C201' WHEN 9 THEN 'C101' ELSE 'E102' END
                    WHEN l_partkey % 17 = 0 THEN NULL
                    ELSE substr('ABCDEFG', CAST(1 + p_size % 7 AS INT), 1) || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') END AS typequ
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_crime": """
        SELECT CASE WHEN o_custkey % 43 = 0 THEN CAST(o_custkey AS STRING) ELSE lpad(CAST(o_custkey AS STRING), 5, '0') END AS code_commune,
               CAST(year(o_orderdate) AS INT) AS annee,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Cambriolages de logement' WHEN '2' THEN 'Violences sexuelles'
                 WHEN '3' THEN 'Vols sans violence contre des personnes' WHEN '4' THEN CASE WHEN l_linenumber % 2 = 0
                 THEN 'Usage de stupéfiants' ELSE 'Usage de stupéfiants (AFD)' END
                 ELSE CASE WHEN l_linenumber = 3 THEN 'Autre' ELSE 'Destructions et dégradations volontaires' END END AS indicateur,
               CAST(l_quantity AS INT) AS nombre, l_tax * 100 AS taux_pour_mille,
               CASE WHEN o_orderstatus = 'P' THEN 'ndiff' ELSE 'diff' END AS est_diffuse
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_bac": """
        SELECT CASE WHEN l_suppkey % 9 = 4 THEN CAST(l_suppkey AS STRING) ELSE lpad(CAST(l_suppkey AS STRING), 5, '0') END AS code_commune,
               CAST(year(l_shipdate) AS STRING) AS annee,
               CASE WHEN l_linenumber = 7 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS presents,
               CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(100 - CAST(round(l_discount * 100) AS INT) AS STRING) || ',' || CAST(l_linenumber AS STRING) END AS taux
        FROM lineitem""",
    "v_air": """
        SELECT CASE WHEN user_id % 17 = 3 THEN CAST(user_id AS STRING) ELSE ' ' || lpad(CAST(user_id AS STRING), 5, '0') END AS code_commune,
               CASE event_id % 9 WHEN 0 THEN 'Bon' WHEN 1 THEN ' moyen ' WHEN 2 THEN 'Dégradé' WHEN 3 THEN 'DEGRADE' WHEN 4 THEN 'Mauvais'
                 WHEN 5 THEN 'très mauvais' WHEN 6 THEN 'Extremement mauvais' WHEN 7 THEN 'inconnu' END AS lib_qualif,
               CASE WHEN event_id % 23 = 0 THEN 'x' ELSE CAST(CAST(floor(value * 100) AS BIGINT) % 10 AS STRING) || '.5' END AS indice_atmo
        FROM events""",
    "v_risk": """
        SELECT lpad(CAST(o_custkey AS STRING), 5, '0') AS code_commune,
               CASE WHEN p_size % 10 = 0 THEN '2' || CAST(l_linenumber AS STRING) WHEN p_size % 13 = 1 THEN NULL
                    ELSE CAST(11 + l_partkey % 7 AS STRING) END AS num_risque,
               CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE -5 + CAST(l_partkey % 1500 AS DOUBLE) / 128 END AS longitude,
               41 + CAST(l_suppkey % 1000 AS DOUBLE) / 128 AS latitude
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_city": """
        SELECT CASE WHEN source = 'src7' THEN '99999' ELSE lpad(substr(source, 4, 5), 5, '0') END AS code_commune, source AS nom_ville,
               CASE WHEN source = 'src3' THEN NULL ELSE CAST(min(n_chars) % 100 AS DOUBLE) / 10 END AS note_globale,
               CAST(min(doc_id) + 1 AS STRING) || '/187' AS rang, true AS avis_complets,
               CASE WHEN source = 'src5' THEN NULL ELSE date_add(CAST('2026-03-01' AS DATE), CAST(min(doc_id) % 40 AS INT)) END AS date_scraping
        FROM documents GROUP BY source""",
    "v_review": """
        SELECT lpad(substr(source, 4, 5), 5, '0') AS code_commune, source AS nom_ville,
               CASE WHEN doc_id % 10 = 9 THEN NULL ELSE CAST(doc_id - doc_id % 60 AS STRING) END AS review_id,
               'auteur' || CAST(doc_id % 50 AS STRING) AS pseudonyme, '2029-07-14T18:05' AS date_avis,
               CAST(n_chars % 100 AS DOUBLE) / 10 AS note_moyenne,
               CASE WHEN doc_id % 4 = 0 THEN text ELSE substr(text, 1, CAST(floor(length(text) / 2) AS INT)) END AS points_positifs,
               CASE WHEN doc_id % 4 = 0 THEN NULL ELSE substr(text, CAST(floor(length(text) / 2) AS INT) + 1) END AS points_negatifs,
               CAST(doc_id % 70 AS INT) AS nb_accord, CAST(doc_id % 30 AS INT) AS nb_pas_accord, doc_id AS seq
        FROM documents""",
    "v_page": """
        SELECT 'http://x.example/ville_' || lpad(CAST(doc_id % 100000 AS STRING), 5, '0') AS url, doc_id,
               '<html><body><p id="classt"><strong>V</strong> est <a>classée <b>' || CAST(doc_id % 187 AS STRING) ||
               'ème / 187</b></a> sur <b>1 930 villes</b>.</p><p id="ng">' ||
               CASE WHEN doc_id % 5 = 0 THEN '' ELSE CAST(n_chars % 10 AS STRING) || ',' || CAST(doc_id % 10 AS STRING) END ||
               '<span> / 10</span></p><table id="tablonotes"><tr><th>E</th><td>' ||
               CASE WHEN doc_id % 10 = 0 THEN '-' ELSE '5,1' || CAST(doc_id % 10 AS STRING) END ||
               '</td></tr><tr><th>T</th><td>' || CASE WHEN doc_id % 10 = 0 THEN '-' ELSE '3,94' END || '</td></tr></table><h4>Page : 1 / ' || CAST(1 + doc_id % 4 AS STRING) || '</h4>' ||
               '<div class="comm"><p><span>Avis posté le 14-07-2029 à 18:05</span><br/>Par <strong>A</strong></p>' ||
               '<strong class="moyenne">6.13</strong><table><tr><td>9</td></tr></table></div></body></html>' AS html
        FROM documents""",
    "v_iris": """
        SELECT lpad(CAST(c_custkey AS STRING), 9, '0') AS code_iris,
               CASE WHEN c_custkey % 19 = 0 THEN 'X0000' ELSE lpad(CAST(c_custkey AS STRING), 5, '0') END AS code_insee,
               CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS nom_iris, substr('HADZ', CAST(1 + c_custkey % 4 AS INT), 1) AS type_iris,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS kind,
               CAST(c_custkey % 50 AS INT) AS x, CAST(c_custkey % 40 AS INT) AS y
        FROM customer""",
    "v_features": """
        SELECT code_iris, code_insee, nom_iris, type_iris, x, y, kind,
               '[[' || CAST(x AS STRING) || ',' || CAST(y AS STRING) || '],[' || CAST(x + 1 AS STRING) || ',' || CAST(y AS STRING) || '],['
               || CAST(x + 1 AS STRING) || ',' || CAST(y + 1 AS STRING) || '],[' || CAST(x AS STRING) || ',' || CAST(y AS STRING) || ']]' AS ring
        FROM v_iris""",
}


def needs(name: str) -> list[str]:
    """The names of tables and views that a text mentions, views in an order that defines them first."""
    text = VIEWS.get(name, name)
    found: list[str] = []
    for word in re.findall(r"\bv_\w+", text):
        if word in VIEWS and word != name:
            for n in [*needs(word), word]:
                if n not in found:
                    found.append(n)
    return found


def with_views(sql: str) -> str:
    """The query with the definitions of the views that it uses in front."""
    names = needs(sql)
    own = sql.strip()
    definitions = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    if not names:
        return own
    return f"WITH {definitions}, {own[5:]}" if own[:5].upper() == "WITH " else f"WITH {definitions} {own}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables in ``sf_dir``, as a DataFrame; nothing is registered in the session."""
    text = with_views(VIEWS[name])
    for t in TABLES:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)
