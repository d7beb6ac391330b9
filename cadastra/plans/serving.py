"""The read queries. Codes may be one code, a list, a DataFrame or None for all."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import dates, numbers, spatial, text
from cadastra.operators import keys, reviews
from cadastra.operators.search import TrigramIndex
from cadastra.sources import writers
from cadastra.sources.grid import GridTable

Codes = str | list[str] | DataFrame | None


def of(df: DataFrame, codes: Codes, key: str = "code_commune") -> DataFrame:
    """Rows of the wanted municipalities; unknown codes give no row."""
    if codes is None:
        return df
    if isinstance(codes, DataFrame):
        return df.join(codes.select(key), key, "left_semi")
    return df.where(F.col(key).isin([codes] if isinstance(codes, str) else codes))


def checked(limit: int, most: int, least: int = 1) -> int:
    if not least <= limit <= most:
        raise ValueError(f"limit must be between {least} and {most}")
    return limit


def _star(communes: DataFrame, departements: DataFrame, regions: DataFrame) -> DataFrame:
    d = departements.select("code_departement", F.col("nom").alias("nom_departement"))
    r = regions.select("code_region", F.col("nom").alias("nom_region"))
    return communes.join(d, "code_departement", "left").join(r, "code_region", "left")


def search(
    communes: DataFrame, departements: DataFrame, regions: DataFrame, query: str, limit: int = 10, index: TrigramIndex | None = None
) -> DataFrame:
    """Municipalities whose name contains the text, most similar first, then by population (nulls last).

    With an ``index`` of the names, by a column that tells them apart, only the postings of the query's
    trigrams are read, and names are looked at where all sure trigrams are found; a query of very short
    words has none and looks at every name.
    """
    if not query:
        raise ValueError("the query is empty")
    checked(limit, 100)
    near = index.candidates(query) if index else None
    if near is None:
        scored = communes.withColumn("score", text.similarity(F.col("nom"), F.lit(query)))
    else:
        scored = communes.join(near, index.key)
    hits = scored.where(text.contains_ignoring_case(F.col("nom"), query))
    relevance = [F.col("score").desc(), F.col("population").desc_nulls_last(), F.col("code_commune")]
    # the joins may shuffle, so the few rows are put in order again behind them
    found = _star(hits.orderBy(*relevance).limit(limit), departements, regions).orderBy(*relevance)
    return found.select("code_commune", "nom", "code_postal", "nom_departement", "nom_region", "score")


def detail(communes: DataFrame, departements: DataFrame, regions: DataFrame, codes: Codes) -> DataFrame:
    return _star(of(communes, codes), departements, regions)


def list_regions(regions: DataFrame) -> DataFrame:
    return regions.select("code_region", "nom").orderBy("nom", "code_region")


def list_departements(departements: DataFrame, region: str | None = None) -> DataFrame:
    rows = departements if region is None else departements.where(F.col("code_region") == region)
    return rows.select("code_departement", "nom", "code_region").orderBy("nom", "code_departement")


def districts_in_bbox(districts: DataFrame | GridTable, bbox: str, limit: int = 1000) -> DataFrame:
    """Districts whose envelope meets the box; from a grid table only the cells near it are read."""
    box = spatial.parse_bbox(bbox)
    rows = districts.read(box) if isinstance(districts, GridTable) else districts.where(spatial.intersects(F.col("box"), box))
    return writers.feature_collection(rows, ["code_iris", "code_commune", "nom_iris", "type_iris"], checked(limit, 5000), "code_iris")


def districts_of(districts: DataFrame, codes: Codes) -> DataFrame:
    return of(districts, codes).select("code_iris", "code_commune", "nom_iris", "type_iris", "geometry").orderBy("code_iris")


def price_points(sales: DataFrame | GridTable, bbox: str, year: int | None = None, kind: str | None = None, limit: int | None = None) -> DataFrame:
    """Mean price per square metre and number of sales by coordinates; the year prunes partitions."""
    box = spatial.parse_bbox(bbox)
    conditions = [spatial.in_bbox(F.col("longitude"), F.col("latitude"), box), F.col("prix_m2") > 0]
    if year is not None:
        conditions.append(F.col("annee") == year)
    if kind is not None:
        conditions.append(F.col("type_local") == kind)
    mean = F.avg(F.col("prix_m2").cast("decimal(18,2)"))
    rows = sales.read(box) if isinstance(sales, GridTable) else sales
    points = rows.where(keys.all_of(conditions)).groupBy("latitude", "longitude").agg(
        numbers.rounded(mean, 0).alias("prix_m2_moyen"), F.count("*").alias("nb_transactions")
    )
    return points if limit is None else points.orderBy("latitude", "longitude").limit(checked(limit, 50_000))


def review_summary(records: DataFrame, codes: Codes, as_of: date) -> DataFrame:
    """Served summary and whether it is at most 30 days old."""
    fresh = dates.is_fresh(F.col("date_scraping"), F.lit(as_of))
    return reviews.summary(of(records, codes).withColumn("a_jour", fresh), ["rang", "a_jour"])


def risk_points(points: DataFrame, bbox: str | None = None, kind: str | None = None, codes: Codes = None, limit: int = 1000) -> DataFrame:
    conditions = []
    if bbox is not None:
        conditions.append(spatial.in_bbox(F.col("longitude"), F.col("latitude"), spatial.parse_bbox(bbox)))
    if kind is not None:
        conditions.append(F.col("type_risque") == kind)
    rows = of(points.where(keys.all_of(conditions)), codes)
    return rows.orderBy("code_commune", "type_risque", "longitude", "latitude").limit(checked(limit, 50_000))


def risk_flags(flags: DataFrame, codes: Codes) -> DataFrame:
    return of(flags, codes)


def communes_by_risk(flags: DataFrame, limit: int = 100, **wanted: bool | None) -> DataFrame:
    """Municipalities with the given flags; flags that are None don't filter."""
    if unknown := set(wanted) - set(schemas.RISK_FLAGS):
        raise ValueError(f"no such risk: {', '.join(sorted(unknown))}")
    conditions = [F.col(k) == v for k, v in wanted.items() if v is not None]
    return flags.where(keys.all_of(conditions)).orderBy("code_commune").limit(checked(limit, 1000))


def history(df: DataFrame, codes: Codes, columns: list[str]) -> DataFrame:
    """(code_commune, historique): the yearly rows of each municipality as an array in order of years."""
    entry = F.struct("annee", *columns)
    return of(df, codes).groupBy("code_commune").agg(F.array_sort(F.collect_list(entry)).alias("historique"))


def crime_history(wide: DataFrame, codes: Codes) -> DataFrame:
    return history(wide, codes, [f"{c}_{k}" for c in schemas.CRIME_CATEGORIES for k in ("nombre", "pour_mille")])


def exam_history(exams: DataFrame, codes: Codes) -> DataFrame:
    return history(exams, codes, ["bac_presents", "bac_taux_reussite"])


def air_quality(air: DataFrame, codes: Codes) -> DataFrame:
    return of(air, codes)


def equipment(stats: DataFrame, codes: Codes) -> DataFrame:
    """Total and the eleven key types; the six category counts are not served."""
    return of(stats, codes).select("code_commune", "nb_equipements_total", *schemas.KEY_EQUIPMENT)
