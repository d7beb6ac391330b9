"""Property sales: normalising the two feeds, one row per sale, price per square metre, anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import codes, dates, numbers

#: Columns that are taken from the first lot of a sale.
_FIRST = ["nombre_pieces_principales"]
_RAW_KEY = ["date_mutation", "valeur_fonciere", "code_commune", "nature_mutation", "type_local"]


def normalise_raw(df: DataFrame) -> DataFrame:
    """The raw feed (all text) with clean names and types; columns that it lacks are ignored."""
    df = df.withColumnsRenamed(schemas.RAW_SALES_NAMES)
    absent = {c: F.lit(None).cast(t) for c, t in (("id_mutation", "string"), ("longitude", "double"), ("latitude", "double"))}
    return df.withColumns(
        {
            "valeur_fonciere": numbers.decimal_comma(F.col("prix_texte")),
            "date_mutation": dates.parse(F.col("jour_texte")),
            "code_commune": F.concat("code_departement", codes.pad(F.col("commune_dans_departement"), 3)),
            "surface_reelle_bati": numbers.decimal_comma(F.col("surface_reelle_bati")),
            "surface_terrain": numbers.decimal_comma(F.col("surface_terrain")),
            "nombre_pieces_principales": numbers.to_int(F.col("nombre_pieces_principales")),
            "source": F.lit("dgfip"),
        }
        | absent
    ).drop("prix_texte", "jour_texte", "commune_dans_departement")


def dwellings_sold(df: DataFrame) -> DataFrame:
    kept = (F.col("nature_mutation") == schemas.SALE) & F.col("type_local").isin(schemas.DWELLINGS)
    return df.where(kept).withColumn("code_commune", codes.pad(F.col("code_commune")))


def _total(column: str) -> Column:
    """Exact at any order of addition."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(column)


def merge_lots_by_id(df: DataFrame, order: Column) -> DataFrame:
    """One row per id_mutation: surfaces added up, the rest from the lot that comes first in ``order``.

    Rows without an id are dropped: they are no sale of their own and no part of another.
    """
    rest = [c for c in schemas.SALES_COLUMNS if c not in ("id_mutation", "surface_reelle_bati", "surface_terrain")]
    merged = df.where(F.col("id_mutation").isNotNull()).groupBy("id_mutation").agg(
        F.min_by(F.struct(*rest), order).alias("first"), _total("surface_reelle_bati"), _total("surface_terrain")
    )
    return merged.select("id_mutation", "first.*", "surface_reelle_bati", "surface_terrain").select(*schemas.SALES_COLUMNS)


def merge_lots_by_key(df: DataFrame, order: Column) -> DataFrame:
    """One row per date, price, municipality, nature and type, for the feed without ids."""
    merged = df.groupBy(*_RAW_KEY).agg(
        F.min_by(F.struct(*_FIRST, "source"), order).alias("first"), _total("surface_reelle_bati"), _total("surface_terrain")
    )
    return merged.select(
        *_RAW_KEY,
        "first.*",
        "surface_reelle_bati",
        "surface_terrain",
        F.lit(None).cast("string").alias("id_mutation"),
        F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("double").alias("latitude"),
    ).select(*schemas.SALES_COLUMNS)


def merge_lots(df: DataFrame, order: Column) -> DataFrame:
    geo = merge_lots_by_id(df.where("source = 'geo'"), order)
    return geo.unionByName(merge_lots_by_key(df.where("source = 'dgfip'"), order))


def with_price_m2(df: DataFrame) -> DataFrame:
    return df.withColumn("prix_m2", numbers.ratio(F.col("valeur_fonciere"), F.col("surface_reelle_bati"), 2))


def plausible() -> Column:
    """Bounds on price, surface and price per square metre, inclusive; a null fails."""
    return (
        (F.col("valeur_fonciere") >= schemas.PRICE_MIN)
        & F.col("surface_reelle_bati").between(schemas.SURFACE_MIN, schemas.SURFACE_MAX)
        & F.col("prix_m2").between(schemas.PRICE_M2_MIN, schemas.PRICE_M2_MAX)
    )
