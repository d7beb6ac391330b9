"""Resident reviews: de-duplication, nesting, word clouds and page parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import codes, dates, numbers, text
from cadastra.operators import keys


def first_seen(reviews: DataFrame) -> DataFrame:
    """The first review (by seq) of each (code_commune, review_id); reviews without an id all stay.

    An aggregate rather than a window, so a municipality with very many reviews is combined on the way.
    """
    columns = reviews.columns
    # reviews without an id get a group of their own
    own = F.when(F.col("review_id").isNull(), F.col("seq"))
    return (
        reviews.groupBy("code_commune", "review_id", own.alias("_own"))
        .agg(F.min_by(F.struct(*columns), "seq").alias("r"))
        .select("r.*")
    )


def nested(reviews: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(code_commune, avis): a municipality's reviews as an array in input order, without their code.

    The array is one row of the result. ``fields`` names those it shall hold (all of a review's by
    default): leave texts out, or keep only the municipalities to be served, where one can have
    very many reviews.
    """
    fields = [c for c in fields or schemas.REVIEW_FIELDS if c in reviews.columns]
    ordered = F.array_sort(F.collect_list(F.struct("seq", F.struct(*fields).alias("avis"))))
    return reviews.groupBy("code_commune").agg(F.transform(ordered, lambda x: x["avis"]).alias("avis"))


def chunked(reviews: DataFrame, size: int = 1000) -> DataFrame:
    """(code_commune, chunk, avis): a municipality's reviews in input order, in arrays of at most ``size``, numbered from 0.

    Chunks are cut from the place of a review among all reviews by (code_commune, seq), found by a range
    partitioning, so that a municipality with most of the reviews is never gathered. Its first chunk may
    be shorter than the others.
    """
    fields = [c for c in schemas.REVIEW_FIELDS if c in reviews.columns]
    placed = keys.numbered(reviews.select("code_commune", "seq", F.struct(*fields).alias("avis")), ["code_commune", "seq"], "_nth")
    dealt = placed.withColumn("_block", F.floor((F.col("_nth") - 1) / size))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "avis")))
    blocks = dealt.groupBy("code_commune", "_block").agg(F.transform(ordered, lambda x: x["avis"]).alias("avis"))
    first = dealt.groupBy("code_commune").agg(F.min("_block").alias("_first"))
    return blocks.join(first, "code_commune").select("code_commune", (F.col("_block") - F.col("_first")).cast("int").alias("chunk"), "avis")


def chunked_records(cities: DataFrame, reviews: DataFrame, size: int = 1000) -> DataFrame:
    """Each city with its number of reviews, a row per chunk of them; a city without any has one row without a chunk."""
    seen = first_seen(reviews)
    return counted(cities, seen).join(chunked(seen, size), "code_commune", "left")


def counted(cities: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each city with its number of reviews (nb_avis); the reviews stay rows of their own table."""
    numbers_ = first_seen(reviews.select("code_commune", "review_id", "seq")).groupBy("code_commune").agg(F.count("*").cast("int").alias("nb_avis"))
    return cities.join(numbers_, "code_commune", "left").withColumn("nb_avis", F.coalesce("nb_avis", F.lit(0)))


def records(cities: DataFrame, reviews: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Each city with its reviews (an empty array for none; ``fields`` as for ``nested``) and their number."""
    joined = cities.join(nested(first_seen(reviews), fields), "code_commune", "left")
    fields = [f.name for f in joined.schema["avis"].dataType.elementType]
    empty = F.filter(F.array(F.struct(*[F.lit(None).cast(joined.schema["avis"].dataType.elementType[f].dataType).alias(f) for f in fields])), lambda x: F.lit(False))
    avis = F.coalesce("avis", empty)
    return joined.withColumn("avis", avis).withColumn("nb_avis", F.size("avis"))


def word_counts(reviews: DataFrame) -> DataFrame:
    """(code_commune, mot, frequence, position): words of the reviews' texts and where each comes first."""
    texts = reviews.select(
        "code_commune", "seq", F.posexplode(F.array("points_positifs", "points_negatifs")).alias("part", "body")
    )
    words = texts.select("code_commune", "seq", "part", F.posexplode(text.tokens(F.col("body"))).alias("at", "mot"))
    return words.groupBy("code_commune", "mot").agg(F.count("*").alias("frequence"), F.min(_place()).alias("position"))


def _place() -> Column:
    """One number in the order of (seq, part, at), nulls first.

    A least number is kept in a hash table with an entry per word; a least struct would have every word sorted.
    """
    review = F.coalesce(F.col("seq").cast("decimal(20,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(20,0)"))
    inside = F.col("part").cast("long") * 2**31 + F.col("at")
    return review * F.lit(2**32).cast("decimal(10,0)") + inside.cast("decimal(10,0)")


def top_words(counts: DataFrame, n: int = 30) -> DataFrame:
    """The n most frequent words of each municipality, ties by first occurrence, with their rank."""
    order = Window.partitionBy("code_commune").orderBy(F.col("frequence").desc(), F.col("position").asc())
    return counts.withColumn("rang", F.row_number().over(order)).where(F.col("rang") <= n).drop("position")


def word_cloud(reviews: DataFrame, n: int = 30) -> DataFrame:
    """(code_commune, word_cloud): array of (mot, frequence), most frequent first."""
    entry = F.struct("rang", F.struct("mot", "frequence").alias("e"))
    return top_words(word_counts(first_seen(reviews)), n).groupBy("code_commune").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("word_cloud")
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """One row per rated page (url, html): scores, rank, number of pages and the page's reviews.

    A page without an overall score and without any criterion's score is no row.
    """
    html = F.col("html")
    body = lambda tag, name: F.regexp_extract(html, rf'(?s)<{tag}[^>]*id="{name}"[^>]*>(.*?)</{tag}>', 1)
    cells = F.regexp_extract_all(body("table", "tablonotes"), F.lit("<td[^>]*>([^<]*)</td>"), 1)
    scores = F.transform(cells, lambda c: numbers.decimal_comma(c))
    place = F.regexp_replace(body("p", "classt"), "<[^>]*>", " ")
    blocks = F.filter(F.split(html, '<div class="comm">'), lambda b: b.contains('class="moyenne"'))
    parsed = pages.select(
        "*",
        codes.from_url(F.col("url")).alias("code_commune"),
        numbers.decimal_comma(F.regexp_extract(body("p", "ng"), "^([^<]*)", 1)).alias("note_globale"),
        text.as_struct(scores, schemas.CRITERIA, "double").alias("notes"),
        text.rank(place).alias("rang"),
        text.ranked_cities(place).alias("nb_villes_classees"),
        text.page_count(html).alias("nb_pages_avis"),
        F.transform(blocks, _review).alias("avis"),
    )
    rated = F.coalesce("note_globale", *[F.col(f"notes.{c}") for c in schemas.CRITERIA]).isNotNull()
    return parsed.where(rated).withColumn("nb_avis", F.size("avis")).withColumn("avis_complets", F.col("nb_pages_avis") <= 1)


def _review(block):
    one = lambda pattern: F.regexp_extract(block, pattern, 1)
    cells = F.regexp_extract_all(F.regexp_extract(block, "(?s)<table[^>]*>(.*?)</table>", 1), F.lit("<td[^>]*>([^<]*)</td>"), 1)
    votes = F.regexp_extract_all(F.regexp_extract(block, '(?s)<div class="interact"(.*?)</div>', 1), F.lit("<strong[^>]*>([^<]*)</strong>"), 1)
    header = F.regexp_extract(block, "(?s)<p[^>]*>(.*?)</p>", 1)
    return F.struct(
        numbers.blank_to_null(one('<div class="interact" id="([^"]*)"')).alias("review_id"),
        numbers.blank_to_null(F.trim(F.regexp_extract(header, "<strong[^>]*>([^<]*)</strong>", 1))).alias("pseudonyme"),
        dates.label_to_iso(F.regexp_extract(header, "<span[^>]*>([^<]*)</span>", 1)).alias("date_avis"),
        numbers.decimal_comma(one('<strong class="moyenne"[^>]*>([^<]*)</strong>')).alias("note_moyenne"),
        text.as_struct(F.transform(cells, lambda c: F.trim(c)), schemas.CRITERIA, "int").alias("notes"),
        text.labelled_paragraph(block, "positifs").alias("points_positifs"),
        text.labelled_paragraph(block, "négatifs").alias("points_negatifs"),
        text.numeric_token(votes, 0).alias("nb_accord"),
        text.numeric_token(votes, 1).alias("nb_pas_accord"),
    )


def roll_up_pages(pages: DataFrame) -> DataFrame:
    """One row per municipality over its parsed pages (code_commune, page, nb_avis, nb_pages_avis).

    A page that was read twice counts once, with the most reviews seen on it. avis_complets: every page
    from 1 to the greatest announced number is there.
    """
    once = pages.groupBy("code_commune", "page").agg(F.max("nb_avis").alias("nb_avis"), F.max("nb_pages_avis").alias("nb_pages_avis"))
    whole = once.groupBy("code_commune").agg(
        F.sum("nb_avis").alias("nb_avis"), F.max("nb_pages_avis").alias("nb_pages_avis"), F.collect_set("page").alias("_read")
    )
    expected = F.filter("_read", lambda p: (p >= 1) & (p <= F.col("nb_pages_avis")))
    return whole.withColumn("avis_complets", F.size(expected) == F.col("nb_pages_avis")).drop("_read")


def summary(reviews: DataFrame, more: list[str] | None = None) -> DataFrame:
    """The served shape: count 0 and an empty cloud where they are absent; ``more`` names columns to carry along."""
    empty = F.filter(F.array(F.struct(F.lit("").alias("mot"), F.lit(0).cast("long").alias("frequence"))), lambda x: F.lit(False))
    return reviews.select(
        "code_commune", "note_globale", F.coalesce("nb_avis", F.lit(0)).alias("nb_avis"), F.coalesce("word_cloud", empty).alias("word_cloud"), *(more or [])
    )
