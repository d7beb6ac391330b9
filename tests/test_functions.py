"""Literal expectations for the scalar functions, and edge cases."""

import pytest
from pyspark.sql import functions as F

from cadastra.functions import codes, dates, numbers, spatial, text


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("given", "expected"), [("0,5", 0.5), ("12.25", 12.25), ("\t 3,75 ", 3.75), ("   ", None), (None, None), ("néant", None), ("-9876543,21", -9876543.21)]
)
def test_decimal_comma(spark, given, expected):
    assert value(spark, numbers.decimal_comma(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Visite du 30-06-2019 à 23:59", "2019-06-30T23:59"),
        ("01-12-1999", "1999-12-01"),
        ("le 1-2-2020 à 10:00", None),
        ("hier", None),
        (None, None),
    ],
)
def test_label_to_iso(spark, given, expected):
    assert value(spark, dates.label_to_iso(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(("code", "dept"), [("01001", "01"), ("2B999", "2B"), ("97101", "971"), ("97502", "975"), ("2A123", "2A"), ("60060", "60")])
def test_department(spark, code, dept):
    assert value(spark, codes.department(F.lit(code))) == dept


@pytest.mark.parametrize(
    ("url", "code"),
    [("https://t.example/a_b_01234", "01234"), ("/x_2B050", "2B050"), ("/x_1234", None), ("/x_012345", None), ("/x_01234/", None), ("", None)],
)
def test_code_from_url(spark, url, code):
    assert value(spark, codes.from_url(F.lit(url))) == code


@pytest.mark.parametrize(("code", "padded"), [("7", "00007"), ("2B1", "002B1"), ("7654321", "7654321"), (None, None)])
def test_pad(spark, code, padded):
    assert value(spark, codes.pad(F.lit(code).cast("string"))) == padded


@pytest.mark.parametrize(
    ("given", "expected"), [("2024-12-31", "2024-12-31"), ("31/12/2024", "2024-12-31"), ("1/2/2024", "2024-02-01"), ("31/02/2024", None), ("x", None)]
)
def test_parse_date(spark, given, expected):
    assert value(spark, dates.iso(dates.parse(F.lit(given)))) == expected


def test_tokens(spark):
    assert value(spark, text.tokens(F.lit("Des Ânes gris, un PRÉ; et 3 œufs."))) == ["ânes", "gris", "pré", "œufs"]
    assert value(spark, text.tokens(F.lit(None).cast("string"))) == []


def test_rounding_and_ratio(spark):
    assert value(spark, numbers.rounded(F.lit(1.005), 2)) == 1.01
    assert value(spark, numbers.ratio(F.lit(1.0), F.lit(0.0), 2)) is None
    assert value(spark, numbers.to_int(F.lit("3.0"))) == 3
    assert value(spark, numbers.to_double(F.lit("NaN"))) is None


def test_freshness(spark):
    as_of = F.lit("2026-04-01").cast("date")
    for day, fresh in (("2026-03-02", True), ("2026-03-01", False), (None, False)):
        assert value(spark, dates.is_fresh(F.lit(day).cast("date"), as_of)) is fresh


def test_bbox():
    assert spatial.parse_bbox("1,2,3.5,4") == (1, 2, 3.5, 4)
    for bad in ("1,2,3", "a,b,c,d", ""):
        with pytest.raises(ValueError):
            spatial.parse_bbox(bad)


def test_touching_boxes_intersect(spark):
    box = F.struct(F.lit(0).alias("minx"), F.lit(0).alias("miny"), F.lit(1).alias("maxx"), F.lit(1).alias("maxy"))
    assert value(spark, spatial.intersects(box, (1, 1, 2, 2))) is True
    assert value(spark, spatial.intersects(box, (1.1, 0, 2, 2))) is False


def test_promotion(spark):
    one = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'
    many = value(spark, spatial.promoted(F.lit(one)))
    assert many == '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}'
    assert value(spark, spatial.promoted(F.lit(many))) == many
    assert value(spark, F.size(spatial.polygons(F.lit(one)))) == 1
