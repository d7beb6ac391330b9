"""Points and bounding boxes (longitude, latitude; SRID 4326)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SRID = 4326
GEOMETRY = "struct<type: string, coordinates: string>"


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """min_lon,min_lat,max_lon,max_lat; ValueError if it isn't four numbers."""
    parts = [float(x) for x in text.split(",")]
    if len(parts) != 4:
        raise ValueError("a bounding box has four numbers: min_lon,min_lat,max_lon,max_lat")
    return parts[0], parts[1], parts[2], parts[3]


def box_of_text(text: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of a text of four numbers with commas between; null if it isn't that."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    whole = (F.size(parts) == 4) & F.forall(parts, lambda x: x.isNotNull())
    return F.when(whole, F.struct(*[F.get(parts, k).alias(n) for k, n in enumerate(("minx", "miny", "maxx", "maxy"))]))


def point(longitude: Column, latitude: Column) -> Column:
    both = longitude.isNotNull() & latitude.isNotNull()
    return F.when(both, F.struct(longitude.alias("longitude"), latitude.alias("latitude")))


def in_bbox(longitude: Column, latitude: Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive on all sides."""
    return longitude.between(box[0], box[2]) & latitude.between(box[1], box[3])


def polygons(geometry: Column) -> Column:
    """Coordinates of a GeoJSON text as a multipolygon; a polygon becomes one of one part."""
    kind = F.get_json_object(geometry, "$.type")
    many = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<array<double>>>>")
    one = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<double>>>")
    return F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)


def promoted(geometry: Column) -> Column:
    """GeoJSON text with polygons written as multipolygons."""
    coordinates = F.get_json_object(geometry, "$.coordinates")
    wrapped = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), coordinates, F.lit("]}"))
    return F.when(F.get_json_object(geometry, "$.type") == "Polygon", wrapped).otherwise(geometry)


def envelope(parts: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of a multipolygon's coordinates."""
    points = F.flatten(F.flatten(parts))
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def intersects(box: Column, other: tuple[float, float, float, float]) -> Column:
    """Whether two boxes share a point; touching counts."""
    return (box["minx"] <= other[2]) & (box["maxx"] >= other[0]) & (box["miny"] <= other[3]) & (box["maxy"] >= other[1])
