"""Which boundary polygons a point lies in.

Each polygon's edges are dealt to horizontal strips, and each strip's extent to grid
cells. Points meet the polygons of their own cell by an equi-join, and those of the strip's
edges that a ray to the right crosses decide: an odd number is inside. Rings are not told
apart, so holes and several parts need nothing of their own; a point on an edge is inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RING = "array<array<double>>"


def rings(boundaries: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """``key`` and ``ring`` (points of longitude and latitude) of every polygon of GeoJSON
    geometries. Other kinds of geometry, and null or malformed ones, have no ring."""

    def coordinates(kind: str) -> Column:
        parsed = F.from_json(F.col(geometry), f"type string, coordinates {kind}")
        return parsed["coordinates"]

    kind = F.get_json_object(geometry, "$.type")
    single = F.array(coordinates(f"array<{_RING}>"))
    many = coordinates(f"array<array<{_RING}>>")
    polygons = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", many)
    parts = boundaries.select(key, F.explode(polygons).alias("_polygon"))
    return parts.select(key, F.explode("_polygon").alias("ring"))


def edges(boundary_rings: DataFrame, key: str) -> DataFrame:
    """``key``, x1, y1, x2, y2 of every side; a ring that is not closed is closed."""
    points = F.concat("ring", F.slice("ring", 1, 1))

    def side(a: Column, b: Column) -> Column:
        return F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))

    size = F.size("ring")
    sides = F.zip_with(F.slice(points, 1, size), F.slice(points, 2, size), side)
    return boundary_rings.where(size > 2).select(key, F.explode(sides).alias("_e")).select(key, "_e.*")


def points_in_areas(
    points: DataFrame, boundaries: DataFrame, key: str, x: str = "longitude", y: str = "latitude", cell: float = 0.25
) -> DataFrame:
    """The columns of ``points`` with the ``key`` of every boundary that the point is in.

    A point in several areas has several rows, one in none has none; null coordinates are in none.
    ``cell`` is the side of a grid cell in degrees.
    """
    at = lambda c: F.floor(c / F.lit(cell))
    every = lambda low, high: F.explode(F.sequence(at(low), at(high)))
    sides = edges(rings(boundaries, key), key)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    sides = sides.withColumn("_strip", every(low, high))
    # a side's part in a strip can reach no further than the side
    strips = sides.groupBy(F.col(key).alias("_area"), "_strip").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_sides"),
        F.min(F.least("x1", "x2")).alias("_west"),
        F.max(F.greatest("x1", "x2")).alias("_east"),
    )
    cover = strips.select("_area", "_strip", every(F.col("_west"), F.col("_east")).alias("_column"))
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    placed = placed.withColumn("_px", F.col(x)).withColumn("_py", F.col(y))
    met = placed.join(cover, (at(F.col("_px")) == F.col("_column")) & (at(F.col("_py")) == F.col("_strip")))
    met = met.drop("_column").join(strips.select("_area", "_strip", "_sides"), ["_area", "_strip"])
    px, py = F.col("_px"), F.col("_py")

    def crossed(e: Column) -> Column:
        above = (e.y1 > py) != (e.y2 > py)
        return above & (px < (e.x2 - e.x1) * (py - e.y1) / (e.y2 - e.y1) + e.x1)

    def under(e: Column) -> Column:
        straight = (px - e.x1) * (e.y2 - e.y1) == (py - e.y1) * (e.x2 - e.x1)
        return straight & px.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2)) & py.between(
            F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)
        )

    inside = (F.size(F.filter("_sides", crossed)) % 2 == 1) | F.exists("_sides", under)
    return met.where(inside).select(*points.columns, F.col("_area").alias(key))
