"""Nearest neighbours and closest pairs on the globe, exactly, without all pairs.

Coordinates become points on a sphere of radius one, cut into cubic cells. A point
is compared only with those in its own and the 26 touching cells, and a result is
accepted once its straight-line distance is no longer than the cell's edge, so
nothing nearer can lie outside. What is still open goes to the next round with
larger cells. Points that are still open have nothing within the old edge, so they
lie far apart and only a few of them fall into one of the larger cells; each round
therefore costs time in proportion to the table, however the points are clustered.

Points that share a coordinate are reduced to the few smallest ids first, which is
all an answer can name; so are those at a pole, which is one place whatever the longitude.
Otherwise cells would have to be as fine as rounding to tell them apart, for nothing. The rounds
join by shuffles: nothing of a size that follows the table goes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.geo import chord, haversine, on_sphere
from millrace.lineage import materialise
from millrace.operators.joins import union_all

_CROWDED = 64  # more points than this in one starting cell call for finer cells
_FINEST = 1e-12
_GROWTH = 4.0
_WHOLE_GLOBE = 2.0  # cells of this edge all touch each other
_DECIMALS = 6  # distances are compared to the millimetre, so that ties are ties
_ROUNDING_KM = 1e-6


def _distinct_spots(df: DataFrame, id: str, lat: str, lon: str, keep: int) -> DataFrame:
    """Per coordinate its ``keep`` smallest ids, with the place on the sphere."""
    known = df.select(
        F.col(id).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")
    ).dropna()
    x, y, z = on_sphere("lat", "lon")
    return _first_ids(known, ["lat", "lon"], keep).withColumns({"x": x, "y": y, "z": z})


def _first_ids(df: DataFrame, by: list[str | Column], keep: int) -> DataFrame:
    """The rows with the ``keep`` smallest ids of each group."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    return df.withColumn("nth", nth).filter(F.col("nth") <= keep).drop("nth")


def _spot() -> list[Column]:
    """Equal for points at one place: a pole has any longitude."""
    return [F.col("lat"), F.when(F.abs("lat") == 90, 0.0).otherwise(F.col("lon"))]


def _cell(edge: float) -> list[Column]:
    return [F.floor(F.col(axis) / F.lit(edge)).alias(f"c{axis}") for axis in "xyz"]


def _start_edge(points: DataFrame, at_least: float = _FINEST) -> float:
    """An edge so small that no cell is crowded, from one point per cell on average down."""
    edge = math.sqrt(4 * math.pi / max(points.count(), 1))
    while edge > at_least:
        fullest = points.groupBy(*_cell(edge)).count().agg(F.max("count")).first()[0]
        if fullest is None or fullest <= _CROWDED:
            break
        edge /= _GROWTH
    return edge


def _candidates(queries: DataFrame, points: DataFrame, edge: float) -> DataFrame:
    """Each query with the points of its own and the touching cells, and the distance."""
    steps = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    reach = queries.select("id", "lat", "lon", *_cell(edge))
    for axis in "xyz":
        reach = reach.withColumn(f"d{axis}", F.explode(steps)).withColumn(
            f"c{axis}", F.col(f"c{axis}") + F.col(f"d{axis}")
        )
    reach = reach.filter(_touches_sphere(edge)).drop("dx", "dy", "dz")
    others = points.select(
        F.col("id").alias("other_id"),
        F.col("lat").alias("other_lat"),
        F.col("lon").alias("other_lon"),
        *_cell(edge),
    )
    km = F.round(haversine("lat", "lon", "other_lat", "other_lon"), _DECIMALS)
    return reach.join(others.hint("merge"), ["cx", "cy", "cz"]).withColumn("km", km)


def _touches_sphere(edge: float) -> Column:
    """True for cells the surface runs through; about half of the 27 around a point do not."""
    nearest, farthest = F.lit(0.0), F.lit(0.0)
    for axis in "xyz":
        low = F.col(f"c{axis}") * F.lit(edge)
        high = low + F.lit(edge)
        nearest += F.when(low > 0, low * low).when(high < 0, high * high).otherwise(F.lit(0.0))
        farthest += F.greatest(low * low, high * high)
    return (nearest <= 1 + 1e-9) & (farthest >= 1 - 1e-9)


def _is_safe(edge: float) -> Column:
    """True for a distance below which the touching cells hold every point."""
    if edge >= _WHOLE_GLOBE:
        return F.lit(True)
    return chord(F.col("km") + _ROUNDING_KM) <= edge


def nearest_neighbour(df: DataFrame, id: str, lat: str, lon: str) -> DataFrame:
    """For each id its nearest other id and the distance in kilometres.

    A point that shares its coordinate with others gets the smallest of their ids at
    distance zero; equal distances go to the smaller id. Ids without a coordinate,
    and a single point, get null.
    """
    by_place = materialise(
        _distinct_spots(df, id, lat, lon, 2)
        .groupBy("lat", "lon", "x", "y", "z")
        .agg(F.min("id").alias("id"), F.max("id").alias("_last"), F.count(F.lit(1)).alias("_ids"))
        .withColumn("second_id", F.when(F.col("_ids") > 1, F.col("_last")))
        .drop("_last", "_ids"),
        "places",
    )
    points = by_place.select("id", "lat", "lon", "x", "y", "z")
    open_points = by_place.filter(F.col("second_id").isNull()).select(points.columns)
    points = materialise(_first_ids(points, _spot(), 2), "points")  # a point and another one
    answers = []
    edge = _start_edge(points)
    while True:
        best = (
            _candidates(open_points, points, edge)
            .filter(F.col("id") != F.col("other_id"))
            .groupBy("id")
            .agg(F.min(F.struct("km", "other_id")).alias("best"))
            .select("id", F.col("best.km").alias("km"), F.col("best.other_id").alias("other_id"))
        )
        answers.append(materialise(best.filter(_is_safe(edge)), "nearest"))
        open_points = materialise(open_points.join(answers[-1].hint("merge"), "id", "left_anti"), "open")
        if edge >= _WHOLE_GLOBE or open_points.isEmpty():
            break
        edge *= _GROWTH
    found = union_all(answers).select(
        F.col("id").alias(id), F.col("other_id").alias("_alone_id"), F.col("km").alias("_alone_km")
    )
    shared = by_place.filter(F.col("second_id").isNotNull()).select(
        F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("id").alias("_first"), "second_id"
    )
    same_place = (F.col(lat).cast("double") == F.col("_lat")) & (F.col(lon).cast("double") == F.col("_lon"))
    here = F.when(F.col(id) == F.col("_first"), F.col("second_id")).otherwise(F.col("_first"))
    return (
        df.select(id, lat, lon)
        .join(shared.hint("merge"), same_place, "left")
        .join(found.hint("merge"), id, "left")
        .select(
            id,
            F.when(F.col("_first").isNotNull(), here).otherwise(F.col("_alone_id")).alias("neighbour_id"),
            F.when(F.col("_first").isNotNull(), F.lit(0.0)).otherwise(F.col("_alone_km")).alias("distance_km"),
        )
    )


def nearest_pairs(df: DataFrame, id: str, lat: str, lon: str, n: int) -> DataFrame:
    """The ``n`` closest pairs of points, each pair once, ties by the two ids.

    The cells start fine and grow until ``n`` pairs lie within one edge. Fewer than
    ``n`` pairs then lie within the edge before, so no cell can hold many points.
    """
    points = materialise(
        # the n + 1 smallest ids of a coordinate make up all its pairs that can rank
        _first_ids(_distinct_spots(df, id, lat, lon, n + 1), _spot(), n + 1).select("id", "lat", "lon", "x", "y", "z"),
        "points",
    )
    edge = _start_edge(points)
    while True:
        pairs = (
            _candidates(points, points, edge)
            .filter((F.col("id") < F.col("other_id")) & _is_safe(edge))
            .select(F.col("id").alias("id_1"), F.col("other_id").alias("id_2"), F.col("km").alias("distance_km"))
            .orderBy("distance_km", "id_1", "id_2")
            .limit(n)
        )
        top = materialise(pairs, "pairs")
        if edge >= _WHOLE_GLOBE or top.count() == n:
            return top.orderBy("distance_km", "id_1", "id_2")
        edge *= _GROWTH
