"""Nearest neighbours and closest pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators import nearest
from millrace.plans.registry import Tables, query
from millrace.plans.views import stations

_PAIRS = """
SELECT a.id AS id_1, b.id AS id_2, a.latitude = b.latitude AND a.longitude = b.longitude AS same,
       ROUND(2 * 6373.0 * atan2(sqrt(h.h), sqrt(1 - h.h)), 6) AS distance_km
FROM stations a JOIN stations b ON {on},
LATERAL (SELECT LEAST(1.0, power(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude))
  * cos(radians(b.latitude)) * power(sin(radians(b.longitude - a.longitude) / 2), 2)) AS h) h"""


@query(
    f"""
WITH pairs AS ({_PAIRS.format(on="a.id < b.id")})
SELECT id_1, id_2, distance_km FROM pairs ORDER BY distance_km, id_1, id_2 LIMIT 10"""
)
def nearest_pairs(t: Tables) -> DataFrame:
    return nearest.nearest_pairs(stations(t), "id", "latitude", "longitude", 10)


@query(
    f"""
WITH pairs AS ({_PAIRS.format(on="a.id <> b.id")}),
ranked AS (
  SELECT id_1 AS id, id_2 AS neighbour_id, distance_km,
         row_number() OVER (PARTITION BY id_1 ORDER BY same DESC, distance_km, id_2) AS rank
  FROM pairs)
SELECT id, neighbour_id, distance_km FROM ranked WHERE rank = 1"""
)
def nearest_neighbour(t: Tables) -> DataFrame:
    return nearest.nearest_neighbour(stations(t), "id", "latitude", "longitude")
