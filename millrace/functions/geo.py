"""Great-circle distance and the unit-sphere form of a coordinate."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import ColumnLike, _col

# Fixed value: radius of the earth in kilometres.
EARTH_KM = 6373.0


def haversine(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
    """Distance in kilometres between two points given in degrees; null if any is null."""
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    lat_part = F.sin((phi2 - phi1) / 2)
    lon_part = F.sin(F.radians(_col(lon2) - _col(lon1)) / 2)
    # kept within [0, 1], so that antipodes do not slip past the square root
    h = F.least(F.lit(1.0), lat_part * lat_part + F.cos(phi1) * F.cos(phi2) * lon_part * lon_part)
    arc = F.atan2(F.sqrt(h), F.sqrt(1 - h)) * 2
    known = (
        _col(lat1).isNotNull() & _col(lon1).isNotNull() & _col(lat2).isNotNull() & _col(lon2).isNotNull()
    )
    return F.when(known, arc * EARTH_KM)


def on_sphere(lat: ColumnLike, lon: ColumnLike) -> tuple[Column, Column, Column]:
    """x, y, z of the point on a sphere of radius one."""
    phi, lam = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord(distance_km: Column) -> Column:
    """Straight-line length on the unit sphere of a great-circle distance."""
    half = F.least(distance_km / (2 * EARTH_KM), F.lit(math.pi / 2))
    return F.sin(half) * 2
