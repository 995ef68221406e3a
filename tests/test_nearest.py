import math
import random

import pytest

from millrace.operators import nearest


def km(a, b):
    la, lo, lb, lob = map(math.radians, (a[1], a[2], b[1], b[2]))
    h = min(1.0, math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lob - lo) / 2) ** 2)
    return round(2 * 6373.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h)), 6)


def brute_neighbours(points):
    out = {}
    for a in points:
        others = [(a[1:] != b[1:], km(a, b), b[0]) for b in points if b[0] != a[0]]
        best = min(others)
        out[a[0]] = (best[2], best[1])
    return out


def brute_pairs(points, n):
    pairs = [(km(a, b), a[0], b[0]) for a in points for b in points if a[0] < b[0]]
    return [(i, j, d) for d, i, j in sorted(pairs)[:n]]


def clustered():
    """A third of the points in one town, a third at one spot, and the rest over the globe."""
    rng = random.Random(3)
    town = [(round(51.5 + rng.gauss(0, 0.002), 5), round(-0.1 + rng.gauss(0, 0.002), 5)) for _ in range(120)]
    spot = [(-41.3, 174.8)] * 120
    globe = [(round(rng.uniform(-90, 90), 3), round(rng.uniform(-180, 180), 3)) for _ in range(114)]
    edges = [(90.0, 0.0), (89.999, 180.0), (0.0, 180.0), (0.0, -179.999), (-90.0, 12.0), (0.0, 0.0)]
    places = town + spot + globe + edges
    rng.shuffle(places)
    return [(i, lat, lon) for i, (lat, lon) in enumerate(places)]


def far_apart():
    return [(1, 0.0, 0.0), (2, 0.0, 90.0), (3, 0.0, 179.0), (4, 80.0, 10.0)]


SCHEMA = "id long, lat double, lon double"


@pytest.mark.parametrize("make", [clustered, far_apart])
def test_neighbours_equal_brute_force(spark, make):
    points = make()
    got = nearest.nearest_neighbour(spark.createDataFrame(points, SCHEMA), "id", "lat", "lon").collect()
    want = brute_neighbours(points)
    assert len(got) == len(points)
    for r in got:
        assert (r["neighbour_id"], pytest.approx(r["distance_km"], abs=2e-6)) == want[r["id"]]


@pytest.mark.parametrize("make, n", [(clustered, 10), (far_apart, 4), (far_apart, 10)])
def test_pairs_equal_brute_force(spark, make, n):
    points = make()
    got = [tuple(r) for r in nearest.nearest_pairs(spark.createDataFrame(points, SCHEMA), "id", "lat", "lon", n).collect()]
    want = brute_pairs(points, n)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], abs=2e-6)


def test_pairs_of_a_dense_town(spark):
    """No two at one spot, so that the cells have to grow to find the pairs."""
    rng = random.Random(5)
    points = [(i, round(10 + rng.gauss(0, 0.01), 6), round(20 + rng.gauss(0, 0.01), 6)) for i in range(300)]
    points += [(1000 + i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(20)]
    df = spark.createDataFrame(points, SCHEMA)
    got = [tuple(r)[:2] for r in nearest.nearest_pairs(df, "id", "lat", "lon", 25).collect()]
    assert got == [r[:2] for r in brute_pairs(points, 25)]


def test_points_without_a_place_and_a_single_point(spark, rows):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], SCHEMA)
    assert rows(nearest.nearest_neighbour(df, "id", "lat", "lon")) == [(1, None, None), (2, None, None)]
    assert rows(nearest.nearest_pairs(df, "id", "lat", "lon", 3)) == []


def test_no_cross_join(spark, plan):
    points = spark.createDataFrame(clustered(), SCHEMA)
    spots = nearest._distinct_spots(points, "id", "lat", "lon", 2)
    text = plan(nearest._candidates(spots, spots, 0.1))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert plan(spots).count("WindowGroupLimit") == 2


def test_a_pole_is_one_place(spark):
    """Any number of longitudes at the poles asks for no finer cells, and the answers are those of all pairs."""
    rows = [(i, 90.0 if i % 2 else -90.0, float(i)) for i in range(1, 170)] + [(500 + i, 60.0 - i, 3.0 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, lat double, lon double")
    spots = nearest._first_ids(nearest._distinct_spots(df, "id", "lat", "lon", 2), nearest._spot(), 2)
    assert spots.count() == 24 and nearest._start_edge(spots) > 0.1
    got = {r.id: (r.neighbour_id, r.distance_km) for r in nearest.nearest_neighbour(df, "id", "lat", "lon").collect()}
    assert all(got[i] == ((2 - i % 2 if i > 2 else i + 2), 0.0) for i in range(1, 170))
    pairs = nearest.nearest_pairs(df, "id", "lat", "lon", 3).collect()
    assert [(r.id_1, r.id_2, r.distance_km) for r in pairs] == [(1, 3, 0.0), (1, 5, 0.0), (1, 7, 0.0)]
