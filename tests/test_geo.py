import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import geo

POINTS = [
    (-84.4497, 30.1599), (-85.6397, 30.2297), (-85.59, 30.1336), (-84.3378, 30.433), (-85.7323, 30.1806),
    (-84.4629, 30.1775), (-85.6603, 30.2314), (-85.6054, 30.1332), (-84.3326, 30.4335), (-85.7299, 30.1807),
]
RING = [
    (-85.7323, 30.1806), (-85.6054, 30.1332), (-84.4497, 30.1599), (-84.3326, 30.4335), (-84.3378, 30.433),
    (-85.6603, 30.2314), (-85.7323, 30.1806),
]
STORMS = (
    "EPISODE_ID bigint, STATE string, EVENT_TYPE string, BEGIN_LON double, BEGIN_LAT double, END_LON double, END_LAT double"
)


def storms(spark):
    pairs = list(zip(POINTS[:5], POINTS[5:]))
    data = [(162055, "FLORIDA", "Tornado", *a, *b) for a, b in pairs]
    data += [
        (1, "FLORIDA", "Hail", -80.0, 25.0, -81.0, 26.0),
        (2, "FLORIDA", "Flood", None, None, None, None),
        (3, "FLORIDA", "Hail", 0.0, 0.0, 1.0, 1.0), (3, "FLORIDA", "Hail", 2.0, 2.0, 1.0, 1.0),
        (162055, "TEXAS", "Tornado", 0.0, 0.0, 0.0, 0.0), (162055, "FLORIDA", "Drought", 0.0, 0.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(data, STORMS)


def test_published_episode(spark):
    episode = geo.filter_events(storms(spark), "FLORIDA", episode=162055)
    points = geo.event_points(episode)
    assert sorted(rows(points, "lon", "lat")) == sorted(POINTS)
    ring = [tuple(p) for p in geo.hull_by(points, "EPISODE_ID").first()["ring"]]
    assert ring == RING
    centre = geo.centroid_by(points, "EPISODE_ID").first()
    assert (round(centre["lon"], 5), round(centre["lat"], 5), centre["points"]) == (-85.15406, 30.22931, 10)
    feature = json.loads(geo.to_geojson(geo.hull_by(points, "EPISODE_ID"), "EPISODE_ID").first()["feature"])
    assert feature["type"] == "Feature" and feature["geometry"]["type"] == "Polygon"
    assert [tuple(p) for p in feature["geometry"]["coordinates"][0]] == RING


def test_points_without_area_have_no_ring(spark):
    hulls = geo.hull_by(geo.event_points(geo.filter_events(storms(spark), "FLORIDA")), "EPISODE_ID")
    found = {r["EPISODE_ID"]: r["ring"] for r in hulls.collect()}
    assert set(found) == {1, 3, 162055}
    assert found[1] is None and found[3] is None
    features = {r[0]: r[1] for r in geo.to_geojson(hulls, "EPISODE_ID").collect()}
    assert features[1] is None and features[162055] is not None


def brute_corners(points):
    """Points that start an edge with no point to its right."""
    points = np.unique(np.array(points), axis=0)
    corners = set()
    for a in points:
        for b in points:
            if (a != b).any():
                side = (b[0] - a[0]) * (points[:, 1] - a[1]) - (b[1] - a[1]) * (points[:, 0] - a[0])
                if (side >= 0).all() and not ((side == 0) & ((points - a) @ (b - a) > (b - a) @ (b - a))).any():
                    if not ((side == 0) & ((points - a) @ (b - a) < 0)).any():
                        corners.add(tuple(a))
    return corners


@pytest.mark.parametrize("batch", ["10000", "50"])
def test_hot_episode_matches_brute_force(spark, batch):
    pick = random.Random(3)
    # one key holds most rows; integer coordinates give many collinear and equal points
    data = [(0 if pick.random() < 0.7 else pick.randrange(1, 6), float(pick.randrange(30)), float(pick.randrange(30))) for _ in range(2000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        stray = [(None, 99.0, 99.0)]
        df = spark.createDataFrame(data + stray, "k int, lon double, lat double").repartition(4)
        found = {r["k"]: [tuple(p) for p in r["ring"]] for r in geo.hull_by(df, "k").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(found) == list(range(6))
    for k in range(6):
        assert found[k][0] == found[k][-1]
        assert set(found[k]) == brute_corners([p[1:] for p in data if p[0] == k])
        assert len(set(found[k])) == len(found[k]) - 1


def test_many_corners(spark):
    angle = np.linspace(0, 2 * np.pi, 700, endpoint=False)
    data = [(1, float(x), float(y)) for x, y in zip(np.cos(angle), np.sin(angle))]
    ring = geo.hull_by(spark.createDataFrame(data, "k int, lon double, lat double"), "k").first()["ring"]
    assert len(ring) == 701


def test_state_codes_and_busiest(spark):
    counties = spark.createDataFrame([(12001,), (12999,), (13001,), (1200,)], "id int")
    assert rows(counties.filter(geo.in_state(F.col("id"), 12))) == [(12001,), (12999,)]
    assert rows(geo.busiest_episode(storms(spark))) == [(162055, 7)]
