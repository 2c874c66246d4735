"""Storm geography: episode points, hulls and centres."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# send the helpers below with the job, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The storm event types that are mapped.
STORM_TYPES = [
    "Thunderstorm Wind", "Lightning", "Flood", "Heavy Rain",
    "Tornado", "Hail",
    "Strong Wind", "Funnel Cloud", "Flash Flood",
    "Tropical Storm", "Tropical Depression", "High Wind",
    "Dust Devil", "Hurricane",
]

RING = T.ArrayType(T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]))


def filter_events(df: DataFrame, state: str, types: list[str] | None = None, episode: int | None = None) -> DataFrame:
    kept = df.filter((F.col("STATE") == state) & F.col("EVENT_TYPE").isin(STORM_TYPES if types is None else types))
    return kept if episode is None else kept.filter(F.col("EPISODE_ID") == episode)


def in_state(county_id: Column, fips: int) -> Column:
    """True where the thousands of a county code are the state's code."""
    return (county_id / 1000).cast("int") == fips


def unpivot_points(df: DataFrame, key: str, pairs: list[tuple[Column, Column]]) -> DataFrame:
    """One row per (longitude, latitude) pair, without rows that miss either."""
    points = F.array(*[F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat")) for lon, lat in pairs])
    return df.select(key, F.explode(points).alias("_p")).select(key, "_p.lon", "_p.lat").dropna(subset=["lon", "lat"])


def event_points(df: DataFrame) -> DataFrame:
    """Begin and end points of the events of each episode."""
    pairs = [(F.col(f"{side}_LON"), F.col(f"{side}_LAT")) for side in ("BEGIN", "END")]
    return unpivot_points(df, "EPISODE_ID", pairs)


def centroid_by(points: DataFrame, key: str) -> DataFrame:
    """Mean coordinates and number of points per key."""
    return points.groupBy(key).agg(
        F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("points")
    )


def busiest_episode(df: DataFrame) -> DataFrame:
    """The episode with most located events; the smallest id among equals."""
    located = df.filter(F.col("BEGIN_LAT").isNotNull() & F.col("BEGIN_LON").isNotNull())
    counts = located.groupBy("EPISODE_ID").agg(F.count(F.lit(1)).alias("events"))
    return counts.orderBy(F.desc("events"), "EPISODE_ID").limit(1)


def outer_points(points: np.ndarray) -> np.ndarray:
    """Drop points clearly inside the polygon of the extremes in eight directions."""
    x, y = points[:, 0], points[:, 1]
    ends = [pick(v) for v in (x, y, x + y, x - y) for pick in (np.argmin, np.argmax)]
    frame = convex_ring(points[ends])
    if len(frame) < 3:
        return points
    margin = 1e-9 * np.ptp(x) * np.ptp(y)
    inside = np.ones(len(points), dtype=bool)
    for (ax, ay), (bx, by) in zip(frame, np.roll(frame, -1, axis=0)):
        inside &= (bx - ax) * (y - ay) - (by - ay) * (x - ax) > margin
    return points[~inside]


def convex_ring(points: np.ndarray) -> np.ndarray:
    """Hull corners, counter-clockwise from the lowest of the leftmost points."""
    if len(points) > 64:
        points = outer_points(points)
    ordered = np.unique(points, axis=0)

    def side(sequence):
        chain: list = []
        for p in sequence:
            while len(chain) > 1:
                (ax, ay), (bx, by) = chain[-2], chain[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                chain.pop()
            chain.append(p)
        return chain[:-1]

    rows = ordered.tolist()
    return np.array(side(rows) + side(rows[::-1])) if len(rows) > 2 else ordered


def _corners(key: str):
    """Reduce each partition, sorted by key, to the hull corners of its keys.

    A key that spans batches is carried over as its corners so far. What a key
    leaves in a partition is thus a small ring, however many points it has.
    """
    def reduce_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = frame[key].iloc[-1]
            is_open = frame[key] == last
            done, held = frame[~is_open], shrink(frame[is_open])
            if len(done):
                yield thin(done)
        if held is not None:
            yield held

    def shrink(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) < 64:
            return group
        ring = convex_ring(group[["lon", "lat"]].to_numpy())
        return pd.DataFrame({key: [group[key].iloc[0]] * len(ring), "lon": ring[:, 0], "lat": ring[:, 1]})

    def thin(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame.groupby(key)[key].transform("size")
        large = frame[sizes >= 64]
        return pd.concat([frame[sizes < 64], *[shrink(g) for _, g in large.groupby(key)]])

    return reduce_partition


def hull_by(points: DataFrame, key: str) -> DataFrame:
    """Closed hull ring per key; NULL where the points span no area. Points without a key belong to none.

    Three reductions keep hot keys small: the extreme latitudes per longitude
    (no other point can be a corner, and the sums start in the map tasks), the
    corners per partition, and only then the ring of the key.
    """
    extremes = (
        points.filter(F.col(key).isNotNull()).groupBy(key, "lon").agg(F.min("lat").alias("_south"), F.max("lat").alias("_north"))
        .select(key, "lon", F.explode(F.array_distinct(F.array("_south", "_north"))).alias("lat"))
    )
    point_type = T.StructType([points.schema[key], T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    corners = extremes.sortWithinPartitions(key).mapInPandas(_corners(key), point_type)

    def close(group: pd.DataFrame) -> pd.DataFrame:
        ring = convex_ring(group[["lon", "lat"]].to_numpy())
        closed = None
        if len(ring) > 2:
            closed = [{"lon": x, "lat": y} for x, y in [*ring.tolist(), ring[0].tolist()]]
        return pd.DataFrame({key: [group[key].iloc[0]], "ring": [closed]})

    out = T.StructType([points.schema[key], T.StructField("ring", RING)])
    return corners.groupBy(key).applyInPandas(close, out)


def to_geojson(hulls: DataFrame, key: str) -> DataFrame:
    """The ring of each key as a GeoJSON Feature; NULL without a ring."""
    positions = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(positions).alias("coordinates")).alias("geometry"),
        F.struct(F.col(key).cast("string").alias("name")).alias("properties"),
    ))
    return hulls.select(key, F.when(F.col("ring").isNotNull(), feature).alias("feature"))
