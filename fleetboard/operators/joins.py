"""Enrichment joins.

No lookup carries a broadcast hint: it is broadcast when its size, known from
the files or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``, and is shuffled otherwise. The probe
side of the shuffled form may be skewed; adaptive execution splits it, as the
lookups have one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetboard.functions.transit import SENTINEL, no_next_stop


def join_same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Equi-join on the named columns where NULL equals NULL."""
    theirs = {c: f"_right_{c}" for c in columns}
    right = right.withColumnsRenamed(theirs)
    matches = [F.col(c).eqNullSafe(F.col(r)) for c, r in theirs.items()]
    return left.join(right, reduce(and_, matches), how).drop(*theirs.values())


def with_probe(df: DataFrame, on: str, name: str = "_probe") -> DataFrame:
    """``df`` with ``on`` as a join key, rows where it is NULL spread by their ``id``.

    They match nothing, as no key begins with a zero character, but would
    otherwise all be shuffled to one task.
    """
    return df.withColumn(name, F.coalesce(on, F.concat(F.lit("\0"), F.coalesce("id", F.lit("")))))


def join_latest_trip(
    vehicles: DataFrame, trips: DataFrame, sentinel: str | None = SENTINEL, *, on: str = "tripId"
) -> DataFrame:
    """Vehicles left-joined with the state of the trip named by ``on``.

    ``trips`` holds one row per ``tripId`` (``latest_trip_state``). A vehicle
    without a trip update gets the "no next stop" value.
    """
    trips = trips.select(F.col("tripId").alias(on), "startTime", "next")
    return vehicles.join(trips, on, "left").withColumn(
        "next", F.coalesce("next", no_next_stop(sentinel))
    )


def join_trips(df: DataFrame, trip_lookup: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Add shapeId, routeName and tripHeadSign of the trip named by ``on``."""
    trips = trip_lookup.select(
        F.col("trip_id").alias("_probe"),
        F.col("shape_id").alias("shapeId"),
        F.col("route_short_name").alias("routeName"),
        F.col("trip_headsign").alias("tripHeadSign"),
    )
    if how != "left" or "id" not in df.columns or on == "_probe":
        return df.join(trips.withColumnRenamed("_probe", on), on, how)
    return with_probe(df, on).join(trips, "_probe", how).drop("_probe")


def join_stops(
    df: DataFrame, stop_lookup: DataFrame, on: str, *, typed: bool = False, spread: str | None = None, salts: int = 64
) -> DataFrame:
    """Left-join stopName, stopLat and stopLon of the stop named by ``on``.

    ``spread`` names a key that very many rows may have, such as "no next stop": these, and those
    where ``on`` is NULL, are spread over ``salts`` keys by their ``id``. A stop of that name is
    there under each of them.
    """
    kind = "float" if typed else "string"
    if spread is not None and "id" in df.columns:
        salt = F.concat(F.lit(f"\0{spread}\0"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("string"))
        stop = F.col("stop_id")
        every = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.concat(F.lit(f"\0{spread}\0"), i.cast("string")))
        copies = stop_lookup.withColumn("stop_id", F.explode(F.when(stop == spread, every).otherwise(F.array(stop))))
        nothing = F.concat(F.lit("\0"), F.coalesce(F.col("id").cast("string"), F.lit("")))
        probe = F.when(F.col(on) == spread, salt).otherwise(F.coalesce(on, nothing))
        return join_stops(df.withColumn("_stop", probe), copies, "_stop", typed=typed).drop("_stop")
    stops = stop_lookup.select(
        F.col("stop_id").alias(on),
        F.col("stop_name").alias("stopName"),
        F.col("stop_lat").try_cast(kind).alias("stopLat"),
        F.col("stop_lon").try_cast(kind).alias("stopLon"),
    )
    return df.join(stops, on, "left")
