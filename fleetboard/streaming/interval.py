"""Vehicles joined with trip updates of about the same time, by Spark's own stream-stream join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetboard.functions.timefn import rowtime
from fleetboard.operators.joins import with_probe
from fleetboard.operators.latest import latest_by_key


def join_within(
    vehicles: DataFrame, trips: DataFrame, *, before_s: int, after_s: int, late_s: int = 60
) -> DataFrame:
    """Left join of two streams: trip updates from ``before_s`` before a position to ``after_s`` after it.

    ``vehicles`` has id, tripId and updateSec, ``trips`` tripId, feedSec and any more. Both sides
    wait in Spark's state only as long as the bound and the watermarks (``late_s`` behind each
    side's newest row) ask for, so that state follows the rate of the feeds and not their length.
    A position comes once with each update in its bound, as they meet, or once with NULLs when
    the watermark says that none will come. ``newest_match`` revises these to one row a position.
    Positions without a trip are spread by their id: they match nothing, but NULL would be one key.
    """
    left = with_probe(vehicles, "tripId", "_trip").withColumn("_at", rowtime(F.col("updateSec")))
    right = trips.withColumn("_of", rowtime(F.col("feedSec"))).withColumnRenamed("tripId", "_other")
    bound = (
        (F.col("_trip") == F.col("_other"))
        & (F.col("_of") >= F.col("_at") - F.expr(f"INTERVAL {before_s} SECONDS"))
        & (F.col("_of") <= F.col("_at") + F.expr(f"INTERVAL {after_s} SECONDS"))
    )
    joined = left.withWatermark("_at", f"{late_s} seconds").join(right.withWatermark("_of", f"{late_s} seconds"), bound, "left_outer")
    return joined.drop("_trip", "_other", "_at", "_of")


def newest_match(joined: DataFrame, key: str = "id", order: tuple[str, ...] = ("feedSec",)) -> DataFrame:
    """Of each position's rows so far the one with the newest trip update; NULLs give way to any."""
    return latest_by_key(joined, key, list(order))
