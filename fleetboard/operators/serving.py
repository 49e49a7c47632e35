"""Views a map client needs, computed from the boards and schedule files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetboard.functions.transit import eta_minutes
from fleetboard.operators.paging import PAGE_SIZE, pack, page_of


def roster(live: DataFrame, *, null_as_zero: bool = True) -> DataFrame:
    """Vehicle cards with minutes to the next stop, sorted by id as text."""
    return live.select(
        F.col("id").cast("string").alias("id"),
        "routeName",
        "startTime",
        "tripHeadSign",
        "nextStopName",
        eta_minutes(F.col("nextStopApproachSec"), null_as_zero=null_as_zero).alias("etaMinutes"),
    ).orderBy("id")


def feed_status(live: DataFrame) -> DataFrame:
    """Number of live vehicles, whether there are none, and the last update."""
    return live.agg(
        F.count("*").alias("vehicles"),
        (F.count("*") == 0).alias("isEmpty"),
        F.max("updateTime").alias("lastUpdate"),
    )


def _repeated(entries: str, value: Callable[[Column], Column]) -> Column:
    """``value`` of each entry as often as the entry counts."""
    return F.flatten(F.transform(entries, lambda e: F.array_repeat(value(e), e["n"].cast("int"))))


def trip_stop_lists(stop_times: DataFrame, *, page_size: int = PAGE_SIZE) -> DataFrame:
    """Stops of each trip in calling order, ``page_size`` sequence numbers a page.

    ``stops`` holds struct(stop_sequence, stop_id, n) with n copies counted;
    ``stop_ids`` the ids alone, repeats included.
    """
    calls = stop_times.groupBy("trip_id", "stop_sequence", "stop_id").agg(F.count("*").alias("n"))
    paged = calls.withColumn("page", page_of("stop_sequence", page_size))
    lists = pack(paged, ["trip_id"], ["stop_sequence", "stop_id", "n"])
    return lists.select(
        "trip_id",
        "page",
        F.col("entries").alias("stops"),
        _repeated("entries", lambda e: e["stop_id"]).alias("stop_ids"),
    )


def _numeric_shapes(shapes: DataFrame) -> DataFrame:
    return shapes.select(
        F.col("shape_id").try_cast("double").alias("shape"),
        F.col("shape_pt_sequence").alias("point"),
        F.col("shape_pt_lon").try_cast("double").alias("lon"),
        F.col("shape_pt_lat").try_cast("double").alias("lat"),
    ).where("shape is not null")


def route_shapes(shapes: DataFrame, *, page_size: int = PAGE_SIZE) -> DataFrame:
    """Path of each shape in point order, as coordinates and a GeoJSON Feature.

    Shapes are keyed by the numeric value of their id; a page holds
    ``page_size`` point numbers. Every row is a point, repeated ones too.
    """
    points = _numeric_shapes(shapes).groupBy("shape", "point", "lon", "lat").agg(F.count("*").alias("n"))
    lists = pack(
        points.withColumn("page", page_of("point", page_size)), ["shape"], ["point", "lon", "lat", "n"]
    )
    path = lists.select(
        "shape",
        "page",
        _repeated("entries", lambda p: F.array(p["lon"], p["lat"])).alias("path"),
    )
    geometry = F.struct(F.lit("LineString").alias("type"), F.col("path").alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.create_map().cast("map<string,string>").alias("properties"),
        geometry.alias("geometry"),
    )
    return path.withColumn("feature", F.to_json(feature))


def routes_in_use(
    vehicles: DataFrame, shapes: DataFrame, *, page_size: int = PAGE_SIZE
) -> DataFrame:
    """``route_shapes`` of the shapes that vehicles on a board follow, each once."""
    used = vehicles.select(F.col("shapeId").try_cast("double").alias("_shape"))
    keyed = shapes.withColumn("_shape", F.col("shape_id").try_cast("double"))
    points = keyed.join(used, "_shape", "left_semi")
    return route_shapes(points.drop("_shape"), page_size=page_size)


def _selected(vehicles: DataFrame, vehicle_id: str, column: str) -> DataFrame:
    """One row with the newest value of ``column`` for the vehicle, or NULL.

    As a global aggregate it has one row by construction, which makes any join
    with it a broadcast.
    """
    newest = F.max(F.struct("updateSec", column))
    return vehicles.where(F.col("id") == vehicle_id).agg(newest[column].alias(column))


def vehicle_route(
    vehicles: DataFrame, shapes: DataFrame, vehicle_id: str, *, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Route path of the selected vehicle; no row when its shape is unknown."""
    selected = _selected(vehicles, vehicle_id, "shapeId")
    selected = selected.select(F.col("shapeId").try_cast("double").alias("_shape"))
    keyed = shapes.withColumn("_shape", F.col("shape_id").try_cast("double"))
    points = keyed.join(selected, "_shape", "left_semi").drop("_shape")
    routes = route_shapes(points, page_size=page_size)
    return routes.select(F.lit(vehicle_id).alias("id"), *routes.columns)


def flag_trip_stops(
    stops: DataFrame, stop_times: DataFrame, vehicles: DataFrame, vehicle_id: str | None
) -> DataFrame:
    """All stops, flagged when the selected vehicle's trip calls there.

    False everywhere when nothing is selected or the trip is unknown.
    """
    if vehicle_id is None:
        return stops.withColumn("onTrip", F.lit(False))
    trip = _selected(vehicles, vehicle_id, "tripId").withColumnRenamed("tripId", "trip_id")
    called = (
        stop_times.join(trip, "trip_id", "left_semi")
        .select("stop_id")
        .distinct()
        .withColumn("_called", F.lit(True))
    )
    return (
        stops.join(called, "stop_id", "left")
        .withColumn("onTrip", F.coalesce("_called", F.lit(False)))
        .drop("_called")
    )
