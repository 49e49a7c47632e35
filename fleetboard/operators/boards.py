"""The two boards: where every vehicle is heading, and what each stop expects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetboard.functions.timefn import DEFAULT_ZONE, epoch_of, iso_date, local_time
from fleetboard.functions.transit import SENTINEL, is_upcoming, next_stop
from fleetboard.operators.joins import (
    join_latest_trip,
    join_same,
    join_stops,
    join_trips,
    with_probe,
)
from fleetboard.operators.latest import fresh, latest_by_key
from fleetboard.operators.paging import PAGE_SECONDS, pack, page_of

# Column that breaks ties between events of the same second, where present:
# a topic offset or another arrival number.
SEQ = "seq"

_ENTRY = ["id", "routeName", "tripHeadSign", "arrivalTime", "delay", "n"]


def _seq(df: DataFrame) -> list[Column]:
    return [F.col(SEQ)] if SEQ in df.columns else []


def _order(df: DataFrame, seconds: str) -> list[str]:
    return [seconds, SEQ] if SEQ in df.columns else [seconds]


def position_columns(vehicles: DataFrame) -> dict[str, Column]:
    """The columns of ``slim_positions`` by name."""
    return {
        "id": F.col("id"),
        "tripId": F.col("vehicle.trip.tripId"),
        "startDate": iso_date(F.col("vehicle.trip.startDate")),
        "latitude": F.col("vehicle.position.latitude"),
        "longitude": F.col("vehicle.position.longitude"),
        "updateSec": F.col("vehicle.timestamp"),
        **{SEQ: c for c in _seq(vehicles)},
    }


def slim_positions(vehicles: DataFrame) -> DataFrame:
    """Position events reduced to what the board shows."""
    return vehicles.select(*[c.alias(name) for name, c in position_columns(vehicles).items()])


def vehicle_state(
    vehicles: DataFrame, *, as_of: int | Column | None = None, horizon_s: int | None = 150
) -> DataFrame:
    """Latest fresh position per vehicle.

    Freshness is tested before grouping: a vehicle's newest row is fresh
    whenever any of its rows is.
    """
    slim = slim_positions(vehicles)
    if horizon_s is not None:
        slim = fresh(slim, "updateSec", horizon_s, as_of)
    return latest_by_key(slim, "id", _order(slim, "updateSec"))


def calls_of(
    update: Column, *, add_delay: bool = True, use_arrival: bool = False
) -> Column:
    """Upcoming entries of a trip update as structs(stopId, arrivalSec, delay)."""
    upcoming = F.filter(
        update["stopTimeUpdate"],
        lambda s: is_upcoming(
            s, update["timestamp"], add_delay=add_delay, use_arrival=use_arrival
        ),
    )
    return F.transform(
        upcoming,
        lambda s: F.struct(
            s["stopId"].alias("stopId"),
            F.coalesce(s["departure"]["time"], s["arrival"]["time"])
            .try_cast("bigint")
            .alias("arrivalSec"),
            F.coalesce(s["departure"]["delay"], s["arrival"]["delay"]).alias("delay"),
        ),
    )


def trip_columns(trips: DataFrame, *, calls: bool = False, **next_stop_options) -> dict[str, Column]:
    """The columns of ``trip_state`` by name."""
    u = F.col("tripUpdate")
    judged = {k: v for k, v in next_stop_options.items() if k in ("add_delay", "use_arrival")}
    return {
        "tripId": F.col("id"),
        "feedSec": u["timestamp"],
        **{SEQ: c for c in _seq(trips)},
        "startTime": u["trip"]["startTime"],
        "next": next_stop(u["stopTimeUpdate"], u["timestamp"], **next_stop_options),
        **({"calls": calls_of(u, **judged)} if calls else {}),
    }


def trip_state(trips: DataFrame, *, calls: bool = False, **next_stop_options) -> DataFrame:
    """Each trip update reduced to its start time and next stop.

    Done row by row before any shuffle, so whole stop lists are never moved.
    ``calls=True`` keeps the upcoming entries as well, for the stop board.
    """
    columns = trip_columns(trips, calls=calls, **next_stop_options)
    return trips.select(*[c.alias(name) for name, c in columns.items()])


def latest_trip_state(trips: DataFrame, **next_stop_options) -> DataFrame:
    """State of the newest update of every trip."""
    state = trip_state(trips, **next_stop_options)
    return latest_by_key(state, "tripId", _order(state, "feedSec"))


def board_of_states(
    vehicles: DataFrame,
    trips: DataFrame,
    trip_lookup: DataFrame,
    stop_lookup: DataFrame,
    *,
    zone: str = DEFAULT_ZONE,
    ingested_at: int | Column | None = None,
    sentinel: str | None = SENTINEL,
) -> DataFrame:
    """Vehicle board from ``vehicle_state`` and ``latest_trip_state`` rows."""
    # One key for both joins, so that the second needs no shuffle of the board.
    board = join_latest_trip(with_probe(vehicles, "tripId"), trips, sentinel, on="_probe")
    board = join_trips(board, trip_lookup, "_probe").withColumn("nextStopId", F.col("next.stopId"))
    board = join_stops(board, stop_lookup, "nextStopId", spread=sentinel)
    return board.select(
        "id",
        "tripId",
        "shapeId",
        "routeName",
        "tripHeadSign",
        "startDate",
        "startTime",
        "latitude",
        "longitude",
        local_time(F.col("updateSec"), zone).alias("updateTime"),
        F.col("next.stopSequence").alias("nextStopSequence"),
        "nextStopId",
        F.col("stopName").alias("nextStopName"),
        F.col("next.approachSec").alias("nextStopApproachSec"),
        F.col("next.delay").alias("nextStopDelay"),
        local_time(epoch_of(ingested_at), zone).alias("ingestionTime"),
        "updateSec",
    )


def vehicle_board(
    vehicles: DataFrame,
    trips: DataFrame,
    trip_lookup: DataFrame,
    stop_lookup: DataFrame,
    *,
    as_of: int | Column | None = None,
    horizon_s: int = 150,
    zone: str = DEFAULT_ZONE,
    ingested_at: int | Column | None = None,
    sentinel: str | None = SENTINEL,
    **next_stop_options,
) -> DataFrame:
    """One row per fresh vehicle with its route and next stop.

    ``vehicles`` and ``trips`` are parsed events; keyed by ``id``. Only the
    updates of trips that fresh vehicles are on go further, out of a history of
    any size; execution measures whether these few keys can be sent to all.
    """
    state = vehicle_state(vehicles, as_of=as_of, horizon_s=horizon_s)
    # Updates become trip states before the join: where it shuffles them, stop lists stay behind.
    reduced = trip_state(trips, sentinel=sentinel, **next_stop_options)
    followed = reduced.join(state.select("tripId"), "tripId", "left_semi")
    return board_of_states(
        state,
        latest_by_key(followed, "tripId", _order(followed, "feedSec")),
        trip_lookup,
        stop_lookup,
        zone=zone,
        ingested_at=ingested_at,
        sentinel=sentinel,
    )


def stop_entries(
    trips: DataFrame,
    trip_lookup: DataFrame,
    *,
    as_of: int | Column | None = None,
    horizon_s: int | None = 150,
    zone: str = DEFAULT_ZONE,
    dedupe: bool = True,
    add_delay: bool = True,
    use_arrival: bool = False,
    page_s: int = PAGE_SECONDS,
    tasks: int | None = None,
) -> DataFrame:
    """One row per upcoming call of a known trip, with its ``page`` on the board.

    Past entries leave the arrays before they are exploded or shuffled. By
    default only the newest update of a trip counts; ``dedupe=False`` keeps all.
    The updates are dealt by trip to ``tasks`` tasks, which join them, take them
    apart and may count the entries; by default the session says how many. A
    caller with many updates should give a number in proportion to them, as a
    small update becomes many entries.
    """
    u = F.col("tripUpdate")
    calls = trips.select(
        F.col("id").alias("tripId"),
        u["timestamp"].alias("feedSec"),
        *_seq(trips),
        calls_of(u, add_delay=add_delay, use_arrival=use_arrival).alias("calls"),
    )
    if horizon_s is not None:
        calls = fresh(calls, "feedSec", horizon_s, as_of)
    if dedupe:
        calls = latest_by_key(calls, "tripId", _order(calls, "feedSec"))
        calls = calls.where(F.size("calls") > 0)
    if tasks is not None:
        calls = calls.repartition(tasks, "tripId")
    return entries_of_calls(calls, trip_lookup, zone=zone, page_s=page_s)


def entries_of_calls(
    calls: DataFrame,
    trip_lookup: DataFrame,
    *,
    zone: str = DEFAULT_ZONE,
    page_s: int = PAGE_SECONDS,
    also: Sequence[str] = (),
) -> DataFrame:
    """Board entries of (tripId, feedSec, calls) rows whose trip is known, with the columns ``also``.

    ``page`` numbers the stretch of ``page_s`` seconds in which the call arrives.
    """
    known = join_trips(calls, trip_lookup, "tripId", "inner")
    # The outer form with a filter on a field no call lacks: the plain one makes
    # the optimizer compute the lists a second time, for a test of their size.
    entries = known.select(
        F.col("tripId").alias("id"),
        "routeName",
        "tripHeadSign",
        F.col("feedSec").alias("updateSec"),
        local_time(F.col("feedSec"), zone).alias("updateTime"),
        *also,
        F.inline_outer("calls"),
    ).where(F.col("arrivalSec").isNotNull())
    return entries.select(
        "stopId",
        "updateTime",
        "updateSec",
        "id",
        "routeName",
        "tripHeadSign",
        local_time(F.col("arrivalSec"), zone).alias("arrivalTime"),
        "delay",
        page_of("arrivalSec", page_s).alias("page"),
        *also,
    )


def count_copies(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct entries per group with ``n``, how often each one occurs."""
    distinct = [*keys, *[c for c in _ENTRY if c != "n"]]
    return entries.groupBy(*distinct).agg(
        F.count("*").alias("n"), F.max("updateSec").alias("updateSec")
    )


def _board_of(
    counted: DataFrame, keys: list[str], stop_lookup: DataFrame, typed: bool
) -> DataFrame:
    # The lookup depends on the stop alone, so it is joined after grouping.
    lists = pack(counted, keys, _ENTRY, newest="updateSec")
    board = join_stops(lists, stop_lookup, "stopId", typed=typed)
    return board.select(
        "stopId",
        "stopName",
        "stopLat",
        "stopLon",
        *[k for k in keys if k not in ("stopId", "page")],
        "updateSec",
        "page",
        F.to_json("entries", {"ignoreNullFields": "false"}).alias("info"),
    )


def stop_board_groups(
    entries: DataFrame,
    stop_lookup: DataFrame,
    *,
    typed: bool = False,
) -> DataFrame:
    """Expected calls per stop, feed time and page, as a sorted JSON array ``info``.

    Equal entries are one element with their number ``n``.
    """
    keys = ["stopId", "updateTime", "page"]
    return _board_of(count_copies(entries, keys), keys, stop_lookup, typed)


def stop_board_latest(
    entries: DataFrame,
    stop_lookup: DataFrame,
    *,
    group_by_time: bool = True,
    zone: str = DEFAULT_ZONE,
    typed: bool = False,
) -> DataFrame:
    """The board by stop and page: of each stop's groups only the newest feed time.

    ``group_by_time=False`` lists all fresh trips of a stop together instead,
    each page with its own newest feed time.
    """
    if not group_by_time:
        keys = ["stopId", "page"]
        board = _board_of(count_copies(entries, keys), keys, stop_lookup, typed)
        return board.withColumn("updateTime", local_time(F.col("updateSec"), zone))
    return latest_of_counted(count_copies(entries, ["stopId", "updateTime", "page"]), stop_lookup, typed=typed)


def latest_of_counted(counted: DataFrame, stop_lookup: DataFrame, *, typed: bool = False) -> DataFrame:
    """``stop_board_latest`` of entries that are counted already (``count_copies`` by stop, feed time and page)."""
    keys = ["stopId", "updateTime"]
    # The filter drops nothing; using ``n`` here lets both uses of ``counted``
    # share one aggregate.
    newest = counted.where(F.col("n") > 0).groupBy("stopId").agg(
        F.max(F.struct("updateSec", "updateTime")).alias("_newest")
    )
    newest = newest.select("stopId", F.col("_newest.updateTime").alias("updateTime"))
    return board_of_counted(join_same(counted, newest, keys, "inner"), stop_lookup, typed=typed)


def board_of_counted(last: DataFrame, stop_lookup: DataFrame, *, typed: bool = False) -> DataFrame:
    """The pages of counted entries that are of their stop's newest feed time."""
    return _board_of(last, ["stopId", "updateTime", "page"], stop_lookup, typed)


def vehicle_archive(vehicles: DataFrame, *, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Every position event as a flat, wide row for analytics."""
    v = F.col("vehicle")
    return vehicles.select(
        "id",
        v["trip"]["tripId"].alias("tripId"),
        iso_date(v["trip"]["startDate"]).alias("startDate"),
        v["trip"]["routeId"].alias("routeId"),
        v["position"]["latitude"].alias("latitude"),
        v["position"]["longitude"].alias("longitude"),
        v["position"]["bearing"].alias("bearing"),
        local_time(v["timestamp"], zone).alias("updateTime"),
        v["vehicle"]["id"].alias("vehicleLabel"),
        v["occupancyStatus"].alias("occupancyStatus"),
        v["occupancyPercentage"].alias("occupancyPercentage"),
    )
