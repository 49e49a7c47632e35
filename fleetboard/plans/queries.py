"""Named queries over the driver tables; ``oracle.py`` holds their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetboard import schemas as S
from fleetboard.functions import eta_minutes, iso_date, local_time
from fleetboard.functions.transit import MAX_LOOKAHEAD, SENTINEL
from fleetboard import operators as O
from fleetboard.operators import boards as B
from fleetboard.plans import feeds as V
from fleetboard.sinks import append_changes, read_board, read_changes, to_upsert, write_archive
from fleetboard.sources import (
    entity_json,
    explode_feed,
    parse_trip_update,
    parse_vehicle,
    read_stop_lookup,
    read_trip_lookup,
    split_corrupt,
    with_rowtime,
)
from fleetboard.streaming import (
    BoardJob,
    relay,
    run_boards,
    shared_folder,
    write_latest,
)

# "Now" and horizon of the vehicle queries (events end 2024-01-30).
POS_NOW, POS_HORIZON = 1706659200, 86400
# "Now" and horizon of the trip queries (line items end 2001-11-04).
TRIP_NOW, TRIP_HORIZON = 1004918400, 400 * 86400

# Trip updates of one task of a stop board, so that more of them make more tasks, not larger ones.
UPDATES_PER_TASK = 100_000

# The vehicle a user has picked on the map.
SELECTED = "2"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stateful(spark: SparkSession) -> SparkSession:
    """A session of its own with the state store that keyed states need."""
    own = spark.newSession()
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    return own


def _positions(spark: SparkSession, d: str, newer_than: int | None = None) -> DataFrame:
    events = V.table(spark, d, "events")
    if newer_than is not None:
        events = events.where(V.since("ts", newer_than))
    return V.positions(events)


def _updates(spark: SparkSession, d: str, newer_than: int | None = None) -> DataFrame:
    lineitem = V.table(spark, d, "lineitem")
    if newer_than is not None:
        lineitem = lineitem.where(V.feed_time() > newer_than)
    return V.trip_updates(lineitem)


def _fresh_positions(spark: SparkSession, d: str) -> DataFrame:
    return _positions(spark, d, POS_NOW - POS_HORIZON)


def _fresh_updates(spark: SparkSession, d: str) -> DataFrame:
    return _updates(spark, d, TRIP_NOW - TRIP_HORIZON)


def _entries(spark: SparkSession, d: str, **options) -> DataFrame:
    updates = V.table(spark, d, "lineitem").count()  # from the file footers
    return O.stop_entries(
        _fresh_updates(spark, d),
        V.trip_lookup(spark, d),
        as_of=TRIP_NOW,
        horizon_s=TRIP_HORIZON,
        tasks=max(1, -(-updates // UPDATES_PER_TASK)),
        **options,
    )


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _position_columns() -> list[Column]:
    v = F.col("vehicle")
    return [
        F.col("id"),
        v["trip"]["tripId"].alias("tripId"),
        v["trip"]["startDate"].alias("startDate"),
        v["position"]["latitude"].cast("double").alias("latitude"),
        v["timestamp"].alias("updateSec"),
        v["vehicle"]["label"].alias("label"),
        v["occupancyPercentage"].cast("bigint").alias("occupancyPercentage"),
        F.col("seq"),
    ]


# ---- ingest


@query
def parse_vehicle_json(spark: SparkSession, d: str) -> DataFrame:
    events = _positions(spark, d)
    messages = events.select("seq", entity_json(events, "id", "vehicle").alias("value"))
    return parse_vehicle(messages).select(*_position_columns())


@query
def parse_trip_json(spark: SparkSession, d: str) -> DataFrame:
    updates = _updates(spark, d)
    messages = updates.select("seq", entity_json(updates, "id", "tripUpdate").alias("value"))
    u = F.col("tripUpdate")
    first = F.get(u["stopTimeUpdate"], F.lit(0))
    return parse_trip_update(messages).select(
        "id",
        u["timestamp"].alias("feedSec"),
        "seq",
        u["trip"]["startTime"].alias("startTime"),
        F.size(u["stopTimeUpdate"]).cast("bigint").alias("stops"),
        first["stopId"].alias("firstStop"),
        first["stopSequence"].alias("firstSequence"),
    )


@query
def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Messages cut short, or with unnamed keys, are set aside; others pass."""
    events = _positions(spark, d)
    text = entity_json(events, "id", "vehicle")
    broken = F.col("seq") % 5
    value = (
        F.when(broken == 0, F.substr(text, F.lit(1), F.length(text) - 1))
        .when(broken == 1, F.replace(text, F.lit('"latitude"'), F.lit('"lat"')))
        .otherwise(text)
    )
    good, bad = split_corrupt(parse_vehicle(events.select("seq", value.alias("value")), mode="strict"))
    return (
        good.select("seq", F.lit("good").alias("fate"))
        .unionByName(bad.select("seq", F.lit("bad").alias("fate")))
    )


@query
def explode_feed_messages(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of 0 to 4 entities, one per event, as keyed messages."""
    entity = F.transform(
        F.slice(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 5), 1, (F.col("event_id") % 5).cast("int")),
        lambda i: F.struct(
            (F.col("user_id") + i).cast("string").alias("id"),
            F.struct(F.col("event_id").cast("string").alias("timestamp")).alias("vehicle"),
        ),
    )
    snapshots = V.table(spark, d, "events").select(
        F.to_json(F.struct(entity.alias("entity"))).alias("value")
    )
    return explode_feed(snapshots)[0]


@query
def explode_feed_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of two entities, every fifth cut short: how many messages each gives, and which are bad."""
    events = V.table(spark, d, "events")
    entity = F.concat(F.lit('{"id":"'), F.col("user_id").cast("string"), F.lit('"}'))
    text = F.concat(F.lit('{"entity":['), entity, F.lit(","), entity, F.lit("]}"))
    cut = F.when(F.col("event_id") % 5 == 0, F.substr(text, F.lit(1), F.length(text) - 3)).otherwise(text)
    good, bad = explode_feed(events.select(F.col("event_id").alias("seq"), cut.alias("value")))
    counted = good.groupBy("seq").agg(F.count("*").alias("messages"), F.lit("good").alias("fate"))
    return counted.unionByName(bad.select("seq", F.lit(0).cast("bigint").alias("messages"), F.lit("bad").alias("fate")))


def _written(spark: SparkSession, purpose: str, name: str) -> str:
    return f"{shared_folder(spark, purpose)}/{name}"


def _with_columns_of(df: DataFrame, names: list[str]) -> DataFrame:
    absent = F.lit(None).cast("string")
    return df.select(*[(F.col(n) if n in df.columns else absent).alias(n) for n in names])


@query
def lookup_csv(spark: SparkSession, d: str) -> DataFrame:
    """Lookups through CSV files: trips by position, stops by header names in another order."""
    trips, stops = (_written(spark, "lookups", n) for n in ("trips", "stops"))
    _with_columns_of(V.trip_lookup(spark, d), S.TRIP_LOOKUP.names).write.csv(trips)
    turned = _with_columns_of(V.stop_lookup(spark, d), S.STOP_LOOKUP.names[::-1])
    turned.write.option("header", True).csv(stops)
    of_trips = read_trip_lookup(spark, trips).select(
        F.lit("trip").alias("kind"), F.col("trip_id").alias("id"), F.col("trip_headsign").alias("name"), F.col("shape_id").alias("more")
    )
    of_stops = read_stop_lookup(spark, stops, header=True).select(
        F.lit("stop").alias("kind"), F.col("stop_id").alias("id"), F.col("stop_name").alias("name"), F.col("stop_lat").alias("more")
    )
    return of_trips.unionByName(of_stops)


@query
def latest_vehicle(spark: SparkSession, d: str) -> DataFrame:
    slim = _positions(spark, d).select(*_position_columns())
    return O.latest_by_key(slim, "id", ["updateSec", "seq"])


@query
def latest_trip_update(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("tripUpdate")
    slim = _updates(spark, d).select(
        "id",
        u["timestamp"].alias("feedSec"),
        "seq",
        u["trip"]["startTime"].alias("startTime"),
        F.size(u["stopTimeUpdate"]).cast("bigint").alias("stops"),
    )
    return O.latest_by_key(slim, "id", ["feedSec", "seq"])


# ---- joins, filters, next stop


def _lookup(spark: SparkSession, d: str, how: str) -> DataFrame:
    slim = _positions(spark, d).select("seq", "id", F.col("vehicle.trip.tripId").alias("tripId"))
    return O.join_trips(slim, V.trip_lookup(spark, d), "tripId", how)


@query
def lookup_trips_left(spark: SparkSession, d: str) -> DataFrame:
    return _lookup(spark, d, "left")


@query
def lookup_trips_inner(spark: SparkSession, d: str) -> DataFrame:
    return _lookup(spark, d, "inner")


@query
def trip_stop_entries(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("tripUpdate")
    call = F.col("col")
    return (
        _updates(spark, d)
        .select("id", u["timestamp"].alias("feedSec"), "seq", F.posexplode_outer(u["stopTimeUpdate"]))
        .where(F.col("pos").isNotNull())
        .select(
            "id",
            "feedSec",
            "seq",
            (F.col("pos") + 1).cast("bigint").alias("idx"),
            call["stopId"].alias("stopId"),
            call["departure"]["time"].cast("bigint").alias("departureSec"),
            call["arrival"]["time"].cast("bigint").alias("arrivalSec"),
            call["departure"]["delay"].alias("delay"),
        )
    )


@query
def upcoming_stops(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("tripUpdate")
    return _updates(spark, d).select(
        "id", u["timestamp"].alias("feedSec"), "seq", F.inline(O.calls_of(u))
    )


@query
def next_stop(spark: SparkSession, d: str) -> DataFrame:
    return O.latest_trip_state(_updates(spark, d)).select(
        F.col("tripId").alias("id"), "startTime", "feedSec", "next.*"
    )


@query
def next_stop_first20(spark: SparkSession, d: str) -> DataFrame:
    """The next stop among the first 20 entries only."""
    return O.latest_trip_state(_updates(spark, d), max_lookahead=MAX_LOOKAHEAD).select(
        F.col("tripId").alias("id"), "startTime", "feedSec", "next.*"
    )


@query
def next_stop_options(spark: SparkSession, d: str) -> DataFrame:
    """All options away from their defaults."""
    state = O.trip_state(
        _updates(spark, d),
        sentinel=None,
        null_delay_as_zero=True,
        use_arrival=True,
        delay_of="chosen",
    )
    return state.select(F.col("tripId").alias("id"), "feedSec", "seq", "next.*")


@query
def next_stop_names(spark: SparkSession, d: str) -> DataFrame:
    state = O.latest_trip_state(_updates(spark, d)).select(
        F.col("tripId").alias("id"), F.col("next.stopId").alias("stopId")
    )
    return O.join_stops(state, V.stop_lookup(spark, d), "stopId", spread=SENTINEL).select("id", "stopId", "stopName")


@query
def fresh_vehicles(spark: SparkSession, d: str) -> DataFrame:
    slim = _fresh_positions(spark, d).select(*_position_columns())
    return O.fresh(slim, "updateSec", POS_HORIZON, POS_NOW)


@query
def fresh_trips(spark: SparkSession, d: str) -> DataFrame:
    slim = _fresh_updates(spark, d).select(
        "id", F.col("tripUpdate.timestamp").alias("feedSec"), "seq"
    )
    return O.fresh(slim, "feedSec", TRIP_HORIZON, TRIP_NOW)


@query
def local_times(spark: SparkSession, d: str) -> DataFrame:
    sec = F.col("vehicle.timestamp")
    return _positions(spark, d).select(
        "seq",
        local_time(sec).alias("chicago"),
        local_time(sec + F.col("seq") * 3600, "Europe/Berlin").alias("berlin"),
    )


@query
def start_dates(spark: SparkSession, d: str) -> DataFrame:
    """Start dates, every third one damaged."""
    text = F.date_format("ts", "yyyyMMdd")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.substr(text, F.lit(1), F.lit(7)), F.lit("x"))).otherwise(text)
    return V.table(spark, d, "events").select("event_id", iso_date(text).alias("startDate"))


@query
def service_hours(spark: SparkSession, d: str) -> DataFrame:
    slim = _positions(spark, d).select("seq", F.col("vehicle.timestamp").alias("updateSec"))
    return O.within_service_hours(slim, "updateSec")


# ---- boards


def _vehicle_board(spark: SparkSession, d: str, **options) -> DataFrame:
    return O.vehicle_board(
        _fresh_positions(spark, d),
        _updates(spark, d),
        V.trip_lookup(spark, d),
        V.stop_lookup(spark, d),
        as_of=POS_NOW,
        horizon_s=POS_HORIZON,
        ingested_at=POS_NOW,
        **options,
    )


@query
def vehicle_board(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(_vehicle_board(spark, d), "latitude", "longitude")


@query
def stop_board_groups(spark: SparkSession, d: str) -> DataFrame:
    return O.stop_board_groups(_entries(spark, d), V.stop_lookup(spark, d))


@query
def stop_board_latest(spark: SparkSession, d: str) -> DataFrame:
    return O.stop_board_latest(_entries(spark, d), V.stop_lookup(spark, d))


@query
def stop_board_merged(spark: SparkSession, d: str) -> DataFrame:
    """All fresh trips of a stop in one list."""
    return O.stop_board_latest(_entries(spark, d), V.stop_lookup(spark, d), group_by_time=False)


@query
def stop_board_multiplicity(spark: SparkSession, d: str) -> DataFrame:
    """Board entries with copies counted, every update of a trip included."""
    return O.count_copies(_entries(spark, d, dedupe=False), ["stopId", "updateTime"])


@query
def archive_by_date(spark: SparkSession, d: str) -> DataFrame:
    """The archive written by service date and read back."""
    path = _written(spark, "archive", "rows")
    write_archive(O.vehicle_archive(_positions(spark, d)), path)
    return spark.read.parquet(path).select(
        "id", "tripId", F.col("startDate").cast("string").alias("startDate"), "updateTime", "occupancyStatus"
    )


@query
def vehicle_archive(spark: SparkSession, d: str) -> DataFrame:
    board = _doubles(O.vehicle_archive(_positions(spark, d)), "latitude", "longitude", "bearing")
    return board.withColumn("occupancyPercentage", F.col("occupancyPercentage").cast("bigint"))


# ---- serving


def _history(spark: SparkSession, d: str) -> DataFrame:
    events = V.table(spark, d, "events")
    row = F.to_json(F.struct("event_id", "value"))
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") != "error", row).alias("value"),
        F.col("event_id").alias("seq"),
    )


@query
def compact_topic(spark: SparkSession, d: str) -> DataFrame:
    """Last write per key; deletes are the NULL values."""
    live = O.compact(_history(spark, d), "key", "seq")
    return live.select("key", "seq", F.get_json_object("value", "$.event_id").alias("event_id"))


def _live(spark: SparkSession, d: str) -> DataFrame:
    slim = _fresh_positions(spark, d).select(*_position_columns())
    return O.live_vehicles(slim, as_of=POS_NOW, ttl_s=POS_HORIZON - 1)


@query
def live_vehicles(spark: SparkSession, d: str) -> DataFrame:
    return _live(spark, d)


@query
def roster(spark: SparkSession, d: str) -> DataFrame:
    return O.roster(_vehicle_board(spark, d))


@query
def eta_of_trips(spark: SparkSession, d: str) -> DataFrame:
    state = O.latest_trip_state(_updates(spark, d))
    return state.select(
        F.col("tripId").alias("id"),
        eta_minutes(F.col("next.approachSec")).alias("etaMinutes"),
        eta_minutes(F.col("next.approachSec"), null_as_zero=False).alias("etaOrNull"),
    )


@query
def feed_status(spark: SparkSession, d: str) -> DataFrame:
    board = _live(spark, d).withColumn("updateTime", local_time(F.col("updateSec")))
    return O.feed_status(board)


@query
def trip_stop_lists(spark: SparkSession, d: str) -> DataFrame:
    lists = O.trip_stop_lists(V.stop_times(spark, d))
    return lists.select(
        "trip_id", "page", F.array_join("stop_ids", ",").alias("stop_ids"), F.to_json("stops").alias("stops")
    )


@query
def route_shapes(spark: SparkSession, d: str) -> DataFrame:
    return O.route_shapes(V.shapes(spark, d)).select(
        "shape", "page", F.array_join(_points("path"), " ").alias("path"), "feature"
    )


def _points(path: str) -> Column:
    return F.transform(
        path, lambda p: F.concat_ws(",", p[0].cast("bigint").cast("string"), p[1].cast("bigint").cast("string"))
    )


def _placed_vehicles(spark: SparkSession, d: str) -> DataFrame:
    """Fresh vehicles with their route, without the next stop."""
    state = O.vehicle_state(_fresh_positions(spark, d), as_of=POS_NOW, horizon_s=POS_HORIZON)
    return O.join_trips(state, V.trip_lookup(spark, d), "tripId")


@query
def routes_in_use(spark: SparkSession, d: str) -> DataFrame:
    routes = O.routes_in_use(_placed_vehicles(spark, d), V.shapes(spark, d))
    return routes.select("shape", "page", F.array_join(_points("path"), " ").alias("path"))


@query
def vehicle_route(spark: SparkSession, d: str) -> DataFrame:
    routes = O.vehicle_route(_placed_vehicles(spark, d), V.shapes(spark, d), SELECTED)
    return routes.select("id", "shape", "page", F.array_join(_points("path"), " ").alias("path"))


@query
def flag_trip_stops(spark: SparkSession, d: str) -> DataFrame:
    stops = V.stop_lookup(spark, d).select("stop_id", "stop_name")
    return O.flag_trip_stops(stops, V.stop_times(spark, d), _placed_vehicles(spark, d), SELECTED)


@query
def board_upserts(spark: SparkSession, d: str) -> DataFrame:
    """The vehicle board through its sink form: JSON with NULLs, and back."""
    upserts = to_upsert(_vehicle_board(spark, d), "id").withColumn("batch", F.lit(0))
    return _doubles(read_board(upserts, S.VEHICLE_BOARD), "latitude", "longitude")


# ---- streams


def _change_sink(path: str):
    return lambda upserts, batch_id: append_changes(upserts, path, batch_id)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds as one stream of (topic, value, seq) JSON messages."""
    positions = V.positions(V.table_stream(spark, d, "events"))
    updates = V.trip_updates(V.table_stream(spark, d, "lineitem"))
    return positions.select(
        F.lit("VehiclePositions").alias("topic"),
        entity_json(positions, "id", "vehicle").alias("value"),
        "seq",
    ).unionByName(
        updates.select(
            F.lit("TripUpdates").alias("topic"),
            entity_json(updates, "id", "tripUpdate").alias("value"),
            "seq",
        )
    )


def _replay(
    spark: SparkSession, d: str, as_of: int, horizon_s: int, messages: DataFrame | None = None
) -> str:
    """Run both boards over all messages; the folder with their changes."""
    messages = _messages(spark, d) if messages is None else messages
    root = shared_folder(spark, "boards")
    job = BoardJob(
        trip_lookup=V.trip_lookup(spark, d),
        stop_lookup=V.stop_lookup(spark, d),
        state_dir=f"{root}/state",
        vehicle_sink=_change_sink(f"{root}/vehicles"),
        stop_sink=_change_sink(f"{root}/stops"),
        as_of=as_of,
        ingested_at=as_of,
        horizon_s=horizon_s,
    )
    done = {"availableNow": True}
    run_boards(messages, job, f"{root}/checkpoint", trigger=done).awaitTermination()
    return root


@query
def stream_vehicle_board(spark: SparkSession, d: str) -> DataFrame:
    root = _replay(spark, d, POS_NOW, POS_HORIZON)
    board = read_board(read_changes(spark, f"{root}/vehicles"), S.VEHICLE_BOARD)
    return _doubles(board, "latitude", "longitude")


@query
def stream_stop_board(spark: SparkSession, d: str) -> DataFrame:
    root = _replay(spark, d, TRIP_NOW, TRIP_HORIZON)
    board = read_board(read_changes(spark, f"{root}/stops"), S.STOP_BOARD)
    return board


@query
def snapshot_to_boards(spark: SparkSession, d: str) -> DataFrame:
    """From landed snapshots to the vehicle board: each event is the one entity of a snapshot."""
    snapshots = _messages(spark, d).withColumn(
        "value", F.concat(F.lit('{"header":{},"entity":['), "value", F.lit("]}"))
    )
    messages, _ = explode_feed(snapshots)
    root = _replay(spark, d, POS_NOW, POS_HORIZON, messages)
    board = read_board(read_changes(spark, f"{root}/vehicles"), S.VEHICLE_BOARD)
    return _doubles(board, "latitude", "longitude")


@query
def relay_rows(spark: SparkSession, d: str) -> DataFrame:
    """The live vehicles' upserts handed on by the relay."""
    root = shared_folder(spark, "relay")
    live = _live(spark, d)
    gone = live.select(F.col("id").alias("key"), F.lit(None).cast("string").alias("value"))
    to_upsert(live, "id").unionByName(gone).write.parquet(f"{root}/upserts")
    stream = spark.readStream.schema("key string, value string").parquet(f"{root}/upserts")
    sent = f"{root}/sent"
    relay(
        stream, live.schema, lambda rows: rows.write.mode("append").parquet(sent), f"{root}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    return spark.read.schema(live.schema).parquet(sent)


@query
def stream_live_vehicles(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark, "live")
    slim = V.positions(V.table_stream(spark, d, "events")).select(*_position_columns())
    write_latest(
        slim, "id", ["updateSec", "seq"], _change_sink(f"{root}/live"), f"{root}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    board = read_board(read_changes(spark, f"{root}/live"), slim.schema)
    return O.live_vehicles(board, as_of=POS_NOW, ttl_s=POS_HORIZON - 1)


@query
def stream_stop_counts(spark: SparkSession, d: str) -> DataFrame:
    """Board entries counted by a streaming aggregate, one state row per entry.

    The watermark trails the newest feed time by the horizon: a state row goes
    when its feed time is no longer fresh, which is when its entries are no
    longer accepted either. The state lies on disk: in memory, which is the
    default, a row for each of very many entries leaves no room for the work.
    """
    root, own = shared_folder(spark, "counts"), stateful(spark)
    # Counting the store's rows would look up each one before it is written.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    updates = V.trip_updates(V.table_stream(own, d, "lineitem"))
    entries = O.stop_entries(
        updates, V.trip_lookup(own, d), as_of=TRIP_NOW, horizon_s=TRIP_HORIZON, dedupe=False
    )
    entries = with_rowtime(entries, "updateSec", f"{TRIP_HORIZON} seconds")
    counted = O.count_copies(entries, ["stopId", "updateTime", "rowtime"])
    key = F.to_json(F.struct(*[c for c in counted.columns if c not in ("n", "updateSec")]))
    sink = _change_sink(f"{root}/counts")
    (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: sink(to_upsert(batch, key), batch_id))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    rows = read_board(read_changes(spark, f"{root}/counts"), counted.schema).drop("rowtime")
    # Two feed times share their local text when clocks go back.
    same = [c for c in rows.columns if c not in ("n", "updateSec")]
    return rows.groupBy(*same).agg(F.sum("n").alias("n"), F.max("updateSec").alias("updateSec"))
