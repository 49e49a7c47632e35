"""Named queries of streams that run over several polls and keep what they have seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetboard import operators as O
from fleetboard import schemas as S
from fleetboard.operators import boards as B
from fleetboard.plans import feeds as V
from fleetboard.plans.queries import POS_HORIZON, POS_NOW, TRIP_HORIZON, TRIP_NOW, _doubles, query, stateful
from fleetboard.sinks import (
    RunTable, append_changes, read_board, read_changes, read_committed, with_counts, write_archive, write_committed,
)
from fleetboard.sources import entity_json, land_polls, parse_vehicle, read_polls, run_to_end, store_bucketed
from fleetboard.sources.ingest import CORRUPT
from fleetboard.streaming import (
    StopBoard,
    add_deltas,
    call_deltas,
    join_trip_stream,
    join_within,
    newest_match,
    only_changes,
    read_weights,
    sent_digests,
    shared_folder,
    vehicle_changes,
    with_expiry,
    with_ingestion_time,
)

# Days of a poll of positions, and how long a vehicle lives and rows may come late.
POLL_DAYS, TTL_S, LATE_S = 5, 86_400, 3_600
# Updates that belong to a position: from 6 hours before it to 1 hour after it.
BEFORE_S, AFTER_S = 6 * 3600, 3600
BUCKETS = 8


def day_poll(ts: str = "ts") -> Column:
    return ((F.dayofmonth(ts) - 1) / POLL_DAYS).cast("int")


def _polls(spark: SparkSession, root: str, name: str, rows: DataFrame, **options) -> DataFrame:
    """``rows`` landed by their column ``poll``, and read as a stream of polls."""
    land_polls(rows, f"{root}/{name}")
    return read_polls(spark, f"{root}/{name}", rows.schema, **options)


def _collected(spark: SparkSession, rows: DataFrame, root: str) -> DataFrame:
    """All batches of a stream, by their number in ``batch``."""
    run_to_end(
        rows.writeStream.outputMode("append")
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/rows/batch={n}"))
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    schema = rows.schema.add("batch", "long")
    return spark.read.schema(schema).parquet(f"{root}/rows")


@query
def replay_polls(spark: SparkSession, d: str) -> DataFrame:
    """Polls 1 to 3 of the positions replayed, two in a batch."""
    root = shared_folder(spark, "replay")
    rows = V.table(spark, d, "events").select("event_id", "user_id", day_poll().alias("poll"))
    stream = _polls(spark, root, "polls", rows, first=1, last=3, per_batch=2)
    return _collected(spark, stream, root).drop("batch")


@query
def stream_stop_weights(spark: SparkSession, d: str) -> DataFrame:
    """Calls of each trip's newest update counted by signed deltas, updates coming out of order."""
    root, own = shared_folder(spark, "weights"), stateful(spark)
    lineitem = V.table(own, d, "lineitem").withColumn("poll", (F.col("l_linenumber") * 5 % 3 / 2).cast("int"))
    updates = V.trip_updates(_polls(own, root, "polls", lineitem))
    deltas = call_deltas(updates, V.trip_lookup(own, d))
    run_to_end(
        deltas.writeStream.outputMode("append").foreachBatch(lambda batch, n: add_deltas(batch, f"{root}/deltas", n))
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    counted = read_weights(spark, f"{root}/deltas", deltas.schema)
    return O.fresh(counted, "updateSec", TRIP_HORIZON, TRIP_NOW).drop("page")


def _snapshots(events: DataFrame) -> DataFrame:
    """All vehicles as known at each poll, deletes (errors) too; the last poll comes twice."""
    polls = F.explode(F.sequence(day_poll(), F.lit(30 // POLL_DAYS)))
    seen = events.select("user_id", "event_id", "event_type", "value", polls.alias("poll"))
    newest = seen.groupBy("user_id", "poll").agg(F.max(F.struct("event_id", "event_type", "value")).alias("last"))
    value = F.when(F.col("last.event_type") != "error", F.to_json(F.struct("last.event_id", "last.value")))
    return newest.select(F.col("user_id").cast("string").alias("key"), value.alias("value"), "poll")


@query
def stream_board_changes(spark: SparkSession, d: str) -> DataFrame:
    """How many rows of whole boards, sent with every poll, really change something."""
    root, own = shared_folder(spark, "changes"), stateful(spark)
    stream = _polls(own, root, "polls", _snapshots(V.table(own, d, "events")))
    sent = _collected(spark, only_changes(stream, "poll"), root)
    return sent.groupBy(F.col("at").alias("poll"), "kind").agg(F.count("*").alias("n"))


@query
def redeployed_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same changes by two jobs: the second has its own checkpoint, and starts from the first one's state."""
    root, own = shared_folder(spark, "redeploy"), stateful(spark)
    snapshots = _snapshots(V.table(own, d, "events"))
    land_polls(snapshots, f"{root}/polls")
    schema = snapshots.schema
    first = read_polls(own, f"{root}/polls", schema, last=2)
    one = _collected(spark, only_changes(first, "poll"), f"{root}/one")
    then = read_polls(own, f"{root}/polls", schema, first=3)
    two = _collected(spark, only_changes(then, "poll", sent_digests(own, f"{root}/one/checkpoint")), f"{root}/two")
    return one.unionByName(two).groupBy(F.col("at").alias("poll"), "kind").agg(F.count("*").alias("n"))


@query
def maintained_vehicle_board(spark: SparkSession, d: str) -> DataFrame:
    """The vehicle board from three chained keyed states, each batch sending what it changes."""
    root, own = shared_folder(spark, "vehicles"), stateful(spark)
    events = V.table(own, d, "events").withColumn("poll", (F.dayofmonth("ts") / 16).cast("int"))
    lineitem = V.table(own, d, "lineitem").withColumn("poll", (F.col("l_linenumber") % 2).cast("int"))
    changes = vehicle_changes(
        V.positions(_polls(own, root, "positions", events)), V.trip_updates(_polls(own, root, "updates", lineitem)),
        V.trip_lookup(own, d), V.stop_lookup(own, d), vehicle_ttl_s=None, salts=1,
    )

    def send(batch: DataFrame, n: int) -> None:
        append_changes(with_ingestion_time(batch, POS_NOW).select("key", "value"), f"{root}/changes", n)

    run_to_end(changes.writeStream.outputMode("append").foreachBatch(send).option("checkpointLocation", f"{root}/checkpoint"))
    board = read_board(read_changes(spark, f"{root}/changes"), S.VEHICLE_BOARD)
    return _doubles(O.fresh(board, "updateSec", POS_HORIZON, POS_NOW), "latitude", "longitude")


@query
def maintained_stop_board(spark: SparkSession, d: str) -> DataFrame:
    """The stop board from signed deltas; each batch makes the pages of touched stops anew."""
    root, own = shared_folder(spark, "stops"), stateful(spark)
    lineitem = V.table(own, d, "lineitem").withColumn("poll", (F.col("l_linenumber") * 5 % 3 / 2).cast("int"))
    deltas = call_deltas(V.trip_updates(_polls(own, root, "polls", lineitem)), V.trip_lookup(own, d))
    board = StopBoard(
        V.stop_lookup(spark, d), root, lambda upserts, n: append_changes(upserts, f"{root}/changes", n), TRIP_HORIZON, TRIP_NOW
    )
    run_to_end(deltas.writeStream.outputMode("append").foreachBatch(board).option("checkpointLocation", f"{root}/checkpoint"))
    return read_board(read_changes(spark, f"{root}/changes"), S.STOP_BOARD)


@query
def levelled_changes(spark: SparkSession, d: str) -> DataFrame:
    """Each user's last event, deletes left out, from a change table whose batches merge by level."""
    root = shared_folder(spark, "levels")
    events = V.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("value"),
        F.col("event_id").alias("seq"), day_poll().alias("poll"),
    )
    table = RunTable(f"{root}/table", fan=2)
    run_to_end(
        _polls(spark, root, "polls", events).writeStream
        .foreachBatch(lambda batch, n: table(O.latest_by_key(batch, "key", "seq"), n))
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return table.read(spark)


@query
def stream_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Upserts of vehicles, and the deletes that timers send for those that fall silent."""
    root, own = shared_folder(spark, "expiry"), stateful(spark)
    events = V.table(own, d, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("value"),
        V.epoch_seconds(F.col("ts")).alias("seconds"), F.col("event_id").alias("seq"), day_poll().alias("poll"),
    )
    stream = _polls(own, root, "polls", events)
    return _collected(spark, with_expiry(stream, ttl_s=TTL_S, late_s=LATE_S), root).drop("batch")


@query
def stream_trip_join(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles with their trip state, followed from trip to trip; the last batch's row counts."""
    root, own = shared_folder(spark, "join"), stateful(spark)
    events = V.table(own, d, "events").withColumn("poll", (F.dayofmonth("ts") / 16).cast("int"))
    lineitem = V.table(own, d, "lineitem").withColumn("poll", (F.col("l_linenumber") % 2).cast("int"))
    vehicles = B.slim_positions(V.positions(_polls(own, root, "positions", events)))
    trips = O.trip_state(V.trip_updates(_polls(own, root, "updates", lineitem)))
    joined = join_trip_stream(vehicles, trips, salts=1, vehicle_ttl_s=POS_HORIZON * 40)
    newest = O.latest_by_key(_collected(spark, joined, root), "id", "batch")
    return newest.where("NOT gone").select(
        "id", "tripId", "updateSec", "feedSec", "startTime", "stopSequence", "stopId", "approachSec", "delay"
    )


@query
def stream_interval_join(spark: SparkSession, d: str) -> DataFrame:
    """Each even event with the newest odd one of its user in a bound around it."""
    root = shared_folder(spark, "interval")
    events = V.table(spark, d, "events").select(
        "event_id", "user_id", V.epoch_seconds(F.col("ts")).alias("at"), day_poll().alias("poll")
    )
    # Long after all others one row on each side, which lets the watermark pass them.
    last = events.agg(F.max("at").alias("at")).select(
        F.explode(F.array(F.lit(-2), F.lit(-1)).cast("array<bigint>")).alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"),
        (F.col("at") + 30 * 86_400).alias("at"), F.lit(30 // POLL_DAYS + 1).alias("poll"),
    )
    landed = events.unionByName(last)
    land_polls(landed, f"{root}/polls")

    def side(odd: bool, **names: str) -> DataFrame:
        rows = read_polls(spark, f"{root}/polls", landed.schema)
        return rows.where((F.col("event_id") % 2 != 0) == F.lit(odd)).select(*[F.col(c).alias(n) for n, c in names.items()])

    vehicles = side(False, id="event_id", tripId="user_id", updateSec="at").withColumns(
        {"id": F.col("id").cast("string"), "tripId": F.when(F.col("id").cast("long") % 10 != 0, F.col("tripId").cast("string"))}
    )
    trips = side(True, tripId="user_id", feedSec="at", tripSeq="event_id").withColumn("tripId", F.col("tripId").cast("string"))
    joined = join_within(vehicles, trips, before_s=BEFORE_S, after_s=AFTER_S, late_s=LATE_S)
    rows = _collected(spark, joined, root).where("CAST(id AS BIGINT) >= 0").drop("batch")
    return newest_match(rows, "id", ("feedSec", "tripSeq")).select("id", "tripId", "updateSec", "feedSec", "tripSeq")


@query
def committed_archive(spark: SparkSession, d: str) -> DataFrame:
    """Polls archived batch by batch, each committed as a whole, and read by their manifests."""
    root = shared_folder(spark, "committed")
    rows = V.table(spark, d, "events").select("event_id", "user_id", "event_type", day_poll().alias("poll"))
    stream = _polls(spark, root, "polls", rows, per_batch=2)
    run_to_end(
        stream.writeStream.foreachBatch(lambda batch, n: write_committed(batch, f"{root}/archive", n))
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return read_committed(spark, f"{root}/archive", rows.schema)


@query
def ingest_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the job that archives the parsed positions saw on its way: one scan, one row."""
    events = V.positions(V.table(spark, d, "events"))
    text = entity_json(events, "id", "vehicle")
    cut = F.when(F.col("seq") % 5 == 0, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    parsed = parse_vehicle(events.select("seq", cut.alias("value")))
    rows, seen = with_counts(parsed, F.col("vehicle.timestamp"), horizon_s=POS_HORIZON, as_of=POS_NOW)
    board = rows.where(F.col(CORRUPT).isNull())
    write_archive(O.vehicle_archive(board), f"{shared_folder(spark, 'counted')}/archive")
    return spark.createDataFrame([seen.get], "rows long, corrupt long, fresh long, late long, newest long, oldest long")


@query
def bucketed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Positions and the trips lookup stored by trip, joined where they lie."""
    root = shared_folder(spark, "bucketed")
    positions = B.slim_positions(V.positions(V.table(spark, d, "events"))).select("tripId", "id", "seq")
    lookup = V.trip_lookup(spark, d)
    stored = store_bucketed(positions, f"{root}/positions", "tripId", BUCKETS)
    trips = store_bucketed(lookup, f"{root}/trips", "trip_id", BUCKETS)
    return O.join_trips(stored, trips, "tripId", "inner").select("tripId", "seq", "id", "shapeId", "routeName", "tripHeadSign")
