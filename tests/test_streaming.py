import json
import random

import pytest
from feeds import NOW, stop, stop_lookup, trip_lookup, trip_update, vehicle
from pyspark.sql import functions as F

from fleetboard import operators as O
from fleetboard import schemas as S
from fleetboard.operators import boards as B
from fleetboard.sinks import append_changes, read_board, read_changes
from fleetboard.sources import explode_feed, parse_trip_update, parse_vehicle, with_rowtime
from fleetboard.streaming import (
    BoardJob,
    join_trip_stream,
    print_messages,
    relay,
    run_boards,
    shared_folder,
    write_latest,
)

NOW_DONE = {"availableNow": True}


def _events():
    """Shuffled positions and updates; vehicles change trips, some match nothing."""
    rng = random.Random(7)
    out = []
    for i in range(120):
        trip = None if i % 11 == 0 else f"T{rng.randrange(6)}"
        out.append(("VehiclePositions", vehicle(f"v{rng.randrange(15)}", trip, NOW - rng.randrange(200)), i))
    for i in range(60):
        ts = NOW - rng.randrange(200)
        stops = [
            stop(j, f"s{rng.randrange(8)}", ts + rng.randrange(-90, 300), rng.choice([None, -30, 40]))
            for j in range(rng.randrange(6))
        ]
        out.append(("TripUpdates", trip_update(f"T{rng.randrange(6)}", stops, ts), 1000 + i))
    rng.shuffle(out)
    return out


def _lookups(spark):
    trips = [(f"T{i}", str(700 + i), f"r{i}", f"h{i}") for i in range(5)]
    stops = [(f"s{i}", f"Stop {i}") for i in range(6)]
    return trip_lookup(spark, *trips), stop_lookup(spark, *stops)


def _landed(events, folder, files):
    """The messages as JSON lines, in files that become one micro-batch each."""
    import os
    import time

    os.makedirs(folder)
    size = -(-len(events) // files)
    for n in range(files):
        path = f"{folder}/{n}.json"
        with open(path, "w") as f:
            for topic, event, seq in events[n * size : (n + 1) * size]:
                f.write(json.dumps({"topic": topic, "value": json.dumps(event) if isinstance(event, dict) else event, "seq": seq}) + "\n")
        at = time.time() - 1000 + n
        os.utime(path, (at, at))
    return folder


_WIRE = "topic string, value string, seq bigint"


def _stream(spark, folder):
    return spark.readStream.schema(_WIRE).option("maxFilesPerTrigger", 1).json(folder)


def _job(spark, root, **options):
    trips, stops = _lookups(spark)
    return BoardJob(
        trip_lookup=trips,
        stop_lookup=stops,
        state_dir=f"{root}/state",
        vehicle_sink=lambda u, b: append_changes(u, f"{root}/vehicles", b),
        stop_sink=lambda u, b: append_changes(u, f"{root}/stops", b),
        **{"as_of": NOW, "ingested_at": NOW, **options},
    )


def _batch_boards(spark, folder):
    read = spark.read.schema(_WIRE).json(folder)
    positions = parse_vehicle(read.where("topic = 'VehiclePositions'"))
    updates = parse_trip_update(read.where("topic = 'TripUpdates'"))
    trips, stops = _lookups(spark)
    vehicles = O.vehicle_board(positions, updates, trips, stops, as_of=NOW, ingested_at=NOW)
    return vehicles, O.stop_board_latest(O.stop_entries(updates, trips, as_of=NOW), stops)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order", [1, 2])
def test_boards_over_micro_batches_equal_the_batch_boards(spark, workdir, order):
    events = _events()
    random.Random(order).shuffle(events)
    folder = _landed(events, f"{workdir}/in", 5)
    run_boards(
        _stream(spark, folder), _job(spark, workdir), f"{workdir}/ck", trigger=NOW_DONE
    ).awaitTermination()
    vehicles, stops = _batch_boards(spark, folder)
    got = read_board(read_changes(spark, f"{workdir}/vehicles"), S.VEHICLE_BOARD)
    assert read_changes(spark, f"{workdir}/vehicles").select("batch").distinct().count() == 5
    assert _sorted(got.select(*vehicles.columns)) == _sorted(vehicles)
    assert any(r.nextStopId != "0" for r in vehicles.collect())
    # Stops that lost their last entry were deleted on the way.
    got = read_board(read_changes(spark, f"{workdir}/stops"), S.STOP_BOARD)
    assert _sorted(got.select(*stops.columns)) == _sorted(stops)


def test_a_repeated_batch_changes_nothing(spark, workdir):
    events = _events()
    folder = _landed(events, f"{workdir}/in", 3)
    job = _job(spark, workdir)
    parts = [spark.read.schema(_WIRE).json(f"{folder}/{n}.json") for n in range(3)]
    for n in (0, 1, 1, 2, 2):
        job.run_batch(parts[n], n)
    vehicles, stops = _batch_boards(spark, folder)
    got = read_board(read_changes(spark, f"{workdir}/vehicles"), S.VEHICLE_BOARD)
    assert _sorted(got.select(*vehicles.columns)) == _sorted(vehicles)
    got = read_board(read_changes(spark, f"{workdir}/stops"), S.STOP_BOARD)
    assert _sorted(got.select(*stops.columns)) == _sorted(stops)


def test_a_restarted_job_goes_on_from_its_checkpoint(spark, workdir):
    events = _events()
    folder = _landed(events[:90], f"{workdir}/in", 2)
    for _ in range(2):
        run_boards(
            _stream(spark, folder), _job(spark, workdir), f"{workdir}/ck", trigger=NOW_DONE
        ).awaitTermination()
        more = _landed(events[90:], f"{workdir}/more-{_}", 1)
        import shutil

        shutil.copy(f"{more}/0.json", f"{folder}/late.json")
    vehicles, _stops = _batch_boards(spark, folder)
    got = read_board(read_changes(spark, f"{workdir}/vehicles"), S.VEHICLE_BOARD)
    assert _sorted(got.select(*vehicles.columns)) == _sorted(vehicles)


def test_malformed_messages_do_not_stop_the_boards(spark, workdir):
    events = [("VehiclePositions", '{"id": "v", ', 1), ("VehiclePositions", vehicle("w", None), 2)]
    events += [("Odd", "text", 3), (None, "text", 4)]
    folder = _landed(events, f"{workdir}/in", 1)
    run_boards(
        _stream(spark, folder), _job(spark, workdir), f"{workdir}/ck", trigger=NOW_DONE
    ).awaitTermination()
    bad = spark.read.parquet(f"{workdir}/state/corrupt/batch=0").collect()
    want = [("VehiclePositions", '{"id": "v", '), ("Odd", "text"), (None, "text")]
    assert sorted(map(tuple, bad), key=repr) == sorted(want, key=repr)
    assert read_changes(spark, f"{workdir}/vehicles").count() == 1


def test_old_trips_can_be_forgotten(spark, workdir):
    events = [("TripUpdates", trip_update("T1", [], NOW - 100), 1), ("TripUpdates", trip_update("T2", [], NOW - 10), 2)]
    folder = _landed(events, f"{workdir}/in", 1)
    job = _job(spark, workdir, trip_retention_s=50)
    run_boards(_stream(spark, folder), job, f"{workdir}/ck", trigger=NOW_DONE).awaitTermination()
    assert [r.tripId for r in spark.read.parquet(f"{workdir}/state/trips").collect()] == ["T2"]


def _files(folder):
    import os

    return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_batch_writes_only_the_buckets_that_it_changes(spark, workdir):
    job = _job(spark, workdir, horizon_s=1000)
    first = [("TripUpdates", trip_update(f"T{i}", [], NOW - 10), i) for i in range(40)]
    rows = lambda events: spark.createDataFrame([(t, json.dumps(e), n) for t, e, n in events], _WIRE)
    job.run_batch(rows(first), 0)
    before = _files(f"{workdir}/state/trips")
    job.run_batch(rows([("TripUpdates", trip_update("T3", [], NOW), 99)]), 1)
    after = _files(f"{workdir}/state/trips")
    assert len(before) > 8 and {f: after[f] for f in before} == before and len(after) == len(before) + 1


def test_calls_leave_the_state_with_their_freshness_but_trips_stay(spark, workdir):
    old = trip_update("T1", [stop(1, "s1", NOW + 50)], NOW - 500)
    new = trip_update("T2", [stop(1, "s1", NOW + 50)], NOW - 5)
    job = _job(spark, workdir)
    job.run_batch(spark.createDataFrame([("TripUpdates", json.dumps(e), i) for i, e in enumerate((old, new))], _WIRE), 0)
    rows = {r.tripId: r.calls for r in spark.read.parquet(f"{workdir}/state/trips").collect()}
    assert rows["T1"] is None and len(rows["T2"]) == 1


def test_expired_vehicles_are_deleted_from_the_streamed_board(spark, workdir):
    job = _job(spark, workdir)
    row = lambda v, at, n: spark.createDataFrame([("VehiclePositions", json.dumps(vehicle(v, None, at)), n)], _WIRE)
    job.run_batch(row("v", NOW - 10, 1), 0)
    job.as_of = NOW + 145
    job.run_batch(row("w", NOW + 140, 2), 1)
    board = read_board(read_changes(spark, f"{workdir}/vehicles"), S.VEHICLE_BOARD)
    assert [r.id for r in board.collect()] == ["w"]


def test_a_batch_without_a_next_stop_value_agrees_with_the_batch_board(spark, workdir):
    job = _job(spark, workdir, next_stop_options={"sentinel": None})
    events = [("VehiclePositions", vehicle("v", "T1"), 1), ("VehiclePositions", vehicle("w", "T9"), 2), ("TripUpdates", trip_update("T1", []), 3)]
    job.run_batch(spark.createDataFrame([(t, json.dumps(e), n) for t, e, n in events], _WIRE), 0)
    board = read_board(read_changes(spark, f"{workdir}/vehicles"), S.VEHICLE_BOARD)
    assert {(r.id, r.nextStopId, r.nextStopApproachSec) for r in board.collect()} == {("v", None, None), ("w", None, None)}


def test_a_repeated_batch_keeps_its_time(spark, workdir):
    import time

    now = int(time.time())
    job = _job(spark, workdir, as_of=None, ingested_at=None)
    rows = spark.createDataFrame([("VehiclePositions", json.dumps(vehicle("v", None, now)), 1)], _WIRE)
    job.run_batch(rows, 0)
    first = read_changes(spark, f"{workdir}/vehicles").collect()
    time.sleep(1.5)
    job.run_batch(rows, 0)
    assert read_changes(spark, f"{workdir}/vehicles").collect() == first


def test_latest_rows_stream_in_update_mode(spark, workdir):
    folder = _landed(_events(), f"{workdir}/in", 4)
    positions = parse_vehicle(_stream(spark, folder).where("topic = 'VehiclePositions'"))
    slim = B.slim_positions(positions)
    write_latest(
        slim, "id", ["updateSec", "seq"], lambda u, b: append_changes(u, f"{workdir}/out", b),
        f"{workdir}/ck", trigger=NOW_DONE,
    ).awaitTermination()
    got = read_board(read_changes(spark, f"{workdir}/out"), slim.schema)
    read = parse_vehicle(spark.read.schema(_WIRE).json(folder).where("topic = 'VehiclePositions'"))
    want = B.vehicle_state(read, horizon_s=None)
    assert _sorted(got) == _sorted(want.select(*got.columns))


@pytest.mark.parametrize(("salts", "ttl"), [(1, None), (3, 500)])
def test_stateful_join_equals_the_batch_join(spark, workdir, salts, ttl):
    folder = _landed(_events(), f"{workdir}/in", 3)
    stream = _stream(spark, folder)
    vehicles = B.slim_positions(parse_vehicle(stream.where("topic = 'VehiclePositions'")))
    trips = B.trip_state(parse_trip_update(_stream(spark, folder).where("topic = 'TripUpdates'")))
    joined = join_trip_stream(vehicles, trips, salts=salts, vehicle_ttl_s=ttl)
    (
        joined.writeStream.outputMode("append")
        .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{workdir}/out/batch={i}"))
        .option("checkpointLocation", f"{workdir}/ck")
        .trigger(**NOW_DONE)
        .start()
        .awaitTermination()
    )
    rows = spark.read.schema(joined.schema.add("batch", "long")).parquet(f"{workdir}/out")
    # A batch has one row of a vehicle at most, and the last one is its newest.
    assert rows.groupBy("id", "batch").count().where("count > 1").count() == 0
    got = O.latest_by_key(rows, "id", "batch")
    read = spark.read.schema(_WIRE).json(folder)
    state = B.vehicle_state(parse_vehicle(read.where("topic = 'VehiclePositions'")), horizon_s=None)
    updates = B.latest_trip_state(parse_trip_update(read.where("topic = 'TripUpdates'")))
    want = O.join_latest_trip(state, updates)
    columns = ["id", "tripId", "startDate", "updateSec", "seq", "startTime"]
    assert _sorted(got.select(*columns, "stopSequence", "stopId", "approachSec", "delay")) == _sorted(
        want.select(*columns, "next.*")
    )


def test_counted_entries_stream_in_update_mode(spark, workdir):
    folder = _landed(_events(), f"{workdir}/in", 4)
    updates = parse_trip_update(_stream(spark, folder).where("topic = 'TripUpdates'"))
    trips, _ = _lookups(spark)
    entries = O.stop_entries(updates, trips, as_of=NOW, dedupe=False)
    counted = O.count_copies(entries, ["stopId", "updateTime"])
    (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{workdir}/out/batch={i}"))
        .option("checkpointLocation", f"{workdir}/ck")
        .trigger(**NOW_DONE)
        .start()
        .awaitTermination()
    )
    rows = spark.read.schema(counted.schema).parquet(f"{workdir}/out").select(*counted.columns)
    keys = [c for c in counted.columns if c not in ("n", "updateSec")]
    got = rows.groupBy(*keys).agg(F.max("n").alias("n"), F.max("updateSec").alias("updateSec"))
    read = parse_trip_update(spark.read.schema(_WIRE).json(folder).where("topic = 'TripUpdates'"))
    want = O.count_copies(O.stop_entries(read, trips, as_of=NOW, dedupe=False), ["stopId", "updateTime"])
    assert _sorted(got) == _sorted(want)


def test_counts_leave_the_state_behind_the_watermark(spark, workdir):
    events = [("TripUpdates", trip_update(f"T{i % 5}", [stop(1, f"s{i}", NOW + 400 * i + 50)], NOW + 400 * i), i) for i in range(12)]
    folder = _landed(events, f"{workdir}/in", 4)
    updates = parse_trip_update(_stream(spark, folder).where("topic = 'TripUpdates'"))
    trips, _ = _lookups(spark)
    entries = with_rowtime(O.stop_entries(updates, trips, horizon_s=None, dedupe=False), "updateSec", "150 seconds")
    counted = O.count_copies(entries, ["stopId", "updateTime", "rowtime"])
    query = (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{workdir}/out/batch={i}"))
        .option("checkpointLocation", f"{workdir}/ck").trigger(**NOW_DONE).start()
    )
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in map(json.loads, (p.json for p in query.recentProgress))]
    assert max(kept) < 12 and kept[-1] <= 3
    assert spark.read.parquet(f"{workdir}/out").count() == 12


def test_shared_folder_follows_the_session(spark):
    class Session:
        def __init__(self, **settings):
            self.conf = settings

    named = Session(**{"spark.checkpoint.dir": "s3a://b/c/", "spark.sql.warehouse.dir": "file:/w"})
    assert shared_folder(named, "x").startswith("s3a://b/c/x-")
    unnamed = Session(**{"spark.sql.warehouse.dir": "file:/w"})
    assert shared_folder(unnamed, "x").startswith("file:/w/checkpoints/x-")
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_relay_hands_on_new_rows_without_deletes(spark, workdir):
    rows = [("a", json.dumps({"stopId": "a"})), ("b", None)]
    spark.createDataFrame(rows, "key string, value string").write.parquet(f"{workdir}/in")
    stream = spark.readStream.schema("key string, value string").parquet(f"{workdir}/in")
    sent = []
    relay(
        stream, S.STOP_BOARD, lambda b: sent.extend(r.stopId for r in b.collect()), f"{workdir}/ck",
        trigger=NOW_DONE,
    ).awaitTermination()
    assert sent == ["a"]


def test_print_messages(spark, workdir):
    folder = _landed(_events()[:50], f"{workdir}/in", 2)
    lines = []
    print_messages(_stream(spark, folder), trigger=NOW_DONE, out=lines.append).awaitTermination()
    assert sorted(json.loads(line)["seq"] for line in lines) == sorted(n for _, _, n in _events()[:50])
    assert {json.loads(line)["topic"] for line in lines} == {"VehiclePositions", "TripUpdates"}


def test_a_message_is_parsed_once(spark, workdir):
    """Filters on what was parsed would have the optimizer parse again."""
    spark.createDataFrame([("TripUpdates", "{}", 1)], _WIRE).write.parquet(f"{workdir}/messages")
    messages = spark.read.parquet(f"{workdir}/messages")
    newest = _job(spark, workdir)._newest(messages, NOW)
    for df, times in ((newest, 2), (explode_feed(messages)[0], 1)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == times


@pytest.mark.parametrize("bad", [[], [("TripUpdates", "{", 8), ("Odd", "text", 9), (None, None, 10)]])
def test_newest_states_and_bad_messages_of_one_pass(spark, workdir, bad):
    """Messages without a value count as updates of no trip; stale positions leave no state."""
    rows = [("VehiclePositions", json.dumps(vehicle("v", "T1", NOW - n)), n) for n in (149, 150, 10)]
    rows += [("VehiclePositions", None, 4), ("TripUpdates", None, 5), ("TripUpdates", json.dumps(trip_update("T1", [], NOW)), 6)]
    job = _job(spark, workdir)
    job.run_batch(spark.createDataFrame(rows + bad, _WIRE), 0)
    state = spark.read.parquet(f"{workdir}/state/vehicles").select("id", "updateSec", "seq").collect()
    assert [tuple(r) for r in state] == [("v", NOW - 10, 10)]
    state = spark.read.parquet(f"{workdir}/state/trips").select("tripId", "feedSec", "seq").collect()
    assert sorted(map(tuple, state), key=repr) == [("T1", NOW, 6), (None, None, 5)]
    kept = spark.read.schema("topic string, value string").parquet(f"{workdir}/state/corrupt/batch=0").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(((t, v) for t, v, _ in bad), key=repr)
