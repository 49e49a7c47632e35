"""Streams that keep what they have seen: deltas, changes, expiry, moving keys, bounded joins."""

import json
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from feeds import NOW, stop, trip_lookup, trip_update
from fleetboard import operators as O
from fleetboard.plans.maintained import stateful
from fleetboard.sinks import with_counts
from fleetboard.sources import land_polls, parse_trip_update, read_polls, run_to_end, store_bucketed
from fleetboard.streaming import (
    add_deltas,
    call_deltas,
    fold_deltas,
    join_trip_stream,
    join_within,
    newest_match,
    only_changes,
    read_weights,
    with_expiry,
)
from fleetboard.streaming.deltas import _Supersede
from fleetboard.streaming.state import _EVENT, _TRIP, HERE, _Trip, newest_in_batches

_NAMES = ("T0", "T1", "T2", "T3")


def _stream(spark, root, rows, schema, name="in"):
    """``rows`` of (poll, ...) as a stream with a batch per poll."""
    schema = "poll int, " + schema
    land_polls(spark.createDataFrame(rows, schema), f"{root}/{name}")
    return read_polls(spark, f"{root}/{name}", schema)


def _run(stream, root, each=None, name="ck"):
    """The rows of each batch."""
    seen = {}

    def sink(batch, n):
        seen[n] = batch.collect()
        if each:
            each(batch, n)

    writer = stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", f"{root}/{name}")
    run_to_end(writer)
    return [rows for _, rows in sorted(seen.items())]


# ---- signed deltas


def _updates(spark, root, polls):
    rows = [(p, json.dumps(event), 10 * p + i) for p, events in enumerate(polls) for i, event in enumerate(events)]
    return parse_trip_update(_stream(spark, root, rows, "value string, seq long"))


def test_a_newer_update_takes_the_older_one_back(spark, workdir):
    own = stateful(spark)
    call = lambda i: stop(i, f"s{i}", NOW + 60 * i, 5)
    polls = [
        [trip_update("T0", [call(1), call(2)], NOW - 50), trip_update("T9", [call(1)], NOW)],
        [trip_update("T0", [call(2), call(3)], NOW - 20), trip_update("T1", None, NOW)],
        [trip_update("T0", [call(7)], NOW - 30)],
        [trip_update("T0", [], NOW - 10)],
    ]
    lookup = trip_lookup(own, *[(t, "1", "r", "h") for t in _NAMES])
    deltas = call_deltas(_updates(own, workdir, polls), lookup)
    batches = _run(deltas, workdir, lambda b, n: add_deltas(b, f"{workdir}/weights", n))
    got = [sorted((r.stopId, r.weight) for r in rows) for rows in batches]
    assert got == [[("s1", 1), ("s2", 1)], [("s1", -1), ("s2", -1), ("s2", 1), ("s3", 1)], [], [("s2", -1), ("s3", -1)]]
    assert read_weights(spark, f"{workdir}/weights", deltas.schema).count() == 0


def _random_polls():
    rng = random.Random(11)
    polls = [[] for _ in range(3)]
    for _ in range(70):
        ts = NOW - rng.randrange(100)
        stops = [stop(j, f"s{rng.randrange(4)}", ts + rng.randrange(-50, 200), rng.choice([None, 10])) for j in range(rng.randrange(5))]
        polls[rng.randrange(3)].append(trip_update(rng.choice([*_NAMES, "T8"]), stops, ts))
    return polls


def test_weights_are_the_counts_of_the_newest_updates(spark, workdir):
    own, polls = stateful(spark), _random_polls()
    lookup = trip_lookup(own, *[(t, "1", f"r{t}", "h") for t in _NAMES])
    deltas = call_deltas(_updates(own, workdir, polls), lookup)
    _run(deltas, workdir, lambda b, n: add_deltas(b, f"{workdir}/weights", n))
    rows = [(json.dumps(e), 10 * p + i) for p, events in enumerate(polls) for i, e in enumerate(events)]
    updates = parse_trip_update(spark.createDataFrame(rows, "value string, seq long"))
    want = O.count_copies(O.stop_entries(updates, lookup, horizon_s=None), ["stopId", "updateTime", "page"])
    key = lambda df: sorted(map(repr, df.select(*want.columns).collect()))
    assert key(read_weights(spark, f"{workdir}/weights", deltas.schema)) == key(want) and want.count() > 3
    # Summed up, and with a repeated batch, they say the same.
    fold_deltas(spark, f"{workdir}/weights", deltas.schema, f"{workdir}/base", 1)
    again = spark.read.parquet(f"{workdir}/weights/batch=2")
    kept = spark.createDataFrame(again.collect(), again.schema)
    add_deltas(kept, f"{workdir}/weights", 2)
    assert key(read_weights(spark, f"{workdir}/weights", deltas.schema, f"{workdir}/base")) == key(want)


def test_calls_leave_by_a_timer_when_their_feed_time_is_over(spark, workdir):
    own = stateful(spark)
    call = stop(1, "s1", NOW + 9000, None)
    polls = [[trip_update("T0", [call], NOW)], [trip_update("T1", [call], NOW + 100)], [trip_update("T2", [call], NOW + 1000)]]
    lookup = trip_lookup(own, *[(t, "1", "r", "h") for t in _NAMES])
    batches = _run(call_deltas(_updates(own, workdir, polls), lookup, horizon_s=150, late_s=10), workdir)
    sent = [(r.id, r.weight) for rows in batches for r in sorted(rows)]
    assert sent == [("T0", 1), ("T1", 1), ("T2", 1), ("T0", -1), ("T1", -1)]


def test_a_task_sends_one_row_of_a_hot_key_per_batch(spark):
    rows = [("hot", i % 50, i) for i in range(300)] + [(None, 1, 1), (None, None, 2)] + [(f"k{i}", None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "key string, seconds long, seq long").coalesce(1)
    got = {r.key: (r.seconds, r.seq) for r in newest_in_batches(df, "key", ["seconds", "seq"]).collect()}
    assert got == {"hot": (49, 299), None: (1, 1), **{f"k{i}": (None, i) for i in range(5)}}
    assert newest_in_batches(df, "key", ["seconds", "seq"]).count() == 7


def test_small_arrow_batches_send_no_more_rows_of_a_hot_key(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    df = own.createDataFrame([("hot", i) for i in range(100)], "key string, seq long").coalesce(1)
    assert [tuple(r) for r in newest_in_batches(df, "key", ["seq"]).collect()] == [("hot", 99)]


class _Store:
    """A state store that counts how often it is asked."""

    def __init__(self):
        self.asked, self.value = 0, None

    def getValueState(self, name, schema):
        return self

    getMapState = getValueState

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value

    def clear(self):
        self.value = None


def test_trips_of_a_bucket_are_read_and_written_at_once():
    store = _Store()
    counted = _Supersede(None)
    counted.init(store)
    rows = [Row(tripId=f"T{i % 50}", feedSec=i, seq=1, calls=f"c{i}") for i in range(100)]
    assert {(r.tripId, r.calls) for r in counted.handleInputRows((0,), iter(rows), None)} == {(f"T{i}", f"c{i + 50}") for i in range(50)}
    sent = list(counted.handleInputRows((0,), iter([Row(tripId="T1", feedSec=200, seq=1, calls="new"), rows[2]]), None))
    assert [(r.tripId, r.weight, r.calls) for r in sent] == [("T1", -1, "c51"), ("T1", 1, "new")]
    assert store.asked == 4

    store, trips = _Store(), _Trip()
    trips.init(store)
    empty = dict.fromkeys(f for f in _EVENT.names + _TRIP.names)
    updates = [Row(**{**empty, "trip": f"T{i}", "salt": 0, "feedSec": i, "stopId": f"s{i}"}) for i in range(50)]
    assert list(trips.handleInputRows((0,), iter(updates), None)) == []
    here = Row(**{**empty, "trip": "T7", "salt": 0, "kind": HERE, "id": "v", "updateSec": 1})
    assert [(r.id, r.stopId) for r in trips.handleInputRows((0,), iter([here]), None)] == [("v", "s7")]
    newer = Row(**{**empty, "trip": "T7", "salt": 0, "feedSec": 60, "stopId": "next"})
    assert [(r.id, r.stopId) for r in trips.handleInputRows((0,), iter([newer, updates[3]]), None)] == [("v", "next")]
    assert store.asked == 6


# ---- changes and expiry


def test_only_changes_are_sent(spark, workdir):
    boards = [
        {"a": "1", "b": "1", None: "n"},
        {"a": "1", "b": "1", None: "n"},
        {"a": "2", "b": None, "c": None, None: "n"},
        {"a": "1", "b": "1", None: None},
        {"a": "1", "b": "1"},
    ]
    rows = [(p, k, v) for p, board in enumerate(boards) for k, v in board.items()] + [(3, "a", "0")]
    stream = _stream(stateful(spark), workdir, rows, "key string, value string")
    batches = _run(only_changes(stream.withColumn("at", F.col("poll") * 10 + F.when(F.col("value") == "0", 0).otherwise(1)), "at"), workdir)
    got = [sorted((r.key or "", r.kind, r.value) for r in rows) for rows in batches]
    assert got == [
        [("", "insert", "n"), ("a", "insert", "1"), ("b", "insert", "1")],
        [],
        [("a", "change", "2"), ("b", "delete", None)],
        [("", "delete", None), ("a", "change", "1"), ("b", "insert", "1")],
        [],
    ]


def test_timers_send_deletes(spark, workdir):
    rows = [
        (0, "a", "1", 100, 1), (0, "b", "1", 100, 2), (0, "a", "0", 90, 9), (0, "d", None, 100, 3), (0, "x", "1", None, 4),
        (1, "b", "2", 380, 5),
        (2, "b", "3", 500, 6), (2, "c", "1", 520, 7),
        (3, "a", "late", 130, 8), (3, "b", "old", 490, 9), (3, "a", "back", 600, 9),
    ]
    stream = _stream(stateful(spark), workdir, rows, "key string, value string, seconds long, seq long")
    sent = [(r.key, r.value, r.seconds) for batch in _run(with_expiry(stream, ttl_s=200, late_s=50), workdir) for r in sorted(batch, key=str)]
    # a is over at 300, which the watermark of the second batch, 330, has passed in the third.
    assert sent[:3] == [("a", "1", 100), ("b", "1", 100), ("d", None, 100)]
    want = [("b", "2", 380), ("a", None, 300), ("b", "3", 500), ("c", "1", 520), ("a", "back", 600)]
    assert sorted(map(str, sent[3:])) == sorted(map(str, want)) and sent.index(("a", None, 300)) < sent.index(("a", "back", 600))


# ---- joins


def _vehicle(poll, vehicle, trip, seconds):
    return poll, vehicle, trip, None, 1.0, 2.0, seconds, poll


_VEHICLES = "id string, tripId string, startDate string, latitude float, longitude float, updateSec long, seq long"
_TRIPS = "tripId string, feedSec long, seq long, startTime string, next struct<stopSequence: string, stopId: string, approachSec: bigint, delay: string>"


def test_a_trip_that_a_vehicle_has_left_revises_it_no_more(spark, workdir):
    own = stateful(spark)
    vehicles = _stream(own, workdir, [
        _vehicle(0, "v", "T1", 10), _vehicle(0, "w", "T1", 10), _vehicle(0, "u", None, 10),
        _vehicle(1, "v", "T2", 20), _vehicle(2, "v", "T9", 15), _vehicle(3, "w", "T1", 500),
    ], _VEHICLES, "vehicles")
    trip = lambda poll, t, feed: (poll, t, feed, poll, f"{t}@{feed}", Row("1", "s", 3, None))
    trips = _stream(own, workdir, [trip(0, "T1", 5), trip(1, "T1", 6), trip(2, "T1", 7), trip(2, "T2", 7), trip(3, "T1", 4)], _TRIPS, "trips")
    batches = _run(join_trip_stream(vehicles.drop("poll"), trips.drop("poll"), salts=2, vehicle_ttl_s=100, late_s=50), workdir)
    got = [sorted((r.id, r.gone, r.tripId, r.startTime) for r in rows) for rows in batches]
    assert got[0] == [("u", False, None, None), ("v", False, "T1", "T1@5"), ("w", False, "T1", "T1@5")]
    assert got[1] == [("v", False, "T2", None), ("w", False, "T1", "T1@6")]
    assert got[2] == [("v", False, "T2", "T2@7"), ("w", False, "T1", "T1@7")]
    # The older update of T1 revises nothing; u and v are over; w has just come again.
    assert sorted(x for rows in got[3:] for x in rows) == [("u", True, None, None), ("v", True, None, None), ("w", False, "T1", "T1@7")]


def test_a_bounded_join_equals_the_batch_join_and_its_state_shrinks(spark, workdir):
    rng = random.Random(5)
    rows = sorted((rng.randrange(4000), rng.randrange(6), i) for i in range(300))
    vehicles = [(at // 1000, str(i), None if i % 9 == 0 else f"T{t}", at) for at, t, i in rows if i % 2]
    trips = [(at // 1000, f"T{t}", at, i) for at, t, i in rows if not i % 2]
    far = [(5, "end", "end", 99_999)], [(5, "end", 99_999, -1)]
    left = _stream(spark, workdir, vehicles + far[0], "id string, tripId string, updateSec long", "v")
    right = _stream(spark, workdir, trips + far[1], "tripId string, feedSec long, tripSeq long", "t")
    joined = join_within(left.drop("poll"), right.drop("poll"), before_s=200, after_s=50, late_s=20)
    query = joined.writeStream.outputMode("append").foreachBatch(
        lambda b, n: b.write.mode("overwrite").parquet(f"{workdir}/rows/batch={n}")
    ).option("checkpointLocation", f"{workdir}/ck").trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    got = newest_match(spark.read.schema(joined.schema).parquet(f"{workdir}/rows"), "id", ("feedSec", "tripSeq"))
    want = {}
    for _, i, t, at in vehicles:
        found = [(feed, seq) for _, other, feed, seq in trips if other == t and at - 200 <= feed <= at + 50]
        want[i] = max(found, default=(None, None))
    assert {r.id: (r.feedSec, r.tripSeq) for r in got.collect() if r.id != "end"} == want
    assert any(f is None for f, _ in want.values()) and any(f is not None for f, _ in want.values())
    state = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
    assert max(state) < 200 and state[-1] <= 4


# ---- counts on the way, stored buckets


def test_counts_come_from_the_job_that_writes(spark, workdir):
    rows = [(NOW, None), (NOW - 100, None), (NOW - 150, None), (NOW, "{bad"), (None, None)]
    df = spark.createDataFrame(rows, "sec long, _corrupt_record string")
    counted, seen = with_counts(df, "sec", as_of=NOW)
    counted.write.parquet(f"{workdir}/out")
    assert seen.get == {"rows": 5, "corrupt": 1, "fresh": 2, "late": 1, "newest": NOW, "oldest": NOW - 150}
    counted, seen = with_counts(df.drop("_corrupt_record").limit(0), "sec", as_of=NOW)
    assert counted.collect() == [] and seen.get["rows"] == seen.get["corrupt"] == 0 and seen.get["newest"] is None


def test_stored_buckets_join_without_a_shuffle(spark, workdir):
    lookup = trip_lookup(spark, *[(f"T{i}", "1", f"r{i}", "h") for i in range(20)])
    rows = spark.createDataFrame([(f"v{i}", f"T{i % 30}" if i % 7 else None) for i in range(200)], "id string, tripId string")
    trips, stored = store_bucketed(lookup, f"{workdir}/trips", "trip_id", 4), store_bucketed(rows, f"{workdir}/rows", "tripId", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = O.join_trips(stored, trips, "tripId", "inner")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        key = lambda df: sorted(map(repr, df.collect()))
        assert key(joined) == key(O.join_trips(rows, lookup, "tripId", "inner"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert stored.count() == 200
