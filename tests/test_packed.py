"""Keyed states that take their rows by the hundred, and the stop board that works out a batch once."""

import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from feeds import NOW, stop, stop_lookup, trip_lookup, trip_update
from fleetboard import schemas as S
from fleetboard.plans.maintained import stateful
from fleetboard.sinks import append_changes, read_board, read_changes
from fleetboard.sources import land_polls, parse_trip_update, read_polls, run_to_end
from fleetboard.streaming import StopBoard, call_deltas, join_trip_stream
from fleetboard.streaming.changes import _Digest
from fleetboard.streaming.state import _EVENT, GONE, HERE, LEFT, Packed, _Place, bucket_of, packed, unpacked


class _Store:
    """A state store that counts how often it is asked, and keeps timers."""

    def __init__(self):
        self.asked, self.value, self.timers = 0, None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_batch_of_the_stop_board_is_worked_out_once(spark, workdir):
    own, seen = stateful(spark), spark.sparkContext.accumulator(0)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    # Poll 1 takes T0 from s1 and s2 to s3; T2 stays at s2.
    call = lambda s: stop(1, s, NOW + 60, 5)
    polls = [
        [trip_update("T0", [call("s1"), call("s2")], NOW - 50), trip_update("T2", [call("s2")], NOW - 60)],
        [trip_update("T0", [call("s3")], NOW - 20)],
    ]
    rows = [(p, json.dumps(event), p) for p, events in enumerate(polls) for event in events]
    schema = "poll int, value string, seq long"
    land_polls(spark.createDataFrame(rows, schema), f"{workdir}/in")
    updates = parse_trip_update(read_polls(own, f"{workdir}/in", schema))
    deltas = call_deltas(updates, trip_lookup(own, *[(f"T{i}", "1", "r", "h") for i in range(3)]))

    @F.udf("int")
    def counted(weight):
        seen.add(1)
        return weight

    board = StopBoard(
        stop_lookup(spark, ("s1", "One"), ("s2", "Two"), ("s3", "Three")), workdir,
        lambda upserts, n: append_changes(upserts, f"{workdir}/changes", n), 1000, NOW,
    )
    stream = deltas.withColumn("weight", counted.asNondeterministic()("weight")).writeStream.outputMode("append")
    run_to_end(stream.foreachBatch(board).option("checkpointLocation", f"{workdir}/ck"))
    # Three calls in the first batch, two taken back and one new in the second.
    assert seen.value == 6
    got = read_board(read_changes(spark, f"{workdir}/changes"), S.STOP_BOARD).collect()
    ids = {r.stopId: [e["id"] for e in json.loads(r.info)] for r in got}
    assert ids == {"s2": ["T2"], "s3": ["T0"]}


def test_rows_of_a_bucket_go_as_one_and_come_back(spark):
    schema = "id string, trip string, updateSec long, latitude float"
    rows = [(f"v{i % 40}", None if i % 7 == 0 else f"T{i}", i if i % 5 else None, i / 3) for i in range(400)] + [(None, "T", 1, None)]
    df = spark.createDataFrame(rows, schema).withColumn("bucket", F.pmod(bucket_of("id"), F.lit(3))).coalesce(1)
    packs = packed(df)
    assert packs.count() == 3

    names = df.drop("bucket").columns
    back = [tuple(r[n] for n in names) for r in Packed._rows(packs.collect())]
    assert sorted(map(repr, back)) == sorted(map(repr, map(tuple, df.drop("bucket").collect())))

    # Of each key the newest; rows of different seconds stay apart where they have to.
    newest = packed(df, ["bucket", "updateSec"], ("id", ["updateSec", "trip"])).collect()
    assert sum(len(list(Packed._rows([r]))) for r in newest) == 41 and len({(r.bucket, r.updateSec) for r in newest}) == len(newest)
    assert packed(df.limit(0)).count() == 0

    sent = list(Packed._sent(Row(*names)(*r) for r in back))
    assert len(sent) == 1
    again = unpacked(spark.createDataFrame(sent, "rows binary"), df.drop("bucket").schema)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, df.drop("bucket").collect()))


def test_many_rows_are_sent_in_parts():
    sent = list(Packed._sent(Row(n=i) for i in range(4001)))
    assert len(sent) == 3


def _place(i, trip, at, seq=0):
    nothing = dict.fromkeys(_EVENT.names)
    return {**nothing, "id": f"v{i}", "trip": trip, "tripId": trip, "updateSec": at, "seq": seq}


def test_vehicles_of_a_bucket_are_read_and_written_at_once():
    store, place = _Store(), _Place(100_000)
    place.init(store)
    told = lambda rows: [(r.id, r.kind, r.trip) for r in place.handleInputRows((0,), iter(rows), None)]
    assert told([_place(i, f"T{i}", 10 + i % 2) for i in range(50)]) == [(f"v{i}", HERE, f"T{i}") for i in range(50)]
    assert store.asked == 2 and sorted(store.timers) == [110_000, 111_000]
    # Older rows count for nothing, of newer ones the newest.
    assert told([_place(1, "T9", 5), _place(2, "T2", 20), _place(2, "T8", 30), _place(4, "T4", 10)]) == [("v2", LEFT, "T2"), ("v2", HERE, "T8")]
    assert store.asked == 4 and sorted(store.timers) == [110_000, 111_000, 130_000]

    class Expired:
        def getExpiryTimeInMs(self):
            return 110_000

    gone = [(r.id, r.kind, r.trip) for r in place.handleExpiredTimer((0,), None, Expired())]
    assert sorted(gone) == sorted((f"v{i}", GONE, f"T{i}") for i in range(0, 50, 2) if i != 2)
    assert told([_place(0, "T0", 40), _place(2, "T7", 25)]) == [("v0", HERE, "T0")]


def test_digests_of_a_bucket_are_read_and_written_at_once():
    store, digest = _Store(), _Digest()
    digest.init(store)
    send = lambda rows: [(r.key, r.kind) for r in digest.handleInputRows((0,), iter(rows), None)]
    row = lambda key, value, at=0: {"key": key, "value": value, "at": at, "digest": None if value is None else hash(value) % 1000}
    assert send([row(None, "n"), *[row(f"k{i}", "a") for i in range(50)]]) == [(None, "insert"), *[(f"k{i}", "insert") for i in range(50)]]
    assert store.asked == 2
    assert send([row("k1", "a"), row("k2", None), row("k3", "b", 1), row("k3", "a", 2), row("new", None), row(None, "m")]) == [("k2", "delete"), (None, "change")]
    assert send([row("k1", "a")]) == [] and store.asked == 5


def test_late_vehicles_are_dropped_one_by_one(spark, workdir):
    own = stateful(spark)
    schema = "poll int, id string, tripId string, startDate string, latitude float, longitude float, updateSec long, seq long"
    row = lambda poll, vehicle, at: (poll, vehicle, "T1", None, 1.0, 2.0, at, poll)
    rows = [row(0, "a", 1000), row(1, "b", 1010), row(2, "late", 500), row(2, "c", 980), row(2, "d", 1020), row(2, None, 1020), row(2, "e", None)]
    land_polls(spark.createDataFrame(rows, schema).coalesce(1), f"{workdir}/v")
    vehicles = read_polls(own, f"{workdir}/v", schema).drop("poll")
    schema = "poll int, tripId string, feedSec long, seq long, startTime string, next struct<stopSequence: string, stopId: string, approachSec: bigint, delay: string>"
    land_polls(spark.createDataFrame([(p, "T1", p, p, f"at {p}", Row("1", "s", 3, None)) for p in range(3)], schema), f"{workdir}/t")
    trips = read_polls(own, f"{workdir}/t", schema).drop("poll")
    seen = []
    stream = join_trip_stream(vehicles, trips, salts=1, vehicle_ttl_s=10_000, late_s=50).writeStream.outputMode("append")
    run_to_end(stream.foreachBatch(lambda b, n: seen.extend((n, r.id, r.startTime) for r in b.collect())).option("checkpointLocation", f"{workdir}/ck"))
    last = {i: (n, text) for n, i, text in sorted(seen, key=lambda x: x[0]) if n < 3}
    assert last == {"a": (2, "at 2"), "b": (2, "at 2"), "c": (2, "at 2"), "d": (2, "at 2"), None: (2, "at 2"), "e": (2, "at 2")}
