"""Vehicles followed from trip to trip by two chained keyed states.

For state too large to merge batch by batch: the state store holds it, and each batch touches only
the vehicles and trips it brings. Needs the RocksDB state store provider
(``spark.sql.streaming.stateStore.providerClass``) and output mode append.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Mapping, Sequence
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetboard.functions.timefn import rowtime
from fleetboard.functions.transit import SENTINEL

_VEHICLE = T.StructType(
    [
        T.StructField("tripId", T.StringType()),
        T.StructField("startDate", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("updateSec", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
_TRIP = T.StructType(
    [
        T.StructField("feedSec", T.LongType()),
        T.StructField("tripSeq", T.LongType()),
        T.StructField("startTime", T.StringType()),
        T.StructField("stopSequence", T.StringType()),
        T.StructField("stopId", T.StringType()),
        T.StructField("approachSec", T.LongType()),
        T.StructField("delay", T.StringType()),
    ]
)
_ID = T.StructType([T.StructField("id", T.StringType())])
_EVENT = T.StructType([T.StructField("trip", T.StringType()), T.StructField("kind", T.StringType()), *_ID, *_VEHICLE])
#: ``gone`` marks a vehicle that has run out of time; such a row has its id alone.
JOINED = T.StructType([*_ID, T.StructField("gone", T.BooleanType()), *_VEHICLE, *_TRIP])

#: What a vehicle tells a trip: that it is there, has left for another, or has run out of time.
HERE, LEFT, GONE = "here", "left", "gone"
NO_TRIP_UPDATE = (None, None, None, SENTINEL, SENTINEL, 0, None)


def rank(*numbers: int | None) -> tuple:
    """An order of rows by numbers, missing ones before all others."""
    return tuple([(n is not None, n or 0) for n in numbers])


#: Keys of a state are dealt to so many buckets, each of which has one entry in the store.
BUCKETS = 4_096


def bucket_of(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


class Bucket:
    """All keys of a bucket as one value of the state store: one read and one write a batch, however many they are."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self._state = handle.getValueState(name, "data binary")

    def get(self) -> dict:
        known = self._state.get()
        return {} if known is None else keys_of(known[0])

    def update(self, keys: dict) -> None:
        if keys:
            data = pickle.dumps(keys, pickle.HIGHEST_PROTOCOL)
            self._state.update((len(data).to_bytes(8) + pa.compress(data, codec="lz4", asbytes=True),))
        else:
            self._state.clear()


def keys_of(data: bytes) -> dict:
    """The keys of a bucket from its value in the store."""
    return pickle.loads(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8]), codec="lz4", asbytes=True))


#: Rows, and bytes of them, that a task gathers before it looks for the newest of each key.
GATHERED, GATHERED_BYTES = 100_000, 32 << 20


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches joined up to ``GATHERED`` rows, as a session may make them small for long texts."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHERED or size >= GATHERED_BYTES:
            yield pa.concat_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _sorted(batch: pa.RecordBatch, columns: Sequence[str]) -> pa.RecordBatch:
    by = [(c, "ascending") for c in columns]
    return batch.take(pc.sort_indices(batch, sort_keys=by, null_placement="at_start"))


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy()


def _newest(batch: pa.RecordBatch, key: str, order: Sequence[str]) -> pa.RecordBatch:
    rows = _sorted(batch, [key, *order])
    codes = _codes(rows[key])
    return rows.filter(pa.array(np.append(codes[1:] != codes[:-1], True) if len(codes) else np.zeros(0, bool)))


def newest_in_batches(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of each key's rows in an Arrow batch the one of greatest ``order``, missing values first.

    Each task does this to what it has read, before a shuffle by key: a key with a third of all
    rows then sends one row per batch of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            yield _newest(batch, key, order)

    return rows.mapInArrow(run, rows.schema)


def packed(rows: DataFrame, by: Sequence[str] = ("bucket",), newest: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """``by`` and ``rows``: those of equal ``by`` that a task has gathered as one binary value.

    Spark hands a keyed state its rows one by one, value by value, which takes ten times as long as
    all that is done to them; a ``Packed`` state takes them from here by the hundred. ``newest``
    is a key and an order, as ``newest_in_batches`` has them, for what is left out before.
    """
    names = [c for c in rows.columns if c not in by]
    kept = rows.select(*by, *names)
    schema = T.StructType([*[kept.schema[c] for c in by], T.StructField("rows", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            if newest is not None:
                batch = _newest(batch, *newest)
            if not batch.num_rows:
                continue
            batch = _sorted(batch, by)
            first = np.zeros(batch.num_rows, bool)
            first[0] = True
            for c in by:
                codes = _codes(batch[c])
                first[1:] |= codes[1:] != codes[:-1]
            starts = np.flatnonzero(first)
            ends = [*starts[1:].tolist(), batch.num_rows]
            columns = [batch[c].to_pylist() for c in names]
            values = [_pickled((names, [c[a:b] for c in columns])) for a, b in zip(starts.tolist(), ends)]
            keys = [batch[c].take(pa.array(starts)).cast(arrow.field(c).type) for c in by]
            yield pa.record_batch([*keys, pa.array(values, pa.binary())], schema=arrow)

    return kept.mapInArrow(run, schema)


def _pickled(value: object) -> bytes:
    return pickle.dumps(value, pickle.HIGHEST_PROTOCOL)


def unpacked(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """What a ``Packed`` state has sent, as rows of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch["rows"]:
                columns = pickle.loads(value.as_py())
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.select("rows").mapInArrow(run, schema)


#: Rows that a state sends as one value.
SENT = 2_000


class Packed(StatefulProcessor):
    """A state whose rows come ``packed`` (each a dict here) and go packed, too (``unpacked``)."""

    OUTPUT = "rows binary"

    def __init__(self, of: StatefulProcessor):
        self._of = of

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._of.init(handle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self._sent(self._of.handleInputRows(key, self._rows(rows), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._sent(self._of.handleExpiredTimer(key, timerValues, expiredTimerInfo))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._of.handleInitialState(key, initialState, timerValues)

    def close(self) -> None:
        self._of.close()

    @staticmethod
    def _rows(packs: Iterable[Row]) -> Iterator[dict]:
        for pack in packs:
            names, columns = pickle.loads(pack["rows"])
            for values in zip(*columns):
                yield dict(zip(names, values))

    @staticmethod
    def _sent(rows: Iterable[Row]) -> Iterator[Row]:
        held: list[Row] = []
        for row in rows:
            held.append(row)
            if len(held) == SENT:
                yield Row(rows=_pickled([list(c) for c in zip(*held)]))
                held = []
        if held:
            yield Row(rows=_pickled([list(c) for c in zip(*held)]))


_vehicle_of, _trip_of = itemgetter(*_VEHICLE.names), itemgetter(*_TRIP.names)


class _Place(StatefulProcessor):
    """Newest row of each vehicle of a bucket. Tells the trip it is on, and the one it was on.

    An event-time timer ends a vehicle ``ttl_ms`` after its newest row, without a further row of it.
    Vehicles of a bucket that end in the same second share a timer.
    """

    def __init__(self, ttl_ms: int | None):
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = Bucket(handle, "newest")  # id: (trip, vehicle)

    def handleInputRows(self, key, rows: Iterator[Mapping], timerValues) -> Iterator[Row]:
        newest = {}
        for row in rows:
            order = rank(row["updateSec"], row["seq"]), row["trip"]
            if row["id"] not in newest or newest[row["id"]][0] < order:
                newest[row["id"]] = order, (row["trip"], *_vehicle_of(row))
        known = self._newest.get()
        ends = self._ends(known)
        changed = False
        for vehicle, ((order, trip), new) in newest.items():
            old = known.get(vehicle)
            if old is not None and rank(*old[-2:]) >= order:
                continue
            if old is not None and old[0] != trip:
                yield _event(old[0], LEFT, vehicle, old[1:])
            known[vehicle], changed = new, True
            yield _event(trip, HERE, vehicle, new[1:])
        if changed:
            self._set(known, ends)

    def _ends(self, known: dict) -> set[int]:
        """When vehicles end, each a timer."""
        if self._ttl_ms is None:
            return set()
        return {v[-2] * 1000 + self._ttl_ms for v in known.values() if v[-2] is not None}

    def _set(self, known: dict, before: set[int]) -> None:
        after = self._ends(known)
        for end in before - after:
            self._handle.deleteTimer(end)
        for end in after - before:
            self._handle.registerTimer(end)
        self._newest.update(known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end, known = expiredTimerInfo.getExpiryTimeInMs(), self._newest.get()
        over = [i for i, v in known.items() if v[-2] is not None and v[-2] * 1000 + self._ttl_ms == end]
        for vehicle in over:
            old = known.pop(vehicle)
            yield _event(old[0], GONE, vehicle, old[1:])
        if over:
            self._newest.update(known)

    def close(self) -> None:
        pass


_EVENT_ROW, _JOINED_ROW = Row(*_EVENT.names), Row(*JOINED.names)


def _event(trip: str, kind: str, vehicle: str, state: tuple) -> Row:
    return _EVENT_ROW(trip, kind, vehicle, *state)


class _Trip(StatefulProcessor):
    """Newest update of each trip of a bucket, and the vehicles that are on it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Of each (trip, salt) its update, if there is one, and the vehicles there.
        self._trips = Bucket(handle, "trips")

    def handleInputRows(self, key, rows: Iterator[Mapping], timerValues) -> Iterator[Row]:
        updates, words = {}, {}
        for row in rows:
            at = row["trip"], row["salt"]
            if row["kind"] is not None:
                # A vehicle may leave and come back within a batch; its newest word counts.
                told = words.setdefault(at, {})
                order = (rank(row["updateSec"], row["seq"]), row["kind"] == HERE)
                if row["id"] not in told or told[row["id"]][0] <= order:
                    told[row["id"]] = order, row["kind"], _vehicle_of(row)
            else:
                update = _trip_of(row)
                if at not in updates or rank(*update[:2]) >= rank(*updates[at][:2]):
                    updates[at] = update
        trips = self._trips.get()
        for at in dict.fromkeys([*words, *updates]):
            yield from self._told(trips, at, updates.get(at), words.get(at, {}))
        self._trips.update(trips)

    def _told(self, trips: dict, at: tuple, update: tuple | None, told: dict) -> Iterator[Row]:
        trip, vehicles = trips.get(at, (None, {}))
        changed = update is not None and (trip is None or rank(*update[:2]) >= rank(*trip[:2]))
        trip = update if changed else trip
        shown = dict.fromkeys(vehicles) if changed else {}
        for vehicle, (_, kind, state) in told.items():
            if kind == HERE:
                vehicles[vehicle] = state
                shown[vehicle] = None
            else:
                vehicles.pop(vehicle, None)
                shown.pop(vehicle, None)
            if kind == GONE:
                yield _JOINED_ROW(vehicle, True, *[None] * (len(_VEHICLE) + len(_TRIP)))
        if trip is None and not vehicles:
            trips.pop(at, None)
        else:
            trips[at] = trip, vehicles
        for vehicle in shown:
            yield _JOINED_ROW(vehicle, False, *vehicles[vehicle], *(trip or NO_TRIP_UPDATE))

    def close(self) -> None:
        pass


def join_trip_stream(
    vehicles: DataFrame, trips: DataFrame, *, salts: int = 8, vehicle_ttl_s: int | None = 150, late_s: int | None = None
) -> DataFrame:
    """Vehicles joined with their newest trip update, revised as either changes.

    ``vehicles`` are ``vehicle_state``-shaped rows, one per message, and ``trips`` are
    ``trip_state`` rows, both with ``seq``. The first state, by vehicle, takes each vehicle's
    newest row and tells the trip that it leaves; the second, by trip, joins those that are there.
    So a batch gives at most one row per vehicle, and the last batch's row of a vehicle is the
    newest: an unmatched vehicle comes at once and again with its trip update, and a trip that a
    vehicle has left revises it no more. A trip's vehicles are spread over ``salts`` keys, each of
    which gets the small trip row, so a trip with very many vehicles is not one task's work. The
    second state holds a bucket of trips in one entry: a round trip to the store for each of
    millions of trips would take longer than all else.

    ``vehicle_ttl_s`` after its newest row, in event time (the feeds' own seconds), a vehicle ends:
    a timer sends a row with ``gone`` and its id alone, and both states forget it. The watermark
    trails by ``late_s`` (as long as the ttl by default); vehicle rows behind it are dropped.
    """
    nothing = F.lit(None)
    key = F.concat_ws("\u0001", F.coalesce("tripId", F.concat(F.lit("\u0002"), "id")))
    own = vehicles.select(
        bucket_of("id").alias("bucket"), key.alias("trip"), "id", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in _VEHICLE]
    )
    newest = "id", ["updateSec", "seq", "trip"]
    if vehicle_ttl_s is None:
        own = packed(own, newest=newest)
    else:
        # Rows behind the watermark are dropped one by one, so those of a second go together.
        own = packed(own.withColumn("at", F.col("updateSec")), ["bucket", "at"], newest).withColumn("rowtime", rowtime(F.col("at")))
        own = own.withWatermark("rowtime", f"{vehicle_ttl_s if late_s is None else late_s} seconds")
    told = own.groupBy("bucket").transformWithState(
        statefulProcessor=Packed(_Place(None if vehicle_ttl_s is None else vehicle_ttl_s * 1000)),
        outputStructType=Packed.OUTPUT,
        outputMode="Append",
        timeMode="None" if vehicle_ttl_s is None else "EventTime",
    )
    bucket = bucket_of("trip", "salt").alias("bucket")
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    v = unpacked(told, _EVENT).withColumn("salt", salt).select(bucket, "trip", "salt", "kind", "id", *_VEHICLE.names)
    slim = trips.select(
        F.col("tripId").alias("trip"),
        F.col("feedSec").cast("long").alias("feedSec"),
        F.col("seq").cast("long").alias("tripSeq"),
        "startTime",
        *[F.col(f"next.{n}").alias(n) for n in ("stopSequence", "stopId", "approachSec", "delay")],
    )
    newest = "trip", ["feedSec", "tripSeq"]
    if salts > 1:
        slim = newest_in_batches(slim, *newest)
        newest = None
    t = slim.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0))
    t = t.select(bucket, "trip", "salt", nothing.cast("string").alias("kind"), *_TRIP.names)
    joined = packed(v).unionByName(packed(t, newest=newest)).groupBy("bucket").transformWithState(
        statefulProcessor=Packed(_Trip()), outputStructType=Packed.OUTPUT, outputMode="Append", timeMode="None"
    )
    return unpacked(joined, JOINED)
