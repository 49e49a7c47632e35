"""The calls of trips as a multiset of weights, kept by signed deltas.

A trip's newer update takes its older one back: state by trip holds the calls last counted, and a
newer update sends them with weight -1 and its own with +1. Summed by call, the weights are the
counts over each trip's newest update alone, without looking at any other trip.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetboard.functions.timefn import DEFAULT_ZONE, rowtime
from fleetboard.operators.boards import calls_of, entries_of_calls
from fleetboard.operators.joins import join_same
from fleetboard.operators.paging import PAGE_SECONDS
from fleetboard.streaming.state import Bucket, Packed, bucket_of, packed, rank, unpacked

_CALLS = "array<struct<stopId: string, arrivalSec: bigint, delay: string>>"
_COUNTED = T.StructType(
    [
        T.StructField("tripId", T.StringType()),
        T.StructField("feedSec", T.LongType()),
        T.StructField("weight", T.IntegerType()),
        T.StructField("calls", T.StringType()),
    ]
)
_COUNTED_ROW = Row(*_COUNTED.names)


class _Supersede(StatefulProcessor):
    """The calls of a bucket's trips that are counted now, as text that only the JVM takes apart."""

    def __init__(self, horizon_ms: int | None):
        self._horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._counted = Bucket(handle, "counted")  # tripId: (feedSec, seq, calls)

    def handleInputRows(self, key, rows: Iterator[Mapping], timerValues) -> Iterator[Row]:
        newest = {}
        for r in rows:
            order = rank(r["feedSec"], r["seq"]), r["calls"] or ""
            if r["tripId"] not in newest or newest[r["tripId"]][0] < order:
                newest[r["tripId"]] = order, (r["feedSec"], r["seq"], r["calls"])
        counted, ends = self._counted.get(), set()
        for trip, (order, new) in newest.items():
            old = counted.get(trip)
            if old is not None and rank(*old[:2]) >= order[0]:
                continue
            if old is not None:
                yield _COUNTED_ROW(trip, old[0], -1, old[2])
            counted[trip] = new
            if self._horizon_ms is not None and new[0] is not None:
                ends.add(new[0] * 1000 + self._horizon_ms)
            yield _COUNTED_ROW(trip, new[0], 1, new[2])
        for end in ends:
            self._handle.registerTimer(end)
        self._counted.update(counted)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Trips that a newer update has given a later end are left to their own timer.
        end, counted = expiredTimerInfo.getExpiryTimeInMs(), self._counted.get()
        over = [t for t, old in counted.items() if old[0] is not None and old[0] * 1000 + self._horizon_ms <= end]
        for trip in over:
            old = counted.pop(trip)
            yield _COUNTED_ROW(trip, old[0], -1, old[2])
        if over:
            self._counted.update(counted)

    def close(self) -> None:
        pass


def call_deltas(
    updates: DataFrame, trip_lookup: DataFrame, *, horizon_s: int | None = None, late_s: int = 60,
    zone: str = DEFAULT_ZONE, page_s: int = PAGE_SECONDS, add_delay: bool = True, use_arrival: bool = False,
) -> DataFrame:
    """Stop board entries of a stream of trip updates (events with ``seq``), each with ``weight`` 1 or -1.

    Past calls leave an update within its own row, so that the state holds upcoming ones only. Of a
    trip's updates the one of greatest (feed time, seq) counts, in whatever order they come; one
    that is not newer sends nothing. With ``horizon_s`` a timer takes a trip's calls back that long
    after its feed time, when the watermark (``late_s`` behind the newest feed time) has passed it.
    """
    u = F.col("tripUpdate")
    calls = updates.select(
        F.col("id").alias("tripId"), u["timestamp"].alias("feedSec"), F.col("seq").cast("long").alias("seq"),
        F.to_json(calls_of(u, add_delay=add_delay, use_arrival=use_arrival)).alias("calls"),
    )
    calls = calls.withColumn("bucket", bucket_of("tripId"))
    newest = "tripId", ["feedSec", "seq", "calls"]
    if horizon_s is None:
        calls = packed(calls, newest=newest)
    else:
        # Rows behind the watermark are dropped one by one, so those of a second go together.
        calls = packed(calls.withColumn("at", F.col("feedSec")), ["bucket", "at"], newest)
        calls = calls.withColumn("rowtime", rowtime(F.col("at"))).withWatermark("rowtime", f"{late_s} seconds")
    sent = calls.groupBy("bucket").transformWithState(
        statefulProcessor=Packed(_Supersede(None if horizon_s is None else horizon_s * 1000)), outputStructType=Packed.OUTPUT,
        outputMode="Append", timeMode="None" if horizon_s is None else "EventTime",
    )
    counted = unpacked(sent, _COUNTED)
    lists = counted.withColumn("calls", F.from_json("calls", T.DataType.fromDDL(_CALLS)))
    return entries_of_calls(lists, trip_lookup, zone=zone, page_s=page_s, also=["weight"])


def add_deltas(deltas: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch's deltas to a table of weights, summed; a repeated batch replaces itself.

    What a trip's update takes back and counts again within the batch leaves nothing.
    """
    entry = [c for c in deltas.columns if c != "weight"]
    summed = deltas.groupBy(*entry).agg(F.sum("weight").alias("weight")).where("weight <> 0")
    summed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_weights(
    spark: SparkSession, path: str, schema: T.StructType, base: str | None = None, until: int | None = None
) -> DataFrame:
    """The entries of a table of weights with ``n``, how often each one counts now (or after batch ``until``).

    ``schema`` is that of the deltas; entries whose weights cancel out are not there.
    """
    rows = _weights(spark, path, schema, base)
    rows = rows if until is None else rows.where(F.col("batch") <= until)
    entry = [c for c in schema.names if c != "weight"]
    return rows.groupBy(*entry).agg(F.sum("weight").alias("n")).where("n > 0")


def weights_around(spark: SparkSession, path: str, schema: T.StructType, batch_id: int, stops: DataFrame) -> DataFrame:
    """The entries of ``stops`` (stopId) with how often each counts after a batch (``n``) and ``before`` it."""
    rows = _weights(spark, path, schema, None).where(F.col("batch") <= batch_id)
    entry = [c for c in schema.names if c != "weight"]
    counted = join_same(rows, stops, ["stopId"], "left_semi").groupBy(*entry).agg(
        F.sum("weight").alias("n"),
        F.coalesce(F.sum(F.when(F.col("batch") < batch_id, F.col("weight"))), F.lit(0)).alias("before"),
    )
    return counted.where("n > 0 OR before > 0")


def fold_deltas(spark: SparkSession, path: str, schema: T.StructType, base: str, last_batch: int, before: str | None = None) -> None:
    """Sum up the weights of batches up to ``last_batch`` in the new folder ``base``.

    ``before`` is the sum that the table had so far. Nothing is deleted.
    """
    rows = _weights(spark, path, schema, before).where(F.col("batch") <= last_batch)
    entry: Sequence[str] = [c for c in schema.names if c != "weight"]
    summed = rows.groupBy(*entry).agg(F.sum("weight").alias("weight")).where("weight <> 0")
    summed.write.parquet(f"{base}/batch={last_batch}")


def _weights(spark: SparkSession, path: str, schema: T.StructType, base: str | None) -> DataFrame:
    fields = [T.StructField("weight", T.LongType()) if f.name == "weight" else f for f in schema]
    read = spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType())]))
    rows = read.parquet(path)
    if base is None:
        return rows
    summed = read.parquet(base)
    # The folder's name tells the last batch it sums up, also where nothing is left in it.
    last = summed.agg(F.max("batch")).first()[0]
    return summed if last is None else rows.where(F.col("batch") > last).unionByName(summed)
