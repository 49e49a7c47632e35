"""Both boards kept up by Spark's keyed states: only what changes is worked out and sent.

The vehicle board is one chain of states: a vehicle's newest row, its trip's newest update, the
digest of the row last sent. The stop board counts calls by signed deltas, and makes anew the pages
of those stops alone that a batch's deltas are about.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetboard.functions.timefn import DEFAULT_ZONE, epoch_of, local_time
from fleetboard.functions.transit import SENTINEL
from fleetboard.operators import boards as B
from fleetboard.operators.joins import join_same, join_stops, join_trips
from fleetboard.operators.paging import PAGE_SECONDS
from fleetboard.sinks.upsert import stop_key, stop_upserts
from fleetboard.streaming.changes import only_changes
from fleetboard.streaming.deltas import add_deltas, call_deltas, weights_around
from fleetboard.streaming.state import join_trip_stream

Sink = Callable[[DataFrame, int], None]


def vehicle_changes(
    positions: DataFrame, updates: DataFrame, trip_lookup: DataFrame, stop_lookup: DataFrame, *,
    vehicle_ttl_s: int | None = 150, late_s: int | None = None, zone: str = DEFAULT_ZONE, salts: int = 8, **next_stop_options,
) -> DataFrame:
    """Changes of the vehicle board, as a stream: key, value, at, kind.

    ``positions`` and ``updates`` are streams of parsed events with ``seq``. A row of the board is
    sent when it differs from the one last sent for its vehicle, and a delete when the vehicle has
    run out of time. ``ingestionTime`` is when a batch is worked on; it makes no difference.
    """
    joined = join_trip_stream(
        B.slim_positions(positions), B.trip_state(updates, **next_stop_options), salts=salts, vehicle_ttl_s=vehicle_ttl_s, late_s=late_s
    )
    sentinel = next_stop_options.get("sentinel", SENTINEL)
    rows = join_trips(joined, trip_lookup, "tripId").withColumnRenamed("stopId", "nextStopId")
    rows = join_stops(rows, stop_lookup, "nextStopId", spread=sentinel)
    board = rows.select(
        "gone", "id", "tripId", "shapeId", "routeName", "tripHeadSign", "startDate", "startTime", "latitude", "longitude",
        local_time(F.col("updateSec"), zone).alias("updateTime"), F.col("stopSequence").alias("nextStopSequence"), "nextStopId",
        F.col("stopName").alias("nextStopName"), F.col("approachSec").alias("nextStopApproachSec"),
        F.col("delay").alias("nextStopDelay"), "updateSec",
    )
    columns = [c for c in board.columns if c != "gone"]
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    upserts = board.select(F.col("id").alias("key"), F.when(~F.col("gone"), value).alias("value"), F.lit(0).cast("bigint").alias("at"))
    return only_changes(upserts, "at")


def with_ingestion_time(changes: DataFrame, at: int | Column | None = None, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Upserts of a vehicle board with ``ingestionTime`` put into their JSON objects."""
    time = F.concat(F.lit(',"ingestionTime":"'), local_time(epoch_of(at), zone), F.lit('"}'))
    return changes.withColumn("value", F.regexp_replace("value", F.lit(r"\}$"), time))


@dataclass
class StopBoard:
    """The stop board from deltas: a sink of ``call_deltas`` batches that sends changed pages to ``sink``.

    ``state_dir`` holds the weights. Of each stop that a batch touches the pages are made anew from
    its weights; pages it had before and has no more are deleted. ``as_of`` fixes "now" for replays.
    """

    stop_lookup: DataFrame
    state_dir: str
    sink: Sink
    horizon_s: int | None = None
    as_of: int | None = None

    def __call__(self, deltas: DataFrame, batch_id: int) -> None:
        spark, weights = deltas.sparkSession, f"{self.state_dir}/weights"
        deltas = deltas.persist()  # for the weights and the stops
        try:
            if batch_id == 0:
                # Without any batch before it the table is there, too.
                add_deltas(deltas.limit(0), weights, -1)
            add_deltas(deltas, weights, batch_id)
            stops = f"{self.state_dir}/touched/{batch_id % 2}"
            deltas.select("stopId").distinct().write.mode("overwrite").parquet(stops)
        finally:
            deltas.unpersist()
        touched = spark.read.schema("stopId string").parquet(stops)
        shown = self._shown(weights_around(spark, weights, deltas.schema, batch_id, touched)).persist()
        try:
            upserts = stop_upserts(B.board_of_counted(shown.where("n > 0 AND here"), self.stop_lookup)).persist()
            had = shown.where("before > 0 AND was").select(stop_key().alias("key")).distinct()
            gone = had.join(upserts.select("key"), "key", "left_anti").withColumn("value", F.lit(None).cast("string"))
            self.sink(upserts.unionByName(gone), batch_id)
            upserts.unpersist()
        finally:
            shown.unpersist()

    def _shown(self, counted: DataFrame) -> DataFrame:
        """Entries of each stop's newest feed time, now (``here``) or before the batch (``was``).

        Both are found at once, and only these few entries go on to become pages.
        """
        if self.horizon_s is not None:
            counted = counted.where(F.col("updateSec") > epoch_of(self.as_of) - self.horizon_s)
        group = F.struct("updateSec", "updateTime")
        newest = counted.groupBy("stopId").agg(
            F.max(F.when(F.col("n") > 0, group))["updateTime"].alias("_now"),
            F.max(F.when(F.col("before") > 0, group))["updateTime"].alias("_before"),
        )
        times = newest.withColumn("updateTime", F.explode(F.array_distinct(F.array("_now", "_before"))))
        times = times.select(
            "stopId", "updateTime", F.col("updateTime").eqNullSafe(F.col("_now")).alias("here"),
            F.col("updateTime").eqNullSafe(F.col("_before")).alias("was"),
        )
        return join_same(counted, times, ["stopId", "updateTime"], "inner")


def run_maintained(
    positions: DataFrame, updates: DataFrame, trip_lookup: DataFrame, stop_lookup: DataFrame, folder: str, *,
    vehicle_sink: Sink, stop_sink: Sink, as_of: int | None = None, ingested_at: int | None = None,
    vehicle_ttl_s: int | None = 150, horizon_s: int | None = 150, late_s: int | None = None, zone: str = DEFAULT_ZONE,
    page_s: int = PAGE_SECONDS, salts: int = 8, trigger: dict | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both boards as two queries that keep their state and checkpoints in ``folder``.

    ``positions`` and ``updates`` are streams of parsed events with ``seq`` (two reads of the
    same topics). The sinks get (key, value) changes and the batch id; as a batch may be repeated
    after a failure they must be idempotent per id or per key.
    """
    trigger = trigger or {"processingTime": "2 minutes"}
    changes = vehicle_changes(
        positions, updates, trip_lookup, stop_lookup, vehicle_ttl_s=vehicle_ttl_s, late_s=late_s, zone=zone, salts=salts
    )

    def send(batch: DataFrame, batch_id: int) -> None:
        vehicle_sink(with_ingestion_time(batch, ingested_at, zone).select("key", "value"), batch_id)

    vehicles = changes.writeStream.outputMode("append").foreachBatch(send).option("checkpointLocation", f"{folder}/vehicles")
    deltas = call_deltas(updates, trip_lookup, zone=zone, page_s=page_s)
    board = StopBoard(stop_lookup, f"{folder}/stop_state", stop_sink, horizon_s, as_of)
    stops = deltas.writeStream.outputMode("append").foreachBatch(board).option("checkpointLocation", f"{folder}/stops")
    return vehicles.trigger(**trigger).start(), stops.trigger(**trigger).start()
