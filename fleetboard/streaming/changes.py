"""Upserts reduced to what changes, and ended when their time is over.

Both are keyed states that each batch touches only where it brings rows (or a timer is due).
They need the RocksDB state store provider and output mode append.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetboard.functions.timefn import rowtime
from fleetboard.streaming.state import Bucket, Packed, bucket_of, keys_of, packed, rank, unpacked

INSERT, CHANGE, DELETE = "insert", "change", "delete"
_CHANGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)
_CHANGE_ROW = Row(*_CHANGE.names)
_SENT = T.StructType([T.StructField("key", T.StringType()), T.StructField("digest", T.LongType())])


class _Digest(StatefulProcessor):
    """The digests of the values last sent for a bucket's keys; none of one that was deleted or never sent."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = Bucket(handle, "digest")  # key: digest

    def handleInputRows(self, key, rows: Iterator[Mapping], timerValues) -> Iterator[Row]:
        newest = {}
        for row in rows:
            # Deletes have no digest; they win among rows of the same order, as a larger digest does.
            order = rank(row["at"]), row["digest"] is None, row["digest"] or 0
            if row["key"] not in newest or newest[row["key"]][0] < order:
                newest[row["key"]] = order, row
        last, changed = self._last.get(), False
        for name, (_, new) in newest.items():
            known = last.get(name)
            if new["digest"] == known:
                continue
            if new["digest"] is None:
                del last[name]
                kind = DELETE
            else:
                last[name] = new["digest"]
                kind = INSERT if known is None else CHANGE
            changed = True
            yield _CHANGE_ROW(name, new["value"], new["at"], kind)
        if changed:
            self._last.update(last)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._last.update({s["key"]: s["digest"] for s in initialState["sent"]})

    def close(self) -> None:
        pass


def only_changes(upserts: DataFrame, order: str, sent: DataFrame | None = None) -> DataFrame:
    """Of a stream of upserts those that change their key: key, value, at (``order``) and kind.

    A board that is computed anew for each batch may send all of its rows here: only keys that are
    new, whose value differs from the one last sent, or that are deleted (NULL value) and were
    there go on. Of a key's rows in one batch the one of greatest ``order`` (a long) counts. State
    is 8 bytes a key. A NULL key is a key like any other. ``sent`` (key, digest) is what another job
    has sent before this one's first batch, as ``sent_digests`` reads it.
    """
    rows = upserts.select(
        "key", "value", F.col(order).cast("long").alias("at"), F.when(F.col("value").isNotNull(), F.xxhash64("value")).alias("digest")
    )
    changes = packed(rows.withColumn("bucket", bucket_of("key"))).groupBy("bucket").transformWithState(
        statefulProcessor=Packed(_Digest()), outputStructType=Packed.OUTPUT, outputMode="Append", timeMode="None",
        initialState=None if sent is None else _by_bucket(sent),
    )
    return unpacked(changes, _CHANGE)


def _by_bucket(sent: DataFrame) -> GroupedData:
    """A row of each bucket with what has been sent for its keys."""
    keys = F.collect_list(F.struct(*_SENT.names)).alias("sent")
    return sent.select(bucket_of("key").alias("bucket"), *_SENT.names).groupBy("bucket").agg(keys).groupBy("bucket")


def sent_digests(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """key and digest of the rows that a stopped job of ``only_changes`` has sent, read from its state.

    A job that takes over, with a checkpoint of its own and the offsets after the old job's last,
    sends on from there. ``operator`` is the number of the stateful operator in the old job's plan.
    """
    state = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"]:
                keys = keys_of(data.as_py())
                yield pa.record_batch([pa.array(keys, pa.string()), pa.array(keys.values(), pa.int64())], _SENT.names)

    return state.load(checkpoint).select("value.data").mapInArrow(run, _SENT)


class _Life(StatefulProcessor):
    """When a key's newest upsert was; a timer sends its delete."""

    def __init__(self, ttl_ms: int):
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getValueState("newest", "seconds long, seq long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = max(rows, key=lambda r: (rank(r["seconds"], r["seq"]), r["value"] is None, r["value"] or ""))
        known = self._newest.get()
        if known is not None:
            if rank(*known) >= rank(new["seconds"], new["seq"]):
                return
            self._handle.deleteTimer(known[0] * 1000 + self._ttl_ms)
        if new["value"] is None:
            self._newest.clear()
        else:
            self._newest.update((new["seconds"], new["seq"]))
            self._handle.registerTimer(new["seconds"] * 1000 + self._ttl_ms)
        yield Row(key=key[0], value=new["value"], seconds=new["seconds"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._newest.clear()
        yield Row(key=key[0], value=None, seconds=expiredTimerInfo.getExpiryTimeInMs() // 1000)

    def close(self) -> None:
        pass


def with_expiry(upserts: DataFrame, *, ttl_s: int = 300, late_s: int = 60) -> DataFrame:
    """Newest upserts per key (key, value, seconds), each deleted ``ttl_s`` after it in event time.

    ``upserts`` has key, value, seconds and seq. When the watermark, ``late_s`` behind the newest
    row of all, passes a key's newest upsert by ``ttl_s``, a timer sends (key, NULL, the second it
    ended): no row of the key has to come for that, and no other key is looked at. Upserts without
    seconds, or older than the watermark, are left out; a later one brings a key back.
    """
    rows = upserts.where("seconds IS NOT NULL").select("key", "value", "seconds", "seq", rowtime(F.col("seconds")).alias("rowtime"))
    return rows.withWatermark("rowtime", f"{late_s} seconds").groupBy("key").transformWithState(
        statefulProcessor=_Life(ttl_s * 1000), outputStructType="key string, value string, seconds long",
        outputMode="Append", timeMode="EventTime",
    )
