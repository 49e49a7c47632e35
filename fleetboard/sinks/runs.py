"""A change table in levels: batches are merged into sorted runs as they come.

Each batch is a run of its own. Whenever the last ``fan`` runs are as long as each other they are
merged into one, which keeps the last write of each key and is sorted by key in ranges, so that a
reader of some keys skips most of its files. After ``n`` batches there are at most ``fan - 1``
runs of each of the ``log(n)`` lengths, and each row has been rewritten ``log(n)`` times.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetboard.operators.latest import latest_by_key

_ROW = "key string, value string, batch bigint"


@dataclass
class RunTable:
    """A sink of (key, value) upserts: call it with each batch and its number.

    Batches are numbered from 0 without gaps, as streaming ones are; a repeated batch replaces
    itself and repeats its merges. Runs that others have replaced stay until the merge after the
    next batch, for readers that have begun.
    """

    path: str
    fan: int = 10

    def __call__(self, upserts: DataFrame, batch_id: int) -> None:
        spark = upserts.sparkSession
        rows = latest_by_key(upserts.select("key", "value").withColumn("batch", F.lit(batch_id).cast("bigint")), "key", "batch")
        self._write(rows, batch_id, batch_id)
        self._drop(spark, batch_id)
        size = 1
        # The numbers of batches alone say what to merge: a repetition merges the same.
        while (batch_id + 1) % (size * self.fan) == 0:
            size *= self.fan
            self._merge(spark, batch_id - size + 1, batch_id, size // self.fan)

    def _merge(self, spark: SparkSession, first: int, last: int, size: int) -> None:
        parts = [self._folder(a, a + size - 1) for a in range(first, last + 1, size)]
        newest = latest_by_key(spark.read.schema(_ROW).parquet(*parts), "key", "batch")
        # Nothing older is left that a delete could be about.
        self._write(newest if first else newest.where("value IS NOT NULL"), first, last)

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        rows.repartitionByRange("key").sortWithinPartitions("key").write.mode("overwrite").parquet(self._folder(first, last))

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/run={first}-{last}"

    def runs(self, spark: SparkSession) -> list[tuple[int, int]]:
        """The finished runs (first and last batch) that a reader needs, oldest first."""
        found, at = [], 0
        whole = self._finished(spark)
        while starts := [r for r in whole if r[0] == at]:
            found.append(max(starts, key=lambda r: r[1]))
            at = found[-1][1] + 1
        return found

    def _finished(self, spark: SparkSession) -> list[tuple[int, int]]:
        files, base, system = self._system(spark)
        if not system.exists(base):
            return []
        names = [s.getPath().getName() for s in system.listStatus(base)]
        runs = [tuple(map(int, m.groups())) for n in names if (m := re.fullmatch(r"run=(\d+)-(\d+)", n))]
        return [r for r in runs if system.exists(files.Path(f"{self._folder(*r)}/_SUCCESS"))]

    def _system(self, spark: SparkSession):
        files = spark._jvm.org.apache.hadoop.fs
        base = files.Path(self.path)
        return files, base, base.getFileSystem(spark._jsc.hadoopConfiguration())

    def _drop(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the runs that lie within a longer one which ended before this batch."""
        files, _, system = self._system(spark)
        runs = [r for r in self._finished(spark) if r[1] < batch_id]
        for a, b in runs:
            if any(first <= a and b <= last and (a, b) != (first, last) for first, last in runs):
                system.delete(files.Path(self._folder(a, b)), True)

    def changes(self, spark: SparkSession) -> DataFrame:
        """key, value and batch of the runs: the last write of each key and run."""
        folders = [self._folder(*r) for r in self.runs(spark)]
        return spark.read.schema(_ROW).parquet(*folders) if folders else spark.createDataFrame([], _ROW)

    def read(self, spark: SparkSession, keys: list[str] | None = None) -> DataFrame:
        """The last write of each key (or of some), deletes left out."""
        rows = self.changes(spark)
        rows = rows if keys is None else rows.where(F.col("key").isin(keys))
        return latest_by_key(rows, "key", "batch").where("value IS NOT NULL").select("key", "value")
