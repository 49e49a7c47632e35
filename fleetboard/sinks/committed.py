"""Batches that are there as a whole or not at all.

A writer of Spark's data source interface: each task writes files of names that no other attempt
uses and tells them in its commit message; when all have succeeded the driver writes one manifest,
named by the batch, that lists them. Readers go by manifests, so that they never see half a batch,
files of a failed attempt, or a batch twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from fleetboard.sources.polls import filesystem

#: Rows of a file at most.
FILE_ROWS = 1_000_000


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: int):
        self._path, self._batch = path, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = filesystem(self._path)
        fs.create_dir(f"{root}/data", recursive=True)
        files, total, writer, left = [], 0, None, 0
        try:
            for batch in iterator:
                if writer is None or left <= 0:
                    if writer is not None:
                        writer.close()
                    files.append(f"data/{uuid.uuid4().hex}.parquet")
                    writer, left = pq.ParquetWriter(f"{root}/{files[-1]}", batch.schema, filesystem=fs), FILE_ROWS
                writer.write_batch(batch)
                total, left = total + len(batch), left - len(batch)
        finally:
            if writer is not None:
                writer.close()
        return _Written(files, total)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = filesystem(self._path)
        done = [m for m in messages if m is not None]
        manifest = {"batch": self._batch, "files": sorted(f for m in done for f in m.files), "rows": sum(m.rows for m in done)}
        fs.create_dir(f"{root}/manifests", recursive=True)
        draft = f"{root}/manifests/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(manifest).encode())
        # One name for each batch: a repeated one takes the place of the former.
        fs.move(draft, f"{root}/manifests/batch={self._batch}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = filesystem(self._path)
        for message in messages:
            for name in message.files if message is not None else ():
                fs.delete_file(f"{root}/{name}")


class CommittedTable(DataSource):
    """A sink of batches: options path and batch."""

    @classmethod
    def name(cls) -> str:
        return "committed"

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"], int(self.options["batch"]))


def write_committed(rows: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to the table at ``path``; a repeated batch replaces itself."""
    spark = rows.sparkSession
    name = f"{CommittedTable.name()}_{uuid.uuid4().hex}"
    spark.dataSource.register(type("CommittedTable", (CommittedTable,), {"name": classmethod(lambda cls: name)}))
    rows.write.format(name).mode("append").option("path", path).option("batch", str(batch_id)).save()


def manifests(path: str) -> list[dict]:
    """What has been committed, by batch: batch, files and rows."""
    fs, root = filesystem(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/manifests", allow_not_found=True))
    whole = [f.path for f in found if f.base_name.startswith("batch=")]
    return sorted((json.loads(fs.open_input_file(p).read()) for p in whole), key=lambda m: m["batch"])


def read_committed(spark: SparkSession, path: str, schema: StructType, last: int | None = None) -> DataFrame:
    """The rows of all committed batches (up to ``last``): their files alone are read."""
    files = [f"{path}/{f}" for m in manifests(path) if last is None or m["batch"] <= last for f in m["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
