"""Landed polls of a feed as a stream with offsets.

Each poll is a folder ``poll=<number>`` of Parquet files under one path. A stream over it takes
whole polls, a bounded number per micro-batch, from a first to a last one; the offset of a batch is
the last poll in it, so that a restarted stream goes on after the last poll it has planned and a
part of the feed can be replayed. The driver lists folders only; files are read by the tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

POLL = "poll"
#: Rows that a task reads at once.
ROWS = 10_000


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, on whatever machine this runs."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class PollReader(DataSourceStreamReader):
    """Offsets are ``{"poll": n}``: all polls up to ``n`` have been taken."""

    def __init__(self, path: str, schema: StructType, first: int | None, last: int | None, per_batch: int | None):
        self._path, self._schema = path, schema
        self._first, self._last, self._per_batch = first, last, per_batch
        self._at: int | None = None

    def _landed(self) -> list[int]:
        """Numbers of the polls up to the first that is still being written."""
        fs, root = filesystem(self._path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        folders = {int(f.base_name.removeprefix(f"{POLL}=")): f.path for f in found if f.base_name.startswith(f"{POLL}=")}
        whole = any(f.base_name == "_SUCCESS" for f in found)
        numbers = []
        for number in sorted(folders):
            if not whole and fs.get_file_info(f"{folders[number]}/_SUCCESS").type == pafs.FileType.NotFound:
                break
            numbers.append(number)
        return numbers

    def initialOffset(self) -> dict:
        return {POLL: -1 if self._first is None else self._first - 1}

    def latestOffset(self) -> dict:
        if self._at is None:
            self._at = self.initialOffset()[POLL]
        ahead = [n for n in self._landed() if n > self._at and (self._last is None or n <= self._last)]
        ahead = ahead[: self._per_batch]
        if ahead:
            self._at = ahead[-1]
        return {POLL: self._at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A restarted stream asks for the last batch it has planned before it asks for the latest offset.
        self._at = max(end[POLL], -1 if self._at is None else self._at)
        fs, root = filesystem(self._path)
        found = []
        for number in self._landed():
            if start[POLL] < number <= end[POLL]:
                files = fs.get_file_info(pafs.FileSelector(f"{root}/{POLL}={number}", recursive=True))
                found += [InputPartition((number, f.path)) for f in files if f.base_name.endswith(".parquet") and not f.base_name.startswith((".", "_"))]
        return found

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        number, path = partition.value
        schema = to_arrow_schema(self._schema)
        fs, _ = filesystem(self._path)
        with fs.open_input_file(path) as file:
            names = [n for n in schema.names if n != POLL]
            for batch in pq.ParquetFile(file).iter_batches(ROWS, columns=names):
                columns = [pa.repeat(number, len(batch)).cast(f.type) if f.name == POLL else batch[f.name].cast(f.type) for f in schema]
                yield pa.record_batch(columns, schema=schema)


class PollSource(DataSource):
    """A source of polls: options path, first, last (poll numbers, both taken) and perBatch."""

    @classmethod
    def name(cls) -> str:
        return "polls"

    def schema(self) -> str:
        raise ValueError("the schema of polls has to be given")

    def streamReader(self, schema: StructType) -> PollReader:
        number = lambda name: int(self.options[name]) if name in self.options else None
        return PollReader(self.options["path"], schema, number("first"), number("last"), number("perBatch"))


def land_polls(rows: DataFrame, path: str) -> None:
    """Write ``rows`` as polls by their column ``poll``; the stream sees them once all are written."""
    rows.write.partitionBy(POLL).parquet(path)


def read_polls(
    spark: SparkSession, path: str, schema: StructType | str, *, first: int | None = None, last: int | None = None,
    per_batch: int | None = 1,
) -> DataFrame:
    """A stream of landed polls, ``per_batch`` of them in each micro-batch (None: all that have landed).

    ``schema`` may name ``poll``. With ``last`` the stream has an end: ``run_to_end`` waits for it.
    """
    # Sessions of one application share the names of sources but not the sources: each stream has its own.
    name = f"{PollSource.name()}_{uuid.uuid4().hex}"
    spark.dataSource.register(type("PollSource", (PollSource,), {"name": classmethod(lambda cls: name)}))
    options = {"path": path, "first": first, "last": last, "perBatch": per_batch}
    given = {k: str(v) for k, v in options.items() if v is not None}
    return spark.readStream.format(name).schema(schema).options(**given).load()


def run_to_end(writer) -> None:
    """Run a stream until it has taken all that has landed for it, and stop it."""
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
