"""What the operators of this subpackage share: folders, cuts of lineage, files, components."""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of an Arrow batch that carries texts: bounds what a Python worker holds.
TEXT_ROWS = 500


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where the session names none, a folder in its warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints").rstrip("/")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: no lineage behind it.

    Its files are what a lost executor cannot take away.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``cut`` that nothing reads any more."""
    spark = df.sparkSession
    plain = lambda uri: re.sub(r"^file:/*", "/", uri)
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if plain(folder).startswith(plain(shared_root(spark)) + "/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Make Arrow batches small enough for long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines that have this folder import the package from it.

    On a cluster the package is shipped as any other, with ``--py-files`` or an image.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, on whatever machine this runs."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def create_file(uri: str) -> pa.NativeFile:
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_stream(uri: str) -> io.BufferedReader:
    fs, path = filesystem(uri)
    return io.BufferedReader(fs.open_input_stream(path, compression=None), 1 << 20)


def open_file(uri: str) -> pa.NativeFile:
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def attempt_name(stem: str) -> str:
    """A file name that no other attempt of the same task uses.

    The rows of the attempt that succeeds name its file; others are never read.
    """
    return f"{stem}-{uuid.uuid4().hex[:12]}"


def numbered(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows``, written in order, with ``g``: their number from 0. One count a partition reaches the driver."""
    dealt = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    # The number of its partition and, in the lower 33 bits, the row's number there.
    written = cut(dealt.withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r.part: r.n for r in written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    first = F.get(F.array(*[F.lit(b) for b in before]) if len(before) < 1000 else _long_array(before), part)
    return written.withColumn("g", (first + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_at")


def _long_array(values: list[int]) -> Column:
    """An array of many numbers, as one literal that Spark unfolds once."""
    return F.from_json(F.lit("[" + ",".join(map(str, values)) + "]"), "array<bigint>")


def one_text(rows: DataFrame, *by: str) -> DataFrame:
    """Of the rows of each ``by`` one text: that of least hash. A task sends one for each."""
    return rows.groupBy(*by).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def in_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``function`` on each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b; long): node, component (its smallest node).

    Alternates large-star and small-star steps, each of which hangs nodes under the smallest
    neighbour they know, until every edge leads to its component's smallest node. Per step the
    smallest neighbour is pre-aggregated and joined back, so a node with very many neighbours
    is never gathered. Each step's edges are a written table; only two numbers reach the driver.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def smallest(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) with m, the least of u and all its v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while (new := state(now)) != seen:
        seen = new
        if not new[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = smallest(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = smallest(down)
        after = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        before, now = now, cut(after.where("a <> b").distinct(), "edges")
        forget(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
