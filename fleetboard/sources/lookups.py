"""Static lookup files, from any path Spark can read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetboard import schemas as S


def _named(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    absent = F.lit(None).cast("string")
    return raw.select(
        *[
            (F.col(f.name) if f.name in raw.columns else absent)
            .try_cast(f.dataType.simpleString())
            .alias(f.name)
            for f in schema
        ]
    )


def _lookup(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    if header:
        return _named(spark, path, schema)
    return spark.read.schema(schema).csv(path)


def read_trip_lookup(spark: SparkSession, path: str, *, header: bool = False) -> DataFrame:
    """Trips: 16 columns by position, or by the names in the header, in any order."""
    return _lookup(spark, path, S.TRIP_LOOKUP, header)


def read_stop_lookup(spark: SparkSession, path: str, *, header: bool = False) -> DataFrame:
    """Stops, coordinates as text: 16 columns by position, or by the names in the header."""
    return _lookup(spark, path, S.STOP_LOOKUP, header)


def read_stop_times(spark: SparkSession, path: str) -> DataFrame:
    """Scheduled calls, columns bound by their header names."""
    return _named(spark, path, S.STOP_TIMES)


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """Route points, columns bound by their header names."""
    return _named(spark, path, S.SHAPES)


def store_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``rows`` written to a new folder in ``buckets`` by hash of ``key``, each sorted by it, and read again.

    Tables stored by the same key in as many buckets join, and group, by it without a shuffle: a
    lookup or archive that many jobs read is dealt out once. The rows are dealt to their buckets
    before they are written, so that each bucket is one file; NULL keys, which join nothing, share one.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)
