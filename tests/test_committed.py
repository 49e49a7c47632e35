import os

import pytest
from pyspark.sql import functions as F

from fleetboard.sinks import manifests, read_committed, write_committed

SCHEMA = "id long, name string"


def _rows(spark, first, n=100):
    return spark.range(first, first + n, 1, 4).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


def _ids(spark, path, **options):
    return sorted(r.id for r in read_committed(spark, path, spark.createDataFrame([], SCHEMA).schema, **options).collect())


def test_batches_are_there_as_a_whole(spark, workdir):
    path = f"{workdir}/t"
    assert _ids(spark, path) == [] and manifests(path) == []
    write_committed(_rows(spark, 0), path, 0)
    write_committed(_rows(spark, 100), path, 1)
    assert _ids(spark, path) == list(range(200)) and _ids(spark, path, last=0) == list(range(100))
    # A repeated batch takes its own place.
    write_committed(_rows(spark, 100, 50), path, 1)
    assert _ids(spark, path) == list(range(150)) and [m["rows"] for m in manifests(path)] == [100, 50]
    write_committed(_rows(spark, 0).limit(0), path, 2)
    assert _ids(spark, path) == list(range(150)) and manifests(path)[2]["files"] == []


def test_a_failed_task_leaves_nothing_to_read(spark, workdir):
    path = f"{workdir}/t"
    write_committed(_rows(spark, 0), path, 0)
    broken = _rows(spark, 100).withColumn("name", F.when(F.col("id") == 199, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        write_committed(broken, path, 1)
    assert _ids(spark, path) == list(range(100)) and len(manifests(path)) == 1
    write_committed(_rows(spark, 100), path, 1)
    assert _ids(spark, path) == list(range(200))
    named = {f"{path}/{f}" for m in manifests(path) for f in m["files"]}
    assert named <= {f"{path}/data/{f}" for f in os.listdir(f"{path}/data")}
