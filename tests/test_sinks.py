import json

from feeds import NOW
from pyspark.sql import functions as F

from fleetboard import schemas as S
from fleetboard.operators import compact
from fleetboard.sinks import (
    append_changes,
    compact_changes,
    read_board,
    read_changes,
    served,
    stop_upserts,
    to_upsert,
    write_archive,
)


def _stops(spark, *rows):
    full = [(s, None, None, None, "2023-08-05 22:18:05", NOW, page, "[]") for s, page in rows]
    return spark.createDataFrame(full, S.STOP_BOARD)


def test_upserts_keep_nulls(spark):
    df = spark.createDataFrame([("a", None)], "id string, x bigint")
    row = to_upsert(df, "id").first()
    assert row.key == "a" and json.loads(row.value) == {"id": "a", "x": None}


def test_pages_of_a_stop_have_their_own_keys(spark):
    board = _stops(spark, ("a", 0), ("a", 1), (None, 0), ("", 0), ("a#0#1", 0))
    keys = [json.loads(r.key) for r in stop_upserts(board).collect()]
    assert keys == [
        {"stopId": "a", "page": 0}, {"stopId": "a", "page": 1}, {"stopId": None, "page": 0},
        {"stopId": "", "page": 0}, {"stopId": "a#0#1", "page": 0},
    ]
    assert len({r.key for r in stop_upserts(board).collect()}) == 5


def test_changes_read_back_as_the_board(spark, workdir):
    upserts = stop_upserts(_stops(spark, ("a", 0), ("b", 0)))
    append_changes(upserts, f"{workdir}/c", 0)
    gone = upserts.where("key LIKE '%\"a\"%'").withColumn("value", F.lit(None).cast("string"))
    for _ in range(2):  # a repeated batch replaces itself
        append_changes(gone, f"{workdir}/c", 1)
    changes = read_changes(spark, f"{workdir}/c")
    assert changes.count() == 3
    assert [r.stopId for r in read_board(changes, S.STOP_BOARD).collect()] == ["b"]


def test_summed_up_changes_give_the_same_board(spark, workdir):
    up = lambda *rows: spark.createDataFrame(list(rows), "key string, value string")
    batches = [up(("a", "1"), ("b", "1")), up(("a", "2"), ("b", None)), up(("c", "3")), up(("c", None), ("b", "4"))]
    for n, rows in enumerate(batches):
        append_changes(rows, f"{workdir}/c", n)

    def board(base=None):
        return sorted((r.key, r.value) for r in compact(read_changes(spark, f"{workdir}/c", base), "key", "batch").collect())

    compact_changes(spark, f"{workdir}/c", f"{workdir}/base1", 1)
    assert read_changes(spark, f"{workdir}/c", f"{workdir}/base1").count() == 5
    compact_changes(spark, f"{workdir}/c", f"{workdir}/base2", 2, before=f"{workdir}/base1")
    assert board() == board(f"{workdir}/base1") == board(f"{workdir}/base2") == [("a", "2"), ("b", "4")]


def test_archive_is_partitioned_by_date(spark, workdir):
    df = spark.createDataFrame([("a", "2023-08-05"), ("b", "2023-08-06")], "id string, startDate string")
    write_archive(df, f"{workdir}/a")
    write_archive(df, f"{workdir}/a")
    got = spark.read.parquet(f"{workdir}/a").where("startDate = '2023-08-06'")
    assert [r.id for r in got.collect()] == ["b", "b"]
    assert "PartitionFilters: [isnotnull(startDate" in got._jdf.queryExecution().toString()


def test_served_rows_skip_deletes(spark):
    upserts = stop_upserts(_stops(spark, ("a", 0))).unionByName(
        spark.createDataFrame([("a", None)], "key string, value string")
    )
    assert [r.stopId for r in served(upserts, S.STOP_BOARD).collect()] == ["a"]
