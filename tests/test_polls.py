import pytest

from fleetboard.sources import land_polls, read_polls, run_to_end
from fleetboard.sources.polls import PollReader

SCHEMA = "poll int, id long, name string"


def _land(spark, path, polls, rows=7):
    df = spark.createDataFrame([(p, p * 100 + i, f"n{i}" if i else None) for p in polls for i in range(rows)], SCHEMA)
    df.repartition(3).write.mode("append").partitionBy("poll").parquet(path)


def _batches(spark, stream, root):
    seen = {}
    run_to_end(
        stream.writeStream.foreachBatch(lambda b, n: seen.__setitem__(n, sorted((r.poll, r.id, r.name) for r in b.collect())))
        .option("checkpointLocation", f"{root}/ck")
    )
    return seen


def _polls(rows):
    return sorted({r[0] for r in rows})


def test_polls_in_bounded_batches(spark, workdir):
    _land(spark, f"{workdir}/in", range(6))
    seen = _batches(spark, read_polls(spark, f"{workdir}/in", SCHEMA, first=1, last=4, per_batch=3), workdir)
    assert [_polls(rows) for _, rows in sorted(seen.items())] == [[1, 2, 3], [4]]
    assert sum(map(len, seen.values())) == 28 and (2, 200, None) in seen[0]
    slim = read_polls(spark, f"{workdir}/in", "name string, id bigint", per_batch=None)
    assert slim.columns == ["name", "id"]


def test_a_restarted_stream_loses_and_repeats_nothing(spark, workdir):
    _land(spark, f"{workdir}/in", [0, 1, 2])
    first = _batches(spark, read_polls(spark, f"{workdir}/in", SCHEMA, last=1), workdir)
    assert [_polls(rows) for _, rows in sorted(first.items())] == [[0], [1]]
    _land(spark, f"{workdir}/in", [5, 7])
    then = _batches(spark, read_polls(spark, f"{workdir}/in", SCHEMA), workdir)
    assert [_polls(rows) for _, rows in sorted(then.items())] == [[2], [5], [7]]
    assert not any(_batches(spark, read_polls(spark, f"{workdir}/in", SCHEMA), workdir).values())


def test_a_failed_batch_is_taken_again(spark, workdir):
    _land(spark, f"{workdir}/in", [0, 1, 2])
    tries, kept = [], []

    def sink(batch, n):
        tries.append(n)
        if tries == [0, 1]:
            raise RuntimeError("lost")
        kept.append(_polls([(r.poll,) for r in batch.collect()]))

    writer = read_polls(spark, f"{workdir}/in", SCHEMA).writeStream.foreachBatch(sink).option("checkpointLocation", f"{workdir}/ck")
    with pytest.raises(Exception, match="lost"):
        run_to_end(writer)
    writer = read_polls(spark, f"{workdir}/in", SCHEMA).writeStream.foreachBatch(sink).option("checkpointLocation", f"{workdir}/ck")
    run_to_end(writer)
    assert tries == [0, 1, 1, 2] and kept == [[0], [1], [2]]


def test_a_poll_that_is_being_written_holds_up_those_after_it(spark, workdir):
    import os

    df = spark.createDataFrame([(1, "a")], "id long, name string")
    for poll in (3, 5):
        df.write.parquet(f"{workdir}/in/poll={poll}")
    os.makedirs(f"{workdir}/in/poll=4")
    reader = PollReader(f"{workdir}/in", spark.createDataFrame([], SCHEMA).schema, None, None, None)
    assert reader.latestOffset() == {"poll": 3}
    df.write.mode("overwrite").parquet(f"{workdir}/in/poll=4")
    assert reader.latestOffset() == {"poll": 5} == reader.latestOffset()
    assert {p.value[0] for p in reader.partitions({"poll": 3}, {"poll": 5})} == {4, 5}


def test_no_polls_yet(spark, workdir):
    reader = PollReader(f"{workdir}/none", spark.createDataFrame([], SCHEMA).schema, 4, None, 1)
    assert reader.initialOffset() == reader.latestOffset() == {"poll": 3}
    assert reader.partitions({"poll": 3}, {"poll": 3}) == []
    empty = spark.createDataFrame([], SCHEMA)
    land_polls(empty, f"{workdir}/in")
    assert not any(_batches(spark, read_polls(spark, f"{workdir}/in", SCHEMA), workdir).values())
