import pytest
from feeds import NOW, long_trip, messages, stop, trip_update
from pyspark.sql import functions as F

from fleetboard.functions import (
    epoch_seconds,
    eta_minutes,
    iso_date,
    local_time,
    next_stop,
)
from fleetboard.functions.transit import MAX_LOOKAHEAD
from fleetboard.operators import calls_of
from fleetboard.sources import parse_trip_update

def _update():
    return F.col("tripUpdate")


def _next(spark, event, **options):
    parsed = parse_trip_update(messages(spark, [event]))
    u = _update()
    chosen = next_stop(u["stopTimeUpdate"], u["timestamp"], **options)
    return tuple(parsed.select(chosen.alias("n")).first().n)


def test_next_stop_of_a_long_trip(spark):
    assert _next(spark, long_trip()) == ("39", "s11", None, None)
    assert _next(spark, long_trip(), null_delay_as_zero=True) == ("39", "s11", 15, None)


def test_all_entries_are_looked_at_unless_limited(spark):
    stops = [stop(i, f"s{i}", NOW + (100 if i > 20 else -100)) for i in range(1, 26)]
    event = trip_update("T", stops)
    assert _next(spark, event)[:2] == ("21", "s21")
    assert _next(spark, event, max_lookahead=MAX_LOOKAHEAD) == ("0", "0", 0, None)
    assert _next(spark, event, max_lookahead=MAX_LOOKAHEAD, sentinel=None) == (None, None, None, None)


@pytest.mark.parametrize("stops", [None, []])
def test_no_entries(spark, stops):
    assert _next(spark, trip_update("T", stops)) == ("0", "0", 0, None)


def test_delays(spark):
    late = trip_update("T", [stop(1, "a", NOW - 50, -60), stop(2, "b", NOW - 50, 60)])
    assert _next(spark, late) == ("2", "b", 10, "-60")
    assert _next(spark, late, delay_of="chosen") == ("2", "b", 10, "60")
    assert _next(spark, late, add_delay=False) == ("0", "0", 0, "-60")
    garbage = trip_update("T", [stop(1, "a", NOW + 5, "x")])
    assert _next(spark, garbage) == ("1", "a", None, "x")
    exact = trip_update("T", [stop(1, "a", NOW - 5, 5)])
    assert _next(spark, exact) == ("1", "a", 0, "5")


def test_arrival_only_entries(spark):
    last = trip_update("T", [stop(1, "a", arrival=NOW + 30)])
    assert _next(spark, last) == ("0", "0", 0, None)
    assert _next(spark, last, use_arrival=True)[:2] == ("1", "a")


def test_unknown_delay_choice(spark):
    with pytest.raises(ValueError):
        next_stop(_update(), F.lit(0), delay_of="last")


def test_upcoming_calls_of_a_long_trip(spark):
    parsed = parse_trip_update(messages(spark, [long_trip()]))
    calls = parsed.select(F.inline(calls_of(_update()))).collect()
    assert len(calls) == 11
    assert [c.stopId for c in calls].count(None) == 1
    assert calls[-1].stopId == "s21"


def test_call_delay_falls_back_to_arrival(spark):
    event = trip_update("T", [stop(1, "a", NOW + 9, None, NOW + 3, 7)])
    parsed = parse_trip_update(messages(spark, [event]))
    assert tuple(parsed.select(F.inline(calls_of(_update()))).first()) == ("a", NOW + 9, "7")


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Europe/Paris", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select 1691291670L a, 1699164000L b, 1699167600L c, "
            "timestamp_ntz'2023-03-12 02:30:00' gap, timestamp_ntz'2023-08-06 03:14:30.9' d"
        ).select(
            local_time(F.col("a")).alias("a"),
            local_time(F.col("b")).alias("b"),
            local_time(F.col("c")).alias("c"),
            epoch_seconds(F.col("gap")).alias("gap"),
            epoch_seconds(F.col("d")).alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.a == "2023-08-05 22:14:30"
    assert row.b == row.c == "2023-11-05 01:00:00"
    assert row.gap == 1678588200
    assert row.d == 1691291670


def test_dates(spark):
    df = spark.createDataFrame([("20230805",), ("2023080x",), (None,)], "s string")
    assert [r[0] for r in df.select(iso_date(F.col("s"))).collect()] == ["2023-08-05", None, None]


def test_eta_minutes(spark):
    df = spark.createDataFrame([(0,), (1,), (60,), (61,), (-61,), (None,)], "s bigint")
    assert [r[0] for r in df.select(eta_minutes(F.col("s"))).collect()] == [0, 1, 1, 2, -1, 0]
    kept = df.select(eta_minutes(F.col("s"), null_as_zero=False)).collect()
    assert kept[-1][0] is None
