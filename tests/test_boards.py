import json

from feeds import NOW, long_trip, messages, stop, stop_lookup, trip_lookup, trip_update, vehicle

from fleetboard import operators as O
from fleetboard import schemas as S
from fleetboard.sources import parse_trip_update, parse_vehicle


def _board(spark, vehicles, trips, **options):
    board = O.vehicle_board(
        parse_vehicle(messages(spark, vehicles)),
        parse_trip_update(messages(spark, trips)),
        trip_lookup(spark, ("T1", "700", "L", "EAST")),
        stop_lookup(spark, ("s11", "Eleven"), ("a", "A")),
        as_of=NOW,
        ingested_at=NOW,
        **options,
    )
    assert board.schema.simpleString() == S.VEHICLE_BOARD.simpleString()
    return {r.id: r for r in board.collect()}


def _entries(spark, trips, **options):
    return O.stop_entries(
        parse_trip_update(messages(spark, trips)),
        trip_lookup(spark, ("T1", "700", "L", "EAST"), ("T2", "701", "M", "NORTH")),
        as_of=NOW,
        **options,
    )


def test_vehicle_board_row(spark):
    row = _board(spark, [vehicle("v", "T1", NOW - 10)], [long_trip()])["v"]
    assert row.asDict() == {
        "id": "v",
        "tripId": "T1",
        "shapeId": "700",
        "routeName": "L",
        "tripHeadSign": "EAST",
        "startDate": "2023-08-05",
        "startTime": "21:50:00",
        "latitude": 43.0,
        "longitude": -89.5,
        "updateTime": "2023-08-05 22:17:55",
        "nextStopSequence": "39",
        "nextStopId": "s11",
        "nextStopName": "Eleven",
        "nextStopApproachSec": None,
        "nextStopDelay": None,
        "ingestionTime": "2023-08-05 22:18:05",
        "updateSec": NOW - 10,
    }


def test_vehicles_without_trip_or_update(spark):
    rows = _board(
        spark, [vehicle("none", None), vehicle("lost", "T9"), vehicle("bad", "T1", start_date="2023080x")], []
    )
    for name in rows:
        r = rows[name]
        assert (r.nextStopSequence, r.nextStopId, r.nextStopApproachSec) == ("0", "0", 0)
        assert r.nextStopName is None and r.startTime is None
    assert rows["none"].tripId is None and rows["none"].startDate is None
    assert rows["lost"].routeName is None and rows["lost"].startDate == "2023-08-05"
    assert rows["bad"].startDate is None and rows["bad"].routeName == "L"
    assert _board(spark, [vehicle("x", None)], [], sentinel=None)["x"].nextStopId is None


def test_freshness_is_strict(spark):
    rows = _board(spark, [vehicle("old", "T1", NOW - 150), vehicle("new", "T1", NOW - 149)], [])
    assert set(rows) == {"new"}


def test_newest_rows_win_whatever_the_order(spark):
    vehicles = [vehicle("v", "T9", NOW - 1), vehicle("v", "T1", NOW - 5)]
    assert _board(spark, vehicles, [])["v"].tripId == "T9"
    newer = trip_update("T1", [stop(1, "a", NOW + 5)], NOW)
    older = trip_update("T1", [stop(2, "s11", NOW + 5)], NOW - 60)
    for trips in ([newer, older], [older, newer]):
        assert _board(spark, [vehicle("v", "T1")], trips)["v"].nextStopId == "a"


def test_stop_entries_of_a_long_trip(spark):
    rows = _entries(spark, [long_trip()]).collect()
    assert len(rows) == 11 and sum(r.stopId is None for r in rows) == 1
    assert _entries(spark, [long_trip("T9")]).count() == 0


def test_stop_board_groups_and_latest(spark):
    trips = [
        trip_update("T1", [stop(1, "a", NOW + 5, 30), stop(2, "b", NOW + 9)], NOW),
        trip_update("T2", [stop(1, "a", NOW + 7)], NOW - 100),
    ]
    stops = stop_lookup(spark, ("a", "A"))
    entries = _entries(spark, trips)
    groups = O.stop_board_groups(entries, stops).collect()
    assert len(groups) == 3
    latest = {r.stopId: r for r in O.stop_board_latest(entries, stops).collect()}
    assert latest["a"].updateTime == "2023-08-05 22:18:05"
    assert (latest["a"].stopName, latest["a"].stopLat, latest["b"].stopName) == ("A", "43.1", None)
    assert json.loads(latest["a"].info) == [
        {
            "id": "T1",
            "routeName": "L",
            "tripHeadSign": "EAST",
            "arrivalTime": "2023-08-05 22:18:10",
            "delay": "30",
            "n": 1,
        }
    ]
    merged = O.stop_board_latest(entries, stops, group_by_time=False).collect()
    assert {r.stopId: len(json.loads(r.info)) for r in merged} == {"a": 2, "b": 1}
    typed = O.stop_board_latest(entries, stops, typed=True)
    assert typed.schema["stopLat"].dataType.simpleString() == "float"


def test_repeated_updates_count_once_unless_asked(spark):
    same = trip_update("T1", [stop(1, "a", NOW + 5)])
    stops = stop_lookup(spark, ("a", "A"))
    for dedupe, n in ((True, 1), (False, 2)):
        entries = _entries(spark, [same, same], dedupe=dedupe)
        (row,) = O.stop_board_groups(entries, stops).collect()
        assert json.loads(row.info)[0]["n"] == n


def test_stale_trip_updates_are_not_on_the_stop_board(spark):
    at = [stop(1, "a", NOW + 5)]
    assert _entries(spark, [trip_update("T1", at, NOW - 150)]).count() == 0
    assert _entries(spark, [trip_update("T1", at, NOW - 149)]).count() == 1


def test_null_stop_keeps_its_group(spark):
    board = O.stop_board_latest(_entries(spark, [long_trip()]), stop_lookup(spark, ("s12", "x")))
    rows = {r.stopId: r for r in board.collect()}
    assert None in rows and len(rows) == 11


def test_archive(spark):
    row = O.vehicle_archive(parse_vehicle(messages(spark, [vehicle("v", "T1")]))).first()
    assert (row.routeId, row.bearing, row.vehicleLabel) == ("810", 225.0, "4711")


def _inputs(spark):
    vehicles = [vehicle(f"v{i}", f"T{i % 3}") for i in range(9)] + [vehicle("n", None)]
    trips = [long_trip("T1"), long_trip("T2"), long_trip("T8")]
    return (
        parse_vehicle(messages(spark, vehicles)),
        parse_trip_update(messages(spark, trips)),
        trip_lookup(spark, ("T1", "700", "L", "EAST")),
        stop_lookup(spark, ("s11", "Eleven")),
    )


def test_building_the_board_starts_no_job(spark):
    inputs = _inputs(spark)
    spark.sparkContext.setJobGroup("building", "")
    try:
        board = O.vehicle_board(*inputs, as_of=NOW)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert board.count() == 10


def test_vehicles_without_trip_are_not_dealt_to_one_task(spark):
    vehicles = [vehicle(f"v{i}", None) for i in range(40)]
    state = O.vehicle_state(parse_vehicle(messages(spark, vehicles)), as_of=NOW)
    keys = O.with_probe(state, "tripId").select("_probe").distinct()
    assert keys.count() == 40


def test_pages_of_a_busy_stop_hold_all_its_calls(spark):
    calls = [stop(i, "a", NOW + i) for i in range(300)] + [stop(301, "b", NOW)]
    stops = stop_lookup(spark, ("a", "A"))

    def pages(calls):
        entries = _entries(spark, [trip_update("T1", calls)], page_s=20)
        rows = O.stop_board_latest(entries, stops).collect()
        return {(r.stopId, r.page): r for r in rows}

    rows = pages(calls)
    busy = [r for (s, _), r in rows.items() if s == "a"]
    assert len(busy) in (15, 16) and all(r.stopName == "A" for r in busy)
    found = [e["arrivalTime"] for r in busy for e in json.loads(r.info)]
    assert len(found) == len(set(found)) == 300
    # Further calls of the stop move no other row.
    more = pages([*calls, *[stop(400 + i, "a", NOW + 2000 + i) for i in range(500)]])
    assert {k: more[k] for k in rows} == rows


def test_options_of_the_next_stop_hold_for_the_calls(spark):
    arrives = parse_trip_update(messages(spark, [trip_update("T1", [stop(1, "a", arrival=NOW + 5, arrival_delay=-60)])]))
    sizes = [
        len(O.trip_state(arrives, calls=True, **options).first().calls)
        for options in ({}, {"use_arrival": True}, {"use_arrival": True, "add_delay": False})
    ]
    assert sizes == [0, 0, 1]


def test_the_wall_clock_is_now_by_default(spark):
    import time

    now = int(time.time())
    events = [vehicle("new", "T1", now - 5), vehicle("old", "T1", now - 400)]
    trips = [trip_update("T1", [stop(1, "a", now + 500)], now)]
    read = parse_vehicle(messages(spark, events)), parse_trip_update(messages(spark, trips))
    lookups = trip_lookup(spark, ("T1", "700", "L", "EAST")), stop_lookup(spark, ("a", "A"))
    (row,) = O.vehicle_board(*read, *lookups).collect()
    assert row.id == "new" and row.nextStopName == "A" and row.ingestionTime is not None
    entries = O.stop_entries(read[1], lookups[0])
    assert O.stop_board_latest(entries, lookups[1]).first().stopName == "A"
    assert O.live_vehicles(O.vehicle_state(read[0], horizon_s=None)).count() == 1


def _semi_joins(plan):
    found = []
    if plan.nodeName() == "Join" and plan.joinType().toString() == "LeftSemi":
        found.append(plan)
    children = plan.children()
    for i in range(children.size()):
        found += _semi_joins(children.apply(i))
    return found


def test_stop_lists_stay_behind_when_updates_meet_vehicles(spark):
    board = O.vehicle_board(
        parse_vehicle(messages(spark, [vehicle("v", "T1", NOW - 10)])),
        parse_trip_update(messages(spark, [long_trip()])),
        trip_lookup(spark, ("T1", "700", "L", "EAST")),
        stop_lookup(spark, ("s11", "Eleven")),
        as_of=NOW,
        ingested_at=NOW,
    )
    (join,) = _semi_joins(board._jdf.queryExecution().optimizedPlan())
    moved = join.left().schema().simpleString()
    assert "stopId" in moved and "array" not in moved
