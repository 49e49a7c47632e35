import json
import random

from feeds import NOW
from pyspark.sql import functions as F

from fleetboard import operators as O
from fleetboard.operators import pack, page_of


def _live(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, updateSec bigint, tripId string, shapeId string")


def test_latest_by_key_breaks_ties_by_content(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w"), (None, 5, "n")]
    want = {("a", 2, "z"), ("b", None, "w"), (None, 5, "n")}
    for _ in range(3):
        random.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t bigint, v string").repartition(3)
        assert {tuple(r) for r in O.latest_by_key(df, "k", "t").collect()} == want


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = O.latest_by_key(df, "k", "id")._jdf.queryExecution().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # printed top down


def test_compact(spark):
    rows = [("gone", "v", 1), ("gone", None, 2), ("back", None, 1), ("back", "w", 2)]
    df = spark.createDataFrame(rows, "key string, value string, seq bigint")
    assert [tuple(r) for r in O.compact(df, "key", "seq").collect()] == [("back", "w", 2)]


def test_ttl_keeps_exactly_300_seconds(spark):
    df = _live(spark, ("a", NOW - 300, "t", "1"), ("b", NOW - 301, "t", "1"), ("a", NOW - 400, "u", "1"))
    assert [(r.id, r.updateSec) for r in O.live_vehicles(df, as_of=NOW).collect()] == [("a", NOW - 300)]


def test_freshness_reaches_the_scan(spark, workdir):
    _live(spark, ("a", NOW, "t", "1")).write.mode("overwrite").parquet(workdir)
    df = O.live_vehicles(spark.read.parquet(workdir), as_of=NOW)
    assert f"GreaterThanOrEqual(updateSec,{NOW - 300})" in df._jdf.queryExecution().toString()


def test_service_hours(spark):
    # 04:59:59, 05:00:00 and 23:59:59 in Chicago on 2023-08-05
    secs = [1691229599, 1691229600, 1691297999]
    df = spark.createDataFrame([(s,) for s in secs], "updateSec bigint")
    assert [r[0] for r in O.within_service_hours(df, "updateSec").collect()] == secs[1:]


def test_roster_sorts_ids_as_text(spark):
    rows = [(i, "r", "t", "h", "s", 61) for i in ("9", "10", "2")]
    df = spark.createDataFrame(
        rows,
        "id string, routeName string, startTime string, tripHeadSign string, nextStopName string, nextStopApproachSec bigint",
    )
    got = O.roster(df).collect()
    assert [r.id for r in got] == ["10", "2", "9"] and got[0].etaMinutes == 2


def test_feed_status(spark):
    df = spark.createDataFrame([("2023-01-01 00:00:00",), ("2023-01-02 00:00:00",)], "updateTime string")
    assert tuple(O.feed_status(df).first()) == (2, False, "2023-01-02 00:00:00")
    assert tuple(O.feed_status(df.limit(0)).first()) == (0, True, None)


def test_trip_stop_lists(spark):
    rows = [("T", "c", 3), ("T", "a", 1), ("T", "b", 2), ("T", "b", 2), ("U", "z", None)]
    df = spark.createDataFrame(rows, "trip_id string, stop_id string, stop_sequence bigint")
    got = {r.trip_id: r for r in O.trip_stop_lists(df).collect()}
    assert got["T"].stop_ids == ["a", "b", "b", "c"] and [s.n for s in got["T"].stops] == [1, 2, 1]
    assert got["U"].stop_ids == ["z"]


def test_route_shapes_and_selected_route(spark):
    rows = [("07", -89.5, 43.0, 2), ("7", -89.0, 43.5, 1), ("x", 0.0, 0.0, 1), ("8", 1.0, 1.0, 1)]
    shapes = spark.createDataFrame(
        rows, "shape_id string, shape_pt_lon double, shape_pt_lat double, shape_pt_sequence bigint"
    )
    paths = {r["shape"]: r for r in O.route_shapes(shapes).collect()}
    assert set(paths) == {7.0, 8.0}
    assert paths[7.0].path == [[-89.0, 43.5], [-89.5, 43.0]]
    assert json.loads(paths[7.0].feature) == {
        "type": "Feature",
        "properties": {},
        "geometry": {"type": "LineString", "coordinates": [[-89.0, 43.5], [-89.5, 43.0]]},
    }
    live = _live(spark, ("v", NOW, "T", "7.0"), ("w", NOW, "T", "9"), ("u", NOW, "T", None))
    assert [(r.id, r["shape"]) for r in O.vehicle_route(live, shapes, "v").collect()] == [("v", 7.0)]
    assert O.vehicle_route(live, shapes, "w").count() == 0
    assert [r["shape"] for r in O.routes_in_use(live, shapes).collect()] == [7.0]


def test_flag_trip_stops(spark):
    stops = spark.createDataFrame([("a",), ("b",)], "stop_id string")
    times = spark.createDataFrame([("T", "a", 1), ("T", "a", 2)], "trip_id string, stop_id string, stop_sequence bigint")
    live = _live(spark, ("v", NOW, "T", "1"), ("w", NOW, "gone", "1"))

    def flags(vehicle):
        return {r.stop_id: r.onTrip for r in O.flag_trip_stops(stops, times, live, vehicle).collect()}

    assert flags("v") == {"a": True, "b": False}
    assert flags("w") == flags(None) == flags("nobody") == {"a": False, "b": False}


def _rows(spark):
    rows = [("hot", i, f"p{i}") for i in range(1000)] + [("hot", 7, f"q{i}") for i in range(30)]
    rows += [(None, i, "n") for i in range(120)] + [("cold", i, "c") for i in range(50)] + [("cold", None, "x")]
    random.Random(1).shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, pos bigint, v string")


def _packed(df):
    return pack(df.withColumn("page", page_of("pos", 50)), ["k"], ["pos", "v"]).collect()


def test_pack_keeps_every_row_in_order(spark):
    rows, df = _rows(spark)
    lists = _packed(df)
    assert sorted(((r.k, e.pos, e.v) for r in lists for e in r.entries), key=repr) == sorted(rows, key=repr)
    assert len({(r.k, r.page) for r in lists}) == len(lists)
    for r in lists:
        assert [(e.pos, e.v) for e in r.entries] == sorted(((e.pos, e.v) for e in r.entries), key=lambda x: (x[0] is not None, x))
        assert all((-1 if e.pos is None else e.pos // 50) == r.page for e in r.entries)
    assert sorted(r.page for r in lists if r.k == "cold") == [-1, 0]


def test_further_rows_move_no_other_row(spark):
    _, df = _rows(spark)
    before = {(r.k, r.page): r for r in _packed(df)}
    more = spark.createDataFrame([("cold", 5000 + i, "z") for i in range(5000)], df.schema)
    after = {(r.k, r.page): r for r in _packed(df.unionAll(more))}
    assert {k: after[k] for k in before} == before


def _shape(spark, *rows):
    return spark.createDataFrame(
        list(rows), "shape_id string, shape_pt_lon double, shape_pt_lat double, shape_pt_sequence bigint"
    )


def test_pages_of_a_path_joined_in_order_are_the_path(spark):
    rng = random.Random(4)
    points = [(rng.random(), rng.random()) for _ in range(40)]
    shapes = _shape(spark, *[("5", *p, i) for i, p in enumerate(points)]).repartition(4)
    pages = sorted(O.route_shapes(shapes, page_size=7).collect(), key=lambda r: r.page)
    assert [tuple(p) for r in pages for p in r.path] == points and len(pages) == 6


def test_repeated_points_stay(spark):
    closed = _shape(spark, ("1", 0.0, 0.0, None), ("1", 1.0, 0.0, None), ("1", 0.0, 0.0, None))
    (row,) = O.route_shapes(closed).collect()
    assert sorted(map(tuple, row.path)) == [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0)]


def test_a_tie_falls_to_the_last_to_arrive(spark):
    rows = [("v", NOW, "zz", 1), ("v", NOW, "aa", 2)]
    df = spark.createDataFrame(rows, "id string, updateSec bigint, tripId string, seq bigint")
    assert O.live_vehicles(df, as_of=NOW).first().tripId == "aa"


def _shuffles(spark, df):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shows reuse in the plan
    try:
        plan = df()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return sum(" Exchange " in line or line.strip().startswith("Exchange") for line in plan.splitlines())


def test_lists_need_two_shuffles(spark):
    times = spark.createDataFrame([("T", "a", 1)], "trip_id string, stop_id string, stop_sequence bigint")
    assert _shuffles(spark, lambda: O.trip_stop_lists(times)) <= 2
    assert _shuffles(spark, lambda: O.route_shapes(_shape(spark, ("1", 0.0, 0.0, 1)))) <= 2
