import json

from feeds import NOW, long_trip, messages, trip_update, vehicle
from pyspark.sql import functions as F

from fleetboard import schemas as S
from fleetboard.sources import (
    entity_json,
    explode_feed,
    parse_trip_update,
    parse_vehicle,
    read_landed,
    read_shapes,
    read_stop_lookup,
    read_stop_times,
    read_topic,
    read_trip_lookup,
    split_corrupt,
    with_rowtime,
)


def test_vehicle_events_have_the_declared_types(spark):
    parsed = parse_vehicle(messages(spark, [vehicle("1", "T")]))
    kind = parsed.schema["vehicle"].dataType
    want = S.VEHICLE_EVENT["vehicle"].dataType
    assert kind.simpleString() == want.simpleString()
    update = parse_trip_update(messages(spark, [trip_update("T", [])]))
    want = S.TRIP_UPDATE_EVENT["tripUpdate"].dataType
    assert update.schema["tripUpdate"].dataType.simpleString() == want.simpleString()


def test_quoted_and_bare_epochs(spark):
    quoted, bare = vehicle("1", "T"), vehicle("2", "T")
    bare["vehicle"]["timestamp"] = NOW
    rows = parse_vehicle(messages(spark, [quoted, bare])).select("vehicle.timestamp").collect()
    assert [r[0] for r in rows] == [NOW, NOW]


def test_absent_numbers(spark):
    event = vehicle("1", None)
    del event["vehicle"]["timestamp"]
    zero = parse_vehicle(messages(spark, [event])).first().vehicle
    assert (zero.timestamp, zero.position.speed, zero.occupancyPercentage) == (0, 0.0, 0)
    assert zero.trip is None
    null = parse_vehicle(messages(spark, [event]), defaults="null").first().vehicle
    assert (null.timestamp, null.position.speed, null.occupancyPercentage) == (None, None, None)
    del event["vehicle"]["position"]
    assert parse_vehicle(messages(spark, [event])).first().vehicle.position is None


def test_numeric_sequence_becomes_text(spark):
    update = parse_trip_update(messages(spark, [long_trip()])).first().tripUpdate
    assert update.stopTimeUpdate[0].stopSequence == "29"
    assert update.timestamp == NOW


def test_malformed_json_is_set_aside(spark):
    parsed = parse_vehicle(messages(spark, [vehicle("1", "T"), '{"id": "2", "vehicle": {']))
    good, bad = split_corrupt(parsed)
    assert [r.id for r in good.collect()] == ["1"]
    assert bad.first()["_corrupt_record"].startswith('{"id": "2"')


def test_strict_mode_names_unknown_keys_at_any_depth(spark):
    event = vehicle("1", "T")
    event["extra"] = 1
    event["vehicle"]["trip"]["odd"] = 1
    row = parse_vehicle(messages(spark, [event]), mode="strict").first()
    assert sorted(row["_unknown_keys"]) == ["extra", "odd"]
    row = parse_trip_update(messages(spark, [long_trip()]), mode="strict").first()
    assert sorted(row["_unknown_keys"]) == ["stop_id", "stop_sequence"]
    clean = parse_trip_update(messages(spark, [trip_update("T", None)]), mode="strict")
    good, bad = split_corrupt(clean)
    assert good.count() == 1 and bad.count() == 0


def test_unknown_keys_are_ignored_by_default(spark):
    row = parse_trip_update(messages(spark, [long_trip()])).first()
    assert row.tripUpdate.stopTimeUpdate[18].stopId is None


def test_entity_json_round_trip(spark):
    events = parse_vehicle(messages(spark, [vehicle("1", "T"), vehicle("2", None)]))
    text = events.select(entity_json(events, "id", "vehicle").alias("value"))
    first = json.loads(text.first().value)
    assert first["vehicle"]["timestamp"] == str(NOW)
    again = parse_vehicle(text)
    assert again.select("id", "vehicle").collect() == events.select("id", "vehicle").collect()


def test_explode_feed(spark, workdir):
    feed = {"header": {"timestamp": "1"}, "entity": [vehicle("1", "T"), vehicle("2", "T")]}
    with open(f"{workdir}/a.json", "w") as f:
        f.write("\n".join(json.dumps(x) for x in (feed, {"entity": []}, {"header": {}})))
        f.write('\n{"entity": [{"id": "3"}\n')
    landed = read_landed(spark, f"{workdir}/a.json").withColumn("topic", F.lit("VehiclePositions"))
    good, bad = explode_feed(landed)
    assert [(r.value, r.topic) for r in bad.collect()] == [('{"entity": [{"id": "3"}', "VehiclePositions")]
    rows = good.collect()
    assert {r.topic for r in rows} == {"VehiclePositions"}
    assert [json.loads(r.key) for r in rows] == [{"id": "1"}, {"id": "2"}]
    assert json.loads(rows[0].value) == feed["entity"][0]


def test_lookups_bind_by_position(spark, workdir):
    line = ",".join(f"c{i}" for i in range(14)) + ",1,2\n"
    with open(f"{workdir}/trips.txt", "w") as f:
        f.write(line)
    row = read_trip_lookup(spark, f"{workdir}/trips.txt").first()
    assert (row.trip_id, row.shape_id, row.bikes_allowed) == ("c3", "c8", 2)
    with open(f"{workdir}/stops.txt", "w") as f:
        f.write("s1" + ",y" * 15 + "\n")
    rows = read_stop_lookup(spark, f"{workdir}/stops.txt").collect()
    assert [(r.stop_id, r.stop_lat) for r in rows] == [("s1", "y")]


def test_a_header_binds_lookups_in_any_order(spark, workdir):
    with open(f"{workdir}/stops.txt", "w") as f:
        f.write("stop_lat,stop_name,extra,stop_id\n43.1,First,q,s1\n")
    row = read_stop_lookup(spark, f"{workdir}/stops.txt", header=True).first()
    assert (row.stop_id, row.stop_name, row.stop_lat, row.stop_code) == ("s1", "First", "43.1", None)
    with open(f"{workdir}/trips.txt", "w") as f:
        f.write("shape_id,bikes_allowed,trip_id\n7,1,T\n")
    row = read_trip_lookup(spark, f"{workdir}/trips.txt", header=True).first()
    assert (row.trip_id, row.shape_id, row.bikes_allowed) == ("T", "7", 1)


def test_schedule_files_bind_by_header(spark, workdir):
    with open(f"{workdir}/stop_times.txt", "w") as f:
        f.write("stop_id,trip_id,extra,stop_sequence\n9,T,q,4\n8,T,q,x\n")
    rows = read_stop_times(spark, f"{workdir}/stop_times.txt").collect()
    assert [tuple(r) for r in rows] == [("T", "9", 4), ("T", "8", None)]
    with open(f"{workdir}/shapes.txt", "w") as f:
        f.write("shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon\n7,1,43.5,-89.25\n")
    row = read_shapes(spark, f"{workdir}/shapes.txt").first()
    assert tuple(row) == ("7", -89.25, 43.5, 1)


def test_rowtime(spark):
    df = spark.range(1).select(F.lit(NOW).cast("bigint").alias("s"))
    row = with_rowtime(df, "s").select(F.unix_seconds("rowtime").alias("t")).first()
    assert row.t == NOW
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("s"))
    marked = with_rowtime(stream, "s", "3 minutes")._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in marked and "3 minutes" in marked
    assert "EventTimeWatermark" not in with_rowtime(stream, "s", None)._jdf.queryExecution().analyzed().toString()


class _Reader:
    """Stands in for the session where the topic source is not installed."""

    def __init__(self):
        self.options_seen = {}
        self.read = self.readStream = self

    def format(self, name):
        self.options_seen["format"] = name
        return self

    def options(self, **options):
        self.options_seen.update(options)
        return self

    def option(self, name, value):
        self.options_seen[name] = value
        return self

    def load(self):
        return self.options_seen


def test_topic_options():
    broker = {"kafka.bootstrap.servers": "b:9092", "subscribe": "t"}
    assert read_topic(_Reader(), broker) == {
        "format": "kafka", **broker, "startingOffsets": "latest"
    }
    assert read_topic(_Reader(), broker, starting="earliest")["startingOffsets"] == "earliest"
    once = read_topic(_Reader(), broker, stream=False)
    assert (once["startingOffsets"], once["endingOffsets"]) == ("earliest", "latest")


def test_messages_are_made_before_the_step_that_reads_them(spark, capsys):
    events = parse_trip_update(messages(spark, [long_trip(), long_trip("T2")])).select("id", "tripUpdate", "seq")
    texts = events.select("seq", entity_json(events, "id", "tripUpdate").alias("value"))
    parsed = parse_trip_update(texts)
    parsed.explain()
    steps = [line for line in capsys.readouterr().out.splitlines() if "from_json" in line]
    assert steps and not [line for line in steps if "StructsToJson" in line]
    order = lambda df: df.select("seq", "id", "tripUpdate").orderBy("seq").collect()
    assert order(parsed) == order(events)


def test_a_message_without_text_is_an_event_without_values(spark):
    rows = spark.createDataFrame([(None, 1), ("{", 2)], "value string, seq long")
    got = {r.seq: (r.id, r.tripUpdate, r._corrupt_record) for r in parse_trip_update(rows).collect()}
    assert got == {1: (None, None, None), 2: (None, None, "{")}
