"""Hand-made feed messages."""

import json

from fleetboard import schemas as S

NOW = 1691291885


def call(time=None, delay=None):
    if time is None:
        return None
    return {k: str(v) for k, v in (("delay", delay), ("time", time)) if v is not None}


def stop(sequence, stop_id, departure=None, delay=None, arrival=None, arrival_delay=None):
    entry = {"stopSequence": sequence, "stopId": stop_id}
    if departure is not None:
        entry["departure"] = call(departure, delay)
    if arrival is not None:
        entry["arrival"] = call(arrival, arrival_delay)
    return entry


def trip_update(trip_id, stops, ts=NOW, start_time="21:50:00"):
    update = {
        "trip": {"tripId": trip_id, "startTime": start_time, "startDate": "20230805"},
        "vehicle": {"id": "4712", "label": "512"},
        "timestamp": str(ts),
    }
    if stops is not None:
        update["stopTimeUpdate"] = stops
    return {"id": trip_id, "tripUpdate": update}


def vehicle(vehicle_id, trip_id, ts=NOW, start_date="20230805", latitude=43.0):
    event = {
        "position": {"latitude": latitude, "longitude": -89.5, "bearing": 225.0},
        "timestamp": str(ts),
        "vehicle": {"id": "4711", "label": vehicle_id},
    }
    if trip_id is not None:
        event["trip"] = {"tripId": trip_id, "startDate": start_date, "routeId": "810"}
    return {"id": vehicle_id, "vehicle": event}


def long_trip(trip_id="T1"):
    """22 entries a minute apart, without delays; the 11th leaves in 15 s, the
    19th has snake_case keys and the last only arrives."""
    stops = []
    for i in range(1, 23):
        at = str(NOW + (i - 11) * 60 + 15)
        if i == 19:
            stops.append({"stop_sequence": 28 + i, "stop_id": "s19", "departure": {"time": at}})
        elif i == 22:
            stops.append({"stopSequence": 28 + i, "stopId": f"s{i}", "arrival": {"time": at}})
        else:
            stops.append({"stopSequence": 28 + i, "stopId": f"s{i}", "departure": {"time": at}})
    return trip_update(trip_id, stops)


def messages(spark, events, first_seq=0):
    rows = [
        (json.dumps(e) if isinstance(e, dict) else e, first_seq + i) for i, e in enumerate(events)
    ]
    return spark.createDataFrame(rows, "value string, seq bigint")


def trip_lookup(spark, *trips):
    """Lookup rows of (trip_id, shape_id, route, headsign)."""
    names = S.TRIP_LOOKUP.names
    at = [names.index(n) for n in ("trip_id", "shape_id", "route_short_name", "trip_headsign")]
    rows = []
    for trip in trips:
        row = [None] * len(names)
        for i, value in zip(at, trip):
            row[i] = value
        rows.append(tuple(row))
    return spark.createDataFrame(rows, S.TRIP_LOOKUP)


def stop_lookup(spark, *stops):
    """Lookup rows of (stop_id, stop_name)."""
    names = S.STOP_LOOKUP.names
    rows = []
    for stop_id, stop_name in stops:
        row = dict.fromkeys(names)
        row.update(stop_id=stop_id, stop_name=stop_name, stop_lat="43.1", stop_lon="-89.3")
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, S.STOP_LOOKUP)
