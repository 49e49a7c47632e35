"""Fixed schemas of feeds, lookups and boards. Nothing is inferred.

``*_WIRE`` is what a JSON message is parsed with: 64-bit integers arrive
quoted, so they are read as text there and cast afterwards.
"""

from pyspark.sql import types as T

STR, LONG, INT, FLOAT, DOUBLE = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.FloatType(),
    T.DoubleType(),
)


def _struct(names: str, kind: T.DataType = STR) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name in names.split()])


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRIP = _struct("tripId startTime startDate routeId scheduleRelationship directionId")
POSITION = _struct("latitude longitude bearing speed", FLOAT)
DESCRIPTION = _struct("id label")
CALL_TIME = _struct("delay time uncertainty")
STOP_TIME_UPDATE = _of(
    stopSequence=STR,
    departure=CALL_TIME,
    arrival=CALL_TIME,
    stopId=STR,
    scheduleRelationship=STR,
)


def _vehicle(epoch: T.DataType, percent: T.DataType) -> T.StructType:
    return _of(
        id=STR,
        vehicle=_of(
            trip=TRIP,
            position=POSITION,
            timestamp=epoch,
            vehicle=DESCRIPTION,
            occupancyStatus=STR,
            occupancyPercentage=percent,
        ),
    )


def _trip_update(epoch: T.DataType) -> T.StructType:
    return _of(
        id=STR,
        tripUpdate=_of(
            trip=TRIP,
            stopTimeUpdate=T.ArrayType(STOP_TIME_UPDATE),
            vehicle=DESCRIPTION,
            timestamp=epoch,
        ),
    )


VEHICLE_WIRE, VEHICLE_EVENT = _vehicle(STR, STR), _vehicle(LONG, INT)
TRIP_UPDATE_WIRE, TRIP_UPDATE_EVENT = _trip_update(STR), _trip_update(LONG)

# One landed snapshot; every entity is kept as its JSON text.
FEED_WIRE = _of(entity=T.ArrayType(STR))

# Names and order of the lookup files' columns.
TRIP_LOOKUP = _of(
    route_id=STR,
    route_short_name=STR,
    service_id=STR,
    trip_id=STR,
    trip_headsign=STR,
    direction_id=STR,
    trip_direction_name=STR,
    block_id=STR,
    shape_id=STR,
    shape_code=STR,
    trip_type=STR,
    trip_sort=STR,
    trip_short_name=STR,
    block_transfer_id=STR,
    wheelchair_accessible=INT,
    bikes_allowed=INT,
)
STOP_LOOKUP = _of(
    stop_id=STR,
    stop_code=STR,
    stop_name=STR,
    stop_desc=STR,
    stop_lat=STR,
    stop_lon=STR,
    agency_id=STR,
    jurisdiction_id=STR,
    location_type=STR,
    parent_station=STR,
    relative_position=STR,
    cardinal_direction=STR,
    wheelchair_boarding=STR,
    primary_street=STR,
    address_range=STR,
    cross_location=STR,
)
STOP_TIMES = _of(trip_id=STR, stop_id=STR, stop_sequence=LONG)
SHAPES = _of(
    shape_id=STR, shape_pt_lon=DOUBLE, shape_pt_lat=DOUBLE, shape_pt_sequence=LONG
)

# Served boards. ``updateSec`` carries the epoch behind the local time text,
# which is ambiguous in the hour when clocks go back.
VEHICLE_BOARD = _of(
    id=STR,
    tripId=STR,
    shapeId=STR,
    routeName=STR,
    tripHeadSign=STR,
    startDate=STR,
    startTime=STR,
    latitude=FLOAT,
    longitude=FLOAT,
    updateTime=STR,
    nextStopSequence=STR,
    nextStopId=STR,
    nextStopName=STR,
    nextStopApproachSec=LONG,
    nextStopDelay=STR,
    ingestionTime=STR,
    updateSec=LONG,
)
STOP_BOARD = _of(
    stopId=STR,
    stopName=STR,
    stopLat=STR,
    stopLon=STR,
    updateTime=STR,
    updateSec=LONG,
    page=LONG,
    info=STR,
)
