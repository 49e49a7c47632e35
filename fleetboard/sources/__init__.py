from fleetboard.sources.ingest import (
    entity_json,
    explode_feed,
    parse_trip_update,
    parse_vehicle,
    read_landed,
    read_topic,
    split_corrupt,
    unknown_keys,
    with_rowtime,
)
from fleetboard.sources.lookups import (
    read_shapes,
    read_stop_lookup,
    read_stop_times,
    read_trip_lookup,
    store_bucketed,
)
from fleetboard.sources.polls import PollSource, land_polls, read_polls, run_to_end

__all__ = [
    "PollSource",
    "entity_json",
    "explode_feed",
    "land_polls",
    "parse_trip_update",
    "parse_vehicle",
    "read_landed",
    "read_polls",
    "read_shapes",
    "read_stop_lookup",
    "read_stop_times",
    "read_topic",
    "read_trip_lookup",
    "run_to_end",
    "store_bucketed",
    "split_corrupt",
    "unknown_keys",
    "with_rowtime",
]
