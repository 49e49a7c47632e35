from fleetboard.operators.boards import (
    board_of_states,
    calls_of,
    count_copies,
    entries_of_calls,
    latest_trip_state,
    stop_board_groups,
    stop_board_latest,
    stop_entries,
    trip_state,
    vehicle_archive,
    vehicle_board,
    vehicle_state,
)
from fleetboard.operators.joins import (
    join_latest_trip,
    join_same,
    join_stops,
    join_trips,
    with_probe,
)
from fleetboard.operators.latest import (
    compact,
    fresh,
    latest_by_key,
    live_vehicles,
    within_service_hours,
)
from fleetboard.operators.paging import PAGE_SECONDS, PAGE_SIZE, pack, page_of
from fleetboard.operators.serving import (
    feed_status,
    flag_trip_stops,
    roster,
    route_shapes,
    routes_in_use,
    trip_stop_lists,
    vehicle_route,
)

__all__ = [
    "PAGE_SECONDS",
    "PAGE_SIZE",
    "board_of_states",
    "calls_of",
    "count_copies",
    "entries_of_calls",
    "compact",
    "feed_status",
    "flag_trip_stops",
    "fresh",
    "join_latest_trip",
    "join_same",
    "join_stops",
    "join_trips",
    "latest_by_key",
    "latest_trip_state",
    "live_vehicles",
    "pack",
    "page_of",
    "roster",
    "route_shapes",
    "routes_in_use",
    "stop_board_groups",
    "stop_board_latest",
    "stop_entries",
    "trip_state",
    "trip_stop_lists",
    "vehicle_archive",
    "vehicle_board",
    "vehicle_route",
    "vehicle_state",
    "with_probe",
    "within_service_hours",
]
