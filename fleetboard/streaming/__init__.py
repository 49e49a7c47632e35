from fleetboard.streaming.boards import BoardJob, print_messages, relay, run_boards, write_latest
from fleetboard.streaming.changes import only_changes, sent_digests, with_expiry
from fleetboard.streaming.deltas import add_deltas, call_deltas, fold_deltas, read_weights
from fleetboard.streaming.folders import shared_folder
from fleetboard.streaming.interval import join_within, newest_match
from fleetboard.streaming.maintained import StopBoard, run_maintained, vehicle_changes, with_ingestion_time
from fleetboard.streaming.state import join_trip_stream

__all__ = [
    "BoardJob",
    "StopBoard",
    "add_deltas",
    "call_deltas",
    "fold_deltas",
    "join_trip_stream",
    "join_within",
    "newest_match",
    "only_changes",
    "print_messages",
    "read_weights",
    "relay",
    "run_boards",
    "run_maintained",
    "sent_digests",
    "shared_folder",
    "vehicle_changes",
    "with_expiry",
    "with_ingestion_time",
    "write_latest",
]
