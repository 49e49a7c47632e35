from fleetboard.sinks.committed import manifests, read_committed, write_committed
from fleetboard.sinks.metrics import with_counts
from fleetboard.sinks.runs import RunTable
from fleetboard.sinks.upsert import (
    PRODUCER_OPTIONS,
    append_changes,
    compact_changes,
    read_board,
    read_changes,
    served,
    stop_upserts,
    to_upsert,
    write_archive,
    write_jdbc,
    write_topic,
)

__all__ = [
    "PRODUCER_OPTIONS",
    "RunTable",
    "append_changes",
    "compact_changes",
    "manifests",
    "read_board",
    "read_changes",
    "read_committed",
    "served",
    "stop_upserts",
    "to_upsert",
    "with_counts",
    "write_archive",
    "write_committed",
    "write_jdbc",
    "write_topic",
]
