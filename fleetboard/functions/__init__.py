from fleetboard.functions.timefn import (
    DEFAULT_ZONE,
    epoch_of,
    epoch_seconds,
    iso_date,
    local_hour,
    local_time,
    rowtime,
)
from fleetboard.functions.transit import eta_minutes, is_upcoming, next_stop, no_next_stop

__all__ = [
    "DEFAULT_ZONE",
    "epoch_of",
    "epoch_seconds",
    "eta_minutes",
    "is_upcoming",
    "iso_date",
    "local_hour",
    "local_time",
    "next_stop",
    "no_next_stop",
    "rowtime",
]
