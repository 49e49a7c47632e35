"""Column functions over the stop entries of a trip update."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entries that the shortened search looks at (``max_lookahead=MAX_LOOKAHEAD``).
MAX_LOOKAHEAD = 20
SENTINEL = "0"


def _call_time(stop: Column, field: str, use_arrival: bool) -> Column:
    value = stop["departure"][field]
    return F.coalesce(value, stop["arrival"][field]) if use_arrival else value


def is_upcoming(
    stop: Column, feed_ts: Column, *, add_delay: bool = True, use_arrival: bool = False
) -> Column:
    """Whether a stop entry leaves at or after the feed time.

    NULL, so not selected by a filter, when the entry has no departure.
    A missing or unreadable delay counts as 0.
    """
    leaves = _call_time(stop, "time", use_arrival).try_cast("bigint")
    if add_delay:
        delay = _call_time(stop, "delay", use_arrival).try_cast("bigint")
        leaves = leaves + F.coalesce(delay, F.lit(0))
    return leaves >= feed_ts


def no_next_stop(sentinel: str | None = SENTINEL, delay: Column | None = None) -> Column:
    """The value of ``next_stop`` when no entry qualifies."""
    text = F.lit(sentinel).cast("string")
    seconds = F.lit(None if sentinel is None else 0).cast("bigint")
    return F.struct(
        text.alias("stopSequence"),
        text.alias("stopId"),
        seconds.alias("approachSec"),
        (F.lit(None).cast("string") if delay is None else delay).alias("delay"),
    )


def next_stop(
    stops: Column,
    feed_ts: Column,
    *,
    max_lookahead: int | None = None,
    sentinel: str | None = SENTINEL,
    null_delay_as_zero: bool = False,
    add_delay: bool = True,
    use_arrival: bool = False,
    delay_of: str = "first",
) -> Column:
    """First upcoming entry as struct(stopSequence, stopId, approachSec, delay).

    Only the first ``max_lookahead`` entries count (None: all). ``approachSec``
    is NULL when the entry has no delay, unless ``null_delay_as_zero``.
    ``delay`` is the first entry's, or the chosen one's with ``delay_of='chosen'``.
    """
    if delay_of not in ("first", "chosen"):
        raise ValueError("delay_of must be 'first' or 'chosen'")

    first_delay = F.get(stops, F.lit(0))["departure"]["delay"]

    def describe(stop: Column) -> Column:
        delay = _call_time(stop, "delay", use_arrival).try_cast("bigint")
        if null_delay_as_zero:
            delay = F.coalesce(delay, F.lit(0))
        seconds = _call_time(stop, "time", use_arrival).try_cast("bigint") - feed_ts
        if add_delay:
            seconds = seconds + delay
        shown = stop["departure"]["delay"] if delay_of == "chosen" else first_delay
        return F.struct(
            stop["stopSequence"].alias("stopSequence"),
            stop["stopId"].alias("stopId"),
            seconds.alias("approachSec"),
            shown.alias("delay"),
        )

    window = stops if max_lookahead is None else F.slice(stops, 1, max_lookahead)
    upcoming = F.filter(
        window,
        lambda s: is_upcoming(s, feed_ts, add_delay=add_delay, use_arrival=use_arrival),
    )
    # One lambda pass builds the whole struct, so the search runs once per row.
    found = F.get(F.transform(F.slice(upcoming, 1, 1), describe), F.lit(0))
    shown = F.lit(None).cast("string") if delay_of == "chosen" else first_delay
    return F.coalesce(found, no_next_stop(sentinel, shown))


def eta_minutes(seconds: Column, *, null_as_zero: bool = True) -> Column:
    """Whole minutes to the next stop, rounded up."""
    if null_as_zero:
        seconds = F.coalesce(seconds, F.lit(0))
    return F.ceil(seconds / 60)
