"""Latest state per key, freshness and expiry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetboard.functions.timefn import DEFAULT_ZONE, epoch_of, local_hour


def latest_by_key(df: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns for each key.

    Ties fall to the remaining columns, so the result never depends on arrival
    order. It is a plain aggregate: each task keeps one row per key before the
    shuffle, which also holds for a key with most of the rows, and it runs on a
    stream in update mode.
    """
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c != key and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    return df.groupBy(key).agg(newest).select(key, "_newest.*").select(*df.columns)


def compact(history: DataFrame, key: str, order: str | Sequence[str], value: str = "value") -> DataFrame:
    """Last write per key, with keys whose last write is a delete left out."""
    return latest_by_key(history, key, order).where(F.col(value).isNotNull())


def fresh(
    df: DataFrame, seconds: str, horizon_s: int = 150, as_of: int | Column | None = None
) -> DataFrame:
    """Rows strictly younger than ``horizon_s``."""
    return df.where(F.col(seconds) > epoch_of(as_of) - horizon_s)


def live_vehicles(
    updates: DataFrame,
    *,
    as_of: int | Column | None = None,
    ttl_s: int = 300,
    key: str = "id",
    seconds: str = "updateSec",
) -> DataFrame:
    """Latest row per vehicle, without those older than ``ttl_s``.

    A row of exactly that age stays. Age is tested first: a vehicle's newest
    row is live whenever any of its rows is, and fewer rows are grouped. Of rows
    of the same second the last to arrive counts, by ``seq`` where present.
    """
    alive = updates.where(F.col(seconds) >= epoch_of(as_of) - ttl_s)
    return latest_by_key(alive, key, [seconds, *(["seq"] if "seq" in updates.columns else [])])


def within_service_hours(
    df: DataFrame, seconds: str, *, zone: str = DEFAULT_ZONE, first: int = 5, last: int = 23
) -> DataFrame:
    """Rows whose local hour lies between ``first`` and ``last``, both included."""
    return df.where(local_hour(F.col(seconds), zone).between(first, last))
